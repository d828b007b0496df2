"""Line dedup: lines that many documents share are dropped from all of them.

Every text is split into lines, and the lines are exploded with their positions. A line's key
is the line stripped and in lower case; it travels as two 64-bit hashes. Distinct documents
are counted per hash, and the texts are put together again from the positions that stay.

Hashes are counted with map-side aggregation. The rows of a hash found in a large part of all
lines are matched with a broadcast list: as the rows of the list's hashes add up to no more
than all rows, hashes above 1 / HOT_KEYS of them are fewer than HOT_KEYS. All others meet
their rows in a shuffled join, where none is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raterscope.llm.common import free_name, register, table
from raterscope.session import stored

LEAST_DOCUMENTS = 10
LEAST_CHARS = 1
HOT_KEYS = 4096
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

HASH = ["h1", "h2"]
TEXT_KEY = ["doc", "t1", "t2"]


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _hashes(value: Column, names: list[str]) -> list[Column]:
    return [F.xxhash64(F.lit(seed), value).alias(name) for seed, name in enumerate(names)]


def line_hashes(docs: DataFrame, id_col: str, text_col: str, least_chars: int = LEAST_CHARS) -> DataFrame:
    """`doc`, `t1`, `t2`, `pos`, `h1`, `h2`: every line whose key has `least_chars` code points.

    The id and the text's two hashes stand for the text: rows that agree on them are alike.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # the whole text is put in lower case at once; the strip does not touch other letters
    lines = F.split(F.translate("text", UPPER, LOWER), "\n", -1)
    return (
        docs.select(F.col(id_col).alias("doc"), text.alias("text"))
        .select("doc", *_hashes(F.col("text"), ["t1", "t2"]), F.posexplode(lines).alias("pos", "line"))
        .withColumn("line", F.btrim("line", F.lit(BLANKS)))
        .where(F.char_length("line") >= least_chars)
        .select(*TEXT_KEY, "pos", *_hashes(F.col("line"), HASH))
    )


def document_counts(lines: DataFrame) -> DataFrame:
    """`h1`, `h2`, `documents`, `rows`: distinct documents and all rows of each line hash.

    Rows of one id are one document. Rows without an id are told apart by their text.
    """
    unnamed = [F.when(F.col("doc").isNull(), F.col(c)).alias(f"_{c}") for c in ("t1", "t2")]
    each = lines.groupBy(*HASH, "doc", *unnamed).agg(F.count("*").alias("rows"))
    return each.groupBy(*HASH).agg(F.count("*").alias("documents"), F.sum("rows").alias("rows"))


def lines_of(lines: DataFrame, wanted: DataFrame, total: int) -> DataFrame:
    """The rows of `lines` whose hash is in `wanted` (`h1`, `h2`, `rows`; one row per hash).

    `total` is the number of all rows. The largest hashes are matched where their rows lie.
    """
    limit = total / HOT_KEYS
    hot = F.broadcast(wanted.where(F.col("rows") > limit).select(*HASH))  # fewer than HOT_KEYS rows
    cold = wanted.where(F.col("rows") <= limit).select(*HASH)
    near = lines.join(hot, HASH, "left_semi")
    return near.unionByName(lines.join(hot, HASH, "left_anti").join(cold, HASH, "left_semi"))


def drop_common_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_documents: int = LEAST_DOCUMENTS,
    least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """All columns of `docs` with `n_lines`, `n_dropped` and `kept`, the text that is left.

    Lines whose key has at least `least_chars` code points and is found in at least
    `least_documents` documents go, however often a document has them; the others stay as they
    were, joined by line feeds. If none stays, `kept` is empty.

    A null or empty text is one empty line, and `kept` is empty. Repeated rows of one id count as
    one document and stay; rows of one id with different texts count as one document too. Rows
    without an id are one document per text. An empty table gives an empty result. Columns of
    `docs` named as the three results give way; no other column is read or changed.
    """
    columns = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped", "kept")]
    if id_col not in columns or text_col not in columns:
        raise ValueError("the id and the text need names other than those of the results")
    lines = stored(line_hashes(docs, id_col, text_col, least_chars), "lines")
    counts = stored(document_counts(lines), "line-counts")
    total = counts.agg(F.sum("rows")).first()[0] or 0
    gone = (
        lines_of(lines, counts.where(F.col("documents") >= least_documents), total)
        .groupBy(*TEXT_KEY)
        .agg(F.collect_set("pos").alias("gone"))  # no more than one text's lines
    )
    own = {name: free_name(columns, f"_{name}") for name in ("text", "t1", "t2", "lines")}
    gone = gone.select(*[F.col(c).alias(free_name(columns, f"_gone_{c}")) for c in gone.columns])
    doc, t1, t2, positions = gone.columns
    rows = docs.select(
        *[F.col(f"`{c}`") for c in columns],
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(own["text"]),
    ).select("*", *_hashes(F.col(own["text"]), [own["t1"], own["t2"]]))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(doc))
    joined = rows.join(gone, same & (F.col(own["t1"]) == F.col(t1)) & (F.col(own["t2"]) == F.col(t2)), "left")
    split = F.split(own["text"], "\n", -1)
    # array_except keeps the order and looks positions up in a hash set
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(positions))
    cut = F.concat_ws("\n", F.transform(stay, lambda p: F.get(F.col(own["lines"]), p)))
    joined = joined.withColumn(own["lines"], F.when(F.col(positions).isNotNull(), split))
    return joined.select(
        *[F.col(f"`{c}`") for c in columns],
        F.size(split).cast("long").alias("n_lines"),
        F.coalesce(F.size(positions), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col(positions).isNull(), F.col(own["text"])).otherwise(cut).alias("kept"),
    )


SQL = f"""
with l as (
  select doc_id, pos, lines[pos] as line,
    translate(trim(lines[pos], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') as key
  from (select doc_id, lines, unnest(range(1, len(lines) + 1)) as pos
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents) s) p
), common as (
  select key from l where length(key) >= {LEAST_CHARS} group by key having count(distinct doc_id) >= {LEAST_DOCUMENTS}
), marked as (select l.*, c.key is not null as gone from l left join common c on l.key = c.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""


@register(SQL)
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_common_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )
