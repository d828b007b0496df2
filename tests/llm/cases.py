"""Small tables with what real ones hold: nulls, empty and long texts, repeated rows, clashing names."""

from __future__ import annotations

#: Columns that operators use as names of results or of their own helpers.
CLASHING = (
    "size score shard slot host fp ids blocks n_words component_id lang_pred copies decoded "
    "id node _rank _cell _before _ends _key2 _inside _best n form output kept n_lines cluster distance"
).split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)

EN = "The house of the old man is near the river and they walk there in the morning with the dog. "
DE = "Das Haus des alten Mannes ist nicht weit vom Fluss und sie gehen am Morgen mit dem Hund dorthin. "
LONG = " ".join(f"word{i % 997}" for i in range(60_000))

TEXTS = [
    (1, EN * 4, "en", "a"),
    (2, EN * 4, "en", "a"),
    (3, DE * 4, "de", "b"),
    (4, DE * 3 + "Und dann kommen alle zusammen.", "de", "b"),
    (5, None, "en", "a"),
    (6, "", "en", None),
    (7, " \t\n\x0b ", None, None),
    (8, LONG, "en", "c"),
    (9, "12 34 -- ***", "en", "c"),
    (10, "a", "en", "c"),
    (11, EN + "\n" + EN + "\n" + EN, None, "c"),
    (12, "É" * 50 + " <|endoftext|> it's\u00a0naïve e\u0301", "de", "ä"),
    (None, EN + "nobody knows", "en", "a"),
    (None, None, None, None),
    (1, EN * 4, "en", "a"),
    (13, "Released under the MIT License. " + EN, "en", "b"),
    (14, "x" * 5000, "en", "b"),
]


def rows():
    return [(i, t, lang, s, None if t is None else len(t), *[f"own {c}" for c in CLASHING]) for i, t, lang, s in TEXTS]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def own_values(df, given_way=()):
    """Whether the caller's columns that need not give way still hold what the caller put there."""
    names = [c for c in CLASHING if c not in given_way]
    return all(r[c] == f"own {c}" for r in df.select(*[f"`{c}`" for c in names]).collect() for c in names)
