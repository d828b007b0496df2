"""Label extraction from decision payloads.

Payload text arrives with `;` for `,` and single for double quotes. Every function
returns an array of `key::value` items, null where the text is not a known form.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from raterscope.functions.clean import clean_text

SEPARATOR = "::"
_STRINGS = "map<string,string>"
_CORRUPT = "_corrupt_record"
_DECISION = f"decision_string string, labels array<string>, response string, {_CORRUPT} string"
_ENTITIES = "map<string,struct<payload:array<struct<values:map<string,string>>>>>"

# A value that cleaning leaves as it is and that is neither a list nor a boolean.
_PLAIN = r"^(?!(true|false)$)([\w.,:;/+-]+( [\w.,:;/+-]+)*)?$"

# The usual spellings, in raw text: one pattern takes them apart as the replacement of separators and the
# JSON parse would, because their texts hold no quote, semicolon, backslash or control character. All other
# text is parsed. Loops are possessive, so long payloads cost no stack.
_S = r"[ \t\r\n]*+"
_C = rf"{_S}[,;]{_S}"
_TEXT = r"""[^"';\\\x00-\x1f]*+"""
_ITEM = rf"""["']{_TEXT}["']"""
_LIST_FORM = (
    rf"""^{_S}\{{{_S}["']decision_string["']{_S}:{_S}{_ITEM}{_C}["']labels["']{_S}:{_S}"""
    rf"\[{_S}({_ITEM}(?:{_C}{_ITEM})*+){_S}\]{_S}\}}{_S}\z"
)
_Q = r'\\"'  # a quote inside a JSON string, where white space is blanks
_I = r" *+[,;] *+"
_INNER = rf"{_Q}{_TEXT}{_Q}"
_KEYED_FORM = (
    rf"""^{_S}\{{{_S}["']\d{{1,1000}}+["']{_S}:{_S}["']\{{ *+{_Q}labels{_Q} *+: *+"""
    rf"""\[ *+({_INNER}(?:{_I}{_INNER})*+) *+\] *+\}}["']{_S}\}}{_S}\z"""
)
_KEY = rf"""{_Q}[^"';{{}}\\\x00-\x1f]{{1,1000}}+{_Q}: ?+"""
_PAIR = rf"{_KEY}{_Q}(?!(?:true|false){_Q})(?:[\w.,:/+-]++(?: [\w.,:/+-]++)*+)?+{_Q}"
_VALUES = rf"\{{{_Q}values{_Q}: ?+\{{"
_PAIRS = rf"{_PAIR}(?:[,;] ?+{_PAIR})*+"
_NESTED_FORM = (
    rf"""^{_S}\{{{_S}["']is_rejected["']{_S}:{_S}(?:true|false){_C}["']response["']{_S}:{_S}["']\{{{_KEY}\{{{_Q}payload{_Q}: ?+"""
    rf"""\[{_VALUES}({_PAIRS}(?:\}}\}}[,;] ?+{_VALUES}{_PAIRS})*+)\}}\}}\]\}}\}}["']{_S}\}}{_S}\z"""
)
# Fixed value: longer texts are left to the parser, which has bounds of its own.
_LONGEST = 1_000_000


def fix_separators(raw: Column) -> Column:
    return _double_quotes(F.replace(raw, F.lit(";"), F.lit(",")))


def _double_quotes(text: Column) -> Column:
    return F.replace(text, F.lit("'"), F.lit('"'))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value computed once: a lambda variable is never evaluated again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _by_pattern(
    raw: Column, pattern: str, found: Callable[[Column], Column], other: Callable[[], Column]
) -> Column:
    """`found` of the pattern's group where the whole text fits the pattern, else `other`."""
    body = F.when(F.octet_length(raw) <= _LONGEST, F.regexp_extract(raw, pattern, 1))
    return _let(body, lambda b: F.when(b != "", found(b)).otherwise(other()))


def _items_in(body: Column, quote: str) -> Column:
    """The texts between quotes; none of them holds a quote or a backslash."""
    return F.regexp_extract_all(body, F.lit(rf"""{quote}([^"'\\]*+){quote}"""), F.lit(1))


def _listed_items(body: Column) -> Column:
    return _items_in(body, "[\"']")


def _nested_items(body: Column) -> Column:
    """`key::value` of the pairs of all `values` objects, in their order."""
    joined = F.regexp_replace(body, rf"\}}\}}[,;] ?{_VALUES}", ",")
    return _items_in(F.regexp_replace(joined, rf"{_Q}: ?{_Q}", SEPARATOR), _Q)


def decision_labels(raw: Column) -> Column:
    """Labels of a decision payload in list form or in nested form.

    The usual spellings are taken apart by a pattern. Any other well-typed payload is read with
    one typed parse per JSON level. One that does not fit the types (and only that one) is taken
    apart level by level.
    """

    def typed(text: Column) -> Column:
        first = F.regexp_extract(text, r'^\s*\{\s*"([^"]*)"', 1)

        def by_form(top: Column) -> Column:
            fits = top[_CORRUPT].isNull()
            return (
                F.when(fits & (first == "decision_string"), F.coalesce(top["labels"], _no_labels()))
                .when(fits & (first == "is_rejected"), _nested_labels(top["response"]))
                .otherwise(_labels_by_level(text))
            )

        parsed = F.from_json(text, _DECISION, {"columnNameOfCorruptRecord": _CORRUPT})
        return _let(parsed, by_form)

    def other() -> Column:
        return _by_pattern(raw, _NESTED_FORM, _nested_items, lambda: _let(fix_separators(raw), typed))

    return _by_pattern(raw, _LIST_FORM, _listed_items, other)


def _labels_by_level(text: Column) -> Column:
    def by_form(top: Column) -> Column:
        first = F.get(F.map_keys(top), F.lit(0))
        return F.when(first == "decision_string", _label_list(top)).when(
            first == "is_rejected", _nested_labels(F.try_element_at(top, F.lit("response")))
        )

    return _let(F.from_json(text, _STRINGS), by_form)


def flat_labels(raw: Column) -> Column:
    """Every top-level key and value of an object."""
    return _object_items(fix_separators(raw))


def listed_labels(raw: Column) -> Column:
    """The `labels` array of the list form."""

    def list_form(top: Column) -> Column:
        first = F.get(F.map_keys(top), F.lit(0))
        return F.when(first == "decision_string", _label_list(top))

    parsed = F.from_json(fix_separators(raw), _STRINGS)
    return _by_pattern(raw, _LIST_FORM, _listed_items, lambda: _let(parsed, list_form))


def auditor_keyed_labels(raw: Column) -> Column:
    """Struct(auditor_id, labels) of a payload keyed by one all-digit auditor id."""

    def keyed(top: Column) -> Column:
        auditor = F.get(F.map_keys(top), F.lit(0))
        nested = F.from_json(F.get(F.map_values(top), F.lit(0)), "labels array<string>")
        return F.when(
            auditor.rlike(r"^\d+$"),
            F.struct(auditor.alias("auditor_id"), nested["labels"].alias("labels")),
        )

    def usual(body: Column) -> Column:
        auditor = F.regexp_extract(raw, r"(\d+)", 1)
        return F.struct(auditor.alias("auditor_id"), _items_in(body, _Q).alias("labels"))

    parsed = F.from_json(fix_separators(raw), _STRINGS)
    found = _by_pattern(raw, _KEYED_FORM, usual, lambda: _let(parsed, keyed))
    return _let(found, lambda k: F.when(k["labels"].isNotNull(), k))


def _label_list(top: Column) -> Column:
    """The labels text as an array; a missing or other value is an empty list."""
    return F.coalesce(
        F.from_json(F.try_element_at(top, F.lit("labels")), "array<string>"), _no_labels()
    )


def _nested_labels(response: Column) -> Column:
    """response -> first entity -> payload items -> their `values` objects."""

    def typed(text: Column) -> Column:
        def from_items(items: Column) -> Column:
            simple = F.forall(
                items,
                lambda i: F.forall(
                    F.map_values(i["values"]), lambda v: F.coalesce(v.rlike(_PLAIN), F.lit(True))
                ),
            )
            labels = F.transform(
                items,
                lambda i: F.transform(
                    F.map_entries(i["values"]),
                    lambda e: F.concat(
                        e["key"], F.lit(SEPARATOR), F.coalesce(e["value"], F.lit(""))
                    ),
                ),
            )
            # Null where an item has no values object, so that case goes level by level.
            return F.when(simple, F.flatten(labels)).otherwise(_items_by_level(text))

        entity = F.get(F.map_values(F.from_json(text, _ENTITIES)), F.lit(0))
        return _let(entity["payload"], from_items)

    blank = response.isNull() | response.isin("", "null")
    return F.when(blank, _no_labels()).otherwise(_let(_double_quotes(response), typed))


def _items_by_level(text: Column) -> Column:
    def items(payload: Column) -> Column:
        # A single object stands for a list of one.
        return F.coalesce(F.from_json(payload, "array<string>"), F.array(payload))

    def labels(entities: Column) -> Column:
        entity = F.get(F.map_values(entities), F.lit(0))
        payload = F.from_json(entity, "payload string")["payload"]
        per_item = F.transform(
            _let(payload, items),
            lambda item: _object_items(F.from_json(item, "values string")["values"]),
        )
        known = F.filter(per_item, lambda part: part.isNotNull())
        return F.when(entities.isNotNull(), F.coalesce(F.flatten(known), _no_labels()))

    return _let(F.from_json(text, _STRINGS), labels)


def _object_items(text: Column) -> Column:
    def items(known: Column) -> Column:
        return F.transform(
            F.map_entries(F.from_json(known, _STRINGS)),
            lambda e: F.concat(e["key"], F.lit(SEPARATOR), _shown(e["key"], e["value"], known)),
        )

    return _let(text, items)


def _shown(key: Column, value: Column, text: Column) -> Column:
    """A value as text: lists comma-joined, booleans capitalised, null as blank.

    Only a value that looks like a list or a boolean is parsed again to learn its type.
    """
    typed = F.try_element_at(F.from_json(text, "map<string,variant>"), key)

    def special(kind: Column) -> Column:
        joined = F.array_join(
            F.transform(F.from_json(value, "array<string>"), lambda v: clean_text(v)), ","
        )
        return (
            F.when(kind == "BOOLEAN", F.initcap(value))
            .when(kind.startswith("ARRAY"), joined)
            .otherwise(clean_text(value))
        )

    return (
        F.when(value.rlike(_PLAIN), value)
        .when(value.rlike(r"^(true|false|\[[\s\S]*\])$"), _let(F.schema_of_variant(typed), special))
        .otherwise(clean_text(value))
    )


def _no_labels() -> Column:
    return F.array().cast("array<string>")


def label_entries(labels: Column, excluded: Sequence[str] = ()) -> Column:
    """Array of struct(key, value): items split at the first `::`, keys trimmed.

    Items without the separator and excluded keys are dropped; the first value of a key
    wins.
    """
    start = len(SEPARATOR) + 1

    def parts(items: Column) -> Column:
        split = F.transform(
            F.filter(items, lambda s: F.contains(s, F.lit(SEPARATOR))),
            lambda s: F.struct(
                F.trim(F.substring_index(s, SEPARATOR, 1)).alias("key"),
                s.substr(F.locate(SEPARATOR, s) + start - 1, F.length(s)).alias("value"),
            ),
        )
        if excluded:
            names = [name.strip() for name in excluded]
            split = F.filter(split, lambda e: ~e["key"].isin(names))
        return split

    def first_wins(found: Column) -> Column:
        return _let(
            F.transform(found, lambda e: e["key"]),
            lambda keys: F.filter(found, lambda e, i: F.array_position(keys, e["key"]) == i + 1),
        )

    return _let(_let(labels, parts), first_wins)


def label_map(labels: Column, excluded: Sequence[str] = ()) -> Column:
    return F.map_from_entries(label_entries(labels, excluded))


def rubric_answers(raw: Column) -> Column:
    """Map question -> number of "Yes" in its answer list; blank or bad text gives an empty map."""

    def counts(items: Column) -> Column:
        return F.transform(
            F.filter(items, lambda i: i["question"].isNotNull()),
            lambda i: F.struct(i["question"].alias("key"), _count_yes(i["answer"]).alias("value")),
        )

    def last_wins(found: Column) -> Column:
        later = F.filter(
            found,
            lambda e, i: ~F.exists(
                F.slice(found, i + 2, F.size(found)), lambda after: after["key"] == e["key"]
            ),
        )
        return F.map_from_entries(later)

    parsed = F.from_json(F.trim(raw), "array<struct<question:string,answer:string>>")
    answers = _let(_let(parsed, counts), last_wins)
    return F.coalesce(answers, F.create_map().cast("map<string,int>"))


def _count_yes(answer: Column) -> Column:
    values = F.coalesce(
        F.from_json(answer, "array<string>"),
        F.from_json(_double_quotes(answer), "array<string>"),
    )
    return F.coalesce(F.size(F.filter(values, lambda v: v == "Yes")), F.lit(0))
