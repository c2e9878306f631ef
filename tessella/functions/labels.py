"""Strict JSON and the extraction, repair and validation of JSON labels in model responses.

Everything but ``pretty_json`` is a plain Column expression on the JVM.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from tessella.functions.text import as_col, brace_slice, let, non_empty, strip

# A number appended to the wrapped text. A parse that ends on it has consumed the whole text.
_END = "7301995218734066113"

#: Levels of arrays and objects that are read.
MOST_LEVELS = 999
#: Bytes of text from which the parser's result may not fit into one value.
MOST_BYTES = 128 << 20

# The two keys a label must have.
REASONING, IDENTIFIERS = "reasoning", "identifiers"

# Fenced blocks, tried in this order; group 1 is the candidate.
FENCED_PATTERNS = (
    r"(?sU)```json\s*(\{.*?\})\s*```",
    r"(?sU)```\s*(\{.*?\})\s*```",
    r"(?sU)```json\s*(.*?)\s*```",
    r"(?sU)```\s*(.*?)\s*```",
)


def _at(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _parse(text: Column) -> Column:
    """The text as variant, null if it is no JSON, without the parser's usual limits of the length of strings and
    numbers. Its limit of nesting, a thousand levels, stays: it works by recursion, and more would end the process."""
    options = {"maxStringLen": str(2**31 - 1), "maxNumLen": str(2**31 - 1), "allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "mode": "PERMISSIVE"}
    return F.from_json(text, "variant", options)


def strict_variant(c: Column | str) -> Column:
    """The text wrapped as variant ``[value, ...]``, or null unless it is exactly one JSON value.

    The JSON parser tolerates text after the first value, so the text is wrapped with an end mark
    behind it: only a parse that reaches the mark has read everything. A text that holds the mark
    itself is parsed in two different wrappings instead, of which trailing text breaks at least one.
    NaN and Infinity are rejected (RFC 8259).
    """
    text = as_col(c)

    def check(j):
        marked = let(
            _parse(F.concat(F.lit("["), j, F.lit(f",{_END}]"))),
            lambda v: F.when((_at(v, "$[1]", "bigint") == int(_END)) & _at(v, "$[2]").isNull(), v),
        )
        twice = let(
            _parse(F.concat(F.lit("["), j, F.lit("]"))),
            lambda v: F.when(
                _at(v, "$[0]").isNotNull()
                & _at(v, "$[1]").isNull()
                & _parse(F.concat(F.lit('{"v":'), j, F.lit("}"))).isNotNull(),
                v,
            ),
        )
        return F.when(F.contains(j, F.lit(_END)), twice).otherwise(marked)

    return let(text, check)


def is_too_large(c: Column | str) -> Column:
    """Whether a text that is not read as JSON nests deeper than ``MOST_LEVELS``, or is beyond what a value may hold.
    The depth is that of brackets outside strings; it is looked at only where there are brackets enough."""
    text = as_col(c)
    marks = F.regexp_replace(F.regexp_replace(text, r'(?s)"(?:[^"\\]|\\.)*+"', ""), r"[^\[\]{}]+", "")
    step = lambda a, x: F.struct((a["now"] + x).alias("now"), F.greatest(a["most"], a["now"] + x).alias("most"))
    each = F.transform(F.split(marks, ""), lambda m: F.when(m.isin("[", "{"), 1).when(m.isin("]", "}"), -1).otherwise(0))
    depth = F.aggregate(each, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step)["most"]
    deep = F.when(F.length(text) - F.length(F.translate(text, "[{", "")) > MOST_LEVELS, depth > MOST_LEVELS).otherwise(False)
    return F.coalesce((F.octet_length(text) >= MOST_BYTES) | deep, F.lit(False))


def is_strict_json(c: Column | str) -> Column:
    return strict_variant(c).isNotNull()


def has_label_keys(v: Column) -> Column:
    """Whether a strict variant is an object with both keys (null values count as present)."""
    return _at(v, f"$[0].{REASONING}").isNotNull() & _at(v, f"$[0].{IDENTIFIERS}").isNotNull()


def is_label(c: Column | str) -> Column:
    return let(strict_variant(c), lambda v: F.coalesce(has_label_keys(v), F.lit(False)))


def label_items(v: Column) -> Column:
    """The identifier list as ``array<variant>``; null when it is missing or not a list."""
    return _at(v, f"$[0].{IDENTIFIERS}", "array<variant>")


def string_items(items: Column) -> Column:
    """Keep positions; items that are not strings become null."""
    return F.transform(
        items, lambda e: F.when(F.schema_of_variant(e) == "STRING", F.try_variant_get(e, "$", "string"))
    )


def reasoning_text(v: Column) -> Column:
    """The reasoning when it is a string, else null."""
    return F.when(
        F.schema_of_variant(_at(v, f"$[0].{REASONING}")) == "STRING", _at(v, f"$[0].{REASONING}", "string")
    )


def repair_json(c: Column | str) -> Column:
    """Outer-brace slice, quotes around bare keys, no trailing commas. Key quoting is purely
    textual and so also fires inside string values."""
    body = let(strip(c), lambda s: F.coalesce(brace_slice(s), s))
    # fixed values: both patterns
    quoted = F.regexp_replace(body, r"(?U)([{,]\s*)(\w+)(\s*:)", '$1"$2"$3')
    return F.regexp_replace(quoted, r"(?U),(\s*[}\]])", "$1")


def validate_label(c: Column | str) -> Column:
    """The stripped text if it is a label; its repaired form if only that parses and is a label;
    else null. A text that parses but lacks a key is not repaired."""

    def check(s):
        repaired = let(repair_json(s), lambda r: F.when((r != s) & is_label(r), r))
        return let(
            strict_variant(s), lambda v: F.when(v.isNull(), repaired).when(has_label_keys(v), s)
        )

    return let(strip(c), check)


def extract_fenced_json(c: Column | str) -> Column:
    """First fenced block whose text validates. The block's own text is returned even where only
    its repaired form validates."""

    def search(s):
        out = F.lit(None).cast("string")
        for pattern in reversed(FENCED_PATTERNS):
            found = let(
                non_empty(strip(F.regexp_extract(s, pattern, 1))),
                lambda b: F.when(validate_label(b).isNotNull(), b),
            )
            out = F.coalesce(found, out)
        return F.when(F.contains(s, F.lit("```")), out)

    return let(strip(c), search)


def extract_balanced_json(c: Column | str) -> Column:
    """From the first line that starts with ``{``, whole lines until the braces balance, validated
    once. Braces inside strings count. Validates the whole text when they never balance."""

    def brace_delta(line):
        without = {b: F.length(F.replace(line, F.lit(b), F.lit(""))) for b in "{}"}
        return without["}"] - without["{"]

    def step(acc, line):
        i = acc["i"] + 1
        opens = acc["first"].isNull() & strip(line).startswith("{")
        first = F.when(opens, i).otherwise(acc["first"])
        depth = F.when(first.isNotNull(), acc["depth"] + brace_delta(line)).otherwise(acc["depth"])
        return F.when(acc["last"].isNotNull(), acc).otherwise(
            let(
                depth,
                lambda d: F.struct(
                    i.alias("i"),
                    first.alias("first"),
                    d.alias("depth"),
                    F.when(first.isNotNull() & (d == 0), i).alias("last"),
                ),
            )
        )

    def search(t):
        none = F.lit(None).cast("int")
        start = F.struct(
            F.lit(0).alias("i"), none.alias("first"), F.lit(0).alias("depth"), none.alias("last")
        )

        def pick(lines):
            return let(
                F.aggregate(lines, start, step),
                lambda a: F.when(
                    a["last"].isNotNull(),
                    validate_label(F.array_join(F.slice(lines, a["first"], a["last"] - a["first"] + 1), "\n")),
                ).when(a["first"].isNotNull(), validate_label(t)),
            )

        return F.when(F.contains(t, F.lit("{")), let(F.split(t, "\n", -1), pick))

    return let(strip(c), search)


def resolve_label(c: Column | str) -> Column:
    """``struct(label, method)`` of the first candidate that is strictly a label: the fenced block,
    else the balanced object (method ``balanced``, or ``repaired`` when repair made it valid), then
    the outer-brace slice. Null when none is."""

    def cascade(s):
        fenced, balanced = extract_fenced_json(s), extract_balanced_json(s)

        def pick(text, method):
            return F.struct(text.alias("label"), method.alias("method"))

        def from_balanced(b):
            return F.when(is_label(b), pick(b, F.when(F.contains(s, b), "balanced").otherwise("repaired")))

        def from_slice(b):
            return F.when(is_label(b), pick(b, F.lit("slice")))

        first = let(
            fenced,
            lambda f: F.when(f.isNull(), let(balanced, from_balanced)).when(is_label(f), pick(f, F.lit("fenced"))),
        )
        return F.coalesce(first, let(brace_slice(s), from_slice))

    return let(strip(c), cascade)


def _pretty(text: str | None) -> str | None:
    try:
        return json.dumps(json.loads(text), indent=2, ensure_ascii=False)
    except (ValueError, TypeError):
        return text


@F.pandas_udf(StringType())
def pretty_json(texts: pd.Series) -> pd.Series:
    """Two-space indented JSON with key order and non-ASCII kept; unparsable text as it is.

    Spark has no writer with this exact layout. Used only where a final text is rendered.
    """
    return texts.map(_pretty, na_action="ignore")
