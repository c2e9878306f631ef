"""Text column functions: stripping, slicing, fences and naming rules."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F

# Every character that counts as whitespace when a text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# File extension -> MIME type; everything else is text/plain.
MIME_TYPES = {".swift": "text/x-swift", ".json": "application/json"}

FENCE = "```"

# Fixed value: what the folder of a generator is called after its name.
GENERATOR_ENDING = "_generated"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def computed_once(struct: Column) -> Column:
    """The fields of a struct as columns, computed once per row. A filter on a plain derived column
    is pushed below it and computes it a second time; it cannot pass this generator."""
    return F.inline_outer(F.array(struct))


def strip(c: Column | str) -> Column:
    return F.btrim(as_col(c), F.lit(WHITESPACE))


def blank(c: Column | str) -> Column:
    """True for null, empty and whitespace-only texts."""
    return F.coalesce(strip(c) == "", F.lit(True))


def non_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip_fence(c: Column | str, lang: str = "swift") -> Column:
    """Drop an opening ```` ```lang ```` and a closing fence found exactly at the ends of the
    stripped response; null when nothing is left."""
    opening = FENCE + lang
    opened = let(
        strip(c), lambda s: F.when(s.startswith(opening), F.substring(s, len(opening) + 1, 2**31 - 1)).otherwise(s)
    )
    closed = let(
        opened,
        lambda s: F.when(s.endswith(FENCE), F.left(s, F.length(s) - len(FENCE))).otherwise(s),
    )
    return non_empty(strip(closed))


def brace_slice(c: Column | str) -> Column:
    """From the first ``{`` to the last ``}`` after it, else null."""
    return non_empty(F.regexp_extract(as_col(c), r"(?s)\{.*\}", 0))


def fill(template: str, slots: dict[str, Column]) -> Column:
    """Fill the ``{name}`` slots of a template in one pass; slot texts are never re-scanned."""
    parts = []
    for literal, slot, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if slot is not None:
            parts.append(slots[slot])
    return F.concat(*parts)


def base_name(path: Column | str) -> Column:
    return F.substring_index(as_col(path), "/", -1)


def split_ext(name: Column | str) -> Column:
    """``struct(stem, ext)``; leading dots belong to the stem, as in a dotfile name."""
    n = as_col(name)
    pattern = r"(?s)\A(\.*[^.].*?)(\.[^.]*)?\z"
    stem = F.regexp_extract(n, pattern, 1)
    return F.struct(
        F.when(stem == "", n).otherwise(stem).alias("stem"),
        F.regexp_extract(n, pattern, 2).alias("ext"),
    )


def safe_name(repo: Column | str) -> Column:
    return F.translate(as_col(repo), "/-", "__")


def artifact_name(repo: Column | str, path: Column | str, suffix: str) -> Column:
    """``<repo made safe>_<file stem>_<suffix>``."""
    return F.concat_ws("_", safe_name(repo), split_ext(base_name(path))["stem"], F.lit(suffix))


def module_name(repo: Column | str) -> Column:
    return F.substring_index(as_col(repo), "/", -1)


def snippet_name(library: Column | str, context: Column | str, ext: str = ".swift") -> Column:
    return F.concat(
        F.lower(as_col(library)), F.lit("_"), F.replace(F.lower(as_col(context)), F.lit(" "), F.lit("_")), F.lit(ext)
    )


def mime_type(name: Column | str) -> Column:
    ext = F.lower(split_ext(base_name(name))["ext"])
    out = F.lit("text/plain")
    for suffix, mime in MIME_TYPES.items():
        out = F.when(ext == suffix, mime).otherwise(out)
    return out
