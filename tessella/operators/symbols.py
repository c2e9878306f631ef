"""Symbol lists of Swift sources: a row-local job over a table of source texts.

A pack of sources becomes arrays of tokens and statements (``functions/lexer.py``), in which brackets, strings, comments and
lists of types nest to any depth. Which tokens use a name, what the declaring statements say and what their bodies use is
decided for all sources of a pack at once, by array operations. It leaves the task as one array of declarations for each
source, so no token passes between Python and Spark unless tokens are asked for. Names, kinds and lists of symbols are column
functions over these arrays. Nothing is shuffled or sorted between rows, so the job is as parallel as the table has rows; a
source is the largest unit of work.

Bodies are nested intervals of positions. The uses of a pack are one array in order of position, each use once; a body's
own ones are the run of that array between its two braces, found by two binary searches, and nested bodies are runs within
runs. The types around declarations are found by following each statement to the one whose body holds it, one step for all.

It is a lexical job, not a full parse; the README lists what it approximates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tessella.functions import lexer
from tessella.functions.lexer import is_any
from tessella.functions.text import WHITESPACE, blank, non_empty

_TOKEN = "pos int, tok string, gap string, inner boolean, nl boolean, cls bigint, depth int, rel int, angle int, stmt int"
TOKEN_FIELDS = tuple(f.split()[0] for f in _TOKEN.split(", "))
_LIST = "array<string>"
_DECLARATION = (
    f"kw int, kind string, names {_LIST}, attributes {_LIST}, signature string, conforms {_LIST}, "
    f"calls_out {_LIST}, references {_LIST}, scopes {_LIST}"
)
#: Characters of source after which what was read so far is passed on.
_PACK = 1 << 18
#: Pairs of a body and a use in it that are held at once.
_PAIRS = 1 << 21
_MARK = regex.compile(r"@[\w.]+")


def _types(fields: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), _LIST: pa.list_(pa.string())}
    return [(name, kinds[kind]) for name, kind in (f.split() for f in fields.split(", "))]


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, list[str]]]:
    """(keys, whether each has code, the codes there are) of as many sources as make a pack."""
    for batch in batches:
        low, size = 0, 0
        codes = batch.column(1).to_pylist()
        for i, code in enumerate(codes, 1):
            size += len(code or "")
            if size > _PACK or i == len(codes):
                pack = codes[low:i]
                yield batch.column(0).slice(low, i - low), np.array([c is not None for c in pack], bool), [c for c in pack if c is not None]
                low, size = i, 0


def _spread(has_code: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sizes of the sources that have code, and 0 for the others."""
    out = np.zeros(len(has_code), np.int64)
    out[has_code] = sizes
    return out


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def _read_by(sources: DataFrame, file: str, code: str, rows: Callable, fields: str) -> DataFrame:
    """What ``rows`` makes of (key, code); blank sources come without code."""
    texts = sources.select(F.col(file).alias("key"), F.when(~blank(code), F.col(code)).alias("code"))
    kind = texts.schema["key"].dataType.simpleString()
    return texts.mapInArrow(rows, f"key {kind}, {fields}").withColumnRenamed("key", file)


def tokens(sources: DataFrame, file: str = "file_id", code: str = "code", fields: tuple[str, ...] = TOKEN_FIELDS) -> DataFrame:
    """(file, pos, tok, gap, inner, nl, cls, depth, rel, angle, stmt), or the file and the named ones of these
    fields, one row per token."""
    wanted = ", ".join(f for f in _TOKEN.split(", ") if f.split()[0] in fields)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, has_code, codes in _packs(batches):
            p, t, _ = lexer.structure(codes)
            sizes = np.diff(p.first)
            heads = np.repeat(p.first[:-1], sizes)
            make = {
                "pos": lambda: np.arange(len(p.word)) - heads,
                "tok": lambda: pa.array(p.words, pa.string()).take(pa.array(p.word)),
                "gap": lambda: [p.text[g:s] for g, s in zip(p.gap.tolist(), p.start.tolist(), strict=True)],
                "inner": lambda: p.inner,
                "stmt": lambda: t["stmt"] - t["stmt"][heads],
            }
            own = keys.take(pa.array(np.repeat(np.arange(len(keys)), _spread(has_code, sizes))))
            columns = [(make[name]() if name in make else t[name], kind) for name, kind in _types(wanted)]
            columns = [c if isinstance(c, pa.Array) else pa.array(c, kind) for c, kind in columns]
            yield pa.RecordBatch.from_arrays([own, *columns], ["key", *[n for n, _ in _types(wanted)]])

    return _read_by(sources, file, code, rows, wanted)


def _uses(p: lexer.Pieces, tokens: dict, stmts: dict, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that use a name (it is no keyword, label, introduced name, type or binding), and whether
    parentheses or a trailing closure follow on its line, so that the used name is called."""
    cls, prev, following, rel = (tokens[c] for c in ("cls", "prev", "following", "rel"))
    first, decl, eq = stmts["first"], stmts["decl"], stmts["eq"]
    heads, lasts = p.first[:-1][np.diff(p.first) > 0], p.first[1:][np.diff(p.first) > 0] - 1
    is_var = kinds == _VAR
    head, before, after = cls[first], prev[first], following[first]

    # all that follows is asked of words only
    at = np.flatnonzero(is_any(cls, "name") & (~is_any(cls, "keyword") | is_any(prev, "dot")) & (tokens["angle"] == 0))
    two_before, two_behind = np.append(lexer.EDGE, prev[:-1])[: len(cls)], np.append(following[1:], 0)[: len(cls)]
    two_before[heads], two_behind[lasts] = lexer.EDGE, 0
    stmt, rel, cls, prev, following = tokens["stmt"][at], rel[at], cls[at], prev[at], following[at]

    def of(values: np.ndarray) -> np.ndarray:
        return values[stmt]

    label = is_any(following, "colon") & is_any(prev, "label_before")
    cast_type = is_any(prev, "cast") | (is_any(prev, "mark") & is_any(two_before[at], "as"))
    accessor = is_any(cls, "accessor") & is_any(following, "accessor_next") & is_any(prev, "accessor_next")
    declared = of((decl >= 0) & ~is_var) & (at >= of(decl))
    later_name = is_any(prev, "comma") & is_any(following, "equals", "colon") & (rel == 0)
    in_binding = of(is_var) & ((of(eq) < 0) | (at <= of(eq)) | later_name)
    bound_in = (at < of(stmts["last_in"])) & (of(is_any(head, "for")) | (of(is_any(before, "open")) & ~is_any(cls, "self")))
    bound_case = of(is_any(head, "case") & is_any(after, "binding")) & (rel > 0) & (at < of(stmts["colon"]))
    used = ~(label | is_any(prev, "introduces") | cast_type | accessor | declared | in_binding | bound_in | bound_case)
    block = (rel == 0) & of(is_any(head, "block_head") | (is_var & (eq < 0)))
    parens = is_any(following, "paren") & ~is_any(two_behind[at], "underscore")
    line_ends = np.append(tokens["nl"][1:], True)
    line_ends[lasts] = True
    called = ~line_ends[at] & (parens | (is_any(following, "open") & ~block))
    return at[used], called[used]


#: The kinds of declarations by number; no declaration has the last.
_KINDS = ("var", "func", *lexer.TYPES)
_VAR, _FUNC, _NO_KIND = 0, 1, -1


def _distinct_names(rank: np.ndarray, low: np.ndarray, high: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ranks, sorted, of each run from ``low`` to ``high``, and how many each one has; there are ``number`` ranks."""
    sizes = np.maximum(high - low, 0)
    found, counts, begin = [np.zeros(0, np.int64)], np.zeros(len(low), np.int64), 0
    total = np.cumsum(sizes)
    while begin < len(low):
        done = total[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(total, done + _PAIRS, "right")))
        own = sizes[begin:stop]
        run = np.repeat(np.arange(stop - begin), own)
        at = np.arange(len(run)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(low[begin:stop], own)
        keys = np.unique(run * number + rank[at])
        found.append(keys % number)
        counts[begin:stop] = np.bincount(keys // number, minlength=stop - begin)
        begin = stop
    return np.concatenate(found), counts


def _declared(codes: list[str]) -> tuple[pa.StructArray, np.ndarray]:
    """What the declaring statements of sources say, and how many each source has."""
    p, tokens, stmts = lexer.structure(codes)
    n, cls, word = len(p.word), tokens["cls"], p.word
    words = pa.array(p.words, pa.string())
    number = {w: i for i, w in enumerate(p.words)}

    def is_word(*texts: str) -> np.ndarray:
        own = np.zeros(len(p.words), bool)
        own[[number[w] for w in texts if w in number]] = True
        return own[word]

    # of each statement, and of the declaring ones
    decl = stmts["decl"]
    found = np.flatnonzero(decl >= 0)
    kind_of_word = np.full(len(p.words) + 1, _NO_KIND, np.int8)
    for w, kind in (*((b, _VAR) for b in lexer.BINDINGS), *((w, k) for k, w in enumerate(_KINDS) if k != _VAR)):
        if w in number:
            kind_of_word[number[w]] = kind
    kinds = np.where(decl >= 0, kind_of_word[word[decl]], _NO_KIND) if n else np.zeros(0, np.int8)
    at, kind, first, stop, opened, close, eq = decl[found], kinds[found], *(stmts[c][found] for c in ("first", "stop", "open", "close", "eq"))
    source = np.searchsorted(p.first, at, "right") - 1
    end_of_source = p.first[source + 1] if len(at) else at
    is_var, is_func, is_type = kind == _VAR, kind == _FUNC, kind > _FUNC

    # heads: what stands behind the keyword, without code in strings and the opening brace; top is outside of brackets
    decl_of = decl[tokens["stmt"]]
    in_head = (decl_of >= 0) & (np.arange(n) > decl_of) & ~p.inner & ~is_word("{")
    level = (tokens["rel"] == 0) & (tokens["angle"] == 0)
    top = in_head & level
    outside = np.maximum.accumulate(np.where(in_head, np.arange(n), -1))

    def next_of(where: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The first of these tokens of the statement behind ``after``, else -1."""
        places = np.append(np.flatnonzero(where), n + 1)
        got = places[np.searchsorted(places, after, "right")]
        return np.where(got < stop, got, -1)

    def last_before(limit: np.ndarray) -> np.ndarray:
        """The last token of the head before ``limit``, or before the end of the statement where there is none."""
        return outside[np.where(limit >= 0, limit, stop) - 1]

    # names
    follows = at + 1 < end_of_source
    single = np.flatnonzero(~is_var)
    parts = np.flatnonzero(top & (kinds == _VAR)[tokens["stmt"]] & ~is_word(")", "]"))
    part_of = tokens["stmt"][parts]
    begins = np.append(True, part_of[1:] != part_of[:-1])[: len(parts)]
    named = is_any(cls[parts], "name") & (begins | np.append(False, is_word(",")[parts[:-1]])[: len(parts)])
    owner = np.concatenate([np.searchsorted(found, part_of[named]), single])
    name_word = np.concatenate([word[parts[named]], np.where(follows[single], word[np.minimum(at[single] + 1, n - 1)], -1)])
    order = np.argsort(owner, kind="stable")
    names = words.take(pa.array(name_word[order], mask=name_word[order] < 0))
    name_counts = np.bincount(owner, minlength=len(at))

    # types of bindings, parameters of functions
    colons, where_ = is_word(":") & top, is_word("where") & top
    signature = [""] * len(at)
    colon, ends = next_of(colons, at), next_of(is_word("=", ",") & top, at)
    typed = np.flatnonzero(is_var & (colon >= 0) & ((ends < 0) | (ends > colon)))
    last = last_before(ends)
    typed = typed[last[typed] > colon[typed]]
    for j, a, b in zip(typed.tolist(), p.start[colon[typed] + 1].tolist(), p.end[last[typed]].tolist(), strict=True):
        signature[j] = p.text[a:b].strip(WHITESPACE)
    parens = next_of(is_word("(") & in_head & (tokens["angle"] == 0), at + 1)
    takes = np.flatnonzero(is_func & (parens >= 0))
    last = last_before(next_of(where_, np.maximum(parens, at)))
    for j, a, b in zip(takes.tolist(), p.start[parens[takes]].tolist(), p.end[last[takes]].tolist(), strict=True):
        signature[j] = p.text[a:b].rstrip(" ")

    # conformances: what stands between commas
    colon, where_ = next_of(colons, at + 1), next_of(where_, at + 1)
    last = last_before(where_)
    conforming = np.flatnonzero(is_type & (colon >= 0) & ((where_ < 0) | (where_ > colon)))
    conforming = conforming[last[conforming] > colon[conforming]]
    commas = np.flatnonzero(is_word(",") & top)
    low, high = np.searchsorted(commas, colon[conforming]), np.searchsorted(commas, last[conforming], "right")
    owner = np.repeat(conforming, high - low)
    inside = commas[np.arange(len(owner)) + np.repeat(low - np.cumsum(high - low) + (high - low), high - low)] if len(owner) else commas[:0]
    owner = np.concatenate([conforming, owner])
    begin = np.concatenate([colon[conforming], inside])
    order = np.lexsort([begin, owner])
    owner, begin = owner[order], begin[order]
    is_last = np.append(owner[1:] != owner[:-1], True)[: len(owner)]
    after = np.append(begin[1:], 0)[: len(begin)]
    texts = [p.text[a:b].strip(WHITESPACE) for a, b in zip(p.end[begin].tolist(), np.where(is_last, p.end[last[owner]], p.gap[after]).tolist(), strict=True)]
    full = np.array([t != "" for t in texts], bool)
    conforms = pa.array([t for t in texts if t], pa.string())
    conform_counts = np.bincount(owner[full], minlength=len(at))

    # attributes
    marks = np.flatnonzero(is_any(cls, "attribute") & (np.arange(n) < decl_of))
    of_mark = word[marks].tolist()
    short = {w: m[0] if (m := _MARK.match(p.words[w])) else "" for w in set(of_mark)}
    attributes = pa.array([short[w] for w in of_mark], pa.string())
    mark_counts = np.bincount(np.searchsorted(found, tokens["stmt"][marks]), minlength=len(at))

    # uses of bodies
    at_use, called = _uses(p, tokens, stmts, kinds)
    used, rank = np.unique(word[at_use], return_inverse=True)
    texts = [p.words[w] for w in used.tolist()]
    by_text = sorted(range(len(texts)), key=texts.__getitem__)
    place = np.empty(len(texts), np.int64)
    place[by_text] = np.arange(len(texts))
    rank, sorted_words = place[rank], pa.array([texts[i] for i in by_text], pa.string())
    inner_first = np.where((opened >= 0) & (opened + 1 < end_of_source), cls[np.minimum(opened + 1, n - 1)], 0) if n else at
    has_body = (opened >= 0) & (is_func | (is_var & ((eq < 0) | is_any(inner_first, "observer"))))

    def of_bodies(uses: np.ndarray, ranks: np.ndarray) -> pa.ListArray:
        low, high = np.searchsorted(uses, opened), np.searchsorted(uses, close)
        distinct, counts = _distinct_names(ranks, np.where(has_body, low, 0), np.where(has_body, high, 0), max(len(texts), 1))
        return _lists(sorted_words.take(pa.array(distinct)), counts)

    # the types around
    owners, types = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    j, around, step = np.arange(len(at)), stmts["within"][found], 0
    depth = tokens["depth"][at]
    while len(j):
        going = (around >= 0) & (step < depth[j])
        j, around = j[going], around[going]
        of_type = kinds[around] > _FUNC
        owners.append(j[of_type])
        types.append(word[decl[around[of_type]] + 1])
        around, step = stmts["within"][around], step + 1
    owner, scope = np.concatenate(owners)[::-1], np.concatenate(types)[::-1]
    order = np.argsort(owner, kind="stable")

    columns = {
        "kw": pa.array(at - p.first[source], pa.int32()),
        "kind": pa.array(_KINDS, pa.string()).take(pa.array(kind)),
        "names": _lists(names, name_counts),
        "attributes": _lists(attributes, mark_counts),
        "signature": pa.array(signature, pa.string()),
        "conforms": _lists(conforms, conform_counts),
        "calls_out": of_bodies(at_use[called], rank[called]),
        "references": of_bodies(at_use, rank),
        "scopes": _lists(words.take(pa.array(scope[order])), np.bincount(owner, minlength=len(at))),
    }
    fields = [pa.field(name, kind) for name, kind in _types(_DECLARATION)]
    return pa.StructArray.from_arrays([columns[f.name].cast(f.type) for f in fields], fields=fields), np.bincount(source, minlength=len(codes))


def _declared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, has_code, codes in _packs(batches):
        rows, counts = _declared(codes)
        edges = np.concatenate([[0], np.cumsum(_spread(has_code, counts))])
        found = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), rows, mask=pa.array(~has_code))
        yield pa.RecordBatch.from_arrays([keys, found], ["key", "decls"])


def described(sources: DataFrame, file: str = "file_id", code: str = "code") -> DataFrame:
    """(file, decls): the declarations of each source as an array in its order; null for blank sources."""
    struct = ", ".join(f"{name}: {kind}" for name, kind in (f.split() for f in _DECLARATION.split(", ")))
    return _read_by(sources, file, code, _declared_rows, f"decls array<struct<{struct}>>")


def declarations(sources: DataFrame, file: str = "file_id", code: str = "code") -> DataFrame:
    """One row per declaration, and one without ``kind`` per file that has code but declares nothing."""
    return described(sources, file, code).where("decls is not null").select(file, F.inline_outer("decls"))


def _symbols_of(decl: Column, mode: str) -> Column:
    """The symbols of a declaration, one for each name.

    ``compat``: names are never qualified and bindings are always variables. ``qualified``: names
    carry their enclosing types and bindings inside a type are properties.
    """
    scopes = decl["scopes"] if mode == "qualified" else F.array().cast("array<string>")
    prefix = F.array_join(F.transform(scopes, lambda n: F.concat(n, F.lit("."))), "")
    binding = F.when(F.size(scopes) > 0, "property").otherwise("variable")
    kind = F.when(decl["kind"] == "func", "method").when(decl["kind"] == "var", binding).otherwise(decl["kind"])
    ending = F.when(decl["kind"] == "func", F.concat(F.lit("("), decl["signature"], F.lit(")"))).otherwise("")

    def one(name: Column, at: Column) -> Column:
        return F.struct(
            decl["kw"].alias("pos"),
            at.alias("ord"),
            F.concat(prefix, name, ending).alias("symbolName"),
            kind.alias("symbolKind"),
            decl["signature"].alias("typeSignature"),
            decl["calls_out"].alias("calls_out"),
            decl["references"].alias("references"),
            decl["conforms"].alias("conforms"),
            decl["attributes"].alias("attributes"),
        )

    return F.transform(F.filter(decl["names"], lambda n: n.isNotNull()), one)


FIELDS = ("symbolName", "symbolKind", "typeSignature", "calls_out", "references", "conforms", "attributes")


def _listed(sources: DataFrame, file: str, code: str, mode: str) -> DataFrame:
    if mode not in ("compat", "qualified"):
        raise ValueError(f"unknown mode {mode!r}")
    found = F.flatten(F.transform("decls", lambda d: _symbols_of(d, mode)))
    return described(sources, file, code).select(file, found.alias("symbols"))


def symbols(sources: DataFrame, file: str = "file_id", code: str = "code", mode: str = "compat") -> DataFrame:
    """(file, pos, ord, symbolName, ...) in the order of the source: one row per declared name, and
    one row with null ``symbolName`` for a file that declares nothing."""
    return _listed(sources, file, code, mode).where("symbols is not null").select(file, F.inline_outer("symbols"))


def _of_kind(rows: DataFrame, *kinds: str) -> DataFrame:
    return rows.where(F.col("symbolKind").isin(*kinds))


def type_symbols(rows: DataFrame) -> DataFrame:
    return _of_kind(rows, *lexer.TYPES)


def func_symbols(rows: DataFrame) -> DataFrame:
    return _of_kind(rows, "method")


def var_symbols(rows: DataFrame) -> DataFrame:
    return _of_kind(rows, "variable", "property")


def sparse(symbol: Column) -> Column:
    """A symbol as a struct whose empty fields are null, which JSON encoding leaves out."""
    fields = [symbol["symbolName"].alias("symbolName"), symbol["symbolKind"].alias("symbolKind"), non_empty(symbol["typeSignature"]).alias("typeSignature")]
    fields += [F.when(F.size(symbol[c]) > 0, symbol[c]).alias(c) for c in FIELDS[3:]]
    return F.struct(*fields)


def _as_json(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def symbols_json(rows: DataFrame, file: str = "file_id") -> DataFrame:
    """(file, symbols_json) from rows of symbols: all of a file in source order; ``[]`` when there are none."""
    own = F.struct(*[F.col(c) for c in FIELDS])
    item = F.when(F.col("symbolName").isNotNull(), F.struct("pos", "ord", F.to_json(sparse(own)).alias("json")))
    return rows.groupBy(file).agg(F.sort_array(F.collect_list(item)).alias("items")).select(file, _as_json(F.col("items.json")).alias("symbols_json"))


def symbol_lists(sources: DataFrame, file: str = "file_id", code: str = "code", mode: str = "compat") -> DataFrame:
    """(file, symbols_json) from sources, without a shuffle; null for blank sources."""
    items = F.transform("symbols", lambda s: F.to_json(sparse(s)))
    return _listed(sources, file, code, mode).select(file, _as_json(items).alias("symbols_json"))


def symbols_or_null(sources: DataFrame, file: str = "file_id", code: str = "code", mode: str = "compat") -> DataFrame:
    """(file, symbols_json, reject) for every source; blank sources have no symbols and are
    rejected as ``no_symbols``, sources without declarations are kept."""
    return symbol_lists(sources, file, code, mode).withColumn("reject", F.when(F.col("symbols_json").isNull(), "no_symbols"))
