"""Tokens of Swift sources with their nesting, many sources at once.

A small state machine reads what stands between stretches of plain code. Strings, with code inside their interpolations, and
attributes with arguments are frames on a stack, block comments are counted, so all of them nest to any depth. A ``/`` begins
a regex literal where no operand stands before it. The tokens of all plain stretches are found together, by array operations
over the characters of all sources; equal tokens share one number, and what depends on the text of a token is found once for
each number. Brackets and generic arguments are matched by stacks over the tokens, and statements are
numbered by sums over arrays. What a token means is left to the caller (``operators/symbols.py``).

Defined cases: a string, an interpolation or an attribute's arguments that do not end are read as the single character or the
name that began them; a block comment that does not end takes the rest; a closing bracket without an opening one
leaves its level; an opening brace without a closing one reaches to the end.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex

# --- fixed values: the lexical shapes of the language -------------------------------------------

OPERATOR_CHARACTERS = "-+*/=<>!&|^~?%"
_NAME = r"(?:`[^`\n]++`|[\p{L}_$][\w$]*+)"
_PIECE = regex.compile(
    rf"(?:\s++|//[^\n]*+)*+(?:({_NAME}|[(){{}}\[\],:;]|->|\.\.[.<]|\d\w*+(?:\.\d\w*+)?+|(?:(?!//|/\*)[-+*=<>!&|^~?%])(?:(?!//|/\*)[-+*/=<>!&|^~?%])*+)|(\S))"
)
_SETTER = regex.compile(r"(?:(?:private|fileprivate|internal|public|open|package)\s*+\(\s*+set|unowned\s*+\(\s*+(?:safe|unsafe))\s*+\)")
_SETTER_HEADS = frozenset("private fileprivate internal public open package unowned".split())
_ATTRIBUTE = regex.compile(r"@[A-Za-z_][\w.]*+")
_QUOTE = regex.compile(r'(#*+)("""|")')
_DIRECTIVE = regex.compile(r"#\w++")
_REGEX = regex.compile(r"/(?![\s*/])(?:\\.|\[(?:\\.|[^\]\\\n])*+\]|[^/\\\n\[])++/")
_LONG_REGEX = regex.compile(r"(#++)/(?s:.)*?/\1")
_OPERATOR = regex.compile(r"(?:(?!//|/\*)[-+*/=<>!&|^~?%])++")
_COMMENT = re.compile(r"/\*|\*/")
# Code without strings, attributes, slashes and quoted names, up to the next of them.
_PLAIN = re.compile(r"""(?:[^"#@/`]++|//[^\n]*+)++""")
#: What stands right before a slash may be one operator with it.
_BEFORE_SLASH = OPERATOR_CHARACTERS + "."
_SETTERS = r"(?:private|fileprivate|internal|public|open|package)\s*+\(\s*+set\s*+\)|unowned\s*+\(\s*+(?:safe|unsafe)\s*+\)"
_TOKENS = regex.compile(
    rf"((?:\s++|//[^\n]*+)*+)({_SETTERS}|[\p{{L}}_$][\w$]*+|->|\.\.[.<]|\d\w*+(?:\.\d\w*+)?+|(?:(?!//|/\*)[-+*=<>!&|^~?%])++|\S|)"
)
#: The words of such a token between its parentheses, and the words before them.
_SETTER_WORDS = {"set": _SETTER_HEADS - {"unowned"}, "safe": {"unowned"}, "unsafe": {"unowned"}}
#: In place of a gap: this is a stretch of plain code.
_STRETCH = -1

KEYWORDS = (
    "associatedtype class deinit enum extension fileprivate func import init inout internal let operator "
    "private precedencegroup protocol public rethrows static struct subscript typealias var break case catch "
    "continue default defer do else fallthrough for guard if in repeat return throw switch where while Any as "
    "await false is nil super throws true try _"
).split()
MODIFIERS = (
    "public private fileprivate internal open package static final override lazy weak unowned mutating "
    "nonmutating dynamic optional required convenience indirect nonisolated"
).split()
TYPES = ["class", "struct"]
BINDINGS = ["var", "let"]
# Keywords that are values, so that a slash after them divides.
VALUES = "self super true false nil Any _".split()
# Words that begin an argument list of types though they are keywords, and those that may stand in one.
GENERIC_HEADS = ["init", "subscript"]
IN_GENERICS = "Any inout throws rethrows class where _".split()

# What a token can be, beyond its own text. The name of a class is the key, its members the value.
CLASSES = {
    "keyword": KEYWORDS,
    "type": TYPES,
    "binding": BINDINGS,
    # A class keyword before one of these is a modifier of a member.
    "member_start": ["func", "var", "let", "subscript", "init", *MODIFIERS],
    # A type keyword after one of these is no declaration.
    "no_type_after": [".", ":", ","],
    # A binding after one of these is a condition or a pattern, not a declaration.
    "pattern_before": ["if", "guard", "while", "case", "for", "catch", "(", ",", "."],
    # A name after one of these is introduced, not used.
    "introduces": "let var func class struct enum protocol extension typealias import for".split(),
    # Statements whose brace opens their own block, not a trailing closure.
    "block_head": (
        "if guard while for switch repeat do catch else defer func class struct enum extension protocol actor "
        "init deinit subscript get set didSet willSet"
    ).split(),
    "accessor": ["get", "set", "didSet", "willSet"],
    "accessor_next": ["get", "set", "didSet", "willSet", "{", "}"],
    "observer": ["didSet", "willSet"],
    # A line that starts or ends with one of these goes on.
    "goes_on_start": "{ . , ) ] -> : where throws rethrows async else in as is".split(),
    "goes_on_end": [",", ".", "(", "[", "->", ":", "where", *MODIFIERS],
    # After a closing brace these continue the statement.
    "follows_brace": [".", ")", "]", "(", ",", ":"],
    "ends_statement": [";", "}"],
    "starts_statement": ["{", ";"],
    "cast": ["as", "is"],
    "mark": ["?", "!"],
    # Operators that may end a type and so a line.
    "type_end": ["?", "!", ">", ">?", ">!"],
    "label_before": ["(", ",", "}"],
    **{name: [text] for name, text in {
        "func": "func", "as": "as", "in": "in", "for": "for", "case": "case", "self": "self", "underscore": "_",
        "open": "{", "close": "}", "paren": "(", "dot": ".", "comma": ",", "colon": ":", "equals": "=",
    }.items()},
}
BITS = {name: 1 << i for i, name in enumerate([*CLASSES, "name", "operator", "attribute"])}
# The token before the first and after the last one.
EDGE = BITS["starts_statement"]


def _lexicon() -> dict[str, int]:
    out: dict[str, int] = {}
    for name, members in CLASSES.items():
        for token in members:
            word = re.fullmatch(r"[A-Za-z_]\w*", token)
            operator = token != "->" and not token.strip(OPERATOR_CHARACTERS)
            base = BITS["name"] if word else BITS["operator"] if operator else 0
            out[token] = out.get(token, base) | BITS[name]
    return out


LEXICON = _lexicon()


def class_of(token: str) -> int:
    """The classes of a token, as bits."""
    known = LEXICON.get(token)
    if known is not None:
        return known
    first = token[0]
    if first.isalpha() or first in "_$`":
        return 0 if token[-1] == ")" else BITS["name"]  # private(set) is no name
    if first in OPERATOR_CHARACTERS:
        return BITS["operator"] if token != "->" and not token.strip(OPERATOR_CHARACTERS) and (token[-1] != "/" or len(token) < 3) else 0
    return BITS["attribute"] if first == "@" else 0


_stops: dict[tuple[str, str], regex.Pattern] = {}


def _stops_of(hashes: str, quote: str) -> regex.Pattern:
    """What ends a stretch of a string's text: its end, an interpolation, an escape, or a line end."""
    if (hashes, quote) not in _stops:
        escape = rf"\\{hashes}"
        line = "" if len(quote) == 3 else r"|(?P<line>\n)"
        _stops[hashes, quote] = regex.compile(rf"(?P<close>{quote}{hashes})|(?P<code>{escape}\()|(?P<escape>{escape}(?s:.)){line}")
    return _stops[hashes, quote]


def _last_token(code: str, at: int, end: int) -> str:
    """The last token of the plain code from ``at`` to ``end``, or its last character if that tells as much; empty if there is none."""
    while at < end:
        low = max(code.rfind("\n", at, end) + 1, at)
        if code[end - 1] in "()[]{},:;" and code.find("//", low, end) < 0:
            return code[end - 1]
        found = [token for _, token in _TOKENS.findall(code, low, end) if token]
        if found:
            return found[-1]
        end = low - 1
    return ""


def _divides(code: str, out: list[tuple[int, int, int]]) -> bool:
    """Whether a slash after these pieces is an operator, as an operand stands before it."""
    for gap, start, end in reversed(out):
        token = code[start:end] if gap != _STRETCH else _last_token(code, start, end)
        if token in KEYWORDS:
            return token in VALUES
        if token:
            return token[0] not in OPERATOR_CHARACTERS + "([{,:;" or token in ("?", "!")
    return False


def _plain(code: str, at: int, gap: int, out: list[tuple[int, int, int]]) -> tuple[int, int]:
    """Add the stretch of plain code from ``at`` on; where it ends, and where the gap after the last piece begins."""
    found = _PLAIN.match(code, at)
    if not found:
        return at, gap
    end = found.end()
    if code.startswith("/", end):
        while end > at and code[end - 1] in _BEFORE_SLASH:
            end -= 1
    elif end == len(code) and "//" in code[at:].rstrip().rpartition("\n")[2]:  # comments at the very end are left to the caller
        for blanks, token in reversed(_TOKENS.findall(code, at, end)):
            if token:
                break
            end -= len(blanks)
    if end > at:
        out.append((_STRETCH, at, end))
    return end, gap


def _scan(code: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(where the gap before it begins, start, end) of each token that is not in a plain stretch and of each such stretch, and
    the runs of pieces that stand in interpolations. The code inside a string's interpolations follows the string, which
    itself is one token. The gap of a stretch is ``_STRETCH``, that of a piece outside of all frames says nothing."""
    out: list[tuple[int, int, int]] = []
    inside: list[tuple[int, int]] = []
    frames: list[tuple] = []  # (kind, start, start of the gap, tokens around, open parentheses around, stops of a string)
    broken: set[int] = set()  # where a frame began that does not end
    at = gap = parens = 0
    while True:
        if not frames:
            at, gap = _plain(code, at, gap, out)
            # what most often stands between plain stretches, read as below
            first = code[at : at + 1]
            found = None
            if first == "/":
                if code.startswith("*", at + 1):
                    at = _comment_end(code, at)
                    continue
                if not code.startswith("/", at + 1):
                    found = (None if _divides(code, out) else _REGEX.match(code, at)) or _OPERATOR.match(code, at)
            elif first == "@":
                found = _ATTRIBUTE.match(code, at)
                if found and code.startswith("(", found.end()):
                    found = None
            if found:
                out.append((gap, at, found.end()))
                at = gap = found.end()
                continue
        for piece in _PIECE.finditer(code, at):  # pieces follow each other without holes
            token = piece[1]
            if token is None:
                break
            start, at = piece.span(1)
            if frames and token in "()":
                if token == "(":
                    parens += 1
                elif parens:
                    parens -= 1
                else:
                    break
            elif token in _SETTER_HEADS and (setter := _SETTER.match(code, start)):
                at = setter.end()
                out.append((gap, start, at))
                gap = at
                break
            out.append((gap, start, at))
            gap = at
            if not frames:
                break
        else:
            if not frames:
                return out, inside
            # the innermost frame does not end: read it as what began it
            kind, begun, before, out, parens, _ = frames.pop()
            broken.add(begun)
            at, gap = begun, before
            if kind == "string":
                out.append((before, begun, begun + 1))
                at = gap = begun + 1
            continue
        if token == ")" and frames and gap != at:
            kind, begun, before, around, outer, stops = frames[-1]
            if kind == "attribute":
                frames.pop()
                out, parens = around, outer
                out.append((before, begun, at))
                gap = at
                continue
        elif token is not None:
            continue
        else:
            start = piece.start(2)
            first = code[start]
            found = quote = None
            if first == "/":
                if code.startswith("/*", start):
                    at = _comment_end(code, start)
                    continue  # the gap goes on
                found = (None if _divides(code, out) else _REGEX.match(code, start)) or _OPERATOR.match(code, start)
            elif first == "@":
                found = _ATTRIBUTE.match(code, start)
                if found and start not in broken and code.startswith("(", found.end()):
                    frames.append(("attribute", start, gap, out, parens, None))
                    out, parens, at = [], 0, found.end() + 1
                    gap = at
                    continue
            elif first in '"#':
                quote = None if start in broken else _QUOTE.match(code, start)
                if not quote and first == "#":
                    found = _LONG_REGEX.match(code, start) or _DIRECTIVE.match(code, start)
            if not quote:
                at = found.end() if found else start + 1
                out.append((gap, start, at))
                gap = at
                continue
            frames.append(("string", start, gap, out, parens, _stops_of(*quote.groups())))
            out, at = [], quote.end()
        # within a string, up to its end or the next interpolation
        _, begun, before, around, outer, stops = frames[-1]
        found = stops.search(code, at)
        while found and found.lastgroup == "escape":
            found = stops.search(code, found.end())
        if found and found.lastgroup == "code":
            at = gap = found.end()
            parens = 0
            continue
        frames.pop()
        inner, out, parens = out, around, outer
        if found and found.lastgroup == "close":
            at = found.end()
            out.append((before, begun, at))
            if inner and not frames:
                inside.append((len(out), len(out) + len(inner)))
            out += inner
        else:
            broken.add(begun)
            at = begun + 1
            out.append((before, begun, at))
        gap = at


def _comment_end(code: str, start: int) -> int:
    """Where the block comment that begins at ``start`` ends, with those inside it."""
    depth, at = 1, start + 2
    while depth:
        mark = _COMMENT.search(code, at)
        if mark is None:
            return len(code)
        depth += 1 if mark[0] == "/*" else -1
        at = mark.end()
    return at


# --- all tokens of many sources at once ----------------------------------------------------------

#: What a character of plain code is: a blank, the begin of a name, a part of names only, a digit, ``$``, a part of operators, a
#: token by itself; not yet asked for.
_BLANK, _LETTER, _PART, _DIGIT, _DOLLAR, _OPERATES, _SINGLE, _UNKNOWN = *range(7), 255
_kinds = np.full(0x110000, _UNKNOWN, np.uint8)
#: The runs that characters make: none, words, operators; one of its own each.
_RUNS = np.array([0, 1, 1, 1, 1, 2, 3], np.uint8)


def _kind_of(character: str) -> int:
    if regex.match(r"\s", character):
        return _BLANK
    if character in OPERATOR_CHARACTERS:
        return _OPERATES
    if character == "$":
        return _DOLLAR
    if regex.match(r"[\p{L}_]", character):
        return _LETTER
    return _DIGIT if regex.match(r"\d", character) else _PART if regex.match(r"\w", character) else _SINGLE


def _kinds_of(characters: np.ndarray) -> np.ndarray:
    kinds = _kinds[characters]
    if (new := kinds == _UNKNOWN).any():
        for c in np.unique(characters[new]).tolist():
            _kinds[c] = _kind_of(chr(c))
        kinds = _kinds[characters]
    return kinds


def _within(size: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether each of ``size`` places is in one of these intervals, which do not overlap."""
    steps = np.zeros(size + 1, np.int8)
    steps[low] += 1
    steps[high] -= 1
    return np.cumsum(steps[:-1], dtype=np.int8).view(bool)


def _plain_tokens(chars: np.ndarray, lines: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the tokens of the stretches of plain code begin and end, and whether each character is in one of them; lines end
    at ``lines``."""
    n = len(chars)
    plain = _within(n, low, high)
    kinds = np.where(plain, _kinds_of(chars), _BLANK).astype(np.uint8)
    slashes = np.flatnonzero(plain & (chars == ord("/")))
    if len(slashes):  # in plain code they stand in line comments only, which the first of a line begins
        ends = np.append(lines, n)[np.searchsorted(lines, slashes)]
        head = np.append(True, ends[1:] != ends[:-1])
        kinds[_within(n, slashes[head], ends[head])] = _BLANK
    runs = np.concatenate([[0], _RUNS[kinds], [0, 0, 0]]).astype(np.uint8)
    kinds = np.concatenate([kinds, np.zeros(3, np.uint8)])
    here, own = runs[1 : n + 1], runs[1 : n + 1] == 3
    begins = np.append((here != 0) & (own | (here != runs[:n])), [False] * 3)
    ends = np.append((here != 0) & (own | (here != runs[2 : n + 2])), [False] * 3)

    # ranges: two dots and a third or a less-than
    dot = np.append((chars == ord(".")) & (here == 3), [False] * 2)
    third = dot[2:] | np.append((chars[2:] == ord("<")) & (here[2:] == 2), [False] * min(n, 2)) if n > 2 else dot[2:]
    at = 0
    for p in np.flatnonzero(dot[:n] & dot[1 : n + 1] & third).tolist():
        if p >= at:
            at = p + 3
            begins[p + 1 : at], ends[p : at - 1], ends[at - 1] = False, False, True
            begins[at] |= runs[at + 1] != 0
    # arrows with more of an operator behind them
    found = np.flatnonzero(begins[:n] & (here == 2) & (chars == ord("-")))
    for p in found[(runs[found + 3] == 2) & ~ends[found] & ~ends[found + 1] & (chars[np.minimum(found + 1, n - 1)] == ord(">"))].tolist():
        stop = p + int(np.argmax(ends[p:])) + 1
        while p + 2 < stop and chars[p] == ord("-") and chars[p + 1] == ord(">"):
            ends[p + 1], begins[p + 2] = True, True
            p += 2
    # words that begin with what may not begin a name, and numbers up to a dollar
    found = np.flatnonzero(begins & ((kinds == _PART) | (kinds == _DIGIT)))
    odd = found[kinds[found] == _PART].tolist()
    if len(dollars := np.flatnonzero(kinds == _DOLLAR)) and len(found):
        starts = np.flatnonzero(begins)
        of = starts[np.searchsorted(starts, dollars, "right") - 1]
        odd = sorted({*odd, *of[kinds[of] == _DIGIT].tolist()})
    for p in odd:
        stop = p + int(np.argmax(ends[p:])) + 1
        while p < stop and kinds[p] in (_PART, _DIGIT):
            q = p + 1
            while kinds[p] == _DIGIT and q < stop and kinds[q] != _DOLLAR:
                q += 1
            ends[q - 1] = True
            if q < stop:
                begins[q] = True
            p = q
    # fractions
    points = np.flatnonzero(dot[:n] & (kinds[1 : n + 1] == _DIGIT) & (np.append(0, here[:-1]) == 1))
    if len(points):
        starts = np.flatnonzero(begins)
        taken = -1
        for p, start in zip(points.tolist(), starts[np.searchsorted(starts, points) - 1].tolist(), strict=True):
            if kinds[start] == _DIGIT and start != taken:
                taken = p + 1
                ends[p - 1] = begins[p] = ends[p] = begins[p + 1] = False
    return np.flatnonzero(begins[:n]), np.flatnonzero(ends[:n]) + 1, here != 0


def _texts(chars: np.ndarray, inside: np.ndarray, sizes: np.ndarray) -> pa.StringArray:
    """The characters that are ``inside``, as texts of these sizes."""
    kept, edges = chars[inside], np.concatenate([[0], np.cumsum(sizes)])
    if kept.dtype == np.uint8:
        data = kept.tobytes()
    else:
        data = kept.tobytes().decode("utf-32-le").encode()
        width = 1 + (kept > 0x7F).astype(np.int8) + (kept > 0x7FF) + (kept > 0xFFFF)
        edges = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[edges]
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data))


class Pieces(NamedTuple):
    """The tokens of sources, which stand one after the other in ``text``: where each one's gap begins, where it begins and
    ends, whether it stands in a string's interpolation, and the number of its text among ``words``. Those of a source are
    from ``first`` of it up to ``first`` of the next one. ``lines`` is where the line ends are."""

    text: str
    lines: np.ndarray
    gap: np.ndarray
    start: np.ndarray
    end: np.ndarray
    inner: np.ndarray
    word: np.ndarray
    words: list[str]
    first: np.ndarray


def _setters(text: str, start: np.ndarray, end: np.ndarray, stretch: np.ndarray, word: np.ndarray, words: list[str]) -> list[int]:
    """The tokens that begin ``private(set)`` and the like, which are four tokens here and one by right."""
    known = {w: i for i, w in enumerate(words)}
    found = []
    for middle, heads in _SETTER_WORDS.items():
        if middle in known and "(" in known and ")" in known:
            at = np.flatnonzero(word[2:-1] == known[middle])
            at = at[(word[at + 1] == known["("]) & (word[at + 3] == known[")"]) & (stretch[at] == stretch[at + 3])]
            found += [k for k in at.tolist() if words[word[k]] in heads and not any(text[end[j] : start[j + 1]].strip() for j in range(k, k + 3))]
    return sorted(found)


def pieces(codes: list[str]) -> Pieces:
    """The tokens of sources."""
    text = "\n".join(codes)  # a source ends as a line does
    bases = np.cumsum([0, *[len(c) + 1 for c in codes]], dtype=np.int64)
    marks: list[tuple[int, int, int]] = []
    counts, runs = [], []
    for code in codes:
        found, inside = _scan(code)
        runs += [(low + len(marks), high + len(marks)) for low, high in inside]
        marks += found
        counts.append(len(found))
    at = np.fromiter(chain.from_iterable(marks), np.int64, 3 * len(marks)).reshape(-1, 3)
    inner = np.zeros(len(at), bool)
    for low, high in runs:
        inner[low:high] = True
    base, is_stretch = np.repeat(bases[:-1], counts), at[:, 0] == _STRETCH
    gap, low, high = at[:, 0] + base, at[:, 1] + base, at[:, 2] + base

    chars = np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), np.uint32)
    lines = np.flatnonzero(chars == ord("\n"))
    start, end, inside = _plain_tokens(chars, lines, low[is_stretch], high[is_stretch])
    alone = ~is_stretch
    others = [text[a:b] for a, b in zip(low[alone].tolist(), high[alone].tolist(), strict=True)]
    coded = pa.concat_arrays([_texts(chars, inside, end - start), pa.array(others, pa.large_string())]).dictionary_encode()
    word, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()

    setters = _setters(text, start, end, np.searchsorted(low[is_stretch], start, "right"), word[: len(start)], words)
    if setters:
        known = {w: i for i, w in enumerate(words)}
        for k in setters:
            whole = text[start[k] : end[k + 3]]
            end[k], word[k] = end[k + 3], known.setdefault(whole, len(known))
        words = list(known)
        kept = np.ones(len(start), bool)
        kept[(np.array(setters)[:, None] + [1, 2, 3]).ravel()] = False
        word = np.concatenate([word[: len(start)][kept], word[len(start) :]])
        start, end = start[kept], end[kept]

    # the pieces of a source stand in order of their begin, also those within a string
    where = np.searchsorted(start, low[alone])
    word = np.insert(word[: len(start)], where, word[len(start) :])
    inner = np.insert(np.zeros(len(start), bool), where, inner[alone])
    gap = np.insert(np.zeros(len(start), np.int64), where, gap[alone])
    start, end = np.insert(start, where, low[alone]), np.insert(end, where, high[alone])
    first = np.searchsorted(start, bases)
    outside = np.flatnonzero(~inner)
    gap[outside] = np.concatenate([[0], end[outside][:-1]])[: len(outside)]
    heads = first[:-1][first[:-1] < first[1:]]
    gap[heads] = bases[:-1][first[:-1] < first[1:]]
    return Pieces(text, lines, gap, start, end, inner, word, words, first)


def lex(code: str) -> tuple[list[tuple[str, str]], list[tuple[int, int]]]:
    """(blanks and comments before it, token) of each token of a source, and the runs of them that stand in interpolations."""
    p = pieces([code])
    tokens = [(code[g:a], code[a:b]) for g, a, b in zip(p.gap.tolist(), p.start.tolist(), p.end.tolist(), strict=True)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], p.inner, [0]]).astype(np.int8))).tolist()
    return tokens, list(zip(edges[::2], edges[1::2], strict=True))


#: What a token is to a list of types: it ends there, goes on, or (from here on) is so many closing brackets.
_ENDS, _GOES_ON, _CLOSES = range(3)
_IN_TYPES = frozenset([".", ",", ":", "&", "?", "!", "->", "...", "==", "[", "]", "(", ")"])
#: Tokens that open or close a level, and the one that may begin a list of types, in the lowest bits of a shape; then whether a
#: list of types may begin behind a token, whether one may end before it, what it is to a list, and its classes.
_SHAPES = {"(": 2, "[": 2, ")": 0, "]": 0, "<": 5}
_HEAD, _AFTER, _ROLE, _CLASSES, _MANY = 3, 4, 8, 16, 255


@functools.lru_cache(1 << 12)
def _shape_of(token: str) -> int:
    cls = class_of(token)
    name, keyword = cls & BITS["name"], cls & BITS["keyword"]
    head = bool(name and (not keyword or token in GENERIC_HEADS))
    after = token[0] in "()[]{}.,;:=>?!&-" or token in ("where", "in", "else")
    if token[0] == ">" and not token.strip(">?!"):
        role = min(_CLOSES + len(token) - len(token.lstrip(">")), _MANY)
    else:
        role = _GOES_ON if (name and (not keyword or token in IN_GENERICS)) or token in _IN_TYPES or token[0] == "@" else _ENDS
    return cls << _CLASSES | role << _ROLE | after << _AFTER | head << _HEAD | _SHAPES.get(token, 1)


_KNOWN_SHAPES = {token: _shape_of(token) for token in LEXICON}
_NAME_SHAPE = _shape_of("name")


def _shapes_of(tokens: list[str]) -> np.ndarray:
    """What there is to know of each token; names that are not in the lexicon are all alike."""
    known = _KNOWN_SHAPES.get
    return np.array([known(t) or (_NAME_SHAPE if t[0].isalpha() and t[-1] != ")" else _shape_of(t)) for t in tokens], np.int64)


def _partners(opens: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For opening and closing brackets in order, which closing one belongs to each opening one, within their groups; -1 for none."""
    level = np.cumsum(np.where(opens, 1, -1)) + ~opens
    order = np.lexsort([level, group])
    pairs = opens[order][:-1] & ~opens[order][1:] & (level[order][1:] == level[order][:-1]) & (group[order][1:] == group[order][:-1])
    out = np.full(len(opens), -1)
    out[order[:-1][pairs]] = order[1:][pairs]
    return out


def generic_depth(p: Pieces, both: np.ndarray, adjacent: np.ndarray, new_line: np.ndarray) -> np.ndarray:
    """How many argument lists of types each token stands in, the angle brackets included.

    A ``<`` right after a name opens one, if only what types are made of follows up to its ``>``, and what stands
    behind that cannot go on an expression with an operand."""
    n = len(p.word)
    heads = np.zeros(n + 1, bool)
    heads[p.first] = True
    starts = np.flatnonzero((both & 4 != 0) & adjacent & ~heads[:-1])
    starts = starts[both[starts - 1] >> _HEAD & 1 != 0]
    if not len(starts):
        return np.zeros(n, np.int64)
    roles = both >> _ROLE & 255
    roles[starts] = _GOES_ON
    closes = np.flatnonzero(roles > _CLOSES)
    counts = roles[closes] - _CLOSES
    for k in np.flatnonzero(roles[closes] == _MANY).tolist():
        counts[k] = len(p.words[p.word[closes[k]]].rstrip("?!"))
    part = np.cumsum((roles == _ENDS) | heads[:-1])
    at = np.concatenate([starts, np.repeat(closes, counts)])
    opens = np.arange(len(at)) < len(starts)
    order = np.argsort(at, kind="stable")
    at, opens = at[order], opens[order]
    partner = _partners(opens, part[at])
    low = np.flatnonzero(partner >= 0)
    opened, behind = at[low], at[partner[low]] + 1
    ends = heads.copy()
    ends[:-1] |= new_line | (both >> _AFTER & 1 != 0)
    opened, behind = opened[ends[behind]], behind[ends[behind]]
    return np.cumsum(np.bincount(opened, minlength=n + 1) - np.bincount(behind, minlength=n + 1))[:-1]


def is_any(cls: np.ndarray, *names: str) -> np.ndarray:
    """Whether a token's classes are any of the named ones."""
    return (cls & sum(BITS[x] for x in set(names))) != 0


def _braces(is_open: np.ndarray, is_close: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The innermost open brace of each token, -1 for none, and where each one closes."""
    n = len(is_open)
    is_event = is_open | is_close
    events = np.flatnonzero(is_event)
    source, opens, k = np.searchsorted(first, events, "right") - 1, is_open[events], np.arange(len(events))
    partner = _partners(opens, source)
    close = np.zeros(n, np.int64)
    close[events] = np.where(partner >= 0, events[partner], first[source + 1]) if len(events) else 0  # without one: where the source ends
    # the brace around an opening one is the last one before it that opened the level below, if that is still open
    level = np.cumsum(np.where(opens, 1, -1))
    level -= level.min(initial=0)
    levels, size = int(level.max(initial=0)) + 2, len(events) + 1
    key = ((source * levels) + level) * size
    known = np.sort((key + k)[opens])
    found = np.searchsorted(known, key - size + k) - 1
    around = known[found] % size if len(known) else k
    same = opens & (found >= 0) & (level > 0)
    same[same] = known[found[same]] // size == key[same] // size - 1
    same[same] = (partner[around[same]] < 0) | (partner[around[same]] > k[same])
    around = np.where(same, around, -1)
    inside = np.where(opens, k, -1)
    closing = np.flatnonzero(partner >= 0)
    inside[partner[closing]] = around[closing]
    brace = np.append(events, -1)[np.append(-1, inside)][np.cumsum(is_event)]
    return np.where(brace >= np.repeat(first[:-1], np.diff(first)), brace, -1), close


def structure(codes: Iterable[str]) -> tuple[Pieces, dict[str, np.ndarray], dict[str, np.ndarray]]:
    """The tokens of sources, what is known of each of them, and the statements, as columns.

    Tokens: nl (starts a line), cls (classes as bits), depth (open braces, the token's own included), rel (open
    parentheses and brackets since the enclosing brace), angle (lists of types around it) and stmt. Statements: first and
    stop (tokens), decl (its declaring keyword), eq, colon (first ones at its level), last_in, open and close (its body) and
    within (the statement whose body holds it); -1 for none. Tokens and statements are counted over all sources.
    """
    p = pieces(list(codes))
    n, sizes = len(p.word), np.diff(p.first)
    both = _shapes_of(p.words)[p.word]
    cls, step = both >> _CLASSES, (both & 3) - 1
    adjacent = p.gap == p.start
    nl = np.zeros(n, bool)
    wide = np.flatnonzero(~adjacent)
    nl[wide] = np.searchsorted(p.lines, p.gap[wide]) < np.searchsorted(p.lines, p.start[wide])
    has = is_any
    is_open, is_close = has(cls, "open"), has(cls, "close")

    def own(values: np.ndarray) -> np.ndarray:
        """What running sums had before the source of each token."""
        return np.repeat(np.append(0, values)[p.first[:-1]], sizes)

    depth, p_depth = np.cumsum(is_open.astype(np.int64) - is_close), np.cumsum(step)
    angle = generic_depth(p, both, adjacent, nl)
    brace, close = _braces(is_open, is_close, p.first)
    rel = p_depth - np.where(brace >= 0, p_depth[brace], own(p_depth)) if n else p_depth
    depth = depth - own(depth)

    prev, following = np.append(EDGE, cls[:-1])[:n], np.append(cls[1:], 0)[:n]
    heads, lasts = p.first[:-1][sizes > 0], p.first[1:][sizes > 0] - 1
    prev[heads], following[lasts] = EDGE, 0
    line_break = nl & (rel == step) & (angle == 0) & ~has(cls, "goes_on_start", "operator") & ~has(prev, "goes_on_end", "attribute") & (~has(prev, "operator") | has(prev, "type_end"))
    after_block = has(prev, "close") & ~has(cls, "follows_brace", "operator")
    is_first = has(prev, "starts_statement") | has(cls, "ends_statement") | line_break | after_block
    first = np.flatnonzero(is_first)
    stmt = np.cumsum(is_first) - 1
    stop = np.append(first[1:], n)[: len(first)]

    is_type = has(cls, "type") & has(following, "name") & ~has(following, "member_start") & ~has(prev, "no_type_after")
    declares = is_type | (has(cls, "func") & ~has(prev, "dot")) | (has(cls, "binding") & ~has(prev, "pattern_before"))

    def least(where: np.ndarray) -> np.ndarray:
        at = np.append(np.flatnonzero(where), n)
        found = at[np.searchsorted(at, first)]
        return np.where(found < stop, found, -1)

    top = (rel == 0) & (angle == 0)
    decl = least(declares)
    last_in = np.full(len(first), -1)
    at_in = np.flatnonzero((rel == 0) & has(cls, "in"))
    last_in[stmt[at_in]] = at_in  # the last one stays
    opened = np.where(is_open[stop - 1], stop - 1, -1) if n else first
    outer = brace[np.where(decl >= 0, decl, first)] if n else first
    tokens = {"prev": prev, "following": following, "nl": nl, "cls": cls, "depth": depth, "rel": rel, "angle": angle, "stmt": stmt}
    statements = {
        "first": first, "stop": stop, "decl": decl, "eq": least(top & has(cls, "equals")), "colon": least(top & has(cls, "colon")),
        "last_in": last_in, "open": opened, "close": np.where(opened >= 0, close[opened], -1) if n else first, "within": np.where(outer >= 0, stmt[outer], -1) if n else first,
    }
    return p, tokens, statements
