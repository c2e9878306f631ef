"""Token ids of whole texts by a public tokenizer file, as little-endian unsigned 32-bit bytes.

A byte-level tokenizer cuts a text into pieces before it merges bytes, always before a space that a
character other than white space follows. So the text is cut at such spaces, each distinct part is encoded once with
the library's model, and its ids are kept in a bounded table of the worker; the ids of a text are those of its
parts in order. Texts with special strings, and all texts of other kinds of tokenizers, are encoded whole by the library.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
from functools import cache

import numpy as np
import regex

#: Distinct parts that a worker keeps; when there are more, it starts anew.
KEPT_PARTS = 600_000

# The pattern by which byte-level tokenizers of this kind cut a text, and the order of the bytes
# that they write as themselves (the others follow from 256 on).
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]


@cache
def file_digest(path: str) -> str:
    """Version of a tokenizer: digest of its file and of the library that reads it."""
    import tokenizers

    with open(path, "rb") as file:
        content = file.read()
    return hashlib.sha256(content + tokenizers.__version__.encode()).hexdigest()


def letters_of_bytes() -> dict[int, str]:
    other = [b for b in range(256) if b not in set(PLAIN_BYTES)]
    return {b: chr(b) for b in PLAIN_BYTES} | {b: chr(256 + i) for i, b in enumerate(other)}


class Parts(dict):
    """Ids of what follows a space: parts of texts, encoded when first asked for."""

    def __init__(self, tokenizer):
        super().__init__()
        self.model = tokenizer.model
        self.cut = regex.compile(CUT).findall
        self.letters = letters_of_bytes()
        self.pieces: dict[str, bytes] = {}

    def encode(self, piece: str) -> bytes:
        mapped = piece.encode().decode("latin-1").translate(self.letters)
        ids = [token.id for token in self.model.tokenize(mapped)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def piece(self, piece: str) -> bytes:
        """Ids of a piece that is no part by itself, such as a mark."""
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) >= KEPT_PARTS // 4:
                self.pieces.clear()
            ids = self.pieces[piece] = self.encode(piece)
        return ids

    def text(self, text: str) -> bytes:
        return b"".join(map(self.piece, self.cut(text)))

    def __missing__(self, part: str) -> bytes:
        if part.isalpha():
            ids = self.encode(" " + part)
        elif part[-1] in ".,;:!?" and part[:-1].isalpha():
            ids = self[part[:-1]] + self.piece(part[-1])
        else:
            ids = self.text(" " + part)
        if len(self) >= KEPT_PARTS:
            self.clear()
        self[part] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        before = parts.get("pre_tokenizer") or {}
        self.by_part = (
            parts.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and parts["model"].get("type") == "BPE"
        )
        self.special = [x["content"] for x in parts.get("added_tokens", [])]
        self.loose = re.compile(r" (?:\s|$)").search
        self.parts = Parts(self.tokenizer)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text, four bytes each."""
        if not self.by_part or any(x in text for x in self.special):
            return self.whole(text)
        if self.loose(text):
            return self.parts.text(text)
        first, *rest = text.split(" ")
        return self.parts.text(first) + b"".join(map(self.parts.__getitem__, rest))


@cache
def encoder(path: str) -> Encoder:
    """One per worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)
