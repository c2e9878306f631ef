"""Scores and sequences against plain versions that go through one row at a time."""

import math

import numpy as np
import pytest
from helpers import documents, prose
from pyspark.sql import functions as F

from tessella.llm import features, language, packing, quality
from tessella.llm.tables import public_tokenizer

TOKENIZER = public_tokenizer("byte_bpe_50k.json")
ODD = [(1, None), (2, ""), (3, "!!! 123"), (4, "x " * 30_000), (4, "x " * 30_000), (None, "word"), (6, "Über  das\tWORT\x85né"), (7, "a")]


def sigmoid(x):
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def plain_language(text, model):
    text = (text or "").lower()
    if not any(c.isalpha() for c in text):
        return "und", 0.0
    data = [int(language._FOLD[b]) for b in text.encode()]
    found = []
    for size in language.RUNS:
        for start in range(len(data) - size + 1):
            run = data[start : start + size]
            if run[0] == run[-1] == 32:
                continue
            value = 0
            for byte in run:
                value = (value * 0x01000193 + byte) % 2**32
            value = ((value ^ (value >> 15)) * 0x9E3779B1 + (size * 0x7F4A7C15 & 0xFFFFFFFF)) % 2**32
            found.append(value >> (32 - language.BITS))
    margin = {name: float(sum(w[f] for f in found)) / max(len(found), 1) + b for name, w, b in zip(model.names, model.weights, model.bias, strict=True)}
    families, sure = list(model.families), 1.0
    top = families[0]
    if len(families) > 1:
        of = {name: min(max(margin["family", name, ""], -20), 20) for name in families}
        top = max(families, key=lambda name: margin["family", name, ""])
        sure = math.exp(2 * max(of.values())) / sum(math.exp(2 * m) for m in of.values())
    members = model.families[top]
    votes, total = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
    for i, one in enumerate(members):
        for other in members[i + 1 :]:
            m = margin["pair", one, other]
            votes[one if m > 0 else other] += 1
            total[one] += m
            total[other] -= m
    best = max(members, key=lambda x: votes[x] + 0.5 * math.tanh(total[x] / (1 + len(members))))
    if len(members) > 1:
        sure *= sigmoid(2 * total[best] / (len(members) - 1))
    return best, sure


def test_language_of_each_row(spark):
    words = {"en": "the of and with this", "de": "der und nicht das ein", "fr": "le et pas une dans", "es": "el y no una con"}
    rows = [(f"{w} {p}", lang) for k, (lang, w) in enumerate(words.items()) for p in prose(8, k, 4)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    texts = [r for r in ODD if r[0] != 4] + [(100 + i, f"{w} {t}") for i, (w, t) in enumerate(zip(list(words.values()) * 5, prose(20, 9, 12), strict=True))]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(documents(spark, texts), model).collect()}
    for key, text in texts:
        lang, score = plain_language(text, model)
        assert got[key][0] == lang and abs(got[key][1] - score) < 1e-6, text


def test_quality_of_each_row(spark):
    rows = [(i % 2, ("bad BAD !! " if i % 2 else "good words, ") + t) for i, t in enumerate(prose(80, 4, 15))]
    model = quality.fit(spark.createDataFrame(rows, "label int, text string"))
    assert model.weights.ndim == 2
    texts = ODD + [(100 + i, t) for i, (_, t) in enumerate(rows)] + [(300 + i, t) for i, t in enumerate(prose(30, 5, 40))]
    got = {}
    for r in quality.score(documents(spark, texts), model).collect():
        got.setdefault(r.doc_id, []).append(r.score)
    for key, text in texts:
        data = np.frombuffer((text or "").encode(), np.uint8)
        found = set(features.style_features(data, np.array([0, len(data)]))[1].tolist())
        weight, square = sum(model.weights[0][f] for f in found), sum(model.weights[1][f] for f in found)
        want = sigmoid(model.slope * (weight / math.sqrt(max(square, 1e-12)) + model.bias) + model.shift)
        assert all(abs(score - want) < 1e-9 for score in got[key])


class PlainBins:
    """Open bins as a list of [number, free]; the latest touched of equally full ones is taken."""

    def __init__(self, capacity, limit):
        self.capacity, self.limit, self.open, self.made = capacity, limit, [], 0

    def place(self, length):
        fitting = [b for b in self.open if b[1] >= length]
        if fitting:
            least = min(b[1] for b in fitting)
            chosen = [b for b in fitting if b[1] == least][-1]
            self.open.remove(chosen)
        else:
            if len(self.open) >= self.limit:
                least = min(b[1] for b in self.open)
                self.open.remove([b for b in self.open if b[1] == least][-1])
            chosen = [self.made, self.capacity]
            self.made += 1
        at = self.capacity - chosen[1]
        if chosen[1] > length:
            self.open.append([chosen[0], chosen[1] - length])
        return chosen[0], at


@pytest.mark.parametrize("capacity, limit", [(10, 1), (10, 3), (64, 8), (1024, 64)])
def test_open_bins_against_a_plain_list(capacity, limit):
    rng = np.random.default_rng(capacity + limit)
    mine, plain = packing.OpenBins(capacity, limit), PlainBins(capacity, limit)
    for length in rng.integers(1, capacity + 1, 3000).tolist():
        assert mine.place(length) == plain.place(length)
        assert mine.open == len(plain.open) <= limit


def test_sequences_of_one_packer(spark):
    """Pieces in the packer's order, put one by one into plain bins, give the same sequences and places."""
    texts = [(i, t) for k in range(12) for i, t in enumerate(prose(20, k, 3 + 9 * k), 20 * k)]
    texts += [(900, None), (901, ""), (902, " ".join(prose(1, 3, 900)))]
    docs = documents(spark, texts)
    got = packing.pack(docs, TOKENIZER, length=128, open_bins=8, share=1000).collect()
    number, bins = len(texts), 8
    block = F.pmod(F.xxhash64("ids_crc32", "doc_id"), F.lit(math.ceil(number / bins)))
    pieces = packing.cut(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), TOKENIZER, 128)
    order = sorted(pieces.withColumn("block", block).collect(), key=lambda r: (r.block, -r.length, r.doc_id, r.piece))
    plain = PlainBins(128, bins)
    want = {(r.doc_id, r.piece): plain.place(r.length) for r in order}
    assert {(r.doc_id, r.piece): (r.sequence_id, r.offset) for r in got} == want and len(got) == len(want)
