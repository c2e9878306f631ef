"""Language identification by hierarchical discrimination.

A text is the mean of its hashed byte runs (one to four bytes of lower-case letters, words apart). One linear support
vector machine for each language family against the rest picks the family; then one machine for each pair of the
family's languages votes, ties being settled by the summed margins. All machines are fitted on at most ``SAMPLE`` texts
a language and applied where the texts are read, in one pass.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a language without a known family is a
family by itself; with one language to learn from, every text with a letter gets it; without any, all are ``und``; null
labels are not learned from; repeated rows and null ids are predicted row by row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.svm import Rows, sigmoid, train
from tessella.llm.tables import map_batches, pieces, raw, texts_of, whole_text

#: Texts of each language that the machines are fitted on, at most (twice that in the worst case).
SAMPLE = 400
BITS = 15
RUNS = (1, 2, 3, 4)
UNKNOWN = "und"

# Families of common languages.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "pl", "cs", "sk", "uk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk"),
}

_FOLD = np.full(256, 32, np.uint8)  # lower-case letters and bytes of letters beyond ASCII stay, all else is a blank
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[128:] = np.arange(128, 256)


def family_of(language: str) -> str:
    return next((name for name, members in FAMILIES.items() if language in members), language)


@dataclass
class Model:
    languages: list[str]
    families: dict[str, list[str]]
    weights: np.ndarray  # one row per machine
    bias: np.ndarray
    names: list[tuple[str, str, str]] = field(default_factory=list)  # (kind, plus, minus) per machine


def runs(data: np.ndarray, offsets: np.ndarray):
    """(position, feature) of each run of bytes that begins at a position and stays within its text; runs of
    blanks alone are left out."""
    folded = _FOLD[data]
    value = np.zeros(len(folded), np.uint32)
    end = np.repeat(offsets[1:], np.diff(offsets))
    place = np.arange(len(folded))
    letter = folded != 32
    for size in RUNS:
        n = len(folded) - size + 1
        if n <= 0:
            return
        value = value[:n] * np.uint32(0x01000193) + folded[size - 1 :].astype(np.uint32)
        feature = ((value ^ (value >> np.uint32(15))) * np.uint32(0x9E3779B1) + np.uint32(size * 0x7F4A7C15 & 0xFFFFFFFF)) >> np.uint32(32 - BITS)
        good = place[:n] + size <= end[:n]
        good &= letter[:n] | letter[size - 1 :]
        yield place[:n][good], feature[good].astype(np.int64)


def _lower(batch: pa.RecordBatch) -> pa.Array:
    return pc.utf8_lower(texts_of(batch))


def feature_rows(sample: DataFrame) -> tuple[Rows, np.ndarray]:
    """Mean runs and languages of a bounded sample of rows (lang, text)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        index, value = [], []
        data, offsets = raw(_lower(batch))
        for a, b in zip(offsets, offsets[1:], strict=False):
            found = [f for _, f in runs(data[a:b], np.array([0, b - a]))]
            each, count = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0), np.zeros(0))
            index.append(each.astype("<i4").tobytes())
            value.append((count / max(count.sum(), 1)).astype("<f4").tobytes())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(index, pa.binary()), pa.array(value, pa.binary())], ["lang", "i", "v"])

    got = map_batches(sample, work, "lang string, i binary, v binary").toArrow()
    rows = sorted(zip(got["i"].to_pylist(), got["v"].to_pylist(), got["lang"].to_pylist(), strict=True))
    pairs = [(np.frombuffer(i, "<i4").astype(np.int64), SCALE * np.frombuffer(v, "<f4").astype(float)) for i, v, _ in rows]
    return Rows.of(pairs), np.array([lang for _, _, lang in rows], object)


#: Means are small numbers; this brings the rows to a length of about one.
SCALE = 8.0


def fit(labelled: DataFrame, sample: int = SAMPLE, cost: float = 10.0) -> Model:
    """A model from rows (lang, text)."""
    labelled = labelled.filter(F.col("lang").isNotNull()).select("lang", whole_text().alias("text"))
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], {}, np.zeros((0, 1 << BITS)), np.zeros(0))
    place = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) / 1e6
    keep = F.lit(False)
    for lang, n in sizes.items():
        keep = keep | ((F.col("lang") == lang) & (place < sample / n))
    rows, langs = feature_rows(labelled.filter(keep).limit(2 * sample * len(sizes)))
    languages = sorted(sizes)
    families: dict[str, list[str]] = {}
    for lang in languages:
        families.setdefault(family_of(lang), []).append(lang)
    family = np.array([family_of(x) for x in langs], object)
    weights, bias, names = [], [], []

    def machine(kind: str, plus: str, minus: str, chosen: np.ndarray, positive: np.ndarray) -> None:
        w, b = train(rows.pick(np.flatnonzero(chosen)), positive[chosen], 1 << BITS, cost)
        weights.append(w * SCALE)
        bias.append(b)
        names.append((kind, plus, minus))

    if len(families) > 1:
        for name in families:
            machine("family", name, "", np.ones(len(langs), bool), family == name)
    for name, members in families.items():
        for i, one in enumerate(members):
            for other in members[i + 1 :]:
                machine("pair", one, other, (langs == one) | (langs == other), langs == one)
    return Model(languages, families, np.array(weights).reshape(len(names), 1 << BITS), np.array(bias), names)


def decide(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language, confidence) from the margins, one column per text."""
    n = margins.shape[1]
    kinds = [k for k, _, _ in model.names]
    names = list(model.families)
    top = np.zeros(n, int)
    sure = np.ones(n)
    if "family" in kinds:
        of = margins[[i for i, k in enumerate(kinds) if k == "family"]]
        top = of.argmax(0)
        power = np.exp(2 * np.clip(of, -20, 20))
        sure = power.max(0) / power.sum(0)
    lang = np.empty(n, object)
    for f, name in enumerate(names):
        members = model.families[name]
        mine = np.flatnonzero(top == f)
        votes = np.zeros((len(members), len(mine)))
        total = np.zeros_like(votes)
        for i, (kind, one, other) in enumerate(model.names):
            if kind == "pair" and one in members:
                margin = margins[i, mine]
                a, b = members.index(one), members.index(other)
                votes[a] += margin > 0
                votes[b] += margin <= 0
                total[a] += margin
                total[b] -= margin
        best = (votes + 0.5 * np.tanh(total / (1 + len(members)))).argmax(0)
        lang[mine] = np.array(members, object)[best]
        if len(members) > 1:
            sure[mine] *= sigmoid(2 * total[best, np.arange(len(mine))] / (len(members) - 1))
    return lang, sure


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of rows (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, texts = shared.value, _lower(batch)
        letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
        lang, sure = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
        if model.languages:
            data, offsets = raw(texts)
            for low, high in pieces(offsets, 1 << 20):
                own = offsets[low : high + 1] - offsets[low]
                total = np.zeros((len(model.names), high - low))
                number = np.zeros(high - low)
                for place, feature in runs(data[offsets[low] : offsets[high]], own):
                    edges = np.searchsorted(place, own)
                    number += np.diff(edges)
                    for m, weights in enumerate(model.weights):
                        sums = np.concatenate([[0.0], np.cumsum(weights[feature])])
                        total[m] += sums[edges[1:]] - sums[edges[:-1]]
                lang[low:high], sure[low:high] = decide(model, total / np.maximum(number, 1) + model.bias[:, None])
            lang[~letters], sure[~letters] = UNKNOWN, 0.0
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(sure)], ["doc_id", "lang_pred", "score"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")), work, "doc_id long, lang_pred string, score double")
