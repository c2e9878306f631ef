"""Plain versions of what the corpus operators compute, and small tables to try them on."""

import collections
import itertools
import math

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the quick brown fox jumps over the lazy dog while a patient heron waits beside the slow green river until evening comes"


def documents(spark, texts):
    """Rows of ``documents`` from (doc_id, text) pairs."""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """With columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    for name in ("node", "blob", "spans", "row", "toxic", "severity", "label", "batch", "part", "content", "words", "key"):
        df = df.withColumn(name, F.lit("x"))
    return df


def prose(n, seed=0, size=120):
    import random

    rng = random.Random(seed)
    make = lambda: "".join(rng.choice(["ka", "lo", "mi", "tu", "re", "sa", "no", "vi"]) for _ in range(rng.randint(1, 4)))
    return [" ".join(make() for _ in range(size)) for _ in range(n)]


def weighted_classes(docs, threshold=0.8):
    """class of each (doc_id, text) by comparing all pairs."""
    counts = {}
    for i, t in docs:
        w = (t or "").lower().encode().split()
        counts[i] = collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else collections.Counter()
    n, df = len(docs), collections.Counter(x for c in counts.values() for x in c)
    idf = {x: 1 + min(1, math.log(n / v) / math.log(128)) for x, v in df.items()}
    up = {i: i for i, _ in docs}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, ca), (b, cb) in itertools.combinations(counts.items(), 2):
        both = sum(min(ca[x], cb[x]) * idf[x] for x in ca.keys() & cb.keys())
        total = sum(v * idf[x] for x, v in ca.items()) + sum(v * idf[x] for x, v in cb.items()) - both
        if (total and both / total >= threshold) or dict(docs)[a] == dict(docs)[b]:
            low, high = sorted((root(a), root(b)))
            up[high] = low
    return {i: root(i) for i, _ in docs}


def kept_words(docs, window=50):
    first = {}
    for i, t in sorted(docs):
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    out = {}
    for i, t in docs:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def fits(rows, capacity):
    """Whether sequences are gapless and none is longer than allowed; rows of (sequence, offset, length)."""
    by = collections.defaultdict(list)
    for s, o, n in rows:
        by[s].append((o, n))
    for placed in by.values():
        at = 0
        for o, n in sorted(placed):
            if o != at:
                return False
            at += n
        if at > capacity:
            return False
    return True
