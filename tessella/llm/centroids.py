"""Exact clustering of integer vectors around centroids by a progressive search in Walsh-Hadamard coefficients.

Components become integers, floor(64 * x). The transform of a vector of 64 integers by the Hadamard matrix (rows in order
of their sign changes, so coarse first) is exact, and the squared distance of two vectors is that of their transforms,
divided by 64. So the squared differences of the first coefficients never exceed the whole, and for the coarse ones, which
hold most of a smooth vector's energy, they come near it soon.

A vector adds up its differences to all centroids in steps of ``STEP`` coefficients. After the first step, the centroid that
is nearest so far is finished, and after every step the centroids whose differences already exceed that distance, strictly,
are left out. Those that remain after all 64 have exact distances; ties go to the smaller number.

Vectors stay where they are read. A round sends the sums of each task's vectors by centroid and component, at most
``CENTROIDS`` x 64 rows a task, added up by Spark; only the centroids reach the driver. A vector that very many rows
hold is no group of its own anywhere.

Defined cases: vectors that are null, of another length, or with a null, infinite or NaN component are left out, and so are
those with a component of 2**18 or more in size, whose squared distances 64 bits cannot hold; a null id counts as an empty
text where starts are chosen; rows with equal ids are vectors of their own, of which the starts take those with the
smaller components first; fewer vectors than centroids give as many centroids as vectors; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.tables import arrow_batches, store

SIZE = 64
CENTROIDS = 16
ROUNDS = 3
#: Coefficients added before centroids are left out.
STEP = 8
#: Vectors that one vectorised step takes.
CHUNK = 4096
LARGEST = float(1 << 18)


def hadamard(size: int = SIZE) -> np.ndarray:
    """The Hadamard matrix, its rows ordered by their number of sign changes."""
    out = np.ones((1, 1), np.int64)
    while len(out) < size:
        out = np.block([[out, out], [out, -out]])
    return out[np.argsort((out[:, 1:] != out[:, :-1]).sum(1), kind="stable")]


#: Sums of 64 integers below 2**24 are exact in double precision too, where products of matrices are fast.
_MATRIX = hadamard().T.astype(np.float64)


def transformed(vectors: np.ndarray) -> np.ndarray:
    return np.rint(vectors.astype(np.float64) @ _MATRIX).astype(np.int64)


def nearest(vectors: np.ndarray, centroids: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each vector; both are transforms."""
    n, k = len(vectors), len(centroids)
    row, other, sums = np.repeat(np.arange(n), k), np.tile(np.arange(k), n), np.zeros(n * k, np.int64)
    most = None
    for low in range(0, SIZE, step):
        apart = vectors[row, low : low + step] - centroids[other, low : low + step]
        sums += (apart * apart).sum(1)
        if most is None:
            ahead = sums.reshape(n, k).argmin(1)
            most = ((vectors - centroids[ahead]) ** 2).sum(1)
        alive = sums <= most[row]
        row, other, sums = row[alive], other[alive], sums[alive]
    order = np.lexsort((other, sums, row))
    first = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
    return other[first], sums[first] // SIZE


def integers(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """The vectors of a batch as rows of integers."""
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return np.floor(values.astype(np.float64) * SIZE).astype(np.int64).reshape(-1, SIZE)


def kept(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the vectors that take part."""
    vector = rows[vector_col].cast("array<double>")
    whole = (F.size("vector") == SIZE) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    return rows.select(rows[id_col].cast("long").alias("vec_id"), vector.alias("vector")).filter(F.coalesce(whole, F.lit(False)))


def starts(vectors: DataFrame, number: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, as integers."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    scaled = F.transform("vector", lambda x: F.floor(x * SIZE).cast("long"))
    first = vectors.select(digest.alias("digest"), scaled.alias("scaled")).orderBy("digest", "scaled").limit(number)
    return np.array([r.scaled for r in first.collect()], np.int64).reshape(-1, SIZE)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after each vector has joined its nearest one."""
    shared = vectors.sparkSession.sparkContext.broadcast(transformed(centroids))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((len(shared.value), SIZE), np.int64), np.zeros(len(shared.value), np.int64)
        for batch in batches:
            own = integers(batch, 0)
            for low in range(0, len(own), CHUNK):
                part = own[low : low + CHUNK]
                cluster, _ = nearest(transformed(part), shared.value)
                np.add.at(total, cluster, part)
                count += np.bincount(cluster, minlength=len(count))
        used = np.flatnonzero(count)
        columns = [np.repeat(used, SIZE), np.tile(np.arange(SIZE), len(used)), total[used].ravel(), np.repeat(count[used], SIZE)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cluster", "place", "total", "n"])

    sums = vectors.select("vector").mapInArrow(work, "cluster long, place long, total long, n long")
    added = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("total", "n")]
    out = centroids.copy()
    for r in sums.groupBy("cluster", "place").agg(*added).collect():
        out[r.cluster, r.place] = int(r.total) // int(r.n)
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of each vector."""
    shared = vectors.sparkSession.sparkContext.broadcast(transformed(centroids))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = integers(batch, 1)
            for low in range(0, len(own), CHUNK):
                part = own[low : low + CHUNK]
                cluster, distance = nearest(transformed(part), shared.value)
                columns = [batch.column(0).slice(low, len(part)), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "vector").mapInArrow(work, "vec_id long, cluster int, distance long")


def _of_cluster(values: list) -> Column:
    """The value of a row's cluster, by its number."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.col("cluster"))


def clusters(rows: DataFrame, number: int = CENTROIDS, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each vector that takes part."""
    arrow_batches(rows.sparkSession, 4 * CHUNK)
    vectors = kept(rows, id_col, vector_col)
    centroids = starts(vectors, number)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    found = store(assigned(vectors, centroids), "vector-clusters")
    inertia = [0] * len(centroids)
    for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect():
        inertia[r.cluster] = int(r.total)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return found.select(
        "*",
        _of_cluster(inertia).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"),
        _of_cluster(names).alias("centroid_sha256"),
    )
