"""Snapshots kept in buckets by key, so that what brings the rows of a key together needs no shuffle.

A bucketed table holds its rows in a fixed number of buckets by the hash of the key columns, sorted by them. Tables with
the same keys and number of buckets are joined, and grouped by key, bucket by bucket where they lie: state, assembly and
anti-joins of any number of runs pay for one shuffle, at the write. Each bucket is its own partition folder, so an
update reads and replaces the buckets it touches and leaves the files of all others as they are.

Choose the number of buckets by ``buckets_for``; it cannot change later. An update is done when ``update`` returns. One that
broke off is repeated as it is: its rows replace themselves.

Defined cases: null keys are one value, for rows as for updates (a null is not a mismatch here); an update without rows
touches nothing; columns are matched by name; a table without rows has its columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tessella.session import materialize

KEYS = ("generator", "base_filename")
BUCKET = "_bucket"

#: Bytes of a bucket, as Parquet: what one task reads and sorts.
BUCKET_BYTES = 256 << 20
MOST_BUCKETS = 1 << 16


def buckets_for(n_bytes: int) -> int:
    """A power of two, so that buckets of about ``BUCKET_BYTES`` hold the bytes."""
    return min(MOST_BUCKETS, 1 << math.ceil(math.log2(max(1, n_bytes / BUCKET_BYTES))))


def text_bytes(rows: DataFrame) -> int:
    """Bytes of all texts of the rows, before they are compressed; the rows are computed once for it."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in rows.schema if f.dataType.typeName() in ("string", "binary")]
    total = F.sum(sum((n.cast("bigint") for n in texts), F.lit(0).cast("bigint")))
    return rows.agg(total).first()[0] or 0


def bucket_of(keys, buckets: int) -> Column:
    """The bucket that Spark deals the keys to, as a column."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


def _dealt(rows: DataFrame, keys, buckets: int) -> DataFrame:
    """Rows with their bucket; one task holds one bucket and so writes one file."""
    return rows.repartition(buckets, *keys).withColumn(BUCKET, bucket_of(keys, buckets))


def _layout(spark: SparkSession, table: str) -> tuple[list[str], int]:
    """(key columns, number of buckets) that the catalog names for a table."""
    found = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect() if r.col_name in ("Num Buckets", "Bucket Columns")}
    if len(found) < 2:
        raise ValueError(f"{table} has no buckets")
    return [c.strip("` ") for c in found["Bucket Columns"].strip("[]").split(",")], int(found["Num Buckets"])


def write(rows: DataFrame, table: str, path: str, keys=KEYS, buckets: int = 64) -> DataFrame:
    """Create ``table`` at the shared folder ``path``; returns its rows as ``read`` does."""
    if BUCKET in rows.columns:
        raise ValueError(f"the column {BUCKET} is the table's own")
    keys = list(keys)
    (
        _dealt(rows, keys, buckets)
        .write.format("parquet")
        .partitionBy(BUCKET)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(table)
    )
    return read(rows.sparkSession, table)


def attach(spark: SparkSession, table: str, path: str, schema, keys=KEYS, buckets: int = 64) -> DataFrame:
    """Name a table that another session wrote at ``path``, where the catalog does not outlive a session."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {table} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return read(spark, table)


def read(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.table(table).drop(BUCKET)


def last_by(rows: DataFrame, keys, order: str) -> DataFrame:
    """The last row of each key by the column ``order``."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc_nulls_last(order)))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def _without(old: DataFrame, gone: DataFrame, keys, within) -> DataFrame:
    """Stored rows whose keys and columns ``within`` are not among ``gone``. They meet by the keys alone, as buckets serve a
    join only by their own columns, and each key brings the set of what goes. Keys without nulls meet where the buckets
    lie; the few with nulls need a null-safe join, which does not keep to them."""
    what = F.struct(*[F.col(c).alias(c) for c in within]) if within else F.struct(F.lit(True).alias("all"))
    sets = gone.groupBy(*keys).agg(F.collect_set(what).alias("_gone"))
    has_null = F.greatest(*[F.col(c).isNull() for c in (*keys, keys[0])])
    stays = F.col("_gone").isNull() | ~F.array_contains("_gone", what)
    whole = old.where(~has_null).join(sets.where(~has_null), list(keys), "left").where(stays).select(*old.columns)
    named = sets.where(has_null).select(*[F.col(c).alias(f"_gone_{c}") for c in keys], "_gone")
    same = [F.col(c).eqNullSafe(F.col(f"_gone_{c}")) for c in keys]
    return whole.unionByName(old.where(has_null).join(named, same, "left").where(stays).select(*old.columns))


def update(updates: DataFrame, table: str, within=(), order: str | None = None) -> int:
    """Put rows in the place of those with the same key and the same columns ``within`` (the kind of an artefact, say);
    rows without such a one are added. Returns the number of buckets that were touched.

    Of several updates of one place the last by ``order`` counts; without an order they are an error. The merged
    buckets are written to the shared folder before any of theirs is replaced."""
    spark = updates.sparkSession
    keys, buckets = _layout(spark, table)
    stored = spark.read.table(table)
    names = [c for c in stored.columns if c != BUCKET]
    place = [*keys, *within]
    if order is not None:
        updates = last_by(updates, place, order)
    new = materialize(updates.select(*names).withColumn(BUCKET, bucket_of(keys, buckets)), "updates")
    if order is None and new.groupBy(*place).count().where("count > 1").limit(1).count():
        raise ValueError("several updates of one place; name a column to order them by")
    # bounded: no more numbers than the table has buckets
    touched = [r[0] for r in new.select(BUCKET).distinct().collect()]
    if not touched:
        return 0
    kept = _without(stored.where(F.col(BUCKET).isin(touched)), new, keys, within)
    merged = materialize(kept.unionByName(new), "merged")
    _replace(merged.select(*names), table, keys, buckets)
    return len(touched)


def _replace(rows: DataFrame, table: str, keys, buckets: int) -> None:
    """Put the rows in the place of the buckets they belong to."""
    spark = rows.sparkSession
    # the table's own order of columns, the bucket last
    dealt = _dealt(rows, keys, buckets).select(*spark.read.table(table).columns)
    # insertInto takes the mode from the session alone; without it all other buckets would go
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        dealt.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    spark.catalog.refreshTable(table)


def remove(selection: DataFrame, table: str, within=()) -> int:
    """Take out the rows of the keys (and columns ``within``) that a selection names; returns the number of buckets touched.
    A bucket that loses all its rows is emptied by dropping its partition."""
    spark = selection.sparkSession
    keys, buckets = _layout(spark, table)
    place = [*keys, *within]
    stored = spark.read.table(table)
    gone = materialize(selection.select(*place).distinct().withColumn(BUCKET, bucket_of(keys, buckets)), "gone")
    touched = [r[0] for r in gone.select(BUCKET).distinct().collect()]  # bounded, as above
    if not touched:
        return 0
    merged = materialize(_without(stored.where(F.col(BUCKET).isin(touched)), gone, keys, within), "kept")
    left = {r[0] for r in merged.select(BUCKET).distinct().collect()}
    _replace(merged.drop(BUCKET), table, keys, buckets)
    for bucket in sorted(set(touched) - left):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BUCKET}={bucket})")
    return len(touched)
