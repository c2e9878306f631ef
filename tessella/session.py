"""Session settings and shared scratch storage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def build_session(app: str = "tessella", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **{k.replace("__", "."): str(v) for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Set the one SQL setting the JSON semantics depend on: the last duplicate key wins."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path under the shared folder named by ``spark.checkpoint.dir``.

    Without that setting a temporary folder is used, which only a local session can share with
    its tasks; a cluster session must name a shared folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        app_id = spark.sparkContext.applicationId
        if app_id not in _local_scratch:
            _local_scratch[app_id] = tempfile.mkdtemp(prefix="tessella-")
        base = _local_scratch[app_id]
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back, so several consumers share the work
    and a lost executor costs a re-read instead of a recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
