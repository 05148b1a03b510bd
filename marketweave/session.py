"""Session settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "marketweave") -> SparkSession:
    """A session with AQE, skew-join handling and UTC time.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: AQE coalesces
    the configured shuffle partitions to the data.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def landing_dir(spark: SparkSession, *parts: str) -> str:
    """Where landed files go: ``spark.marketweave.landing.dir``, or the shared folder if that is not set."""
    base = spark.conf.get("spark.marketweave.landing.dir", None)
    return "/".join([base.rstrip("/"), *parts]) if base else shared_dir(spark, "landing", *parts)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read again, so that each use sees the same."""
    path = shared_dir(df.sparkSession, "staged", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local run, where the
    setting may be absent, falls back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="marketweave-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, *parts) if "://" not in base else "/".join([base.rstrip("/"), *parts])


def dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows in as many parts as the session shuffles to, dealt by ``keys``, of which each has few rows.

    Aggregates by ``keys`` need no further shuffle then and combine no rows before it, where each task would hold nearly every row of its split.
    AQE joins the small parts of other shuffles until a task has 64 MB of compressed rows, of each side of a union; these parts are not joined.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
