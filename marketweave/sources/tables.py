"""Keyed table writes as frame rewrites, and the partition overwrite that stores them.

Parquet has no MERGE: a write reads the touched partitions, drops the rows whose
key arrives again, adds the new rows, and overwrites those partitions only. Two
writers must not touch the same partition at the same time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from ..functions.symbols import normalize_symbol
from ..operators import prices as px
from ..schemas import KEYS, SCHEMAS, STRICT_TABLES


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) == ""


def missing_keys(keys: list[str]) -> Column:
    """Comma list of the blank key parts; empty for a complete key."""
    return F.concat_ws(",", *[F.when(_blank(k), F.lit(k)) for k in keys])


def complete_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [~_blank(k) for k in keys])


def reject_missing_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``reject_reason``: null for a complete key. One pass serves both sinks."""
    missing = missing_keys(keys)
    return df.withColumn("reject_reason", F.when(missing != "", F.concat(F.lit("missing "), missing)))


def dedupe_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows with a complete key, the last one per key.

    ``row_number() = 1`` keeps one row per key and map task before the shuffle.
    """
    complete = df.where(complete_key(keys))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return complete.withColumn("keep", rank).where(F.col("keep") == 1).drop("keep")


def align_schema(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Columns of the schema in order: missing ones as typed null, extra ones dropped (or refused)."""
    extra = [c for c in df.columns if c not in schema.names]
    if extra and strict:
        raise ValueError(f"unknown columns {extra}")
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def prepare(table: str, df: DataFrame, order: list[Column]) -> DataFrame:
    """Canonical symbol, complete key, table checks, last row per key, table schema."""
    if "symbol" in df.columns:
        df = df.withColumn("symbol", normalize_symbol(F.col("symbol")))
    if table == "normalized_stock_prices_daily":
        df = df.where(px.complete_row())  # a snapshot-only row is incomplete too
    rows = dedupe_last(df, KEYS[table], order)
    return align_schema(rows, SCHEMAS[table], table in STRICT_TABLES) if table in SCHEMAS else rows


def _first_of(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of the frames, the first frame that has a key giving its row; each frame has unique keys.

    One shuffle moves all frames, and none is read twice.
    """
    columns = frames[0].columns
    stacked = reduce(DataFrame.unionByName, [df.select(*columns, F.lit(i).alias("frame")) for i, df in enumerate(frames)])
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("frame"))
    return stacked.withColumn("keep", rank).where(F.col("keep") == 1).select(*columns)


def upsert(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Changes replace target rows of the same key."""
    return _first_of([changes.select(*target.columns), target], keys)


def insert_ignore(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Only keys the target lacks are added."""
    return _first_of([target, changes.select(*target.columns)], keys)


def update_where(target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Matched rows take the non-null new values; other rows and columns stay."""
    new = changes.select(*keys, *[F.col(c).alias(f"new_{c}") for c in columns])
    joined = target.join(new, keys, "left")
    return joined.select(*[F.coalesce(f"new_{c}", c).alias(c) if c in columns else F.col(c) for c in target.columns])


def delete_where(target: DataFrame, equal: dict | None = None, below: dict | None = None) -> DataFrame:
    """Rows not matched by all the equality and less-than filters; null never matches."""
    conds = [F.col(k) == F.lit(v) for k, v in (equal or {}).items()] + [F.col(k) < F.lit(v) for k, v in (below or {}).items()]
    if not conds:
        raise ValueError("a delete needs a filter")
    return target.where(~F.coalesce(reduce(lambda a, b: a & b, conds), F.lit(False)))


def replace_slice(target: DataFrame, slice_condition: Column, fresh: DataFrame) -> DataFrame:
    """Delete one logical slice and insert its fresh rows."""
    return target.where(~F.coalesce(slice_condition, F.lit(False))).unionByName(fresh.select(*target.columns))


def refresh_slices(target: DataFrame, fresh: DataFrame, keys: list[str], refreshed: DataFrame) -> DataFrame:
    """Every slice named in ``refreshed`` loses its old rows, fresh ones or not."""
    return target.join(refreshed.select(*keys).distinct(), keys, "left_anti").unionByName(fresh.select(*target.columns))


def run_log(job: Column, target_date: Column, status: Column, processed: Column, message: Column | None = None) -> list[Column]:
    return [
        job.alias("job_name"), target_date.alias("target_date"), F.coalesce(status, F.lit("")).alias("status"),
        processed.cast("long").alias("records_processed"), (message if message is not None else F.lit("")).alias("error_message"),
    ]


# ---- storage ----------------------------------------------------------------


def store(df: DataFrame, path: str, partition: str = "base_date") -> None:
    """Overwrite only the partitions present in ``df``.

    Rows of a partition meet in one write task unless they are many: adaptive
    execution splits and joins the tasks by their measured size.
    """
    _overwrite(df.hint("rebalance", F.col(partition)), path, partition)


def _overwrite(df: DataFrame, path: str, partition: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def store_counted(df: DataFrame, flag: str, path: str, partition: str = "base_date") -> int:
    """As :func:`store`, without the column ``flag``; the number of written rows where it is true.

    The write counts them itself, in its last stage, where a repeated task counts once.
    """
    seen = Observation()
    rows = df.hint("rebalance", F.col(partition)).observe(seen, F.count_if(F.col(flag)).alias("n")).drop(flag)
    _overwrite(rows, path, partition)
    return seen.get["n"]


def clear(spark: SparkSession, path: str, schema: T.StructType, partition: str, value) -> None:
    """Leave one partition without rows, which an overwrite with no rows would not touch."""
    rest = T.StructType([f for f in schema.fields if f.name != partition])
    nothing = spark.createDataFrame([], rest)
    nothing.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{partition}={value}")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("nothing int").parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored table, or no rows before its first write."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def from_footers(spark: SparkSession, path: str) -> DataFrame:
    """A stored table whose counts and extremes Spark takes from file footers, without reading rows.

    That needs Parquet's second reader, which is chosen while the table is opened; all other reads and the writes keep the first.
    Groups must be partition columns, and a filter on other columns makes Spark read rows again.
    """
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    chosen = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in chosen.split(",") if x != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", chosen)


def stored_state(spark: SparkSession, paths: dict[str, str], target, partition: str = "base_date") -> DataFrame:
    """Of each stored table: table_name, latest_date with rows, row_count, target_count and lag_days, from footers alone.

    A table that was never written, or is empty, has no latest date and counts of 0.
    """
    day = F.col(partition).cast("date")
    aim = F.lit(target).cast("date")
    states = []
    for name, path in paths.items():
        if _exists(spark, path) and partition in (held := from_footers(spark, path)).columns:
            days = held.groupBy(partition).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
        else:
            days = spark.createDataFrame([], f"{partition} date, n long")
        counted = days.agg(F.max(day).alias("latest_date"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.coalesce(F.sum(F.when(day == aim, F.col("n"))), F.lit(0)).alias("target_count"))
        states.append(counted.select(F.lit(name).alias("table_name"), "*", F.datediff(aim, "latest_date").alias("lag_days")))
    return reduce(DataFrame.unionByName, states)


def upsert_table(spark: SparkSession, path: str, table: str, changes: DataFrame, order: list[Column], partition: str = "base_date") -> None:
    """Merge changes into a stored table, reading and rewriting only the partitions they touch.

    The changes are computed once and kept. The touched days, of which there are no
    more than the calendar has, come to the driver as literals that prune the scan.
    """
    ready = prepare(table, changes, order).persist()
    try:
        days = [r[0] for r in ready.select(partition).distinct().collect()]
        touched = read(spark, path, SCHEMAS[table]).where(F.col(partition).isin(days))
        store(upsert(touched, ready, KEYS[table]), path, partition)
    finally:
        ready.unpersist()


def append_run_log(spark: SparkSession, path: str, rows: DataFrame) -> None:
    align_schema(rows, SCHEMAS["pipeline_run_logs"], strict=True).write.mode("append").partitionBy("target_date").parquet(path)
