"""Scans and readers of landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.symbols import normalize_symbol


def date_range(df: DataFrame, column: str, start, end, order: str | None = None, descending: bool = True) -> DataFrame:
    """Inclusive date range of the whole table, without a row cap."""
    rows = df.where(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if order is None:
        return rows
    return rows.orderBy(F.col(order).desc() if descending else F.col(order).asc())


def matching(df: DataFrame, columns: list[str], equal: dict | None = None, among: dict | None = None, unequal: dict | None = None) -> DataFrame:
    """Projection of the rows that pass equality, IN and not-equal filters."""
    for name, value in (equal or {}).items():
        df = df.where(F.col(name) == F.lit(value))
    for name, values in (among or {}).items():
        df = df.where(F.col(name).isin(*values))
    for name, value in (unequal or {}).items():
        df = df.where(F.col(name) != F.lit(value))
    return df.select(*columns)


def latest_row(df: DataFrame, column: str, until=None) -> DataFrame:
    rows = df if until is None else df.where(F.col(column) <= F.lit(until).cast("date"))
    return rows.orderBy(F.desc(column)).limit(1)


def latest_row_per_series(df: DataFrame, until) -> DataFrame:
    rows = df.where(F.col("base_date") <= F.lit(until).cast("date"))
    return rows.groupBy("series_id").agg(F.max("base_date").alias("base_date"), F.max_by("value", "base_date").alias("value"))


def latest_dates(tables: dict[str, DataFrame], target, column: str = "base_date") -> DataFrame:
    """Freshness list: latest date and lag per table, one partial aggregate per table."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.max(column).alias("latest_date")).select(F.lit(name).alias("table_name"), "latest_date")
        out = part if out is None else out.unionByName(part)
    return out.withColumn("lag_days", F.datediff(F.lit(target).cast("date"), "latest_date"))


def row_counts(tables: dict[str, DataFrame], target, column: str = "base_date") -> DataFrame:
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(column) == F.lit(target).cast("date")).alias("target_count")).select(
            F.lit(name).alias("table_name"), "row_count", "target_count")
        out = part if out is None else out.unionByName(part)
    return out


SERIES_CONFIG = T.StructType([
    T.StructField("series_id", T.StringType()), T.StructField("source", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("frequency", T.StringType()), T.StructField("enabled", T.BooleanType()),
])


def series_config(spark: SparkSession, path: str, categories: list[str] | None = None, ids: list[str] | None = None) -> DataFrame:
    """Series definitions from JSON files (one object per line, or a whole-file list), filtered."""
    rows = spark.read.schema(SERIES_CONFIG).json(path).where(F.coalesce("enabled", F.lit(True)))
    if categories:
        rows = rows.where(F.col("category").isin(*categories))
    return rows.where(F.col("series_id").isin(*ids)) if ids else rows


def calendar_overrides(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The list inside ``{"overrides": [...]}`` documents, one per file or one per line."""
    item = T.StructType([
        T.StructField("exchange_code", T.StringType()), T.StructField("calendar_date", T.DateType()),
        T.StructField("is_open", T.BooleanType()), T.StructField("reason", T.StringType()),
    ])
    document = T.StructType([T.StructField("overrides", T.ArrayType(item))])
    rows = spark.read.schema(document).option("multiLine", multi_line).json(path).select(F.inline("overrides"))
    return rows.where("exchange_code is not null and calendar_date is not null").withColumn("exchange_code", F.upper("exchange_code"))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Listing file (code, name, market, line_no): canonical code, the last line of a code wins."""
    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("name", T.StringType()), T.StructField("market", T.StringType()), T.StructField("line_no", T.LongType())])
    rows = spark.read.schema(schema).option("header", True).csv(path).where("code is not null and name is not null")
    row = F.max_by(F.struct("name", "market"), "line_no")
    return rows.groupBy(normalize_symbol(F.col("code")).alias("code")).agg(row.alias("r")).select("code", "r.name", "r.market")


def corp_codes(spark: SparkSession, path: str) -> DataFrame:
    """Filer code to stock code from the XML list; unlisted filers have a blank stock code."""
    schema = T.StructType([T.StructField("corp_code", T.StringType()), T.StructField("corp_name", T.StringType()), T.StructField("stock_code", T.StringType())])
    rows = spark.read.format("xml").schema(schema).option("rowTag", "list").load(path)
    return rows.withColumn("stock_code", F.btrim("stock_code")).where(F.col("stock_code") != "")
