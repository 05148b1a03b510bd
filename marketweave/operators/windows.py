"""Window columns over one-row-per-day panels.

The frames all share one ``partitionBy/orderBy`` so Spark sorts once. A symbol
has at most one row per open day here, so a window partition is bounded by the
length of the calendar, however many raw rows a symbol had.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.sanity import JUMP_DOWN, JUMP_MIN_HISTORY, JUMP_UP, price_scale_warning

def by_symbol():
    return Window.partitionBy("symbol").orderBy("base_date")


def _rows(first: int, last: int = 0):
    return by_symbol().rowsBetween(first, last)


def ratio_change(current: Column, previous: Column) -> Column:
    return F.when(previous != 0, current / previous - F.lit(1.0))


def return_n(n: int) -> Column:
    return ratio_change(F.col("close_price"), F.lag("close_price", n).over(by_symbol()))


def moving_avg(n: int) -> Column:
    return F.avg("close_price").over(_rows(-(n - 1)))


def ratio_to_mean(name: str = "trading_value", n: int = 20) -> Column:
    frame = _rows(-(n - 1))
    return F.when(F.count(name).over(frame) == n, F.col(name) / F.avg(name).over(frame))


def volatility(n: int = 20) -> Column:
    """Needs the helper column ``return_1d``; 0.0 on the first row of a symbol."""
    return F.when(F.row_number().over(by_symbol()) == 1, 0.0).otherwise(F.stddev_samp("return_1d").over(_rows(-(n - 1))))


def zscore(name: str = "foreign_net_buy", n: int = 20) -> Column:
    frame = _rows(-(n - 1))
    spread = F.stddev_samp(name).over(frame)
    return F.when(spread != 0, (F.col(name) - F.avg(name).over(frame)) / spread)


def source_mixed(n: int) -> Column:
    """More than one source in the last n+1 rows; too few rows count as not mixed."""
    frame, source = _rows(-n), F.coalesce("source", F.lit("UNKNOWN"))
    ready = F.count(F.lit(1)).over(frame) == n + 1
    return ready & (F.min(source).over(frame) != F.max(source).over(frame))


def jump_warning() -> Column:
    """Close against the median of up to 20 earlier closes, five at least."""
    frame = _rows(-20, -1)
    ratio = F.col("close_price") / F.percentile("close_price", F.lit(0.5)).over(frame)
    jump = (F.count("close_price").over(frame) >= JUMP_MIN_HISTORY) & ((ratio >= JUMP_UP) | (ratio <= JUMP_DOWN))
    return F.coalesce(jump, F.lit(False))


def stock_columns(panel: DataFrame, bounds: dict | None = None) -> DataFrame:
    """Every stock feature, mixed-source flag and price warning in one pass over the panel."""
    first_jump = F.when(jump_warning(), "WARN_PRICE_JUMP_ANOMALY")
    return panel.withColumn("return_1d", return_n(1)).withColumns({
        "return_5d": return_n(5),
        "return_20d": return_n(20),
        "return_60d": return_n(60),
        "moving_avg_5": moving_avg(5),
        "moving_avg_20": moving_avg(20),
        "trading_value_ratio_20d": ratio_to_mean(),
        "volatility_20d": volatility(),
        "foreign_flow_zscore": zscore(),
        "mixed_5": source_mixed(5),
        "mixed_20": source_mixed(20),
        "mixed_60": source_mixed(60),
        "price_warning": F.coalesce(
            first_jump,
            F.when(price_scale_warning(F.col("symbol"), F.col("close_price"), bounds), "WARN_PRICE_SCALE_ANOMALY"),
        ),
    })


def fill_forward_back(df: DataFrame, key: str, order: str, value: str, causal: bool = False) -> DataFrame:
    """Forward fill, then backward fill of the head; ``causal`` leaves the head empty."""
    base = Window.partitionBy(key).orderBy(order)
    back = F.last(value, ignorenulls=True).over(base.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(value, ignorenulls=True).over(base.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn(value, back if causal else F.coalesce(back, ahead))


def lag_change_wide(df: DataFrame, key: str = "column_name", value: str = "value") -> DataFrame:
    """Change against 1 and 5 rows back; too few rows or a zero base give null."""
    w = Window.partitionBy(key).orderBy("base_date")
    return df.withColumns({
        "chg_1d": ratio_change(F.col(value), F.lag(value, 1).over(w)),
        "chg_5d": ratio_change(F.col(value), F.lag(value, 5).over(w)),
    })


def lag_change_series(df: DataFrame, key: str = "series_id", value: str = "value") -> DataFrame:
    """As above, but with 1 to 4 earlier rows the 5-row change uses the oldest of them."""
    w = Window.partitionBy(key).orderBy("base_date")
    oldest = F.when(F.row_number().over(w) > 1, F.first(value).over(w.rowsBetween(-5, 0)))
    return df.withColumns({
        "chg_1d": ratio_change(F.col(value), F.lag(value, 1).over(w)),
        "chg_5d": ratio_change(F.col(value), oldest),
    })


#: Rows of a block, about; and cuts that are compared one by one when a row is placed.
BLOCK_ROWS = 1_000_000
_STRIDE = 64


def _whole(df: DataFrame, name: str) -> Column:
    """A column as whole numbers of the same order."""
    kind = df.select(name).schema[0].dataType.simpleString()
    col = F.col(name)
    if kind.startswith("timestamp"):
        return F.unix_micros(col.cast("timestamp"))
    return F.unix_date(col).cast("long") if kind == "date" else col.cast("long")


def _alike(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    conds = [left[n].eqNullSafe(right[f"of_{n}"]) for n in names]
    return reduce(lambda a, b: a & b, conds)


def _cuts(df: DataFrame, by: list[str], value: str, target: int) -> DataFrame | None:
    """For each group of more than ``target`` rows the values that cut it into even parts, from a mergeable quantile sketch; None if there is no such group.

    The cuts come to the driver, at most one for ``target`` rows of the table, and go on
    as literals: sketches differ from run to run, and every use must see the same cuts.
    """
    heavy = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > target).collect()
    if not heavy:
        return None
    spark = df.sparkSession
    names = T.StructType([T.StructField(f"of_{f.name}", f.dataType) for f in df.select(*by).schema.fields])
    # the greatest group says how fine the sketch must be: errors of about two in its size
    most = -(-max(r["n"] for r in heavy) // target)
    fine, grid = min(65_535, max(200, 16 * most)), min(20_000, 4 * most)
    groups = spark.createDataFrame([tuple(r)[:-1] for r in heavy], names)
    rows = df.join(F.broadcast(groups), _alike(df, groups, by), "left_semi")
    sketched = rows.groupBy(*by).agg(F.kll_sketch_agg_bigint(value, F.lit(fine)).alias("s"))
    parts = F.ceil(F.kll_sketch_get_n_bigint("s") / target)
    even = F.kll_sketch_get_quantile_bigint("s", F.array(*[F.lit(i / grid) for i in range(1, grid)]))
    picked = sketched.select(*by, even.alias("even"), parts.cast("long").alias("parts"))
    places = F.transform(F.sequence(F.lit(1).cast("long"), F.col("parts") - 1), lambda i: F.element_at("even", F.least(F.ceil(i * grid / F.col("parts")), F.lit(grid - 1)).cast("int")))
    found = picked.where("parts > 1").select(*by, F.explode(places).alias("cut"))
    per = found.groupBy(*by, "cut").agg(F.count(F.lit(1)).alias("times")).groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("cut", "times"))).alias("cuts"))
    listed = []
    for r in per.collect():
        cuts = [c["cut"] for c in r["cuts"]]
        listed.append((*tuple(r)[:-1], cuts, cuts[::_STRIDE], [c["cut"] for c in r["cuts"] if c["times"] > 1]))
    longs = T.ArrayType(T.LongType())
    return spark.createDataFrame(listed, T.StructType([*names.fields, *(T.StructField(n, longs) for n in ("cuts", "coarse", "hot"))]))


def in_blocks(df: DataFrame, by: list[str], order: str, target: int | None = None) -> DataFrame:
    """``df`` with ``block``: the place of its range of (keys, order), each range having about ``target`` rows, or a whole key of fewer.

    ``order`` is a whole number, a date, an instant, or a struct of such. A value that holds
    more than one cut is a block for itself, cut on by the struct's next field. Nothing is
    written, and the number of blocks follows the rows alone.
    """
    target = target or BLOCK_ROWS
    kind = df.select(order).schema[0].dataType
    fields = [f"{order}.{f.name}" for f in kind.fields] if isinstance(kind, T.StructType) else [order]
    rows, fixed, places, columns = df, list(by), [], df.columns
    for level, field in enumerate(fields):
        value, place = f"value_{level}", f"place_{level}"
        rows = rows.withColumn(value, _whole(df, field))
        # below the first field, only rows of a hot value are cut on
        wanted = rows if not level else rows.where(f"on_{level - 1}")
        cuts = _cuts(wanted, fixed, value, target)
        if cuts is None:
            break
        joined = rows.join(F.broadcast(cuts), _alike(rows, cuts, fixed) & (F.col(f"on_{level - 1}") if level else F.lit(True)), "left")
        v, coarse = F.col(value), F.size(F.filter("coarse", lambda x: x < F.col(value)))
        start = F.greatest(coarse - 1, F.lit(0)) * _STRIDE
        below = start + F.size(F.filter(F.slice("cuts", start + 1, F.lit(_STRIDE)), lambda x: x < F.col(value)))
        hot = F.coalesce(F.array_contains("hot", v), F.lit(False))
        number = F.when(F.col("cuts").isNull(), 0).otherwise(2 * below + hot.cast("int"))
        rows = joined.withColumns({place: number, f"on_{level}": hot}).drop(*cuts.columns)
        places.append(place)
        fixed = [*fixed, value]
    return rows.select(*columns, F.struct(*places or [F.lit(0).alias("whole")]).alias("block"))


def blocked_lag(df: DataFrame, keys: str | list[str], order: str, value: str) -> DataFrame:
    """``lag(value)`` per key for histories too long for one task.

    Rows are windowed per (key, block); the first row of a block takes the last
    value of the key's previous block from a table with one row per block.
    """
    by = [keys] if isinstance(keys, str) else list(keys)
    inside = Window.partitionBy(*by, "block").orderBy(order)
    blocks = Window.partitionBy(*by).orderBy("block")
    cut = in_blocks(df, by, order)
    if cut.schema["block"].dataType.fieldNames() == ["whole"]:  # no key is too long
        return df.withColumn("previous", F.lag(value).over(Window.partitionBy(*by).orderBy(order)))
    tails = cut.groupBy(*by, "block").agg(F.max_by(value, order).alias("tail"))
    carried = tails.select(*by, "block", F.lag("tail").over(blocks).alias("carried"))
    return (
        cut.withColumns({"inner": F.lag(value).over(inside), "row": F.row_number().over(inside)})
        .join(carried, [*by, "block"])
        .withColumn("previous", F.when(F.col("row") == 1, F.col("carried")).otherwise(F.col("inner")))
        .drop("block", "inner", "row", "carried")
    )


def rank_by(df: DataFrame, keys: list[str], order: list[Column], limits: dict[str, int] | int, market: str = "market") -> DataFrame:
    """Rank within the keys and keep the top rows, per-market limits allowed.

    The filter on the largest limit sits directly on ``row_number``, so each map
    task sends at most that many rows per key to the shuffle.
    """
    top = limits if isinstance(limits, int) else max(limits.values())
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    if isinstance(limits, int):
        return ranked
    allowed = F.lit(None).cast("int")
    for name, limit in limits.items():
        allowed = F.when(F.col(market) == name, limit).otherwise(allowed)
    return ranked.where(F.col("rank") <= allowed)
