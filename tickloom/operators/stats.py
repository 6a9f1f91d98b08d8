"""Summaries of trades, timings and activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.expressions import floor_ms
from tickloom.operators.prepare import in_universe


def trade_summary(trades: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Counts, volume, notional, means and extremes of the trades per key.

    Notional and means go through wide decimals, so they do not depend on the order of rows: prices
    below 1e20 with 18 places, quantities below 1e26 and notionals below 1e26 with 12 places; larger ones fail
    the job. Notionals under 1e-12 are added apart, as doubles.
    """
    price, quantity = F.col("price").cast("decimal(38,18)"), F.col("quantity").cast("decimal(38,12)")
    product = F.col("price") * F.col("quantity")
    tiny = F.abs(product) < 1e-12
    notional, rest = F.when(~tiny, product.cast("decimal(38,12)")), F.when(tiny, product)
    return trades.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_trades"),
        F.sum("quantity").alias("total_volume"),
        F.coalesce(F.sum(notional).cast("double") + F.coalesce(F.sum(rest), F.lit(0.0)), F.sum(rest)).alias("total_value"),
        (F.sum(price).cast("double") / F.count(price)).alias("average_price"),
        (F.sum(quantity).cast("double") / F.count(quantity)).alias("average_quantity"),
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
        F.count_if(F.col("is_buyer_maker")).alias("buyer_market_trades"),
        F.count_if(~F.col("is_buyer_maker")).alias("seller_market_trades"),
    )


#: The sketch misses a rank by one in so many at most, and the bracket is cut into so many buckets.
RANK_ACCURACY, RANK_BUCKETS = 10_000, 1024


def _bracket(value: Column, accuracy: int = RANK_ACCURACY) -> Column:
    """Two values of the column that surely hold the middle ranks between them, from a mergeable quantile sketch."""
    return F.percentile_approx(value, [0.5 - 2 / accuracy, 0.5 + 2 / accuracy], accuracy)


def _median_in_bracket(values: DataFrame, low: Column, high: Column, total: Column, buckets: int = RANK_BUCKETS) -> DataFrame:
    """One row, column ``median``, of the column ``v``: what lies below the bracket is counted, only what lies inside is kept.

    Equal values are folded before the shuffle. Ranks inside come from counts of ``buckets`` equal parts, and only
    the parts that hold a middle rank are ordered.
    """
    inside = F.when(F.col("v") >= low, F.col("v")).alias("v")
    counts = values.where(F.col("v") <= high).groupBy(inside).agg(F.count("*").alias("n"))
    part = F.least(F.floor(F.coalesce(F.try_divide(F.col("v") - low, high - low), F.lit(0.0)) * buckets), F.lit(buckets - 1))
    counts = counts.withColumn("part", F.when(F.col("v").isNull(), F.lit(-1)).otherwise(part).cast("int"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # of at most buckets + 1 rows
    parts = counts.groupBy("part").agg(F.sum("n").alias("held")).withColumn("before", F.coalesce(F.sum("held").over(ahead), F.lit(0)))
    ranks = {"lo": F.floor((total + 1) / 2).cast("bigint"), "hi": (F.floor(total / 2) + 1).cast("bigint")}
    parts = parts.withColumns(ranks).where("part >= 0")
    holds = [(F.col("before") < F.col(r)) & (F.col(r) <= F.col("before") + F.col("held")) for r in ranks]
    middle = counts.join(parts.where(holds[0] | holds[1]), "part")
    ranked = middle.withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy("part").orderBy("v")))
    at = [F.max(F.when((F.col("upto") >= F.col(r)) & (F.col("upto") - F.col("n") < F.col(r)), F.col("v"))) for r in ranks]
    found = ranked.agg(((at[0] + at[1]) / 2).alias("median"))
    missed = F.raise_error(F.lit("the bracket of the quantile sketch misses the middle")).cast("double")
    return found.select(F.when(F.col("median").isNotNull() | (total == 0), F.col("median")).otherwise(missed).alias("median"))


def exact_median(df: DataFrame, value: str) -> DataFrame:
    """Median of a whole column without sorting it in one task; one row, column ``median``.

    The builtin exact percentile keeps every distinct value of a group in one buffer. Here a first scan
    makes a sketch, whose error bound gives a bracket around the middle, and a second one counts what
    lies below it and keeps what lies inside (a few in 10,000 rows, equal values folded).
    """
    values = df.where(F.col(value).isNotNull()).select(F.col(value).alias("v"))
    facts = values.agg(F.struct(_bracket(F.col("v")).alias("q"), F.count("*").alias("n"))).scalar()
    return _median_in_bracket(values, facts["q"][0], facts["q"][1], facts["n"])


def _span(df: DataFrame, value: str) -> tuple[Column, Column]:
    """Smallest and largest value, from one scalar subquery."""
    span = df.agg(F.struct(F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high"))).scalar()
    return span.getField("low"), span.getField("high")


def timing_stats(log: DataFrame, elapsed: str = "elapsed_time", trades: str = "trade_count") -> DataFrame:
    """Mean, exact median, population deviation and extremes of call times, and trade totals; two scans."""
    facts = log.agg(
        F.struct(
            F.avg(elapsed).alias("mean_time"),
            F.stddev_pop(elapsed).alias("std_dev_time"),
            F.min(elapsed).alias("min_time"),
            F.max(elapsed).alias("max_time"),
            F.sum(trades).alias("total_trades"),
            F.avg(trades).alias("mean_trades_per_call"),
            _bracket(F.col(elapsed)).alias("q"),
            F.count(elapsed).alias("n"),
        )
    ).scalar()
    values = log.where(F.col(elapsed).isNotNull()).select(F.col(elapsed).alias("v"))
    median = _median_in_bracket(values, facts["q"][0], facts["q"][1], facts["n"])
    names = ["mean_time", "std_dev_time", "min_time", "max_time", "total_trades", "mean_trades_per_call"]
    return median.select(*[facts[c].alias(c) for c in names], F.col("median").alias("median_time"))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Rows per equal-width bin between the smallest and largest value; the last bin is closed.

    Every bin is present, also the empty ones.
    """
    low, high = _span(df, value)
    share = F.coalesce(F.try_divide(F.col(value) - low, high - low), F.lit(0.0))
    number = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("bigint")
    counted = df.where(F.col(value).isNotNull()).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    filled = every.join(counted, "bin", "left")
    return filled.select(
        "bin",
        (low + (high - low) * F.col("bin") / bins).alias("bin_start"),
        (low + (high - low) * (F.col("bin") + 1) / bins).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def rate_per_minute(trades: DataFrame) -> DataFrame:
    """Messages per symbol and minute."""
    return trades.groupBy("symbol", floor_ms("transact_time", "1m").alias("minute_ms")).agg(
        F.count(F.lit(1)).alias("n")
    )


def last_seen(trades: DataFrame, now_ms: int | None = None) -> DataFrame:
    """Newest trade time per symbol; with ``now_ms`` also how long ago that was."""
    out = trades.groupBy("symbol").agg(F.max("transact_time").alias("last_ms"))
    return out if now_ms is None else out.withColumn("stale_ms", F.lit(now_ms) - F.col("last_ms"))


def symbols(trades: DataFrame) -> DataFrame:
    return trades.select("symbol").distinct()


def universe_top_n(tickers: DataFrame, metrics: Sequence[str], n: int = 50, only_usdt: bool = True) -> DataFrame:
    """The n first symbols by the metrics, all descending; a missing metric counts as 0.

    The symbol breaks remaining ties so that the choice is repeatable.
    """
    for metric in metrics:
        value = F.col(metric).try_cast("double") if metric in tickers.columns else F.lit(0.0)
        tickers = tickers.withColumn(metric, F.coalesce(value, F.lit(0.0)))
    kept = tickers.where(in_universe()) if only_usdt else tickers
    return kept.orderBy(*[F.col(m).desc() for m in metrics], "symbol").limit(n)


def latest_minutes(trades: DataFrame, n: int) -> DataFrame:
    """Trades of the n newest minutes that have any, over all symbols.

    These are all trades from the start of the nth newest minute on, so there is no join: distinct minutes are reduced
    in the map tasks, n of them are kept per task, and their first bounds the time as a scalar subquery, which a Parquet scan
    takes as a pushed filter. A minute without trades does not count. For a landed table ``read_latest_minutes`` names the
    folders instead.
    """
    minute = floor_ms("transact_time", "1m")
    newest = trades.select(minute.alias("minute_ms")).distinct().orderBy(F.col("minute_ms").desc()).limit(n)
    first = newest.agg(F.min("minute_ms")).scalar()
    return trades.where(F.col("transact_time") >= first).withColumn("minute_ms", minute)


def latest_minutes_for(trades: DataFrame, timeframe: str) -> DataFrame:
    """Newest minutes needed by a timeframe: 5 for 5m, 15 for 15m, 60 for 1h."""
    counts = {"1m": 1, "5m": 5, "15m": 15, "30m": 30, "1h": 60}
    if timeframe not in counts:
        raise ValueError(f"unsupported timeframe {timeframe!r}")
    return latest_minutes(trades, counts[timeframe])


