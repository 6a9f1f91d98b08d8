"""OHLCV time bars and their roll-up to longer timeframes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.expressions import exact_sum, floor_ms, trade_order
from tickloom.schema import timeframe_ms


def bar_aggregates(timeframe: str, wide_ids: bool = False) -> list[Column]:
    """Open, close, high, low and quantity of the trades of a bar, as partial aggregates; the same for tables and streams."""
    # The key of a row without a price is null, so min_by and max_by skip that row.
    priced = F.when(F.col("price").isNotNull(), trade_order("transact_time", "agg_trade_id", timeframe, wide_ids))
    return [
        F.min_by("price", priced).alias("open"),
        F.max_by("price", priced).alias("close"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        exact_sum("quantity").alias("qty"),
    ]


def ohlcv(trades: DataFrame, timeframe: str, wide_ids: bool = False) -> DataFrame:
    """One row per ``(symbol, time_rounded)`` with open, close, high, low and quantity.

    Open and close are the first and last trade by (time, id), found without sorting. All five are
    partial aggregates, so a symbol holding most of the tape is reduced before the shuffle. Trades
    without a time belong to no bar.
    """
    timed = trades.where(F.col("transact_time").isNotNull())
    bars = timed.groupBy("symbol", floor_ms("transact_time", timeframe).alias("bar_ms")).agg(*bar_aggregates(timeframe, wide_ids))
    return bars.select(
        "symbol",
        F.lit(timeframe).alias("timeframe"),
        F.timestamp_millis("bar_ms").alias("time_rounded"),
        "open",
        "close",
        "high",
        "low",
        "qty",
    )


def check_multiple(source: str, target: str) -> None:
    """A roll-up is exact only when the target width is a multiple of the source width."""
    if timeframe_ms(target) % timeframe_ms(source):
        raise ValueError(f"{target} is not a multiple of {source}")


def rollup_bars(bars: DataFrame, source: str, *targets: str) -> DataFrame:
    """Re-aggregate bars to longer timeframes; equals building those bars from the trades.

    Several targets share one pass: each bar is placed in its bar of every target.
    """
    return (
        bars.select("*", F.inline(target_bars(source, targets)))
        .groupBy("symbol", "target", "bar_ms")
        .agg(
            F.min_by("open", F.when(F.col("open").isNotNull(), F.col("time_rounded"))).alias("open"),
            F.max_by("close", F.when(F.col("close").isNotNull(), F.col("time_rounded"))).alias("close"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            exact_sum("qty").alias("qty"),
        )
        .select(
            "symbol",
            F.col("target").alias("timeframe"),
            F.timestamp_millis("bar_ms").alias("time_rounded"),
            "open",
            "close",
            "high",
            "low",
            "qty",
        )
    )


def target_bars(source: str, targets: Sequence[str]) -> Column:
    """Array of ``(target, bar_ms)``: the bars of longer timeframes a bar falls into."""
    for target in targets:
        check_multiple(source, target)
    start = F.unix_millis("time_rounded")
    return F.array(
        *[F.struct(F.lit(t).alias("target"), floor_ms(start, t).alias("bar_ms")) for t in targets]
    )


def bars_for_timeframes(trades: DataFrame, timeframes: Sequence[str], wide_ids: bool = False) -> DataFrame:
    """Bars of several timeframes from one pass over the tape.

    The tape is folded once at the finest timeframe; the others come from those bars, whose number
    is bounded by the calendar.
    """
    finest = min(timeframes, key=timeframe_ms)
    return rollup_bars(ohlcv(trades, finest, wide_ids), finest, *timeframes)
