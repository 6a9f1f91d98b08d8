"""The historical flow: tape to final bars, and bars to the analysis table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions.expressions import exact_sum
from tickloom.operators import footprint, profile
from tickloom.operators.bars import rollup_bars
from tickloom.operators.lifecycle import pending
from tickloom.operators.series import SERIES, index_bars
from tickloom.plans.stage import staged
from tickloom.schema import TIMEFRAMES, timeframe_ms
from tickloom.sinks import files
from tickloom.sinks.writers import write_bars
from tickloom.sources.readers import read_daily_trades

EPOCH = date(1970, 1, 1).toordinal()


def whole_weeks(start: str, end: str) -> tuple[str, str]:
    """A range of days widened to whole epoch weeks (Thursday to Wednesday)."""
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    first -= timedelta((first.toordinal() - EPOCH) % 7)
    last += timedelta((EPOCH - 1 - last.toordinal()) % 7)
    return first.isoformat(), last.isoformat()


def final_bars(base: DataFrame, finest: str, timeframes: Sequence[str]) -> DataFrame:
    """Final bars of several timeframes out of those of the finest; ``base`` should be a table, as it is read twice."""
    levels = footprint.rollup_levels(footprint.explode_footprint(base), finest, *timeframes)
    totals = [exact_sum(f"total_{side}_qty").alias(f"sum_total_{side}_qty") for side in footprint.SIDES]
    measured = levels.groupBy(*footprint.BAR).agg(*totals, footprint.map_of_levels())
    joined = rollup_bars(base, finest, *timeframes).join(measured, footprint.BAR, "left")
    none = F.create_map().cast(base.schema["footprint"].dataType)
    return joined.fillna(0.0, [f"sum_total_{side}_qty" for side in footprint.SIDES]).withColumn("footprint", F.coalesce("footprint", none)).select(*base.columns)


COMPLETED = "symbol string, timeframe string, first string, last string"


def historical_bars(
    spark: SparkSession,
    base: str,
    out: str,
    symbols: Sequence[str],
    start: str,
    end: str,
    timeframes: Sequence[str] = ("4h",),
    ticks: Mapping[str, int] | None = None,
) -> DataFrame:
    """Write final bars per symbol, timeframe and day of a range of the tape; other days stay.

    What was completed for this range before (``<out>_completed``) is left out. The tape of the others is
    folded once, at the finest timeframe; the rest is rolled up from that table. A weekly bar needs its
    whole week, so if weeks are asked for, the fold covers whole weeks. Returns what was done.
    """
    record = f"{out}_completed"
    asked = spark.createDataFrame([(s, t, start, end) for s in symbols for t in timeframes], COMPLETED)
    done = spark.read.schema(COMPLETED).parquet(record) if files.exists(spark, record) else asked.limit(0)
    todo = pending(asked, done, ["symbol", "timeframe", "first", "last"]).collect()
    now = spark.createDataFrame(todo, COMPLETED)
    if not todo:
        return now
    wanted = sorted({r.timeframe for r in todo}, key=timeframe_ms)
    first, last = whole_weeks(start, end) if "1w" in wanted else (start, end)
    trades = read_daily_trades(spark, base, sorted({r.symbol for r in todo}), first, last)
    finest = max((t for t in TIMEFRAMES if all(timeframe_ms(w) % timeframe_ms(t) == 0 for w in wanted)), key=timeframe_ms)
    folded = staged(footprint.bars_with_footprint(trades, finest, ticks))
    day = F.col("time_rounded").cast("date")
    inside = (F.col("timeframe") == "1w") | day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    bars = final_bars(folded, finest, wanted).where(inside).join(now.select("symbol", "timeframe"), ["symbol", "timeframe"], "left_semi")
    write_bars(bars, out, whole_days=True)
    now.write.mode("append").parquet(record)
    return now


def analysis_table(bars: DataFrame, levels: DataFrame) -> DataFrame:
    """One row per bar with delta, imbalance, level means, POC, value area and the cluster labels of both sides.

    ``bars`` and ``levels`` should be tables (or staged), since each is read by several measures. One
    index over all bars, also those without levels, serves the bars, the profile and the clusters.
    """
    totals = profile.delta_columns(levels.groupBy(*footprint.BAR).agg(*profile.totals_of_levels(), *profile.means_of_levels())).drop("i")
    clusters = profile.cluster_maps(levels, profile.volume_clusters(levels, of=bars))
    measures = [totals, profile.top_level_imbalance(levels), clusters]
    out = index_bars(bars).drop("n_bars")
    for frame in measures:
        out = out.join(frame, footprint.BAR, "left")
    return out.join(profile.poc_value_area(levels, of=bars), [*SERIES, "i"], "left")
