"""Keeping a table of indicators up to date with the bars it is made from."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.operators.indicators.registry import CATALOGUE, build_all
from tickloom.operators.indicators.resume import extended_indicators
from tickloom.operators.series import SERIES
from tickloom.plans.stage import staged
from tickloom.sinks import files


def _versions(spark: SparkSession, base: str) -> list[int]:
    """Complete versions; the state of a version is written after its rows."""
    found = [int(m[1]) for c in files.children(spark, f"{base}/state") if (m := re.fullmatch(r"version=(\d+)", c))]
    return sorted(v for v in found if files.exists(spark, f"{base}/state/version={v}/_SUCCESS"))


def read_indicator_table(spark: SparkSession, base: str) -> DataFrame:
    """Rows of all complete extensions."""
    newest = max(_versions(spark, base))
    return spark.read.option("basePath", f"{base}/rows").parquet(f"{base}/rows").where(F.col("version") <= newest).drop("version")


def read_indicator_state(spark: SparkSession, base: str) -> DataFrame | None:
    done = _versions(spark, base)
    return spark.read.parquet(f"{base}/state/version={done[-1]}") if done else None


def unseen(bars: DataFrame, state: DataFrame) -> DataFrame:
    """Bars that may be new to ``state``, by a bound for each timeframe that is pushed down to the scan.

    The bound is the oldest last bar of the timeframe's series (as many bounds as there are timeframes). A
    series that the state does not know is read from its beginning, provided it has a bar behind the bound.
    """
    bounds = state.groupBy("timeframe").agg(F.min("last_time").alias("t")).collect()
    # One scan for each, so that its time bound is pushed down whether the timeframe is a partition or a column.
    recent = bars.where(~F.col("timeframe").isin([r.timeframe for r in bounds]))
    for r in bounds:
        recent = recent.unionByName(bars.where((F.col("timeframe") == r.timeframe) & (F.col("time_rounded") > F.lit(r.t))))
    keys = list(SERIES)
    starting = staged(recent.select(*keys).distinct().join(state.select(*keys), keys, "left_anti"))
    if starting.isEmpty():
        return recent
    return recent.join(starting, keys, "left_anti").unionByName(bars.join(starting, keys, "left_semi"))


def extend_indicator_table(
    spark: SparkSession, bars: DataFrame, base: str, config: Sequence[Mapping[str, Any]] = CATALOGUE
) -> dict[str, str]:
    """Bring the indicator table below ``base`` up to date with ``bars``; returns the failed entries by name.

    Only bars after those already seen are read and computed; what they need of the others is in the
    stored state. Every extension is a version of its own: its rows are written first and its state last, so
    one that was cut off is not seen by readers and is written again by the next call. Older states are
    dropped when the new one is complete.
    """
    indicators, failed = build_all(config)
    done = _versions(spark, base)
    state = read_indicator_state(spark, base)
    new = bars if state is None else unseen(bars, state)
    rows, after = extended_indicators(new, indicators, state, cut=staged)
    version = done[-1] + 1 if done else 1
    rows.hint("rebalance", *[F.col(k) for k in SERIES]).write.mode("overwrite").parquet(f"{base}/rows/version={version}")
    after.write.mode("overwrite").parquet(f"{base}/state/version={version}")
    for old in done:
        files.delete(spark, f"{base}/state/version={old}")
    return failed
