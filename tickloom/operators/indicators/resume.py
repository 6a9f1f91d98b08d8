"""Indicators that go on from a stored state: new bars are computed without reading the old ones.

The state of a series is one row: how many bars it has, the newest of them that look-backs need, the
running values that the block scans carry, and the states of the sequential folds.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tickloom.operators.indicators.registry import PRICED, Cut, check_unique, compute, in_passes, with_volume
from tickloom.operators.indicators.spec import Indicator, ref
from tickloom.operators.indicators.stateful import Stateful
from tickloom.operators.series import BLOCK, SERIES, index_bars

TAIL = ("time_rounded", "open", "close", "high", "low", "volume")
HELD = ("n_bars", "tail", "carries", "folds")


def layout(indicators: Sequence[Indicator | Stateful]) -> str:
    """What a state belongs to: the outputs of each scan with their look-backs. Another list cannot go on from it."""
    passes, sequential = in_passes(indicators)
    scans = [[[list(x.outputs) for x in some], max(x.pre for x in some), max(x.post for x in some)] for some in passes]
    return json.dumps([scans, [list(x.outputs) for x in sequential]])


def look_back(indicators: Sequence[Indicator | Stateful]) -> int:
    """Bars before the first new one that the scans read."""
    passes, _ = in_passes(indicators)
    return max((max(x.pre for x in some) + max(x.post for x in some) for some in passes), default=0)


def extended_indicators(
    bars: DataFrame,
    indicators: Sequence[Indicator | Stateful],
    state: DataFrame | None = None,
    keys: Sequence[str] = SERIES,
    size: int = BLOCK,
    cut: Cut = lambda df: df,
) -> tuple[DataFrame, DataFrame]:
    """Outputs for the bars that ``state`` has not seen, and the state after them.

    Without a state every series starts; so do series that the state does not know, whose bars must all
    be given. Of the others only bars after the last one seen count; earlier ones are left out,
    so a series whose past bars were corrected has to be computed anew. Series without new bars keep
    their state. Bars without a price come back without indicators. A state of other indicators
    fails the job. Both results are made from the same frames, which ``cut`` may write to a table.
    """
    bars, keys = with_volume(bars), list(keys)
    outputs = [name for x in indicators for name in x.outputs]
    check_unique([*bars.columns, *outputs])
    names, wanted = bars.columns, layout(indicators)
    empty = F.lit(None).cast("string")
    if state is None:
        bars = cut(bars).withColumns({"_origin": F.lit(0).cast("bigint"), "_folds": empty})
    else:
        wrong = F.raise_error(F.lit("the state is of other indicators")).cast("bigint")
        known = state.select(*keys, F.when(F.col("layout") == wanted, F.col("n_bars")).otherwise(wrong).alias("_origin"), F.col("folds").alias("_folds"), F.col("last_time").alias("_seen"))
        joined = bars.join(known, keys, "left").where("_seen IS NULL OR time_rounded > _seen")
        bars = cut(joined.withColumn("_origin", F.coalesce("_origin", F.lit(0))).drop("_seen"))
    new = index_bars(bars.where(PRICED), keys).withColumns({"i": F.expr("i + _origin"), "n_bars": F.expr("n_bars + _origin")})
    full, carried = new, None
    if state is not None:
        lengths = new.groupBy(*keys).agg(F.max("n_bars").alias("_length"))
        tails = state.join(lengths, keys).selectExpr(*keys, "_length AS n_bars", "n_bars AS _origin", "inline(tail)")
        full, carried = new.unionByName(tails, allowMissingColumns=True), state.select(*keys, "carries")
    table, carries = compute(full, indicators, keys, size, "_origin", carried, ("_folds", "_left"), cut)
    if "_left" not in table.columns:
        table = table.withColumn("_left", empty)
    after = _state(bars, full, table, carries, state, keys, look_back(indicators)).withColumn("layout", F.lit(wanted))
    done = table.select(*[ref(c) for c in names], *[ref(c) for c in outputs])
    return done.unionByName(bars.where(f"NOT ({PRICED})").select(*names), allowMissingColumns=True), after


def _state(
    bars: DataFrame, full: DataFrame, table: DataFrame, carries: Sequence[DataFrame], state: DataFrame | None, keys: list[str], halo: int
) -> DataFrame:
    """One row per series; what this run did not touch is taken over."""
    row = F.struct("i", *TAIL)
    facts = full.groupBy(*keys).agg(
        F.max("n_bars").alias("n_bars"), F.array_sort(F.collect_list(F.when(F.col("i") >= F.col("n_bars") - halo, row))).alias("tail")
    )
    nothing = F.create_map().cast("map<string,double>")
    for k, held in enumerate(carries):
        facts = facts.join(held.withColumnRenamed("carries", f"_c{k}"), keys, "left")
    parts = [F.coalesce(f"_c{k}", nothing) for k in range(len(carries))]
    facts = facts.withColumn("carries", F.map_concat(*parts) if parts else nothing)
    ends = table.where("_left IS NOT NULL").select(*keys, F.col("_left").alias("folds"))
    facts = facts.join(ends, keys, "left").select(*keys, *HELD)
    times = bars.groupBy(*keys).agg(F.max("time_rounded").alias("last_time"))
    if state is None:
        merged = times.join(facts, keys, "left")
    else:
        old = state.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in (*HELD, "last_time")])
        merged = reduce(lambda a, b: a.join(b, keys, "full_outer"), (old, times, facts))
        merged = merged.withColumns({c: F.coalesce(c, f"_old_{c}") for c in (*HELD, "last_time")})
    return merged.select(
        *keys, "last_time", F.coalesce("n_bars", F.lit(0).cast("bigint")).alias("n_bars"),
        F.coalesce("tail", F.array().cast(facts.schema["tail"].dataType)).alias("tail"), F.coalesce("carries", nothing).alias("carries"), "folds",
    )
