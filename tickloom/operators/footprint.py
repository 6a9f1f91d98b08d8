"""Volume and trade count per price level and aggressor side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickloom.functions.expressions import concatenated_json_array, exact_sum, floor_ms, round_to, round_to_tick, trade_order
from tickloom.operators.bars import target_bars
from tickloom.schema import TICK_DECIMALS

BAR = ["symbol", "timeframe", "time_rounded"]
SIDES = ("bid", "ask")
LEVEL_MEASURES = [f"total_{side}_{what}" for side in SIDES for what in ("qty", "trades")]


def with_price_level(
    trades: DataFrame, ticks: Mapping[str, int] | DataFrame | None = None, decimals: int | None = None
) -> DataFrame:
    """Add ``price_level``: the price rounded to the tick of its symbol.

    ``ticks`` is a symbol-to-decimals mapping or a ``(symbol, decimals)`` frame (joined without a
    hint, so its measured size decides on a broadcast; fold trades by price before). ``decimals`` rounds every symbol alike.
    """
    if decimals is not None:
        return trades.withColumn("price_level", F.round("price", decimals))
    if isinstance(ticks, DataFrame):
        twice = F.raise_error(F.concat(F.lit("several tick sizes for symbol "), F.col("symbol"))).cast("int")
        one = F.when(F.count("*") == 1, F.max("decimals")).otherwise(twice).alias("_decimals")
        sized = trades.join(ticks.groupBy("symbol").agg(one), "symbol", "left")
        return sized.withColumn("price_level", round_to("price", "_decimals")).drop("_decimals")
    return trades.withColumn("price_level", round_to_tick("price", "symbol", TICK_DECIMALS if ticks is None else ticks))


def _complete() -> Column:
    return F.col("price").isNotNull() & F.col("quantity").isNotNull()


def _on(side: str) -> Column:
    """Buyer is maker: the seller aggressed and the trade hits the bid."""
    return F.col("is_buyer_maker") if side == "bid" else ~F.col("is_buyer_maker")


def side_sums(extra: Column | None = None) -> list[Column]:
    sums = []
    for side in SIDES:
        counted = _on(side) if extra is None else _on(side) & extra
        sums.append(exact_sum(F.when(counted, F.col("quantity")).otherwise(0.0)).alias(f"total_{side}_qty"))
        sums.append(F.count_if(counted).alias(f"total_{side}_trades"))
    return sums


def added(measures: Sequence[str]) -> list[Column]:
    """Level measures summed: quantities exactly, counts as they are."""
    return [(exact_sum(m) if m.endswith("_qty") else F.sum(m)).alias(m) for m in measures]


def footprint_levels(
    trades: DataFrame,
    timeframe: str,
    ticks: Mapping[str, int] | DataFrame | None = None,
    decimals: int | None = None,
    trades_aggr: bool = False,
) -> DataFrame:
    """Long footprint: one row per ``(symbol, time_rounded, price_level)`` with both sides.

    Trades without price, quantity, side or time are left out. A side that did not trade at the level is
    zero. ``trades_aggr`` adds the per-side count of aggregated trades.
    """
    known = trades.where(_complete() & F.col("is_buyer_maker").isNotNull() & F.col("transact_time").isNotNull())
    sums = side_sums()
    if trades_aggr:
        sums += [F.sum(F.when(_on(side), 1).otherwise(0)).alias(f"total_{side}_trades_aggr") for side in SIDES]
    bar = floor_ms("transact_time", timeframe).alias("bar_ms")
    if isinstance(ticks, DataFrame) and decimals is None:
        # Folded by price first: what meets the tick table is as small as the raw levels, however hot a symbol is.
        raw = known.groupBy("symbol", bar, "price").agg(*sums)
        measures = [c for c in raw.columns if c.startswith("total_")]
        levels = with_price_level(raw, ticks).groupBy("symbol", "bar_ms", "price_level").agg(*added(measures))
    else:
        levels = with_price_level(known, ticks, decimals).groupBy("symbol", bar, "price_level").agg(*sums)
        measures = [c for c in levels.columns if c.startswith("total_")]
    return levels.select(
        "symbol",
        F.lit(timeframe).alias("timeframe"),
        F.timestamp_millis("bar_ms").alias("time_rounded"),
        "price_level",
        *measures,
    )


def rollup_levels(levels: DataFrame, source: str, *targets: str) -> DataFrame:
    """Re-aggregate a long footprint to longer timeframes in one pass."""
    measures = [c for c in levels.columns if c.startswith("total_")]
    return (
        levels.select("*", F.inline(target_bars(source, targets)))
        .groupBy("symbol", "target", "bar_ms", "price_level")
        .agg(*added(measures))
        .select(
            "symbol",
            F.col("target").alias("timeframe"),
            F.timestamp_millis("bar_ms").alias("time_rounded"),
            "price_level",
            *measures,
        )
    )


def side_totals(levels: DataFrame) -> DataFrame:
    """Quantity and trades per bar and side."""
    return levels.groupBy(*BAR).agg(
        *[exact_sum(f"total_{side}_qty").alias(f"sum_total_{side}_qty") for side in SIDES],
        *[F.sum(f"total_{side}_trades").alias(f"sum_total_{side}_trades") for side in SIDES],
    )


def side_footprint(levels: DataFrame, side: str) -> DataFrame:
    """Per bar, the levels of one side as ``array<map<string, struct>>`` in price order.

    One array entry per level of the bar: the size is that of the result the caller asked for.
    """
    entry = F.struct(
        F.col("price_level"),
        F.struct(
            F.col(f"total_{side}_qty").alias(f"{side}_qty"),
            F.col(f"total_{side}_trades").cast("double").alias(f"{side}_trades"),
        ).alias("cell"),
    )
    traded = levels.where(F.col(f"total_{side}_trades") > 0)
    return traded.groupBy(*BAR).agg(
        F.transform(
            F.array_sort(F.collect_list(entry)),
            lambda e: F.create_map(e["price_level"].cast("string"), e["cell"]),
        ).alias(f"aggregated_foot_{side}")
    )


def _cell() -> Column:
    return F.struct(
        F.col("total_bid_qty").alias("bid_qty"),
        F.col("total_bid_trades").cast("double").alias("bid_trades"),
        F.col("total_ask_qty").alias("ask_qty"),
        F.col("total_ask_trades").cast("double").alias("ask_trades"),
    )


def _as_map(entries: Column) -> Column:
    keyed = F.transform(entries, lambda e: F.struct(e["price_level"].cast("string"), e["cell"]))
    return F.map_from_entries(keyed)


def map_of_levels() -> Column:
    """Aggregate of levels to ``map<price, struct<bid_qty, bid_trades, ask_qty, ask_trades>>`` in price order."""
    entry = F.struct(F.col("price_level"), _cell().alias("cell"))
    return _as_map(F.array_sort(F.collect_list(entry))).alias("footprint")


def footprint_map(levels: DataFrame) -> DataFrame:
    """The footprint map of each bar."""
    return levels.groupBy(*BAR).agg(map_of_levels())


def bars_with_footprint(
    trades: DataFrame,
    timeframe: str,
    ticks: Mapping[str, int] | DataFrame | None = None,
    decimals: int | None = None,
    wide_ids: bool = False,
) -> DataFrame:
    """Final bars (OHLCV, side totals, footprint map) in one pass over the tape, without joins.

    Trades fold to levels first, so the second step moves levels, never trades, and a hot symbol is
    spread over its levels. Rows without a price sit on a null level: they count for the bar's
    quantity but not for its footprint.
    """
    timed, bar = trades.where(F.col("transact_time").isNotNull()), floor_ms("transact_time", timeframe).alias("bar_ms")
    if isinstance(ticks, DataFrame) and decimals is None:
        raw = timed.groupBy("symbol", bar, "price").agg(*level_partials(timeframe, wide_ids))
        levels = with_price_level(raw, ticks).groupBy("symbol", "bar_ms", "price_level").agg(*merged_partials())
    else:
        levels = with_price_level(timed, ticks, decimals).groupBy("symbol", bar, "price_level").agg(*level_partials(timeframe, wide_ids))
    bars = levels.groupBy("symbol", "bar_ms").agg(*bars_of_partials())
    return bars.select("symbol", F.lit(timeframe).alias("timeframe"), F.timestamp_millis("bar_ms").alias("time_rounded"), *FINAL)


FINAL = ("open", "close", "high", "low", "qty", "sum_total_bid_qty", "sum_total_ask_qty", "footprint")


def level_partials(timeframe: str, wide_ids: bool = False) -> list[Column]:
    """What a price level of a bar hands on to the final bar."""
    order = trade_order("transact_time", "agg_trade_id", timeframe, wide_ids)
    priced = F.when(F.col("price").isNotNull(), order)
    usable = _complete() & F.col("is_buyer_maker").isNotNull()
    return [
        *side_sums(_complete()),
        F.count_if(usable).alias("usable"),
        F.min_by("price", priced).alias("first_price"),
        F.min(priced).alias("first_key"),
        F.max_by("price", priced).alias("last_price"),
        F.max(priced).alias("last_key"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        exact_sum("quantity").alias("qty"),
    ]


def merged_partials() -> list[Column]:
    """Partials of several prices as those of the level they belong to."""
    return [
        *added(LEVEL_MEASURES),
        F.sum("usable").alias("usable"),
        F.min_by("first_price", "first_key").alias("first_price"),
        F.min("first_key").alias("first_key"),
        F.max_by("last_price", "last_key").alias("last_price"),
        F.max("last_key").alias("last_key"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        exact_sum("qty").alias("qty"),
    ]


def bars_of_partials() -> list[Column]:
    """The final bar from the partials of its levels."""
    entry = F.when(F.col("usable") > 0, F.struct(F.col("price_level"), _cell().alias("cell")))
    return [
        F.min_by("first_price", "first_key").alias("open"),
        F.max_by("last_price", "last_key").alias("close"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        exact_sum("qty").alias("qty"),
        exact_sum("total_bid_qty").alias("sum_total_bid_qty"),
        exact_sum("total_ask_qty").alias("sum_total_ask_qty"),
        _as_map(F.array_sort(F.collect_list(entry))).alias("footprint"),
    ]


def join_side_frames(bars: DataFrame, levels: DataFrame) -> DataFrame:
    """Bars full-outer-joined with both side totals and both side footprints.

    Kept as a cross-check of :func:`bars_with_footprint`, which gives the same bars without a join.
    """
    totals = {
        side: levels.where(F.col(f"total_{side}_trades") > 0)
        .groupBy(*BAR)
        .agg(exact_sum(f"total_{side}_qty").alias(f"sum_total_{side}_qty"))
        for side in SIDES
    }
    out = bars
    for frame in (totals["bid"], totals["ask"], side_footprint(levels, "bid"), side_footprint(levels, "ask")):
        out = out.join(frame, BAR, "full_outer")
    return out.fillna(0.0, [f"sum_total_{side}_qty" for side in SIDES])


def explode_footprint(bars: DataFrame, column: str = "footprint") -> DataFrame:
    """Long form of a footprint map."""
    cells = bars.select(*BAR, F.explode(column).alias("price", "cell"))
    return cells.select(
        *BAR,
        F.col("price").cast("double").alias("price_level"),
        *[F.coalesce(F.col(f"cell.{side}_qty"), F.lit(0.0)).alias(f"total_{side}_qty") for side in SIDES],
        *[F.coalesce(F.col(f"cell.{side}_trades"), F.lit(0.0)).alias(f"total_{side}_trades") for side in SIDES],
    )


def retick_levels(levels: DataFrame, decimals: int = 0) -> DataFrame:
    """Merge the levels of a long footprint that round to the same price."""
    return (
        levels.withColumn("price_level", F.round("price_level", decimals))
        .groupBy(*BAR, "price_level")
        .agg(*added(LEVEL_MEASURES))
    )


def retick_footprint(bars: DataFrame, decimals: int = 0) -> DataFrame:
    """Footprint maps at a coarser tick, entries in descending price."""
    entry = F.struct(F.col("price_level"), _cell().alias("cell"))
    merged = retick_levels(explode_footprint(bars), decimals).groupBy(*BAR).agg(
        _as_map(F.sort_array(F.collect_list(entry), asc=False)).alias("footprint")
    )
    return bars.drop("footprint").join(merged, BAR, "left")


def flatten_maps(maps: str | Column) -> Column:
    """One map out of an array of maps; a later map wins on equal keys."""
    maps = F.col(maps) if isinstance(maps, str) else maps
    entries = F.flatten(F.transform(maps, F.map_entries))
    placed = F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"), e["value"].alias("value")))
    # Sorted by key and place, the last of a key is the one whose follower has another key. The sorted array is the
    # argument of a function, as an expression that a function over an array names would be evaluated for each element.
    last = F.transform(
        F.array(F.array_sort(placed)), lambda ranked: F.filter(ranked, lambda e, i: F.coalesce(F.get(ranked, i + 1)["key"] != e["key"], F.lit(True)))
    )[0]
    ordered = F.array_sort(F.transform(last, lambda e: F.struct(e["i"].alias("i"), e["key"].alias("key"), e["value"].alias("value"))))
    return F.map_from_entries(F.transform(ordered, lambda e: F.struct(e["key"], e["value"])))


def explode_concatenated_json(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """One row per JSON object of a text column holding objects written back to back."""
    others = [c for c in df.columns if c != column]
    rows = df.select(*others, F.explode(concatenated_json_array(column, schema)).alias("_o"))
    return rows.select(*others, "_o.*")
