"""Volume-profile analytics over the long footprint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tickloom.functions.expressions import col, exact_sum
from tickloom.operators.footprint import BAR, SIDES
from tickloom.operators.indicators.recurrent import ema_alpha, from_rank, row_rank, smooth
from tickloom.operators.series import BLOCK, SERIES, Recurrence, in_blocks, index_bars, running_total

# Defaults of the analysis.
PROFILE_BARS = 40
PROFILE_BLOCK = 64
VALUE_AREA_SHARE = 0.4
CLUSTER_BARS = 50
CLUSTER_FACTOR = 0.005
DELTA_SCALE = 10_000
TOP_LEVELS = 3


def top_level_imbalance(levels: DataFrame, top: int = TOP_LEVELS) -> DataFrame:
    """``delta_x``: sum of the largest ask quantities of a bar minus that of the bid quantities.

    The rank filter is applied per map task before the shuffle (window group limit), so only ``top``
    rows per task, bar and side move, however many levels a bar has.
    """
    sides = levels.select(
        *BAR,
        F.inline(
            F.array(
                *[F.struct(F.lit(s).alias("side"), F.col(f"total_{s}_qty").alias("side_qty")) for s in SIDES]
            )
        ),
    )
    best = Window.partitionBy(*BAR, "side").orderBy(F.col("side_qty").desc_nulls_last())
    ranked = sides.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    signed = F.when(F.col("side") == "ask", F.col("side_qty")).otherwise(-F.col("side_qty"))
    return ranked.groupBy(*BAR).agg(F.coalesce(F.sum(signed), F.lit(0.0)).alias("delta_x"))


def means_of_levels() -> list[Column]:
    """Aggregates of levels to the mean quantity per level: bid, ask and both."""
    return [
        F.avg("total_bid_qty").alias("bid_average"),
        F.avg("total_ask_qty").alias("ask_average"),
        F.avg(F.col("total_bid_qty") + F.col("total_ask_qty")).alias("bid_ask_average"),
    ]


def level_means(levels: DataFrame) -> DataFrame:
    """Mean quantity per level of a bar."""
    return levels.groupBy(*BAR).agg(*means_of_levels())


def totals_of_levels() -> list[Column]:
    """Aggregates of levels to quantity and trades: ``bid, ask, bid_trades, ask_trades``."""
    return [
        *[exact_sum(f"total_{s}_qty").alias(s) for s in SIDES],
        *[F.sum(f"total_{s}_trades").alias(f"{s}_trades") for s in SIDES],
    ]


def bar_totals(levels: DataFrame) -> DataFrame:
    """Quantity and trades per bar."""
    return levels.groupBy(*BAR).agg(*totals_of_levels())


def delta_columns(totals: DataFrame, ema_length: int = 9, size: int = BLOCK) -> DataFrame:
    """Add delta, cumulative delta and the EMAs of both sides with their difference."""
    indexed = index_bars(totals)
    delta = F.col("ask") - F.col("bid")
    blocks = in_blocks(indexed, size=size)
    alpha = ema_alpha(ema_length)
    scanned = blocks.scan(
        {
            "_total": Recurrence("ask - bid"),
            **{f"_{s}": smooth(s, ema_length, alpha, row_rank()) for s in SIDES},
        }
    ).rows()
    return scanned.withColumns(
        {
            "delta": delta,
            "cumulative_delta": F.col("_total") / DELTA_SCALE,
            "delta_bid": from_rank(ema_length, "_bid", row_rank()),
            "delta_ask": from_rank(ema_length, "_ask", row_rank()),
            "delta_ema": from_rank(ema_length, "_ask - _bid", row_rank()),
        }
    ).drop("_total", "_bid", "_ask", "n_bars")


def cumulative_delta(totals: DataFrame, size: int = BLOCK) -> DataFrame:
    """Add ``delta`` and ``cumulative_delta`` only."""
    delta = F.col("ask") - F.col("bid")
    summed = running_total(index_bars(totals), {"_total": "ask - bid"}, size=size)
    return summed.withColumns({"delta": delta, "cumulative_delta": F.col("_total") / DELTA_SCALE}).drop(
        "_total", "n_bars"
    )


def bar_index(levels: DataFrame, bars: DataFrame | None = None) -> DataFrame:
    """Bars with their index and the number of bars of their series.

    The index counts ``bars``, also those without levels; without ``bars``, the bars that have levels.
    """
    return index_bars((levels if bars is None else bars).select(*BAR).distinct())


def with_bar_index(levels: DataFrame, bars: DataFrame | None = None) -> DataFrame:
    """Give each level row the index of its bar and the number of bars of its series."""
    return levels.join(bar_index(levels, bars), BAR)


def profile_runs(indexed: DataFrame, bars: int = PROFILE_BARS, size: int = PROFILE_BLOCK) -> DataFrame:
    """Runs of bars over which a price has the same volume of the last ``bars`` bars, by block of bars.

    A level row changes the volume of its price twice: at its own bar and ``bars`` later. Between two changes
    nothing moves, so a price has at most two runs per level row, whatever ``bars`` is. Level rows go to
    the block of their bar, and the few before a block to that one too; from there on everything stays in
    the block's task. Columns: series, _block, price_level, volume, first_bar (oldest bar with the price), from_bar, to_bar.
    """
    volume = F.col("total_bid_qty") + F.col("total_ask_qty")
    narrow = indexed.select(*SERIES, "i", "n_bars", "price_level", volume.alias("volume"))
    placed = in_blocks(narrow, pre=bars - 1, size=size).df.repartition(*SERIES, "_block")
    both = F.expr(f"inline(array(struct(i AS at, volume AS added, i AS bar), struct(i + {bars} AS at, double(null) AS added, bigint(null) AS bar)))")
    changes = placed.select(*SERIES, "_block", "n_bars", "price_level", both)
    price = Window.partitionBy(*SERIES, "_block", "price_level").orderBy("at")
    recent = price.rangeBetween(1 - bars, 0)
    runs = changes.select(
        *SERIES, "_block", "price_level",
        F.sum("added").over(recent).alias("volume"),
        F.min("bar").over(recent).alias("first_bar"),
        # Bars of the block itself that have a full history.
        F.greatest("at", F.col("_block") * size, F.lit(bars + 1)).alias("from_bar"),
        F.least(F.coalesce(F.lead("at").over(price) - 1, F.col("at")), (F.col("_block") + 1) * size - 1, F.col("n_bars") - 1).alias("to_bar"),
    )
    return runs.where(F.col("volume").isNotNull() & (F.col("from_bar") <= F.col("to_bar")))


def rolling_profile(indexed: DataFrame, bars: int = PROFILE_BARS, size: int = PROFILE_BLOCK) -> DataFrame:
    """Volume per price over the last ``bars`` bars, for every bar with index above ``bars``: the runs, bar by bar."""
    return _by_bar(profile_runs(indexed, bars, size)).drop("_block")


def _by_bar(runs: DataFrame) -> DataFrame:
    """A row for each bar and price; rows of a bar stay in the task of its block."""
    bar = F.explode(F.sequence("from_bar", "to_bar")).alias("i")
    return runs.select(*SERIES, "_block", bar, "price_level", "volume", "first_bar")


def with_poc(profile: DataFrame) -> DataFrame:
    """Add ``poc``: the price of most volume; ties go to the older bar, then the higher price."""
    best = F.max(F.struct("volume", (-F.col("first_bar")).alias("age"), "price_level")).over(_ladder(profile)[1])
    return profile.withColumn("poc", best["price_level"])


def _ladder(profile: DataFrame) -> tuple[WindowSpec, WindowSpec]:
    """The prices of a bar from below up to each, and all of them: two frames of one order."""
    prices = Window.partitionBy(*_bar_keys(profile)).orderBy("price_level")
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    return prices.rowsBetween(Window.unboundedPreceding, 0), prices.rowsBetween(*whole)


def _bar_keys(profile: DataFrame) -> list[str]:
    """A profile that is partitioned by block is not shuffled again."""
    return [*SERIES, *[c for c in ("_block",) if c in profile.columns], "i"]


def value_area(profile: DataFrame, share: float = VALUE_AREA_SHARE) -> DataFrame:
    """POC, VAL, VAH and the rank of the POC in the price ladder, per bar.

    Going down (up) from the POC, VAL (VAH) is the first price at which the running volume exceeds
    ``share`` of all volume on that side; else the side's last price; else the POC. All sums run along
    one order of the prices: what lies between a price and the POC is what lies below the POC without what
    lies below the price.
    """
    upto, whole = _ladder(profile)
    below, above = F.col("price_level") < F.col("poc"), F.col("price_level") > F.col("poc")
    under, over = F.when(below, F.col("volume")), F.when(above, F.col("volume"))
    down = F.sum(under).over(whole) - F.sum(under).over(upto) + under
    hit = F.col("reached")
    reached = F.when(below, F.try_divide(down, F.sum(under).over(whole)) > share).otherwise(F.try_divide(F.sum(over).over(upto), F.sum(over).over(whole)) > share)
    sided = with_poc(profile)
    keys = _bar_keys(profile)
    price = F.col("price_level")
    return (
        sided.withColumn("reached", reached)
        .groupBy(*keys)
        .agg(
            F.max("poc").alias("poc"),
            F.coalesce(F.max(F.when(below & hit, price)), F.min(F.when(below, price)), F.max("poc")).alias("val"),
            F.coalesce(F.min(F.when(above & hit, price)), F.max(F.when(above, price)), F.max("poc")).alias("vah"),
            F.count_if(below).alias("poc_rank"),
        )
        .drop("_block")
    )


def poc_value_area(
    levels: DataFrame, bars: int = PROFILE_BARS, share: float = VALUE_AREA_SHARE, of: DataFrame | None = None
) -> DataFrame:
    """POC, VAL and VAH of the rolling profile; one row per bar with a full history.

    ``of`` holds all bars of the series; a bar without levels counts as one with an empty profile.
    """
    return value_area(_by_bar(profile_runs(with_bar_index(levels, of), bars)), share)


def volume_clusters(
    levels: DataFrame,
    bars: int = CLUSTER_BARS,
    factor: float = CLUSTER_FACTOR,
    gate: str = "bar_index",
    size: int = BLOCK,
    of: DataFrame | None = None,
) -> DataFrame:
    """Levels whose side quantity stands out against the recent bars, in long form.

    ``of`` holds all bars of the series, also those without levels, which the index and the recent bars count.

    A level is a cluster when ``qty / sum(last bars' mean level quantity) / bars > factor``. The gate
    ``bar_index`` asks for bar index >= ``bars``; ``poc_rank`` for a POC rank >= ``bars`` instead,
    on bars that have a rolling profile.
    """
    indexed = bar_index(levels, of).join(level_means(levels), BAR, "left")
    blocks = in_blocks(indexed, pre=bars, size=size)
    sums = blocks.with_columns({f"{s}_sum": F.sum(f"{s}_average").over(blocks.last(bars)) for s in SIDES}).rows()
    if gate == "bar_index":
        gated = sums.where(F.col("i") >= bars)
    elif gate == "poc_rank":
        ranks = poc_value_area(levels, of=of).where(F.col("poc_rank") >= bars).select(*SERIES, "i")
        gated = sums.join(ranks, [*SERIES, "i"], "left_semi")
    else:
        raise ValueError(f"unknown gate {gate!r}")
    kept = gated.select(*BAR, "i", *[f"{s}_{x}" for s in SIDES for x in ("average", "sum")])
    sides = levels.join(kept, BAR).select(
        *BAR,
        "i",
        "price_level",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(s).alias("side"),
                        F.col(f"total_{s}_qty").alias("side_qty"),
                        F.col(f"{s}_average").alias("average"),
                        F.col(f"{s}_sum").alias("recent"),
                    )
                    for s in SIDES
                ]
            )
        ),
    )
    stands_out = (F.col("average") > 0) & (F.col("recent") > 0)
    ratio = F.try_divide(F.col("side_qty"), F.col("recent")) / bars
    return sides.where(stands_out & (ratio > factor)).select(*BAR, "i", "price_level", "side", "side_qty", "recent")


def cluster_label(quantity: str | Column, recent: str | Column, bars: int = CLUSTER_BARS) -> Column:
    """``quantity|xstrength`` with 4 and 1 decimals."""
    quantity, recent = col(quantity), col(recent)
    strength = F.round(quantity * 1000 / recent / bars, 1)
    return F.concat(F.round(quantity, 4).cast("string"), F.lit("|x"), strength.cast("string"))


def cluster_maps(levels: DataFrame, clusters: DataFrame, bars: int = CLUSTER_BARS) -> DataFrame:
    """Per bar, the cluster labels of both sides as maps; empty where a bar has none."""
    price = F.col("price_level")

    def side_map(side: str) -> Column:
        entry = F.when(F.col("side") == side, F.struct(price, cluster_label("side_qty", "recent", bars).alias("label")))
        keyed = F.transform(
            F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["price_level"].cast("string"), e["label"])
        )
        return F.map_from_entries(keyed).alias(f"cluster_{side}")

    found = clusters.groupBy(*BAR).agg(side_map("bid"), side_map("ask"))
    none = F.create_map().cast("map<string, string>")
    return (
        levels.select(*BAR)
        .distinct()
        .join(found, BAR, "left")
        .withColumns({f"cluster_{s}": F.coalesce(F.col(f"cluster_{s}"), none) for s in SIDES})
    )


def bars_with_clusters(maps: DataFrame, side: str = "bid") -> DataFrame:
    return maps.where(F.size(f"cluster_{side}") > 0)


def cluster_range(clusters: DataFrame) -> DataFrame:
    """Smallest and largest cluster quantity per side over everything found."""
    return clusters.groupBy("side").agg(F.min("side_qty").alias("min_qty"), F.max("side_qty").alias("max_qty"))
