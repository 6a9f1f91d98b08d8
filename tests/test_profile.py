"""Volume profile against a plain loop over bars that keeps the order rules literally."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import HOUR, random_rows, tape
from tickloom.operators import footprint, profile
from tickloom.plans.stage import staged


def books(levels):
    """Per symbol, the bars in time order as {price: (bid, ask)} with prices descending."""
    out = {}
    for r in levels.orderBy("symbol", "time_rounded", F.col("price_level").desc()).collect():
        out.setdefault(r.symbol, {}).setdefault(r.time_rounded, {})[r.price_level] = (r.total_bid_qty, r.total_ask_qty)
    return {s: list(b.values()) for s, b in out.items()}


def plain_area(bars, i, period=40, share=0.4):
    book = {}
    for bar in bars[i - period + 1 : i + 1]:
        for price, (bid, ask) in bar.items():
            book[price] = book.get(price, 0.0) + bid + ask
    poc = max(book, key=book.get)
    prices = sorted(book)
    rank = prices.index(poc)

    def walk(steps, total):
        run = 0.0
        for k, p in enumerate(steps):
            run += book[p]
            if (total > 0 and run / total > share) or k == len(steps) - 1:
                return p
        return poc

    below, above = prices[:rank][::-1], prices[rank + 1 :]
    return poc, walk(below, sum(book[p] for p in below)), walk(above, sum(book[p] for p in above)), rank


@pytest.fixture(scope="module")
def levels(spark):
    df = footprint.footprint_levels(tape(spark, random_rows(900, step_ms=HOUR // 2)), "1h", decimals=0).cache()
    yield df
    df.unpersist()


def test_poc_and_value_area(spark, levels):
    got = {(r.symbol, r.i): (r.poc, r.val, r.vah, r.poc_rank) for r in profile.poc_value_area(levels).collect()}
    want = {
        (s, i): plain_area(bars, i) for s, bars in books(levels).items() for i in range(41, len(bars))
    }
    assert len(want) > 100 and got == want


def test_short_history_starts_at_index_41(spark):
    for n, first in ((41, None), (42, 41)):
        t = tape(spark, [("X", i, 100.0 + i % 3, 1.0, i * HOUR, True) for i in range(n)])
        found = [r.i for r in profile.poc_value_area(footprint.footprint_levels(t, "1h")).collect()]
        assert found == ([] if first is None else [first])


def test_ties_and_extremes(spark):
    rows = lambda prices: [("X", i, float(p), 1.0, i * HOUR, True) for i, p in enumerate(prices)]
    # Window of bar 41 is bars 2..41; every price trades equally: the oldest bar wins.
    r = profile.poc_value_area(footprint.footprint_levels(tape(spark, rows(range(1, 43))), "1h")).first()
    assert (r.poc, r.val) == (3.0, 3.0)
    one_bar = [("X", 100 + k, 50.0 + k, 9.0, 41 * HOUR, True) for k in range(2)]
    r = profile.poc_value_area(footprint.footprint_levels(tape(spark, rows(range(1, 42)) + one_bar), "1h")).first()
    assert r.poc == 51.0 and r.vah == 51.0


@pytest.mark.parametrize("gate", ["bar_index", "poc_rank"])
def test_clusters(spark, levels, gate):
    factor, n = 0.0009, 5
    found = profile.volume_clusters(levels, bars=n, factor=factor * 10, gate=gate, size=16)
    got = {(r.symbol, r.i, r.price_level, r.side, r.side_qty) for r in found.collect()}
    want = set()
    for s, bars in books(levels).items():
        means = [[sum(c[k] for c in b.values()) / len(b) for k in (0, 1)] for b in bars]
        for i, bar in enumerate(bars):
            if gate == "bar_index" and i < n:
                continue
            if gate == "poc_rank" and (i <= 40 or plain_area(bars, i)[3] < n):
                continue
            for k, side in enumerate(("bid", "ask")):
                recent = sum(m[k] for m in means[max(0, i - n + 1) : i + 1])
                for price, cell in bar.items():
                    if means[i][k] > 0 and recent > 0 and cell[k] / recent / n > factor * 10:
                        want.add((s, i, price, side, cell[k]))
    assert want and got == want


def test_cluster_labels_and_range(spark, levels):
    found = profile.volume_clusters(levels, bars=5, factor=0.02).cache()
    row = found.where("side = 'bid'").first()
    maps = profile.cluster_maps(levels, found, bars=5).cache()
    bar = maps.where((F.col("symbol") == row.symbol) & (F.col("time_rounded") == F.lit(row.time_rounded))).first()
    assert bar.cluster_bid[str(row.price_level)] == f"{round(row.side_qty, 4)}|x{round(row.side_qty * 1000 / row.recent / 5, 1)}"
    assert maps.count() == levels.select("symbol", "time_rounded").distinct().count()
    with_bid = profile.bars_with_clusters(maps).count()
    assert with_bid == found.where("side = 'bid'").select("symbol", "time_rounded").distinct().count()
    span = {r.side: (r.min_qty, r.max_qty) for r in profile.cluster_range(found).collect()}
    sizes = [r.side_qty for r in found.where("side = 'bid'").collect()]
    assert span["bid"] == (min(sizes), max(sizes))
    with pytest.raises(ValueError):
        profile.volume_clusters(levels, gate="other")


def test_imbalance_pads_short_bars(spark):
    t = tape(spark, [("X", 1, 1.0, 5.0, 0, True), ("X", 2, 2.0, 7.0, 0, False)] + [("X", 10 + k, 3.0 + k, 1.0, HOUR, False) for k in range(5)])
    got = {r.time_rounded.hour: r.delta_x for r in profile.top_level_imbalance(footprint.footprint_levels(t, "1h")).collect()}
    assert got == {0: 2.0, 1: 3.0}


def test_deltas(spark, levels):
    totals = profile.bar_totals(levels)
    out = profile.delta_columns(totals, size=16).where("symbol = 'XYZ'").orderBy("time_rounded").collect()
    cum, bid = 0.0, None
    for i, r in enumerate(out):
        cum += r.ask - r.bid
        assert math.isclose(r.cumulative_delta, cum / 10000, abs_tol=1e-12) and r.delta == r.ask - r.bid
        if i == 8:
            bid = sum(x.bid for x in out[:9]) / 9
        elif i > 8:
            bid = 0.2 * r.bid + 0.8 * bid
        assert (r.delta_bid is None) == (i < 8)
        assert i < 8 or math.isclose(r.delta_bid, bid, rel_tol=1e-9)
        assert i < 8 or math.isclose(r.delta_ema, r.delta_ask - r.delta_bid, rel_tol=1e-9, abs_tol=1e-9)


def test_runs_of_a_price_grow_with_its_changes(spark):
    """Runs against a plain loop; a price has two at most for each of its levels and block, and one shuffle by block serves all that follows."""
    rng = random.Random(4)
    rows = [("A", k, float(rng.choice([5, 5, 5, rng.randint(1, 40)])), float(rng.randint(1, 9)), (k // 3) * HOUR + k % 3, k % 2 == 0) for k in range(700)]
    levels = staged(footprint.footprint_levels(tape(spark, rows), "1h"))
    indexed = profile.with_bar_index(levels)
    runs = profile.profile_runs(indexed, bars=10, size=16)
    volume, first = {}, {}
    for _, k, price, quantity, _, _ in rows:
        bar = k // 3
        for i in range(max(bar, 11), min(bar + 10, 700 // 3 + 1)):
            volume[i, price] = volume.get((i, price), 0.0) + quantity
            first[i, price] = min(first.get((i, price), bar), bar)
    got = {}
    for r in runs.collect():
        for i in range(r.from_bar, r.to_bar + 1):
            assert (i, r.price_level) not in got
            got[i, r.price_level] = (r.volume, r.first_bar)
    assert got == {k: (volume[k], first[k]) for k in volume}
    assert profile.profile_runs(indexed).count() < 2 * levels.count() * 2
    text = profile.poc_value_area(levels)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("RepartitionByExpression") == 1
    plan = profile.value_area(profile._by_bar(profile.profile_runs(indexed)))._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in line and "_block" in line for line in plan.splitlines()) == 1
