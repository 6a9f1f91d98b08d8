"""Inputs beyond the usual range: ticks, tiny and huge numbers, long look-backs, long and nested JSON, bars without levels."""

import random
import statistics
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import HOUR, tape
from tickloom.functions.expressions import concatenated_json_array, outermost_objects, round_to
from tickloom.operators import bars, footprint, stats
from tickloom.operators.indicators.recurrent import ema, kama
from tickloom.operators.indicators.registry import add_indicators
from tickloom.operators.indicators.windowed import sma
from tickloom.plans.batch import analysis_table, whole_weeks
from tickloom.schema import AGG_TRADES
from tickloom.sources import readers


def test_ticks_of_any_size(spark):
    df = spark.createDataFrame([(104.0, -1), (155.0, -1), (0.1234567890125, 12), (7.77, None), (2.5, 0)], "p double, d int")
    assert [r[0] for r in df.select(round_to("p", "d")).collect()] == [100.0, 160.0, 0.123456789013, 7.77, 3.0]
    with pytest.raises(PySparkException, match="tick decimals out of range"):
        spark.createDataFrame([(1.0, 40)], "p double, d int").select(round_to("p", "d")).collect()


def test_repeated_tick_sizes_are_refused(spark):
    trades = tape(spark, [("A", 1, 1.26, 1.0, 0, True)])
    ticks = spark.createDataFrame([("A", 1)], "symbol string, decimals int")
    assert footprint.footprint_levels(trades, "1h", ticks).first().price_level == 1.3
    with pytest.raises(PySparkException, match="several tick sizes"):
        footprint.footprint_levels(trades, "1h", ticks.union(ticks)).collect()


def test_summary_of_tiny_and_huge_trades(spark):
    (r,) = stats.trade_summary(tape(spark, [("A", 1, 4e-9, 1e9, 0, True), ("A", 2, 4e-9, 1e13, 0, False)])).collect()
    assert r.total_value == pytest.approx(4 + 4e4) and r.average_price == pytest.approx(4e-9) and r.average_quantity == pytest.approx((1e9 + 1e13) / 2)


def test_summary_counts_notionals_of_any_smallness(spark):
    rows = [("A", 1, 4e-9, 1e-5, 0, True), ("A", 2, 4e-9, 2e-5, 0, False), ("B", 3, 4e-9, 1e-5, 0, True), ("B", 4, 2.0, 3.0, 0, True), ("C", 5, None, 1.0, 0, True)]
    got = {r.symbol: r.total_value for r in stats.trade_summary(tape(spark, rows)).collect()}
    assert got["A"] == pytest.approx(12e-14) and got["B"] == pytest.approx(6.0) and got["C"] is None


def test_median_of_values_on_two_scales(spark):
    random.seed(2)
    values = [random.random() for _ in range(5000)] + [1e6, 1e15, -1e300] + [0.5] * 100
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert stats.exact_median(df, "v").first()[0] == statistics.median(values)
    assert stats.exact_median(df.limit(0), "v").first()[0] is None
    facts = df.agg(stats._bracket(F.col("v")).alias("q")).first().q
    assert df.where(F.col("v").between(*facts)).select("v").distinct().count() < 100
    with pytest.raises(PySparkException, match="misses the middle"):
        stats._median_in_bracket(df, F.lit(0.9), F.lit(1.0), F.lit(df.count())).collect()


def test_long_look_back_beside_a_short_average(spark):
    random.seed(1)
    rows = [("A", k, random.uniform(10, 20), 1.0, k * HOUR, True) for k in range(2300)]
    frame = bars.ohlcv(tape(spark, rows), "1h")
    table = add_indicators(frame, [sma(1000), ema(2)])
    got = sorted(table.collect(), key=lambda r: r.time_rounded)
    closes = [r[2] for r in rows]
    y = sum(closes[:2]) / 2
    for k in range(2, 2300):
        y += (closes[k] - y) * 2 / 3
    last = got[-1].asDict()
    assert [v for n, v in last.items() if n.lower().startswith("sma")][0] == pytest.approx(sum(closes[-1000:]) / 1000)
    assert [v for n, v in last.items() if n.lower().startswith("ema")][0] == pytest.approx(y)


def test_average_that_forgets_everything(spark):
    """With a steady rise and fast=1 the factor is 0 at every step, so the average is the price."""
    rows = [("A", k, 10.0 + k, 1.0, k * HOUR, True) for k in range(600)]
    got = add_indicators(bars.ohlcv(tape(spark, rows), "1h"), [kama(fast=1)]).orderBy("time_rounded").collect()
    assert [r.KAMA_10_1_30 for r in got[10:]] == pytest.approx([10.0 + k for k in range(10, 600)])
    with pytest.raises(ValueError):
        kama(fast=0)


def test_long_and_nested_json(spark):
    long = "x" * 100_000
    texts = ['{"a":"1","b":{"c":2}}{"a":"2","b":{"c":{"d":"}"}}}', '{"a":"' + long + '"}', '{"a":"q\\"{"},{"a":"' + '\\\\"}', "none", None, "{" * 5000]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    schema = spark.createDataFrame([], "a string").schema
    got = [[x.a for x in r.o] for r in df.orderBy("k").select(concatenated_json_array("t", schema).alias("o")).collect()]
    assert got == [["1", "2"], [long], ['q"{', "\\"], [], [], []]


def test_objects_of_any_depth(spark):
    deep = '{"a":"1","x":' + '{"y":' * 60 + '"}"' + "}" * 60 + "}"
    texts = [deep + "," + deep, "}" + deep + "} {", deep + '{"a":"never closed"' + deep, '{"a":"' + "\\\\" * 20_000 + '"}', "{}" * 3]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = [list(r.o) for r in df.orderBy("k").select(outermost_objects("t").alias("o")).collect()]
    assert got == [[deep, deep], [deep], [deep], [texts[3]], ["{}"] * 3]


def test_sums_of_quantities_do_not_depend_on_partitions(spark):
    rows = [("A", k, 100.0 + k % 3, (k * 7919 % 100_003 + 1) / 1e8 + (k % 5) * 1e5, k, k % 2 == 0) for k in range(4000)]
    exact = sum(Decimal(repr(r[3])).quantize(Decimal("1e-8")) for r in rows)
    seen = set()
    for n in (1, 200):
        df = tape(spark, rows).repartition(n)
        bar, final = bars.ohlcv(df, "1h").first(), footprint.bars_with_footprint(df, "1h").first()
        levels = footprint.footprint_levels(df, "1h", spark.createDataFrame([("A", -1)], "symbol string, decimals int")).first()
        assert bar.qty == final.qty == float(exact) and levels.total_bid_trades == 2000
        seen.add((bar.qty, final.sum_total_bid_qty, final.sum_total_ask_qty, levels.total_bid_qty, levels.total_ask_qty))
    assert len(seen) == 1
    with pytest.raises(PySparkException):
        bars.ohlcv(tape(spark, [("A", 1, 1.0, 1e25, 0, True)]), "1h").collect()


def test_trades_are_folded_before_they_meet_the_tick_table(spark):
    ticks = spark.createDataFrame([("BTCUSDT", 0)], "symbol string, decimals int")
    df = tape(spark, [("BTCUSDT", k, 100.0 + k % 9 / 10, 1.0, k, True) for k in range(50)])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (footprint.footprint_levels(df, "1h", ticks), footprint.bars_with_footprint(df, "1h", ticks)):
            text = out._jdf.queryExecution().executedPlan().toString()
            exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning(symbol" in line]
            first = max(exchanges, key=lambda line: len(line) - len(line.lstrip(" :+-|")))
            assert "price" in first, first  # the deepest one, of raw trades, is by symbol, bar and price
            assert out.count() >= 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    names = AGG_TRADES.fieldNames()
    turned = names[::-1]
    values = {n: str(k + 1) for k, n in enumerate(names)} | {"is_buyer_maker": "true"}
    (tmp_path / "a.csv").write_text(",".join(turned) + "\n" + ",".join(values[n] for n in turned) + "\n")
    row = readers.read_trades_csv(spark, str(tmp_path / "a.csv")).first()
    assert row.agg_trade_id == int(values["agg_trade_id"]) and row.price == float(values["price"])
    (tmp_path / "b.csv").write_text("price\n1\n")
    with pytest.raises(ValueError, match="columns missing"):
        readers.read_trades_csv(spark, str(tmp_path / "b.csv"))


def test_weeks_are_whole():
    assert whole_weeks("1970-01-01", "1970-01-07") == ("1970-01-01", "1970-01-07")
    assert whole_weeks("1970-01-07", "1970-01-08") == ("1970-01-01", "1970-01-14")
    assert whole_weeks("1969-12-31", "1969-12-31") == ("1969-12-25", "1969-12-31")


def test_bars_without_levels_count(spark):
    """Profile and clusters use the index of all bars, so no bar gets the point of control of the next one."""
    random.seed(7)
    rows, empty = [], {3, 44, 45, 50}
    for bar in range(60):
        for k in range(6):
            rows.append(("A", 10 * bar + k, float(random.randint(1, 9)), float(random.randint(1, 50)), bar * HOUR + k, None if bar in empty else k % 2 == 0))
    df = tape(spark, rows)
    table = analysis_table(bars.ohlcv(df, "1h"), footprint.footprint_levels(df, "1h"))
    got = {r.i: r for r in table.collect()}
    assert len(got) == 60
    for i in range(60):
        volume, first = defaultdict(float), {}
        for _, _, price, quantity, ms, side in rows:
            bar = ms // HOUR
            if side is not None and i - 39 <= bar <= i:
                volume[price] += quantity
                first[price] = min(first.get(price, bar), bar)
        poc = max(volume, key=lambda p: (volume[p], -first[p], p)) if i > 40 else None
        assert got[i].poc == poc
        assert (got[i].cluster_bid is None) == (i in empty)
