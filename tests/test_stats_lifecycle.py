import random
import statistics
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.helpers import HOUR, by_key, random_rows, tape
from tickloom.operators import lifecycle, prepare, stats, wide
from tickloom.operators.bars import ohlcv


def bag(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(
    "values",
    [
        [3.0],
        [1.0, 2.0],
        [5.0] * 500 + [1.0] * 499,
        [random.Random(2).expovariate(1) for _ in range(777)],
        [1e-9 * k for k in range(100)] + [1e9],
        [-4.0, -1.0, None, 7.5, 2.0],
    ],
)
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = stats.exact_median(df, "x").first()[0]
    assert got == statistics.median([v for v in values if v is not None])


def test_timing_stats_and_histogram(spark):
    x = [random.Random(4).random() for _ in range(100)] + [0.0, 1.0]
    log = spark.createDataFrame([(v, 2) for v in x], "elapsed_time double, trade_count bigint")
    r = stats.timing_stats(log).first()
    assert r.total_trades == 204 and r.median_time == statistics.median(x)
    assert r.std_dev_time == pytest.approx(statistics.pstdev(x))
    bins = [r.n for r in stats.histogram(log, "elapsed_time").orderBy("bin").collect()]
    want = [0] * 20
    for v in x:
        want[min(int(v * 20), 19)] += 1
    assert bins == want
    one = stats.histogram(spark.createDataFrame([(3.0,)], "elapsed_time double"), "elapsed_time")
    assert sum(r.n for r in one.collect()) == 1


def test_summary(spark):
    t = tape(spark, [("A", 1, 2.0, 3.0, 0, True), ("A", 2, 4.0, 1.0, 0, False), ("A", 3, 3.0, 2.0, 0, False)])
    r = stats.trade_summary(t).first()
    assert (r.total_trades, r.total_volume, r.total_value, r.average_price, r.max_price, r.min_price) == (3, 6.0, 16.0, 3.0, 4.0, 2.0)
    assert (r.buyer_market_trades, r.seller_market_trades) == (1, 2)


def test_universe_orders_all_metrics_descending(spark):
    df = spark.createDataFrame(
        [("BTCUSDT", "10", "1"), ("ETHUSDT", "10", "2"), ("USDCUSDT", "99", "9"), ("BTCEUR", "99", "9"), ("XUSDT", None, "5")],
        "symbol string, a string, b string",
    )
    assert [r.symbol for r in stats.universe_top_n(df, ["a", "b"], 2).collect()] == ["ETHUSDT", "BTCUSDT"]
    assert [r.symbol for r in stats.universe_top_n(df, ["missing", "b"], 5).collect()] == ["XUSDT", "ETHUSDT", "BTCUSDT"]


def test_latest_minutes(spark):
    t = tape(spark, [("A", k, 1.0, 1.0, k * 60000, True) for k in range(9)])
    assert sorted(r.agg_trade_id for r in stats.latest_minutes_for(t, "5m").collect()) == [4, 5, 6, 7, 8]
    with pytest.raises(ValueError):
        stats.latest_minutes_for(t, "2h")
    gaps = tape(spark, [("A", 1, 1.0, 1.0, 0, True), ("B", 2, 1.0, 1.0, 59999, True), ("A", 3, 1.0, 1.0, 3600000, True), ("A", 4, 1.0, 1.0, None, True)])
    assert [sorted(r.agg_trade_id for r in stats.latest_minutes(gaps, n).collect()) for n in (0, 1, 2, 9)] == [[], [3], [1, 2, 3], [1, 2, 3]]
    assert stats.latest_minutes(gaps.where("false"), 5).count() == 0


def test_latest_minutes_bound_the_scan(spark, tmp_path):
    tape(spark, [("A", k, 1.0, 1.0, k * 60000, True) for k in range(9)]).write.parquet(f"{tmp_path}/t")
    text = stats.latest_minutes(spark.read.parquet(f"{tmp_path}/t"), 2)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "GreaterThanOrEqual(transact_time,ScalarSubquery" in text


def test_last_seen(spark):
    t = tape(spark, random_rows(50))
    got = by_key(stats.last_seen(t, 10**12), "symbol", "stale_ms")
    assert all(v > 0 for v in got.values()) and len(got) == 2


def test_append_and_dedupe_prefers_the_new_side(spark):
    old = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 2.0)], "symbol string, agg_trade_id bigint, price double")
    new = spark.createDataFrame([("A", 2, 9.0), ("A", 3, 3.0), ("A", 3, 3.0)], old.schema)
    assert bag(lifecycle.append_and_dedupe(old, new)) == [("A", 1, 1.0), ("A", 2, 9.0), ("A", 3, 3.0)]


def test_dedupe_keeps_trades_of_one_millisecond(spark):
    t = tape(spark, [("A", 1, 1.0, 1.0, 5, True), ("A", 2, 2.0, 1.0, 5, True), ("A", 2, 2.0, 1.0, 5, True)])
    assert lifecycle.newest_per_key(t, lifecycle.TRADE_KEY, ["transact_time"]).count() == 2
    assert lifecycle.newest_per_key(t, ["symbol", "transact_time"], ["agg_trade_id"]).first().agg_trade_id == 2


def test_documents_compare_by_content(spark):
    old = spark.createDataFrame([("t", "d", '{"a":1,"b":2}')], "task string, day string, doc string")
    new = spark.createDataFrame([("t", "d", '{ "b": 2, "a": 1 }'), ("t", "e", '{"a":1,"b":2}'), ("t", "d", '{"a":3}'), ("t", "d", '{"a": 3}')], old.schema)
    out = lifecycle.absent_documents(old, new).collect()
    assert sorted((r.day, lifecycle_doc(r.doc)) for r in out) == [("d", '{"a":3}'), ("e", '{"a":1,"b":2}')]


def lifecycle_doc(text):
    return text.replace(" ", "")


def test_calendar_has_no_30_february(spark):
    symbols = spark.createDataFrame([("A",)], "symbol string")
    days = [r.date for r in lifecycle.requested_days(symbols, "2024-02-27", "2024-03-01").orderBy("date").collect()]
    assert days == [date(2024, 2, 27), date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]


def test_date_checks():
    assert lifecycle.check_dates("2024-01-01", "2024-01-02")[1] == date(2024, 1, 2)
    for start, end in (("2024-01-03", "2024-01-02"), ("2024-1-3", "2024-02-01"), ("2024-02-30", "2024-03-01")):
        with pytest.raises(ValueError):
            lifecycle.check_dates(start, end)
    with pytest.raises(ValueError):
        lifecycle.check_dates("2030-01-01", "2030-01-02", today=date(2024, 1, 1))


def test_resume_returns_only_pending(spark):
    keys = ["symbol", "timeframe", "range"]
    wanted = spark.createDataFrame([("A", "1h", "r1"), ("A", "1h", "r2"), ("B", "1h", "r1")], "symbol string, timeframe string, range string")
    done = wanted.where("symbol = 'A' AND range = 'r1'")
    assert bag(lifecycle.pending(wanted, done, keys)) == [("A", "1h", "r2"), ("B", "1h", "r1")]
    assert bag(lifecycle.existing_keys(wanted, done, keys)) == [("A", "1h", "r1")]
    assert lifecycle.is_present(done) and not lifecycle.is_present(done.where("false"))


def test_backfill_plans_current_month_by_day(spark):
    symbols = spark.createDataFrame([("A",)], "symbol string")
    have = spark.createDataFrame([("A", "2024-01"), ("A", "2024-03")], "symbol string, period string")
    plan = lifecycle.backfill_plan(symbols, have, F.lit("2024-01-10").cast("date"), F.lit("2024-03-03").cast("date"))
    assert bag(plan.select("kind", "period")) == [("day", "2024-03-01"), ("day", "2024-03-02"), ("month", "2024-02")]
    first = lifecycle.backfill_plan(symbols, have, F.lit("2024-03-01").cast("date"), F.lit("2024-03-01").cast("date"))
    assert first.count() == 0


def test_daily_fallback_only_for_absent_months(spark):
    m = spark.createDataFrame([("A", "2024-01", 1)], "symbol string, month string, n int")
    d = spark.createDataFrame([("A", "2024-01", 2), ("A", "2024-02", 3)], m.schema)
    assert bag(lifecycle.daily_fallback(m, d)) == [("A", "2024-01", 1), ("A", "2024-02", 3)]


def test_archive_split_is_complete(spark):
    midnight = 1704412800000
    t = tape(spark, [("A", k, 1.0, 1.0, midnight + d, True) for k, d in enumerate((-1, 0, 1, HOUR))] + [("A", 9, 1.0, 1.0, None, True)])
    old, keep = lifecycle.split_archive(t, F.timestamp_millis(F.lit(midnight + 7 * HOUR)))
    assert [r.agg_trade_id for r in old.collect()] == [0]
    assert sorted(r.agg_trade_id for r in keep.collect()) == [1, 2, 3, 9]
    assert sorted(r.agg_trade_id for r in lifecycle.not_archived(t, old).collect()) == [1, 2, 3, 9]


def test_coverage_states(spark):
    full = ohlcv(tape(spark, [(s, k, 1.0, 1.0, k * HOUR, True) for s in "ABC" for k in range(5)]), "1h")
    part = full.where("symbol = 'A' OR (symbol = 'B' AND hour(time_rounded) < 3)")
    got = {r.symbol: (r.state, r.recompute_from and r.recompute_from.hour) for r in lifecycle.coverage(full, part, look_back=2).collect()}
    assert got == {"A": ("complete", None), "B": ("incomplete", 0), "C": ("missing", None)}


def test_key_mismatches(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (2,), (3,)], "k int")
    assert bag(lifecycle.key_mismatches(a, b, ["k"])) == [(1, "absent"), (2, "repeated"), (3, "extra")]


def test_wide_cells_round_trip(spark):
    bars = ohlcv(tape(spark, [("A", 1, 1.5, 1.0, 0, True), ("AB", 2, 2.5, 1.0, 0, True)]), "1h")
    cells = wide.bar_cells(bars, "x", ("open", "close"))
    back = wide.pivot_cells(cells, {"open": "double", "close": "double", "volume": "double"})
    assert bag(back.drop("volume")) == [("x#A#1h#0", 1.5, 1.5), ("x#AB#1h#0", 2.5, 2.5)]
    keyed = wide.trade_cells(tape(spark, [("A", 1, 1.5, 1.0, 0, True), ("AB", 2, 2.5, 1.0, 0, True)]))
    only = wide.scan_prefix(keyed, "A", {"price": "double", "is_buyer_maker": "boolean", "absent": "bigint"})
    assert bag(only.drop("absent")) == [("A#1970-01#0", 1.5, True)]


def test_interval_floor_and_tags(spark):
    t = prepare.with_readable_time(tape(spark, [("A", 1, 1.0, 1.0, 1704067259123, True)]))
    r = prepare.round_down_to_interval(t, 60).select("time_rounded", "time").first()
    assert (r.time_rounded.second, r.time.microsecond) == (0, 123000)
    tagged = prepare.with_minute_parts(prepare.with_tags(t, exchange="x")).first()
    assert (tagged.exchange, tagged.day, tagged.hour, tagged.minute) == ("x", "2024-01-01", "00", "00")
    with pytest.raises(ValueError):
        prepare.rename_by_position(t, ["a"])
