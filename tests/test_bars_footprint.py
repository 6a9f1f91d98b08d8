import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tests.helpers import HOUR, random_rows, tape
from tickloom.operators import bars, footprint, prepare
from tickloom.schema import TAPE, timeframe_seconds


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_equal_times_open_and_close_by_id(spark):
    t = tape(spark, [("A", 2, 11.0, 1.0, 5, True), ("A", 1, 10.0, 1.0, 5, True), ("A", 3, 12.0, 1.0, 5, False)])
    for wide in (False, True):
        r = bars.ohlcv(t, "1m", wide_ids=wide).first()
        assert (r.open, r.close, r.high, r.low, r.qty) == (10.0, 12.0, 12.0, 10.0, 3.0)


def test_ids_beyond_the_packed_range_fail_unless_wide(spark):
    t = tape(spark, [("A", 2**62, 11.0, 1.0, 5, True), ("A", 2**62 + 1, 12.0, 1.0, 5, True)])
    with pytest.raises(SparkRuntimeException, match="wide_ids"):
        bars.ohlcv(t, "1w").collect()
    r = bars.ohlcv(t, "1w", wide_ids=True).first()
    assert (r.open, r.close) == (11.0, 12.0)


def test_week_starts_on_thursday(spark):
    wed, thu = 1704326399000, 1704326400000  # 2024-01-03 23:59:59 and 2024-01-04 00:00:00
    t = tape(spark, [("A", 1, 1.0, 1.0, wed, True), ("A", 2, 2.0, 1.0, thu, True)])
    starts = [r[0] for r in bars.ohlcv(t, "1w").select(F.unix_millis("time_rounded")).collect()]
    assert sorted(starts) == [thu - 7 * 86400000, thu]
    window = t.groupBy(F.window(F.timestamp_millis("transact_time"), "604800 seconds")).count()
    assert sorted(r[0] for r in window.select(F.unix_millis("window.start")).collect()) == sorted(starts)


def test_no_bar_for_a_gap(spark):
    t = tape(spark, [("A", 1, 1.0, 1.0, 0, True), ("A", 2, 2.0, 1.0, 5 * HOUR, True)])
    assert bars.ohlcv(t, "1h").count() == 2


def test_unknown_timeframe_and_uneven_rollup():
    with pytest.raises(ValueError):
        timeframe_seconds("2h")
    with pytest.raises(ValueError):
        bars.check_multiple("1d", "4h")


def test_null_price_counts_for_quantity_only(spark):
    t = tape(spark, [("A", 1, None, 5.0, 0, True), ("A", 2, 3.0, 1.0, 1, True), ("A", 3, 4.0, None, 2, False)])
    r = bars.ohlcv(t, "1h").first()
    assert (r.open, r.close, r.qty) == (3.0, 4.0, 6.0)
    levels = footprint.footprint_levels(t, "1h", {})
    assert rows(levels, "price_level", "total_bid_qty", "total_ask_qty") == [(3.0, 1.0, 0.0)]
    full = footprint.bars_with_footprint(t, "1h", {}).first()
    assert (full.open, full.close, full.qty, full.sum_total_bid_qty) == (3.0, 4.0, 6.0, 1.0)
    assert list(full.footprint) == ["3.0"]


def test_string_prices_and_text_sides(spark):
    raw = spark.createDataFrame(
        [("A", "1", "9.5", "1", "0", "true"), ("A", "2", "10.1", "1", "1", "False"), ("A", "agg_trade_id", "price", "quantity", "transact_time", "m")],
        "symbol string, agg_trade_id string, price string, quantity string, transact_time string, is_buyer_maker string",
    )
    clean = prepare.canonical_types(prepare.drop_header_rows(raw))
    r = bars.ohlcv(clean, "1h").first()
    assert (r.high, r.low) == (10.1, 9.5)
    level = footprint.footprint_levels(clean, "1h", {})
    assert rows(level, "price_level", "total_bid_trades", "total_ask_trades") == [(9.5, 1, 0), (10.1, 0, 1)]


def test_one_sided_level_is_zero_not_null(spark):
    t = tape(spark, [("A", 1, 3.0, 2.0, 0, True)])
    cell = footprint.bars_with_footprint(t, "1h").first().footprint["3.0"]
    assert (cell.bid_qty, cell.bid_trades, cell.ask_qty, cell.ask_trades) == (2.0, 1.0, 0.0, 0.0)
    joined = footprint.join_side_frames(bars.ohlcv(t, "1h"), footprint.footprint_levels(t, "1h")).first()
    assert (joined.sum_total_bid_qty, joined.sum_total_ask_qty) == (2.0, 0.0)


def test_half_up_levels_by_symbol(spark):
    t = tape(spark, [("BTCUSDT", 1, 2.5, 1.0, 0, True), ("BTCUSDT", 2, 0.5, 1.0, 0, True), ("SOLUSDT", 3, 2.25, 1.0, 0, True), ("X", 4, 2.25, 1.0, 0, True)])
    levels = footprint.footprint_levels(t, "1h")
    assert rows(levels, "symbol", "price_level") == [("BTCUSDT", 1.0), ("BTCUSDT", 3.0), ("SOLUSDT", 2.3), ("X", 2.25)]
    ticks = spark.createDataFrame([("BTCUSDT", 0), ("SOLUSDT", 1)], "symbol string, decimals int")
    assert rows(footprint.footprint_levels(t, "1h", ticks), "symbol", "price_level") == rows(levels, "symbol", "price_level")


def test_one_pass_equals_join_and_rollup_equals_direct(spark):
    t = tape(spark, random_rows(600))
    levels = footprint.footprint_levels(t, "4h")
    one = footprint.bars_with_footprint(t, "4h")
    names = ["symbol", "time_rounded", "open", "close", "high", "low", "qty", "sum_total_bid_qty", "sum_total_ask_qty"]
    assert rows(one, *names) == rows(footprint.join_side_frames(bars.ohlcv(t, "4h"), levels), *names)
    cells = footprint.explode_footprint(one)
    assert rows(cells, "symbol", "time_rounded", "price_level", "total_ask_qty") == rows(levels, "symbol", "time_rounded", "price_level", "total_ask_qty")
    rolled = bars.rollup_bars(bars.rollup_bars(bars.ohlcv(t, "1m"), "1m", "5m"), "5m", "4h")
    assert rows(rolled, *names[:7]) == rows(bars.ohlcv(t, "4h"), *names[:7])
    fine = footprint.rollup_levels(footprint.footprint_levels(t, "1h"), "1h", "4h")
    assert rows(fine, *levels.columns) == rows(levels, *levels.columns)


def test_maps_are_in_price_order_and_reticked_descending(spark):
    t = tape(spark, [("X", i, p, 1.0, 0, True) for i, p in enumerate((10.4, 9.6, 100.2, 99.9))])
    full = footprint.bars_with_footprint(t, "1h")
    assert full.select(F.map_keys("footprint")).first()[0] == ["9.6", "10.4", "99.9", "100.2"]
    again = footprint.retick_footprint(full, 0)
    assert again.select(F.map_keys("footprint")).first()[0] == ["100.0", "10.0"]
    assert again.first().footprint["100.0"].bid_qty == 2.0


def test_side_footprint_is_sorted_maps(spark):
    t = tape(spark, [("X", 1, 3.0, 1.0, 0, True), ("X", 2, 2.0, 1.0, 0, True), ("X", 3, 2.0, 1.0, 0, False)])
    side = footprint.side_footprint(footprint.footprint_levels(t, "1h"), "bid").first().aggregated_foot_bid
    assert [list(m)[0] for m in side] == ["2.0", "3.0"]


def test_flatten_maps_keeps_the_later_value(spark):
    df = spark.sql("SELECT array(map('a', 1, 'b', 2), map('b', 3), map('c', 4)) AS m")
    assert df.select(footprint.flatten_maps("m").alias("f")).first().f == {"a": 1, "b": 3, "c": 4}


def test_concatenated_json(spark):
    df = spark.createDataFrame([("a", '{"agg_trade_id":1,"price":2.5}{"agg_trade_id":2}, {"agg_trade_id":3}'), ("b", ""), ("c", None)], "k string, doc string")
    out = footprint.explode_concatenated_json(df, "doc", type(TAPE)([f for f in TAPE.fields if f.name in ("agg_trade_id", "price")]))
    assert rows(out.fillna(0.0), "k", "agg_trade_id", "price") == [("a", 1, 2.5), ("a", 2, 0.0), ("a", 3, 0.0)]


def nested(depth):
    return '{"agg_trade_id":1,"price":2.5,"x":' + '{"agg_trade_id":7,"x":' * depth + '"{{}{\\"}"' + "}" * (depth + 1)


def test_concatenated_json_is_split_at_the_outermost_objects(spark):
    fields = type(TAPE)([f for f in TAPE.fields if f.name in ("agg_trade_id", "price")])

    def split(text):
        df = spark.createDataFrame([("a", text)], "k string, doc string")
        return rows(footprint.explode_concatenated_json(df, "doc", fields), "agg_trade_id", "price")

    assert split(nested(8) * 2 + ',{"agg_trade_id":1,"price":2.5}') == [(1, 2.5)] * 3
    assert split('{"agg_trade_id":1,"price":2.5}{"agg_trade_id":') == [(1, 2.5)]
    for depth in (9, 60):
        assert split('{"agg_trade_id":1,"price":2.5}' + nested(depth)) == [(1, 2.5)] * 2


def test_analysis_frame_names(spark):
    frame = prepare.analysis_frame(footprint.bars_with_footprint(tape(spark, random_rows(20)), "1h"))
    assert frame.columns == ["symbol", "timeframe", "date", "open", "close", "high", "low", "volume", "total_bid_qty", "total_ask_qty", "footprint"]


def test_trades_without_a_time_have_no_bar(spark):
    t = tape(spark, [("A", 1, 3.0, 1.0, None, True), ("A", 2, 4.0, 1.0, 0, True)])
    assert bars.ohlcv(t, "1h").count() == 1
    assert footprint.footprint_levels(t, "1h").count() == 1
    assert footprint.bars_with_footprint(t, "1h").count() == 1
