"""Queries on the tape itself: preparation, bars, footprints, statistics, lifecycle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.operators import bars, footprint, lifecycle, prepare, stats, wide
from tickloom.plans import batch
from tickloom.plans.catalog import LEVEL, TAPE, WIDTH, bars_sql, flat, levels_sql, register, rounded
from tickloom.operators.series import index_bars
from tickloom.plans.stage import staged
from tickloom.plans.tape import EVENT_TICKS, event_bars, event_levels, tape_events, tape_lineitem
from tickloom.schema import AGG_TRADES, TIMEFRAMES, TRADE_COLUMNS
from tickloom.sources.messages import decode_messages
from tickloom.sources.readers import align_columns, union_periods

LEVEL_NAMES = "bq AS total_bid_qty, bn AS total_bid_trades, aq AS total_ask_qty, an AS total_ask_trades"


# --- bars -------------------------------------------------------------------------------------

for _tf in TIMEFRAMES:
    register(
        f"ohlcv_{_tf}",
        lambda spark, d, tf=_tf: flat(bars.ohlcv(tape_events(spark, d), tf)),
        f"WITH {bars_sql(_tf)} SELECT symbol, bar_ms, open, close, high, low, qty FROM bars",
    )

register(
    "ohlcv_wide_ids",
    lambda spark, d: flat(bars.ohlcv(tape_events(spark, d), "1h", wide_ids=True)),
    f"WITH {bars_sql('1h')} SELECT symbol, bar_ms, open, close, high, low, qty FROM bars",
)
register(
    "rollup_1m_to_1h",
    lambda spark, d: flat(bars.rollup_bars(bars.ohlcv(tape_events(spark, d), "1m"), "1m", "1h")),
    f"WITH {bars_sql('1h')} SELECT symbol, bar_ms, open, close, high, low, qty FROM bars",
)


def _fan_out(spark: SparkSession, d: str) -> DataFrame:
    frame = bars.bars_for_timeframes(tape_events(spark, d), ["1h", "4h", "1d"])
    return flat(frame.withColumn("tf", F.col("timeframe")))


register(
    "timeframe_fan_out",
    _fan_out,
    f"WITH {TAPE}, w(tf, ms) AS (VALUES "
    + ", ".join(f"('{t}', {WIDTH[t]})" for t in ("1h", "4h", "1d"))
    + """) SELECT symbol, tf, t - t % ms AS bar_ms, first(price ORDER BY t, id) AS open,
      last(price ORDER BY t, id) AS close, max(price) AS high, min(price) AS low, sum(qty) AS qty
      FROM tape, w GROUP BY ALL""",
)


def _volume_bars(spark: SparkSession, d: str) -> DataFrame:
    return flat(bars.ohlcv(tape_lineitem(spark, d), "1w")).select("symbol", "bar_ms", "high", "low", "qty")


LINEITEM = """li AS (SELECT 'P' || CAST(l_partkey % 4 AS VARCHAR) AS symbol, l_extendedprice / l_quantity AS price,
  l_quantity AS qty, epoch_us(CAST(l_shipdate AS TIMESTAMP)) // 1000 AS t, l_linestatus = 'O' AS maker FROM lineitem)"""
register(
    "volume_bars_1w",
    _volume_bars,
    f"""WITH {LINEITEM} SELECT symbol, t - t % 604800000 AS bar_ms, max(price) AS high, min(price) AS low,
    sum(qty) AS qty FROM li GROUP BY ALL""",
)
register(
    "volume_levels_1d",
    lambda spark, d: flat(footprint.footprint_levels(tape_lineitem(spark, d), "1d", decimals=0)),
    f"""WITH {LINEITEM}, l AS (SELECT symbol, t - t % 86400000 AS bar_ms, round(price, 0) AS price_level,
    sum(CASE WHEN maker THEN qty ELSE 0 END) AS bq, count(*) FILTER (WHERE maker) AS bn,
    sum(CASE WHEN NOT maker THEN qty ELSE 0 END) AS aq, count(*) FILTER (WHERE NOT maker) AS an
    FROM li GROUP BY ALL) SELECT symbol, bar_ms, price_level, {LEVEL_NAMES} FROM l""",
)

# --- footprints -------------------------------------------------------------------------------

for _tf in ("1h", "4h", "1d"):
    register(
        f"footprint_levels_{_tf}",
        lambda spark, d, tf=_tf: flat(footprint.footprint_levels(tape_events(spark, d), tf, EVENT_TICKS)),
        f"WITH {levels_sql(_tf)} SELECT symbol, bar_ms, price_level, {LEVEL_NAMES} FROM levels",
    )


def _levels_by_tick_table(spark: SparkSession, d: str) -> DataFrame:
    trades = tape_events(spark, d)
    number = F.substring("symbol", 2, 1).cast("int")
    ticks = trades.select("symbol").distinct().where(number < 3).withColumn("decimals", F.when(number == 2, 1).otherwise(0))
    return flat(footprint.footprint_levels(trades, "4h", ticks))


register(
    "levels_tick_table",
    _levels_by_tick_table,
    f"WITH {levels_sql('4h')} SELECT symbol, bar_ms, price_level, {LEVEL_NAMES} FROM levels",
)
register(
    "levels_raw_tick",
    lambda spark, d: flat(footprint.footprint_levels(tape_events(spark, d), "4h", {})),
    f"WITH {levels_sql('4h', 'price')} SELECT symbol, bar_ms, price_level, {LEVEL_NAMES} FROM levels",
)
register(
    "levels_trades_aggr",
    lambda spark, d: flat(footprint.footprint_levels(tape_events(spark, d), "4h", EVENT_TICKS, trades_aggr=True)),
    f"""WITH {levels_sql('4h')} SELECT symbol, bar_ms, price_level, {LEVEL_NAMES},
    bn AS total_bid_trades_aggr, an AS total_ask_trades_aggr FROM levels""",
)
register(
    "rollup_levels_1h_to_1d",
    lambda spark, d: flat(
        footprint.rollup_levels(footprint.footprint_levels(tape_events(spark, d), "1h", EVENT_TICKS), "1h", "1d")
    ),
    f"WITH {levels_sql('1d')} SELECT symbol, bar_ms, price_level, {LEVEL_NAMES} FROM levels",
)
register(
    "bar_side_totals",
    lambda spark, d: flat(footprint.side_totals(footprint.footprint_levels(tape_events(spark, d), "4h", EVENT_TICKS))),
    f"""WITH {TAPE} SELECT symbol, t - t % 14400000 AS bar_ms,
    sum(CASE WHEN maker THEN qty ELSE 0 END) AS sum_total_bid_qty,
    sum(CASE WHEN NOT maker THEN qty ELSE 0 END) AS sum_total_ask_qty,
    count(*) FILTER (WHERE maker) AS sum_total_bid_trades,
    count(*) FILTER (WHERE NOT maker) AS sum_total_ask_trades FROM tape GROUP BY ALL""",
)

FINAL_BARS = f"""WITH {levels_sql('4h')}, b AS (SELECT symbol, t - t % 14400000 AS bar_ms,
    first(price ORDER BY t, id) AS open, last(price ORDER BY t, id) AS close, max(price) AS high,
    min(price) AS low, sum(qty) AS qty, sum(CASE WHEN maker THEN qty ELSE 0 END) AS sum_total_bid_qty,
    sum(CASE WHEN NOT maker THEN qty ELSE 0 END) AS sum_total_ask_qty FROM tape GROUP BY ALL),
  n AS (SELECT symbol, bar_ms, count(*) AS levels, count(*) FILTER (WHERE bn > 0) AS bid_levels,
    count(*) FILTER (WHERE an > 0) AS ask_levels FROM levels GROUP BY ALL)"""


def _one_pass(spark: SparkSession, d: str) -> DataFrame:
    out = footprint.bars_with_footprint(tape_events(spark, d), "4h", EVENT_TICKS)
    return flat(out.withColumn("levels", F.size("footprint").cast("bigint")).drop("footprint"))


register(
    "bars_one_pass",
    _one_pass,
    f"""{FINAL_BARS} SELECT b.*, n.levels FROM b JOIN n USING (symbol, bar_ms)""",
)


def _joined(spark: SparkSession, d: str) -> DataFrame:
    trades = tape_events(spark, d)
    out = footprint.join_side_frames(
        bars.ohlcv(trades, "4h"), footprint.footprint_levels(trades, "4h", EVENT_TICKS)
    )
    sizes = {f"{s}_levels": F.coalesce(F.size(f"aggregated_foot_{s}"), F.lit(0)).cast("bigint") for s in ("bid", "ask")}
    return flat(out.withColumns(sizes).drop("aggregated_foot_bid", "aggregated_foot_ask"))


register(
    "bars_joined",
    _joined,
    f"{FINAL_BARS} SELECT b.*, n.bid_levels, n.ask_levels FROM b JOIN n USING (symbol, bar_ms)",
)


def _map_cells(frame: DataFrame) -> DataFrame:
    cells = footprint.explode_footprint(frame)
    counts = [F.col(f"total_{s}_trades").cast("bigint").alias(f"total_{s}_trades") for s in ("bid", "ask")]
    return flat(
        cells.select("symbol", "time_rounded", "price_level", "total_bid_qty", counts[0], "total_ask_qty", counts[1])
    )


register(
    "footprint_map_cells",
    lambda spark, d: _map_cells(footprint.bars_with_footprint(tape_events(spark, d), "4h", EVENT_TICKS)),
    f"WITH {levels_sql('4h')} SELECT symbol, bar_ms, price_level, {LEVEL_NAMES} FROM levels",
)
register(
    "footprint_map",
    lambda spark, d: flat(footprint.footprint_map(footprint.footprint_levels(tape_events(spark, d), "4h", EVENT_TICKS))),
)


def _side_cells(spark: SparkSession, d: str, which: str) -> DataFrame:
    levels = footprint.footprint_levels(tape_events(spark, d), "4h", EVENT_TICKS)
    side = footprint.side_footprint(levels, which).select("symbol", "time_rounded", F.explode(f"aggregated_foot_{which}").alias("m"))
    cells = side.select("symbol", "time_rounded", F.explode("m").alias("price", "cell"))
    return flat(
        cells.select(
            "symbol", "time_rounded", F.col("price").cast("double").alias("price_level"),
            F.col(f"cell.{which}_qty").alias(f"{which}_qty"), F.col(f"cell.{which}_trades").cast("bigint").alias(f"{which}_trades"),
        )
    )


for _side in ("bid", "ask"):
    register(
        f"side_footprint_{_side}",
        lambda spark, d, side=_side: _side_cells(spark, d, side),
        f"""WITH {levels_sql('4h')} SELECT symbol, bar_ms, price_level, {_side[0]}q AS {_side}_qty, {_side[0]}n AS {_side}_trades
        FROM levels WHERE {_side[0]}n > 0""",
    )
register(
    "retick_footprint",
    lambda spark, d: _map_cells(
        footprint.retick_footprint(footprint.bars_with_footprint(tape_events(spark, d), "4h", EVENT_TICKS), 0)
    ),
    f"""WITH {levels_sql('4h')}, r AS (
      SELECT symbol, bar_ms, CAST(round(CAST(price_level AS DECIMAL(18,4)), 0) AS DOUBLE) AS price_level,
      sum(bq) AS bq, CAST(sum(bn) AS BIGINT) AS bn, sum(aq) AS aq, CAST(sum(an) AS BIGINT) AS an FROM levels GROUP BY ALL)
    SELECT symbol, bar_ms, price_level, {LEVEL_NAMES} FROM r""",
)


def _exploded_json(spark: SparkSession, d: str) -> DataFrame:
    trades = tape_events(spark, d)
    text = F.to_json(F.struct("agg_trade_id", "price", "quantity"))
    minute = F.floor(F.col("transact_time") / 60000)
    packed = trades.groupBy("symbol", minute.alias("minute")).agg(F.concat_ws("", F.collect_list(text)).alias("doc"))
    fields = [f for f in AGG_TRADES.fields if f.name in ("agg_trade_id", "price", "quantity")]
    return footprint.explode_concatenated_json(packed, "doc", type(AGG_TRADES)(fields))


register(
    "explode_concatenated_json",
    _exploded_json,
    f"WITH {TAPE} SELECT symbol, t // 60000 AS minute, id AS agg_trade_id, price, qty AS quantity FROM tape",
)



def _deep_json(spark: SparkSession, d: str) -> DataFrame:
    """Objects with 50 levels of others in them, braces and quotes in values, and here and there a value of 100,000 characters."""
    number = F.col("agg_trade_id").cast("string")
    deep = '{"d":' * 50 + "1" + "}" * 50
    text = F.concat(
        F.lit('{"agg_trade_id":'), number, F.lit(',"in":' + deep + ',"note":"}{\\"{","pad":"'),
        F.when(F.col("agg_trade_id") % 997 == 0, F.repeat(F.lit("y}"), 50_000)).otherwise(""), F.lit('","price":'), F.col("price").cast("string"), F.lit("}"),
    )
    packed = tape_events(spark, d).groupBy("symbol", F.floor(F.col("transact_time") / 3600000).alias("hour")).agg(F.concat_ws(",", F.collect_list(text)).alias("doc"))
    fields = [f for f in AGG_TRADES.fields if f.name in ("agg_trade_id", "price")]
    return footprint.explode_concatenated_json(packed, "doc", type(AGG_TRADES)(fields))


register(
    "explode_deep_json",
    _deep_json,
    f"WITH {TAPE} SELECT symbol, t // 3600000 AS hour, id AS agg_trade_id, price FROM tape",
)


def _fractional(spark: SparkSession, d: str) -> DataFrame:
    """The tape with quantities of eight decimals."""
    units = (F.col("agg_trade_id") * 7919) % 100_000_007 + 1
    return tape_events(spark, d).withColumn("quantity", units.cast("double") / 1e8)


FRACTIONAL = f"{TAPE}, fine AS (SELECT symbol, id, price, t, maker, CAST((id * 7919) % 100000007 + 1 AS DOUBLE) / 100000000.0 AS q FROM tape)"


def _exactly(q: str) -> str:
    return f"CAST(sum(CAST({q} AS DECIMAL(28,8))) AS DOUBLE)"


register(
    "fractional_bars",
    lambda spark, d: flat(bars.rollup_bars(bars.ohlcv(_fractional(spark, d), "1h"), "1h", "1w")).drop("open", "close"),
    f"WITH {FRACTIONAL} SELECT symbol, t - t % 604800000 AS bar_ms, max(price) AS high, min(price) AS low, {_exactly('q')} AS qty FROM fine GROUP BY ALL",
)


def _fractional_levels(spark: SparkSession, d: str) -> DataFrame:
    """Levels by a tick table, rounded to tens, so that many prices meet on a level."""
    ticks = spark.createDataFrame([(f"S{k}", -1) for k in range(4)], "symbol string, decimals int")
    return flat(footprint.footprint_levels(_fractional(spark, d), "1w", ticks))


register(
    "fractional_levels",
    _fractional_levels,
    f"""WITH {FRACTIONAL} SELECT symbol, t - t % 604800000 AS bar_ms, CAST(round(CAST(price AS DECIMAL(18,4)), -1) AS DOUBLE) AS price_level,
    {_exactly('CASE WHEN maker THEN q ELSE 0 END')} AS total_bid_qty, count(*) FILTER (WHERE maker) AS total_bid_trades,
    {_exactly('CASE WHEN NOT maker THEN q ELSE 0 END')} AS total_ask_qty, count(*) FILTER (WHERE NOT maker) AS total_ask_trades
    FROM fine GROUP BY ALL""",
)


def _flattened(spark: SparkSession, d: str) -> DataFrame:
    """Per symbol and day one map of the last price of each minute, out of a map for every hour and another for its last trade."""
    tape = tape_events(spark, d).withColumns({"hour": F.floor(F.col("transact_time") / 3600000), "minute": F.floor(F.col("transact_time") / 60000) % 60})
    last = tape.groupBy("symbol", "hour", "minute").agg(F.max_by("price", F.struct("transact_time", "agg_trade_id")).alias("price"))
    hours = last.groupBy("symbol", "hour").agg(F.map_from_entries(F.collect_list(F.struct("minute", "price"))).alias("m"))
    days = hours.groupBy("symbol", F.floor(F.col("hour") / 24).alias("day")).agg(F.array_sort(F.collect_list(F.struct("hour", F.map_entries("m").alias("e")))).alias("ms"))
    maps = F.transform("ms", lambda x: F.map_from_entries(x["e"]))
    return days.select("symbol", "day", F.explode(footprint.flatten_maps(maps)).alias("minute", "price"))


register(
    "flattened_maps",
    _flattened,
    f"WITH {TAPE} SELECT symbol, t // 86400000 AS day, t // 60000 % 60 AS minute, last(price ORDER BY t, id) AS price FROM tape GROUP BY ALL",
)

# --- preparation ------------------------------------------------------------------------------


def _raw(spark: SparkSession, d: str) -> DataFrame:
    """The tape as a headerless file would give it: strings, unnamed columns, one header row."""
    trades = tape_events(spark, d).select("symbol", *[F.col(c).cast("string") for c in TRADE_COLUMNS])
    header = spark.range(1).select(F.lit("S0").alias("symbol"), *[F.lit(c).alias(c) for c in TRADE_COLUMNS])
    both = header.unionByName(trades)
    return both.toDF("symbol", *[f"_c{n}" for n in range(len(TRADE_COLUMNS))])


def _prepared(spark: SparkSession, d: str) -> DataFrame:
    named = prepare.rename_by_position(_raw(spark, d), ["symbol", *TRADE_COLUMNS])
    clean = prepare.canonical_trades(prepare.drop_header_rows(named))
    return prepare.drop_incomplete(clean, ["price", "quantity"])


register(
    "prepared_trades",
    _prepared,
    f"""WITH {TAPE} SELECT symbol, id AS agg_trade_id, price, qty AS quantity, id AS first_trade_id,
    id AS last_trade_id, t AS transact_time, maker AS is_buyer_maker FROM tape""",
)


def _aliased(spark: SparkSession, d: str) -> DataFrame:
    landed = tape_events(spark, d).select(
        "symbol", F.col("agg_trade_id").alias("market_raw_id"), F.col("price").cast("string"),
        F.col("quantity").alias("qty"), F.col("transact_time").alias("time"),
        F.col("is_buyer_maker").cast("string").alias("is_buyer_market"),
    )
    return prepare.canonical_trades(landed)


register(
    "landed_aliases",
    _aliased,
    f"""WITH {TAPE} SELECT symbol, id AS agg_trade_id, price, qty AS quantity, t AS transact_time,
    maker AS is_buyer_maker FROM tape""",
)


def _times(spark: SparkSession, d: str) -> DataFrame:
    timed = prepare.with_readable_time(tape_events(spark, d))
    floored = prepare.round_down_to_interval(timed, 900)
    return flat(floored).select(
        "agg_trade_id", "bar_ms", F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSS").alias("time_text")
    )


register(
    "readable_times",
    _times,
    f"""WITH {TAPE} SELECT id AS agg_trade_id, t - t % 900000 AS bar_ms,
    strftime(make_timestamp_ms(t), '%Y-%m-%d %H:%M:%S.%g') AS time_text FROM tape""",
)


def _sides(spark: SparkSession, d: str) -> DataFrame:
    split = prepare.split_sides(tape_events(spark, d))
    return split.select(
        "agg_trade_id", F.col("foot_bid.price_level").alias("bid_price"), F.col("foot_bid.bid_qty").alias("bid_qty"),
        F.col("foot_ask.price_level").alias("ask_price"), F.col("foot_ask.ask_qty").alias("ask_qty"),
    )


register(
    "split_sides",
    _sides,
    f"""WITH {TAPE} SELECT id AS agg_trade_id, CASE WHEN maker THEN price END AS bid_price,
    CASE WHEN maker THEN qty END AS bid_qty, CASE WHEN NOT maker THEN price END AS ask_price,
    CASE WHEN NOT maker THEN qty END AS ask_qty FROM tape""",
)
register(
    "bars_in_time_order",
    lambda spark, d: flat(bars.ohlcv(tape_events(spark, d), "12h").orderBy("symbol", "time_rounded")),
    f"WITH {bars_sql('12h')} SELECT symbol, bar_ms, open, close, high, low, qty FROM bars ORDER BY symbol, bar_ms",
)
register(
    "levels_in_price_order",
    lambda spark, d: flat(
        footprint.footprint_levels(tape_events(spark, d), "12h", EVENT_TICKS).orderBy("symbol", "time_rounded", "price_level")
    ),
    f"WITH {levels_sql('12h')} SELECT symbol, bar_ms, price_level, {LEVEL_NAMES} FROM levels ORDER BY 1, 2, 3",
)
register(
    "price_levels",
    lambda spark, d: footprint.with_price_level(tape_events(spark, d), EVENT_TICKS).select("agg_trade_id", "price_level"),
    f"WITH {TAPE} SELECT id AS agg_trade_id, {LEVEL} AS price_level FROM tape",
)
register(
    "minute_parts",
    lambda spark, d: prepare.with_tags(prepare.with_minute_parts(tape_events(spark, d)), exchange="xchg", timeframe="1m").select(
        "agg_trade_id", "day", "hour", "minute", "exchange", "timeframe"
    ),
    f"""WITH {TAPE} SELECT id AS agg_trade_id, strftime(make_timestamp_ms(t), '%Y-%m-%d') AS day,
    strftime(make_timestamp_ms(t), '%H') AS hour, strftime(make_timestamp_ms(t), '%M') AS minute,
    'xchg' AS exchange, '1m' AS timeframe FROM tape""",
)


def _aligned(spark: SparkSession, d: str) -> DataFrame:
    trades = tape_events(spark, d)
    early = F.col("transact_time") < 1705276800000
    schema = type(AGG_TRADES)([f for f in AGG_TRADES.fields if f.name in ("agg_trade_id", "price", "quantity", "transact_time")])
    first = align_columns(trades.where(early).drop("quantity"), schema)
    return union_periods([first, align_columns(trades.where(~early), schema)])


register(
    "aligned_periods",
    _aligned,
    f"""WITH {TAPE} SELECT id AS agg_trade_id, price, CASE WHEN t >= 1705276800000 THEN qty END AS quantity,
    t AS transact_time FROM tape""",
)


def _daily_range(spark: SparkSession, d: str) -> DataFrame:
    dated = tape_events(spark, d).withColumn("date", F.timestamp_millis("transact_time").cast("date"))
    picked = prepare.in_calendar_range(dated, "2024-01-10", "2024-01-12")
    return picked.select("symbol", "agg_trade_id", "price", "quantity", "transact_time")


register(
    "daily_range",
    _daily_range,
    f"""WITH {TAPE} SELECT symbol, id AS agg_trade_id, price, qty AS quantity, t AS transact_time FROM tape
    WHERE CAST(make_timestamp_ms(t) AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
)


def _messages(spark: SparkSession, d: str) -> DataFrame:
    """Live messages: every trade, every tenth also as another event type, and broken text."""
    trades = tape_events(spark, d)
    text = {
        "E": F.col("transact_time") + 5, "T": F.col("transact_time"), "s": F.col("symbol"), "a": F.col("agg_trade_id"),
        "p": F.col("price").cast("string"), "q": F.col("quantity").cast("string"), "m": F.col("is_buyer_maker"),
    }

    def message(kind: str) -> Column:
        body = F.concat_ws(
            ",",
            F.concat(F.lit(f'"e":"{kind}"')),
            *[F.concat(F.lit(f'"{k}":'), F.lit('"') if k in "spq" else F.lit(""), c.cast("string"), F.lit('"') if k in "spq" else F.lit("")) for k, c in text.items()],
        )
        return F.concat(F.lit("{"), body, F.lit("}"))

    kinds = F.array(message("aggTrade"), message("kline"), F.lit("{broken"))
    return trades.select(F.explode(kinds).alias("value"))


register(
    "decode_messages",
    lambda spark, d: decode_messages(_messages(spark, d)),
    f"""WITH {TAPE} SELECT symbol, id AS agg_trade_id, price, qty AS quantity, t + 5 AS event_time,
    t AS transact_time, maker AS is_buyer_maker FROM tape""",
)

# --- statistics -------------------------------------------------------------------------------

register(
    "trade_summary",
    lambda spark, d: rounded(stats.trade_summary(tape_events(spark, d)), "total_value", "average_price", "average_quantity"),
    f"""WITH {TAPE} SELECT symbol, count(*) AS total_trades, sum(qty) AS total_volume,
    round(CAST(sum(CAST(price AS DECIMAL(18,4)) * CAST(qty AS DECIMAL(18,4))) AS DOUBLE), 6) AS total_value,
    round(CAST(sum(CAST(price AS DECIMAL(18,4))) AS DOUBLE) / count(*), 6) AS average_price, round(avg(qty), 6) AS average_quantity, max(price) AS max_price,
    min(price) AS min_price, count(*) FILTER (WHERE maker) AS buyer_market_trades,
    count(*) FILTER (WHERE NOT maker) AS seller_market_trades FROM tape GROUP BY symbol""",
)


def _timings(spark: SparkSession, d: str) -> DataFrame:
    return tape_events(spark, d).select(F.col("price").alias("elapsed_time"), F.col("quantity").alias("trade_count"))


register(
    "value_stats",
    lambda spark, d: rounded(
        stats.timing_stats(_timings(spark, d)), "mean_time", "std_dev_time", "mean_trades_per_call", "median_time"
    ),
    f"""WITH {TAPE} SELECT round(avg(price), 6) AS mean_time, round(median(price), 6) AS median_time,
    round(stddev_pop(price), 6) AS std_dev_time, min(price) AS min_time, max(price) AS max_time,
    sum(qty) AS total_trades, round(avg(qty), 6) AS mean_trades_per_call FROM tape""",
)
register(
    "value_histogram",
    lambda spark, d: rounded(stats.histogram(_timings(spark, d), "elapsed_time"), "bin_start", "bin_end"),
    f"""WITH {TAPE}, r AS (SELECT min(price) AS lo, max(price) AS hi FROM tape),
    c AS (SELECT least(CAST(floor((price - lo) / (hi - lo) * 20) AS BIGINT), 19) AS bin, count(*) AS n FROM tape, r GROUP BY 1)
    SELECT CAST(s.bin AS BIGINT) AS bin, round(lo + (hi - lo) * s.bin / 20, 6) AS bin_start,
    round(lo + (hi - lo) * (s.bin + 1) / 20, 6) AS bin_end, coalesce(n, 0) AS n
    FROM range(20) s(bin) CROSS JOIN r LEFT JOIN c ON c.bin = s.bin""",
)
register(
    "rate_per_minute",
    lambda spark, d: stats.rate_per_minute(tape_events(spark, d)),
    f"WITH {TAPE} SELECT symbol, t - t % 60000 AS minute_ms, count(*) AS n FROM tape GROUP BY ALL",
)
register(
    "last_seen",
    lambda spark, d: stats.last_seen(tape_events(spark, d), 1706745600000),
    f"WITH {TAPE} SELECT symbol, max(t) AS last_ms, 1706745600000 - max(t) AS stale_ms FROM tape GROUP BY symbol",
)
register(
    "symbols",
    lambda spark, d: stats.symbols(tape_events(spark, d)),
    f"WITH {TAPE} SELECT DISTINCT symbol FROM tape",
)


def _universe(spark: SparkSession, d: str) -> DataFrame:
    users = tape_events(spark, d).join(
        spark.read.parquet(f"{d}/events.parquet").select(F.col("event_id").alias("agg_trade_id"), "user_id"), "agg_trade_id"
    )
    quote = F.when(F.col("user_id") % 3 == 0, "BUSD").otherwise("USDT")
    base = F.when(F.col("user_id") % 7 == 0, F.concat(F.lit("USDC"), F.col("user_id"))).otherwise(F.concat(F.lit("C"), F.col("user_id")))
    tickers = users.groupBy(F.concat(base, quote).alias("symbol")).agg(
        F.count(F.lit(1)).cast("string").alias("trades"), F.sum("quantity").cast("string").alias("volume")
    )
    return stats.universe_top_n(tickers, ["trades", "volume", "absent"], 50)


register(
    "universe_top_n",
    _universe,
    """SELECT symbol, trades, volume, 0.0::DOUBLE AS absent FROM (
      SELECT (CASE WHEN user_id % 7 = 0 THEN 'USDC' ELSE 'C' END) || CAST(user_id AS VARCHAR)
        || (CASE WHEN user_id % 3 = 0 THEN 'BUSD' ELSE 'USDT' END) AS symbol,
        CAST(count(*) AS DOUBLE) AS trades, sum(CAST(json_extract_string(props, '$.k') AS DOUBLE) + 1) AS volume
      FROM events GROUP BY 1)
    WHERE symbol LIKE '%USDT' AND symbol NOT LIKE 'USDC%' ORDER BY trades DESC, volume DESC, symbol LIMIT 50""",
)
register(
    "latest_n_minutes",
    lambda spark, d: stats.latest_minutes_for(tape_events(spark, d), "15m").select("minute_ms", "symbol", "agg_trade_id"),
    f"""WITH {TAPE} SELECT t - t % 60000 AS minute_ms, symbol, id AS agg_trade_id FROM tape
    WHERE t - t % 60000 IN (SELECT DISTINCT t - t % 60000 AS m FROM tape ORDER BY m DESC LIMIT 15)""",
)

# --- wide-column form -------------------------------------------------------------------------

WIDE_KEYS = "'xchg#' || symbol || '#4h#' || CAST(bar_ms AS VARCHAR)"


def _bar_cells(spark: SparkSession, d: str) -> DataFrame:
    cells = wide.bar_cells(bars.ohlcv(tape_events(spark, d), "4h"), "xchg")
    return cells.select("row_key", "qualifier", F.col("value").cast("double").alias("number"))


register(
    "wide_rows",
    _bar_cells,
    f"""WITH {bars_sql('4h')} SELECT {WIDE_KEYS} AS row_key, q AS qualifier, v AS number FROM bars,
    LATERAL (VALUES ('open', open), ('close', close), ('high', high), ('low', low), ('qty', qty)) x(q, v)""",
)


def _pivoted(spark: SparkSession, d: str) -> DataFrame:
    cells = wide.bar_cells(bars.ohlcv(tape_events(spark, d), "4h"), "xchg", ("open", "close", "high", "low"))
    kinds = {"open": "double", "close": "double", "high": "double", "low": "double", "volume": "double"}
    return wide.scan_prefix(cells, "xchg#S1", kinds)


register(
    "wide_pivot",
    _pivoted,
    f"""WITH {bars_sql('4h')} SELECT {WIDE_KEYS} AS row_key, open, close, high, low, CAST(NULL AS DOUBLE) AS volume
    FROM bars WHERE symbol = 'S1'""",
)
register(
    "trade_row_keys",
    lambda spark, d: wide.trade_row_keys(tape_events(spark, d)).select("agg_trade_id", "row_key"),
    f"""WITH {TAPE} SELECT id AS agg_trade_id, symbol || '#' || strftime(make_timestamp_ms(t), '%Y-%m') || '#'
    || CAST(row_number() OVER (PARTITION BY symbol, strftime(make_timestamp_ms(t), '%Y-%m') ORDER BY t, id) - 1 AS VARCHAR)
    AS row_key FROM tape""",
)

# --- lifecycle --------------------------------------------------------------------------------


def _copies(spark: SparkSession, d: str) -> DataFrame:
    """The tape with a later, corrected copy of every trade of the second half of the month."""
    trades = tape_events(spark, d).select("symbol", "agg_trade_id", "price", "quantity", "transact_time")
    late = F.col("transact_time") >= 1705276800000
    return trades, trades.where(late).withColumn("quantity", F.col("quantity") + 1000)


register(
    "dedupe_keep_last",
    lambda spark, d: lifecycle.append_and_dedupe(*_copies(spark, d)),
    f"""WITH {TAPE} SELECT symbol, id AS agg_trade_id, price,
    qty + CASE WHEN t >= 1705276800000 THEN 1000 ELSE 0 END AS quantity, t AS transact_time FROM tape""",
)
register(
    "dedupe_by_time",
    lambda spark, d: lifecycle.newest_per_key(
        tape_events(spark, d).withColumn("second", F.floor(F.col("transact_time") / 1000)).select("symbol", "second", "agg_trade_id", "price"),
        ["symbol", "second"], ["agg_trade_id"],
    ),
    f"""WITH {TAPE} SELECT symbol, t // 1000 AS second, max(id) AS agg_trade_id, arg_max(price, id) AS price
    FROM tape GROUP BY 1, 2""",
)


def _merged_month(spark: SparkSession, d: str) -> DataFrame:
    trades = tape_events(spark, d).select("symbol", "agg_trade_id", "price", "quantity", "transact_time")
    day_start = 1706572800000
    month = trades.where(F.col("transact_time") < day_start + 3600000)
    day = trades.where(F.col("transact_time") >= day_start).withColumn("price", F.col("price") * 2)
    return lifecycle.merge_day_into_month(month, day)


register(
    "merge_day_into_month",
    _merged_month,
    f"""WITH {TAPE} SELECT symbol, id AS agg_trade_id, CASE WHEN t >= 1706572800000 THEN price * 2 ELSE price END AS price,
    qty AS quantity, t AS transact_time FROM tape""",
)


def _snapshots(spark: SparkSession, d: str) -> DataFrame:
    events = spark.read.parquet(f"{d}/events.parquet")
    docs = events.select(
        F.col("event_type").alias("task"), F.date_format(F.col("ts"), "yyyy-MM-dd").alias("day"), F.col("props").alias("doc")
    )
    stored = docs.where(F.get_json_object("doc", "$.k").cast("int") < 50)
    return lifecycle.absent_documents(stored, docs)


register(
    "snapshot_append_if_absent",
    _snapshots,
    """SELECT DISTINCT event_type AS task, strftime(ts, '%Y-%m-%d') AS day, props AS doc FROM events
    WHERE CAST(json_extract_string(props, '$.k') AS INT) >= 50""",
)


def _days(spark: SparkSession, d: str) -> DataFrame:
    return tape_events(spark, d).select(
        "symbol", F.date_format(F.timestamp_millis("transact_time"), "yyyy-MM-dd").alias("period")
    )


def _resume(spark: SparkSession, d: str) -> DataFrame:
    present = _days(spark, d).distinct()
    wanted = lifecycle.requested_days(present.select("symbol").distinct(), "2024-01-01", "2024-02-29")
    wanted = wanted.select("symbol", F.date_format("date", "yyyy-MM-dd").alias("period"))
    return lifecycle.pending(wanted, present, ["symbol", "period"])


register(
    "resume_pending",
    _resume,
    f"""WITH {TAPE}, days AS (SELECT CAST(g AS DATE) AS day FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-29', INTERVAL 1 DAY) x(g))
    SELECT symbol, strftime(day, '%Y-%m-%d') AS period FROM (SELECT DISTINCT symbol FROM tape), days
    EXCEPT SELECT symbol, strftime(make_timestamp_ms(t), '%Y-%m-%d') FROM tape""",
)


def _backfill(spark: SparkSession, d: str) -> DataFrame:
    trades = tape_events(spark, d)
    symbols = stats.symbols(trades)
    have = trades.where(F.col("symbol") != "S3").select(
        "symbol", F.date_format(F.timestamp_millis("transact_time"), "yyyy-MM").alias("period")
    ).distinct()
    return lifecycle.backfill_plan(symbols, have, F.lit("2023-11-15").cast("date"), F.lit("2024-02-10").cast("date"))


register(
    "backfill_plan",
    _backfill,
    f"""WITH {TAPE}, s AS (SELECT DISTINCT symbol FROM tape),
    m(period) AS (VALUES ('2023-11'), ('2023-12'), ('2024-01')),
    have AS (SELECT DISTINCT symbol, strftime(make_timestamp_ms(t), '%Y-%m') AS period FROM tape WHERE symbol <> 'S3')
    SELECT symbol, 'month' AS kind, period FROM s, m WHERE (symbol, period) NOT IN (SELECT symbol, period FROM have)
    UNION ALL SELECT symbol, 'day', '2024-02-0' || CAST(d AS VARCHAR) FROM s, range(1, 10) x(d)""",
)


def _fallback(spark: SparkSession, d: str) -> DataFrame:
    trades = tape_events(spark, d).select("symbol", "agg_trade_id", "price", "transact_time")
    dated = trades.withColumn("month", F.date_format(F.timestamp_millis("transact_time"), "yyyy-MM"))
    return lifecycle.daily_fallback(dated.where(F.col("symbol").isin("S0", "S1")), dated.withColumn("price", -F.col("price")))


register(
    "daily_fallback",
    _fallback,
    f"""WITH {TAPE} SELECT symbol, id AS agg_trade_id, CASE WHEN symbol IN ('S0', 'S1') THEN price ELSE -price END AS price,
    t AS transact_time, strftime(make_timestamp_ms(t), '%Y-%m') AS month FROM tape""",
)

AS_OF = "2024-01-20 13:30:00"


def _archive(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    trades = tape_events(spark, d).select("symbol", "agg_trade_id", "transact_time")
    return lifecycle.split_archive(trades, F.lit(AS_OF).cast("timestamp"))


register(
    "purge_archive",
    lambda spark, d: _archive(spark, d)[0].orderBy(F.col("transact_time").desc()),
    f"WITH {TAPE} SELECT symbol, id AS agg_trade_id, t AS transact_time FROM tape WHERE t < epoch_ms(TIMESTAMP '2024-01-20')",
)
register(
    "purge_keep",
    lambda spark, d: lifecycle.not_archived(
        tape_events(spark, d).select("symbol", "agg_trade_id", "transact_time"), _archive(spark, d)[0]
    ),
    f"WITH {TAPE} SELECT symbol, id AS agg_trade_id, t AS transact_time FROM tape WHERE t >= epoch_ms(TIMESTAMP '2024-01-20')",
)


def _probe(spark: SparkSession, d: str) -> DataFrame:
    trades = tape_events(spark, d)
    wanted = trades.select("symbol", (F.col("agg_trade_id") + 1).alias("agg_trade_id"))
    return lifecycle.existing_keys(wanted, trades, ["symbol", "agg_trade_id"])


register(
    "probe_existing",
    _probe,
    f"""WITH {TAPE} SELECT a.symbol, a.id + 1 AS agg_trade_id FROM tape a JOIN tape b ON b.symbol = a.symbol AND b.id = a.id + 1""",
)


def _coverage(spark: SparkSession, d: str) -> DataFrame:
    source = bars.ohlcv(tape_events(spark, d), "1h")
    cut = F.when(F.col("symbol") == "S0", "2025-01-01").when(F.col("symbol") == "S1", "2024-01-15").otherwise("2023-01-01")
    state = lifecycle.coverage(source, source.where(F.col("time_rounded") < cut.cast("timestamp")), look_back=50)
    return state.select(
        "symbol", "state", F.unix_millis("source_last").alias("source_ms"), F.unix_millis("target_last").alias("target_ms"),
        F.unix_millis("recompute_from").alias("from_ms"),
    )


register(
    "coverage_gaps",
    _coverage,
    f"""WITH {bars_sql('1h')}, s AS (SELECT symbol, max(bar_ms) AS source_ms FROM bars GROUP BY 1),
    h AS (SELECT symbol, max(bar_ms) AS target_ms FROM bars WHERE symbol = 'S0'
      OR (symbol = 'S1' AND bar_ms < epoch_ms(TIMESTAMP '2024-01-15')) GROUP BY 1)
    SELECT symbol, CASE WHEN target_ms IS NULL THEN 'missing' WHEN target_ms < source_ms THEN 'incomplete' ELSE 'complete' END AS state,
    source_ms, target_ms, CASE WHEN target_ms < source_ms THEN target_ms - 50 * 3600000 END AS from_ms FROM s LEFT JOIN h USING (symbol)""",
)


def _mismatches(spark: SparkSession, d: str) -> DataFrame:
    frame = event_bars(spark, d, "4h")
    table = batch.analysis_table(frame, event_levels(spark, d, "4h"))
    return lifecycle.key_mismatches(frame, staged(table), ["symbol", "time_rounded"])


register(
    "analysis_one_row_per_bar",
    lambda spark, d: flat(_mismatches(spark, d)),
    "SELECT CAST(NULL AS VARCHAR) AS symbol, CAST(NULL AS BIGINT) AS bar_ms, CAST(NULL AS VARCHAR) AS problem WHERE false",
)


def _injected(spark: SparkSession, d: str) -> DataFrame:
    """Bars against a copy that lacks every seventh, has every eleventh twice and every thirteenth a second time a year later."""
    bars = staged(index_bars(event_bars(spark, d, "4h")).select("symbol", "time_rounded", "i"))
    later = bars.where("i % 13 = 0").withColumn("time_rounded", F.col("time_rounded") + F.expr("interval 366 days"))
    copy = bars.where("i % 7 > 0").unionByName(bars.where("i % 7 > 0 AND i % 11 = 0")).unionByName(later)
    return flat(lifecycle.key_mismatches(bars, copy, ["symbol", "time_rounded"]))


register(
    "key_mismatches",
    _injected,
    f"""WITH {bars_sql('4h')} SELECT symbol, bar_ms, 'absent' AS problem FROM bars WHERE i % 7 = 0
    UNION ALL SELECT symbol, bar_ms + CAST(366 AS BIGINT) * 86400000, 'extra' FROM bars WHERE i % 13 = 0
    UNION ALL SELECT symbol, bar_ms, 'repeated' FROM bars WHERE i % 7 > 0 AND i % 11 = 0""",
)
