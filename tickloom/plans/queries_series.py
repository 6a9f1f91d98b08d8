"""Queries on series of bars: volume profile, clusters, deltas and indicators."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.operators import footprint, prepare, profile
from tickloom.operators.indicators.registry import CATALOGUE, add_indicators, build, indicator_table
from tickloom.operators.series import index_bars
from tickloom.plans import batch
from tickloom.plans.catalog import (
    ORACLES, TAPE, bars_sql, flat, indexed_levels_sql, levels_sql, profile_sql, register, rounded, smooth_sql,
)
from tickloom.plans.indicators import extend_indicator_table, read_indicator_table
from tickloom.plans.stage import shared_folder, staged
from tickloom.plans.tape import EVENT_TICKS, event_bars, event_levels, tape_events
from tickloom.operators.bars import ohlcv

# --- per-bar measures -------------------------------------------------------------------------

register(
    "bar_index",
    lambda spark, d: flat(index_bars(event_bars(spark, d, "1h"))).select("symbol", "bar_ms", "i", "n_bars"),
    f"WITH {bars_sql('1h')} SELECT symbol, bar_ms, i, count(*) OVER (PARTITION BY symbol) AS n_bars FROM bars",
)
register(
    "delta_x",
    lambda spark, d: flat(profile.top_level_imbalance(footprint.footprint_levels(tape_events(spark, d), "4h", EVENT_TICKS))),
    f"""WITH {levels_sql('4h')}, r AS (SELECT *, row_number() OVER (PARTITION BY symbol, bar_ms ORDER BY aq DESC) AS ra,
      row_number() OVER (PARTITION BY symbol, bar_ms ORDER BY bq DESC) AS rb FROM levels)
    SELECT symbol, bar_ms, sum(CASE WHEN ra <= 3 THEN aq ELSE 0 END) - sum(CASE WHEN rb <= 3 THEN bq ELSE 0 END) AS delta_x
    FROM r GROUP BY ALL""",
)
register(
    "level_means",
    lambda spark, d: rounded(
        flat(profile.level_means(footprint.footprint_levels(tape_events(spark, d), "4h", EVENT_TICKS))),
        "bid_average", "ask_average", "bid_ask_average",
    ),
    f"""WITH {levels_sql('4h')} SELECT symbol, bar_ms, round(avg(bq), 6) AS bid_average, round(avg(aq), 6) AS ask_average,
    round(avg(bq + aq), 6) AS bid_ask_average FROM levels GROUP BY ALL""",
)
register(
    "side_trade_totals",
    lambda spark, d: flat(profile.bar_totals(footprint.footprint_levels(tape_events(spark, d), "4h", EVENT_TICKS))),
    f"""WITH {levels_sql('4h')} SELECT symbol, bar_ms, sum(bq) AS bid, sum(aq) AS ask, CAST(sum(bn) AS BIGINT) AS bid_trades,
    CAST(sum(an) AS BIGINT) AS ask_trades FROM levels GROUP BY ALL""",
)

TOTALS = f"""{levels_sql('1h')}, tot AS (SELECT symbol, bar_ms, sum(bq) AS bid, sum(aq) AS ask,
  row_number() OVER (PARTITION BY symbol ORDER BY bar_ms) - 1 AS i FROM levels GROUP BY symbol, bar_ms)"""


def _totals(spark: SparkSession, d: str) -> DataFrame:
    return staged(profile.bar_totals(footprint.footprint_levels(tape_events(spark, d), "1h", EVENT_TICKS)))


register(
    "delta_cum",
    lambda spark, d: rounded(
        flat(profile.cumulative_delta(_totals(spark, d))).select("symbol", "bar_ms", "delta", "cumulative_delta"), "cumulative_delta"
    ),
    f"""WITH {TOTALS} SELECT symbol, bar_ms, ask - bid AS delta,
    round(sum(ask - bid) OVER (PARTITION BY symbol ORDER BY i) / 10000, 6) AS cumulative_delta FROM tot""",
)
register(
    "delta_ema",
    lambda spark, d: rounded(
        flat(profile.delta_columns(_totals(spark, d))).select("symbol", "bar_ms", "delta_bid", "delta_ask", "delta_ema"),
        "delta_bid", "delta_ask", "delta_ema",
    ),
    f"""WITH RECURSIVE {TOTALS}, {smooth_sql('eb', 'tot', 'bid', 9, '0.2')}, {smooth_sql('ea', 'tot', 'ask', 9, '0.2')}
    SELECT symbol, bar_ms, round(eb.y, 6) AS delta_bid, round(ea.y, 6) AS delta_ask, round(ea.y - eb.y, 6) AS delta_ema
    FROM tot LEFT JOIN eb USING (symbol, i) LEFT JOIN ea USING (symbol, i)""",
)

# --- rolling profile --------------------------------------------------------------------------

register(
    "rolling_profile",
    lambda spark, d: flat(profile.rolling_profile(profile.with_bar_index(event_levels(spark, d)))).drop("first_bar"),
    f"WITH {profile_sql('4h')} SELECT symbol, i, price_level, volume FROM prof",
)
register(
    "poc_value_area",
    lambda spark, d: flat(profile.poc_value_area(event_levels(spark, d))),
    f"WITH {profile_sql('4h')} SELECT symbol, i, poc, val, vah, poc_rank FROM area",
)


def _clusters(spark: SparkSession, d: str, timeframe: str, gate: str) -> DataFrame:
    # One trade-sized level rarely exceeds the default share, so the queries use a lower one.
    found = profile.volume_clusters(event_levels(spark, d, timeframe), factor=CLUSTER_SHARE, gate=gate)
    return flat(found).select("symbol", "bar_ms", "price_level", "side", "side_qty")


CLUSTER_SHARE = 0.0008


def _clusters_sql(timeframe: str, gate: str) -> str:
    base = profile_sql(timeframe) if gate == "poc_rank" else indexed_levels_sql(timeframe)
    admitted = "i IN (SELECT a.i FROM area a WHERE a.symbol = r.symbol AND a.poc_rank >= 50)" if gate == "poc_rank" else "i >= 50"
    return f"""{base}, m AS (SELECT symbol, bar_ms, i, avg(bq) AS b, avg(aq) AS a FROM lev GROUP BY ALL),
    r AS (SELECT *, sum(b) OVER w AS bs, sum(a) OVER w AS sa FROM m
          WINDOW w AS (PARTITION BY symbol ORDER BY i ROWS 49 PRECEDING)),
    g AS (SELECT * FROM r WHERE {admitted}),
    c AS (SELECT l.symbol, l.bar_ms, l.price_level, 'bid' AS side, l.bq AS side_qty, g.bs AS recent FROM lev l JOIN g USING (symbol, i)
          WHERE g.b > 0 AND g.bs > 0 AND l.bq / g.bs / 50 > {CLUSTER_SHARE}
          UNION ALL
          SELECT l.symbol, l.bar_ms, l.price_level, 'ask', l.aq, g.sa FROM lev l JOIN g USING (symbol, i)
          WHERE g.a > 0 AND g.sa > 0 AND l.aq / g.sa / 50 > {CLUSTER_SHARE})"""


for _gate, _name in (("bar_index", "clusters"), ("poc_rank", "clusters_poc_rank")):
    register(
        _name,
        lambda spark, d, gate=_gate: _clusters(spark, d, "4h", gate),
        f"WITH {_clusters_sql('4h', _gate)} SELECT symbol, bar_ms, price_level, side, side_qty FROM c",
    )
register(
    "cluster_range",
    lambda spark, d: profile.cluster_range(profile.volume_clusters(event_levels(spark, d), factor=CLUSTER_SHARE)),
    f"WITH {_clusters_sql('4h', 'bar_index')} SELECT side, min(side_qty) AS min_qty, max(side_qty) AS max_qty FROM c GROUP BY side",
)


def _cluster_maps(spark: SparkSession, d: str) -> DataFrame:
    levels = event_levels(spark, d)
    return profile.cluster_maps(levels, profile.volume_clusters(levels, factor=CLUSTER_SHARE))


LABEL_SQL = "CAST(round(c.side_qty, 4) AS VARCHAR) || '|x' || CAST(round(c.side_qty * 1000 / c.recent / 50, 1) AS VARCHAR)"


def _cluster_entries(spark: SparkSession, d: str) -> DataFrame:
    """The entries of both maps of every bar, and the size of the maps."""
    maps = flat(_cluster_maps(spark, d)).withColumns({f"{s}_size": F.size(f"cluster_{s}").cast("bigint") for s in ("bid", "ask")})
    sides = [
        maps.select("symbol", "bar_ms", "bid_size", "ask_size", F.lit(side).alias("side"), F.explode_outer(f"cluster_{side}").alias("price", "label"))
        for side in ("bid", "ask")
    ]
    return sides[0].unionByName(sides[1]).withColumn("price", F.col("price").cast("double"))


register(
    "cluster_labels",
    _cluster_entries,
    f"""WITH {_clusters_sql('4h', 'bar_index')}, n AS (SELECT symbol, bar_ms, side, count(*) AS size FROM c GROUP BY ALL),
    e AS (SELECT DISTINCT symbol, bar_ms FROM levels)
    SELECT symbol, bar_ms, coalesce(b.size, 0) AS bid_size, coalesce(a.size, 0) AS ask_size, s.side, c.price_level AS price,
      {LABEL_SQL} AS label
    FROM e CROSS JOIN (VALUES ('bid'), ('ask')) s(side) LEFT JOIN c USING (symbol, bar_ms, side)
    LEFT JOIN (SELECT * FROM n WHERE side = 'bid') b USING (symbol, bar_ms) LEFT JOIN (SELECT * FROM n WHERE side = 'ask') a USING (symbol, bar_ms)""",
)
register(
    "bars_with_clusters",
    lambda spark, d: flat(profile.bars_with_clusters(_cluster_maps(spark, d))).select(
        "symbol", "bar_ms", F.size("cluster_bid").cast("bigint").alias("n")
    ),
    f"""WITH {_clusters_sql('4h', 'bar_index')} SELECT symbol, bar_ms, count(*) AS n FROM c WHERE side = 'bid' GROUP BY ALL""",
)


def _analysis(spark: SparkSession, d: str) -> DataFrame:
    out = flat(batch.analysis_table(event_bars(spark, d, "4h"), event_levels(spark, d, "4h")))
    out = rounded(out, "delta_bid", "delta_ask", "delta_ema", "cumulative_delta", "bid_average", "ask_average")
    return out.select(
        "symbol", "bar_ms", "i", "open", "close", "delta", "cumulative_delta", "delta_ema", "delta_x", "bid_average", "ask_average",
        "poc", "val", "vah",
    )


register(
    "analysis_table",
    _analysis,
    f"""WITH RECURSIVE {profile_sql('4h')}, b AS (SELECT symbol, t - t % 14400000 AS bar_ms, first(price ORDER BY t, id) AS open,
      last(price ORDER BY t, id) AS close FROM tape GROUP BY ALL),
    tot AS (SELECT symbol, bar_ms, i, sum(bq) AS bid, sum(aq) AS ask, round(avg(bq), 6) AS bid_average,
      round(avg(aq), 6) AS ask_average FROM lev GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY symbol, bar_ms ORDER BY aq DESC) AS ra,
      row_number() OVER (PARTITION BY symbol, bar_ms ORDER BY bq DESC) AS rb FROM levels),
    dx AS (SELECT symbol, bar_ms, sum(CASE WHEN ra <= 3 THEN aq ELSE 0 END) - sum(CASE WHEN rb <= 3 THEN bq ELSE 0 END) AS delta_x
      FROM r GROUP BY ALL),
    {smooth_sql('eb', 'tot', 'bid', 9, '0.2')}, {smooth_sql('ea', 'tot', 'ask', 9, '0.2')}
    SELECT symbol, bar_ms, i, open, close, ask - bid AS delta,
      round(sum(ask - bid) OVER (PARTITION BY symbol ORDER BY i) / 10000, 6) AS cumulative_delta,
      round(ea.y - eb.y, 6) AS delta_ema, delta_x, bid_average, ask_average, poc, val, vah
    FROM b JOIN tot USING (symbol, bar_ms) JOIN dx USING (symbol, bar_ms) LEFT JOIN eb USING (symbol, i)
    LEFT JOIN ea USING (symbol, i) LEFT JOIN area USING (symbol, i)""",
)


def _frame(spark: SparkSession, d: str) -> DataFrame:
    final = footprint.bars_with_footprint(tape_events(spark, d), "4h", EVENT_TICKS)
    frame = prepare.analysis_frame(final)
    return frame.withColumn("bar_ms", F.unix_millis("date")).drop("date", "timeframe", "footprint")


register(
    "analysis_frame",
    _frame,
    f"""WITH {TAPE} SELECT symbol, t - t % 14400000 AS bar_ms, first(price ORDER BY t, id) AS open,
    last(price ORDER BY t, id) AS close, max(price) AS high, min(price) AS low, sum(qty) AS volume,
    sum(CASE WHEN maker THEN qty ELSE 0 END) AS total_bid_qty,
    sum(CASE WHEN NOT maker THEN qty ELSE 0 END) AS total_ask_qty FROM tape GROUP BY ALL""",
)

# --- indicators -------------------------------------------------------------------------------

# Bars with short names; x is the price source.
SERIES = f"""{bars_sql('1h')}, s AS (SELECT symbol, bar_ms, i, open AS o, close AS c, high AS h, low AS l, qty AS v, close AS x,
  (high + low + close) / 3 AS tp, lag(close) OVER q AS c1, lag(high) OVER q AS h1, lag(low) OVER q AS l1,
  lag((high + low + close) / 3) OVER q AS tp1 FROM bars WINDOW q AS (PARTITION BY symbol ORDER BY i))"""


def _rows(n: int) -> str:
    return f"(PARTITION BY symbol ORDER BY i ROWS {n - 1} PRECEDING)"


def _compared(table: DataFrame, outputs: dict[str, str], places: int = 6) -> DataFrame:
    return flat(table).select("symbol", "bar_ms", *[F.round(F.col(f"`{c}`"), places).alias(alias) for c, alias in outputs.items()])


OUTPUTS: dict[str, dict[str, str]] = {}


def _indicator(name: str, outputs: dict[str, str], make, sql: str | None, places: int = 6) -> None:
    """Register an indicator over the 1h bars; ``outputs`` maps its columns to oracle columns."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        return _compared(add_indicators(event_bars(spark, d, "1h"), [make()]), outputs, places)

    if sql is not None:
        head, body = ("", sql) if "§" not in sql else sql.split("§", 1)
        chosen = ", ".join(f"round({alias}, {places}) AS {alias}" for alias in outputs.values())
        recursive = "RECURSIVE " if "UNION ALL" in head else ""
        sql = f"WITH {recursive}{SERIES}{', ' + head if head else ''} SELECT symbol, bar_ms, {chosen} FROM ({body})"
    OUTPUTS[name] = outputs
    register(name, query, sql)


def _weights(n: int, weight: str, source: str = "x", table: str = "s") -> str:
    """Weighted mean over the newest n rows; ``weight`` is an expression in k = 1..n, newest last."""
    return f"""SELECT b.symbol, b.i, CASE WHEN count(a.{source}) = {n} THEN sum(a.{source} * w) / sum(w) END AS y
    FROM {table} b JOIN (SELECT *, 0 AS one FROM {table}) a ON a.symbol = b.symbol AND a.i BETWEEN b.i - {n - 1} AND b.i,
    LATERAL (SELECT {weight} AS w FROM (SELECT a.i - b.i + {n} AS k)) z GROUP BY b.symbol, b.i"""


def _weighted(name: str, out: str, n: int, weight: str) -> None:
    _indicator(
        name, {out: name}, lambda: build(name.split("_")[0], {"length": n}),
        f"w AS ({_weights(n, weight)})§SELECT symbol, bar_ms, y AS {name} FROM s JOIN w USING (symbol, i)",
    )


_indicator(
    "sma_50", {"SMA_50": "sma_50"}, lambda: build("sma", {"length": 50}),
    f"SELECT symbol, bar_ms, CASE WHEN i >= 49 THEN avg(x) OVER {_rows(50)} END AS sma_50 FROM s",
)
_weighted("wma_30", "WMA_30", 30, "k")
_weighted("sinwma_14", "SINWMA_14", 14, "sin(k * pi() / 15)")
_weighted("alma_9", "ALMA_9", 9, "exp(-pow(k - 1 - 0.85 * 8, 2) / (2 * pow(9 / 6.0, 2)))")
_weighted("swma_10", "SWMA_10", 10, "least(k, 11 - k)")
_weighted("fwma_10", "FWMA_10", 10, "([1, 1, 2, 3, 5, 8, 13, 21, 34, 55])[k]")
_indicator(
    "hma_9", {"HMA_9": "hma_9"}, lambda: build("hma", {"length": 9}),
    f"""w4 AS ({_weights(4, 'k')}), w9 AS ({_weights(9, 'k')}),
    raw AS (SELECT symbol, i, 2 * w4.y - w9.y AS x FROM w4 JOIN w9 USING (symbol, i)), w AS ({_weights(3, 'k', 'x', 'raw')})
    §SELECT symbol, bar_ms, y AS hma_9 FROM s JOIN w USING (symbol, i)""",
)
_indicator(
    "trima_10", {"TRIMA_10": "trima_10"}, lambda: build("trima", {"length": 10}),
    f"""m AS (SELECT symbol, bar_ms, i, CASE WHEN i >= 5 THEN avg(x) OVER {_rows(6)} END AS x FROM s)
    §SELECT symbol, bar_ms, CASE WHEN i >= 10 THEN avg(x) OVER {_rows(6)} END AS trima_10 FROM m""",
)
_indicator(
    "linreg_14", {"LR_14": "linreg_14"}, lambda: build("linreg", {"length": 14}),
    f"""SELECT symbol, bar_ms, CASE WHEN i >= 13 THEN regr_intercept(x, i) OVER {_rows(14)} + regr_slope(x, i) OVER {_rows(14)} * i END
    AS linreg_14 FROM s""",
    places=5,
)
_indicator(
    "vwma_10", {"VWMA_10": "vwma_10"}, lambda: build("vwma", {"length": 10}),
    f"SELECT symbol, bar_ms, CASE WHEN i >= 9 THEN sum(x * v) OVER {_rows(10)} / sum(v) OVER {_rows(10)} END AS vwma_10 FROM s",
)
_indicator(
    "vwap_14", {"VWAP_14": "vwap_14"}, lambda: build("vwap", {"length": 14}),
    f"SELECT symbol, bar_ms, CASE WHEN i >= 13 THEN sum(tp * v) OVER {_rows(14)} / sum(v) OVER {_rows(14)} END AS vwap_14 FROM s",
)
_indicator(
    "stoch", {"STOCHk_14_3_3": "stoch_k", "STOCHd_14_3_3": "stoch_d"}, lambda: build("stoch"),
    f"""r AS (SELECT symbol, bar_ms, i, CASE WHEN i >= 13 THEN 100 * (c - min(l) OVER {_rows(14)})
      / nullif(max(h) OVER {_rows(14)} - min(l) OVER {_rows(14)}, 0) END AS raw FROM s),
    k AS (SELECT *, CASE WHEN count(raw) OVER {_rows(3)} = 3 THEN avg(raw) OVER {_rows(3)} END AS stoch_k FROM r)
    §SELECT symbol, bar_ms, stoch_k, CASE WHEN count(stoch_k) OVER {_rows(3)} = 3 THEN avg(stoch_k) OVER {_rows(3)} END AS stoch_d FROM k""",
)
_indicator(
    "willr_14", {"WILLR_14": "willr_14"}, lambda: build("willr"),
    f"""SELECT symbol, bar_ms, CASE WHEN i >= 13 THEN -100 * (max(h) OVER {_rows(14)} - c)
    / nullif(max(h) OVER {_rows(14)} - min(l) OVER {_rows(14)}, 0) END AS willr_14 FROM s""",
)
_indicator(
    "cci_20", {"CCI_20_0.015": "cci_20"}, lambda: build("cci"),
    f"""m AS (SELECT symbol, bar_ms, i, tp, avg(tp) OVER {_rows(20)} AS mean FROM s),
    d AS (SELECT b.symbol, b.i, avg(abs(a.tp - b.mean)) AS mad FROM m b JOIN m a ON a.symbol = b.symbol AND a.i BETWEEN b.i - 19 AND b.i
      WHERE b.i >= 19 GROUP BY ALL)
    §SELECT symbol, bar_ms, (tp - mean) / nullif(0.015 * mad, 0) AS cci_20 FROM m LEFT JOIN d USING (symbol, i)""",
)
_indicator(
    "roc_12", {"ROC_12": "roc_12"}, lambda: build("roc"),
    "SELECT symbol, bar_ms, 100 * (x / lag(x, 12) OVER (PARTITION BY symbol ORDER BY i) - 1) AS roc_12 FROM s",
)
_indicator(
    "bbands_20",
    {"BBL_20_2.0": "bb_low", "BBM_20_2.0": "bb_mid", "BBU_20_2.0": "bb_high", "BBB_20_2.0": "bb_width", "BBP_20_2.0": "bb_share"},
    lambda: build("bollinger_bands", {"length": 20, "nbdevup": 2, "nbdevdn": 2}),
    f"""m AS (SELECT symbol, bar_ms, x, CASE WHEN i >= 19 THEN avg(x) OVER {_rows(20)} END AS bb_mid,
      CASE WHEN i >= 19 THEN stddev_pop(x) OVER {_rows(20)} END AS sd FROM s)
    §SELECT symbol, bar_ms, bb_mid - 2 * sd AS bb_low, bb_mid, bb_mid + 2 * sd AS bb_high, 400 * sd / nullif(bb_mid, 0) AS bb_width,
    (x - (bb_mid - 2 * sd)) / nullif(4 * sd, 0) AS bb_share FROM m""",
)
_indicator(
    "mfi_14", {"MFI_14": "mfi_14"}, lambda: build("mfi"),
    f"""f AS (SELECT *, CASE WHEN tp > tp1 THEN tp * v ELSE 0 END AS up, CASE WHEN tp < tp1 THEN tp * v ELSE 0 END AS down FROM s)
    §SELECT symbol, bar_ms, CASE WHEN i >= 14 THEN 100 * sum(up) OVER {_rows(14)}
    / nullif(sum(up) OVER {_rows(14)} + sum(down) OVER {_rows(14)}, 0) END AS mfi_14 FROM f""",
)
_indicator(
    "obv", {"OBV": "obv"}, lambda: build("obv"),
    "SELECT symbol, bar_ms, sum(CASE WHEN i = 0 THEN v ELSE sign(c - c1) * v END) OVER (PARTITION BY symbol ORDER BY i) AS obv FROM "
    "(SELECT *, 0.0 + v AS v0 FROM s)",
)
_indicator(
    "hilo_13", {"HILO_13_23": "hilo_13"}, lambda: build("hilo", {"length": 13}),
    f"""m AS (SELECT symbol, bar_ms, i, c, CASE WHEN i >= 12 THEN avg(h) OVER {_rows(13)} END AS hh,
      CASE WHEN i >= 22 THEN avg(l) OVER {_rows(23)} END AS ll FROM s),
    p AS (SELECT *, lag(hh) OVER q AS h1, lag(ll) OVER q AS l1 FROM m WINDOW q AS (PARTITION BY symbol ORDER BY i)),
    k AS (SELECT *, CASE WHEN h1 IS NULL OR l1 IS NULL THEN NULL WHEN c > h1 THEN ll WHEN c < l1 THEN hh END AS pick FROM p)
    §SELECT symbol, bar_ms, last_value(pick IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY i) AS hilo_13 FROM k""",
)
_indicator(
    "price_sources", {"SMA_1": "hl2"}, lambda: build("sma", {"length": 1, "column": "hl2"}),
    "SELECT symbol, bar_ms, (h + l) / 2 AS hl2 FROM s",
)
_indicator(
    "price_source_hlc3", {"SMA_1": "hlc3"}, lambda: build("sma", {"length": 1, "column": "hlc3"}),
    "SELECT symbol, bar_ms, (h + l + x) / 3 AS hlc3 FROM s",
)


def _ratio(n: int) -> str:
    return f"(2.0 / {n + 1})"


_indicator(
    "ema_20", {"EMA_20": "ema_20"}, lambda: build("ema", {"length": 20}),
    f"{smooth_sql('e', 's', 'x', 20, _ratio(20))}§SELECT symbol, bar_ms, y AS ema_20 FROM s LEFT JOIN e USING (symbol, i)",
)
_indicator(
    "rma_14", {"RMA_14": "rma_14"}, lambda: build("rma", {"length": 14}),
    f"{smooth_sql('e', 's', 'x', 14, '(1.0 / 14)')}§SELECT symbol, bar_ms, y AS rma_14 FROM s LEFT JOIN e USING (symbol, i)",
)
_indicator(
    "macd", {"MACD_12_26_9": "macd", "MACDh_12_26_9": "macd_hist", "MACDs_12_26_9": "macd_signal"}, lambda: build("macd"),
    f"""{smooth_sql('f', 's', 'x', 12, _ratio(12))}, {smooth_sql('g', 's', 'x', 26, _ratio(26))},
    m AS (SELECT symbol, i, f.y - g.y AS x FROM f JOIN g USING (symbol, i)), {smooth_sql('z', 'm', 'x', 9, _ratio(9), 25)}
    §SELECT symbol, bar_ms, m.x AS macd, m.x - z.y AS macd_hist, z.y AS macd_signal
    FROM s LEFT JOIN m USING (symbol, i) LEFT JOIN z USING (symbol, i)""",
)
for _n in (14, 21):
    _indicator(
        f"rsi_{_n}", {f"RSI_{_n}": f"rsi_{_n}"}, lambda n=_n: build("rsi", {"length": n}),
        f"""d AS (SELECT symbol, i, greatest(c - c1, 0) AS up, greatest(c1 - c, 0) AS down FROM s),
        {smooth_sql('u', 'd', 'up', _n, f'(1.0 / {_n})', 1)}, {smooth_sql('w', 'd', 'down', _n, f'(1.0 / {_n})', 1)}
        §SELECT symbol, bar_ms, 100 * u.y / nullif(u.y + w.y, 0) AS rsi_{_n} FROM s LEFT JOIN u USING (symbol, i) LEFT JOIN w USING (symbol, i)""",
    )
TRUE_RANGE = "greatest(h - l, coalesce(abs(h - c1), 0), coalesce(abs(l - c1), 0))"
_indicator(
    "atr_14", {"ATRr_14": "atr_14"}, lambda: build("atr"),
    f"""d AS (SELECT symbol, i, {TRUE_RANGE} AS tr FROM s), {smooth_sql('e', 'd', 'tr', 14, '(1.0 / 14)')}
    §SELECT symbol, bar_ms, y AS atr_14 FROM s LEFT JOIN e USING (symbol, i)""",
)
_indicator(
    "adx_14", {"ADX_14": "adx", "DMP_14": "dmp", "DMN_14": "dmn"}, lambda: build("adx"),
    f"""d AS (SELECT symbol, i, {TRUE_RANGE} AS tr, CASE WHEN h - h1 > l1 - l AND h > h1 THEN h - h1 ELSE 0 END AS up,
      CASE WHEN l1 - l > h - h1 AND l < l1 THEN l1 - l ELSE 0 END AS down FROM s WHERE i > 0),
    {smooth_sql('qt', 'd', 'tr', 14, '(1.0 / 14)', 1)}, {smooth_sql('qu', 'd', 'up', 14, '(1.0 / 14)', 1)},
    {smooth_sql('qd', 'd', 'down', 14, '(1.0 / 14)', 1)},
    di AS (SELECT symbol, i, 100 * qu.y / qt.y AS dmp, 100 * qd.y / qt.y AS dmn FROM qt JOIN qu USING (symbol, i) JOIN qd USING (symbol, i)),
    dx AS (SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY i) - 1 AS i, i AS bar,
      100 * abs(dmp - dmn) / (dmp + dmn) AS dx FROM di WHERE dmp + dmn > 0),
    {smooth_sql('e', 'dx', 'dx', 14, '(1.0 / 14)')}
    §SELECT symbol, bar_ms, e.y AS adx, dmp, dmn FROM s LEFT JOIN di USING (symbol, i)
    LEFT JOIN (SELECT dx.symbol, dx.bar AS i, e.y FROM dx JOIN e USING (symbol, i)) e USING (symbol, i)""",
)


def _cascade(n: int, depth: int) -> str:
    parts = [smooth_sql("e1", "s", "x", n, _ratio(n))]
    parts += [smooth_sql(f"e{k}", f"e{k - 1}", "y", n, _ratio(n), (k - 1) * (n - 1)) for k in range(2, depth + 1)]
    return ", ".join(parts)


_indicator(
    "trix_15", {"TRIX_15_9": "trix", "TRIXs_15_9": "trix_signal"}, lambda: build("trix"),
    f"""{_cascade(15, 3)}, t AS (SELECT symbol, i, 100 * (y - lag(y) OVER q) / lag(y) OVER q AS trix FROM e3
      WINDOW q AS (PARTITION BY symbol ORDER BY i)),
    u AS (SELECT *, CASE WHEN count(trix) OVER {_rows(9)} = 9 THEN avg(trix) OVER {_rows(9)} END AS trix_signal FROM t)
    §SELECT symbol, bar_ms, trix, trix_signal FROM s LEFT JOIN u USING (symbol, i)""",
)
for _name, _depth, _expr in (
    ("dema", 2, "2 * e1.y - e2.y"), ("tema", 3, "3 * e1.y - 3 * e2.y + e3.y"), ("zema", 2, "e1.y + (e1.y - e2.y)"),
):
    _indicator(
        f"{_name}_10", {f"{_name.upper()}_10": f"{_name}_10"}, lambda name=_name: build(name, {"length": 10}),
        f"{_cascade(10, _depth)}§SELECT symbol, bar_ms, {_expr} AS {_name}_10 FROM s "
        + " ".join(f"LEFT JOIN e{k} USING (symbol, i)" for k in range(1, _depth + 1)),
    )


def _fold_sql(name: str, first_row: str, seed: str, step: str) -> str:
    """Recursive CTE ``name`` (symbol, i, y) over table ``k`` with y from the previous row."""
    return f"""{name} AS (SELECT symbol, i, {seed} AS y FROM k WHERE i = {first_row}
    UNION ALL SELECT k.symbol, k.i, {step} FROM {name} r JOIN k ON k.symbol = r.symbol AND k.i = r.i + 1)"""


_indicator(
    "vidya_14", {"VIDYA_14": "vidya_14"}, lambda: build("vidya", {"length": 14}),
    f"""k AS (SELECT symbol, i, x, coalesce(abs(sum(c - c1) OVER {_rows(14)} / nullif(sum(abs(c - c1)) OVER {_rows(14)}, 0)), 0) * 2 / 15.0 AS f FROM s),
    {_fold_sql('e', '14', 'x', 'k.f * k.x + (1 - k.f) * r.y')}
    §SELECT symbol, bar_ms, y AS vidya_14 FROM s LEFT JOIN e USING (symbol, i)""",
)
for _name, _fast, _quick in (("kama_10", 2, "2 / 3.0"), ("kama_fast_1", 1, "1.0")):
    _indicator(
        _name, {f"KAMA_10_{_fast}_30": _name}, lambda fast=_fast: build("kama", {"length": 10, "fast": fast}),
        f"""k AS (SELECT symbol, i, x, avg(x) OVER {_rows(10)} AS m, pow(coalesce(abs(x - lag(x, 10) OVER (PARTITION BY symbol ORDER BY i))
          / nullif(sum(abs(c - c1)) OVER {_rows(10)}, 0), 0) * ({_quick} - 2 / 31.0) + 2 / 31.0, 2) AS f FROM s),
        {_fold_sql('e', '9', 'm', 'r.y + k.f * (k.x - r.y)')}
        §SELECT symbol, bar_ms, y AS {_name} FROM s LEFT JOIN e USING (symbol, i)""",
    )
_indicator("ema_1", {"EMA_1": "ema_1"}, lambda: build("ema", {"length": 1}), "SELECT symbol, bar_ms, x AS ema_1 FROM s")
_indicator(
    "hwma", {"HWMA_0.2_0.1_0.1": "hwma"}, lambda: build("hwma"),
    """e AS (SELECT symbol, CAST(-1 AS BIGINT) AS i, x AS f, 0.0::DOUBLE AS v, 0.0::DOUBLE AS a FROM s WHERE i = 0
      UNION ALL SELECT symbol, i, f1, v1, 0.9 * a + 0.1 * (v1 - v)
      FROM (SELECT *, 0.9 * (v + a) + 0.1 * (f1 - f) AS v1
            FROM (SELECT s.symbol, s.i, r.f, r.v, r.a, 0.8 * (r.f + r.v + r.a / 2) + 0.2 * s.x AS f1
                  FROM e r JOIN s ON s.symbol = r.symbol AND s.i = r.i + 1)))
    §SELECT symbol, bar_ms, e.f + e.v + e.a / 2 AS hwma FROM s LEFT JOIN e USING (symbol, i)""",
)
_A = math.exp(-math.sqrt(2) * math.pi / 10)
_B = 2 * _A * math.cos(math.sqrt(2) * math.pi / 10)
_indicator(
    "ssf_10", {"SSF_10": "ssf_10"}, lambda: build("ssf", {"length": 10}),
    f"""e AS (SELECT b.symbol, b.i, b.x AS y, a.x AS y1 FROM s b JOIN s a ON a.symbol = b.symbol AND a.i = 0 WHERE b.i = 1
      UNION ALL SELECT s.symbol, s.i, {1 - _B + _A * _A!r} * s.x + {_B!r} * r.y - {_A * _A!r} * r.y1, r.y
      FROM e r JOIN s ON s.symbol = r.symbol AND s.i = r.i + 1)
    §SELECT symbol, bar_ms, CASE WHEN i = 0 THEN x ELSE y END AS ssf_10 FROM s LEFT JOIN e USING (symbol, i)""",
)
_indicator(
    "psar", {"PSAR_0.02_0.2": "psar"}, lambda: build("psar", {"acceleration": 0.02, "maximum": 0.2}),
    """k AS (SELECT *, lag(h, 2) OVER q AS h2, lag(l, 2) OVER q AS l2 FROM s WINDOW q AS (PARTITION BY symbol ORDER BY i)),
    e AS (SELECT symbol, i, h - h1 >= l1 - l AS up, CASE WHEN h - h1 >= l1 - l THEN l1 ELSE h1 END AS sar,
        CASE WHEN h - h1 >= l1 - l THEN greatest(h, h1) ELSE least(l, l1) END AS best, 0.02::DOUBLE AS rate FROM k WHERE i = 1
      UNION ALL SELECT symbol, i, CASE WHEN turn THEN NOT up ELSE up END, CASE WHEN turn THEN best ELSE nxt END,
        CASE WHEN turn THEN CASE WHEN up THEN l ELSE h END WHEN up THEN greatest(best, h) ELSE least(best, l) END,
        CASE WHEN turn THEN 0.02 WHEN (up AND h > best) OR (NOT up AND l < best) THEN least(rate + 0.02, 0.2) ELSE rate END
      FROM (SELECT *, CASE WHEN up THEN l < nxt ELSE h > nxt END AS turn
            FROM (SELECT k.symbol, k.i, k.h, k.l, r.up, r.best, r.rate,
                    CASE WHEN r.up THEN least(r.sar + r.rate * (r.best - r.sar), k.l1, k.l2)
                         ELSE greatest(r.sar + r.rate * (r.best - r.sar), k.h1, k.h2) END AS nxt
                  FROM e r JOIN k ON k.symbol = r.symbol AND k.i = r.i + 1)))
    §SELECT symbol, bar_ms, sar AS psar FROM s LEFT JOIN e USING (symbol, i)""",
)


def _hilbert(v: str) -> str:
    """Published Hilbert taps over a list, newest first, scaled by the period."""
    return f"((0.0962::DOUBLE * {v}[1] + 0.5769::DOUBLE * {v}[3] - 0.5769::DOUBLE * {v}[5] - 0.0962::DOUBLE * {v}[7]) * scale)"


_ZEROS = "list_resize([0.0::DOUBLE], 7, 0.0::DOUBLE)"
_indicator(
    "mama",
    {"MAMA_1.75": "mama", "FAMA_1.75": "fama"},
    lambda: build("mama", {"length": 14}),
    f"""k AS (SELECT symbol, i, c AS x, lag(c, 1) OVER q AS x1, lag(c, 2) OVER q AS x2, lag(c, 3) OVER q AS x3
      FROM s WINDOW q AS (PARTITION BY symbol ORDER BY i)),
    e AS (SELECT symbol, i, {_ZEROS} AS smooth, {_ZEROS} AS trend, {_ZEROS} AS quad, {_ZEROS} AS inph, 0.0::DOUBLE AS period,
        0.0::DOUBLE AS i2, 0.0::DOUBLE AS q2, 0.0::DOUBLE AS re, 0.0::DOUBLE AS im, 0.0::DOUBLE AS phase, x AS mama, x AS fama
      FROM k WHERE i = 4
      UNION ALL SELECT symbol, i, smooth, trend, quad, inph, period, i2, q2, re, im, phase, mama, 0.5 * alpha * mama + (1 - 0.5 * alpha) * fama
      FROM (SELECT *, alpha * x + (1 - alpha) * mama0 AS mama
      FROM (SELECT *, least(greatest((0.5::DOUBLE / 1.75) / greatest(phase0 - phase, 1.0), 0.05::DOUBLE / 1.75), 0.5::DOUBLE / 1.75) AS alpha,
          0.2 * greatest(least(greatest(least(cycle, 1.5 * period0), 0.67 * period0), 50.0), 6.0) + 0.8 * period0 AS period
      FROM (SELECT *, CASE WHEN re <> 0 AND im <> 0 THEN 2 * pi() / atan(im / re) ELSE period0 END AS cycle,
          CASE WHEN inph[1] <> 0 THEN degrees(atan(quad[1] / inph[1])) ELSE phase0 END AS phase
      FROM (SELECT *, 0.2 * (i2 * i20 + q2 * q20) + 0.8 * re0 AS re, 0.2 * (i2 * q20 - q2 * i20) + 0.8 * im0 AS im
      FROM (SELECT *, 0.2 * (inph[1] - {_hilbert('quad')}) + 0.8 * i20 AS i2, 0.2 * (quad[1] + {_hilbert('inph')}) + 0.8 * q20 AS q2
      FROM (SELECT *, list_prepend({_hilbert('trend')}, quad0[1:6]) AS quad, list_prepend(trend[4], inph0[1:6]) AS inph
      FROM (SELECT *, list_prepend({_hilbert('smooth')}, trend0[1:6]) AS trend
      FROM (SELECT k.*, list_prepend((4 * x + 3 * x1 + 2 * x2 + x3) / 10, r.smooth[1:6]) AS smooth, 0.075::DOUBLE * r.period + 0.54::DOUBLE AS scale,
          r.trend AS trend0, r.quad AS quad0, r.inph AS inph0, r.period AS period0, r.i2 AS i20, r.q2 AS q20, r.re AS re0, r.im AS im0,
          r.phase AS phase0, r.mama AS mama0, r.fama
        FROM e r JOIN k ON k.symbol = r.symbol AND k.i = r.i + 1)))))))))
    §SELECT symbol, bar_ms, coalesce(mama, c) AS mama, coalesce(fama, c) AS fama FROM s LEFT JOIN e USING (symbol, i)""",
)


def _mean_price_bars(spark: SparkSession, d: str) -> DataFrame:
    """Bars at 1d with the mean traded price as close.

    The McGinley step divides by the fourth power of a price ratio; on single random prices it runs
    away from any average, so no two engines would agree on its rounding.
    """
    trades = tape_events(spark, d)
    base = ohlcv(trades, "1d")
    mean = trades.groupBy("symbol", F.timestamp_millis(F.expr("transact_time - transact_time % 86400000")).alias("time_rounded"))
    mean = mean.agg(F.avg(F.col("price").cast("decimal(18,4)")).cast("double").alias("mean"))
    return staged(base.join(mean, ["symbol", "time_rounded"]).withColumn("close", F.col("mean")).drop("mean"))


def _mcgd(spark: SparkSession, d: str) -> DataFrame:
    table = flat(add_indicators(_mean_price_bars(spark, d), [build("mcgd", {"length": 10})]))
    return rounded(table.select("symbol", "bar_ms", F.col("MCGD_10").alias("mcgd_10")), "mcgd_10", places=4)


register(
    "mcgd_10",
    _mcgd,
    f"""WITH RECURSIVE {TAPE}, k AS (SELECT symbol, t - t % 86400000 AS bar_ms, CAST(round(avg(price), 8) AS DOUBLE) AS x,
      row_number() OVER (PARTITION BY symbol ORDER BY t - t % 86400000) - 1 AS i FROM tape GROUP BY symbol, t - t % 86400000),
    {_fold_sql('e', '0', 'x', 'CASE WHEN r.y IS NULL THEN k.x ELSE r.y + (k.x - r.y) / nullif(10 * pow(k.x / r.y, 4), 0) END')}
    SELECT symbol, bar_ms, round(y, 4) AS mcgd_10 FROM k JOIN e USING (symbol, i)""",
)


# The queries that check the catalogue's entries one by one; together they have all its columns.
ENTRIES = [
    "ema_20", "macd", "rsi_14", "rsi_21", "sma_50", "wma_30", "stoch", "adx_14", "atr_14", "cci_20", "roc_12", "bbands_20", "mfi_14",
    "trix_15", "obv", "psar", "willr_14",
]
CATALOGUE_OUTPUTS = {column: alias for name in ENTRIES for column, alias in OUTPUTS[name].items()}
CATALOGUE_SQL = "SELECT * FROM " + " JOIN ".join(f"({ORACLES[name]}) AS t{k}{' USING (symbol, bar_ms)' if k else ''}" for k, name in enumerate(ENTRIES))


def _catalogue(spark: SparkSession, d: str) -> DataFrame:
    config = [*CATALOGUE, {"name": "unheard_of"}, {"name": "rsi", "params": {"length": 0}}]
    indexed = staged(index_bars(event_bars(spark, d, "1h")))  # read by every pass
    table, failed = indicator_table(indexed, config)
    if sorted(failed) != ["rsi", "unheard_of"]:
        raise AssertionError(f"unexpected failures: {failed}")
    return _compared(table, CATALOGUE_OUTPUTS)


register("indicator_catalogue", _catalogue, CATALOGUE_SQL)


def _extended(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue's table brought up to date three times: a first part, the bars of one hour, and the rest."""
    bars, base = event_bars(spark, d, "1h"), f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    for ms in (EXTEND_MS, EXTEND_MS + 3_600_000, None):
        known = bars if ms is None else bars.where(F.col("time_rounded") < F.timestamp_millis(F.lit(ms)))
        extend_indicator_table(spark, known, base)
    return _compared(read_indicator_table(spark, base), CATALOGUE_OUTPUTS)


EXTEND_MS = 1_705_287_600_000  # 15 January 2024, 03:00
register("extended_indicators", _extended, CATALOGUE_SQL)


def _many_series(spark: SparkSession, d: str) -> DataFrame:
    both = staged(ohlcv(tape_events(spark, d), "4h").unionByName(ohlcv(tape_events(spark, d), "1h")))
    table = add_indicators(both.withColumn("market", F.lit("spot")), [build("sma", {"length": 50})], ("symbol", "market", "timeframe"))
    out = flat(table.withColumn("tf", F.col("timeframe")))
    return rounded(out.select("symbol", "tf", "bar_ms", F.col("SMA_50").alias("sma_50")), "sma_50")


def _one_sma(timeframe: str) -> str:
    return f"""SELECT * FROM (WITH {bars_sql(timeframe)} SELECT symbol, '{timeframe}' AS tf, bar_ms,
    round(CASE WHEN i >= 49 THEN avg(close) OVER {_rows(50)} END, 6) AS sma_50 FROM bars)"""


register("indicators_many_series", _many_series, f"{_one_sma('1h')} UNION ALL {_one_sma('4h')}")
