"""Block-wise series operators against plain loops, with blocks far smaller than the series."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import bars_of, by_key, walk
from tickloom.operators.indicators.registry import CATALOGUE, add_indicators, build, build_all, check_unique, indicator_table
from tickloom.operators.indicators.stateful import mama_period
from tickloom.operators.series import Recurrence, in_blocks, index_bars, running_total
from tickloom.operators.wide import trade_row_keys


def series(spark, n=137, gap=True):
    """One long and one short symbol; with gaps, so index and time differ."""
    df = bars_of(spark, {"A": walk(n), "B": walk(9, seed=5)})
    if gap:
        ms = F.unix_millis("time_rounded")
        df = df.withColumn("time_rounded", F.timestamp_millis(ms + F.floor(ms / 36_000_000) * 50 * 3_600_000))
    return df


def values(df, name, symbol="A"):
    return [r[0] for r in df.where(F.col("symbol") == symbol).orderBy("time_rounded").select(f"`{name}`").collect()]


def close(a, b, tol=1e-9):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert (x is None) == (y is None)
        assert x is None or math.isclose(x, y, rel_tol=tol, abs_tol=tol)


def test_index_counts_bars_per_series(spark):
    df = index_bars(series(spark))
    assert values(df, "i") == list(range(137)) and values(df, "i", "B") == list(range(9))
    assert set(values(df, "n_bars")) == {137}


@pytest.mark.parametrize("size", [8, 16, 512])
def test_scan_matches_a_loop(spark, size):
    df = index_bars(series(spark))
    b = in_blocks(df, pre=3, post=2, size=size)
    b = b.with_columns({"d": F.col("close") - b.lag("close")})
    b = b.scan(
        {
            "total": Recurrence("close"),
            "slow": Recurrence("close * 0.5D", "0.5D"),
            "slower": Recurrence(a="0.75D", of={"slow": "0.25D"}),
            "held": Recurrence("CASE WHEN i % 11 = 4 THEN d END", keep="last"),
            "low": Recurrence("CASE WHEN i > 6 THEN close END", keep="least"),
        }
    )
    out = b.with_columns({"after": b.full(F.avg("slower"), "slower", 3)}).rows().cache()
    x = walk(137)
    total, slow, slower, held, low = 0.0, 0.0, 0.0, None, None
    want = {k: [] for k in ("total", "slow", "slower", "held", "low")}
    for i, v in enumerate(x):
        total += v
        slow = 0.5 * slow + 0.5 * v
        slower = 0.75 * slower + 0.25 * slow
        held = v - x[i - 1] if i % 11 == 4 else held
        low = v if i == 7 else min(low, v) if i > 7 else None
        for k, y in zip(want, (total, slow, slower, held, low)):
            want[k].append(y)
    for k, w in want.items():
        close(values(out, k), w)
    close(values(out, "after")[2:], [sum(want["slower"][i - 2 : i + 1]) / 3 for i in range(2, 137)])
    out.unpersist()


def test_scan_rejects_circles(spark):
    b = in_blocks(index_bars(series(spark)), size=16)
    with pytest.raises(ValueError):
        b.scan({"x": Recurrence(a="0.5D", of={"y": "1D"}), "y": Recurrence(a="0.5D", of={"x": "1D"})})


def test_running_total(spark):
    out = running_total(index_bars(series(spark)), {"t": "volume"}, size=16)
    assert values(out, "t")[-1] == sum(1 + i % 7 for i in range(137))


def plain_ema(x, n, alpha):
    out, y, seen = [], None, []
    for v in x:
        if v is None:
            out.append(None)
            continue
        seen.append(v)
        if len(seen) == n:
            y = sum(seen) / n
        elif len(seen) > n:
            y = alpha * v + (1 - alpha) * y
        out.append(y if len(seen) >= n else None)
    return out


ALL = [
    *CATALOGUE,
    *[{"name": n, "params": {"length": 8}} for n in ("rma", "dema", "tema", "zema", "vidya", "kama", "hma", "hilo", "linreg", "alma")],
    {"name": "hwma"}, {"name": "ssf"}, {"name": "mcgd"}, {"name": "mama"},
]


@pytest.mark.parametrize("size", [64, 100])
def test_blocks_do_not_change_any_indicator(spark, size):
    """Small blocks and one block holding the whole series give the same table."""
    bars = series(spark, n=260).cache()
    small, failed = indicator_table(bars, ALL, size=size)
    whole, _ = indicator_table(bars, ALL, size=4096)
    assert failed == {}
    key = lambda r: (r.symbol, r.time_rounded)
    a, b = sorted(small.collect(), key=key), sorted(whole.collect(), key=key)
    assert len(a) == len(b) == 269
    for x, y in zip(a, b):
        for name in small.columns:
            if isinstance(x[name], float):
                assert math.isclose(x[name], y[name], rel_tol=1e-9, abs_tol=1e-9), name
            else:
                assert x[name] == y[name], name
    bars.unpersist()


def test_chained_smoothing_against_loops(spark):
    out = add_indicators(series(spark), [build("macd"), build("trix", {"length": 5, "signal": 3}), build("ema", {"length": 9})], size=32).cache()
    x = walk(137)
    close(values(out, "EMA_9"), plain_ema(x, 9, 0.2))
    fast, slow = plain_ema(x, 12, 2 / 13), plain_ema(x, 26, 2 / 27)
    line = [None if s is None else f - s for f, s in zip(fast, slow)]
    close(values(out, "MACD_12_26_9"), line)
    close(values(out, "MACDs_12_26_9"), plain_ema(line, 9, 0.2))
    e = x
    for _ in range(3):
        e = plain_ema(e, 5, 1 / 3)
    trix = [None if p is None else 100 * (v - p) / p for p, v in zip([None] + e[:-1], e)]
    close(values(out, "TRIX_5_3"), trix)
    assert values(out, "EMA_9", "B")[8] == pytest.approx(sum(walk(9, seed=5)) / 9)
    out.unpersist()


def test_mama_against_arrays(spark):
    """The adaptive average restated over whole arrays."""
    x, n = walk(137), 137
    at = lambda v, i: v[i] if i >= 5 else 0.0
    sm, det, q1, i1, i2, q2, re, im, per, ph = ([0.0] * n for _ in range(10))
    mama, fama = list(x[:5]), list(x[:5])
    hil = lambda v, i, s: (0.0962 * at(v, i) + 0.5769 * at(v, i - 2) - 0.5769 * at(v, i - 4) - 0.0962 * at(v, i - 6)) * s
    fast, slow = 0.5 / 1.75, 0.05 / 1.75
    for i in range(5, n):
        s = 0.075 * per[i - 1] + 0.54
        sm[i] = (4 * x[i] + 3 * x[i - 1] + 2 * x[i - 2] + x[i - 3]) / 10
        det[i] = hil(sm, i, s)
        q1[i], i1[i] = hil(det, i, s), at(det, i - 3)
        i2[i] = 0.2 * (i1[i] - hil(q1, i, s)) + 0.8 * i2[i - 1]
        q2[i] = 0.2 * (q1[i] + hil(i1, i, s)) + 0.8 * q2[i - 1]
        re[i] = 0.2 * (i2[i] * i2[i - 1] + q2[i] * q2[i - 1]) + 0.8 * re[i - 1]
        im[i] = 0.2 * (i2[i] * q2[i - 1] - q2[i] * i2[i - 1]) + 0.8 * im[i - 1]
        p = 2 * math.pi / math.atan(im[i] / re[i]) if re[i] and im[i] else per[i - 1]
        p = min(max(max(min(p, 1.5 * per[i - 1]), 0.67 * per[i - 1]), 6), 50)
        per[i] = 0.2 * p + 0.8 * per[i - 1]
        ph[i] = math.degrees(math.atan(q1[i] / i1[i])) if i1[i] else ph[i - 1]
        alpha = max(min(fast / max(ph[i - 1] - ph[i], 1), fast), slow)
        mama.append(alpha * x[i] + (1 - alpha) * mama[-1])
        fama.append(0.5 * alpha * mama[-1] + (1 - 0.5 * alpha) * fama[-1])
    out = add_indicators(series(spark), [build("mama", {"length": 14})]).cache()
    close(values(out, "MAMA_1.75"), mama)
    close(values(out, "FAMA_1.75"), fama)
    out.unpersist()
    assert mama_period(14) == 1.75 and mama_period(0.5) == 1.0


def test_stateful_state_survives_arrow_batches(spark):
    bars = series(spark).cache()
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = values(add_indicators(bars, [build("psar"), build("mcgd")]), "MCGD_10")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        got = values(add_indicators(bars, [build("psar"), build("mcgd")]), "MCGD_10")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    close(got, want)


def test_flat_window_gives_null(spark):
    df = bars_of(spark, {"A": [5.0] * 40}).withColumns({"high": F.col("close"), "low": F.col("close")})
    out = add_indicators(df, [build(n) for n in ("stoch", "willr", "rsi", "adx", "cci", "bbands", "mfi")])
    last = out.orderBy(F.col("time_rounded").desc()).first().asDict()
    for name in ("STOCHk_14_3_3", "WILLR_14", "RSI_14", "ADX_14", "CCI_20_0.015", "BBP_20_2.0", "MFI_14"):
        assert last[name] is None, name


def test_registry_reports_failures_and_rejects_duplicates():
    built, failed = build_all([{"name": "ema", "params": {"length": 20}}, {"name": "nope"}, {"name": "sma", "params": {"bad": 1}}, {"name": "ema", "params": {"length": 0}}])
    assert len(built) == 1 and set(failed) == {"nope", "sma", "ema"}
    with pytest.raises(ValueError, match="MACD_12_26_9"):
        check_unique([c for x in (build("macd"), build("macd")) for c in x.outputs])


def test_vidya_period_is_scaled():
    assert build("vidya", {"length": 100}).outputs == ("VIDYA_33",)


def test_trade_row_keys_count_months_from_zero(spark):
    rng = random.Random(1)
    rows = [("A" if rng.random() < 0.7 else "B", i, 1704067200000 + rng.randrange(60 * 86400 * 1000)) for i in range(500)]
    df = trade_row_keys(spark.createDataFrame(rows, "symbol string, agg_trade_id bigint, transact_time bigint"))
    seen = {}
    for s, i, t in sorted(rows, key=lambda r: (r[2], r[1])):
        month = "2024-01" if t < 1706745600000 else "2024-02" if t < 1709251200000 else "2024-03"
        seen[i] = f"{s}#{month}#{sum(1 for k in seen.values() if k.startswith(f'{s}#{month}#'))}"
    assert by_key(df, "agg_trade_id", "row_key") == seen


def test_unpriced_bars_are_returned_without_indicators(spark):
    bars = series(spark, n=30, gap=False)
    hole = bars.withColumns({c: F.when(F.col("time_rounded") != F.timestamp_millis(F.lit(36_000_000)), F.col(c)) for c in ("open", "close", "high", "low")})
    out = add_indicators(hole, [build("sma", {"length": 3})])
    assert out.count() == 39
    got = values(out, "SMA_3")
    x = walk(30)
    assert got[10] is None and got[11] == pytest.approx((x[8] + x[9] + x[11]) / 3)


def test_unknown_timeframe_of_bars_fails(spark):
    with pytest.raises(Exception, match="unsupported timeframe"):
        index_bars(bars_of(spark, {"A": [1.0, 2.0]}, timeframe="2h")).collect()


def test_mcginley_restarts_where_its_denominator_vanishes():
    mcgd = build("mcgd", {"length": 10})
    state = mcgd.start()
    got = [mcgd.step(state, 0.0, 0.0, x)[0] for x in (1e9, 1e-80, 5.0, 5.0)]
    assert got == [1e9, None, 5.0, 5.0]
