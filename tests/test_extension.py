"""Indicators that go on from a stored state equal those of the whole series."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import HOUR, bars_of, walk
from tickloom.operators.indicators.registry import CATALOGUE, add_indicators, build, build_all
from tickloom.operators.indicators.resume import extended_indicators, layout, look_back
from tickloom.operators.series import Recurrence, in_blocks, index_bars
from tickloom.plans.indicators import extend_indicator_table, read_indicator_state, read_indicator_table
from tickloom.plans.stage import staged

MORE = [{"name": n} for n in ("hwma", "ssf", "mama", "mcgd", "vidya", "hilo", "tema")] + [{"name": "kama", "params": {"fast": 1}}]


def between(bars, first, last):
    """Bars of the hours first to last - 1."""
    return bars.where(F.unix_millis("time_rounded").between(first * HOUR, last * HOUR - 1))


def by_bar(df):
    out = {}
    for r in df.collect():
        assert (r.symbol, r.time_rounded) not in out
        out[r.symbol, r.time_rounded] = r.asDict()
    return out


def same(got, want):
    assert set(got) == set(want)
    for key, row in want.items():
        for c, x in row.items():
            y = got[key][c]
            assert x == y or (isinstance(x, float) and y == pytest.approx(x, rel=1e-9, abs=1e-7)), (key, c, x, y)


@pytest.mark.parametrize("config", [CATALOGUE, MORE])
def test_extensions_equal_the_whole_series(spark, config):
    """Cuts in the warm-up, inside a block and at its border; one series stops, one starts late."""
    bars = bars_of(spark, {"A": walk(200), "B": walk(90, 5), "C": [5.0] * 3})
    late = bars_of(spark, {"D": walk(200, 8)}).where(F.unix_millis("time_rounded") >= 150 * HOUR)
    bars = staged(bars.unionByName(late))
    indicators, _ = build_all(config)
    state, got = None, {}
    for first, last in ((0, 1), (1, 45), (45, 128), (128, 200)):
        rows, after = extended_indicators(between(bars, first, last), indicators, state, size=32, cut=staged)
        got |= by_bar(rows)
        state = staged(after)
    same(got, by_bar(add_indicators(bars, indicators, size=32)))
    rest = {r.symbol: (r.n_bars, len(r.tail)) for r in state.collect()}
    halo = look_back(indicators)
    assert rest == {"A": (200, min(halo, 200)), "B": (90, min(halo, 90)), "C": (3, min(halo, 3)), "D": (50, min(halo, 50))}


def test_bars_without_a_price_and_bars_seen_before(spark):
    bars = bars_of(spark, {"A": walk(40)})
    holes = bars.withColumns({c: F.when(~F.hour("time_rounded").isin(7, 19), F.col(c)) for c in ("open", "close", "high", "low")})
    holes = staged(holes)
    indicators = [build("sma", {"length": 3}), build("ema", {"length": 5}), build("psar")]
    state, got = None, {}
    for last in (20, 20, 32):  # each call is given all bars so far; bar 19 and 31 end a call without a price
        rows, after = extended_indicators(between(holes, 0, last), indicators, state, size=16, cut=staged)
        found = by_bar(rows)
        assert not set(found) & set(got)
        got |= found
        state = staged(after)
    same(got, by_bar(add_indicators(between(holes, 0, 32), indicators, size=16)))


def test_a_state_of_other_indicators_fails(spark):
    bars = bars_of(spark, {"A": walk(60)})
    _, state = extended_indicators(between(bars, 0, 50), [build("ema"), build("obv")])
    rows, _ = extended_indicators(bars, [build("ema")], staged(state))
    assert layout([build("ema")]) != layout([build("ema"), build("obv")])
    with pytest.raises(Exception, match="of other indicators"):
        rows.collect()


@pytest.fixture
def stored(spark, tmp_path):
    bars = bars_of(spark, {"A": walk(120), "B": walk(120, 4)})
    path = str(tmp_path / "bars")
    bars.withColumn("date", F.to_date("time_rounded")).write.partitionBy("timeframe", "date").parquet(path)
    return spark.read.parquet(path).drop("date")


CONFIG = [{"name": "ema", "params": {"length": 5}}, {"name": "obv"}, {"name": "sar"}, {"name": "nope"}]


def test_table_is_extended_from_new_bars_only(spark, stored, tmp_path, monkeypatch):
    from tickloom.plans import indicators as plan

    seen = []
    real = plan.extended_indicators
    monkeypatch.setattr(plan, "extended_indicators", lambda new, *a, **k: (seen.append(new), real(new, *a, **k))[1])
    base = str(tmp_path / "table")
    assert set(extend_indicator_table(spark, between(stored, 0, 100), base, CONFIG)) == {"nope"}
    extend_indicator_table(spark, stored, base, CONFIG)
    want = add_indicators(stored, build_all(CONFIG)[0])
    same(by_bar(read_indicator_table(spark, base)), by_bar(want))
    plan_text = seen[1]._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan_text.splitlines() if "FileScan" in line]
    bound = [line for line in scans if "GreaterThan(time_rounded" in line]
    others = [line for line in scans if line not in bound]  # of other timeframes, none of which is there
    assert len(bound) == 1 and all("NOT (timeframe" in line for line in others)
    assert seen[1].count() == 2 * 20


def test_an_extension_that_was_cut_off_is_not_seen_and_is_repeated(spark, stored, tmp_path):
    base = str(tmp_path / "table")
    extend_indicator_table(spark, between(stored, 0, 60), base, CONFIG)
    # The rows of the next version are there, its state is not.
    read_indicator_table(spark, base).write.parquet(f"{base}/rows/version=2")
    assert read_indicator_table(spark, base).count() == 120
    extend_indicator_table(spark, stored, base, CONFIG)
    assert read_indicator_table(spark, base).count() == 240 and read_indicator_state(spark, base).count() == 2


def test_a_series_that_starts_later_is_read_from_its_beginning(spark, stored, tmp_path):
    base = str(tmp_path / "table")
    extend_indicator_table(spark, between(stored, 0, 60).where("symbol = 'A'"), base, CONFIG)
    extend_indicator_table(spark, stored, base, CONFIG)
    want = add_indicators(stored, build_all(CONFIG)[0])
    same(by_bar(read_indicator_table(spark, base)), by_bar(want))


def test_vectors_and_factors_of_zero_are_scanned(spark):
    """A rotation with a reset, a value that forgets at random rows, and one chained to it, against plain loops."""
    rng = random.Random(9)
    n, x = 300, walk(300)
    forget = [rng.choice([0.0, 0.0, 1e-200, 0.5, 1.0]) for _ in range(n)]
    bars = bars_of(spark, {"A": x}).withColumn("a", F.element_at(F.array(*map(F.lit, forget)), F.expr("cast(unix_millis(time_rounded) / 3600000 + 1 AS int)")))
    running = {
        "u": Recurrence("close", a="CASE WHEN i = 130 THEN 0D ELSE 0.8D END", prev={"w": "-0.6D"}),
        "w": Recurrence(a="0.8D", prev={"u": "0.6D"}),
        "f": Recurrence("close", a="a", least=0.0),
        "g": Recurrence(a="0.9D", of={"f": "0.1D"}),
        "plain": Recurrence("close", a="0.9D"),
    }
    got = in_blocks(index_bars(bars), post=3, size=64).scan(running).rows().orderBy("i").collect()
    u = w = f = g = p = 0.0
    for k, r in enumerate(got):
        u, w = (0.0 if k == 130 else 0.8) * u - 0.6 * w + x[k], 0.8 * w + 0.6 * u
        f = forget[k] * f + x[k]
        g, p = 0.9 * g + 0.1 * f, 0.9 * p + x[k]
        assert [r.u, r.w, r.f, r.g, r.plain] == pytest.approx([u, w, f, g, p], rel=1e-9)
    with pytest.raises(ValueError, match="unknown"):
        in_blocks(index_bars(bars)).scan({"x": Recurrence("close", prev={"nowhere": "1D"})})
