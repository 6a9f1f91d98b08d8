"""Streams give the batch result on the same tape."""

import json
import os

import pytest

from tests.helpers import random_rows, tape
from tickloom.operators import bars, footprint, stats
from tickloom.sources.messages import decode_messages
from tickloom.streaming import corrections, live

MINUTE = 60_000
LAST = 10**9


def write_messages(folder, rows, parts=3):
    folder.mkdir(parents=True, exist_ok=True)
    size = -(-len(rows) // parts)
    for k in range(parts):
        lines = [
            json.dumps({"e": "aggTrade", "E": t + 3, "T": t, "s": s, "a": i, "p": str(p), "q": str(q), "m": m})
            for s, i, p, q, t, m in rows[k * size : (k + 1) * size]
        ]
        file = folder / f"{k:03d}.json"
        file.write_text("\n".join(lines) + "\n")
        os.utime(file, (10**9 + 10 * k, 10**9 + 10 * k))  # a stream takes files by their times


@pytest.fixture
def source(spark, tmp_path):
    rows = random_rows(300, step_ms=20_000)
    folder = tmp_path / "in"
    # A last trade far ahead moves the watermark past every window of interest.
    write_messages(folder, [*rows, ("BTCUSDT", LAST, 1.0, 1.0, 10**10, True)])
    return rows, str(folder)


def run(df, tmp_path, name, mode="append"):
    query = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", f"{tmp_path}/cp_{name}").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def rows_of(df, columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_bars_levels_and_summary_equal_batch(spark, source, tmp_path):
    rows, folder = source
    batch = tape(spark, rows)
    stream = live.read_messages(spark, folder, files_per_batch=1)
    cases = {
        "s_bars": (live.stream_bars(stream, "5m"), bars.ohlcv(batch, "5m")),
        "s_levels": (live.stream_levels(stream, "5m"), footprint.footprint_levels(batch, "5m")),
    }
    for name, (df, want) in cases.items():
        run(df, tmp_path, name)
        got = spark.table(name).where("time_rounded < timestamp'1970-04-01'")
        assert rows_of(got, want.columns) == rows_of(want, want.columns)
    run(live.stream_summary(stream, "5m"), tmp_path, "s_sum")
    total = spark.table("s_sum").where("time_rounded < timestamp'1970-04-01'").selectExpr("sum(total_trades)", "sum(total_volume)").first()
    assert tuple(total) == (300, sum(r[3] for r in rows))


def test_last_seen_in_update_mode(spark, source, tmp_path):
    rows, folder = source
    run(live.stream_last_seen(live.read_messages(spark, folder)), tmp_path, "s_seen", "update")
    got = {}
    for r in spark.table("s_seen").collect():
        got[r.symbol] = max(got.get(r.symbol, 0), r.last_ms)
    assert got["XYZ"] == max(r[4] for r in rows if r[0] == "XYZ")


def test_late_and_repeated_rows(spark, tmp_path):
    """Repeats are dropped; a row within the delay counts, one beyond it is dropped and counted."""
    folder = tmp_path / "late"
    base = [("A", 1, 1.0, 1.0, 30_000, True), ("A", 2, 2.0, 1.0, 5 * MINUTE, True)]
    within, beyond = ("A", 3, 3.0, 1.0, 4 * MINUTE + 30_000, True), ("A", 4, 9.0, 1.0, MINUTE, True)
    write_messages(folder, [*base, base[1]], 1)
    stream = live.read_messages(spark, str(folder))
    df = live.stream_bars(live.dedupe_stream(stream, "1 minute"), "1m")

    def once():
        query = (
            df.writeStream.format("parquet").option("path", f"{tmp_path}/out").outputMode("append")
            .option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return query

    once()
    (folder / "100.json").write_text(
        "\n".join(json.dumps({"e": "aggTrade", "T": t, "s": s, "a": i, "p": str(p), "q": str(q), "m": m}) for s, i, p, q, t, m in (within, beyond, base[1])) + "\n"
    )
    query = once()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped >= 1
    (folder / "200.json").write_text(json.dumps({"e": "aggTrade", "T": 10**9, "s": "A", "a": 9, "p": "1", "q": "1", "m": True}) + "\n")
    once()
    got = {r.time_rounded.minute: (r.open, r.close, r.qty) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {0: (1.0, 1.0, 1.0), 4: (3.0, 3.0, 1.0), 5: (2.0, 2.0, 1.0)}


def test_landing_merges_late_rows_and_replays(spark, source, tmp_path):
    rows, folder = source
    out = f"{tmp_path}/minutes"
    stream = live.read_messages(spark, folder, files_per_batch=1)
    for checkpoint in ("one", "two"):  # the second run replays everything
        query = live.land_minutes(stream, out, f"{tmp_path}/{checkpoint}").trigger(availableNow=True).start()
        query.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 301 and got.select("agg_trade_id").distinct().count() == 301
    late = [("XYZ", 5000, 7.0, 1.0, rows[0][4], False)]
    write_messages(tmp_path / "more", late, 1)
    more = live.land_minutes(live.read_messages(spark, str(tmp_path / "more")), out, f"{tmp_path}/three")
    more.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 302


def test_parquet_writer_and_binary_messages(spark, source, tmp_path):
    rows, folder = source
    raw = spark.readStream.format("text").load(folder)
    stream = live.decode_stream(raw.selectExpr("cast(value AS binary) AS value"))
    live.write_stream(live.stream_bars(stream, "1h"), f"{tmp_path}/o", f"{tmp_path}/c", every=None).start().awaitTermination()
    want = bars.ohlcv(tape(spark, rows), "1h")
    got = spark.read.parquet(f"{tmp_path}/o").where("time_rounded < timestamp'1970-04-01'")
    assert rows_of(got, want.columns) == rows_of(want, want.columns)
    assert stats.symbols(decode_messages(spark.read.text(folder))).count() == 2


def cells(df):
    return sorted((*r[:-1], sorted((k, tuple(v)) for k, v in r[-1].items())) for r in df.select("symbol", "time_rounded", *footprint.FINAL).collect())


def test_final_bars_of_a_stream_equal_the_batch(spark, source, tmp_path):
    """Three batches; levels and bars are two steps of one query, and a restart goes on from both states."""
    rows, folder = source
    want = footprint.bars_with_footprint(tape(spark, rows), "15m", {"BTCUSDT": 0})
    stream = live.dedupe_stream(live.read_messages(spark, folder, files_per_batch=1))
    df = live.stream_final_bars(stream, "15m", ticks={"BTCUSDT": 0})
    for _ in range(2):
        query = live.write_stream(df, f"{tmp_path}/o", f"{tmp_path}/c", every=None).start()
        query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/o").where("time_rounded < timestamp'1970-04-01'")
    assert cells(got) == cells(want)


def started(spark, folder, base, timeframe="1h", **options):
    stream = live.read_messages(spark, str(folder), files_per_batch=1)
    places = [f"{base}/{x}" for x in ("minutes", "bars", "progress")]
    writer = corrections.write_corrected_bars(stream, *places, timeframe, f"{base}/checkpoint", parts=("symbol", "day"), **options)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/bars")


def written(base):
    return {str(f.relative_to(base)): f.stat().st_mtime_ns for f in (base / "bars").rglob("*.parquet")}


def test_late_rows_correct_the_bars_they_belong_to(spark, tmp_path):
    """Rows days behind the watermark, one of them for a bar that had none: only their days are rewritten."""
    day = 24 * 60 * MINUTE
    rows = [("A", k, 100.0 + k % 7, 1.0 + k % 3, k * 50 * MINUTE, k % 2 == 0) for k in range(120) if k % 29]
    write_messages(tmp_path / "in", rows, 2)
    started(spark, tmp_path / "in", tmp_path)
    before = written(tmp_path)
    late = [("A", 1000, 7.0, 2.0, day + 5 * MINUTE, True), ("A", 1001, 900.0, 2.0, day + 6 * MINUTE, False), ("B", 5, 1.0, 1.0, day + MINUTE, True), rows[40]]
    lines = [json.dumps({"e": "aggTrade", "T": t, "s": s, "a": i, "p": str(p), "q": str(q), "m": m}) for s, i, p, q, t, m in late]
    (tmp_path / "in" / "late.json").write_text("\n".join(lines) + "\n")
    got = started(spark, tmp_path / "in", tmp_path)
    newest = max(r[4] for r in rows)
    full = footprint.bars_with_footprint(tape(spark, [*rows, *late[:3]]), "1h")
    want = full.where(f"unix_millis(time_rounded) + 3600000 <= {newest - MINUTE}")
    assert cells(got) == cells(want)
    after = written(tmp_path)
    kept = {f for f in before if "date=1970-01-02" not in f and "1970-01-02" not in f}
    assert kept and all(after.get(f) == before[f] for f in kept if f"date={_date(rows[40][4])}" not in f)
    assert any(f not in after or after[f] != before[f] for f in before if "date=1970-01-02" in f)


def _date(ms):
    from datetime import datetime, timezone

    return datetime.fromtimestamp(ms / 1000, timezone.utc).date().isoformat()


def test_a_replayed_batch_changes_no_bar(spark, tmp_path):
    rows = [("A", k, 100.0 + k % 7, 1.0, k * 17 * MINUTE, k % 2 == 0) for k in range(200)]
    places = [f"{tmp_path}/{x}" for x in ("minutes", "bars", "progress")]
    halves = [tape(spark, rows[:120]), tape(spark, [*rows[120:], ("A", 900, 50.0, 1.0, 3 * MINUTE, True)])]

    def merge(k):
        corrections.correct_bars(halves[k], k, *places, "1h", MINUTE, parts=("symbol", "day"))
        return cells(spark.read.parquet(places[1]))

    merge(0)
    first = merge(1)
    assert merge(1) == first
    want = footprint.bars_with_footprint(tape(spark, [*rows, ("A", 900, 50.0, 1.0, 3 * MINUTE, True)]), "1h")
    assert first == cells(want.where(f"unix_millis(time_rounded) + 3600000 <= {rows[-1][4] - MINUTE}"))
