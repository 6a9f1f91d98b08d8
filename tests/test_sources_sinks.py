import re
from datetime import datetime, timezone

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import HOUR, random_rows, tape
from tickloom.operators.bars import ohlcv
from tickloom.operators.footprint import bars_with_footprint
from tickloom.operators.prepare import with_minute_parts
from tickloom.plans import batch
from tickloom.schema import AGG_TRADES, KLINES
from tickloom.sinks import files, writers
from tickloom.sources import messages, readers


def ids(df):
    return sorted(r.agg_trade_id for r in df.collect())


def dated(spark, rows):
    return tape(spark, rows).withColumn("date", F.timestamp_millis("transact_time").cast("date"))


DAY = 86_400_000


def test_daily_and_monthly_reads_prune(spark, tmp_path):
    rows = [(s, n * 10 + k, 1.0, 1.0, k * 20 * DAY, True) for n, s in enumerate("AB") for k in range(4)]
    df = dated(spark, rows)
    daily, monthly = f"{tmp_path}/daily", f"{tmp_path}/monthly"
    df.write.partitionBy("symbol", "date").parquet(daily)
    df.withColumns({"year": F.year("date"), "month": F.month("date")}).drop("date").write.partitionBy("symbol", "year", "month").parquet(monthly)
    got = readers.read_daily_trades(spark, daily, ["A"], "1970-01-21", "1970-02-10")
    assert ids(got) == [1, 2]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "symbol" in plan.split("PartitionFilters")[1][:200]
    assert ids(readers.read_monthly_trades(spark, monthly, ["B"], (1970, 2), (1970, 3))) == [12, 13]
    assert sorted(r.symbol for r in readers.symbols_in_paths(spark.read.parquet(daily)).collect()) == ["A", "B"]
    found = readers.list_files(spark, daily, ".parquet")
    assert {r.symbol: r.files for r in readers.file_accounting(found).collect()} == {"A": 4, "B": 4}
    assert found.columns == ["path", "length", "modificationTime"]
    with pytest.raises(ValueError):
        readers.read_daily_trades(spark, daily, ["A"], "1970-02-10", "1970-01-21")


def test_absent_files_are_skipped(spark, tmp_path):
    paths = []
    for k in range(3):
        path = f"{tmp_path}/in/{k}/part"
        tape(spark, [("A", k, 1.0, 1.0, 0, True)]).write.parquet(path)
        paths += [path, f"{tmp_path}/in/{k}/absent"]
    assert ids(readers.read_existing_files(spark, paths)) == [0, 1, 2]
    with pytest.raises(FileNotFoundError):
        readers.read_existing_files(spark, [f"{tmp_path}/no/1", f"{tmp_path}/no/2"])
    with pytest.raises(FileNotFoundError):
        readers.read_existing_files(spark, [])


def test_unreadable_files_are_named(spark, tmp_path):
    good, bad = f"{tmp_path}/a/part", f"{tmp_path}/b.parquet"
    tape(spark, [("A", 1, 1.0, 1.0, 0, True)]).write.parquet(good)
    (tmp_path / "b.parquet").write_text("no parquet at all")
    assert readers.unreadable_files(spark, [good, bad, f"{tmp_path}/c"]) == [bad]
    with pytest.warns(UserWarning, match="b.parquet"):
        assert ids(readers.read_existing_files(spark, [good, bad], skip_unreadable=True)) == [1]
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_existing_files(spark, [good, bad], AGG_TRADES).collect()


def test_latest_minutes_by_folder_names(spark, tmp_path):
    out = f"{tmp_path}/minutes"
    rows = [("A", k, 1.0, 1.0, k * 60_000 + (DAY if k > 5 else 0), True) for k in range(9)] + [("B", 20, 1.0, 1.0, DAY + 7 * 60_000, True)]
    writers.append_minutes(tape(spark, rows), out)
    got = readers.read_latest_minutes(spark, out, 2)
    assert ids(got) == [7, 8, 20] and len(got.inputFiles()) == 3
    assert len(ids(readers.read_latest_minutes(spark, out, 100))) == 10
    with pytest.raises(FileNotFoundError):
        readers.read_latest_minutes(spark, f"{tmp_path}/none", 1)


def test_unequal_schema_is_null_filled(spark):
    a = tape(spark, [("A", 1, 1.0, 2.0, 0, True)])
    out = readers.union_aligned([a, a.drop("quantity").withColumn("extra", F.lit(1))], AGG_TRADES)
    assert out.columns == AGG_TRADES.fieldNames()
    assert sorted((r.quantity is None) for r in out.collect()) == [False, True]


LINES = ["1,10.5,2,1,1,1000,true", "2,9.5,1,2,2,2000,False"]
HEAD = "agg_trade_id,price,quantity,first_trade_id,last_trade_id,transact_time,is_buyer_maker"


def test_csv_trades(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([HEAD, *LINES]) + "\n")
    (tmp_path / "b.csv").write_text("3,8,1,3,3,3000,true\n")
    got = readers.read_headerless_trades(spark, str(tmp_path))
    assert ids(got) == [1, 2, 3] and got.schema == AGG_TRADES
    assert sorted(r.is_buyer_maker for r in got.collect()) == [False, True, True]
    declared = readers.read_trades_csv(spark, str(tmp_path / "a.csv"))
    assert ids(declared) == [1, 2] and dict(declared.dtypes)["transact_time"] == "bigint"


def test_datasets_match_by_trimmed_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("price,id,qty ,quote_qty,time,is_buyer_maker\n2.5,7,1,2.5,99,true\n")
    r = readers.read_dataset(spark, "trades", str(tmp_path / "t.csv")).first()
    assert (r.id, r.price, r.qty, r.time, r.is_buyer_maker) == (7, 2.5, 1.0, 99, True)
    with pytest.raises(ValueError, match="missing"):
        readers.read_dataset(spark, "bookTicker", str(tmp_path / "t.csv"))
    with pytest.raises(ValueError, match="unknown dataset"):
        readers.read_dataset(spark, "other", str(tmp_path / "t.csv"))


def test_klines(spark, tmp_path):
    line = "0,1,3,0.5,2,10,59999,20,4,5,9,0"
    (tmp_path / "k.csv").write_text(",".join(KLINES.fieldNames()) + "\n" + line + "\n")
    k = readers.read_klines(spark, str(tmp_path / "k.csv"))
    assert k.schema == KLINES and k.count() == 1
    b = readers.klines_as_bars(k, "A", "1m").first()
    assert (b.open, b.high, b.low, b.close, b.volume) == (1.0, 3.0, 0.5, 2.0, 10.0)


def test_symbol_csvs_skip_malformed_paths(spark, tmp_path):
    for path in ("xchg/1m/BTC__x.csv", "xchg/1m/ETH__y.csv", "xchg/1m/broken.csv"):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text("\n".join([HEAD, LINES[0]]) + "\n")
    got = readers.read_symbol_csvs(spark, str(tmp_path))
    assert sorted((r.symbol, r.exchange, r.timeframe) for r in got.collect()) == [("BTC", "xchg", "1m"), ("ETH", "xchg", "1m")]
    writers.write_symbol_csv(got, f"{tmp_path}/out")
    assert sorted(c for c in files.children(spark, f"{tmp_path}/out") if c.startswith("symbol=")) == ["symbol=BTC", "symbol=ETH"]


def test_generic_read_and_write(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    for fmt, options in (("parquet", {}), ("json", {}), ("csv", {"header": True})):
        writers.write_data(df, f"{tmp_path}/{fmt}", fmt, **options)
        assert readers.read_data(spark, f"{tmp_path}/{fmt}", fmt, **options).first().s == "a"
    for call in (lambda: readers.read_data(spark, "x", "orc"), lambda: writers.write_data(df, "x", "orc")):
        with pytest.raises(ValueError):
            call()


def test_messages_ignore_other_events_and_keep_corrupt_ones(spark):
    lines = [
        '{"e":"aggTrade","E":7,"s":"A","a":1,"p":"2.5","q":"3","m":true}',
        '{"e":"aggTrade","E":7,"T":5,"s":"A","a":2,"p":"x","q":"3","m":"false"}',
        '{"e":"kline"}',
        "{oops",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = sorted(messages.decode_messages(df).collect(), key=lambda r: r.agg_trade_id)
    assert [(r.price, r.quantity, r.event_time, r.transact_time, r.is_buyer_maker) for r in got] == [
        (2.5, 3.0, 7, 7, True), (None, 3.0, 7, 5, False),
    ]
    assert [r.corrupt for r in messages.corrupt_messages(df).collect()] == ["{oops"]


def test_bars_overwrite_only_their_partitions(spark, tmp_path):
    out = f"{tmp_path}/bars"
    one = bars_with_footprint(tape(spark, [("A", 1, 1.0, 1.0, 0, True), ("B", 2, 2.0, 1.0, 0, True)]), "1h")
    writers.write_bars(one, out)
    writers.write_bars(bars_with_footprint(tape(spark, [("A", 3, 9.0, 1.0, 0, True)]), "1h"), out)
    assert {r.symbol: r.open for r in spark.read.parquet(out).collect()} == {"A": 9.0, "B": 2.0}


def test_minute_upsert(spark, tmp_path):
    out = f"{tmp_path}/minutes"
    writers.upsert_minutes(tape(spark, [("A", 1, 1.0, 1.0, 0, True), ("A", 1, 1.0, 1.0, 0, True), ("A", 2, 1.0, 1.0, 60000, True)]), out)
    writers.upsert_minutes(tape(spark, [("A", 1, 5.0, 1.0, 10, True), ("A", 3, 1.0, 1.0, 20, True)]), out)
    got = {r.agg_trade_id: r.price for r in spark.read.parquet(out).collect()}
    assert got == {1: 5.0, 2: 1.0, 3: 1.0}
    writers.append_minutes(tape(spark, [("A", 3, 1.0, 1.0, 20, True)]), out)
    assert spark.read.parquet(out).count() == 4


def test_upsert_opens_only_touched_days(spark, tmp_path):
    out = f"{tmp_path}/minutes"
    writers.append_minutes(tape(spark, [("A", k, 1.0, 1.0, k * DAY, True) for k in range(5)]), out)
    new = with_minute_parts(tape(spark, [("A", 9, 1.0, 1.0, 3 * DAY, True)]))
    stored = writers.stored_partitions(new, out, writers.MINUTE_PARTS, "day")
    assert ids(stored) == [3]
    assert all("day=1970-01-04" in f for f in stored.inputFiles())
    absent = with_minute_parts(tape(spark, [("A/B", 9, 1.0, 1.0, 9 * DAY, True)]))
    assert writers.stored_partitions(absent, out, writers.MINUTE_PARTS, "day") is None


def test_bars_of_two_ranges(spark, tmp_path):
    out = f"{tmp_path}/bars"
    rows = [("A", k, 1.0 + k, 1.0, k * DAY, True) for k in range(10)]
    for part in (rows[:5], rows[5:], rows[:5]):
        writers.write_bars(bars_with_footprint(tape(spark, part), "1d"), out)
    assert sorted(r.open for r in spark.read.parquet(out).collect()) == [1.0 + k for k in range(10)]


def test_landing_keeps_trades_without_ids(spark, tmp_path):
    out = f"{tmp_path}/minutes"
    rows = [("A", None, 1.0 + k, 1.0, k, True) for k in range(10)] + [("A", 5, 1.0, 1.0, 3, True)]
    for _ in range(2):
        writers.upsert_minutes(tape(spark, rows), out)
    assert spark.read.parquet(out).count() == 11


def test_upsert_keeps_stored_columns(spark, tmp_path):
    out = f"{tmp_path}/minutes"
    stored = tape(spark, [("A", 1, 1.0, 1.0, 0, True), ("A", 2, 1.0, 1.0, 5, True)]).withColumn("note", F.lit("x"))
    writers.upsert_minutes(stored, out)
    writers.upsert_minutes(tape(spark, [("A", 1, 9.0, 1.0, 0, True)]).drop("first_trade_id"), out)
    got = {r.agg_trade_id: r for r in spark.read.option("mergeSchema", True).parquet(out).collect()}
    assert "first_trade_id" in got[2].asDict() and (got[2].note, got[1].note, got[1].price) == ("x", None, 9.0)


def test_range_named_siblings_stay(spark, tmp_path):
    base = f"{tmp_path}/ind"
    bars = ohlcv(tape(spark, [("A", k, 1.0, 1.0, k * HOUR, True) for k in range(3)]), "1h")
    other = writers.write_range_named(bars, base, "btc_1h")
    writers.write_range_named(bars, base, "btc")
    writers.write_range_named(bars, base, "btc")
    assert sorted(files.children(spark, base)) == ["btc_197001010000_197001010200", other.rsplit("/", 1)[1]]


def test_purge_keeps_the_layout(spark, tmp_path):
    table = f"{tmp_path}/minutes"
    rows = [("A", k, 1.0, 1.0, DAY * (k // 2) + HOUR * 5 * (k % 2), True) for k in range(8)]
    writers.upsert_minutes(tape(spark, rows), table)
    as_of = datetime(1970, 1, 3, 15, tzinfo=timezone.utc)
    assert writers.archive_and_purge(spark, table, f"{tmp_path}/archive", as_of) == (4, 4)
    writers.upsert_minutes(tape(spark, [("A", 6, 7.0, 1.0, 3 * DAY, True), ("A", 99, 1.0, 1.0, 3 * DAY, True)]), table)
    got = {r.agg_trade_id: r.price for r in writers.read_partitioned(spark, table, writers.MINUTE_PARTS).collect()}
    assert got == {4: 1.0, 5: 1.0, 6: 7.0, 7: 1.0, 99: 1.0}
    assert not [c for c in files.children(spark, str(tmp_path)) if "next" in c]


def test_purge_rewrites_mixed_partitions(spark, tmp_path):
    table = f"{tmp_path}/tape"
    writers.merge_day(tape(spark, [("A", k, 1.0, 1.0, k * 10 * DAY, True) for k in range(6)]), table)
    assert writers.archive_and_purge(spark, table, f"{tmp_path}/archive", datetime(1970, 1, 15, tzinfo=timezone.utc)) == (2, 4)
    assert ids(writers.read_partitioned(spark, table, ["symbol", "month"])) == [2, 3, 4, 5]


@pytest.mark.parametrize("parted", [True, False])
def test_purge_takes_up_what_was_cut_short(spark, tmp_path, parted):
    table, archive, as_of = f"{tmp_path}/tape", f"{tmp_path}/archive", datetime(1970, 1, 15, tzinfo=timezone.utc)

    def land(rows):
        if parted:
            writers.merge_day(tape(spark, rows), table)
        else:
            tape(spark, rows).write.mode("append").parquet(table)

    land([("A", k, 0.1 * k, 1.0, k * 5 * DAY, True) for k in range(6)])
    (first,) = writers.archive_old(spark, table, archive, as_of)  # and the job ends here
    land([("A", 7, 1.0, 1.0, DAY, True)])
    files.touch(spark, f"{writers._pending(archive, table)}archive_19700101_000000")  # an archive that was never finished
    tape(spark, [("X", 1, 1.0, 1.0, 0, True)]).write.csv(f"{archive}/archive_19700101_000000")
    files.delete(spark, f"{archive}/archive_19700101_000000/_SUCCESS")
    assert writers.archive_and_purge(spark, table, archive, as_of) == (4, 3)
    assert writers.archive_and_purge(spark, table, archive, as_of) == (0, 3)
    assert sorted(files.children(spark, archive)) == [first.rsplit("/", 1)[1], f"{first.rsplit('/', 1)[1]}_2"]
    stored = spark.read.option("header", True).csv([f"{archive}/{c}" for c in files.children(spark, archive)])
    assert sorted(r.agg_trade_id for r in stored.collect()) == ["0", "1", "2", "7"]
    assert ids(writers._stored_rows(spark, table)[0]) == [3, 4, 5]


def test_cut_short_swap_is_finished(spark, tmp_path):
    table, as_of = f"{tmp_path}/table", datetime(1970, 1, 3, tzinfo=timezone.utc)
    tape(spark, [("A", k, 1.0, 1.0, DAY * k, True) for k in range(4)]).write.parquet(f"{table}_previous")
    tape(spark, [("A", k, 1.0, 1.0, DAY * k, True) for k in (2, 3)]).write.parquet(f"{table}_next")
    assert writers.archive_and_purge(spark, table, f"{tmp_path}/archive", as_of) == (0, 2)
    assert ids(spark.read.parquet(table)) == [2, 3] and not files.exists(spark, f"{table}_previous")


def test_purge_reads_old_partitions_only(spark, tmp_path):
    table, as_of = f"{tmp_path}/minutes", datetime(1970, 1, 3, 15, tzinfo=timezone.utc)
    writers.upsert_minutes(tape(spark, [("A", k, 1.0, 1.0, DAY * k, True) for k in range(6)]), table)
    rows, parts = writers._stored_rows(spark, table)
    plan = rows.where(writers.may_be_old(parts, as_of))
    assert {f.split("day=")[1][:10] for f in plan.inputFiles()} >= {"1970-01-01", "1970-01-02"}
    assert "PartitionFilters: [isnotnull(day" in plan._jdf.queryExecution().executedPlan().toString() and plan.count() == 2


def test_purge_cut_short_behind_a_rewritten_partition(spark, tmp_path):
    """The archive then holds more rows of the month than the table has; the others of that month stay."""
    table, archive, as_of = f"{tmp_path}/tape", f"{tmp_path}/archive", datetime(1970, 1, 15, tzinfo=timezone.utc)
    writers.merge_day(tape(spark, [("A", k, 1.0, 1.0, k * 4 * DAY, True) for k in range(6)]), table)
    (stored,) = writers.archive_old(spark, table, archive, as_of)
    writers.purge_archived(spark, table, archive, [stored], as_of)
    files.touch(spark, f"{writers._pending(archive, table)}{stored.rsplit('/', 1)[1]}")  # as if the job had ended before this went
    assert writers.archive_and_purge(spark, table, archive, as_of) == (4, 2)
    assert ids(writers._stored_rows(spark, table)[0]) == [4, 5]
    writers.merge_day(tape(spark, [("A", 9, 1.0, 1.0, 0, True)]), table)
    with pytest.raises(RuntimeError, match="1 old rows, of which 0 are archived"):
        writers.purge_archived(spark, table, archive, [], as_of)


def test_nested_documents_are_compared_whole(spark, tmp_path):
    out = f"{tmp_path}/docs"
    texts = ['{"a":{"x":1,"y":[{"p":1,"q":2}]},"b":2}', '{"b":2, "a":{"y":[{"q":2,"p":1}],"x":1}}', "not json", '{"a":{"x":2}}']
    docs = spark.createDataFrame([("t", "d", x) for x in texts], "task string, day string, doc string")
    for _ in range(2):
        writers.append_documents(docs, out)
    assert spark.read.parquet(out).count() == 3


def test_day_is_merged_into_its_month(spark, tmp_path):
    out = f"{tmp_path}/tape"
    writers.merge_day(tape(spark, [("A", 1, 1.0, 1.0, 0, True), ("A", 2, 1.0, 1.0, 40 * DAY, True)]), out)
    writers.merge_day(tape(spark, [("A", 1, 7.0, 1.0, 0, True), ("A", 3, 1.0, 1.0, DAY, True)]), out)
    got = {(r.agg_trade_id, str(r.month)): r.price for r in spark.read.parquet(out).collect()}
    assert got == {(1, "1970-01"): 7.0, (2, "1970-02"): 1.0, (3, "1970-01"): 1.0}


def test_documents_are_appended_once(spark, tmp_path):
    out = f"{tmp_path}/docs"
    docs = spark.createDataFrame([("t", "d", '{"a":1}'), ("t", "d", '{"a": 1}')], "task string, day string, doc string")
    for _ in range(2):
        writers.append_documents(docs, out)
    assert spark.read.parquet(out).count() == 1


def test_range_named_table_replaces_the_older_range(spark, tmp_path):
    base = f"{tmp_path}/ind"
    bars = ohlcv(tape(spark, [("A", k, 1.0, 1.0, k * HOUR, True) for k in range(3)]), "1h")
    first = writers.write_range_named(bars.limit(1).where("true"), base, "A_1h")
    second = writers.write_range_named(bars, base, "A_1h")
    assert second.endswith("A_1h_197001010000_197001010200") and first != second
    assert files.children(spark, base) == [second.rsplit("/", 1)[1]]
    assert writers.write_range_named(bars, base, "A_1h") == second and spark.read.parquet(second).count() == 3


def test_archive_and_purge(spark, tmp_path):
    table, archive = f"{tmp_path}/table", f"{tmp_path}/archive"
    tape(spark, [("A", k, 1.0, 1.0, DAY * k + HOUR, True) for k in range(4)]).write.parquet(table)
    as_of = datetime(1970, 1, 3, 15, tzinfo=timezone.utc)
    assert writers.archive_and_purge(spark, table, archive, as_of) == (2, 2)
    assert ids(spark.read.parquet(table)) == [2, 3]
    stored = spark.read.option("header", True).csv(f"{archive}/archive_19700103_150000")
    assert sorted(r.agg_trade_id for r in stored.collect()) == ["0", "1"]
    assert not files.exists(spark, f"{table}_previous")


def test_historical_flow(spark, tmp_path):
    base, out = f"{tmp_path}/tape", f"{tmp_path}/bars"
    rows = random_rows(200, symbols=("A", "B"))
    dated(spark, rows).write.partitionBy("symbol", "date").parquet(base)
    batch.historical_bars(spark, base, out, ["A"], "1970-01-01", "1970-01-31", ["1h", "4h"])
    got = spark.read.parquet(out)
    want = bars_with_footprint(tape(spark, [r for r in rows if r[0] == "A"]), "4h")
    key = ["time_rounded", "open", "close", "qty"]
    assert sorted(map(tuple, got.where("timeframe = '4h'").select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))
    assert {r.timeframe for r in got.select("timeframe").distinct().collect()} == {"1h", "4h"}


def test_historical_flow_folds_once_and_resumes(spark, tmp_path, monkeypatch):
    base, out = f"{tmp_path}/tape", f"{tmp_path}/bars"
    rows = random_rows(300, symbols=("A", "B"))
    dated(spark, rows).write.partitionBy("symbol", "date").parquet(base)
    folds = []
    real = batch.footprint.bars_with_footprint
    monkeypatch.setattr(batch.footprint, "bars_with_footprint", lambda *a: folds.append(a[1]) or real(*a))
    frames = ["1m", "5m", "15m", "30m", "1h", "4h", "12h", "1d", "1w"]
    done = [batch.historical_bars(spark, base, out, symbols, "1970-01-01", "1970-01-31", frames).count() for symbols in (["A"], ["A"], ["A", "B"])]
    assert done == [9, 0, 9] and folds == ["1m", "1m"]
    got = spark.read.parquet(out)
    for frame in ("5m", "4h", "1w"):
        want = real(tape(spark, rows), frame)
        columns = [F.to_json(F.struct(*[F.expr(c) for c in ("symbol", "time_rounded", "open", "close", "high", "low", "round(qty, 6) qty", "round(sum_total_bid_qty, 6) b", "map_entries(footprint) f")])).alias("x")]
        assert sorted(r.x for r in got.where(F.col("timeframe") == frame).select(columns).collect()) == sorted(r.x for r in want.select(columns).collect())
