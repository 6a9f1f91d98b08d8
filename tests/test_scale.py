"""Plan and skew checks: what must stay true for a large tape with one dominant symbol."""

import re

import pytest

import __spark_entry__ as entry
from tests.helpers import HOUR, random_rows, tape
from tickloom.operators import bars, footprint, lifecycle, profile, stats
from tickloom.operators.indicators.registry import build, indicator_table
from tickloom.operators.series import index_bars
from tickloom.operators.wide import trade_row_keys
from tickloom.plans.batch import analysis_table
from tickloom.plans.catalog import QUERIES

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    """Of the library's own queries; those of the optional subpackage, which may use Python, are checked beside it."""
    return {name: plan(query(spark, SMALL)) for name, query in QUERIES.items()}


def window_keys(text):
    """Partition and order columns of the windows in a plan, except those over bucket sizes."""
    out = []
    for line in text.splitlines():
        if re.search(r"\bWindow \[", line) and "sum(_size" not in line:
            specs = re.search(r"windowspecdefinition\(([^\n]*?)(?:specifiedwindowframe|$)", line)
            assert specs, line
            out.append({re.sub(r"#\d+L?", "", c).split(" ASC")[0].split(" DESC")[0].strip() for c in specs.group(1).split(",")})
    return out


def test_bars_aggregate_by_hash_with_map_side_combine(spark):
    text = plan(bars.ohlcv(tape(spark, random_rows(50)), "1w"))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    assert "partial_min_by" in text and text.index("partial_min_by") > text.index("Exchange hashpartitioning")


def test_one_pass_reads_the_tape_once_without_join_or_python(spark):
    df = entry.queries()["bars_one_pass"](spark, SMALL)
    text = plan(df)
    assert text.count("FileScan parquet") == 1 and "Join" not in text and "Python" not in text
    assert text.count("Exchange hashpartitioning") == 2


def test_scan_reads_only_needed_columns(spark):
    text = plan(entry.queries()["rate_per_minute"](spark, SMALL))
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", text).group(1)
    assert "value" not in schema and "props" not in schema


def test_no_python_in_any_query_but_the_stateful_indicators(plans):
    stateful = {"psar", "mama", "mcgd_10", "indicator_catalogue"}
    for name, text in plans.items():
        assert name in stateful or ("Python" not in text and "InPandas" not in text), name


def test_no_cartesian_or_nested_loop_join(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_row_windows_are_cut_into_blocks(spark, tmp_path):
    """Windows over bars or trades also partition by block or bucket; only border tables go by series."""
    source = bars.ohlcv(tape(spark, random_rows(300, step_ms=HOUR)), "1h")
    source.write.parquet(f"{tmp_path}/bars")
    table, _ = indicator_table(spark.read.parquet(f"{tmp_path}/bars"))
    for df in (table, index_bars(source), trade_row_keys(tape(spark, random_rows(50)))):
        for keys in window_keys(plan(df)):
            assert keys & {"_block", "_bucket"}, keys


def test_top_levels_are_limited_before_the_shuffle(spark):
    text = plan(profile.top_level_imbalance(footprint.footprint_levels(tape(spark, random_rows(100)), "1h")))
    assert "WindowGroupLimit" in text


@pytest.fixture(scope="module")
def hot(spark):
    """Nine tenths of the trades on one symbol, a third of them at one price."""
    rows = [
        (s, i, 100.0 if i % 3 == 0 else p, q, t, m)
        for s, i, p, q, t, m in random_rows(3000, step_ms=HOUR // 20, hot=0.9)
    ]
    df = tape(spark, rows).cache()
    yield rows, df
    df.unpersist()


def test_hot_symbol_totals_are_whole(spark, hot):
    rows, df = hot
    full = footprint.bars_with_footprint(df, "1h").cache()
    assert full.selectExpr("sum(qty)").first()[0] == sum(r[3] for r in rows)
    cells = footprint.explode_footprint(full)
    assert cells.selectExpr("sum(total_bid_trades + total_ask_trades)").first()[0] == len(rows)
    table = analysis_table(bars.ohlcv(df, "1h"), footprint.footprint_levels(df, "1h"))
    assert lifecycle.key_mismatches(full, table, ["symbol", "time_rounded"]).count() == 0
    full.unpersist()


def test_hot_copies_reduce_before_the_shuffle(spark, hot):
    rows, df = hot
    copies = df.where("agg_trade_id = 0")
    for _ in range(6):
        copies = copies.unionByName(copies)
    deduped = lifecycle.append_and_dedupe(df, copies)
    assert deduped.count() == len(rows)
    text = plan(deduped)
    assert "partial_max_by" in text and "Window" not in text


def test_median_of_a_hot_value(spark, hot):
    rows, df = hot
    import statistics

    assert stats.exact_median(df, "price").first()[0] == statistics.median(r[2] for r in rows)


def test_indicator_specs_bound_their_look_back():
    for name in ("sma", "stoch", "adx", "trix", "kama", "hilo"):
        spec = build(name)
        assert 0 < spec.pre + spec.post < 512
