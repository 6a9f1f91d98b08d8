"""Steps whose time or memory must not grow faster than their input."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from tickloom.functions.expressions import outermost_objects
from tickloom.operators.footprint import flatten_maps
from tickloom.plans import queries_sources
from tickloom.plans.catalog import QUERIES
from tickloom.sinks import files, writers


def test_many_objects_in_one_text_are_split_in_one_pass(spark):
    deep = '{"a":"}{","x":' + '{"y":' * 50 + "1" + "}" * 51
    df = spark.createDataFrame([(",".join([deep] * 6000),)], "t string")
    began = time.monotonic()
    got = df.select(outermost_objects("t").alias("o")).select(F.size("o").alias("n"), F.size(F.array_distinct("o")).alias("d")).first()
    assert tuple(got) == (6000, 1)
    assert time.monotonic() - began < 30


def test_maps_of_many_entries_are_sorted_once(spark):
    maps = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.map_from_arrays(F.sequence(h, h + 399), F.transform(F.sequence(h, h + 399), lambda k: h * 1000 + k)))
    began = time.monotonic()
    got = spark.range(1).select(flatten_maps(maps).alias("m")).first().m
    assert got == {k: min(k, 23) * 1000 + k for k in range(423)}
    assert time.monotonic() - began < 15


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@pytest.mark.parametrize("name", ["files_per_symbol", "read_symbol_files"])
def test_symbols_are_written_by_several_tasks(spark, tmp_path, monkeypatch, name):
    start = datetime.datetime(2024, 1, 1)
    rows = [(k, start + datetime.timedelta(seconds=k), k, "view", 1.0 + k, f'{{"k": {k % 9}}}') for k in range(400)]
    spark.createDataFrame(rows, EVENTS).repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    made = iter([f"{tmp_path}/one", f"{tmp_path}/two"])
    monkeypatch.setattr(queries_sources, "_folder", lambda _: next(made))
    moved, rename = [], files.rename
    monkeypatch.setattr(files, "rename", lambda s, source, target: (moved.append(source), rename(s, source, target)))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.openCostInBytes", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(kept, ("false", str(128 << 20), "50")):
            spark.conf.set(k, v)
        got = QUERIES[name](spark, str(tmp_path)).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    if name == "files_per_symbol":
        assert sorted((r.symbol, r.files) for r in got) == [(f"S{k}", 1) for k in range(4)]
        moved = [p for k in range(4) for p in files.children(spark, f"{tmp_path}/one/symbol=S{k}") if p.startswith("part-")]
    else:
        assert sorted((r.symbol, r.agg_trade_id, r.price) for r in got) == sorted((f"S{k % 4}", k, 1.0 + k) for k in range(400))
    assert len({p.rsplit("part-", 1)[1][:5] for p in moved}) > 1


def test_open_partitions_are_set_back(spark):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), writers.open_partitions(spark, 3):
        assert spark.conf.get(name) == "3"
        raise RuntimeError
    assert spark.conf.get(name) == before
