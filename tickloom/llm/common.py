"""Small helpers of the operators: shared tables, words of Arrow batches, groups of sorted streams."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space that separates words, as a regular expression class without brackets.
BLANKS = r"\x20\x09-\x0D"
#: Bytes of text that a task turns into arrays at a time (one longer text is a slice of its own).
SLICE_BYTES = 1 << 20

_own_root: str | None = None


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset (tests), below a temporary one."""
    global _own_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = _own_root = _own_root or tempfile.mkdtemp(prefix="llm-")
    return f"{root}/llm-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps survive lost executors without recomputing it."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def partitions(rows: int, per_task: int) -> int:
    return max(1, -(-rows // per_task))


def binary(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """Values as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Rows of ``batch`` in runs of about SLICE_BYTES of text, so that arrays stay small whatever the batch holds."""
    if not batch.num_rows:
        return
    lengths = np.array(pc.binary_length(batch.column(column).cast(pa.binary())).fill_null(0), dtype=np.int64)
    part = (np.cumsum(lengths) - lengths) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def bounds(lengths: np.ndarray) -> np.ndarray:
    """0 and the running sums."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, ... of each run, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` neighbours (one for each place where a run fits)."""
    n = len(hashes) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        for k in range(width):
            out = out * np.uint64(0x100000001B3) + hashes[k : k + n]
    return mixed(out)


def each_slice(make: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """A ``mapInArrow`` function that hands ``make`` bounded slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                if (out := make(part)) is not None:
                    yield out

    return run


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` in a stream that is sorted by it; a run may span batches."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key)
        change = np.flatnonzero(np.array(pc.not_equal(values[1:], values[:-1]), dtype=bool)) + 1
        edges = [0, *change.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            part = batch.slice(a, b - a)
            if rest and rest[0].column(key)[0] != part.column(key)[0]:
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(part)
    if rest:
        yield pa.Table.from_batches(rest)


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, or with underscores behind it a name that no column of the frames has (names differ by more than case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, order: Column, name: str, tasks: int = 32) -> DataFrame:
    """Number the rows from 0 in ``order``: a range sort, and the driver gets one count for each of its ``tasks`` parts."""
    place = fresh("place", df)
    cut = staged(df.repartitionByRange(tasks, order).sortWithinPartitions(order).withColumn(place, F.monotonically_increasing_id()))
    part = F.shiftright(place, 33)
    sizes = {r.part: r.n for r in cut.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, first = 0, []
    for k in sorted(sizes):
        first += [F.lit(k).cast("bigint"), F.lit(before).cast("bigint")]
        before += sizes[k]
    if not first:
        return df.withColumn(name, F.lit(0).cast("bigint"))
    return cut.withColumn(name, F.element_at(F.create_map(*first), part) + F.col(place).bitwiseAND((1 << 33) - 1)).drop(place)
