"""Token-id files: documents compressed one by one against a shared dictionary.

A file set is a folder with two tables. ``dictionary`` has one row: the zstandard dictionary, trained
on serialized id arrays of a bounded sample, its sha256 and the bytes an id takes. ``blocks`` has a
row for each run of documents: the dictionary's hash, the ids of the documents, how many token ids
each has, where its frame starts in the blob (the offset index), the smallest and largest document id,
the token ids before the block in its shard, and the blob of frames. Shards follow each other in
ascending order of documents, so a document is read by its block's index and one frame, and the whole
corpus by streaming the blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tickloom.llm.common import binary, partitions, slices, staged
from tickloom.llm.tokens import encoder, space_units

BLOCKS = "shard int, block int, dictionary string, doc_ids array<bigint>, counts array<bigint>, offsets array<bigint>, before bigint, low bigint, high bigint, blob binary"
FRAMES = "doc_id bigint, tie string, n bigint, frame binary"
READ = "shard int, before bigint, doc_id bigint, n_tokens bigint, ids binary"


def _serialized(texts: list[bytes], path: str, units: Callable, width: str) -> tuple[list[bytes], np.ndarray]:
    """The ids of each text as bytes of ``width``, and how many there are."""
    ids, counts = encoder(path, units).encode(texts)
    if len(ids) and int(ids.max()) >= 1 << (8 * np.dtype(width).itemsize):
        raise ValueError(f"token id {int(ids.max())} does not fit {width}")
    raw = ids.astype(width).tobytes()
    ends = (np.cumsum(counts) * np.dtype(width).itemsize).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)], counts


def train_dictionary(docs: DataFrame, path: str, units: Callable, width: str, rows: int, sample: int, size: int) -> bytes:
    """A zstandard dictionary from about ``sample`` documents, chosen by a hash of their id.

    Their id arrays are cut to 64 KB each, so the driver holds a bounded amount; the dictionary only
    affects the size of the files. Too small a sample gives its plain bytes as the dictionary.
    """
    every = max(1, rows // sample)
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(every)) == 0)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                arrays, _ = _serialized(binary(part.column("text")), path, units, width)
                yield pa.record_batch({"x": pa.array([a[:65536] for a in arrays], pa.binary())})

    samples = [bytes(r.x) for r in chosen.select("text").mapInArrow(run, "x binary").limit(2 * sample).collect() if r.x]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_token_files(
    docs: DataFrame,
    folder: str,
    path: str,
    units: Callable = space_units,
    end_id: int | None = 0,
    width: str = "<u2",
    block_bytes: int = 1 << 20,
    docs_per_shard: int = 4000,
    sample: int = 1000,
    dictionary_bytes: int = 64 << 10,
    level: int = 1,
) -> None:
    """Encode every whole text of ``docs`` (doc_id, text) and write a file set to ``folder``.

    Documents come in ascending doc_id order, a null doc_id first, equal ids by their text. A null
    text is empty; an empty text has the end id only. Other columns are not read. An empty table
    gives a file set without blocks.
    """
    spark, rows = docs.sparkSession, docs.count()
    raw = train_dictionary(docs.select("doc_id", "text"), path, units, width, rows, sample, dictionary_bytes)
    name = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(name, raw, width)], "dictionary string, bytes binary, width string").write.parquet(f"{folder}/dictionary")
    tail = b"" if end_id is None else int(end_id).to_bytes(np.dtype(width).itemsize, "little")

    def compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(raw), write_checksum=False)
        for batch in batches:
            for part in slices(batch):
                arrays, counts = _serialized(binary(part.column("text")), path, units, width)
                n = pa.array(counts.astype(np.int64) + (end_id is not None))
                frame = pa.array([frames.compress(x + tail) for x in arrays], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), part.column("tie").cast(pa.string()), n, frame], names=["doc_id", "tie", "n", "frame"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        longs = pa.list_(pa.int64())
        types = [pa.int32(), pa.int32(), pa.string(), longs, longs, longs, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["shard", "block", "dictionary", "doc_ids", "counts", "offsets", "before", "low", "high", "blob"]
        ids: list = []
        counts: list[int] = []
        blob: list[bytes] = []

        def flush() -> pa.RecordBatch:
            offsets = np.cumsum([0, *map(len, blob)]).tolist()
            known = [x for x in ids if x is not None] or [None]
            row = [shard, block, name, ids, counts, offsets, before, min(known), max(known), b"".join(blob)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        held = 0
        for batch in batches:
            for doc_id, n, frame in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "n", "frame")]):
                ids.append(doc_id)
                counts.append(n)
                blob.append(frame)
                held += len(frame)
                if held >= block_bytes:
                    yield flush()
                    before += sum(counts)
                    block, held, ids, counts, blob = block + 1, 0, [], [], []
        if ids:
            yield flush()

    # Texts are compressed where they are read: what is sorted and shuffled are their frames. Only where a doc_id comes
    # more than once does its text go along, to tell the rows apart.
    repeated = not docs.groupBy("doc_id").count().where("count > 1").isEmpty()
    tie = F.col("text") if repeated else F.lit(None).cast("string")
    frames = staged(docs.select("doc_id", "text", tie.alias("tie")).mapInArrow(compressed, FRAMES).withColumn("turn", F.monotonically_increasing_id()))
    order = ["doc_id", "tie", "turn"]  # the last keeps equal rows from gathering in one task
    ordered = frames.repartitionByRange(partitions(rows, docs_per_shard), *order).sortWithinPartitions(*order)
    ordered.drop("tie", "turn").mapInArrow(blocks, BLOCKS).write.parquet(f"{folder}/blocks")


def _opened(spark: SparkSession, folder: str) -> tuple[str, bytes, str]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    raw = bytes(row.bytes)
    if hashlib.sha256(raw).hexdigest() != row.dictionary:
        raise ValueError(f"{folder}: the dictionary does not have the hash that its name says")
    return row.dictionary, raw, row.width


def _documents(raw: bytes, name: str, width: str, wanted: frozenset | None = None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary"] != name:
                    raise ValueError(f"a block needs dictionary {row['dictionary']}, the file set has {name}")
                starts = np.cumsum([row["before"], *row["counts"]])[:-1].tolist()
                out: list[tuple] = []
                for k, doc_id in enumerate(row["doc_ids"]):
                    if wanted is None or doc_id in wanted:
                        plain = frames.decompress(row["blob"][row["offsets"][k] : row["offsets"][k + 1]])
                        out.append((row["shard"], starts[k], doc_id, row["counts"][k], np.frombuffer(plain, width).astype("<u4").tobytes()))
                if out:
                    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                    columns = [pa.array(v, t) for v, t in zip(zip(*out), types)]
                    yield pa.RecordBatch.from_arrays(columns, names=["shard", "before", "doc_id", "n_tokens", "ids"])

    return run


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents of a file set: doc_id, start (ids of all documents before it), n_tokens, ids (binary, little-endian u32).

    The ids before a shard come from running sums over its thousand of shards and over the thousands.
    """
    name, raw, width = _opened(spark, folder)
    blocks = spark.read.parquet(f"{folder}/blocks")
    own = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, b: a + b)
    sizes = blocks.select("shard", own.alias("n")).groupBy("shard").agg(F.sum("n").alias("n")).withColumn("thousand", F.floor(F.col("shard") / 1000))
    earlier = (Window.unboundedPreceding, -1)
    inner = sizes.withColumn("first", F.coalesce(F.sum("n").over(Window.partitionBy("thousand").orderBy("shard").rowsBetween(*earlier)), F.lit(0)))
    outer = sizes.groupBy("thousand").agg(F.sum("n").alias("all"))
    outer = outer.select("thousand", F.coalesce(F.sum("all").over(Window.orderBy("thousand").rowsBetween(*earlier)), F.lit(0)).alias("base"))
    first = inner.join(outer, "thousand").select("shard", (F.col("first") + F.col("base")).alias("first"))
    # A table of its own, so that its size decides how it is joined; blobs then stay where they are.
    placed = blocks.join(staged(first), "shard").withColumn("before", F.col("before") + F.col("first")).drop("first")
    return placed.mapInArrow(_documents(raw, name, width), READ).select("doc_id", F.col("before").alias("start"), "n_tokens", "ids")


def fetch_documents(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of single documents: blocks are chosen by their smallest and largest id, which is pushed down to
    the scan, and only the documents' frames are opened."""
    name, raw, width = _opened(spark, folder)
    blocks = spark.read.parquet(f"{folder}/blocks")
    asked = sorted({int(x) for x in doc_ids})
    if not asked:
        return blocks.limit(0).mapInArrow(_documents(raw, name, width), READ).select("doc_id", "ids")
    near = [(F.col("low") <= x) & (F.col("high") >= x) for x in asked]
    hit = blocks.where(reduce(lambda a, b: a | b, near)).where(F.arrays_overlap("doc_ids", F.array(*map(F.lit, asked)).cast("array<bigint>")))
    return hit.mapInArrow(_documents(raw, name, width, frozenset(doc_ids)), READ).select("doc_id", "ids")
