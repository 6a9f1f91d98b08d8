"""Sum-of-squares packing of token sequences."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import binary, each_slice, partitions
from tickloom.llm.tokens import encoder, word_units

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


class SumOfSquares:
    """Open bins of one task, counted by their residual gap.

    A piece goes where the sum of the squared counts becomes smallest; full bins leave the count. Of
    equal places the fullest bin wins. A new bin is opened only where no open one has room, so that
    there are as few as possible. It keeps one number for each open bin.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)  # open bins by gap
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset in it."""
        here = self.count[length:]
        gaps = np.flatnonzero(here)
        if len(gaps):
            # A bin of gap g moves to gap g - length: its square falls by 2 N(g) - 1, the other rises by 2 N(g - length) + 1.
            change = 2 * (self.count[gaps] - here[gaps]) + 2
            if gaps[0] == 0:
                change[0] = 1 - 2 * here[0]
            after = int(gaps[int(np.argmin(change))])
            gap = after + length
            number = self.bins[gap].pop()
            self.count[gap] -= 1
        else:
            gap, number = self.capacity, self.made
            self.made += 1
            after = gap - length
        if after:
            self.bins[after].append(number)
            self.count[after] += 1
        return number, self.capacity - gap


def tokenized_pieces(docs: DataFrame, path: str, units: Callable = word_units, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """Token ids of every whole text and an end id, cut into pieces of at most ``capacity``; the last may be shorter."""

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts = encoder(path, units).encode(binary(part.column("text")))
        rows: list[tuple] = []
        end = 0
        for doc_id, n in zip(part.column("doc_id").to_pylist(), counts.tolist()):
            raw = ids[end : end + n].tobytes() + end_id.to_bytes(4, "little")
            end += n
            for k, a in enumerate(range(0, len(raw), 4 * capacity)):
                piece = raw[a : a + 4 * capacity]
                rows.append((doc_id, k, a // 4, len(piece) // 4, piece))
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select("doc_id", "text").mapInArrow(each_slice(make), PIECES)


def pack(pieces: DataFrame, tasks: int, capacity: int = 4096) -> DataFrame:
    """Add sequence_id and offset to pieces (length from 1 to ``capacity``).

    Pieces are dealt to ``tasks`` by a hash, so no document, source or length gathers in one; each
    task takes them longest first and keeps a number for each open sequence only. Python gets the
    lengths alone; the ids stay in the JVM. With some ten thousand pieces a task, what the tasks leave open is a small fraction of a per cent.
    """

    @F.arrow_udf("sequence_id bigint, offset bigint")
    def placed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bins, first = SumOfSquares(capacity), TaskContext.get().partitionId() << 40
        for lengths in batches:
            number, offset = np.array([bins.place(n) for n in lengths.to_pylist()], np.int64).reshape(-1, 2).T
            yield pa.StructArray.from_arrays([pa.array(number + first), pa.array(offset)], names=["sequence_id", "offset"])

    dealt = pieces.select("doc_id", "piece", "start", "length", "ids").repartition(tasks, F.xxhash64("doc_id", "piece", "start", "length"))
    dealt = dealt.sortWithinPartitions(F.desc("length"), "doc_id", "piece")
    # Not deterministic: evaluated once, on the sorted rows.
    at = dealt.withColumn("at", placed.asNondeterministic()("length"))
    return at.select("doc_id", "piece", "start", "length", "ids", "at.sequence_id", "at.offset")


def pack_documents(
    docs: DataFrame, path: str, units: Callable = word_units, end_id: int = 1, capacity: int = 4096, docs_per_task: int = 10_000
) -> DataFrame:
    """Pack every document of ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids (binary, little-endian u32), sequence_id and offset, a row
    for each piece. A null or empty text is the end id alone. Rows with equal or null doc_id are packed
    each for itself. Other columns are not read; an empty table gives no rows.
    """
    tasks = partitions(docs.count(), docs_per_task)
    return pack(tokenized_pieces(docs, path, units, end_id, capacity), tasks, capacity)
