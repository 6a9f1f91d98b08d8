"""Packing by non-negative least squares over a histogram of lengths."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tickloom.llm.common import binary, slices
from tickloom.llm.tokens import encoder, space_units

PACKED = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
#: Parts into which a window is divided to enumerate combinations, and the most documents of one.
PARTS, DEPTH = 32, 4
#: A group of tails is planned together; it closes at so many tails or bytes of ids.
GROUP_TAILS, GROUP_BYTES = 20_000, 48 << 20


@cache
def combinations(parts: int = PARTS, depth: int = DEPTH) -> np.ndarray:
    """Counts by length class (0 to ``parts``) of every choice of up to ``depth`` classes that fills a window."""

    def fill(left: int, most: int, room: int) -> Iterator[list[int]]:
        if left == 0:
            yield []
        elif room:
            for x in range(min(left, most), 0, -1):
                for rest in fill(left - x, x, room - 1):
                    yield [x, *rest]

    rows = list(fill(parts, parts, depth))
    out = np.zeros((parts + 1, len(rows)))
    for k, row in enumerate(rows):
        np.add.at(out[:, k], row, 1)
    return out


def non_negative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The x of no negative entry that makes ``a @ x`` nearest to ``b``, by active sets.

    The column that lowers the error fastest enters; where the unconstrained solution of the entered
    columns turns negative, the step stops at the first zero and that column leaves.
    """
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    least = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(3 * a.shape[0]):
        gain = np.where(active, -np.inf, a.T @ (b - a @ x))
        if gain.max() <= least:
            break
        active[int(gain.argmax())] = True
        while True:
            at = np.flatnonzero(active)
            wanted = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            low = wanted <= 0
            if not low.any():
                x[at] = wanted
                break
            falling = at[low]
            step = float(np.min(x[falling] / np.maximum(x[falling] - wanted[low], 1e-300)))
            x[at] += step * (wanted - x[at])
            active[at[x[at] <= 1e-12]] = False
            active[falling[x[falling] <= 1e-12]] = False
            x[~active] = 0
            if not active.any():
                break
    return x


class Tails:
    """Open tails of a group by length; a tail is (document, start)."""

    def __init__(self, capacity: int, lengths: np.ndarray):
        self.by_length: list[list[tuple[int, int]]] = [[] for _ in range(capacity)]
        self.classes = capacity // PARTS
        for k, n in enumerate(lengths.tolist()):
            if n:
                self.by_length[n].append((k, 0))
        self.left = sum(map(len, self.by_length))

    def add(self, length: int, tail: tuple[int, int]) -> None:
        self.by_length[length].append(tail)
        self.left += 1

    def take(self, length: int) -> tuple[int, int, int]:
        """Document, start and length of a tail."""
        self.left -= 1
        return (*self.by_length[length].pop(), length)

    def in_class(self, x: int) -> int:
        """The longest length of class ``x`` (rounded to parts of a window) that is left, 0 if there is none."""
        for n in range(min(len(self.by_length), x * self.classes + self.classes // 2) - 1, max(0, x * self.classes - self.classes // 2 - 1), -1):
            if self.by_length[n]:
                return n
        return 0

    def near(self, length: int) -> int:
        """The length left that is nearest to ``length``, shorter ones first; 0 if there is none."""
        for d in range(len(self.by_length)):
            if 0 < length - d and self.by_length[length - d]:
                return length - d
            if length + d < len(self.by_length) and self.by_length[length + d]:
                return length + d
        return 0

    def finish(self, window: list, gap: int) -> int:
        """Fill ``gap`` of ``window`` to the end while tails are left: with an exact one, else the nearest, cut if longer."""
        while gap and self.left:
            n = gap if gap < len(self.by_length) and self.by_length[gap] else self.near(min(gap, len(self.by_length) - 1))
            k, start, n = self.take(n)
            if n > gap:
                self.add(n - gap, (k, start + gap))
                n = gap
            window.append((k, start, n))
            gap -= n
        return gap


def plan(lengths: np.ndarray, capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that hold all ``lengths`` (each below ``capacity``).

    Repeat counts of the combinations solve the histogram of length classes and are rounded down. Each
    repeat takes its documents but the last from their classes; the last is one of the very length
    that is missing, or the nearest, cut where it is too long. What is left is packed longest first
    in the same way. The end, less than a window, is cut at powers of two, which need no padding.
    """
    tails = Tails(capacity, lengths)
    width = capacity // PARTS
    classes = np.bincount(np.minimum((lengths[lengths > 0] + width // 2) // width, PARTS), minlength=PARTS + 1).astype(float)
    classes[0] = 0  # shorter than half a part: left to the rest
    table = combinations()
    repeats = np.floor(non_negative_least_squares(table, classes) + 1e-6).astype(np.int64)
    out: list[list[tuple[int, int, int]]] = []
    for column in np.flatnonzero(repeats):
        parts = np.repeat(np.arange(PARTS + 1), table[:, column].astype(int))[::-1].tolist()
        for _ in range(int(repeats[column])):
            window, gap = [], capacity
            for x in parts[:-1] or parts:
                n = tails.in_class(x)
                if 0 < n <= gap:
                    window.append(tails.take(n))
                    gap -= n
            if window:
                out.append(window)
                _close(out, tails, gap)
    length = capacity - 1
    while tails.left:
        while not tails.by_length[length]:
            length -= 1
        out.append([tails.take(length)])
        _close(out, tails, capacity - length)
    return out


def _close(out: list, tails: Tails, gap: int) -> None:
    """Fill the last window; if the tails end before, cut it at powers of two."""
    gap = tails.finish(out[-1], gap)
    if not gap:
        return
    pieces = out.pop()
    left = sum(n for _, _, n in pieces)
    while left:
        size = 1 << (left.bit_length() - 1)
        left, window = left - size, []
        while size:
            k, start, n = pieces[0]
            used = min(n, size)
            window.append((k, start, used))
            size -= used
            pieces = pieces[1:] if used == n else [(k, start + used, n - used), *pieces[1:]]
        out.append(window)


def pack_by_least_squares(docs: DataFrame, path: str, units: Callable = space_units, end_id: int = 1, capacity: int = 2048) -> DataFrame:
    """Pack every document of ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens, none of which needs padding.

    Returns doc_id, start, length, ids (binary, little-endian u32), doc_tokens, sequence_id and offset, a
    row for each piece; every sequence has ``capacity`` tokens or a power of two. Whole windows of a
    document are sequences of their own, its tail is planned with those of up to GROUP_TAILS documents that
    lie in the same part of the scan. So nothing is shuffled, no group of equal documents meets in one
    task, and a task holds the tails of one group. A null or empty text is the end id alone. Rows with
    equal or null doc_id are packed each for itself; other columns are not read; an empty table gives no rows.
    """
    if capacity < PARTS or capacity & (capacity - 1):
        raise ValueError(f"capacity must be a power of two from {PARTS} on")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        tails: list[tuple] = []  # (doc_id, doc_tokens, start, ids)
        held = 0

        def packed() -> pa.RecordBatch:
            nonlocal sequence
            rows = []
            for window in plan(np.array([len(t[3]) for t in tails], np.int64), capacity):
                offset = 0
                for k, start, n in window:
                    doc_id, total, first, ids = tails[k]
                    rows.append((doc_id, first + start, n, ids[start : start + n].astype("<u4").tobytes(), total, sequence, offset))
                    offset += n
                sequence += 1
            return _batch(rows)

        for part in chain.from_iterable(map(slices, batches)):
            ids, counts = encoder(path, units).encode(binary(part.column("text")))
            narrow = np.uint16 if not len(ids) or ids.max() < 1 << 16 else np.uint32
            end, rows = 0, []
            for doc_id, n in zip(part.column("doc_id").to_pylist(), counts.tolist()):
                own = np.append(ids[end : end + n], np.uint32(end_id))
                end += n
                whole = (n + 1) // capacity * capacity
                for start in range(0, whole, capacity):
                    rows.append((doc_id, start, capacity, own[start : start + capacity].astype("<u4").tobytes(), n + 1, sequence, 0))
                    sequence += 1
                if whole <= n:
                    tails.append((doc_id, n + 1, whole, own[whole:].astype(narrow)))
                    held += tails[-1][3].nbytes
            if rows:
                yield _batch(rows)
            if len(tails) >= GROUP_TAILS or held >= GROUP_BYTES:
                yield packed()
                tails, held = [], 0
        if tails:
            yield packed()

    return docs.select("doc_id", "text").mapInArrow(run, PACKED)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names=names)
