"""Substring dedup: repeated word windows by matching statistics of suffix automata."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import binary, bounds, each_slice, ragged, rolled, slices, staged
from tickloom.llm.words import Words, _grown, mixed

#: Words of the runs from which a window's anchor is chosen.
GRAM = 8
#: Contents of one anchor beyond which its windows are counted one by one instead of in one automaton.
SHARD = 64


class SuffixAutomaton:
    """Suffix automaton over several word sequences, each with a weight; ``weight`` of a state counts its occurrences."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.weight = [-1], [0], [0]

    def _state(self, length: int, link: int, following: dict) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.weight.append(0)
        return len(self.link) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, self.link[q], self.next[q].copy())
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[int], weight: int) -> None:
        last = 0
        for word in words:
            p, q = last, self.next[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            else:
                last = self._state(self.length[p] + 1, 0, {})
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = last
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][word]
                    self.link[last] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            self.weight[last] += weight

    def count(self) -> None:
        """Carry the weights from longer to shorter suffixes, once all sequences are in."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.weight[self.link[state]] += self.weight[state]

    def repeated(self, words: list[int], width: int) -> int:
        """Bit k is set if the window of ``width`` words that starts at k occurs twice at least.

        The sequence is streamed through the automaton; the matching statistic of each place, cut to
        ``width``, names the state whose weight is the number of occurrences.
        """
        state = matched = bits = 0
        for k, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            state = self.next[state].get(word, 0)
            matched = matched + 1 if state else 0
            while self.length[self.link[state]] >= width:
                state = self.link[state]
                matched = self.length[state]
            if matched >= width and self.weight[state] >= 2:
                bits |= 1 << (k + 1 - width)
        return bits


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest of each ``width`` neighbours."""
    at, step = np.arange(len(values)), 1
    while step < width:
        move = min(step, width - step)
        left, right = at[: len(at) - move], at[move:]
        at = np.where(values[left] <= values[right], left, right)
        step += move
    return at


def _contents(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of the words of each run."""
    up, down = _grown(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(up[: len(hashes)] * hashes, out=sums[1:])
    return mixed((sums[starts + lengths] - sums[starts]) * down[starts] + lengths.astype(np.uint64))


def _segments(words: Words, width: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same anchor: text, first window, windows, anchor hash and content hash.

    The anchor of a window is its leftmost run of GRAM words with the smallest hash, so it depends on the
    window's words only: equal windows have equal anchors at equal places.
    """
    hashes = words.hashes()
    grams = rolled(hashes, GRAM)
    span = width - GRAM + 1
    counts = words.counts
    windows = np.maximum(counts - width + 1, 0)
    if not windows.sum():
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    anchor = _least(grams, span)
    first = ragged(words.at[:-1], windows)
    text = np.repeat(np.arange(len(counts)), windows)
    place = anchor[first]
    edge = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
    runs = np.diff(np.append(edge, len(first)))
    starts = first[edge]
    return text[edge], starts - words.at[text[edge]], runs, grams[place[edge]], _contents(hashes, starts, runs + width - 1)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def repeated_windows(docs: DataFrame, width: int) -> DataFrame:
    """id, tag and start, bits (of up to 28 windows from ``start`` on, those that occur twice) of documents ``docs`` (id, tag, text)."""

    def segments(part: pa.RecordBatch) -> pa.RecordBatch:
        text, start, runs, key, content = _segments(Words(binary(part.column("text"))), width)
        owner = pa.array(text)
        columns = [part.column("id").take(owner), part.column("tag").take(owner), pa.array(start.astype(np.int32)), pa.array(runs.astype(np.int32)), _signed(key), _signed(content)]
        return pa.RecordBatch.from_arrays(columns, names=["id", "tag", "start", "n", "key", "content"])

    rows = "id bigint, tag bigint, start int, n int, key bigint, content bigint"
    cut = staged(docs.mapInArrow(each_slice(segments), rows))
    # A key that one segment has can hold no repetition; a key of equal segments is a repetition throughout.
    keys = cut.groupBy("key").agg(F.count("*").alias("all"), F.min("content").alias("low"), F.max("content").alias("high")).where(F.col("all") > 1)
    keys = staged(keys.select("key", (F.col("low") != F.col("high")).alias("mixed")))  # a side of its own, so that the join can split a hot key
    shared = staged(cut.join(keys, "key"))
    whole = shared.where("not mixed").select("id", "tag", "start", F.expr("shiftleft(1L, n) - 1 AS bits"))

    # Of the others the words are needed: the distinct contents of an anchor go to one shard.
    contents = shared.where("mixed").groupBy("key", "content").agg(F.count("*").alias("times"))
    many = staged(contents.groupBy("key").agg((F.count("*") > SHARD).alias("many")))
    asked = shared.where("mixed").join(many, "key").groupBy("id", "tag").agg(F.collect_list(F.struct("start", "n", "key", "content", "many")).alias("asked"))
    texts = docs.join(asked, ["id", "tag"])

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*[(*k, *v) for k, v in held.items()]), (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()))]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["key", "content", "many", "times", "words"])

        for batch in batches:
            for part in slices(batch):
                words = Words(binary(part.column("text")))
                hashes = words.hashes()
                for at, wanted in zip(words.at.tolist(), part.column("asked").to_pylist()):
                    for x in wanted:
                        if (have := held.get((x["key"], x["content"], x["many"]))) is not None:
                            have[0] += 1
                        else:
                            a = at + x["start"]
                            held[x["key"], x["content"], x["many"]] = [1, hashes[a : a + x["n"] + width - 1].tobytes()]
                    if len(held) > 20_000:
                        yield flush()
        if held:
            yield flush()

    unit = "key bigint, content bigint, many boolean, times bigint, words binary"
    found = staged(texts.select("text", "asked").mapInArrow(units, unit))

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
        out: list[tuple] = []
        for key, group in groupby(stream, key=lambda row: row[0]):
            weights: dict[int, int] = {}
            texts: dict[int, list[int]] = {}
            for _, content, times, raw in group:
                weights[content] = weights.get(content, 0) + times
                if content not in texts:
                    texts[content] = np.frombuffer(raw, np.uint64).tolist()
            automaton = SuffixAutomaton()
            for content, words in texts.items():
                automaton.add(words, weights[content])
            automaton.count()
            out += [(key, content, automaton.repeated(words, width)) for content, words in texts.items()]
            if len(out) > 10_000:
                yield _bits(out)
                out = []
        if out:
            yield _bits(out)

    sharded = found.where("not many").select("key", "content", "times", "words").repartition("key").sortWithinPartitions("key")
    by_automaton = sharded.mapInArrow(matched, "key bigint, content bigint, bits bigint")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, content, times, raw in zip(*[c.to_pylist() for c in batch.columns]):
                hashes = np.frombuffer(raw, np.uint64)
                n = len(hashes) - width + 1
                one = _contents(hashes, np.arange(n), np.full(n, width))
                two = _contents(mixed(hashes), np.arange(n), np.full(n, width))
                columns = [pa.array([x] * n, pa.int64()) for x in (key, content, times)]
                yield pa.RecordBatch.from_arrays([*columns, _signed(one), _signed(two), pa.array(1 << np.arange(n))], names=["key", "content", "times", "one", "two", "bit"])

    single = found.where("many").select("key", "content", "times", "words").mapInArrow(windows, "key bigint, content bigint, times bigint, one bigint, two bigint, bit bigint")
    often = single.groupBy("one", "two").agg(F.sum("times").alias("all")).where(F.col("all") > 1)
    by_window = single.join(often, ["one", "two"]).groupBy("key", "content").agg(F.bit_or("bit").alias("bits"))
    bits = by_automaton.unionByName(by_window).where("bits <> 0").groupBy("key", "content").agg(F.bit_or("bits").alias("bits"))
    part = shared.where("mixed").join(bits, ["key", "content"]).select("id", "tag", "start", "bits")
    return whole.unionByName(part)


def _bits(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["key", "content", "bits"])


def without_repeats(docs: DataFrame, width: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, spans (removed runs of words, from and behind) and kept_text of every document.

    A word goes if a window of ``width`` words of its document that covers it also starts anywhere else,
    in this document or another; windows are judged on the input. Kept words are joined by one space.
    A null or empty text has no words; texts shorter than a window stay whole; a repeated row is another
    occurrence; an empty table gives no rows. Columns besides doc_id and text are not read.
    """
    tag = F.xxhash64("doc_id", "text")
    docs = docs.select("doc_id", F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("id"), tag.alias("tag"), "text")
    hits = repeated_windows(docs.select("id", "tag", "text"), width)
    hits = hits.groupBy("id", "tag").agg(F.collect_list(F.struct("start", "bits")).alias("hits"))

    def finish(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = binary(part.column("text"))
        words = Words(texts)
        raw = words.buffer.tobytes()
        rows: list[tuple] = []
        for k, hits in enumerate(part.column("hits").to_pylist()):
            at, n = int(words.at[k]), int(words.counts[k])
            if not hits:
                rows.append((n, 0, [], b" ".join(texts[k].split())))
                continue
            cover = np.zeros(n + 1, np.int64)
            for hit in hits:
                here = hit["start"] + np.flatnonzero(hit["bits"] >> np.arange(width) & 1)
                np.add.at(cover, here, 1)
                np.add.at(cover, here + width, -1)
            gone = np.cumsum(cover[:n]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            spans = edges.reshape(-1, 2)
            kept = np.concatenate([[0], spans.ravel(), [n]]).reshape(-1, 2).tolist()
            runs = [raw[words.starts[at + a] : words.ends[at + b - 1]] for a, b in kept if b > a]
            rows.append((n, int(gone.sum()), spans.tolist(), b" ".join(x for run in runs for x in run.split())))
        types = [pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int32())), pa.binary()]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        columns[3] = columns[3].cast(pa.string())
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", "n_words", "n_removed", "spans", "kept_text"])

    joined = docs.join(hits, ["id", "tag"], "left").select("doc_id", "text", "hits")
    return joined.mapInArrow(each_slice(finish), "doc_id bigint, n_words bigint, n_removed bigint, spans array<array<int>>, kept_text string")
