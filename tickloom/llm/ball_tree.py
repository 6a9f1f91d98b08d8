"""Ranked lexical search: exact inner products of sparse integer vectors, pruned by ball trees."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.common import binary, bounds, each_slice, ragged, slices, staged
from tickloom.llm.words import LOWER, HashIndex, span_hashes

#: Items are searched in blocks of so many bytes of text (one longer item is a block of its own).
BLOCK_BYTES = 4 << 20
#: Documents, and vector entries, of a tree; documents of a leaf; queries and columns that are bounded at a time.
TREE_ROWS, TREE_ENTRIES, LEAF = 4096, 1 << 21, 32
QUERIES, COLUMNS = 256, 1024
VECTORS = "doc_id bigint, n bigint, terms binary, tf binary"
FOUND = "item int, doc_id bigint, score bigint"

#: Characters of a term: ASCII letters and digits, and all beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """The buffer of all texts in lower case, starts and ends of their terms, and the terms before each text."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    dark = np.concatenate([[False], _TERM[raw]])
    edges = np.flatnonzero(dark[1:] != dark[:-1])
    firsts = bounds(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return LOWER[raw], edges[::2], edges[1::2], np.searchsorted(edges[::2], firsts)


class Vocabulary:
    """Terms of a block of items; a hit in the hash table is compared byte by byte."""

    def __init__(self, terms: list[bytes]):
        self.size = len(terms)
        self.lengths = np.fromiter(map(len, terms), np.int64, len(terms))
        self.starts = bounds(self.lengths)[:-1]
        self.buffer = np.frombuffer(b"".join(terms), np.uint8)
        hashes = span_hashes(self.buffer, self.starts, self.starts + self.lengths)
        if len(np.unique(hashes)) < self.size:
            raise ValueError("two terms of a block share a 64-bit hash")
        self.index = HashIndex()
        self.index.add(hashes)

    def find(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of each term, -1 where it is unknown."""
        out = self.index.find(span_hashes(buffer, starts, ends))
        at = np.flatnonzero(out >= 0)
        same = (ends - starts)[at] == self.lengths[out[at]]
        out[at[~same]] = -1
        at = at[same]
        if len(at):
            n = (ends - starts)[at]
            wrong = buffer[ragged(starts[at], n)] != self.buffer[ragged(self.starts[out[at]], n)]
            out[at[np.add.reduceat(wrong, bounds(n)[:-1]) > 0]] = -1
        return out


def vectors(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Documents with terms: their number of terms, and the vocabulary's terms that they hold with counts (int32 arrays)."""

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        buffer, starts, ends, at = terms_of(binary(part.column("text")))
        n = np.diff(at)
        place = vocabulary.find(buffer, starts, ends)
        known = np.flatnonzero(place >= 0)
        doc = np.repeat(np.arange(len(n)), n)[known]
        keys, counts = np.unique(doc * max(1, vocabulary.size) + place[known], return_counts=True)
        cuts = (np.searchsorted(keys, np.arange(len(n) + 1) * max(1, vocabulary.size)) * 4).tolist()
        term, tf = ((keys % max(1, vocabulary.size)).astype("<i4").tobytes(), counts.astype("<i4").tobytes())
        arrays = [part.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64())]
        arrays += [pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()) for raw in (term, tf)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "terms", "tf"])

    return docs.select("doc_id", "text").mapInArrow(each_slice(make), VECTORS).where("n > 0")


def document_counts(rows: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each of the ``size`` terms; a task hands on one row a term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<i4"), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["term", "n"])

    out = np.zeros(size, np.int64)
    for r in rows.select("terms").mapInArrow(count, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n
    return out


class Sparse:
    """Rows of integer vectors, none of them empty, in one array each for columns and values."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray):
        self.starts, self.columns, self.values = starts, columns, values  # starts has one entry more than there are rows

    def __len__(self) -> int:
        return len(self.starts) - 1

    def take(self, rows: np.ndarray) -> Sparse:
        n = self.starts[rows + 1] - self.starts[rows]
        at = ragged(self.starts[rows], n)
        return Sparse(bounds(n), self.columns[at], self.values[at])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(dense[self.columns] * self.values, self.starts[:-1])


class BallTree:
    """Nodes over sparse rows: each with the mean of its rows and a radius that holds them all.

    A node is halved between two far rows until a leaf is reached, so equal rows end in leaves of radius
    about 0. Node k has the children ``children[k]`` or, if that is None, the rows ``spans[k]`` of ``rows``.
    """

    def __init__(self, rows: Sparse, width: int, leaf: int = LEAF):
        self.width, self.children, self.spans = width, [], []
        self.radius, self._columns, self._means = [], [], []
        order: list[np.ndarray] = []
        squares = np.add.reduceat(rows.values.astype(np.float64) ** 2, rows.starts[:-1])
        self._end = 0

        def build(here: np.ndarray) -> int:
            k = len(self.spans)
            part, square = rows.take(here), squares[here]
            mean = np.bincount(part.columns, part.values, width) / len(here)
            distance = square - 2 * part.dot(mean) + float(mean @ mean)
            # What rounding may hide of a squared distance is far below 1e-9 of the squares in it.
            self.radius.append(math.sqrt(max(0.0, float(distance.max())) + 1e-9 * (float(square.max()) + float(mean @ mean))))
            self._columns.append(np.flatnonzero(mean))
            self._means.append(mean[self._columns[-1]])
            self.spans.append((self._end, self._end + len(here)))
            self.children.append(None)
            if len(here) <= leaf:
                order.append(here)
                self._end += len(here)
                return k
            far = self._dense(part, int(distance.argmax()))
            other = self._dense(part, int((square - 2 * part.dot(far)).argmax()))
            ranked = here[np.argsort(part.dot(far - other), kind="stable")]
            half = len(here) // 2
            self.children[k] = (build(ranked[:half]), build(ranked[half:]))
            return k

        build(np.arange(len(rows)))
        self.order = np.concatenate(order)
        self.rows = rows.take(self.order)

    def _dense(self, part: Sparse, k: int) -> np.ndarray:
        out = np.zeros(self.width)
        at = slice(part.starts[k], part.starts[k + 1])
        out[part.columns[at]] = part.values[at]
        return out

    def limits(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """No row below a node has a larger inner product with a query: q c + r |q|, over the columns in use below it.

        Rows have no negative entry, so the columns of a node are those of its mean, and the others add nothing.
        """
        node = np.repeat(np.arange(len(self.spans)), [len(c) for c in self._columns])
        column, mean = np.concatenate(self._columns), np.concatenate(self._means)
        product, square = (np.zeros((len(self.spans), len(queries))) for _ in range(2))
        query = np.repeat(np.arange(len(queries)), [len(c) for c, _ in queries])
        asked, weight = (np.concatenate([q[k] for q in queries]) for k in range(2))
        used = np.unique(asked)
        for a in range(0, len(used), COLUMNS):
            own = used[a : a + COLUMNS]
            place = np.full(self.width, -1)
            place[own] = np.arange(len(own))
            there, wanted = place[column] >= 0, place[asked] >= 0
            c, q = np.zeros((len(self.spans), len(own))), np.zeros((len(own), len(queries)))
            c[node[there], place[column[there]]] = mean[there]
            q[place[asked[wanted]], query[wanted]] = weight[wanted]
            product += c @ q
            square += (c > 0) @ (q * q)
        return (product + np.array(self.radius)[:, None] * np.sqrt(square)) * (1 + 1e-9) + 1

    def search(self, bound: list[float], weights: np.ndarray, best: Best) -> int:
        """Score leaves in the order of their bounds until none can reach the ranking; the leaves that were scored."""
        heap, leaves = [(-bound[0], 0)], 0
        while heap and -heap[0][0] >= best.least:
            above, k = heapq.heappop(heap)
            if self.children[k]:
                for child in self.children[k]:
                    heapq.heappush(heap, (max(above, -bound[child]), child))
                continue
            leaves += 1
            a, b = self.spans[k]
            at = slice(self.rows.starts[a], self.rows.starts[b])
            scores = np.add.reduceat(weights[self.rows.columns[at]] * self.rows.values[at], self.rows.starts[a:b] - self.rows.starts[a])
            hits = np.flatnonzero(scores >= best.least)
            if len(hits):
                best.add(scores[hits], self.order[a + hits])
        return leaves


class Best:
    """The highest scores of an item so far, equal ones by document number (null last); ``least`` is what a new one must reach."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)
        self.source: tuple = ()

    def of(self, ids: np.ndarray, null: np.ndarray) -> Best:
        self.source = (ids, null)
        return self

    def add(self, scores: np.ndarray, rows: np.ndarray) -> None:
        ids, null = self.source
        scores = np.concatenate([self.scores, scores])
        ids, null = np.concatenate([self.ids, ids[rows]]), np.concatenate([self.null, null[rows]])
        keep = np.lexsort((ids, null, -scores))[: self.k]
        self.scores, self.ids, self.null = scores[keep], ids[keep], null[keep]
        if len(keep) == self.k:
            self.least = int(self.scores[-1])


def search(rows: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], width: int, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The ``k`` best rows of every task for each query; a task builds trees over its rows, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        held: list[pa.RecordBatch] = []
        size = entries = 0
        for batch in chain.from_iterable(slices(x, "terms") for x in batches):
            for a in range(0, batch.num_rows, TREE_ROWS // 4):
                part = batch.slice(a, TREE_ROWS // 4)
                held.append(part)
                size, entries = size + part.num_rows, entries + sum(map(len, part.column("terms").to_pylist())) // 4
                if size >= TREE_ROWS or entries >= TREE_ENTRIES:
                    one_tree(held, best)
                    held, size, entries = [], 0, 0
        if held:
            one_tree(held, best)
        at = [i for i, b in enumerate(best) for _ in b.ids]
        if at:
            ids, null, scores = (np.concatenate([getattr(b, c) for b in best]) for c in ("ids", "null", "scores"))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(ids, mask=null), pa.array(scores)], names=["item", "doc_id", "score"])

    def one_tree(held: list[pa.RecordBatch], best: list[Best]) -> None:
        table = pa.Table.from_batches(held)
        raw, counts = table.column("terms").to_pylist(), table.column("tf").to_pylist()
        lengths = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        column = np.frombuffer(b"".join(raw), "<i4").astype(np.int64)
        tf = np.frombuffer(b"".join(counts), "<i4").astype(np.int64)
        m = 100 - 50 + (50 * np.asarray(table.column("n")) * n_docs) // n_terms
        values = (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, lengths))
        used = lengths > 0
        if not used.any():
            return
        ids = table.column("doc_id").combine_chunks()
        null, ids = np.asarray(ids.is_null())[used], np.asarray(ids.fill_null(0))[used]
        tree = BallTree(Sparse(bounds(lengths[used]), column, values), width)
        weights = np.zeros(width, np.int64)
        for a in range(0, len(queries), QUERIES):
            limit = tree.limits(queries[a : a + QUERIES]).T.tolist()
            for q, (own, w) in enumerate(queries[a : a + QUERIES]):
                weights[own] = w
                tree.search(limit[q], weights, best[a + q].of(ids, null))
                weights[own] = 0
        for b in best:
            b.source = ()

    return rows.mapInArrow(run, FOUND)


def ranked(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` documents of ``docs`` (doc_id, text) with the highest scores above 0 for each row of ``items`` (item_id, text).

    Returns item_id, rank (from 1), doc_id and score: the exact integer BM25 of the whole texts. Equal
    scores go by ascending doc_id, null last; rows that share a doc_id or a text are ranked each for
    itself, and so are items that share an item_id. Null and empty texts have no terms: such documents and
    items give no rows, nor do empty tables. Other columns are not read.

    Items are taken in blocks of BLOCK_BYTES of text, whose terms and weights go to the tasks; a block costs
    a pass over the documents. Documents become vectors over the block's terms, which loses nothing of
    a score. Each task builds ball trees over 4096 vectors at a time, whatever keys or copies they hold, and
    keeps ``k`` results an item.
    """
    found = [_block(docs, block, k) for block in _blocks(items)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    block, size = [], 0
    for r in items.select("item_id", "text").where(F.col("text").rlike(TERM)).toLocalIterator():
        text = r.text.encode()
        if block and size + len(text) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((r.item_id, text))
        size += len(text)
    if block:
        yield block


def _block(docs: DataFrame, block: list[tuple[int, bytes]], k: int) -> DataFrame:
    spark = docs.sparkSession
    buffer, starts, ends, at = terms_of([t for _, t in block])
    raw = buffer.tobytes()
    words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    own = [sorted(set(words[a:b])) for a, b in zip(at[:-1], at[1:])]  # none is empty
    terms = sorted(set(words))
    number = {t: i for i, t in enumerate(terms)}
    rows = staged(vectors(docs, Vocabulary(terms)))
    n_docs, n_terms = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = document_counts(rows, len(terms))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in counts.tolist()], np.int64)
    asked = [np.array([number[t] for t in ts], np.int64) for ts in own]
    best = search(rows, [(c, weight[c]) for c in asked], len(terms), max(1, n_docs), max(1, n_terms), k)
    best = staged(best)  # a few rows an item and task
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salt = F.pmod(F.xxhash64("doc_id", "score"), F.lit(16))
    for keys in (["item", salt], ["item"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    names = spark.createDataFrame([(q, item_id) for q, (item_id, _) in enumerate(block)], "item int, item_id bigint")
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


ORACLE = rf"""WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{TERM}+') AS ts FROM documents WHERE text IS NOT NULL),
d AS (SELECT * FROM t WHERE len(ts) > 0),
s AS (SELECT count(*) AS n, sum(len(ts))::BIGINT AS l FROM d),
f AS (SELECT r, doc_id, 100 - 50 + (50 * len(ts) * s.n) // s.l AS m, ts FROM d, s),
p AS (SELECT r, doc_id, m, term, count(*) AS tf FROM (SELECT r, doc_id, m, unnest(ts) AS term FROM f) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(s.n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term),
i AS (
  SELECT item, item_id, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{TERM}+'))) AS term
  FROM (SELECT row_number() OVER () AS item, * FROM benchmark)),
x AS (
  SELECT item, item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM i JOIN p USING (term) JOIN w USING (term) GROUP BY item, item_id, r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 50"""
