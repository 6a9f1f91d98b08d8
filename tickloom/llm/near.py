"""N-gram Jaccard join by a MinHash LSH forest with exact verification."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import binary, each_slice, fresh, mixed, ragged, rolled, staged
from tickloom.llm.words import Words

#: Members of a bucket that are compared in one unit of work; larger buckets are compared block by block.
BLOCK = 256


def prefix_length(threshold: float, trees: int, recall: float, longest: int = 12) -> int:
    """Depth at which the forest is read: prefixes are shortened until a pair at the threshold shares one in
    some tree with probability ``recall``; more similar pairs are then met more surely still."""
    depth = longest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``n`` words of each text, one after the other, and how many each text has.

    A text of 1 to n - 1 words is one shingle.
    """
    words = Words(texts)
    hashes, counts = words.hashes(), words.counts
    grams = rolled(hashes, n)
    short = np.flatnonzero((counts > 0) & (counts < n))
    whole = [int(rolled(hashes[words.at[k] : words.at[k + 1]], int(counts[k]))[0]) for k in short]
    starts = words.at[:-1].copy()
    starts[short] = len(grams) + np.arange(len(short))
    sizes = np.where(counts < n, np.minimum(counts, 1), counts - n + 1)
    return np.concatenate([grams, np.array(whole, np.uint64)])[ragged(starts, sizes)], sizes


class Forest:
    """Prefixes of MinHash signatures, one for each tree."""

    def __init__(self, threshold: float, trees: int, recall: float, n: int, seed: int = 3):
        self.trees, self.n, self.depth = trees, n, prefix_length(threshold, trees, recall)
        self.factors = np.random.default_rng(seed).integers(1 << 62, 1 << 63, trees * self.depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sketch(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """Distinct shingles of each text, two hashes of the set, and the prefix of each tree."""
        flat, sizes = shingles(texts, self.n)
        some = np.flatnonzero(sizes)
        size, one, two = (np.zeros(len(texts), t) for t in (np.int64, np.uint64, np.uint64))
        keys = np.zeros((len(texts), self.trees), np.uint64)
        if not len(some):
            return size, one, two, keys
        ends = np.cumsum(sizes)
        for k in some:
            distinct = np.unique(flat[ends[k] - sizes[k] : ends[k]])
            size[k], one[k], two[k] = len(distinct), mixed(distinct).sum(), mixed(distinct ^ np.uint64(0x5BD1E995)).sum()
        starts = (ends - sizes)[some]
        for tree in range(self.trees):
            key = np.full(len(some), tree + 1, np.uint64)
            for factor in self.factors[tree * self.depth : (tree + 1) * self.depth]:
                least = np.minimum.reduceat((flat * factor) >> np.uint64(32), starts)
                key = mixed(key * np.uint64(0x100000001B3) + least)
            keys[some, tree] = key
        return size, one, two, keys


def runs(batches: Iterator[pa.RecordBatch], arrays: Callable[[pa.RecordBatch], list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """Arrays of each run of equal first values in a sorted stream; a run may span batches."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = arrays(batch)
        if rest is not None:
            now = [np.concatenate([a, b]) for a, b in zip(rest, now)]
        edges = [0, *(np.flatnonzero(now[0][1:] != now[0][:-1]) + 1).tolist()]
        for a, b in zip(edges, edges[1:]):
            yield [x[a:b] for x in now]
        rest = [x[edges[-1] :] for x in now]
    if rest is not None:
        yield rest


def _long(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [np.asarray(batch.column(c), np.int64) for c in names]


def _objects(column: pa.Array) -> np.ndarray:
    out = np.empty(len(column), object)
    out[:] = column.to_pylist()
    return out


def common_counts(sets: list[np.ndarray], wanted: np.ndarray) -> np.ndarray:
    """How many values each wanted pair of sorted sets shares (exactly)."""
    m = len(sets)
    out = np.zeros((m, m), np.int64)
    if m <= 8:
        for i, j in zip(*np.nonzero(wanted)):
            a, b = (sets[i], sets[j]) if len(sets[i]) < len(sets[j]) else (sets[j], sets[i])
            at = np.searchsorted(b, a)
            at[at == len(b)] = 0
            out[i, j] = int((b[at] == a).sum())
        return out
    owner = np.repeat(np.arange(m), [len(x) for x in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[column] > 1  # a shingle of one set is common to none
    owner, column = owner[keep], (np.cumsum(count > 1) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        x = np.zeros((m, width), np.float32)
        x[owner[a:b], column[a:b] - start] = 1
        out += (x @ x.T).astype(np.int64)
    return out


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node of its connected part) of all nodes of ``edges`` (a, b).

    Labels spread to neighbours and then jump to their label's label, so rounds grow with the logarithm of
    the longest path. A round is joins and minima over tables; only the count of changes is collected.
    """
    both = staged(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        told = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("told"))
        near = labels.join(told, F.col("node") == F.col("a")).select("node", "label", F.least("label", "told").alias("next"))
        jump = labels.select(F.col("node").alias("of"), F.col("label").alias("jumped"))
        after = staged(near.join(jump, F.col("next") == F.col("of")).select("node", F.least("next", "jumped").alias("fresh"), "label"))
        changed = after.where("fresh <> label").count()
        labels = after.select("node", F.col("fresh").alias("label"))
        if not changed:
            return labels


def near_classes(
    docs: DataFrame, threshold: float = 0.8, n: int = 5, trees: int = 32, recall: float = 0.9999
) -> DataFrame:
    """doc_id, class_id, n_links, n_shingles and stays (the row whose id the class has) of every document of ``docs`` (doc_id, text).

    Two documents are linked when the Jaccard similarity of their sets of ``n``-word shingles is
    ``threshold`` at least, verified on the sets. n_links counts linked other documents, copies included.
    A class is what links connect; its id is its smallest doc_id. Documents with the same set are one
    node, so copies are counted, not paired. The forest's prefixes are short enough that a pair at the
    threshold is met with probability ``recall``; all members of a bucket are compared, a large bucket
    in blocks of bounded size, and a pair only in the first tree in which it meets. Pairs are summed up
    where they are compared: what leaves a task is a count and one edge for each member.

    A null or empty text has no shingles, no links and is a class of its own; a text below ``n`` words is
    one shingle. Repeated rows are copies; a null doc_id is the class id only if all ids of the class are
    null. An empty table gives no rows.
    """
    forest = Forest(threshold, trees, recall, n)
    docs = docs.select("doc_id", F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("id"), F.xxhash64("doc_id", "text").alias("tag"), "text")

    def sketched(part: pa.RecordBatch) -> pa.RecordBatch:
        size, one, two, keys = forest.sketch(binary(part.column("text")))
        columns = [*part.select(["doc_id", "id", "tag"]).columns, pa.array(size), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))]
        keys = pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).ravel()), trees).cast(pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([*columns, keys], names=["doc_id", "id", "tag", "size", "one", "two", "keys"])

    schema = "doc_id bigint, id bigint, tag bigint, size bigint, one bigint, two bigint, keys array<bigint>"
    sketches = staged(docs.mapInArrow(each_slice(sketched), schema).withColumn("row", F.monotonically_increasing_id()))
    sets = sketches.where("size > 0").groupBy("one", "two").agg(F.count("*").alias("copies"), F.min("doc_id").alias("low"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "id", "tag", "row", "size", "keys")).alias("r"))
    sets = staged(sets.select(F.monotonically_increasing_id().alias("set"), "one", "two", "copies", "low", "r.id", "r.tag", "r.row", "r.size", "r.keys"))

    leaves = sets.select("set", F.posexplode("keys").alias("tree", "key"))
    filled = leaves.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    members = leaves.join(filled, "key").withColumn("block", F.pmod(F.xxhash64("set"), blocks).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    members = members.withColumns({"from": F.least("block", "other"), "to": F.greatest("block", "other")})
    members = members.select(F.xxhash64("key", "from", "to").alias("unit"), "tree", "set", "block", (F.col("from") == F.col("to")).alias("own"))
    units = members.join(sets.select("set", "id", "tag", "size", "keys"), "set")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
            keys = np.asarray(batch.column("keys").flatten(), np.int64).reshape(batch.num_rows, trees)
            return [*_long(batch, "unit", "tree", "set", "block", "own", "id", "tag", "size"), keys]

        rows: list[tuple] = []
        for unit, tree, number, block, own, ids, tags, size, keys in runs(batches, arrays):
            m = len(unit)
            if m < 2:
                continue
            met = keys[:, None, :] == keys[None, :, :]
            first = met[:, :, tree[0]] & (met.argmax(2) == tree[0])
            first &= np.minimum.outer(size, size) >= threshold * np.maximum.outer(size, size) - 1e-9
            first &= np.triu(np.ones((m, m), bool), 1) if own[0] else block[:, None] < block[None, :]
            for k in np.flatnonzero(first.any(0) | first.any(1)):
                rows.append((unit[k], k, number[k], ids[k], tags[k], np.packbits(first[k]).tobytes()))
            if len(rows) > 5000:
                yield _rows(rows, CANDIDATES)
                rows = []
        if rows:
            yield _rows(rows, CANDIDATES)

    pairs = units.repartition("unit").sortWithinPartitions("unit", "set").mapInArrow(candidates, "unit bigint, k bigint, set bigint, id bigint, tag bigint, bits binary")
    texts = staged(pairs).join(docs.select("id", "tag", "text"), ["id", "tag"])
    texts = texts.select("unit", "k", "set", "bits", "text").join(sets.select("set", "copies"), "set")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
            return [*_long(batch, "unit", "k", "set", "copies"), _objects(batch.column("bits")), _objects(batch.column("text"))]

        rows: list[tuple] = []
        for _, place, number, copies, bits, text in runs(batches, arrays):
            _, once = np.unique(place, return_index=True)  # rows that are repeated in the table come several times
            place, number, copies, bits, text = (x[once] for x in (place, number, copies, bits, text))
            flat, sizes = shingles([x.encode() for x in text], n)
            ends = np.cumsum(sizes)
            found = [np.unique(flat[b - s : b]) for b, s in zip(ends, sizes)]
            wanted = np.stack([np.unpackbits(np.frombuffer(x, np.uint8), count=8 * len(bits[0]))[place] for x in bits]).astype(bool)
            common = common_counts(found, wanted)
            size = np.array([len(x) for x in found])
            linked = wanted & (common >= threshold * (np.add.outer(size, size) - common) - 1e-9)
            linked |= linked.T
            root = np.arange(len(size))
            while ((low := np.minimum(root, np.where(linked, root[None, :], len(size)).min(1))) != root).any():
                root = low
            links = linked @ copies
            rows += [(int(number[k]), int(links[k]), int(number[root[k]])) for k in np.flatnonzero(links)]
            if len(rows) > 5000:
                yield _rows(rows, LINKS)
                rows = []
        if rows:
            yield _rows(rows, LINKS)

    links = texts.repartition("unit").sortWithinPartitions("unit", "k").mapInArrow(verified, "set bigint, links bigint, root bigint")
    links = staged(links)
    parts = components(links.where("set <> root").select(F.col("set").alias("a"), F.col("root").alias("b")).distinct())
    sums = links.groupBy("set").agg(F.sum("links").alias("links"))
    named = sets.select("set", "one", "two", "copies", "low", F.col("row").alias("first")).join(parts.withColumnRenamed("node", "set"), "set", "left").withColumn("label", F.coalesce("label", "set"))
    lowest = named.groupBy("label").agg(F.min(F.struct(F.col("low").isNull().alias("none"), "low", "first")).alias("l"))
    named = named.join(lowest, "label").join(sums, "set", "left")
    named = named.select(F.col("one").alias("x"), F.col("two").alias("y"), F.col("l.low").alias("class_id"), F.col("l.first").alias("stays"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    joined = sketches.select("doc_id", "id", "tag", "size", "one", "two", "row").join(named, (F.col("one") == F.col("x")) & (F.col("two") == F.col("y")) & (F.col("size") > 0), "left")
    some = F.col("size") > 0
    return joined.select(
        "doc_id",
        F.when(some, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.col("size").alias("n_shingles"),
        F.when(some, F.col("row") == F.col("stays")).otherwise(True).alias("stays"),
        "id",
        "tag",
    )


def one_of_each_class(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay when of each class only the one with its id does, with all their columns.

    Of rows that agree in doc_id and text one stays, if any; texts without words all stay.
    """
    names = {c: fresh(c, docs) for c in ("id", "tag")}
    stay = near_classes(docs, **options).where("stays").select(F.col("id").alias(names["id"]), F.col("tag").alias(names["tag"]))
    named = docs.withColumns({names["id"]: F.coalesce("doc_id", F.lit(0)).cast("bigint"), names["tag"]: F.xxhash64("doc_id", "text")})
    key = [names["id"], names["tag"]]
    if not named.groupBy(*key).count().where("count > 1").isEmpty():
        named = named.dropDuplicates(key)
    return named.join(stay, key, "left_semi").select(*docs.columns)


CANDIDATES = (("unit", pa.int64()), ("k", pa.int64()), ("set", pa.int64()), ("id", pa.int64()), ("tag", pa.int64()), ("bits", pa.binary()))
LINKS = (("set", pa.int64()), ("links", pa.int64()), ("root", pa.int64()))


def _rows(rows: list[tuple], columns: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), columns)], names=[name for name, _ in columns])
