"""Approximate nearest neighbours by cross-polytope hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import staged


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows (a power of two wide), without scaling."""
    rows, n = x.shape
    width = 1
    while width < n:
        x = x.reshape(rows, -1, 2, width)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(rows, n)
        width *= 2
    return x


#: Rows of a bucket, roughly.
PER_BUCKET = 5.0


class CrossPolytope:
    """Hash tables of unit vectors. A hash turns the vector by three rounds of random signs and a Hadamard
    transform and takes the nearest signed axis; a table joins several, the last over fewer axes, so that
    the number of buckets follows the number of vectors.
    """

    def __init__(self, dims: int, rows: int, tables: int, per_bucket: float = PER_BUCKET, seed: int = 5):
        self.dims, self.tables = dims, tables
        self.width = max(2, 1 << (dims - 1).bit_length())
        self.axes: list[int] = []
        left = rows / per_bucket
        while left >= 2:
            self.axes.append(int(min(self.width, max(1, round(left / 2)))))
            left /= 2 * self.axes[-1]
        self.signs = np.random.default_rng(seed).choice(np.array([-1, 1], np.float32), (tables, max(1, len(self.axes)), 3, self.width))

    def _axes(self, x: np.ndarray, table: int, k: int) -> np.ndarray:
        """Nearness of each vector to each signed axis of hash ``k``: all plus axes, then all minus axes."""
        for signs in self.signs[table, k]:
            x = hadamard(x * signs)
        x = x / np.float32(self.width**1.5)
        x = x[:, : self.axes[k]]
        return np.concatenate([x, -x], 1)

    def _unit(self, vectors: np.ndarray) -> np.ndarray:
        x = np.zeros((len(vectors), self.width), np.float32)
        x[:, : self.dims] = vectors / np.abs(vectors).max(1, keepdims=True)  # first, so that no square is lost
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        return x

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """Bucket of each vector in each table."""
        x, out = self._unit(vectors), np.zeros((len(vectors), self.tables), np.int64)
        for table in range(self.tables):
            bucket = np.zeros(len(x), np.int64)
            for k, axes in enumerate(self.axes):
                bucket = bucket * (2 * axes) + self._axes(x, table, k).argmax(1)
            out[:, table] = bucket * self.tables + table
        return out

    def probes(self, vectors: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` likeliest buckets of each vector in each table.

        An axis that is less near than the nearest by a gap g is the likelier the smaller g * g; the
        sums over the hashes of a table are searched hash by hash, keeping the best ``count``.
        """
        x, out = self._unit(vectors), []
        for table in range(self.tables):
            bucket, cost = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
            for k, axes in enumerate(self.axes):
                near = self._axes(x, table, k)
                most = min(2 * axes, count)
                best = np.argsort(-near, axis=1, kind="stable")[:, :most]
                gaps = (near.max(1, keepdims=True) - np.take_along_axis(near, best, 1)) ** 2
                bucket = (bucket[:, :, None] * (2 * axes) + best[:, None, :]).reshape(len(x), -1)
                cost = (cost[:, :, None] + gaps[:, None, :]).reshape(len(x), -1)
                keep = np.argsort(cost, axis=1, kind="stable")[:, :count]
                bucket, cost = np.take_along_axis(bucket, keep, 1), np.take_along_axis(cost, keep, 1)
            out.append(bucket * self.tables + table)
        return np.concatenate(out, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def valid(column: str) -> Column:
    """Vectors that are not null, hold only finite numbers and are not zero."""
    x = F.col(column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(x.isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def coded(x: np.ndarray) -> list[bytes]:
    """A byte for each component, behind the step that one unit stands for and the distance of the vector to its code."""
    step = (np.abs(x).max(1, initial=0) / 127).astype("<f8")
    units = np.rint(x / step[:, None]).astype(np.int8)
    off = np.sqrt(((x - units * step[:, None]) ** 2).sum(1)).astype("<f8")
    return [a.tobytes() + b.tobytes() + c.tobytes() for a, b, c in zip(step, off, units)]


def decoded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The vectors that the codes stand for, and how far off these are."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    head = raw[:, :16].copy().view("<f8")
    return raw[:, 16:].view(np.int8) * head[:, :1], head[:, 1]


#: Norms of a band differ by a tenth at most.
BAND = math.log(1.1)


def log_norms(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(1, initial=0)
    return np.log(largest) + np.log(np.linalg.norm(vectors / largest[:, None], axis=1))


def bands(vectors: np.ndarray) -> np.ndarray:
    """Band of norms of each vector; the norm 1 lies in the middle of one."""
    return np.floor(log_norms(vectors) / BAND + 0.5).astype(np.int64)


class Bands:
    """A cross-polytope index for each band of norms, in which nearness is a matter of direction alone.

    ``sizes`` holds the rows of each band. Doubles have fewer than 15,000 bands, whatever the table.
    """

    #: Tail of the normal distribution at -12, ..., 12.
    STEPS = np.linspace(-12, 12, 4801)
    TAIL = np.array([math.erfc(x / math.sqrt(2)) / 2 for x in STEPS])

    def __init__(self, dims: int, sizes: dict[int, int], tables: int, rate: float, power: float):
        self.names = np.array(sorted(sizes), np.int64)
        self.sizes = np.array([sizes[b] for b in self.names.tolist()], np.float64)
        self.dims, self.rate, self.power = dims, rate, power
        self.indexes = [CrossPolytope(dims, int(n), tables) for n in self.sizes]

    def _keys(self, buckets: np.ndarray, band: int) -> np.ndarray:
        return (buckets * np.int64(1 << 15)) + np.int64(band + (1 << 14))

    def buckets(self, vectors: np.ndarray) -> list[np.ndarray]:
        out: list = [None] * len(vectors)
        own = bands(vectors)
        for name, index in zip(self.names.tolist(), self.indexes):
            at = np.flatnonzero(own == name)
            if len(at):
                for k, keys in zip(at, self._keys(index.buckets(vectors[at]), name)):
                    out[k] = keys
        return out

    def shares(self, logs: np.ndarray, k: int) -> np.ndarray:
        """For each query (the logarithm of its norm) and band the share of the band that ``k`` neighbours would take if directions were spread evenly.

        The cosines of even directions are nearly normal; the distance within which ``k`` rows are expected is
        found by halving, and a band's share is the tail of cosines that come within it.
        """
        q, deviation = np.ones((len(logs), 1)), 1 / math.sqrt(self.dims)
        places = (self.names + np.array([[-0.5], [-0.25], [0], [0.25], [0.5]])) * BAND
        edges = np.exp(np.clip(places[:, None, :] - logs[:, None], -300, 300))  # in units of the query's norm

        def tails(limit: np.ndarray) -> np.ndarray:
            """Share by query and band within the distance, over the norms of the band."""
            with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
                cosine = (q / edges + edges / q - limit**2 / (q * edges)) / 2
                share = np.interp(np.clip(np.nan_to_num(cosine, nan=12, posinf=12, neginf=-12) / deviation, -12, 12), self.STEPS, self.TAIL)
            return np.where(cosine > 1, 0, share)

        low, high = np.zeros_like(q), q + edges[-1].max(1, keepdims=True)
        for _ in range(50):
            middle = (low + high) / 2
            enough = (tails(middle).mean(0) * self.sizes).sum(1, keepdims=True) >= k
            low, high = np.where(enough, low, middle), np.where(enough, middle, high)
        return tails(high).max(0)

    def probes(self, vectors: np.ndarray, k: int) -> list[np.ndarray]:
        """Keys that each query looks up.

        Where a band's share is k of n rows, it is searched as hard as an evenly spread table of n rows: in each
        table ``rate`` * n ** ``power`` of its n / PER_BUCKET buckets, and never less hard than the whole table is.
        """
        total, logs, some = self.sizes.sum(), log_norms(vectors), max(1, 100_000 // len(self.names))
        shares = np.concatenate([self.shares(logs[a : a + some], k) for a in range(0, len(logs), some)])
        alike = np.clip(k / np.maximum(shares, 1e-300), 1, max(total, 1))
        parts = np.minimum(self.rate * alike**self.power / (alike / PER_BUCKET), 1)
        out: list[list[np.ndarray]] = [[] for _ in vectors]
        for b, (name, index) in enumerate(zip(self.names.tolist(), self.indexes)):
            buckets = math.prod(2 * a for a in index.axes)
            wanted = np.clip(np.ceil(parts[:, b] * buckets), 1, buckets).astype(np.int64)
            order = np.argsort(wanted, kind="stable")
            for at in np.array_split(order, max(1, min(8, len(order)))):
                if len(at):
                    most = int(wanted[at].max())
                    for q, keys in zip(at, self._keys(index.probes(vectors[at], most), name)):
                        out[q].append(keys)
        return [np.concatenate(x) for x in out]


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    tables: int = 16,
    probe_rate: float = 0.6,
    probe_power: float = 0.45,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance in double precision) of the ``k`` nearest found.

    ``queries`` marks the query rows; candidates are all other rows. Rows are parted into bands of norms, and every row is
    indexed in ``tables`` tables of its band of some five rows a bucket. A query probes all bands, each as hard as
    its norm makes neighbours likely there (``Bands.probes``): where all norms agree ``probe_rate`` * rows ** ``probe_power``
    buckets a table, so its candidates grow more slowly than the rows. Index and probes carry a byte for each
    component and the distance between vector and code, which bounds the true distance of a pair from both
    sides; all pairs that may be among the ``k`` nearest by these bounds are compared on the original vectors. Of equal
    vectors only the k + 1 smallest ids can be among the nearest, so the others are left out before
    hashing: a vector may be as frequent as it likes. Ties go to the smaller id. Vectors that are null,
    empty, zero, hold null or non-finite components, or have another length than most of the table take
    no part, nor do null ids; a repeated id counts once, with its smallest vector.
    """
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector).alias("v"), queries.alias("q")).where(F.col("vec_id").isNotNull() & valid("v"))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.where(F.size("v") == lengths.d)
    rows = staged(rows.withColumn("n", F.row_number().over(Window.partitionBy("vec_id").orderBy("v"))).where("n = 1").drop("n"))

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(bands(_matrix(batch.column("v"))))], names=["band"])

    sizes = rows.select("v").mapInArrow(banded, "band bigint").groupBy("band").agg(F.count("*").alias("n")).collect()
    index = Bands(lengths.d, {r.band: r.n for r in sizes}, tables, probe_rate, probe_power)

    def hashed(name: str, keys_of) -> object:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 1000):
                    part = batch.slice(a, 1000)
                    x = _matrix(part.column("v"))
                    keys = pa.array(keys_of(x), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([part.column("vec_id"), keys, pa.array(coded(x), pa.binary())], names=[name, "keys", f"{name}_code"])

        return run

    rank = Window.partitionBy("v").orderBy("vec_id")
    indexed = rows.withColumn("n", F.row_number().over(rank)).where(F.col("n") <= k + 1).select("vec_id", "v")
    table = indexed.mapInArrow(hashed("vec_id", index.buckets), "vec_id bigint, keys array<bigint>, vec_id_code binary")
    asked = rows.where("q").select("vec_id", "v").mapInArrow(hashed("query_id", lambda x: index.probes(x, k)), "query_id bigint, keys array<bigint>, query_id_code binary")
    met = asked.withColumn("key", F.explode("keys")).drop("keys").join(table.withColumn("key", F.explode("keys")).drop("keys"), "key").where("query_id <> vec_id")

    def roughly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                (a, off_a), (b, off_b) = decoded(batch.column("query_id_code")), decoded(batch.column("vec_id_code"))
                gap = np.sqrt(((a - b) ** 2).sum(1))
                off = (off_a + off_b) * (1 + 1e-9) + 1e-12 * (np.abs(a).sum(1) + np.abs(b).sum(1))  # rounding included
                columns = [batch.column("query_id"), batch.column("vec_id"), pa.array(gap - off), pa.array(gap + off)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "least", "most"])

    rough = met.select("query_id", "vec_id", "query_id_code", "vec_id_code").mapInArrow(roughly, "query_id bigint, vec_id bigint, least double, most double")
    near = Window.partitionBy("query_id").orderBy("most").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limit = F.nth_value("most", k).over(near)  # null where fewer were found
    pairs = rough.groupBy("query_id", "vec_id").agg(F.min("least").alias("least"), F.min("most").alias("most")).withColumn("limit", limit).where(F.col("limit").isNull() | (F.col("least") <= F.col("limit")))
    others = rows.select("vec_id", F.col("v").alias("b"))
    both = pairs.select("query_id", "vec_id").join(others, "vec_id").join(rows.where("q").select(F.col("vec_id").alias("query_id"), F.col("v").alias("a")), "query_id")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                gap = _matrix(batch.column("a")) - _matrix(batch.column("b"))
                yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("vec_id"), pa.array(np.sqrt((gap * gap).sum(1)))], names=["query_id", "vec_id", "score"])

    scored = both.select("query_id", "vec_id", "a", "b").mapInArrow(compared, "query_id bigint, vec_id bigint, score double")
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
