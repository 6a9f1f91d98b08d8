"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections import Counter
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import binary, crc_of_id, fresh, slices, staged

_EDGES = b".,;:!?\"'()[]{}<>|-_*"
#: Lengths in bytes of the word beginnings that are features besides the word itself.
BEGINNINGS = (4, 5, 6)


def word_features(word: bytes) -> list[int]:
    """Hashes of a lower-cased word without punctuation at its edges, and of its beginnings."""
    word = word.lower().strip(_EDGES)
    if not word:
        return []
    parts = [b"w" + word, *(b"p" + word[:n] for n in BEGINNINGS if len(word) > n)]
    return [xxhash.xxh3_64_intdigest(x) >> 1 for x in parts]


class Features(dict):
    """Columns of the model that a word switches on; words seen before are looked up."""

    def __init__(self, columns: dict[int, int], most: int = 100_000):
        self.columns, self.most = columns, most

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.clear()
        self[word] = found = tuple(self.columns[x] for x in word_features(word) if x in self.columns)
        return found

    def of(self, text: bytes) -> dict[int, float]:
        """log2(1 + how often), up to seven times, of each column that the text switches on."""
        often: dict[int, int] = {}
        for word, times in Counter(text.split()).items():
            for k in self[word]:
                often[k] = often.get(k, 0) + times
        return {k: log2(1 + min(n, 7)) for k, n in sorted(often.items())}


def nn_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, decay: float | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model that minimise the non-negative positive-unlabelled risk.

    The risk is prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)]). Where the second part, the
    estimate of the risk on negatives, falls below zero, its sign is turned: the step goes back from
    overfitting the unlabelled rows. ``decay`` of the weights is one over the positives unless given, so a
    prior of fixed strength gives way to evidence. Full-batch Adam from zero, so a run is repeatable.
    """
    decay = 1 / len(positive) if decay is None else decay
    positive, unlabelled = (x.astype(np.float32, copy=False) for x in (positive, unlabelled))
    w, b = np.zeros(positive.shape[1]), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)

    def sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    for k in range(1, steps + 1):
        small = w.astype(np.float32)  # as the matrices, which are not copied
        zp, zu = (positive @ small + b).astype(float), (unlabelled @ small + b).astype(float)
        pp, pu = sigmoid(zp), sigmoid(zu)
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp, gu = prior * (pp - 1) / len(pp), pu / len(pu)
        back = prior * pp / len(pp)
        if negative_risk >= 0:
            parts = ((positive, gp - back), (unlabelled, gu))
        else:
            parts = ((positive, back), (unlabelled, -gu))
        g = sum(np.append(x.T @ e.astype(np.float32), e.sum()) for x, e in parts)
        g[:-1] += decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


class Model:
    """Selected features, their weights and a bias; a few thousand numbers whatever the corpus holds."""

    def __init__(self, columns: dict[int, int], weights: np.ndarray, bias: float):
        self.columns, self.weights, self.bias = columns, weights, bias

    def scores(self, texts: list[bytes], features: Features) -> np.ndarray:
        z = [self.bias + sum(self.weights[k] * v for k, v in features.of(x).items()) for x in texts]
        return 1 / (1 + np.exp(-np.clip(np.array(z, float), -30, 30)))


def fit(
    docs: DataFrame, labels: DataFrame, positives: int = 4000, unlabelled: int = 12_000, strength: float = 6.0, least: int = 8, most: int = 1500
) -> Model:
    """Train on the rows whose crc32 of the id modulo 4 is not 2.

    Confirmed are the texts labelled toxic, at most about ``positives`` of them; unlabelled is a sample
    of about ``unlabelled`` texts of the corpus, whatever their label. Both are chosen by a hash of
    the id; these two bounds are the only ones. The class prior is the toxic share of the labelled
    training rows. Features are the ``most`` words and word beginnings whose shares in the two samples
    lie ``strength`` standard errors apart and that ``least`` confirmed texts hold. Without confirmed
    texts, or where no feature is found, every score is 0. A null label or a
    label of a row that is not in ``docs`` says nothing; of repeated labels the larger counts.
    """
    spark = docs.sparkSession
    learn = crc_of_id() % 4 != 2
    known = labels.where(F.col("toxic").isNotNull() & learn).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    row = known.agg(F.count("*").alias("n"), F.sum(F.col("toxic")).alias("p")).first()
    if not row.p:
        return Model({}, np.zeros(0), -30.0)
    prior = min(0.9, max(1e-4, row.p / row.n))

    def one_of(rows: int, wanted: int) -> Column:
        return F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(max(1, round(rows / wanted)))) == 0

    confirmed = known.where((F.col("toxic") == 1) & one_of(row.p, positives)).select(F.col("doc_id").alias("of"))
    texts = docs.select("doc_id", "text").where(learn)
    sampled = texts.join(F.broadcast(confirmed), F.col("doc_id") == F.col("of"), "left")  # at most about ``positives`` ids
    sampled = sampled.select("text", F.col("of").isNotNull().alias("p"), one_of(docs.count(), unlabelled).alias("u")).where("p or u")
    sampled = staged(sampled)
    totals = sampled.agg(F.sum(F.col("p").cast("long")).alias("p"), F.sum(F.col("u").cast("long")).alias("u")).first()
    if not totals.p or not totals.u:
        return Model({}, np.zeros(0), -30.0)

    def counted(batches):
        p, u = Counter(), Counter()
        cache: dict = {}
        for batch in batches:
            for part in slices(batch):
                for text, confirmed, free in zip(binary(part.column("text")), part.column("p").to_pylist(), part.column("u").to_pylist()):
                    found = set()
                    for word in set(text.split()):
                        if (f := cache.get(word)) is None:
                            if len(cache) > 300_000:
                                cache.clear()
                            f = cache[word] = word_features(word)
                        found.update(f)
                    if confirmed:
                        p.update(found)
                    if free:
                        u.update(found)
        keys = list(p | u)
        for a in range(0, len(keys), 100_000):
            ks = keys[a : a + 100_000]
            yield pa.record_batch({"f": pa.array(ks, pa.int64()), "p": pa.array([p[k] for k in ks], pa.int64()), "u": pa.array([u[k] for k in ks], pa.int64())})

    counts = sampled.mapInArrow(counted, "f bigint, p bigint, u bigint").groupBy("f").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    both = (F.col("p") + F.col("u") + 1) / (totals.p + totals.u + 2)
    z = (F.col("p") / totals.p - F.col("u") / totals.u) / F.sqrt(both * (1 - both) * (1 / totals.p + 1 / totals.u))
    chosen = counts.where(F.col("p") >= least).withColumn("z", z).where(F.abs("z") >= strength)
    columns = {r.f: k for k, r in enumerate(chosen.orderBy(F.desc(F.abs("z")), "f").limit(most).collect())}
    if not columns:
        return Model({}, np.zeros(0), -30.0)

    def rows(batches):
        features = Features(columns)
        for batch in batches:
            for part in slices(batch):
                on = [features.of(x) for x in binary(part.column("text"))]
                arrays = [pa.array([list(x) for x in on], pa.list_(pa.int32())), pa.array([list(x.values()) for x in on], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*arrays, *part.select(["p", "u"]).columns], names=["on", "often", "p", "u"])

    table = sampled.mapInArrow(rows, "on array<int>, often array<double>, p boolean, u boolean").toArrow()

    def matrix(flag: str) -> np.ndarray:
        chosen = table.filter(table[flag])
        on = sorted(zip(chosen.column("on").to_pylist(), chosen.column("often").to_pylist()))  # whatever the order of partitions
        x = np.zeros((len(on), len(columns)), np.float32)
        for k, (here, often) in enumerate(on):
            x[k, here] = often
        return x

    weights, bias = nn_pu(matrix("p"), matrix("u"), prior)
    return Model(columns, weights, bias)


def with_score(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """All columns of ``docs`` and the score of the text, from 0 to 1; the text is the only input. A null text is empty."""
    state: dict = {}

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        features = state.setdefault("features", Features(model.columns))
        parts = slices(pa.RecordBatch.from_arrays([text], names=["text"]))
        return pa.array(np.concatenate([np.zeros(0), *(model.scores(binary(x.column("text")), features) for x in parts)]))

    return docs.withColumn(name, score("text"))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; empty texts get the score of no evidence.

    A null doc_id counts as the empty id for the split and has no label; repeated rows are scored each.
    """
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels, **options), "score")
    return scored.select("doc_id", (crc_of_id() % 4 == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """The rows of ``docs`` below the threshold, with all their columns."""
    name = fresh("score", docs)
    return with_score(docs, fit(docs, labels, **options), name).where(F.col(name) < threshold).select(*docs.columns)
