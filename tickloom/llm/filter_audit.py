"""What each of several filters removes in every order of applying them, from additive counts of failure sets.

One filter, the last, fails a document whose text is identical to that of a smaller doc_id. A counting
Bloom sketch of all texts clears those that are certainly unique, so only possible repeats are shuffled
with their text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import BLANKS, groups, staged

#: Counters of a segment, counters that a text touches, and counters for each text of the table.
SLOTS, PROBES, ROOM = 1 << 16, 4, 16
#: A sketch of at most so many bytes is broadcast, a larger one is joined by segment.
BROADCAST_BYTES = 64 << 20
#: Sketch entries that a task gathers before it hands them on.
FLUSH = 1 << 20


def contract_filters(text: Column) -> dict[str, Column]:
    """Failure conditions by letter, but for the repeats."""
    words = F.array_remove(F.split(text, f"[{BLANKS}]+"), "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _places(h2: np.ndarray) -> np.ndarray:
    """Counters of each text within its segment: PROBES different ones, as the step is odd."""
    first, step = h2 & (SLOTS - 1), ((h2 >> 16) & (SLOTS - 1)) | 1
    return (first[:, None] + np.arange(PROBES) * step[:, None]) & (SLOTS - 1)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters that a task's texts touch, by segment; a count is 1 or 2 (two or more)."""

    def flushed(parts: list[np.ndarray]) -> pa.RecordBatch:
        slots, counts = np.unique(np.concatenate(parts), return_counts=True)
        segment = slots // SLOTS
        starts = np.append(np.flatnonzero(np.diff(segment, prepend=-1)), len(slots))
        place, count = (slots % SLOTS).astype("<u2"), np.minimum(counts, 2).astype("u1")
        spans = list(zip(starts[:-1], starts[1:]))
        columns = [pa.array(segment[starts[:-1]], pa.int64()), pa.array([place[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([count[a:b].tobytes() for a, b in spans], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["segment", "places", "counts"])

    parts, held = [], 0
    for batch in batches:
        segment, h2 = (np.asarray(batch.column(c)) for c in ("segment", "h2"))
        parts.append((segment[:, None] * SLOTS + _places(h2)).ravel())
        held += len(parts[-1])
        if held >= FLUSH:
            yield flushed(parts)
            parts, held = [], 0
    if held:
        yield flushed(parts)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each segment: the bits of the counters that reached two, as 64-bit words."""
    for part in groups(batches, "segment"):
        counts = np.zeros(SLOTS, np.uint8)
        for places, more in zip(part.column("places").to_pylist(), part.column("counts").to_pylist()):
            at = np.frombuffer(places, "<u2")
            counts[at] = np.minimum(counts[at] + np.frombuffer(more, "u1"), 2)
        words = np.packbits(counts == 2, bitorder="little").view("<i8")
        arrays = [pa.array([part.column("segment")[0].as_py()], pa.int64()), pa.array([words.tolist()], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["segment", "words"])


def counting_bloom(hashed: DataFrame) -> DataFrame:
    """(segment, words) from rows of (segment, h2): sketches of tasks, merged segment by segment.

    What a task hands on grows with its own texts, not with the sketch, and a text that fills a third
    of the table is one entry of a task.
    """
    sparse = hashed.select("segment", "h2").mapInArrow(_sketched, "segment bigint, places binary, counts binary")
    return sparse.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merged, "segment bigint, words array<bigint>")


def _may_repeat(words: Column, h2: Column) -> Column:
    """Whether all counters of a text reached two; where one did not, no other row has this text."""
    first, step = h2.bitwiseAND(SLOTS - 1), F.shiftright(h2, 16).bitwiseAND(SLOTS - 1).bitwiseOR(F.lit(1))
    found = F.lit(True)
    for k in range(PROBES):
        place = (first + k * step).bitwiseAND(SLOTS - 1)
        word = F.element_at(words, (F.shiftright(place, 6) + 1).cast("int"))
        found = found & (F.getbit(word, place.bitwiseAND(63).cast("int")) == 1)
    return found


def _hashes(text: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed + k), text).alias(name) for k, name in enumerate(("h1", "h2"))]


def first_of_repeats(docs: DataFrame, flags: list[Column], seeds: int = 4) -> DataFrame:
    """``flags`` of every row of ``docs`` and ``repeats``: whether a smaller doc_id has the identical text.

    Null texts count as empty; a null doc_id repeats nothing and is no smaller one. Rows are known by 128
    hashed bits of their text, which are proven, text against text, to tell the possible repeats of this
    very table apart; should two texts share them, the next seed is taken.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    for seed in range(seeds):
        narrow = staged(docs.select(*flags, "doc_id", *_hashes(text, seed)))
        segments = max(1, -(-narrow.count() * ROOM // SLOTS))
        segment = F.pmod("h1", F.lit(segments)).alias("segment")
        sketch = staged(counting_bloom(narrow.select(segment, "h2")))
        side = F.broadcast(sketch) if segments * SLOTS // 8 <= BROADCAST_BYTES else sketch
        seen = docs.select("doc_id", text.alias("whole"), *_hashes(text, seed)).withColumn("segment", segment)
        possible = seen.join(side, "segment").where(_may_repeat(F.col("words"), F.col("h2")))
        sets = staged(possible.groupBy("h1", "h2", "whole").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).drop("whole"))
        repeated = sets.groupBy("h1", "h2").agg(F.count("*").alias("texts"), F.max("n").alias("n"), F.min("first").alias("first")).where("n > 1")
        repeated = staged(repeated)
        if not repeated.where("texts > 1").isEmpty():
            continue
        judged = narrow.withColumn("segment", segment).join(side, "segment").withColumn("may", _may_repeat(F.col("words"), F.col("h2"))).drop("words", "segment")
        cleared = judged.where(~F.col("may")).withColumn("repeats", F.lit(False))
        least = repeated.select("h1", "h2", "first")
        others = judged.where("may").join(least, ["h1", "h2"], "left").withColumn("repeats", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
        names = [c for c in cleared.columns if c not in ("h1", "h2", "may")]
        return cleared.select(names).unionByName(others.select(names))
    raise ValueError(f"texts collide for {seeds} seeds")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of the filters A to E in each order, for each part of ``docs`` (doc_id, text, source).

    Returns part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost
    and shapley: all 600 rows for every source (null: the empty string), zeros included. A null text is
    empty, which A alone fails on first sight; repeated rows count each for itself, and rows that share a
    doc_id do not repeat each other. ``labels`` (doc_id, quality, toxic) may be absent for a document or
    repeat, when one row with 1 is enough; null labels are no labels. Other columns are not read; an empty
    table gives no rows. Beyond the possible repeats only counts of (part, failure set) move.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    conditions = contract_filters(text)
    low = F.concat(*[F.when(bad, F.lit(letter)).otherwise("") for letter, bad in conditions.items()]).alias("low")
    rows = first_of_repeats(docs, [F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), low])
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("bad"))
    fails = F.concat("low", F.when(F.col("repeats"), "E").otherwise("")).alias("fails")
    hits = {name: F.sum(F.coalesce(F.col(name).cast("bigint"), F.lit(0))).alias(name) for name in ("good", "bad")}
    counts = rows.join(known, "doc_id", "left").groupBy("part", fails).agg(F.count("*").alias("n"), *hits.values())
    return _in_every_order(counts)


def _in_every_order(counts: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """Sums over the failure sets: at most 2 ** 5 rows of a part, spread over the orders and steps."""
    orders = F.split(F.lit(",".join("".join(p) for p in permutations(letters))), ",")
    each = counts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    each = each.withColumns({"letter": F.expr("substring(filter_order, step, 1)"), "before": F.expr("substring(filter_order, 1, step - 1)")})
    fails = F.expr("instr(fails, letter) > 0")
    reached = F.expr("translate(before, fails, '') = before")  # no filter before fails it
    tests = {
        "kept": ("n", reached & ~fails),
        "removed": ("n", reached & fails),
        "redundant": ("n", ~reached & fails),
        "unique_fails": ("n", F.col("fails") == F.col("letter")),
        "good_lost": ("good", reached & fails),
        "toxic_lost": ("bad", reached & fails),
    }
    sums = [F.sum(F.when(test, F.col(what)).otherwise(0)).cast("bigint").alias(name) for name, (what, test) in tests.items()]
    steps = each.groupBy("part", "filter_order", "step", "letter").agg(*sums)
    share = steps.groupBy("part", "letter").agg(F.sum("removed").cast("bigint").alias("shapley"))
    return steps.join(share, ["part", "letter"]).select("part", "filter_order", "step", *tests, "shapley")


ORACLE = rf"""WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^{BLANKS}]+') AS w FROM documents),
l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1),
f AS (
  SELECT part, l.quality, l.toxic, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS bad
  FROM d LEFT JOIN l USING (doc_id)),
k AS (SELECT part, bad, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic FROM f GROUP BY 1, 2),
i AS (SELECT unnest(range(1, 6)) AS x),
o AS (SELECT [a.x, b.x, c.x, e.x, g.x] AS p FROM i a, i b, i c, i e, i g WHERE len(list_distinct([a.x, b.x, c.x, e.x, g.x])) = 5),
s AS (SELECT p, x AS step, p[x] AS f, p[1:x - 1] AS before FROM o, i),
j AS (SELECT k.*, s.*, bad[f] AS hit, len(list_filter(before, lambda y: bad[y])) = 0 AS here FROM k, s),
r AS (
  SELECT part, p, step, f, sum(CASE WHEN here AND NOT hit THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN here AND hit THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN NOT here AND hit THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN hit AND len(list_filter(bad, lambda y: y)) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN here AND hit THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN here AND hit THEN toxic ELSE 0 END) AS toxic_lost
  FROM j GROUP BY ALL)
SELECT part, array_to_string(list_transform(p, lambda y: 'ABCDE'[y]), '') AS filter_order, step::INTEGER AS step, kept::BIGINT AS kept,
  removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM r"""
