"""The filter audit against plain Python, and its prepass."""

import re
from collections import Counter
from itertools import permutations

import pytest

from tests.llm.frames import awkward, documents
from tickloom.llm import filter_audit


def failing(rows):
    """Part, failure set and doc_id of each row."""
    out = []
    for doc_id, text, source in rows:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        tests = [
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            bool(re.search("[#$%&*|]", text)),
            doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows),
        ]
        out.append((source or "", {x for x, bad in zip("ABCDE", tests) if bad}, doc_id))
    return out


def plain(rows, labels):
    known = failing(rows)
    good, toxic = ({i for i, *flags in labels if flags[k] == 1 and i is not None} for k in range(2))
    out = {}
    for part in {p for p, _, _ in known}:
        mine, removed = [(f, i) for p, f, i in known if p == part], Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[0]]
                left = [r for r in left if x not in r[0]]
                removed[x] += len(gone)
                earlier = sum(x in f for f, _ in mine) - len(gone)
                alone = sum(f == {x} for f, _ in mine)
                out[part, "".join(order), step] = [len(left), len(gone), earlier, alone, sum(i in good for _, i in gone), sum(i in toxic for _, i in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed[order[step - 1]])
    return out


def cases():
    long = " ".join(f"word{k}" for k in range(300))
    rows = [(i, t, ["s", None, "", "t"][k % 4]) for k, (i, t) in enumerate(awkward())]
    rows += [(100 + k, long, "hot") for k in range(40)] + [(100, long, "hot"), (None, long, "hot"), (-7, long + " ", "t")]
    rows += [(200, "A B C $ " * 70, "t"), (201, long + " #", "t"), (202, long.upper(), "hot"), (203, "x " * 400, None), (204, "x " * 400, "s")]
    return rows


@pytest.mark.parametrize("limit", [filter_audit.BROADCAST_BYTES, -1])
def test_audit_equals_plain_counts(spark, monkeypatch, limit):
    monkeypatch.setattr(filter_audit, "BROADCAST_BYTES", limit)
    rows = cases()
    labels = [(1, 1, 0), (1, 0, 1), (7, 0, 1), (101, 1, None), (102, None, 1), (203, 1, 1), (None, 1, 1), (9999, 1, 1), (204, 0, 0)]
    table = spark.createDataFrame([(*r, "x", 1) for r in labels], "doc_id bigint, quality int, toxic int, part string, repeats int")
    found = filter_audit.audit(documents(spark, rows), table).collect()
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in found}
    assert len(found) == len(got) and got == plain(rows, labels)


def test_audit_without_rows(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(documents(spark, []), labels).count() == 0
    found = filter_audit.audit(documents(spark, [(1, "a")]), labels).collect()
    assert len(found) == 600 and {r.good_lost + r.toxic_lost for r in found} == {0}


def test_sketch_clears_only_unique_texts(spark):
    """Counters of a merged sketch tell whether two texts touched them; most unique texts are cleared."""
    F = filter_audit.F
    texts = spark.range(30_000).select(F.when(F.col("id") % 10 == 0, F.lit("same")).otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    hashed = texts.repartition(5).select("text", *filter_audit._hashes(F.col("text"), 0)).withColumn("segment", F.pmod("h1", F.lit(8)))
    judged = hashed.join(filter_audit.counting_bloom(hashed), "segment").withColumn("may", filter_audit._may_repeat(F.col("words"), F.col("h2")))
    counts = {(r.same, r.may): r["count"] for r in judged.groupBy((F.col("text") == "same").alias("same"), "may").count().collect()}
    assert counts[True, True] == 3000 and (True, False) not in counts and counts.get((False, True), 0) < 0.02 * 27_000


def test_colliding_texts_take_the_next_seed(spark, monkeypatch):
    real, seeds = filter_audit._hashes, []

    def poor(text, seed):
        seeds.append(seed)
        F = filter_audit.F
        return [F.lit(5).cast("bigint").alias("h1"), F.lit(9).cast("bigint").alias("h2")] if seed == 0 else real(text, seed)

    monkeypatch.setattr(filter_audit, "_hashes", poor)
    rows = cases()
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    found = filter_audit.audit(documents(spark, rows), labels).collect()
    want = plain(rows, [])
    assert {(r.part, r.filter_order, r.step): r.shapley for r in found} == {k: v[-1] for k, v in want.items()} and max(seeds) == 1
