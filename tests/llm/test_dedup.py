"""Exact, substring and near-duplicate operators against plain Python."""

import hashlib
import random
import re
from collections import Counter

import pytest

from tests.llm.frames import awkward, documents
from tickloom.llm import exact, near, substrings
from tickloom.llm.common import numbered


def squeezed(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def test_exact_groups(spark):
    rows = awkward() + [(-(2**63), "one two three four five six"), (-(2**63), "a"), (2**63 - 1, "a")]
    found = exact.exact_groups(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(squeezed(text), []).append((-len(text or ""), doc_id is None, doc_id or 0))
    want = Counter()
    for doc_id, text in rows:
        key = squeezed(text)
        keep = min(groups[key])
        want[doc_id, None if keep[1] else keep[2], len(groups[key]), hashlib.sha256(key.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == want
    assert sum(r.kept for r in found) == len(groups)


def test_exact_kept_rows(spark):
    docs = documents(spark, awkward())
    kept = exact.kept_documents(docs)
    assert kept.columns == docs.columns
    texts = [squeezed(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({squeezed(t) for _, t in awkward()})


def test_chunks_join_to_the_text_and_resynchronise(spark):
    random.seed(1)
    text = "".join(random.choice("abcdefgh.,") for _ in range(20_000))
    rows = spark.createDataFrame([(text,), ("zz" + text,), ("",)], "norm string").select("norm", exact.chunks(exact.F.col("norm")).alias("c")).collect()
    assert all("".join(r.c) == r.norm for r in rows)
    assert len(set(rows[0].c) & set(rows[1].c)) > 0.9 * len(rows[0].c)


def test_exact_is_native(spark):
    plan = exact.exact_groups(documents(spark, awkward()))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def without_repeats(rows, width):
    texts = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[k : k + width]) for w in texts for k in range(len(w) - width + 1))
    out = Counter()
    for (doc_id, _), w in zip(rows, texts):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if seen[tuple(w[k : k + width])] > 1:
                gone[k : k + width] = [True] * width
        out[doc_id, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()] += 1
    return out


def check_repeats(spark, rows, width=35):
    found = substrings.without_repeats(documents(spark, rows), width).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found) == without_repeats(rows, width)
    assert all(r.n_removed == sum(b - a for a, b in r.spans) for r in found)


def test_substrings_awkward(spark):
    check_repeats(spark, awkward())


@pytest.mark.parametrize("shard", [0, 64])
def test_substrings_random(spark, monkeypatch, shard):
    """Passages at different places, periodic texts, a passage of many documents; also with all anchors counted by windows."""
    monkeypatch.setattr(substrings, "SHARD", shard)
    random.seed(shard)
    passages = [[random.choice("abcdefghij") * random.randint(1, 3) for _ in range(n)] for n in (35, 36, 50, 90)]
    rows = []
    for k in range(150):
        words = []
        for _ in range(random.randint(0, 4)):
            words += [f"u{random.randint(0, 10**6)}" for _ in range(random.randint(0, 40))]
            p = random.choice(passages)
            a = random.randint(0, 3)
            words += p[a:] if random.random() < 0.8 else ["x", "y", "z"] * random.randint(1, 40)
        rows.append((k, " ".join(words)))
    check_repeats(spark, rows)


def test_suffix_automaton_counts_occurrences():
    random.seed(3)
    texts = [[random.randint(0, 2) for _ in range(random.randint(5, 40))] for _ in range(6)]
    weights = [1, 1, 2, 1, 1, 3]
    automaton = substrings.SuffixAutomaton()
    for words, weight in zip(texts, weights):
        automaton.add(words, weight)
    automaton.count()
    for width in (3, 5):
        often = Counter()
        for words, weight in zip(texts, weights):
            for k in range(len(words) - width + 1):
                often[tuple(words[k : k + width])] += weight
        for words in texts:
            want = sum(1 << k for k in range(len(words) - width + 1) if often[tuple(words[k : k + width])] > 1)
            assert automaton.repeated(words, width) == want


def brute_classes(rows, n=5):
    sets = []
    for _, text in rows:
        w = (text or "").encode().split()
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    members = {}
    for k in range(len(rows)):
        members.setdefault(find(k), []).append(rows[k][0])
    out = Counter()
    for k, (doc_id, _) in enumerate(rows):
        ids = [x for x in members[find(k)] if x is not None]
        out[doc_id, min(ids) if ids else None, links[k]] += 1
    return out, len(members)


def edited(words, edits):
    words = list(words)
    for _ in range(edits):
        words[random.randrange(len(words))] = f"e{random.randint(0, 10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("block", [4, 256])
def test_near_classes(spark, monkeypatch, block):
    """Near copies around the threshold, a large group that is compared in blocks, and the awkward rows."""
    monkeypatch.setattr(near, "BLOCK", block)
    random.seed(block)
    bases = [[f"b{i}_{k}" for k in range(200)] for i in range(6)]
    rows = awkward() + [(100 + k, edited(random.choice(bases), random.randint(0, 12))) for k in range(120)]
    docs = documents(spark, rows)
    found = near.near_classes(docs).collect()
    want, classes = brute_classes(rows)
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in found) == want
    kept = near.one_of_each_class(docs)
    assert kept.columns == docs.columns and kept.count() == classes


def test_prefixes_are_shortened_until_the_recall():
    depth = near.prefix_length(0.8, 32, 0.9999)
    assert 1 - (1 - 0.8**depth) ** 32 >= 0.9999 > 1 - (1 - 0.8 ** (depth + 1)) ** 32
    assert near.prefix_length(0.8, 2, 0.9999) == 1


def test_components_of_a_long_path(spark):
    random.seed(2)
    order = random.sample(range(60), 60)
    edges = spark.createDataFrame([(a, b) for a, b in zip(order, order[1:])] + [(100, 101)], "a bigint, b bigint")
    assert {(r.node, r.label) for r in near.components(edges).collect()} == {(k, 0) for k in range(60)} | {(100, 100), (101, 100)}


def test_empty_tables(spark):
    none = documents(spark, [])
    assert exact.exact_groups(none).count() == substrings.without_repeats(none).count() == near.near_classes(none).count() == 0
    assert exact.kept_documents(none).count() == near.one_of_each_class(none).count() == 0


def test_numbered(spark):
    names = [None, "b", "a", "Z", "é", "zz", "𝒳"]
    found = numbered(spark.createDataFrame([(x,) for x in names], "source string"), exact.F.asc_nulls_last("source"), "k").collect()
    assert [r.source for r in sorted(found, key=lambda r: r.k)] == ["Z", "a", "b", "zz", "é", "𝒳", None]
