"""Ranked search against plain Python integers, and what the tree promises."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.frames import awkward, documents
from tickloom.llm import ball_tree


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(rows, items, k):
    docs = [(i, Counter(terms(t))) for i, t in rows if terms(t)]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in items:
        asked, scored = set(terms(text)), []
        for doc_id, c in docs:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in asked if c[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, doc_id, -s) for rank, (s, _, _, doc_id) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return Counter(out)


def table(spark, items):
    return spark.createDataFrame([(*i, 3, "x") for i in items], "item_id bigint, text string, rank int, score string")


def many(n, seed=2):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(rng.choices(words[60 * (k % 6) : 60 * (k % 6) + 100], k=rng.randint(1, 80))) for k in range(n // 2)]
    return [(10_000 + k, rng.choice(texts[:3] if k % 3 == 0 else texts)) for k in range(n)], texts


@pytest.mark.parametrize("bytes_", [ball_tree.BLOCK_BYTES, 200])
def test_ranked_equals_plain_scores(spark, monkeypatch, bytes_):
    monkeypatch.setattr(ball_tree, "BLOCK_BYTES", bytes_)
    rows, texts = many(700)
    rows += awkward() + [(None, texts[0]), (10_001, texts[0]), (9, "İ é É ß 中文 W1 w1")]
    items = [(1, texts[0]), (2, texts[5] + " " + texts[9]), (2, "w1 W1 É 中文 İ"), (None, texts[7]), (4, None), (5, ""), (6, "nowhere ,.,"), (7, "...")]
    found = ball_tree.ranked(documents(spark, rows), table(spark, items), k=20)
    assert Counter(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect())) == plain(rows, items, 20)


def test_ranked_without_documents_or_items(spark):
    assert ball_tree.ranked(documents(spark, []), table(spark, [(1, "a b")])).count() == 0
    assert ball_tree.ranked(documents(spark, [(1, None)]), table(spark, [(1, "a b")])).count() == 0
    assert ball_tree.ranked(documents(spark, awkward()), table(spark, [])).count() == 0


def test_bounds_hold_and_prune():
    """No row exceeds the bound of a node above it, equal rows and far groups are skipped, and the ranking is that of all rows."""
    rng = np.random.default_rng(5)
    width, topics, dense = 600, 12, []
    for k in range(1200):
        row = np.zeros(width, np.int64)
        own = 50 * (k % topics) + rng.integers(0, 50, 12)
        row[own] = rng.integers(1, 10**6, 12)
        dense.append(dense[0] if k % 3 == 0 and k else row)
    dense = np.array(dense)
    lengths = (dense > 0).sum(axis=1)
    column = np.nonzero(dense)[1]
    sparse = ball_tree.Sparse(np.concatenate([[0], np.cumsum(lengths)]), column, dense[dense > 0])
    tree = ball_tree.BallTree(sparse, width, leaf=16)
    assert sorted(tree.order.tolist()) == list(range(len(dense)))
    queries = [(np.sort(rng.choice(50, 8, replace=False)) + 50 * t, rng.integers(1, 20_000, 8)) for t in range(1, topics)]
    limit, scored = tree.limits(queries), 0
    for q, (own, w) in enumerate(queries):
        weights = np.zeros(width, np.int64)
        weights[own] = w
        exact = dense @ weights
        for (a, b), bound in zip(tree.spans, limit[:, q]):
            assert bound >= (exact[tree.order[a:b]].max() if b > a else 0)
        best = ball_tree.Best(10).of(np.arange(len(dense)), np.zeros(len(dense), bool))
        scored += tree.search(limit[:, q].tolist(), weights, best)
        want = sorted((-s, k) for k, s in enumerate(exact.tolist()) if s > 0)[:10]
        assert [(-s, k) for s, k in zip(best.scores.tolist(), best.ids.tolist())] == want
    leaves = sum(c is None for c in tree.children)
    assert scored < 0.5 * leaves * len(queries)
