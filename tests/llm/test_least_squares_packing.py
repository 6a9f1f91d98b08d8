"""Packing by least squares against the tokenizers themselves, and the solver against its conditions."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.frames import awkward, documents
from tickloom.llm import least_squares_packing as packing
from tickloom.llm.tokens import public_vocabulary


def test_combinations_fill_the_window():
    table = packing.combinations(12, 3)
    assert (np.arange(13) @ table == 12).all() and (table.sum(axis=0) <= 3).all()
    assert len({tuple(c) for c in table.T}) == table.shape[1] == 1 + 6 + 12


def test_least_squares_meets_the_optimality_conditions():
    rng = np.random.default_rng(3)
    for n, m in [(4, 9), (12, 5), (33, 300)]:
        a, b = rng.random((n, m)), rng.normal(1, 2, n)
        x = packing.non_negative_least_squares(a, b)
        gain = a.T @ (b - a @ x)
        assert (x >= 0).all() and gain.max() < 1e-6 and np.abs(gain[x > 1e-9]).max(initial=0) < 1e-6
    assert packing.non_negative_least_squares(np.ones((3, 2)), np.zeros(3)).tolist() == [0, 0]


@pytest.mark.parametrize("n", [0, 1, 7, 400, 6000])
def test_plan_holds_every_token_once_and_needs_no_padding(n):
    rng = np.random.default_rng(n)
    lengths = np.minimum(1023, rng.lognormal(5, 1.2, n).astype(np.int64))
    found = packing.plan(lengths, 1024)
    got = {}
    for window in found:
        size = sum(m for _, _, m in window)
        assert size == 1024 or (0 < size < 1024 and size & (size - 1) == 0)
        for k, start, m in window:
            got.setdefault(k, []).append((start, m))
    for k, length in enumerate(lengths.tolist()):
        end = 0
        for start, m in sorted(got.get(k, [])):
            assert start == end and m > 0
            end += m
        assert end == length
    assert sum(sum(m for _, _, m in w) < 1024 for w in found) <= 10
    if n == 6000:  # one cut a sequence is what cutting a stream of ids would cost
        assert sum(map(len, got.values())) - len(got) < 0.5 * len(found)


@pytest.mark.parametrize("tails", [5, 20_000])
def test_pack_documents(spark, monkeypatch, tails):
    monkeypatch.setattr(packing, "GROUP_TAILS", tails)  # taken over into the tasks with the function
    random.seed(4)
    path = public_vocabulary("byte_bpe_50k.json")
    rows = awkward() + [(500 + k, "word more " * random.randint(0, 400)) for k in range(60)] + [(900, "<|endoftext|> a")] * 3
    tokenizer = Tokenizer.from_file(path)
    want = Counter()
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want[doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    found = packing.pack_by_least_squares(documents(spark, rows), path, capacity=512).collect()
    sequences = {}
    for r in found:
        assert len(r.ids) == 4 * r.length > 0
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 512 and end & (end - 1) == 0
    total = Counter()
    for r in found:
        total[r.doc_id] += r.length
    sizes = Counter()
    for (doc_id, n, _), k in want.items():
        sizes[doc_id] += n * k
    assert total == sizes
    alone = {d for d, k in Counter(d for d, _ in rows).items() if k == 1}
    whole = {d: b"".join(bytes(r.ids) for r in sorted((r for r in found if r.doc_id == d), key=lambda r: r.start)) for d in alone}
    assert {(d, len(x) // 4, zlib.crc32(x)) for d, x in whole.items()} == {k for k in want if k[0] in alone}
    assert all(r.doc_tokens * 4 == len(whole[r.doc_id]) for r in found if r.doc_id in alone)


def test_pack_nothing_and_bad_capacity(spark):
    path = public_vocabulary("byte_bpe_50k.json")
    assert packing.pack_by_least_squares(documents(spark, []), path).count() == 0
    with pytest.raises(ValueError):
        packing.pack_by_least_squares(documents(spark, []), path, capacity=1000)
