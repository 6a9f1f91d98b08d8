"""Tokenizers' ids, token files, packing and token counts."""

import random
import tracemalloc
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer, models

from tests.llm.frames import awkward, documents
from tickloom.llm import packing, token_counts, token_files
from tickloom.llm.tokens import Encoder, public_vocabulary, space_units, word_units
from tickloom.llm.words import span_hashes

VOCABULARIES = [("byte_bpe_50k.json", space_units), ("word_bpe_49k.json", word_units)]


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("name", "units"), VOCABULARIES)
def test_units_give_the_tokenizer_s_ids(name, units):
    path = public_vocabulary(name)
    encoder, tokenizer = Encoder(path, units, most=500), Tokenizer.from_file(path)
    random.seed(name)
    letters = "ab .,'é\n\t\r1İΣ　́!\x0b\x1c ​﻿<|endoftext|>"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 40))) for _ in range(2000)] + [t or "" for _, t in awkward()]
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|", "|>", "A", "b.C", " ", ". ", "Ünï", "\n"]
    texts += ["".join(random.choices(parts, k=random.randint(1, 8))) for _ in range(1000)]
    for a in range(0, len(texts), 7):
        part = texts[a : a + 7]
        ids, counts = encoder.encode([x.encode() for x in part])
        want = [x.ids for x in tokenizer.encode_batch(part, add_special_tokens=False)]
        assert ids.tolist() == sum(want, []) and counts.tolist() == [len(x) for x in want]


@pytest.mark.parametrize("shards", [3, 4000])
def test_token_files_round_trip(spark, tmp_path, shards):
    path, rows = public_vocabulary("byte_bpe_50k.json"), awkward()
    folder = str(tmp_path / "files")
    token_files.write_token_files(documents(spark, rows), folder, path, docs_per_shard=shards, block_bytes=2000)
    found = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start = 0
    for row, (doc_id, text) in zip(found, ordered, strict=True):
        want = np.array([*ids_of(path, text), 0], "<u4").tobytes()
        assert (row.doc_id, row.start, row.n_tokens, bytes(row.ids)) == (doc_id, start, len(want) // 4, want)
        start += row.n_tokens
    one = token_files.fetch_documents(spark, folder, [8]).collect()
    assert [bytes(r.ids) for r in one] == [np.array([*ids_of(path, rows[7][1]), 0], "<u4").tobytes()]
    assert token_files.fetch_documents(spark, folder, []).count() == 0 and token_files.fetch_documents(spark, folder, [10**9]).count() == 0
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = token_files.fetch_documents(spark, folder, [8])._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(low,8)" in plan and "GreaterThanOrEqual(high,8)" in plan


def test_token_files_refuse_ids_that_do_not_fit(spark, tmp_path):
    with pytest.raises(Exception, match="does not fit"):
        token_files.write_token_files(documents(spark, awkward()), str(tmp_path / "f"), public_vocabulary("byte_bpe_50k.json"), width="u1")


def test_token_files_empty(spark, tmp_path):
    folder = str(tmp_path / "files")
    token_files.write_token_files(documents(spark, []), folder, public_vocabulary("byte_bpe_50k.json"))
    assert token_files.read_token_files(spark, folder).count() == 0


def test_pack_documents(spark):
    path, rows = public_vocabulary("word_bpe_49k.json"), awkward() + [(500 + k, "word " * (37 * k % 900)) for k in range(60)]
    found = packing.pack_documents(documents(spark, rows), path, capacity=512).collect()
    pieces = {}
    for doc_id, text in rows:
        ids = [*ids_of(path, text), 1]
        for k, a in enumerate(range(0, len(ids), 512)):
            piece = np.array(ids[a : a + 512], "<u4").tobytes()
            key = (doc_id, k, a, len(piece) // 4, zlib.crc32(piece))
            pieces[key] = pieces.get(key, 0) + 1
    got, sequences = {}, {}
    for r in found:
        key = (r.doc_id, r.piece, r.start, r.length, zlib.crc32(bytes(r.ids)))
        got[key] = got.get(key, 0) + 1
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == pieces
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 512
    total = sum(r.length for r in found)
    assert len(sequences) <= -(-total // 512) + 1
    assert packing.pack_documents(documents(spark, []), path).count() == 0


def test_sum_of_squares_follows_its_rule():
    random.seed(5)
    bins, gaps = packing.SumOfSquares(40), {}
    for length in sorted((random.randint(1, 40) for _ in range(300)), reverse=True):
        counts = [list(gaps.values()).count(g) for g in range(41)]
        counts[0] = 0

        def squares(g):
            after = counts.copy()
            after[g] -= 1
            if g - length:
                after[g - length] += 1
            return sum(x * x for x in after)

        room = [g for g in set(gaps.values()) if g >= length]
        number, offset = bins.place(length)
        gap = 40 - offset
        if room:
            assert squares(gap) == min(map(squares, room)) and gaps[number] == gap
        else:
            assert gap == 40 and number not in gaps
        gaps[number] = gap - length


def unigram_pieces(model, text):
    words = (text or "").encode().split()
    return len(words), sum(len(model.tokenize(token_counts.MARK + w.decode())) for w in words)


@pytest.mark.parametrize("small", [False, True])
def test_token_counts(spark, monkeypatch, small):
    """The counts of a unigram tokenizer with the same vocabulary; the small one has ties and unknown characters."""
    path = public_vocabulary("piece_bpe_32k.model")
    vocabulary = [("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0), ("ba", -2.5), ("on", -1.0), ("e", -2.0)] if small else token_counts.ranked_vocabulary(path)
    monkeypatch.setattr(token_counts, "_COUNTERS", {})
    counter, model = token_counts.PieceCounter(vocabulary), models.Unigram([("<unk>", 0.0), *vocabulary], 0, False)
    random.seed(1)
    for word in ["".join(random.choice("abonéx中") for _ in range(random.randint(0, 12))) for _ in range(500)]:
        assert counter.word("▁" + word)[0] == len(model.tokenize("▁" + word))
    if not small:
        found = token_counts.token_counts(documents(spark, awkward()), path).collect()
        want = sorted((str(i), *unigram_pieces(model, t)) for i, t in awkward())
        assert sorted((str(r.doc_id), r.n_words, r.n_pieces) for r in found) == want
        assert token_counts.token_counts(documents(spark, []), path).count() == 0


def test_packing_moves_no_ids_through_python(spark, capsys):
    """Only the lengths go to the worker that places the pieces; the ids would fill it and the JVM's transfer buffers."""
    pieces = spark.createDataFrame([(k, 0, 0, 1 + k % 9, bytes(4 + k % 9 * 4)) for k in range(40)], packing.PIECES)
    df = packing.pack(pieces, 2, capacity=16)
    df.explain()
    plan = capsys.readouterr().out
    assert "MapInArrow" not in plan and plan.count("ArrowEvalPython") == 1
    rows = df.collect()
    assert sorted(r.doc_id for r in rows) == list(range(40)) and all(len(r.ids) == 4 * r.length for r in rows)
    # Longest first in each task: what a sequence starts with is never shorter than what follows.
    for number in {r.sequence_id for r in rows}:
        here = sorted((r.offset, r.length) for r in rows if r.sequence_id == number)
        assert [n for _, n in here] == sorted((n for _, n in here), reverse=True)
        assert [a for a, _ in here] == [sum(n for _, n in here[:k]) for k in range(len(here))]


def test_hashes_need_little_memory_beside_the_text():
    """One array of eight bytes for each byte of text, and no copies of it."""
    buffer = np.frombuffer(b"some words " * 50_000, np.uint8)
    starts = np.arange(0, len(buffer) - 11, 11)
    want = span_hashes(buffer, starts, starts + 4)  # also makes the powers
    assert len(set(want.tolist())) == 1
    tracemalloc.start()
    span_hashes(buffer, starts, starts + 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 14 * len(buffer)
