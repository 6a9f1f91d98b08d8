"""Mixing, toxicity, nearest neighbours, language-model scores and the pipeline."""

import inspect
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.frames import awkward, documents
from tickloom.llm import mixing, neighbours, scoring, toxicity


def targets_of(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by the rule's words: deal, cap, deal the excess again."""
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(free):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                free.remove(s)
    return target


def mix_rows():
    random.seed(4)
    rows = [(k, "w " * random.randint(0, 30), random.choice([None, "a", "B", "é", "a", "a"])) for k in range(600)]
    return rows + [(None, None, "a"), (1000, "", "none"), (1500, "x y", "a"), (1500, "x y", "a"), (2000, "big " * 5000, "B")]


def test_mix(spark):
    rows = mix_rows()
    docs = documents(spark, rows)
    found = mixing.mix(docs).join(docs.select("doc_id", "source").distinct(), "doc_id", "left").collect()
    again = mixing.mix(docs).collect()
    assert sorted(map(str, [(r.doc_id, r.size, r.taken) for r in again])) == sorted(map(str, [(r.doc_id, r.size, r.taken) for r in mixing.mix(docs).collect()]))
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    target, taken, largest = targets_of(sizes), Counter(), Counter()
    for r in found:
        if r.doc_id is None:
            continue
        assert r.taken in (0, r.size, 2 * r.size)
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], abs_tol=1e-6)
    for doc_id, text, source in rows:
        largest[source] = max(largest[source], 2 * len((text or "").split()))
    for r in found:
        taken[r.source] += r.taken
    for source in sizes:
        assert abs(taken[source] - target[source]) <= largest[source]
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len((r.text or "").split())
    assert words == +Counter({s: taken[s] for s in taken})
    none = documents(spark, [])
    assert mixing.mix(none).count() == mixing.mixed_documents(none).count() == 0


def toxic_corpus(n=1500):
    random.seed(9)
    rows, labels = [], []
    for k in range(n):
        words = ["".join(random.choice(["ta", "re", "mo", "li"]) for _ in range(random.randint(1, 4))) for _ in range(random.randint(5, 60))]
        bad = random.random() < 0.15
        for _ in range(random.randint(2, 5) if bad else 0):
            words.insert(random.randint(0, len(words)), random.choice(["nasty", "Grimword,", "slur" + random.choice("abc")]))
        rows.append((k, " ".join(words)))
        if random.random() < 0.6:
            labels.append((k, 1, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_corpus()
    table = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None), (10**6, 0, 1)], "doc_id bigint, quality int, toxic int")
    docs = documents(spark, rows + [(5000, None), (5001, ""), (None, "nasty nasty grimword")])
    found = {r.doc_id: r for r in toxicity.toxicity(docs, table).collect()}
    assert len(found) == len(rows) + 3
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items() if i is not None)
    held = [(found[i].predicted, t) for i, _, t in labels if found[i].held_out]
    assert np.mean([p == t for p, t in held]) > 0.97
    clean = toxicity.clean_documents(docs, table)
    assert clean.columns == docs.columns and clean.count() == sum(not r.predicted for r in found.values())


def test_toxicity_reads_labels_of_training_rows_only(spark):
    rows, labels = toxic_corpus(400)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    docs = documents(spark, rows)
    a, b = ({r.doc_id: r.score for r in toxicity.toxicity(docs, spark.createDataFrame(x, "doc_id bigint, quality int, toxic int")).collect()} for x in (labels, turned))
    assert a == b


def test_toxicity_without_examples(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.predicted for r in toxicity.toxicity(documents(spark, awkward()), none).collect()} == {0}
    assert toxicity.toxicity(documents(spark, []), none).count() == 0


def test_toxicity_without_features_rejects_nothing(spark):
    """Few labels, half of them toxic: nothing tells the texts apart, so the prior must not reject all."""
    docs = documents(spark, [(k, f"text number {k}") for k in range(40)])
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(20)], "doc_id bigint, quality int, toxic int")
    assert {r.predicted for r in toxicity.toxicity(docs, labels).collect()} == {0}
    assert toxicity.clean_documents(docs, labels).count() == 40


def test_words_known_to_a_worker_are_bounded():
    """A table of all words of a task's texts would be most of the worker's memory; the score is the same."""
    features = toxicity.Features({toxicity.word_features(b"bad")[0]: 0})
    for k in range(0, 300_000, 1000):
        assert features.of(b" ".join(b"w%d" % x for x in range(k, k + 1000)) + b" bad") == {0: 1.0}
    assert len(features) <= 100_000


def test_risk_finds_the_hidden_positives():
    """Unlabelled rows with their prior's share of positives; many more features than rows tell apart, so an unclipped risk would overfit."""
    rng = np.random.default_rng(0)
    shift = np.zeros(60)
    shift[:20] = 0.9
    positive, hidden = rng.normal(size=(200, 60)) + shift, np.arange(500) < 200
    unlabelled = rng.normal(size=(500, 60)) + np.outer(hidden, shift)
    weights, bias = toxicity.nn_pu(positive, unlabelled, 0.4, decay=0.03)  # dense features need more than words do
    fresh, truth = rng.normal(size=(2000, 60)), np.arange(2000) < 800
    fresh += np.outer(truth, shift)
    assert ((unlabelled @ weights + bias > 0) == hidden).mean() > 0.85
    assert ((fresh @ weights + bias > 0) == truth).mean() > 0.85


def brute_nearest(rows, k=10):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 6 and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = min(good.get(i, v), v)
    out = []
    for q, a in good.items():
        if q % 100 == 0:
            near = sorted((math.dist(a, b), i) for i, b in good.items() if i != q)[:k]
            out += [(q, n + 1, i, round(d, 9)) for n, (d, i) in enumerate(near)]
    return sorted(out)


def test_nearest_small_is_exact(spark):
    random.seed(8)
    same = [1.0, 2.0, 0.0, 0.0, 1.0, 0.5]
    rows = [(k, [float(random.randint(-3, 3)) for _ in range(6)]) for k in range(300)] + [(1000 + k, same) for k in range(150)]
    rows += [(2000, None), (2100, []), (2200, [0.0] * 6), (2300, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2400, [float("nan")] * 6), (2500, [float("inf")] + [1.0] * 5), (2600, [1.0]), (None, same), (5, same)]
    frame = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], "vec_id bigint, embedding array<float>, keys string, rank int, q int")
    found = neighbours.nearest(frame, F.col("vec_id") % 100 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in found) == brute_nearest(rows)
    assert neighbours.nearest(frame.where("false"), F.col("vec_id") % 100 == 0).count() == 0


def directions(rows, dims, seed=1):
    x = np.random.default_rng(seed).normal(size=(rows, dims))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


SPREAD = np.random.default_rng(2).normal(size=(20000, 1))
TABLES = {
    "gaussian": (np.random.default_rng(1).normal(size=(8000, 32)), 100),
    "few rows": (directions(500, 64), 10),
    "norms of lognormal spread 1": (directions(20000, 64) * np.exp(SPREAD), 200),
    "norms of lognormal spread 2": (directions(8000, 64) * np.exp(2 * SPREAD[:8000]), 100),
    "norms as far apart as floats go": (directions(2000, 16) * 10.0 ** np.array([[-40], [0], [35]])[np.arange(2000) % 3], 50),
}


@pytest.mark.parametrize("name", TABLES)
def test_nearest_recall(spark, name):
    vectors, step = TABLES[name]
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    found = defaultdict(set)
    for r in neighbours.nearest(frame, F.col("vec_id") % step == 0).collect():
        found[r.query_id].add(r.vec_id)
    hits, asked = 0, range(0, len(vectors), step)
    for q in asked:
        gaps = np.linalg.norm(vectors - vectors[q], axis=1)
        gaps[q] = np.inf
        best = np.sort(gaps)[9]
        hits += min(10, sum(gaps[list(found[q])] <= best * (1 + 1e-12)))
    assert hits / (10 * len(asked)) >= 0.9


def test_small_tables_are_hashed():
    index = neighbours.Bands(64, {0: 500}, 16, 0.6, 0.45)
    keys = index.probes(directions(20, 64), 10)
    assert math.prod(2 * a for a in index.indexes[0].axes) > 50 and max(map(len, keys)) < 16 * 50


def test_bands_are_searched_where_neighbours_are():
    """All rows of small norm may be near a long vector, long ones only in its direction."""
    index = neighbours.Bands(64, {-40: 1000, 0: 1000, 40: 1000}, 16, 0.6, 0.45)
    small, same, large = index.shares(np.zeros(1), 10)[0]
    assert small > 1e-3 and large == 0 and same < small
    assert math.isclose(neighbours.Bands(64, {0: 1000}, 16, 0.6, 0.45).shares(np.zeros(1), 10)[0, 0], 0.01, rel_tol=0.6)


@pytest.mark.parametrize("spread", [0.01, 0.001])
def test_nearest_among_thousands_of_near_copies(spark, spread):
    """The codes cannot tell these vectors apart; the original vectors can."""
    rng = np.random.default_rng(4)
    centre = rng.normal(size=64)
    vectors = (centre / np.linalg.norm(centre) + rng.normal(size=(3000, 64)) * spread / 8).astype(np.float32)
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    found = defaultdict(list)
    for r in neighbours.nearest(frame, F.col("vec_id") % 300 == 0).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r.vec_id)
    for q in range(0, 3000, 300):
        gaps = ((vectors.astype(float) - vectors[q]) ** 2).sum(1)
        gaps[q] = np.inf
        assert found[q] == np.argsort(gaps, kind="stable")[:10].tolist()


def test_hadamard_is_orthogonal():
    x = np.random.default_rng(2).normal(size=(5, 16))
    assert np.allclose(neighbours.hadamard(neighbours.hadamard(x)), 16 * x)


def lm_rows():
    random.seed(6)
    lexicon = [("".join(random.choice("aeioklmn") for _ in range(random.randint(1, 6)))).title() for _ in range(80)]
    rows = awkward() + [(200 + k, " ".join(random.choice(lexicon) for _ in range(random.randint(1, 300)))) for k in range(150)]
    return rows


def unigram(rows):
    texts = [[w.decode() for w in (t or "").encode().lower().split()] + [None] for _, t in rows]
    train = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2 for i, _ in rows]
    counts = Counter(w for words, on in zip(texts, train) if on for w in words)
    n, v = sum(counts.values()), len(counts)
    out = Counter()
    for (i, _), words, on in zip(rows, texts, train):
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        out[i, not on, len(words), sum(counts[w] > 0 for w in words), n, round(base, 6)] += 1
    return out


@pytest.mark.parametrize("dictionary", [10, 1_000_000])
def test_base_scores(spark, dictionary):
    """With a tiny dictionary most words take the way of the join."""
    rows = lm_rows()
    found = scoring.score(documents(spark, rows), dictionary=dictionary, coded=50).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == unigram(rows)
    assert all(r.score < 0 for r in found)


def test_scores_of_empty_tables(spark):
    assert scoring.score(documents(spark, [])).count() == 0
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    (only,) = scoring.score(documents(spark, [(held, "never seen")])).collect()
    assert only.n_known == only.train_tokens == 0 and only.score < 0


def small_model():
    """A model over a few words, with tables filled from a few texts."""
    v = scoring.Vocabulary(pa.table({"word": pa.array([b"b", b"a", b"cc"], pa.binary()), "n": [30, 50, 20]}), 3, 130, 20)
    model = scoring.Model(v, 130, 4, 20)
    rng = np.random.default_rng(3)
    model.set_tables(rng.integers(0, 5, (scoring.WORD_ORDERS, 2 << scoring.WORD_BITS), dtype=np.uint32), rng.integers(0, 5, (scoring.SPELL_ORDERS, 2 << scoring.SPELL_BITS), dtype=np.uint32))
    model.words.weights += rng.normal(0, 0.2, model.words.weights.shape).astype(np.float32)
    return model


def test_next_token_probabilities_sum_to_one():
    model = small_model()
    before = [b"a b cc a"]
    symbols = np.arange(len(model.vocabulary.codes))
    tokens = scoring.Tokens(before, model.vocabulary)
    contexts = [np.full(len(symbols), c[-1]) for c in tokens.contexts]
    sizes, bit, gate, x = model.word_inputs(symbols, contexts)
    logs = np.bincount(np.repeat(symbols, sizes), scoring._bits(model.words.logits(x, gate), bit)[0])
    assert math.isclose(sum(10**logs), 1, rel_tol=1e-4)


def test_scores_refine_weights_as_a_plain_loop_does(monkeypatch):
    monkeypatch.setattr(scoring, "STRIDE", 4)
    model, v = small_model(), None
    v = model.vocabulary
    texts = [b"a b a cc b a a b cc a a b a", b"", b"cc cc cc a b"]
    tokens = scoring.Tokens(texts, v)
    fast = model.scores(tokens, 0, 3)
    for k in range(3):
        own, total = np.zeros(scoring.WORD_ORDERS + 2), 0.0
        for a in range(tokens.at[k], tokens.at[k + 1], 4):
            here = np.arange(a, min(a + 4, tokens.at[k + 1]))
            _, bit, gate, x = model.word_inputs(tokens.symbol[here], [c[here] for c in tokens.contexts])
            step = np.zeros_like(own)
            for b, g, row in zip(bit, gate, x.T):
                p = 1 / (1 + math.exp(-float(((model.words.weights[g] + own) * row).sum())))
                total += math.log10(p if b else 1 - p)
                step += (b - p) * row
            own += 0.02 * step / len(bit)
        assert math.isclose(total, fast[k], rel_tol=1e-4)


def test_contexts_are_counted_apart_whatever_the_corpus(spark):
    """Every pair of a context and a symbol has the counts of a plain loop along its path: none shares a slot."""
    random.seed(12)
    lexicon = [f"w{k}" for k in range(40)]
    texts = [" ".join(random.choice(lexicon) for _ in range(random.randint(0, 200))).encode() for _ in range(60)]
    train = np.array([k % 3 > 0 for k in range(60)])
    counts = Counter(w for text, on in zip(texts, train) if on for w in text.split())
    table = pa.table({"word": pa.array([w for w in counts], pa.binary()), "n": list(counts.values())})
    v = scoring.Vocabulary(table, 30, sum(counts.values()) + 40, 40)
    tokens = scoring.Tokens(texts, v)
    asked = scoring.slice_pairs(tokens, train)
    frame = spark.createDataFrame(pa.table({"context": asked[0].view(np.int64), "symbol": asked[1], "n": asked[2]}))
    paths = scoring.Paths(scoring.context_paths(frame, spark.sparkContext.broadcast(v)).toArrow())
    along = [Counter(), Counter()]
    on = np.repeat(train, tokens.counts)
    for order, context in enumerate(tokens.contexts):
        for c, s in zip(context[on].tolist(), tokens.symbol[on].tolist()):
            bits = format(v.codes[s], f"0{v.lengths[s]}b")
            along[order].update((c, bits[:d]) for d in range(len(bits) + 1))
    sizes = v.lengths[tokens.symbol]
    bit = v.bit[scoring.ragged(v.first[tokens.symbol], sizes)]
    for order, context in enumerate(tokens.contexts):
        zero, one = paths.counts(context, tokens.symbol, sizes, bit, False)
        expected = [(along[order][c, b[:d] + "0"], along[order][c, b[:d] + "1"]) for c, s in zip(context.tolist(), tokens.symbol.tolist()) for b in [format(v.codes[s], f"0{v.lengths[s]}b")] for d in range(len(b))]
        seen = list(zip(zero.tolist(), one.tolist()))
        assert seen == expected


def test_short_texts_and_spelling_are_refined():
    """With the repository's own stride: a text of a few words, and its spelled words, move their weights at once."""
    model = small_model()
    tokens = scoring.Tokens([b"a b a cc b a a b", b"zq zq zq a zq", b""], model.vocabulary)
    assert scoring.STRIDE <= 4
    fixed = [model.scores(tokens, 0, 3, 0.0), model.spell_scores(tokens, 0.0)]
    moved = [model.scores(tokens, 0, 3), model.spell_scores(tokens)]
    assert (fixed[0] != moved[0]).tolist() == [True, True, False]
    assert (fixed[1] != moved[1]).tolist() == [False, True, False]
    own, total = np.zeros(scoring.SPELL_ORDERS), 0.0
    for _ in range(4):
        _, bit, gate, inputs = model.spell_inputs([b"zq"])
        step = np.zeros_like(own)
        for b, g, row in zip(bit, gate, inputs.T):
            p = 1 / (1 + math.exp(-float(((model.spell.weights[g] + own) * row).sum())))
            total += math.log10(p if b else 1 - p)
            step += (b - p) * row
        own += scoring.SPELL_RATE * step / len(bit)
    assert math.isclose(total, moved[1][1], rel_tol=1e-4)


def test_mixers_are_fitted_on_long_texts(spark):
    """Runs of texts of any length, each bit with the contexts of the whole text."""
    random.seed(3)
    lexicon = [f"word{k}" for k in range(60)]
    rows = [(k, " ".join(random.choice(lexicon) for _ in range(9_000))) for k in range(4)]
    counts = Counter(w for _, t in rows for w in t.encode().split())
    v = scoring.Vocabulary(pa.table({"word": pa.array(list(counts), pa.binary()), "n": list(counts.values())}), 50, 36_004, 4)
    frame = spark.createDataFrame([(7 + 5 * k, t) for k, t in rows], "h bigint, text string")
    shared = spark.sparkContext.broadcast(v)
    runs = scoring.sampled_runs(frame, 4, 300, scoring.WORD_ORDERS, scoring.text_runs(shared))
    assert [len(symbol) for symbol, _ in runs] == [scoring.RUN] * 4
    for (k, text), (symbol, contexts) in zip(rows, runs):
        tokens, first = scoring.Tokens([text.encode()], v), (7 + 5 * k) % (9_001 - scoring.RUN + 1)
        assert (tokens.symbol[first : first + scoring.RUN] == symbol).all()
        assert all((a[first : first + scoring.RUN] == b).all() for a, b in zip(tokens.contexts, contexts))
    long = spark.createDataFrame([(3, bytearray(b"q" * 5_000))], "h bigint, text binary")
    ((letters, _),) = scoring.sampled_runs(long, 1, 20, scoring.SPELL_ORDERS, scoring.letter_runs(shared))
    assert len(letters) == scoring.LETTERS
    assert scoring.Model(v, 1, 1, 1).words.weights[:, 1:3].all()


def test_words_up_to_rank_65000_are_coded_and_five_letters_are_contexts():
    coded = inspect.signature(scoring.score).parameters["coded"].default
    words = [f"w{k}".encode() for k in range(70_000)]
    v = scoring.Vocabulary(pa.table({"word": pa.array(words, pa.binary()), "n": [70_010 - k for k in range(70_000)]}), coded, 3_000_000_000, 100)
    assert (scoring.Tokens([b"w0 w45000 w64999"], v).symbol[:3] > scoring.END).all()
    _, _, contexts = scoring.spelling([b"abcdex", b"zbcdex", b"zzcdex", b"zzzdex", b"zzzzex"])
    assert [len(set(c[5::7, 0].tolist())) for c in contexts] == [1, 2, 3, 4, 5]


def test_code_is_complete():
    lengths = scoring.code_lengths([5, 1, 1, 20, 7, 7, 3])
    assert sum(2.0**-lengths) == 1
    codes = {format(c, f"0{n}b") for c, n in zip(scoring.canonical(lengths), lengths)}
    assert len(codes) == 7 and not any(a != b and b.startswith(a) for a in codes for b in codes)


def test_pipeline(spark, tmp_path):
    rows, labels = toxic_corpus(300)
    rows = [(i, t, f"s{i % 3}") for i, t in rows] + [(900 + k, rows[k][1], "s1") for k in range(40)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.staged(stage(spark, docs, str(tmp_path)))
        assert docs.columns == before.columns, name
        assert docs.join(before.select("doc_id").distinct(), "doc_id", "left_anti").isEmpty()
    assert not docs.where("doc_id >= 900").count()
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    documents(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
