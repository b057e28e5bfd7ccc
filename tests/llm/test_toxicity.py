"""The toxicity network: gradients, windows, scores against plain loops, held-out quality."""
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerwise.llm import toxicity as TX


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net, x = TX.Network.new(1), rng.normal(size=(30, TX.N_INPUTS))
    first, length = np.array([0, 5, 20]), np.array([8, 3, 10])
    y, w = np.array([1.0, 0, 1]), np.array([0.3, 0.5, 0.2])
    _, grads = net.gradients(x, first, length, y, w)
    for name, value in net.par.items():
        for _ in range(4):
            i = tuple(rng.integers(0, s) for s in value.shape)
            old, loss = value[i], []
            for shift in (1e-5, -1e-5):
                value[i] = old + shift
                loss.append(net.gradients(x, first, length, y, w)[0])
            value[i] = old
            assert abs((loss[0] - loss[1]) / 2e-5 - grads[name][i]) < 1e-6


def plain_logit(p, x):
    """One window, step by step."""
    sig = lambda a: 1 / (1 + np.exp(-a))
    H, states = TX.HIDDEN, []
    for d, order in (("f", range(len(x))), ("b", range(len(x) - 1, -1, -1))):
        h, out = np.zeros(H), {}
        for t in order:
            g, u = x[t] @ p[f"W_{d}"] + p[f"c_{d}"], h @ p[f"U_{d}"]
            z, r = sig(g[:H] + u[:H]), sig(g[H:2 * H] + u[H:2 * H])
            n = np.tanh(g[2 * H:] + r * (u[2 * H:] + p[f"e_{d}"]))
            h = out[t] = (1 - z) * n + z * h
        states.append(np.array([out[t] for t in range(len(x))]))
    s = np.concatenate(states, axis=1)
    a = np.exp(np.tanh(s @ p["A"] + p["a"]) @ p["v"])
    return (a / a.sum()) @ s @ p["o"] + p["p"][0]


def test_scores_match_plain_loops():
    rng = np.random.default_rng(2)
    vocab = [f"w{i}ord" for i in range(50)]
    texts = [" ".join(rng.choice(vocab, n)) for n in (1, 2, 63, 64, 65, 96, 97, 200, 333)]
    net = TX.Network.new(3)
    model = TX.Model(0.1, rng.integers(-99, 99, TX.BUCKETS).astype(np.int8),
                     [rng.integers(-99, 99, TX.BUCKETS).astype(np.int8) for _ in TX.GRAMS], net)
    got, n = model.score(pa.array([*texts, "", None, " \n"]))
    for t, s, k in zip(texts, got, n):
        x = TX.Inputs(pa.array([t])).inputs(model.word_odds, model.gram_odds).astype(float)
        starts = [0]
        while starts[-1] + TX.WINDOW < len(x):
            starts.append(starts[-1] + TX.STRIDE)
        best = max(plain_logit(net.par, x[a:a + TX.WINDOW]) for a in starts)
        assert k == len(starts) and abs(s - 1 / (1 + np.exp(-best))) < 1e-4
    assert got[-3:].tolist() == [0.1] * 3 and n[-3:].tolist() == [0] * 3


def test_inputs_do_not_depend_on_neighbours():
    rng = np.random.default_rng(0)
    odds = [rng.integers(-99, 99, TX.BUCKETS).astype(np.int8) for _ in range(1 + len(TX.GRAMS))]
    texts = ["A bad  word", "", "a", "wordy é", None, "bad"]
    each = [TX.Inputs(pa.array([t], pa.string())).inputs(odds[0], odds[1:]) for t in texts]
    assert np.array_equal(TX.Inputs(pa.array(texts)).inputs(odds[0], odds[1:]), np.concatenate(each))
    assert np.array_equal(each[0][1], each[5][0])


@pytest.fixture(scope="module")
def model_and_data(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    return TX.train(docs, labels), docs, labels


def test_held_out_quality(model_and_data):
    model, docs, labels = model_and_data
    rows = TX.score(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), model).join(labels, "doc_id").filter("held_out").collect()
    y = np.array([r.toxic for r in rows])
    s = np.array([r.score for r in rows])
    order = s.argsort().argsort()
    n1 = y.sum()
    auc = (order[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(y) - n1))
    assert auc > 0.93
    assert (s[y == 1] >= 0.5).mean() > 0.85 and (s[y == 0] >= 0.5).mean() < 0.03


def test_sample_never_holds_held_out_rows(spark, model_and_data):
    _, docs, labels = model_and_data
    sample = TX.fit_sample(docs, labels, 300)
    held = {r.text[:TX.FIT_CHARS] for r in docs.filter(TX.held_out(F.col("doc_id"))).select("text").collect()}
    kept = {r.text[:TX.FIT_CHARS] for r in docs.filter(~TX.held_out(F.col("doc_id"))).select("text").collect()}
    assert len(sample) > 500 and all(t in kept for t, _ in sample)
    assert sum(t in held for t, _ in sample) < 60  # exact copies of other documents only


def test_score_odd_documents(spark, odd_docs, odd_rows, model_and_data):
    model = model_and_data[0]
    rows = TX.score(odd_docs, model).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in odd_rows)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert TX.score(odd_docs.limit(0), model).count() == 0
    null = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert [r.held_out for r in TX.score(null, model).collect()] == [False]


def test_one_class_or_no_labels(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = TX.train(odd_docs.select("doc_id", "text"), none)
    assert model.network is None
    assert {r.score for r in TX.score(odd_docs, model).collect()} == {model.prior}


def test_threshold_does_not_move_with_the_sample(spark):
    """One labelled row in ten is toxic; the mark stands in 60% of the toxic and
    10% of the clean rows, so a marked text is toxic with a chance of 0.4."""
    rng = np.random.default_rng(4)
    vocab, rows = [f"plain{i}" for i in range(300)], []
    for i in range(6_000):
        toxic = int(rng.random() < 0.1)
        words = rng.choice(vocab, 12).tolist()
        words[5] = "zzmark" if rng.random() < (0.6 if toxic else 0.1) else words[5]
        rows.append((i, " ".join(words), toxic))
    data = spark.createDataFrame(rows, "doc_id long, text string, toxic int").cache()
    docs, labels = data.select("doc_id", "text"), data.select("doc_id", "toxic")
    used = [t for i, _, t in rows if zlib.crc32(str(i).encode()) % 5]
    share, texts = np.mean(used), pa.array([t for _, t, _ in rows])
    marked = np.array(["zzmark" in t for _, t, _ in rows])
    assert 400 < sum(used) < 1_000
    for fit_docs in (10_000, 1_000, 300):  # binds on no class, on one, on both
        model = TX.train(docs, labels, fit_docs)
        score = model.score(texts)[0]
        assert abs(model.prior - share) < 0.01
        assert abs(score.mean() - share) < 0.04
        assert (score[marked] >= 0.5).mean() < 0.2
    assert TX.ratio_shift(labels, 10_000) == 0


def test_long_texts_are_drawn_over_their_whole_length(spark):
    words = [f"w{i:05d}" for i in range(10_000)]
    rows = [(1, " ".join(words)), (2, "short text"), (3, "x" * 7_001), (4, None)]
    got = {r.i: r.t for r in spark.createDataFrame(rows, "i int, x string").select("i", TX.drawn_text(F.col("x"), 6_000, 500).alias("t")).collect()}
    drawn = got[1].split()
    assert 5_000 < len(got[1]) <= 6_100 and set(drawn) <= set(words) and drawn == sorted(drawn)
    assert drawn[0] != words[0] or drawn[-1] > words[2_000]
    assert max(map(int, (w[1:] for w in drawn))) > 8_000 and min(map(int, (w[1:] for w in drawn))) < 2_000
    assert got[2] == "short text" and got[4] is None


def test_repeated_ids_bring_one_text_each(spark):
    docs = spark.createDataFrame([(i % 4, f"text number {i}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == 1)) for i in range(4)], "doc_id long, toxic int")
    assert len(TX.fit_sample(docs, labels)) <= 4
