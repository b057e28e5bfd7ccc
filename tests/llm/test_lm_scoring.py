"""The log-bilinear scores: gradients, plain counts and sums, a proper distribution, held-out gain."""
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerwise.llm import lm_scoring as LM

SCHEMA = "doc_id long, text string"
HOW = dict(frequent=5, suffixes=7, steps=30)


def plain_tokens(text):
    raw = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return raw + [b""]


def plain_held(i, folds=10):
    return zlib.crc32(("" if i is None else str(i)).encode()) % folds == 0


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = LM.LogBilinear.new(np.full(6, 1 / 6), size=4)
    far, near, target, noise = rng.integers(0, 7, 9), rng.integers(0, 7, 9), rng.integers(0, 6, 9), rng.integers(0, 6, 5)
    log = np.log(5 * rng.dirichlet(np.ones(6)))
    grads = net.gradients(far, near, target, noise, log)[1]
    for name, value in net.par.items():
        for _ in range(6):
            i = tuple(rng.integers(0, s) for s in value.shape)
            old, loss = value[i], []
            for shift in (1e-5, -1e-5):
                value[i] = old + shift
                loss.append(net.gradients(far, near, target, noise, log)[0])
            value[i] = old
            assert abs((loss[0] - loss[1]) / 2e-5 - grads[name][i]) < 1e-7


def plain_scores(rows, model):
    """Counts by a dictionary, class scores by loops, from the fitted vectors."""
    c = Counter(t for i, x in rows if not plain_held(i) for t in plain_tokens(x))
    n, v, p = sum(c.values()), len(c), model.network.par
    k, names = model.network.classes, model.classes.frequent

    def cls(t):
        return 0 if t == b"" else 1 + names.index(t) if t in names else int(model.classes.of(pa.array([t]))[0])

    rest = [t for t in c if cls(t) > len(names)]
    once, twice = sum(c[t] == 1 for t in rest), sum(c[t] == 2 for t in rest)
    d = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
    out = []
    for i, x in rows:
        far = near = k
        base = total = 0.0
        for t in plain_tokens(x):
            r = p["R"][near] @ p["C1"] + p["R"][far] @ p["C2"]
            s = [float(r @ p["Q"][j] + p["b"][j]) for j in range(k)]
            j = cls(t)
            total += (s[j] - math.log(sum(map(math.exp, s)))) / math.log(10)
            if j > len(names):
                own = [u for u in rest if cls(u) == j]
                size = sum(c[u] for u in own)
                total += math.log10((c[t] - d) / size if c[t] else d * len(own) / size if size else 1.0)
            base += math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1)))
            far, near = near, j
        ts = plain_tokens(x)
        out.append((i, plain_held(i), len(ts), sum(c[t] > 0 for t in ts), n, base, total))
    return out


ROWS = [(i, t) for i, t in enumerate(
    ["The cat sat on the mat.", "a cat, the DOG and the cat", "", None, "dogs  sat\n\ton mats", "The the THE the", "élan vital çà",
     "one two three four five six", "the cat sat", "the cat sat on a mat"] * 3)] + [(None, "the cat never seen"), (7, "unseen words here"), (7, "the cat")]


@pytest.mark.parametrize("block", [LM.BLOCK_BYTES, 40])
def test_against_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(LM, "BLOCK_BYTES", block)
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit(c) for c in ("block", "pos", "token", "c", "held", "sizes")})
    coded = LM.coded_blocks(docs, LM.held_out(F.col("doc_id")))
    model = LM.train(coded, LM.token_counts(coded), **HOW)
    want = plain_scores(ROWS, model)
    got = LM.score(docs, **HOW)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    rows = sorted(map(tuple, got.collect()), key=order)
    want.sort(key=order)
    assert [r[:5] for r in rows] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in rows], [r[5:] for r in want], atol=1e-9)


def test_probabilities_add_up_to_one(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    coded = LM.coded_blocks(docs, LM.held_out(F.col("doc_id")))
    counts = LM.token_counts(coded)
    model = LM.train(coded, counts, **HOW)
    known = [(bytes(r.token), r.c) for r in counts.filter("c > 0").collect()]
    k = model.classes.of(pa.array([t for t, _ in known]))
    within = 10.0 ** model.within(np.array([c for _, c in known]), k)
    opens = np.arange(1 + len(model.classes.frequent), model.classes.n)
    unseen = 10.0 ** model.within(np.zeros(len(opens), np.int64), opens)
    for far, near in ((model.classes.n, model.classes.n), (0, 1), (2, 3)):
        p = np.exp(model.network.log_probabilities(np.array([far]), np.array([near]))[0])
        assert abs((p[k] * within).sum() + (p[opens] * unseen).sum() - 1) < 1e-12


def test_all_training_rows_are_counted(spark, odd_docs, odd_rows):
    coded = LM.coded_blocks(odd_docs, LM.held_out(F.col("doc_id")))
    want = Counter(t for i, x in odd_rows if not plain_held(i) for t in plain_tokens(x))
    got = {bytes(r.token): r.c for r in LM.token_counts(coded).collect() if r.c}
    long = [t for t in want if len(t) > LM.LONG_TOKEN]
    assert long and all(t not in got for t in long)
    assert sorted(got.values()) == sorted(want.values())
    assert {t: n for t, n in got.items() if not t.startswith(b" ")} == {t: n for t, n in want.items() if len(t) <= LM.LONG_TOKEN}
    classes = LM.Classes(LM.frequent_tokens(LM.token_counts(coded), 9), 11)
    assert LM.class_triples(coded, classes)[1].sum() == sum(want.values()) == LM.class_sums(LM.token_counts(coded), classes)["n"].sum()
    out = LM.score(odd_docs, **HOW)
    assert sorted((r.doc_id, r.n_tokens) for r in out.collect()) == sorted((i, len(plain_tokens(x))) for i, x in odd_rows)


def test_empty_table_and_no_training_rows(spark):
    assert LM.score(spark.createDataFrame([], SCHEMA), **HOW).count() == 0
    only = next(i for i in range(99) if plain_held(i))
    got = LM.score(spark.createDataFrame([(only, "a b")], SCHEMA), **HOW).collect()
    assert got[0].n_known == got[0].train_tokens == 0 and got[0].base_score == 0.0 and np.isfinite(got[0].score)


def test_held_out_texts_score_above_the_base(spark):
    out = LM.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    held = out.filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert held.s / held.n > held.b / held.n + 0.2
    assert {(r.doc_id, r.held_out) for r in out.collect()} == {(r.doc_id, plain_held(r.doc_id)) for r in out.collect()}


def test_word_order_matters(spark):
    """A corpus where each word follows another: texts in that order score higher."""
    rows = [(i, " ".join("alpha beta gamma delta".split()[(i + j) % 4] for j in range(40))) for i in range(60)]
    docs = spark.createDataFrame(rows + [(1000, "alpha beta gamma delta alpha beta"), (1001, "beta alpha delta alpha beta gamma")], SCHEMA)
    got = {r.doc_id: r for r in LM.score(docs, frequent=4, suffixes=2, steps=600).collect()}
    assert got[1000].score > got[1001].score + 1.5 and abs(got[1000].base_score - got[1001].base_score) < 0.5
