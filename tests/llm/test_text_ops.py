"""Substring dedup, quality lines and decontamination against brute force."""
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwise.llm import decontaminate as DC
from ledgerwise.llm import quality_lines as QL
from ledgerwise.llm import substring_dedup as SD
from ledgerwise.llm.blocks import Hasher, Words

SPLIT = re.compile(r"[^\x20\x09-\x0d]+")


def words_of(t):
    return SPLIT.findall(t or "")


def lower(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def brute_substring(rows, k):
    starts = {}
    inf = 1 << 62
    for d, t in rows:
        w = words_of(t)
        for i in range(len(w) - k + 1):
            key = tuple(w[i:i + k])
            starts[key] = min(starts.get(key, inf), inf if d is None else d)
    out = []
    for d, t in rows:
        w = words_of(t)
        gone = set()
        for i in range(len(w) - k + 1):
            if starts[tuple(w[i:i + k])] < (inf if d is None else d):
                gone.update(range(i, i + k))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def by_text(rows):
    return sorted(rows, key=repr)


def test_words_and_hashes_match_python():
    import pyarrow as pa
    texts = ["a  b\tc", "", None, "éa b", "  x", "a b c", "\n", "b\x1cc \x0bd"]
    w = Words(pa.array(texts))
    assert w.counts.tolist() == [len(words_of(t)) for t in texts]
    joined, s, e = w.joined(w.buf)
    flat = [x for t in texts for x in words_of(t)]
    assert [joined[a:b].decode() for a, b in zip(s, e)] == flat
    h = Hasher(1)
    hw = h.words(w)
    assert all((hw[i] == hw[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(len(flat)))
    at = np.arange(len(flat) - 2)
    runs = h.runs(h.prefix(hw), at, at + 3)
    assert all((runs[i] == runs[j]) == (flat[i:i + 3] == flat[j:j + 3]) for i in at for j in at)


@pytest.mark.parametrize("window,anchor", [(50, 10), (8, 3), (12, 12)])
def test_substring_dedup_matches_brute_force(odd_docs, odd_rows, window, anchor):
    got = [tuple(r) for r in SD.substring_dedup(odd_docs, window, anchor).collect()]
    assert by_text(got) == by_text(brute_substring(odd_rows, window))


def test_substring_dedup_branches_and_null_ids(spark):
    import random
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for i in range(80):
        p = list(passage)
        if i % 3:
            p[rng.randrange(60)] = "edit"
        a, b = rng.randrange(0, 20), rng.randrange(40, 61)
        rows.append((i * 7 % 80, " ".join([rng.choice(vocab) for _ in range(rng.randrange(30))] + p[a:b] + [rng.choice(vocab)] * 9)))
    rows += [(None, " ".join(passage)), (None, " ".join(passage)), (5, "a b " * 60), (6, "b a " * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for k, m in ((15, 4), (20, 20)):
        got = [tuple(r) for r in SD.substring_dedup(df, k, m).collect()]
        assert by_text(got) == by_text(brute_substring(rows, k))


def test_spans_name_their_source(spark):
    rows = [(1, "a b c d e f g h i j"), (2, "x a b c d e f y"), (3, "c d e f g h q b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {tuple(r) for r in SD.repeated_spans(SD.repeated_edges(df, 4, 2), 4)
             .select("doc", "start", "end", "source_doc", "source_start").collect()}
    text = {d: t.split() for d, t in rows}
    assert {(s[0], i) for s in spans for i in range(s[1], s[2])} == (
        {(2, i) for i in range(1, 7)} | {(3, i) for i in range(12) if i != 6})
    for d, a, b, src, at in spans:
        assert src < d and text[d][a:b] == text[src][at:at + b - a]


def test_substring_dedup_empty(odd_docs):
    assert SD.substring_dedup(odd_docs.limit(0)).count() == 0


def brute_quality(t):
    t = t or ""
    w = words_of(t)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    rep = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dups = set(), 0
    for line in t.split("\n"):
        if words_of(line):
            dups += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dups, len(rep),
            len(w) < 10 or 100 * len(rep) > 20 * len(w))


def test_quality_base_matches_brute_force(odd_docs, odd_rows):
    got = [tuple(r) for r in QL.quality_rules(odd_docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()]
    assert by_text(got) == by_text([(d, *brute_quality(t)) for d, t in odd_rows])


def test_viterbi_is_the_best_path():
    from itertools import product
    rng = np.random.default_rng(0)
    for n in range(1, 9):
        model = QL.Crf(rng.normal(size=(2, 4)), rng.normal(size=(2, 2)))
        x = rng.integers(0, 2, (n, 4)).astype(float)

        def score(path):
            return (sum(model.emission[s] @ x[i] for i, s in enumerate(path))
                    + sum(model.transition[a, b] for a, b in zip(path, path[1:])))

        assert np.isclose(score(model.decode(x)), max(map(score, product((0, 1), repeat=n))))


def test_quality_verdict_follows_line_states(odd_docs):
    for r in QL.quality_rules(odd_docs, line_states=True).join(odd_docs.select("doc_id", "text").distinct(), "doc_id").collect():
        lines = (r.text or "").split("\n")
        assert len(lines) == len(r.line_states)
        content = sum(len(words_of(x)) for x, s in zip(lines, r.line_states) if s == 0)
        assert content == r.content_words
        assert all((s == -1) == (not words_of(x)) for x, s in zip(lines, r.line_states))
        assert r.kept == (not r.base_failed and content / max(1, r.n_words) >= 0.5)


def test_quality_learns_from_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = QL.quality_rules(docs, QL.train(docs, labels)).join(labels, "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept"), F.avg((F.col("kept") | F.col("base_failed")).cast("int")).alias("pass")).collect()
    got = {r.quality: r for r in got}
    assert got[1]["pass"] > 0.98 and got[0].kept < 0.1


def test_quality_without_labels_and_empty(spark, odd_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = QL.train(odd_docs.select("doc_id", "text"), labels)
    assert np.array_equal(model.emission, QL.DEFAULT.emission)
    assert QL.quality_rules(odd_docs.limit(0)).count() == 0
    good = QL.keep_good(odd_docs)
    assert good.columns == odd_docs.columns
    kept = QL.quality_rules(odd_docs).filter("kept").count()
    assert good.count() == kept > 10


def brute_leaks(docs, items, least=0.8):
    out = set()
    for item, text in set(items):
        iw = words_of(lower(text))
        if not iw:
            continue
        k = min(5, len(iw))
        want = Counter(tuple(iw[i:i + k]) for i in range(len(iw) - k + 1))
        for d, t in docs:
            w = words_of(lower(t))
            size = min(len(iw), len(w))
            if size < k:
                continue
            found = []
            for s in range(len(w) - size + 1):
                have = Counter(tuple(w[i:i + k]) for i in range(s, s + size - k + 1))
                both = sum((have & want).values())
                sim = both / (sum(have.values()) + sum(want.values()) - both)
                if sim >= least:
                    found.append((sim, s))
            if found:
                top = max(f[0] for f in found)
                out.add((d, item, min(s for f, s in found if f == top), len(found), top))
    return sorted(out)


def test_leaks_match_brute_force(spark, odd_docs, odd_rows):
    import random
    rng = random.Random(3)
    small = [(d, t) for d, t in dict(odd_rows).items() if len(t or "") < 3000]
    items = []
    for i in range(12):
        d, t = small[i * 4]
        w = words_of(t)
        items.append((i, " ".join(w[5:5 + rng.choice([3, 6, 20, 40])])))
    long = next(t for _, t in small if len(words_of(t)) > 120)
    edited = words_of(long)[:100]
    edited[50] = "changed"
    items += [(20, " ".join(edited)), (21, ""), (22, None), (23, "one TWO"), (24, "the the the the the the the"), (20, " ".join(edited))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    df = odd_docs.filter(F.col("doc_id").isin([d for d, _ in small])).dropDuplicates(["doc_id"])
    got = sorted(tuple(r) for r in DC.leaks(df, bench).collect())
    want = brute_leaks(small, [(i, t) for i, t in items if t])
    assert got == want and len({x[1] for x in got}) > 8
    bad = {x[0] for x in want}
    clean = DC.remove_contaminated(df, bench)
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in small} - bad


def test_leaks_in_item_blocks_and_empty(spark, odd_docs, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted(tuple(r) for r in DC.leaks(docs, bench).collect())
    monkeypatch.setattr(DC, "BLOCK_ITEMS", 16)
    assert sorted(tuple(r) for r in DC.leaks(docs, bench).collect()) == want and want
    assert DC.leaks(odd_docs.limit(0), bench).count() == 0
    assert DC.leaks(odd_docs, bench.limit(0)).count() == 0
    assert DC.remove_contaminated(odd_docs, bench.limit(0)).count() == odd_docs.count()


def test_leaks_before_a_run_of_one_word(spark):
    """Passages at the start of a text, followed by one repeated word, at a similarity just above 0.8."""
    rng = np.random.default_rng(8)
    items, docs = [], []
    for i in range(12):
        words = [f"w{rng.integers(10**6)}" for _ in range(200)]
        items += [(i, " ".join(words)), (100 + i, " ".join(words[:179] + ["tail"] * 21))]
        docs += [(i, " ".join(words[:180] + ["the"] * (20 + 5 * i))), (100 + i, " ".join(words))]
    got = DC.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = brute_leaks(docs, items)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 36


def test_fingerprints_number_the_occurrences():
    rng = np.random.default_rng(3)
    h = rng.integers(1, 2**63, 6, dtype=np.uint64)[rng.integers(0, 6, 90)]
    run = np.repeat([1, 2, 5], [40, 7, 43])
    size = np.repeat([9, 7, 20], [40, 7, 43])
    start = np.array([0, 1, 2, 17, 31, 40, 47, 50, 69, 70])
    got = DC.window_fingerprints(h, run, size, start)
    for s, fp in zip(start, got):
        seen, elements = Counter(), []
        for x in h[s:s + size[s]]:
            seen[x] += 1
            elements.append(DC.scramble(np.array([x]) ^ DC.scramble(np.array([seen[x]], dtype=np.uint64))))
        first = np.concatenate(elements)
        both = np.column_stack([first, DC.scramble(first ^ DC._SALT)])
        bits = np.unpackbits(both.view(np.uint8), axis=1, bitorder="little")
        assert np.array_equal(np.packbits(2 * bits.sum(axis=0) > size[s], bitorder="little"), fp)


def test_ball_tables_find_all_within_radius():
    rng = np.random.default_rng(1)
    c = DC.ItemClass(10)
    for i in range(70):
        c.ids.append(i)
        c.counts.append(Counter())
        c.prints.append(rng.integers(0, 256, DC.CHUNKS, dtype=np.uint8))
    c.finish()
    base = np.unpackbits(c.prints, axis=1)
    queries = np.concatenate([np.packbits(base ^ (rng.random(base.shape) < p), axis=1) for p in (0.05, 0.2, 0.3, 0.35)])
    want = {(j, i) for j in range(70) for i in range(len(queries))
            if np.unpackbits(queries[i] ^ c.prints[j]).sum() <= DC.RADIUS}
    got = {(j, int(i)) for j, at in c.candidates(queries) for i in at}
    assert got == want and len(want) > 100


def test_crf_gradients_match_differences():
    """The likelihood by enumeration of all paths, against the forward-backward gradients."""
    from itertools import product
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2, (3, 4, 2)).astype(float)
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 0, 0, 0]], dtype=float)
    gold = rng.integers(0, 2, (3, 4))
    truth, weight = np.eye(2)[gold] * mask[:, :, None], np.array([0.2, 0.5, 0.3])
    w, t = rng.normal(size=(2, 2)), rng.normal(size=(2, 2))

    def likelihood():
        total = 0.0
        for i in range(3):
            n = int(mask[i].sum())
            score = lambda p: sum(w[s] @ x[i, j] for j, s in enumerate(p)) + sum(t[a, b] for a, b in zip(p, p[1:]))  # noqa: B023,E731
            total += weight[i] * (score(gold[i, :n]) - np.log(sum(np.exp(score(p)) for p in product((0, 1), repeat=n))))
        return total

    for value, grad in zip((w, t), QL._crf_gradients(w, t, x, mask, truth, weight)):
        for i in np.ndindex(value.shape):
            old, both = value[i], []
            for shift in (1e-5, -1e-5):
                value[i] = old + shift
                both.append(likelihood())
            value[i] = old
            assert abs((both[0] - both[1]) / 2e-5 - grad[i]) < 1e-6


def test_training_lines_come_from_the_whole_text():
    seen = set()
    for seed in range(200):
        codes = np.concatenate(([seed], np.arange(1, 500)))
        run = QL._run_of(codes, 64)
        assert len(run) == 64 and (np.diff(run[1:]) == 1).all()
        seen.add(int(run[-1]))
    assert min(seen) < 130 and max(seen) > 430
    assert QL._run_of(np.arange(5), 64).tolist() == [0, 1, 2, 3, 4]


def test_training_sample_takes_one_row_of_an_id(spark):
    docs = spark.createDataFrame([(i % 3, f"a line of row {i}") for i in range(90)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(3)], "doc_id long, quality int")
    assert len(QL.fit_sample(docs, labels)) == 3
