"""Small operators against brute force: SimHash classes, token counts, line dedup, mixing."""
import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerwise.llm import line_dedup as LD
from ledgerwise.llm import mixing as MX
from ledgerwise.llm import simhash_neardup as SH
from ledgerwise.llm import token_counts as TC

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def lower(b):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in b)


def brute_simhash(text, k=3):
    words = WORD.findall(lower((text or "").encode()))
    sh = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_classes(fps, bits):
    """fps: list of (id, fp) -> {index: smallest id}."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= bits:
                parent[find(i)] = find(j)
    low = defaultdict(lambda: math.inf)
    for i, (d, _) in enumerate(fps):
        low[find(i)] = min(low[find(i)], d)
    return [low[find(i)] for i in range(len(fps))]


def test_simhash_matches_brute_force(odd_docs, odd_rows):
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in SH.near_duplicates(odd_docs).select(
        "doc_id", SH.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id").collect())
    fps = [(d, brute_simhash(t)) for d, t in odd_rows]
    want = sorted((d, f"{f:016x}", c) for (d, f), c in zip(fps, brute_classes(fps, 2)))
    assert got == want
    assert {d for d, f, _ in got if f == "0" * 16} >= {100, 101, 102}


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_connect_all_pairs_within_radius(spark, bits):
    import random
    rng = random.Random(bits)
    centres = [rng.getrandbits(64) for _ in range(30)]
    fps = set(centres)
    for c in centres:
        for _ in range(12):
            f = c
            for _ in range(rng.randint(1, 4)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = SH.links(df, bits)
    for r in edges.collect():
        assert bin((r.u ^ r.v) & (1 << 64) - 1).count("1") <= bits
    from ledgerwise.llm.graph import components
    root = {r.node: r.root for r in components(edges).collect()}
    want = brute_classes(list(zip(signed, fps)), bits)
    assert [root.get(f, f) for f in signed] == want


def test_simhash_dense_cluster_is_linear(spark):
    """All fingerprints within a 9-bit cube: one class, at most 65 links a bucket."""
    df = spark.createDataFrame([(x,) for x in range(512)], "fp long")
    edges = SH.links(df).count()
    assert edges <= 512 * 65


def test_keep_one_drops_only_copies(odd_docs):
    found = {r.doc_id: r.component_id for r in SH.near_duplicates(odd_docs).collect()}
    kept = {r.doc_id for r in SH.keep_one(odd_docs).collect()}
    assert kept == {d for d, c in found.items() if d == c}


def test_near_duplicates_with_null_ids(spark):
    rows = [(None, "a b c d"), (7, "A b  c D"), (3, "a b c d"), (None, "other words here now")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in SH.near_duplicates(df).collect()}
    assert got == {(None, 3), (7, 3), (3, 3), (None, None)}
    assert sorted(str(r.doc_id) for r in SH.keep_one(df).collect()) == ["3", "None", "None"]


def test_keep_one_with_an_id_in_two_classes(spark):
    """Id 5 is a copy of 1 in one class and the smallest id of another one."""
    a, b = "some words of the first text here", "quite other things stand in that second one"
    df = spark.createDataFrame([(1, a, "x"), (5, a, "x"), (5, b, "x"), (8, b, "x"), (8, a, "x")], "doc_id long, text string, fp string")
    kept = SH.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, a), (5, b)]


def test_components_of_a_path(spark):
    from ledgerwise.llm.graph import components
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "u long, v long")
    got = {(r.node, r.root) for r in components(edges).collect()}
    assert got == {(i, 0) for i in range(301)}


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts_match_the_library(spark, odd_docs, odd_rows, name):
    import public_tokenizers
    path = public_tokenizers.path(name)
    extra = [(900, "a <|endoftext|> b<|endoftext|>c <|startoftext|>́x I'LL don't ÉCOLE ΣΣ ẛ̣ é"),
             (901, "x y z \x1c\x1f\x85 ​q"), (902, "<|endof text|> 12345 ### $$$ ..."), (903, "İ İ ﬁ")]
    if name.endswith(".model"):
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda s: len(m.encode(s))
    else:
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        count = lambda s: len(t.encode(s, add_special_tokens=False))
    df = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    assert isinstance(TC.counter(path), TC.WordEndCounter) == (name == "word_bpe_49k.json")
    got = sorted(tuple(r) for r in TC.token_counts(df, name).collect())
    want = sorted((d, len((t or "").encode()), count(t or "")) for d, t in [*odd_rows, *extra])
    assert got == want


def test_token_groups_cover_the_text(monkeypatch):
    monkeypatch.setattr(TC, "GROUP_BYTES", 10)
    monkeypatch.setattr(TC, "MEMO_PIECES", 3)
    import public_tokenizers
    monkeypatch.setattr(TC, "MEMO_PIECE_BYTES", 6)
    c = TC.WordEndCounter(public_tokenizers.path("word_bpe_49k.json"), lower=True)
    text = "alpha beta gammagammagamma  delta\nepsilon zeta" * 5
    want = len(c.tokenizer.encode(text, add_special_tokens=False))
    for _ in range(3):
        assert c.count(text.encode()) == want
        assert c.count_all([text.encode(), b"", b"alpha  beta ALPHA"]) == [want, 0, 3]


def brute_lines(rows, min_chars=40, min_docs=5):
    def key(line):
        return lower(line.strip("\x20\t\n\x0b\x0c\r").encode()).decode()

    held = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (len(key(x)) >= min_chars and len(held[key(x)]) >= min_docs and max(held[key(x)]) != d)]
        out.append((d, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("n_batches,fanout", [(1, 2), (4, 2), (7, 3)])
def test_line_dedup_matches_brute_force(odd_docs, odd_rows, n_batches, fanout):
    df = LD.drop_repeated_lines(odd_docs, n_batches=n_batches, fanout=fanout)
    assert df.columns == [*odd_docs.columns, "n_lines", "n_dropped"]
    got = sorted(tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped",
                                             F.sha2(F.coalesce("text", F.lit("")), 256)).collect())
    assert got == brute_lines(odd_rows)
    assert sum(x[2] for x in got) > 10


def test_line_dedup_null_id_and_empty_table(spark, odd_docs):
    line = "x" * 45
    df = spark.createDataFrame([(None, line), (1, line), (2, line), (3, line), (4, line + "\n" + line)], "doc_id long, text string")
    got = {r.doc_id: r.n_dropped for r in LD.drop_repeated_lines(df).collect()}
    assert got == {None: 1, 1: 1, 2: 1, 3: 1, 4: 0}
    assert LD.drop_repeated_lines(odd_docs.limit(0)).count() == 0
    assert LD.dedup_documents(odd_docs).columns == odd_docs.columns


def test_line_dedup_has_no_python(odd_docs):
    plan = LD.drop_repeated_lines(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def brute_poisson(u, rate):
    k, p, total = 0, math.exp(-rate), math.exp(-rate)
    while total <= u and p > 0:
        k += 1
        p *= rate / k
        total += p
    return k


def test_mixing_matches_brute_force(odd_docs):
    weights = MX.square_root_weights(odd_docs.select("source"))
    rows = odd_docs.select("doc_id", "source").collect()
    n = Counter(r.source for r in rows)
    w = {s: math.sqrt(c) for s, c in n.items()}
    want = Counter()
    for r in rows:
        u = int(hashlib.md5(f"11:{r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        for c in range(brute_poisson(u, w[r.source] / sum(w.values()) * len(rows) / n[r.source])):
            want[r.doc_id, c + 1] += 1
    out = MX.poisson_mix(odd_docs, weights)
    assert out.columns == [*odd_docs.columns, "copy", "shuffle_key"]
    assert Counter((r.doc_id, r.copy) for r in out.collect()) == want


def test_mixing_reaches_targets_and_large_rates(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"),
                                      F.when(F.col("id") < 10, "rare").when(F.col("id") < 15_000, "hot").otherwise("mid").alias("source"))
    w = spark.createDataFrame([("rare", 2.0), ("hot", 1.0), ("mid", 1.0), ("absent", None)], "source string, weight double")
    got = {r.source: r["count"] for r in MX.poisson_mix(docs, w).groupBy("source").count().collect()}
    assert abs(got["rare"] - 10_000) < 500 and abs(got["hot"] - 5_000) < 300 and abs(got["mid"] - 5_000) < 300
    assert MX.poisson_mix(docs, w.filter("weight > 5")).count() == 0
    assert MX.poisson_mix(docs.limit(0), w).count() == 0


def test_empty_tables(odd_docs):
    none = odd_docs.limit(0)
    assert SH.near_duplicates(none).count() == 0
    assert TC.token_counts(none, "word_bpe_49k.json").count() == 0


def test_steps_are_linear_and_exact_at_any_rate(spark):
    import math
    import time
    rates = [0.001, 0.7, 30.0, 1_000.0, 1e6]
    df = spark.createDataFrame([(f"s{i}", r) for i, r in enumerate(rates)], "source string, rate double")
    start = time.time()
    got = {r.source: r for r in MX.poisson_steps(df).collect()}
    assert time.time() - start < 30
    for i, rate in enumerate(rates):
        low, steps = got[f"s{i}"].low, got[f"s{i}"].steps
        total, want = 0.0, []
        for k in range(low, low + len(steps)):
            total += math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
            want.append(total)
        near = 1e-9 + 1e-13 * rate  # the logarithms of terms near rate * log(rate) end there
        assert max(abs(a - b) for a, b in zip(steps, want)) < near and abs(steps[-1] - 1) < near
        for u in (0.0, 1e-12, 0.25, 0.5, 0.999999, steps[0], steps[-2]):
            row = spark.createDataFrame([(u, low, steps)], "u double, low long, steps array<double>")
            n = row.select(MX.count_of(F.col("u"), F.col("low"), F.col("steps"), len(steps)).alias("n")).first().n
            assert n == low + sum(x <= u for x in steps)
