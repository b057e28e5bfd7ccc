"""The pipeline against the composition of brute-force stages."""
import hashlib
import math
from collections import Counter

import corpus_pipeline as CP
from ledgerwise.llm import quality_lines as QL

from test_simple_ops import brute_classes, brute_lines, brute_poisson, brute_simhash, lower
from test_text_ops import brute_leaks, brute_quality

D = "/root/testdata/sf0.001"


def brute_line_text(rows):
    """Texts after line dedup; digests are checked against the line tests' version."""
    from collections import defaultdict
    key = lambda x: lower(x.strip("\x20\t\n\x0b\x0c\r").encode()).decode()
    held = defaultdict(set)
    for d, t in rows:
        for x in t.split("\n"):
            held[key(x)].add(d)
    out = [(d, "\n".join(x for x in t.split("\n") if len(key(x)) < 40 or len(held[key(x)]) < 5 or max(held[key(x)]) == d)) for d, t in rows]
    digests = {r[0]: r[3] for r in brute_lines(rows)}
    assert all(digests[d] == hashlib.sha256(t.encode()).hexdigest() for d, t in out)
    return out


def test_stages():
    assert [n for n, _ in CP.STAGES] == ["quality_rules", "line_dedup", "simhash_neardup", "decontamination", "mixing"]


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    source = {r.doc_id: r.source for r in docs.collect()}
    verdict = {r.doc_id: r.kept for r in QL.quality_rules(docs, QL.train(docs, spark.read.parquet(f"{D}/labels.parquet"))).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if verdict[r.doc_id]]
    assert all(not brute_quality(t)[-1] for _, t in rows)
    rows = brute_line_text(rows)
    classes = brute_classes([(d, brute_simhash(t)) for d, t in rows], 2)
    rows = [(d, t) for (d, t), c in zip(rows, classes) if d == c]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    bad = {x[0] for x in brute_leaks(rows, items)}
    rows = [(d, t) for d, t in rows if d not in bad]
    n = Counter(source[d] for d, _ in rows)
    total = sum(math.sqrt(c) for c in n.values())
    want = Counter()
    for d, t in rows:
        u = int(hashlib.md5(f"11:{d}".encode()).hexdigest()[:13], 16) / 2**52
        s = source[d]
        for c in range(brute_poisson(u, math.sqrt(n[s]) / total * len(rows) / n[s])):
            want[d, c + 1, t] += 1
    out = CP.run(spark, D)
    assert out.columns == [*docs.columns, "copy", "shuffle_key"]
    assert Counter((r.doc_id, r.copy, r.text) for r in out.collect()) == want
    assert len(bad) > 0 and len(rows) < len(source)


def test_stages_keep_columns_and_odd_rows(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in CP.STAGES[:-1]:
        out = stage(spark, docs, D)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), D).count() == 0
        docs = out
    assert CP.STAGES[-1][1](spark, docs, D).count() > 0
