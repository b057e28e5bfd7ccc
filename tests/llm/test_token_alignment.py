"""Cross-tokenizer alignment against plain loops over byte ranges."""
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from ledgerwise.llm import token_alignment as TA

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(A))
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(B))


def plain_tokens(libraries, text):
    """[(id, start, end)] of both, by the libraries' own decoding of single tokens."""
    t, m = libraries
    if not text:
        return [], []
    want, out = (" " + text).encode(), []
    letters = TA._byte_letters()
    for ids, raw in ((t.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(letters[c] for c in t.id_to_token(i))),
                     (m.encode(text), lambda i: bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i)
                      else m.id_to_piece(i).replace("▁", " ").encode())):
        at, spans = 0, []
        for i in ids:
            spans.append((i, at, at + len(raw(i))))
            at += len(raw(i))
        if b"".join(raw(i) for i in ids) != want:
            return [], []
        out.append(spans)
    return out


def plain_rows(libraries, docs):
    each, pairs = [], Counter()
    for i, text in docs:
        a, b = plain_tokens(libraries, text)
        ends = {e for _, _, e in a} & {e for _, _, e in b}
        links = [(x, y) for x, _, e in a for y, _, f in b if e == f] if len(a) < 300 else \
            [(x, {f: y for y, _, f in b}[e]) for x, _, e in a if e in ends]
        groups, lo = [], 0
        for e in sorted(ends):
            groups.append(",".join(str(x) for x, _, f in a if lo < f <= e) + "|" + ",".join(str(x) for x, _, f in b if lo < f <= e))
            lo = e
        pairs.update(links)
        each.append((i, len(a), len(b), len(ends), links, ";".join(groups)))
    top = Counter()
    for (_, y), n in pairs.items():
        top[y] = max(top[y], n)
    return sorted(map(repr, [(i, na, nb, ng, len(ls), sum(pairs[p] == top[p[1]] for p in ls), sum(pairs[p] for p in ls),
                              hashlib.sha256(g.encode()).hexdigest() if na else "") for i, na, nb, ng, ls, g in each]))


TEXTS = ["Hello world, naïve Café", "a", " ", "\n\n\t x", "<|endoftext|> and <s></s> <unk>", "x▁y", "漢字かな交じり文", "é" * 20,
         "don't  stop   believing", "0123456789 3.14", "\x00\x01 nul", "🙂🙃 emoji", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", None, "",
         "Hello world, naïve Café", "the <0x41> byte", " lead", "trail ", "a  b c", "a \n b", "tab\t x y", "x\u00a0 y\u3000z \x1c q",
         "a b \u2581 c", "\ufffd b a"]


def test_against_plain_loops(spark, libraries):
    rows = list(enumerate(TEXTS)) + [(3, "twice"), (3, "twice"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = TA.align(docs, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == plain_rows(libraries, rows)


def test_odd_documents(spark, libraries, odd_docs, odd_rows):
    some = [(i, t if t is None or len(t) < 3_000 else t[:3_000]) for i, t in odd_rows]
    docs = spark.createDataFrame(some, "doc_id long, text string")
    assert sorted(repr(tuple(r)) for r in TA.align(docs, A, B).collect()) == plain_rows(libraries, some)
    whole = TA.align(odd_docs, A, B).collect()  # with very long texts and clashing columns
    assert sorted(r.doc_id for r in whole) == sorted(i for i, _ in odd_rows)
    assert all((r.n_a > 0) == bool(t) for r, t in [(r, dict(odd_rows)[r.doc_id]) for r in whole])


def test_empty_table_and_bad_bytes(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert TA.align(docs, A, B).count() == 0
    bad = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    assert [tuple(r) for r in TA.align(bad, A, B).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("kind", ["overlap", "end", "group"])
def test_links_of_each_kind(spark, libraries, kind):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    want = Counter()
    for i, text in enumerate(TEXTS):
        a, b = plain_tokens(libraries, text)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        group = lambda e: next(k for k, c in enumerate(cuts) if e <= c)
        for p, (x, s, e) in enumerate(a):
            for q, (y, u, v) in enumerate(b):
                shared = min(e, v) - max(s, u)
                w = {"overlap": max(shared, 0), "end": int(e == v), "group": int(group(e) == group(v))}[kind]
                if w:
                    want[i, p, q, x, y, w] += 1
    got = Counter(tuple(r) for r in TA.token_links(docs, A, B, kind).collect())
    assert got == want


def test_row_products_match_dense(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(TA, "PRODUCT_ROWS", 7)
    for _ in range(30):
        n, k, m = rng.integers(0, 9, 3) + (0, 1, 1)
        x, y = rng.random((n, k)) < 0.4, rng.random((k, m)) < 0.4
        csr = lambda d: TA.Csr(np.concatenate(([0], np.cumsum(d.sum(1)))), np.flatnonzero(d.ravel()) % d.shape[1], d.shape[1])
        out = np.zeros((n, m), int)
        for i, j, v in TA.row_products(csr(x), csr(y)):
            out[i, j] += v
        assert np.array_equal(out, x.astype(int) @ y.astype(int))
        assert np.array_equal(csr(x).transposed().cols, csr(x.T).cols)


def test_pairs_are_bounded_by_the_vocabularies(spark):
    a, b = TA.vocabulary(A), TA.vocabulary(B)
    assert TA.pair_bound(a, b) < 1_000_000
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    raw = (a.bytes.to_pylist(), b.bytes.to_pylist())
    for r in TA.pair_counts(TA.aligned(docs, A, B), A, B).collect():
        x, y = raw[0][r.code // b.size], raw[1][r.code % b.size]
        assert x.endswith(y) or y.endswith(x)


def test_chunks_and_whole_texts_agree(monkeypatch):
    a, b = TA.vocabulary(A), TA.vocabulary(B)
    texts = [(t or "").encode() for t in TEXTS] * 2 + [b"a\xff b", b""]
    assert TA.Aligner(a, b).local
    by_chunk, whole = TA.Aligner(a, b), TA.Aligner(a, b)
    whole.local = False
    monkeypatch.setattr(TA, "MEMO_CHUNKS", 20)
    for lo in range(0, len(texts), 5):
        got, want = by_chunk.block(texts[lo:lo + 5]), whole.block(texts[lo:lo + 5])
        assert np.array_equal(got[0], want[0]) and got[1] == want[1] and all(map(np.array_equal, got[2], want[2]))
