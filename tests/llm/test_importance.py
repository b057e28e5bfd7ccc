"""Importance resampling against a plain version: windows, buckets, gains, draw."""
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwise.llm import importance as IM

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_buckets(text, lo, hi, k):
    w = plain_words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % k for n in range(lo, hi + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, lo, hi, k, min_words, percent, seed):
    s, t = np.zeros(k, int), np.zeros(k, int)
    for _, x in docs:
        np.add.at(s, plain_buckets(x, lo, hi, k), 1)
    for x in target:
        np.add.at(t, plain_buckets(x, lo, hi, k), 1)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (int(s.sum()) + k) / ((s[b] + 1) * (int(t.sum()) + k)))) for b in range(k)]
    out = []
    for i, x in docs:
        b = plain_buckets(x, lo, hi, k)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[j] for j in b)
        out.append([i, len(plain_words(x)), len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[3], r[2]))
    n = len(able) * percent // 100
    ranks = {id(r): j + 1 for j, r in enumerate(able[:n])}
    return sorted(map(repr, [tuple(r) + (ranks.get(id(r)),) for r in out]))


@pytest.mark.parametrize("lo,hi,k", [(1, 1, 10_000), (1, 3, 97), (2, 2, 70_000)])
def test_against_plain_version(spark, odd_docs, odd_rows, lo, hi, k):
    target = ["The stand of 漢字 with", None, "", "émo ça naïve x1 the of and to in", "the of and"]
    bench = spark.createDataFrame([(x, 1) for x in target], "text string, doc_id int")
    got = IM.resample(odd_docs, bench, lo, hi, k, min_words=20, percent=30, seed=7)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == plain(odd_rows, target, lo, hi, k, 20, 30, 7)


def test_null_ids_and_empty_tables(spark):
    schema = "doc_id long, text string"
    rows = [(None, "a b c"), (None, "a b c"), (3, "A b, C"), (4, None)]
    docs, none = spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)
    got = IM.resample(docs, none.select("text"), min_words=1, percent=100, seed=1)
    assert sorted(repr(tuple(r)) for r in got.collect()) == plain(rows, [], 1, 1, 10_000, 1, 100, 1)
    assert IM.resample(none, docs.select("text")).count() == 0


def test_long_text_is_cut_without_a_trace(monkeypatch):
    text = "\x00One two,THREE  漢字-é four\n" * 50 + "x" * 300 + " tail one two"
    whole = IM.Featurizer(1, 3, 60_000).text(text.encode())
    monkeypatch.setattr(IM, "PIECE_BYTES", 7)
    cut = IM.Featurizer(1, 3, 60_000).text(text.encode())
    assert cut[0] == whole[0] and sorted(cut[1]) == sorted(whole[1]) == sorted(plain_buckets(text, 1, 3, 60_000))


def test_offsets_are_those_of_the_words():
    text = "é a1 漢字,b"
    assert [(w, text[lo:hi]) for w, (lo, hi) in IM._splitter().pre_tokenize_str(text)] == [(w, w) for w in plain_words(text)]


def test_drawn_rows_keep_their_columns(spark, odd_docs):
    bench = spark.createDataFrame([("the of and to in that it",)], "text string")
    how = dict(min_words=20, percent=25, seed=3)
    ids = {r.doc_id for r in IM.resample(odd_docs, bench, **how).filter(F.col("rank").isNotNull()).collect()}
    got = IM.drawn(odd_docs, bench, **how)
    assert got.columns == odd_docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in odd_docs.collect() if r.doc_id in ids)
