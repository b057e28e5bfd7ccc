"""Token counts of whole texts with a public tokenizer, lengths only.

Texts arrive in Arrow batches and are cut into groups of about equal bytes; a
long text is cut at safe boundaries, so no call ever holds more than one group.

A boundary is safe where the library itself cuts before it merges anything.
For a pre-tokenizer that drops white space (the word-end vocabulary) every
space, tab and line end is one: no merge, normal form or added token spans it.
A group's text is then a bag of such pieces, and each distinct piece is encoded
once per group (one batch call) or remembered from an earlier group; the memory
holds up to ``MEMO_PIECES`` pieces of up to ``MEMO_PIECE_BYTES``, and when it is full
only the short ones stay.

For the other tokenizers a space belongs to a token, so texts are encoded
whole.

Results in odd cases: a null or empty text has 0 bytes and 0 tokens; repeated
rows are counted each; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwise.llm.blocks import blocks, byte_view

GROUP_BYTES = 1 << 20
MEMO_PIECES = 600_000
MEMO_PIECE_BYTES = 100
SHORT_PIECE_BYTES = 8


class WordEndCounter:
    """Counts with a Hugging Face tokenizer whose pre-tokenizer drops white space
    and whose normalizer lower-cases (``lower``)."""

    def __init__(self, path: str, lower: bool):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.lower = lower
        self.memo: dict[bytes, int] = {}

    def _encode(self, pieces: list[bytes]) -> dict[bytes, int]:
        """Token counts of distinct pieces, in calls of about equal bytes."""
        out: dict[bytes, int] = {}
        lo = 0
        while lo < len(pieces):
            hi, size = lo, 0
            while hi < len(pieces) and (hi == lo or size + len(pieces[hi]) <= GROUP_BYTES):
                size += len(pieces[hi])
                hi += 1
            part = pieces[lo:hi]
            found = self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in part], add_special_tokens=False)
            out.update(zip(part, map(len, found)))
            lo = hi
        return out

    def counts(self, texts: list[bytes]) -> list[int]:
        """The counts of a group of texts, whose new pieces are encoded together."""
        if self.lower:  # but never turn text into an added token
            texts = [t if b"<|" in t else t.lower() for t in texts]
        bags = [t.split() for t in texts]
        fresh: set[bytes] = set()
        for bag in bags:
            fresh |= set(bag).difference(self.memo)
        new = self._encode(list(fresh))
        room = {p: n for p, n in new.items() if len(p) <= MEMO_PIECE_BYTES}
        if len(self.memo) + len(room) > MEMO_PIECES:
            known = {p: self.memo[p] for bag in bags for p in bag if p in self.memo}
            # short pieces are the frequent ones
            self.memo = {p: n for p, n in self.memo.items() if len(p) <= SHORT_PIECE_BYTES}
            if len(self.memo) + len(room) > MEMO_PIECES:
                self.memo = {}
            new |= known
        self.memo.update(room)
        if len(room) < len(new):
            look = self.memo | new if len(new) > len(self.memo) else None
            get = look.__getitem__ if look else lambda p: new[p] if p in new else self.memo[p]
        else:
            get = self.memo.__getitem__
        return [sum(map(get, bag)) for bag in bags]

    def count(self, text: bytes) -> int:
        """One text, cut at white space if it is longer than a group."""
        total, lo = 0, 0
        while lo < len(text):
            hi = lo + GROUP_BYTES
            if hi < len(text):
                cut = _SPACE.search(text, hi)
                hi = cut.start() if cut else len(text)
            total += self.counts([text[lo:hi]])[0]
            lo = hi
        return total

    def count_all(self, texts: list[bytes]) -> list[int]:
        if sum(map(len, texts)) <= 2 * GROUP_BYTES:
            return self.counts(texts)
        return [self.count(t) for t in texts]


_SPACE = re.compile(rb"[\x09-\x0d\x20]")


class WholeCounter:
    """Counts of whole texts, for tokenizers that keep white space."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._len = lambda s: len(model.encode(s, num_threads=1))
        else:
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            self._len = lambda s: len(t.encode(s, add_special_tokens=False))

    def count_all(self, texts: list[bytes]) -> list[int]:
        return [self._len(t.decode("utf-8", "replace")) if t else 0 for t in texts]


def _spec(path: str) -> dict:
    if not path.endswith(".json"):
        return {}
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _drops_spaces(spec: dict) -> bool:
    """Whether the pre-tokenizer cuts at, and drops, white space."""
    parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    return any(p.get("type") == "Split" and p.get("behavior") == "Removed" and p.get("invert")
               and "[^\\s" in p.get("pattern", {}).get("Regex", "") for p in parts)


@lru_cache(maxsize=4)
def counter(path: str) -> WordEndCounter | WholeCounter:
    """One counter per worker process and file; the process is one Spark task's,
    so the library's own threads stay off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    spec = _spec(path)
    if not _drops_spaces(spec):
        return WholeCounter(path)
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    return WordEndCounter(path, lower=any(x.get("type") == "Lowercase" for x in steps))


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens). ``tokenizer`` is a vocabulary file's name in
    the installed set of public tokenizers or a path all executors can read."""
    def run(batches):
        path = tokenizer
        if "/" not in path:
            import public_tokenizers
            path = public_tokenizers.path(path)
        c = counter(path)
        for b in blocks(batches, "text", GROUP_BYTES):
            buf, off = byte_view(b.column("text"))
            raw = buf.tobytes()
            n = c.count_all([raw[lo:hi] for lo, hi in zip(off[:-1].tolist(), off[1:].tolist())])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(off)), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
