"""Alignment of two tokenizers' tokens by the bytes they cover.

Each text, with a space before it, is encoded by both tokenizers. Tokens of a
block of texts and the bytes they cover are sparse incidence matrices in
compressed rows, built by hand on numpy arrays: A (tokens of the first x bytes) and
B (tokens of the second x bytes). Gustavson's row products A·Bᵀ give every pair
of tokens that overlap, with the number of bytes they share; texts do not
share bytes, so the product stays block-diagonal. Pairs whose byte ranges end
together are the *links*; the offsets where they end cut the tokens into groups,
and products of token-group incidences give the pairs of tokens that share a group.

Neither vocabulary has a token with a space after another character, so no token of
either spans the place before a single space between two other characters. Texts
are cut there, each distinct chunk of a block is encoded and aligned once (or
remembered from an earlier block), and a text's result is put together from its chunks'.
A vocabulary of another kind is applied to whole texts.

The encoded links are written once (four bytes a link); their counts over the
corpus are sums of per-task counts. Of two linked tokens one's bytes end with the
other's, so the table of pairs is bounded by the vocabularies, whatever the corpus
(``pair_bound``; about half a million pairs for the public vocabularies), and is
sent to the tasks that compare each link with its second token's best.

Results in odd cases: a null or empty text, or one whose tokens do not join to
the text (bytes that are no UTF-8, U+2581 under a vocabulary that writes spaces
so), has no tokens: zeros and an empty digest; strings of special tokens in a text are
plain text; repeated rows are texts of their own and count each; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwise.llm.blocks import blocks, byte_view
from ledgerwise.session import materialize

BLOCK_BYTES = 1 << 20
PRODUCT_ROWS = 1 << 20    # products of a block come in slices of about so many entries
MEMO_CHUNKS = 120_000     # chunks of texts whose alignment a worker remembers,
MEMO_BYTES = 32 << 20     # and their bytes
LEARN_CHUNKS = 10_000     # new chunks encoded at a time
MERGE_PAIRS = 2_000_000   # pair counts a task gathers before it merges them


# ---------------------------------------------------------------------------
# sparse matrices in compressed rows
# ---------------------------------------------------------------------------

@dataclass
class Csr:
    """A 0/1 matrix: the columns of row i are ``cols[ptr[i]:ptr[i + 1]]``."""
    ptr: np.ndarray
    cols: np.ndarray
    width: int

    @property
    def rows(self) -> int:
        return len(self.ptr) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.ptr))

    def transposed(self) -> "Csr":
        order = np.argsort(self.cols, kind="stable")
        ptr = np.concatenate(([0], np.cumsum(np.bincount(self.cols, minlength=self.width))))
        return Csr(ptr, self.row_of()[order], self.rows)


def row_products(left: Csr, right: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, column, value) of left·right by Gustavson's method: row i is the sum of
    the rows of ``right`` at the columns of row i of ``left``. In slices of rows."""
    width = np.diff(right.ptr)
    cost = np.concatenate(([0], np.cumsum(width[left.cols])))[left.ptr]
    lo = 0
    while lo < left.rows:
        hi = max(lo + 1, int(np.searchsorted(cost, cost[lo] + PRODUCT_ROWS, side="right")) - 1)
        inner = left.cols[left.ptr[lo]:left.ptr[hi]]
        each = width[inner]
        total = int(each.sum())
        row = np.repeat(np.repeat(np.arange(lo, hi), np.diff(left.ptr[lo:hi + 1])), each)
        shift = np.repeat(right.ptr[inner] - (np.cumsum(each) - each), each)
        col = right.cols[np.arange(total) + shift]
        key = row * right.width + col
        if total and (key[1:] < key[:-1]).any():
            key = np.sort(key, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if total else np.zeros(0, np.int64)
        yield key[first] // right.width, key[first] % right.width, np.diff(np.append(first, total))
        lo = hi


def byte_incidence(lengths: np.ndarray) -> Csr:
    """Tokens x bytes, for tokens that follow one another."""
    ptr = np.concatenate(([0], np.cumsum(lengths)))
    return Csr(ptr, np.arange(ptr[-1]), int(ptr[-1]))


def group_incidence(ends: np.ndarray, cuts: np.ndarray) -> Csr:
    """Tokens x groups; a group holds the tokens that end after the cut before it
    and no later than its own."""
    return Csr(np.arange(len(ends) + 1), np.searchsorted(cuts, ends, side="left"), len(cuts))


# ---------------------------------------------------------------------------
# tokenizers
# ---------------------------------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """The letters in which byte-level vocabularies write bytes: printable Latin-1
    characters stand for themselves, the other bytes follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A tokenizer with the bytes of each of its tokens. ``local``: no token spans
    the place before a single space between two other characters."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
            raw = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
            self.encode = lambda texts: model.encode(texts, num_threads=1)  # puts the space before a text itself
            self.local = all("▁" not in p.lstrip("▁") for p in names)
        else:
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            t.encode_special_tokens = True
            spec = json.loads(t.to_str())
            cut = spec.get("pre_tokenizer") or {}
            self.local = spec.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
            letters = _byte_letters()
            by_id = {i: s for s, i in t.get_vocab(with_added_tokens=True).items()}
            raw = [bytes(letters[c] for c in s) if all(c in letters for c in s) else s.encode()
                   for s in (by_id.get(i, "") for i in range(max(by_id) + 1))]
            self.encode = lambda texts: [e.ids for e in t.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)]
        self.size = len(raw)
        self.bytes = pa.array(raw, pa.binary())
        self.length = np.array([len(x) for x in raw], dtype=np.int64)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        data = self.bytes.take(pa.array(ids)).buffers()[2]
        return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def _path(name: str) -> str:
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def vocabulary(name: str) -> Vocabulary:
    """One per worker process and file; the process is one task's, so the library's threads stay off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Vocabulary(_path(name))


def pair_bound(a: Vocabulary, b: Vocabulary) -> int:
    """How many pairs of tokens can ever be linked: those of which one ends with the other."""
    def ends(short: list[bytes], long: list[bytes], proper: int) -> int:
        there: dict[bytes, int] = {}
        for s in short:
            there[s] = there.get(s, 0) + 1
        return sum(there.get(x[i:], 0) for x in long for i in range(proper, len(x)))

    x, y = a.bytes.to_pylist(), b.bytes.to_pylist()
    return ends(y, x, 0) + ends(x, y, 1)


# ---------------------------------------------------------------------------
# alignment of a block
# ---------------------------------------------------------------------------

class Alignment:
    """The tokens of a block of texts under both vocabularies. ``first_a`` and
    ``first_b`` hold each text's first token, with the totals at the end."""

    def __init__(self, texts: list[bytes | None], a: Vocabulary, b: Vocabulary):
        self.a, self.b = a, b
        own: list[tuple[np.ndarray, np.ndarray]] = []  # (ids, tokens of each text)
        words = [t.decode("utf-8", "replace") if t else "" for t in texts]
        at = np.flatnonzero([bool(w) for w in words])
        good = np.zeros(len(texts), dtype=bool)
        good[at] = True
        for v in (a, b):
            found = v.encode([words[i] for i in at]) if len(at) else []
            size = np.zeros(len(texts), dtype=np.int64)
            size[at] = [len(x) for x in found]
            own.append((np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(size.sum())), size))
        for v, (ids, size) in zip((a, b), own):
            good &= self._agree(v, ids, size, texts)
        (self.ids_a, self.first_a), (self.ids_b, self.first_b) = (self._only(ids, size, good) for ids, size in own)
        self.end_a, self.end_b = np.cumsum(a.length[self.ids_a]), np.cumsum(b.length[self.ids_b])
        self._groups()

    @staticmethod
    def _only(ids: np.ndarray, size: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of the good texts, and where each text's begin."""
        return ids[np.repeat(good, size)], np.concatenate(([0], np.cumsum(np.where(good, size, 0))))

    @staticmethod
    def _agree(v: Vocabulary, ids: np.ndarray, size: np.ndarray, texts: list[bytes | None]) -> np.ndarray:
        """Which texts' tokens join to a space and the text."""
        want = np.array([len(t or b"") + 1 for t in texts])
        spans = np.concatenate(([0], np.cumsum(v.length[ids])))
        first = np.concatenate(([0], np.cumsum(size)))
        good = spans[first[1:]] - spans[first[:-1]] == want
        got = v.joined(ids[np.repeat(good, size)])
        wanted = np.frombuffer(b"".join(b" " + t for t, g in zip(texts, good) if g), dtype=np.uint8)
        wrong = np.flatnonzero(got != wanted)
        if len(wrong):
            ends = np.cumsum(want[good])
            good[np.flatnonzero(good)[np.searchsorted(ends, wrong, side="right")]] = False
        return good

    def overlaps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(token of A, token of B, bytes shared) of all overlapping tokens."""
        left = byte_incidence(self.a.length[self.ids_a])
        return row_products(left, byte_incidence(self.b.length[self.ids_b]).transposed())

    def _groups(self) -> None:
        """Links: overlaps that end together; their ends are the cuts."""
        found = [(i[same], j[same]) for i, j, _ in self.overlaps() for same in [self.end_a[i] == self.end_b[j]]]
        self.link_a = np.concatenate([i for i, _ in found]) if found else np.zeros(0, np.int64)
        self.link_b = np.concatenate([j for _, j in found]) if found else np.zeros(0, np.int64)
        self.cuts = self.end_a[self.link_a]  # rising: of each side one token ends at a byte
        self.in_a, self.in_b = group_incidence(self.end_a, self.cuts), group_incidence(self.end_b, self.cuts)

    def shared_groups(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(token of A, token of B, 1) of all tokens that share a group."""
        return row_products(self.in_a, self.in_b.transposed())

    def group_counts(self) -> np.ndarray:
        """Groups of each text."""
        return np.diff(np.searchsorted(self.first_of_group(), self.first_a))

    def first_of_group(self) -> np.ndarray:
        """The first token of A of each group."""
        return self.in_a.transposed().ptr[:-1]

    def texts(self) -> list[bytes]:
        """Each text's groups: ``a1,a2|b1;a3|b2,b3``."""
        n_a, n_b = len(self.ids_a), len(self.ids_b)
        by_a, by_b = self.in_a.transposed().ptr, self.in_b.transposed().ptr
        order = np.empty(n_a + n_b, dtype=np.int64)
        sign_a, sign_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
        sign_a[by_a[1:] - 1] = sign_b[by_b[1:] - 1] = 1
        sign_b[self.first_b[1:][np.diff(self.first_b) > 0] - 1] = 2  # nothing stands after a text's last token
        order[np.arange(n_a) + by_b[self.in_a.cols]] = sign_a * self.a.size + self.ids_a
        order[np.arange(n_b) + by_a[self.in_b.cols + 1]] = 2 * self.a.size + sign_b * self.b.size + self.ids_b
        joined = _names(self.a.size, self.b.size).take(pa.array(order))
        off = np.frombuffer(joined.buffers()[1], dtype=np.int64)[joined.offset:joined.offset + len(joined) + 1]
        data = joined.buffers()[2]
        raw = data.to_pybytes() if data is not None else b""
        at = off[self.first_a + self.first_b].tolist()
        return [raw[lo:hi] for lo, hi in zip(at[:-1], at[1:])]


@lru_cache(maxsize=2)
def _names(size_a: int, size_b: int) -> pa.Array:
    """Decimal ids with what can follow them: A with ',' and '|', B with ',', ';' and nothing."""
    a, b = [str(i) for i in range(size_a)], [str(i) for i in range(size_b)]
    return pa.array([x + s for ids, signs in ((a, ",|"), (b, [",", ";", ""])) for s in signs for x in ids], pa.large_binary())


_SAFE = re.compile(r"(?<=\S) (?=\S)")


class Aligner:
    """Alignments of whole texts, put together from those of their distinct chunks."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.a, self.b, self.local = a, b, a.local and b.local
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.held = 0
        self.counts = np.zeros((0, 4), dtype=np.int64)  # tokens of A, of B, links, whether the bytes agree
        self.written: list[bytes] = []
        self.codes, self.ptr = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _learn(self, chunks: list[str]) -> None:
        x = Alignment([c.encode() for c in chunks], self.a, self.b)
        cut = np.searchsorted(x.link_a, x.first_a)
        n_a = np.diff(x.first_a)
        self.place.update(zip(chunks, range(len(self.place), len(self.place) + len(chunks))))
        self.counts = np.concatenate((self.counts, np.stack((n_a, np.diff(x.first_b), np.diff(cut), n_a > 0), axis=1)))
        self.written += x.texts()
        self.codes = np.concatenate((self.codes, x.ids_a[x.link_a] * self.b.size + x.ids_b[x.link_b]))
        self.ptr = np.concatenate((self.ptr, self.ptr[-1] + cut[1:]))
        self.held += sum(map(len, chunks))

    def block(self, texts: list[bytes]) -> tuple[np.ndarray, list[bytes], list[np.ndarray]]:
        """Of each text: (tokens of A, of B, links), the groups written out, its links' id pairs."""
        cut = [(_SAFE.split(w) if self.local else [w]) if w else [] for w in (t.decode("utf-8", "replace") for t in texts)]
        flat = [c for chunks in cut for c in chunks]
        if len(self.place) > MEMO_CHUNKS or self.held > MEMO_BYTES:
            self._forget()
        fresh = list(dict.fromkeys(c for c in flat if c not in self.place))
        for lo in range(0, len(fresh), LEARN_CHUNKS):
            self._learn(fresh[lo:lo + LEARN_CHUNKS])
        at = np.fromiter(map(self.place.__getitem__, flat), dtype=np.int64, count=len(flat))
        first = np.concatenate(([0], np.cumsum([len(c) for c in cut]))).astype(np.int64)
        sums = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(self.counts[at], axis=0)))
        counts = sums[first[1:]] - sums[first[:-1]]
        # a text counts if all its chunks do; one that is not UTF-8 never does
        size = np.diff(first)
        for i, t in enumerate(texts):
            if counts[i, 3] < size[i] or any(c.find("\ufffd") >= 0 for c in cut[i]) and t != " ".join(cut[i]).encode():
                counts[i] = -1
        out_text, out_codes = [], []
        for i, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            if counts[i, 0] <= 0:
                counts[i] = 0
                out_text.append(b"")
                out_codes.append(self.codes[:0])
                continue
            own = at[lo:hi]
            out_text.append(b";".join(map(self.written.__getitem__, own.tolist())))
            each = self.ptr[own + 1] - self.ptr[own]
            out_codes.append(self.codes[np.arange(int(each.sum())) + np.repeat(self.ptr[own] - (np.cumsum(each) - each), each)])
        return counts[:, :3], out_text, out_codes


@lru_cache(maxsize=1)
def _aligner(name_a: str, name_b: str) -> Aligner:
    """One per worker process, so that its tasks share what they remember."""
    return Aligner(vocabulary(name_a), vocabulary(name_b))


# ---------------------------------------------------------------------------
# on tables
# ---------------------------------------------------------------------------

def _code_type(a: Vocabulary, b: Vocabulary) -> np.dtype:
    return np.dtype("<u4" if a.size * b.size <= 1 << 32 else "<u8")


def aligned(docs: DataFrame, name_a: str, name_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links): ``links`` holds
    the id pairs of a text's links, packed."""
    def run(batches):
        aligner = _aligner(name_a, name_b)
        a, b = aligner.a, aligner.b
        kind = _code_type(a, b)
        for block in blocks(batches, "text", BLOCK_BYTES):
            buf, off = byte_view(block.column("text"))
            raw = buf.tobytes()
            n, groups, codes = aligner.block([raw[lo:hi] for lo, hi in zip(off[:-1].tolist(), off[1:].tolist())])
            yield pa.RecordBatch.from_arrays(
                # of each side one token ends at a cut, so there are as many groups as links
                [block.column("doc_id"), *[pa.array(np.ascontiguousarray(n[:, k])) for k in (0, 1, 2, 2)],
                 pa.array([sha256(t).hexdigest() if t else "" for t in groups]), pa.array([c.astype(kind).tobytes() for c in codes], pa.binary())],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary")


def _codes(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    codes = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]].view(kind) if data is not None else np.zeros(0, kind)
    return codes, (off - off[0]) // kind.itemsize


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(codes, return_inverse=True)
    return distinct, np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)


def pair_counts(found: DataFrame, name_a: str, name_b: str) -> DataFrame:
    """(code, n): the links of each id pair over all rows; every task sums its own first."""
    def run(batches):
        kind = _code_type(vocabulary(name_a), vocabulary(name_b))
        codes, counts, held = [], [], 0
        for b in batches:
            if b.num_rows:
                c, n = np.unique(_codes(b.column("links"), kind)[0], return_counts=True)
                codes.append(c)
                counts.append(n)
                held += len(c)
            if held > MERGE_PAIRS:
                c, n = _summed(np.concatenate(codes), np.concatenate(counts))
                codes, counts, held = [c], [n], 0
        if codes:
            c, n = _summed(np.concatenate(codes), np.concatenate(counts))
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)), pa.array(n)], ["code", "n"])

    return found.select("links").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def align(docs: DataFrame, name_a: str, name_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    found = materialize(aligned(docs, name_a, name_b, id_col, text_col), "alignment")
    table = pair_counts(found, name_a, name_b).toArrow().sort_by("code")  # bounded by the vocabularies
    codes, counts = table.column("code").to_numpy(), table.column("n").to_numpy()
    size_b = vocabulary(name_b).size
    top = np.zeros(size_b, dtype=np.int64)
    np.maximum.at(top, codes % size_b, counts)
    best = counts == top[codes % size_b]

    def run(batches):
        kind = _code_type(vocabulary(name_a), vocabulary(name_b))
        for b in batches:
            if b.num_rows == 0:
                continue
            own, off = _codes(b.column("links"), kind)
            at = np.searchsorted(codes, own)
            sums = [np.concatenate(([0], np.cumsum(x[at]))) for x in (best.astype(np.int64), counts)]
            extra = [pa.array(s[off[1:]] - s[off[:-1]]) for s in sums]
            kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *extra, b.column("groups_sha256")],
                                             [*kept, "n_best", "count_sum", "groups_sha256"])

    return found.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                                 "groups_sha256 string")


def token_links(docs: DataFrame, name_a: str, name_b: str, kind: str = "overlap", id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(doc_id, pos_a, pos_b, id_a, id_b, weight): the linked token occurrences. ``kind``:
    'overlap' (weight: bytes shared), 'end' (ranges that end together) or 'group' (one group)."""
    if kind not in ("overlap", "end", "group"):
        raise ValueError(f"unknown kind of link {kind!r}")

    def run(batches):
        a, b = vocabulary(name_a), vocabulary(name_b)
        for block in blocks(batches, "text", BLOCK_BYTES):
            buf, off = byte_view(block.column("text"))
            raw = buf.tobytes()
            x = Alignment([raw[lo:hi] for lo, hi in zip(off[:-1].tolist(), off[1:].tolist())], a, b)
            parts = {"overlap": x.overlaps, "group": x.shared_groups,
                     "end": lambda x=x: [(x.link_a, x.link_b, np.ones(len(x.link_a), np.int64))]}[kind]()
            for i, j, w in parts:
                own = np.searchsorted(x.first_a, i, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id").take(pa.array(own)), *[pa.array(v) for v in (i - x.first_a[own], j - x.first_b[own], x.ids_a[i], x.ids_b[j], w)]],
                    ["doc_id", "pos_a", "pos_b", "id_a", "id_b", "weight"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, pos_a long, pos_b long, id_a long, id_b long, weight long")
