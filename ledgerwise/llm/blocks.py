"""Word spans and hashes of Arrow text columns, computed on whole byte buffers.

A block is a slice of an Arrow batch whose texts hold at most ``max_bytes``
bytes (or one text, if that is longer). Words are runs of bytes other than
``0x20`` and ``0x09``-``0x0D``; those separators never occur inside a UTF-8
sequence, so spans can be found on bytes. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 4 << 20
_CHUNK_WORDS = 1 << 15

_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def blocks(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches, balanced by the bytes of ``column``."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(size)
        lo, base = 0, 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(total, base + max_bytes, side="right")))
            yield batch.slice(lo, hi - lo)
            lo, base = hi, int(total[hi - 1])


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty. Offsets start at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    col = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(col)
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + n + 1] if n else np.zeros(1, np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


class Words:
    """Words of a block of texts: byte ``starts``/``ends`` in ``buf`` and
    ``first`` (word index at which each text begins, with the total at the end)."""

    def __init__(self, column: pa.Array):
        self.buf, self.offsets = byte_view(column)
        self._spans()

    def _spans(self) -> None:
        n = len(self.buf)
        word = ~_SEP[self.buf]
        opens, closes = word.copy(), word.copy()
        opens[1:] &= ~word[:-1]
        closes[:-1] &= ~word[1:]
        # a text border separates words of neighbouring texts
        at = self.offsets[:-1][self.offsets[:-1] < n]
        opens[at] = word[at]
        at = self.offsets[1:][self.offsets[1:] > 0] - 1
        closes[at] = word[at]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def lowered(self) -> np.ndarray:
        """The bytes with A-Z lower-cased."""
        b = self.buf
        return np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)

    def joined(self, buf: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The words of ``buf`` with one space between words of a text:
        (bytes, starts, ends) of the words in them."""
        length = self.ends - self.starts
        gap = np.ones(len(length), dtype=np.int64)
        last = self.first[1:][np.diff(self.first) > 0] - 1
        gap[last] = 0
        ends = np.cumsum(length + gap) - gap
        starts = ends - length
        keep = ~_SEP[buf]
        out = np.full(int(ends[-1] + gap[-1]) if len(ends) else 0, 0x20, dtype=np.uint8)
        fill = np.ones(len(out), dtype=bool)
        fill[ends[gap == 1]] = False
        out[fill] = buf[keep]
        return out.tobytes(), starts, ends


class Hasher:
    """A polynomial hash of words and of word runs, modulo 2**64, from a seed.

    Bytes map to random 64-bit values; a word's hash is the weighted sum of
    its bytes, scrambled; a run's hash is the weighted sum of its words'
    hashes, scrambled. Equal content has equal hashes wherever it stands.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
        self.byte_base = int(rng.integers(0, 1 << 63)) * 8 + 5
        self.word_base = int(rng.integers(0, 1 << 63)) * 8 + 5
        self._powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _power(self, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """base**0..n-1 and its inverses modulo 2**64."""
        have = self._powers.get(base)
        if have is None or len(have[0]) < n:
            size = 1 << max(16, (n - 1).bit_length())
            mask = (1 << 64) - 1
            out = []
            for b in (base & mask, pow(base, -1, 1 << 64)):
                steps = np.full(size, b, dtype=np.uint64)
                steps[0] = 1
                out.append(np.multiply.accumulate(steps))
            have = self._powers[base] = (out[0], out[1])
        return have[0], have[1]

    def words(self, w: Words, buf: np.ndarray | None = None) -> np.ndarray:
        buf = w.buf if buf is None else buf
        out = np.empty(len(w.starts), dtype=np.uint64)
        for lo in range(0, len(out), _CHUNK_WORDS):
            s, e = w.starts[lo:lo + _CHUNK_WORDS], w.ends[lo:lo + _CHUNK_WORDS]
            a, n = s[0], int(e[-1] - s[0])
            power, inverse = self._power(self.byte_base, n + 1)
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(self.table[buf[a:e[-1]]] * power[:n], out=sums[1:])
            out[lo:lo + len(s)] = scramble((sums[e - a] - sums[s - a]) * inverse[s - a])
        return out

    def prefix(self, word_hash: np.ndarray) -> np.ndarray:
        """Sums from which ``runs`` takes the hash of any run of words."""
        n = len(word_hash)
        power, _ = self._power(self.word_base, n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(word_hash * power[:n], out=sums[1:])
        return sums

    def runs(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, inverse = self._power(self.word_base, len(sums))
        return scramble((sums[end] - sums[start]) * inverse[start])


def scramble(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (multiply and shift)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def text_of(joined: bytes, starts: np.ndarray, ends: np.ndarray, lo: int, hi: int) -> bytes:
    """Words lo..hi-1 of one text, joined by one space."""
    return joined[starts[lo]:ends[hi - 1]] if hi > lo else b""
