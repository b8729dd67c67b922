"""Vectorised words and word shingles over Arrow string columns.

A chunk of texts is one byte buffer with offsets. Word borders come from a 256-entry class table,
word hashes from prefix sums of a polynomial modulo 2**64, so that no Python object is made per
word. The polynomial works on random 64-bit values per byte and is mixed afterwards; two different
words get the same 64-bit hash with a chance of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20
#: Rows of a chunk.
CHUNK_ROWS = 65_000
U64 = np.uint64
_ODD = 0x9E3779B97F4A7C15
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)
_SHINGLE_FACTORS = [pow(0xD6E8FEB86659FD93, j + 1, 1 << 64) for j in range(16)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift, multiply)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@dataclass(frozen=True)
class Alphabet:
    """word: which bytes belong to words; value: a 64-bit value per byte, equal for A-Z and a-z."""

    word: np.ndarray
    value: np.ndarray


def _alphabet(is_word) -> Alphabet:
    folded = np.arange(256, dtype=U64)
    folded[ord("A") : ord("Z") + 1] += U64(32)
    value = mix((folded + U64(1)) * U64(0xA0761D6478BD642F))
    return Alphabet(np.array([is_word(b) for b in range(256)]), value)


#: Words are runs of anything but space and the controls 9 to 13.
NONSPACE = _alphabet(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Words are runs of ASCII letters, digits and all of non-ASCII.
ALNUM = _alphabet(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.full(size, _ODD, U64)
        down = np.full(size, _ODD_INVERSE, U64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def string_buffer(texts) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the n + 1 offsets of an Arrow string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    _, offsets, data = texts.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_, offsets


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES, rows: int = CHUNK_ROWS) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `rows` rows whose texts have at most limit bytes together, or of a
    single row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n, lo + rows)
        yield lo, hi
        lo = hi


@dataclass
class Words:
    """start, end: byte positions in buf; hash: 64 bits; offsets: of each document's words; value: of
    bytes in the polynomial."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    offsets: np.ndarray
    value: np.ndarray

    def heads(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(words of at least size bytes, hashes of their first size bytes)."""
        long_ = np.flatnonzero(self.end - self.start >= size)
        start = self.start[long_]
        total = np.zeros(len(start), U64)
        for j in range(size):
            total += self.value[self.buf[start + j]] * U64(pow(_ODD, j, 1 << 64))
        return long_, mix(total)


def words(buf: np.ndarray, offsets: np.ndarray, alphabet: Alphabet, piece: int = CHUNK_BYTES) -> Words:
    """All words of the texts buf[offsets[i]:offsets[i + 1]]; words never cross texts.

    The bytes are gone through in pieces, so that a long text needs memory for its words, not for
    several numbers per byte; a word may lie across pieces."""
    base = int(offsets[0])
    part, local = buf[base : int(offsets[-1])], offsets - base
    up, down = _powers(piece)
    starts, ends, first_sums, last_sums, shifts = [], [], [], [], []
    before, total, size = False, U64(0), len(part)
    for p in range(0, size, piece):
        n = min(piece, size - p)
        inside = np.zeros(n + 1, bool)
        ahead = alphabet.word[part[p : p + n + 1]]
        inside[: len(ahead)] = ahead  # with the byte after the piece
        border = np.zeros(n + 1, bool)
        a, b = np.searchsorted(local, [p, p + n + 1])
        border[local[a:b] - p] = True
        opens = inside[:n].copy()
        opens[1:] &= ~inside[: n - 1] | border[1:n]
        opens[0] &= not before or border[0]
        closes = inside[:n] & (~inside[1:] | border[1:])
        sums = np.empty(n + 1, U64)
        sums[0] = 0
        np.cumsum(alphabet.value[part[p : p + n]] * up[:n], out=sums[1:])
        opens, closes = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        first, last, shift = sums[opens], sums[closes], down[opens]
        if p:
            scale = U64(pow(_ODD, p, 1 << 64))
            first, last = first * scale + total, last * scale + total
            shift = shift * U64(pow(_ODD_INVERSE, p, 1 << 64))
        starts.append(opens + p)
        ends.append(closes + p)
        first_sums.append(first)
        last_sums.append(last)
        shifts.append(shift)
        before, total = bool(inside[n - 1]), U64((int(sums[n]) * pow(_ODD, p, 1 << 64) + int(total)) % (1 << 64))
    if not starts:
        none = np.zeros(0, np.int64)
        return Words(part, none, none, np.zeros(0, U64), np.zeros(len(offsets), np.int64), alphabet.value)
    start, end = np.concatenate(starts), np.concatenate(ends)
    hashes = mix((np.concatenate(last_sums) - np.concatenate(first_sums)) * np.concatenate(shifts))
    return Words(part, start, end, hashes, np.searchsorted(start, local).astype(np.int64), alphabet.value)


def shingle_hashes(w: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the shingles of each text, with repeats; a text with fewer words than
    size, but not none, has its whole word sequence as its only shingle."""
    counts = np.diff(w.offsets)
    per_doc = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(per_doc)])
    out = np.empty(int(offsets[-1]), U64)
    long_docs = counts >= size
    first = np.repeat(w.offsets[:-1], per_doc) + (np.arange(len(out)) - np.repeat(offsets[:-1], per_doc))
    is_long = np.repeat(long_docs, per_doc)
    at = first[is_long]
    acc = np.zeros(len(at), U64)
    for j in range(size):
        acc += w.hash[at + j] * U64(_SHINGLE_FACTORS[j])
    out[is_long] = mix(acc)
    for c in range(1, size):
        docs = np.flatnonzero(counts == c)
        if len(docs):
            acc = np.full(len(docs), c, U64)
            for j in range(c):
                acc += w.hash[w.offsets[docs] + j] * U64(_SHINGLE_FACTORS[j])
            out[offsets[docs]] = mix(acc)
    return out, offsets


def distinct_sets(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes sorted and without repeats, with new offsets."""
    hashes = hashes.copy()
    bounds = offsets.tolist()
    for a, b in zip(bounds, bounds[1:]):
        if b - a > 1:
            hashes[a:b].sort()
    keep = np.empty(len(hashes), bool)
    if len(hashes):
        keep[0] = True
        np.not_equal(hashes[1:], hashes[:-1], out=keep[1:])
        keep[offsets[:-1][np.diff(offsets) > 0]] = True
    total = np.concatenate([[0], np.cumsum(keep)])
    return hashes[keep], total[offsets]


def segment_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 of values[offsets[i]:offsets[i + 1]]; 0 for an empty segment."""
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def shingle_sets(texts, size: int = 5) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, sorted distinct shingle hashes, offsets) for each chunk."""
    buf, offsets = string_buffer(texts)
    for lo, hi in chunks(offsets):
        found = words(buf, offsets[lo : hi + 1], NONSPACE)
        yield lo, hi, *distinct_sets(*shingle_hashes(found, size))
