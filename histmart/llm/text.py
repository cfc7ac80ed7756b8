"""Vectorised text helpers for Arrow batches: words, word hashes, shingles.

Everything works on the UTF-8 bytes of a whole batch at once (numpy), in
chunks of a few MB so that a task's memory does not follow the batch size.
A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_rng = np.random.default_rng(20240117)
_BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_WORD_COEF = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_powers: dict[int, np.ndarray] = {}

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
#: bytes of words split at ASCII white space: [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept and grown between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        have[0] = 1
        have = _powers[base] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def text_chunks(col: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of texts of about max_bytes."""
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    buffers = col.buffers()
    offsets = np.frombuffer(buffers[1], dtype=kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), len(col))
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (bytes) and text number of every word."""
    n = len(data)
    w = is_word[data]
    first, last = w.copy(), w.copy()
    first[1:] &= ~w[:-1]
    last[:-1] &= ~w[1:]
    border = offsets[1:-1]
    border = border[(border > 0) & (border < n)]
    first[border] |= w[border]
    last[border - 1] |= w[border - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(offsets, start, side="right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each word, A-Z lower-cased or unchanged."""
    n = len(data)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[ASCII_LOWER[data] if lower else data] * _power(_BASE, n), out=total[1:])
    return mix((total[end] - total[start]) * _power(_INV, n + 1)[start])


def shingles(h: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, k-word shingle hash), sorted by text, then signed hash.

    A text of 1 to k-1 words has its whole sequence as its one shingle; a
    text without words has none.
    """
    parts_doc, parts_hash = [], []
    n = len(h)
    if n >= k:
        acc = h[:n - k + 1] * _WORD_COEF[0]
        for j in range(1, k):
            acc = acc + h[j:n - k + 1 + j] * _WORD_COEF[j]
        ok = doc[:n - k + 1] == doc[k - 1:]
        parts_doc.append(doc[:n - k + 1][ok])
        parts_hash.append(mix(acc[ok] + _U(k)))
    counts = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(counts) - counts
    for m in range(1, k):
        few = np.flatnonzero(counts == m)
        if len(few):
            acc = np.zeros(len(few), dtype=np.uint64)
            for j in range(m):
                acc = acc + h[first[few] + j] * _WORD_COEF[j]
            parts_doc.append(few)
            parts_hash.append(mix(acc + _U(m)))
    if not parts_doc:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    d, s = np.concatenate(parts_doc), np.concatenate(parts_hash).view(np.int64)
    order = np.lexsort((s, d))
    d, s = d[order], s[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
    return d[new], s[new]


def sum_by(doc: np.ndarray, x: np.ndarray, n_docs: int) -> np.ndarray:
    """Sum of uint64 x for each text (modulo 2^64); doc is sorted."""
    total = np.zeros(len(x) + 1, dtype=np.uint64)
    np.cumsum(x, out=total[1:])
    edge = np.searchsorted(doc, np.arange(n_docs + 1))
    return total[edge[1:]] - total[edge[:-1]]


def list_array(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    """list<int64> with counts[i] of the values in row i."""
    edge = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=edge[1:])
    return pa.ListArray.from_arrays(pa.array(edge), pa.array(values, pa.int64()))
