"""Array helpers for whole texts: an Arrow string column becomes flat byte arrays, words and hashes.

Everything here works on one slice of a few megabytes inside a Spark task. Hashes are 64-bit polynomial hashes over
bytes (modulo 2^64, odd base) that are mixed before use.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_ascii = np.arange(256)
#: Whitespace of the contracts: space and 0x09-0x0D.
IS_SPACE = (_ascii == 0x20) | ((_ascii >= 0x09) & (_ascii <= 0x0D))
NOT_SPACE = ~IS_SPACE
#: Digits, lower-case ASCII letters and every byte of a non-ASCII character.
IS_ALNUM = ((_ascii >= 0x30) & (_ascii <= 0x39)) | ((_ascii >= 0x61) & (_ascii <= 0x7A)) | (_ascii >= 0x80)
LOWER = np.where((_ascii >= 0x41) & (_ascii <= 0x5A), _ascii + 32, _ascii).astype(np.uint8)

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _table(old: np.ndarray, base: np.uint64, n: int) -> np.ndarray:
    while len(old) < n:
        step = np.uint64(pow(int(base), len(old), 1 << 64))
        old = np.concatenate([old, old * step])
    return old


def powers(n: int) -> np.ndarray:
    global _powers
    _powers = _table(_powers, BASE, n)
    return _powers[:n]


def inverse_powers(n: int) -> np.ndarray:
    global _inverse
    _inverse = _table(_inverse, BASE_INVERSE, n)
    return _inverse[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H with len(data)+1 entries: H[i] = sum over j < i of (byte+1) * BASE^j."""
    out = np.zeros(len(data) + 1, np.uint64)
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= powers(len(data))
    np.cumsum(terms, out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of bytes [start, end), independent of where they lie."""
    return (prefix[ends] - prefix[starts]) * inverse_powers(len(prefix))[starts]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of each piece take about ``limit`` bytes; a longer text stands alone."""
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64)
        ends = np.cumsum(lengths)
        row = 0
        while row < batch.num_rows:
            before = ends[row - 1] if row else 0
            to = max(row + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(row, to - row)
            row = to
    pa.default_memory_pool().release_unused()  # workers are reused: give back what the next task may not need


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and the offsets of each; null counts as empty."""
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = column.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(wide) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


class Words:
    """Words of a slice: byte starts and ends, word offsets per text, and a mixed 64-bit hash per word."""

    def __init__(self, column: pa.Array, is_word: np.ndarray, lower: bool = True):
        data, self.offsets = flat(column)
        self.data = LOWER[data] if lower else data
        inside = is_word[self.data]
        edge = np.zeros(len(data) + 1, bool)
        edge[self.offsets] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.word_offsets = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.word_offsets)
        self.hashes = mix(span_hashes(prefix_hashes(self.data), self.starts, self.ends))

    def doc_of(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.word_offsets, words, "right") - 1

    def text(self, word: int) -> bytes:
        return self.data[self.starts[word] : self.ends[word]].tobytes()


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive word hashes (also across texts; callers mask those)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out *= BASE
        out += words[j : j + n]
    return mix(out)


def within(word_offsets: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of the n k-gram starts lie wholly inside one text."""
    ok = np.ones(max(n, 0), bool)
    for back in range(1, k):
        at = word_offsets[1:-1] - back
        ok[at[(at >= 0) & (at < n)]] = False
    return ok


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every span, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(before - starts, lengths)


def binary_rows(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Arrow binary column from flat bytes and the byte length of each row."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
