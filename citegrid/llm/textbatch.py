"""Task-side helpers: Arrow string columns as flat byte arrays, word hashes, shingle hashes.

Everything here works on one Arrow batch with vectorised NumPy; nothing keeps
state between batches.  Hashes are 64-bit, fixed by constants, and depend only
on the bytes of a word, so they agree between tasks, runs and machines.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at a time; bounds the scratch arrays however long a text is.
WINDOW = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_U = np.uint64


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))
_BYTE_CODE_LOWER = _BYTE_CODE.copy()
_BYTE_CODE_LOWER[65:91] = _BYTE_CODE[97:123]

#: Word bytes under "words are runs of [^\x20\x09-\x0D]".
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Word bytes under "words are runs of ASCII letters and digits or non-ASCII bytes".
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = True
ALNUM[128:] = True

_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        n = max(n, WINDOW + 4096)
        inverse = _U(pow(int(_BASE), -1, 1 << 64))
        for name, b in (("up", _BASE), ("down", inverse)):
            t = np.full(n, b, dtype=np.uint64)
            t[0] = 1
            _POWERS[name] = np.multiply.accumulate(t)
    return _POWERS["up"], _POWERS["down"]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows back to back, and the row offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    n = len(column)
    if n == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    o = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0]:o[-1]], o - o[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray = NON_SPACE) -> Iterator[tuple]:
    """(first byte, view of bytes, word starts, word ends) of consecutive
    windows, cut between words; starts and ends count from the window."""
    n, at = len(data), 0
    while at < n:
        end = min(n, at + WINDOW)
        if end < n:
            gap = np.flatnonzero(~word_byte[data[at:end]])
            row = offsets[np.searchsorted(offsets, end, "right") - 1]
            cut = max(at + int(gap[-1]) + 1 if len(gap) else 0, int(row))
            while cut <= at:          # one word longer than the window: go on to its end
                more = min(n, end + WINDOW)
                gap = np.flatnonzero(~word_byte[data[end:more]])
                later = offsets[np.searchsorted(offsets, end, "left")]
                stop = end + int(gap[0]) + 1 if len(gap) else more
                stop = min(stop, int(later)) if later > at else stop
                if len(gap) or stop == later or more == n:
                    cut = stop
                end = more
            end = cut
        view = data[at:end]
        inside = word_byte[view]
        bounds = offsets[(offsets >= at) & (offsets < end)] - at
        before = np.empty_like(inside)
        before[0] = False
        before[1:] = inside[:-1]
        before[bounds] = False
        after = np.empty_like(inside)
        after[-1] = False
        after[:-1] = inside[1:]
        after[bounds[bounds > 0] - 1] = False
        yield at, view, np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray = NON_SPACE,
                lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and for each row the index of its first
    word (one entry more than rows).  ``lower`` folds A-Z only."""
    code = _BYTE_CODE_LOWER if lower else _BYTE_CODE
    hashes, places = [], []
    for at, view, s, e in word_spans(data, offsets, word_byte):
        if not len(s):
            continue
        up, down = powers(len(view) + 1)
        total = np.zeros(len(view) + 1, dtype=np.uint64)
        np.cumsum(code[view] * up[:len(view)], out=total[1:])
        hashes.append(mix64((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)))
        places.append(s + at)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    places = np.concatenate(places)
    return np.concatenate(hashes), np.searchsorted(places, offsets, "left")


def span_hashes(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray,
                beginnings: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(byte place, hash) of all words, lower-cased, then of the first bytes of
    the longer ones, for each window and length in ``beginnings``."""
    for at, view, s, e in word_spans(data, offsets, word_byte):
        up, down = powers(len(view) + 1)
        total = np.zeros(len(view) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE_LOWER[view] * up[:len(view)], out=total[1:])
        yield s + at, mix64((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        for n in beginnings:
            s, e = s[e - s > n], e[e - s > n]
            yield s + at, mix64((total[s + n] - total[s]) * down[s] + _U(n | 1 << 32))


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words of each row (repeats kept), rows back to
    back, and the row offsets.  A row of 1 to k-1 words has its whole sequence
    as its one shingle; a row without words has none."""
    n_words = np.diff(first)
    count = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    at = np.zeros(len(count) + 1, np.int64)
    np.cumsum(count, out=at[1:])
    if at[-1] == 0:
        return np.zeros(0, np.uint64), at
    start = np.repeat(first[:-1], count) + (np.arange(at[-1]) - np.repeat(at[:-1], count))
    length = np.repeat(np.minimum(n_words, k), count)
    h = np.zeros(at[-1], np.uint64)
    for j in range(k):
        here = j < length
        w = words[np.minimum(start + j, len(words) - 1)]
        h = np.where(here, mix64(h * _U(0x9FB21C651E98DF25) + w + _U(j + 1)), h)
    return h, at


def code_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each row."""
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    return np.diff(heads[offsets])


def slices(batch: pa.RecordBatch, column: str = "text", max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of the batch with at most ``max_bytes`` of the
    column each (a longer row is a range of its own); no row is left out."""
    _, offsets = flat(batch.column(column))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1)
        j = min(j, batch.num_rows)
        yield batch.slice(i, j - i)
        i = j
