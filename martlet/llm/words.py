"""Vectorised word and phrase hashing over Arrow string columns.

The functions here run inside Spark tasks (``mapInArrow``): they look at the
UTF-8 bytes of a record batch in place, so no Python object is made per word.
Separators are ASCII bytes, hence a byte-wise split is also right for UTF-8.
Hashes are 64-bit polynomial hashes passed through a mixing step; memory beside
the words themselves is one block of ``BLOCK`` bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
BLOCK = 1 << 18
_MASK = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15 | 1                       # odd, so it has an inverse mod 2**64
_PINV = pow(_P, -1, 1 << 64)
_Q = 0xD6E8FEB86659FD93


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.cumprod(out, dtype=U)


_POW, _POWINV = _powers(_P, BLOCK), _powers(_PINV, BLOCK)

#: Bytes of a word when words are whatever stands between ASCII blanks.
BLANKS = np.ones(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (splitmix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _byte_table(fold: bool) -> np.ndarray:
    t = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
    if fold:
        t[65:91] = t[97:123]
    return t


_TABLE = {False: _byte_table(False), True: _byte_table(True)}


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def word_spans(data: np.ndarray, off: np.ndarray, word_bytes: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the index of each document's first word (one more entry at the end)."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = word_bytes[data]
    edges = off[(off > 0) & (off < n)]
    starts, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    starts[edges] = inside[edges + 1]
    ends[edges - 1] = inside[edges]
    ws, we = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return ws, we, np.searchsorted(ws, off)


def word_hashes(data: np.ndarray, ws: np.ndarray, we: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hash of each word; ``fold`` makes A-Z equal to a-z."""
    table = _TABLE[fold]
    lo, hi = np.zeros(len(ws), U), np.zeros(len(ws), U)
    inverse = np.zeros(len(ws), U)
    carry, scale, unscale = U(0), 1, 1
    full, fullinv = pow(_P, BLOCK, 1 << 64), pow(_PINV, BLOCK, 1 << 64)
    for b in range(0, len(data), BLOCK):
        part = data[b:b + BLOCK]
        sums = np.empty(len(part) + 1, U)
        sums[0] = 0
        np.cumsum(table[part] * _POW[:len(part)], out=sums[1:])
        sums = sums * U(scale) + carry
        i, j = np.searchsorted(ws, (b, b + len(part)))
        lo[i:j] = sums[ws[i:j] - b]
        inverse[i:j] = _POWINV[ws[i:j] - b] * U(unscale)
        i, j = np.searchsorted(we, (b + 1, b + len(part) + 1))
        hi[i:j] = sums[we[i:j] - b]
        carry = sums[-1]
        scale, unscale = scale * full & _MASK, unscale * fullinv & _MASK
    return mix((hi - lo) * inverse + (we - ws).astype(U))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of ``h[i:i+k]`` for each i at which k values are left (document ends are the caller's)."""
    if len(h) < k:
        return np.zeros(0, U)
    out, size, unit, unit_size = None, 0, h, 1
    while k:                                        # doubling: a gram of a+b is gram_a * Q**b + gram_b shifted by a
        if k & 1:
            if out is None:
                out, size = unit, unit_size
            else:
                m = min(len(out), len(unit) - size)
                out, size = out[:m] * U(pow(_Q, unit_size, 1 << 64)) + unit[size:size + m], size + unit_size
        k >>= 1
        if k:
            m = len(unit) - unit_size
            unit = unit[:m] * U(pow(_Q, unit_size, 1 << 64)) + unit[unit_size:]
            unit_size *= 2
    return mix(out)


def gram_starts(first: np.ndarray, k: int) -> np.ndarray:
    """Which word positions begin a gram of k words inside one document: ``first`` as from word_spans."""
    ok = np.ones(first[-1], bool)
    for d in range(1, k):
        stop = first[1:] - d
        ok[stop[stop >= first[:-1]]] = False
    return ok


def blocks(batch: pa.RecordBatch, column: str, most: int = 1 << 20):
    """Slices of a record batch with about ``most`` bytes of text each; a longer text stands alone."""
    col = batch.column(batch.schema.get_field_index(column))
    _, off = utf8(col)
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j
