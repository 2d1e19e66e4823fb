"""Periodic runs: stretches of words that repeat one phrase four times or more.

A run is a maximal stretch of consecutive words with a smallest period q (words q apart are
equal) and at least ``max(LEAST, EXPONENT * q)`` words.

Periods under ``DIRECT`` are found by comparing the words with themselves q places on. Longer
ones are found scale by scale: for periods from 2**k to 2**(k+1) - 1, every 2**(k+1) words
get a hash, and every window of 2**(k-1) such hashes its minimum. A run has at least
2q + 1 of these hashes; they repeat q places on, and no two within one period are equal (a
phrase that is not itself repeated differs from all its rotations). So inside a run the place where the minimum
of windows changes to a value occurs again exactly one period later, at least once.
Neighbouring occurrences of one value at a distance of this scale are the seeds; each is extended both ways by
comparing words, and seeds inside a stretch already found for their distance are skipped.
Work per scale is in proportion to the words, so the whole is n log n.

Words are compared by 64-bit hashes, found over bytes. The texts of a record batch stand in one
array, with a value of its own between any two.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martlet.llm.tables import task
from martlet.llm.words import U, blocks, mix, utf8, word_hashes, word_spans

LEAST, EXPONENT = 6, 4
#: Periods below are compared directly; a power of two.
DIRECT = 16
_A, _B = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)


def _stretches(x: np.ndarray, q: int, least: int) -> np.ndarray:
    """(first, end) rows of maximal stretches with period ``q`` and ``least`` words or more."""
    if len(x) <= q:
        return np.zeros((0, 2), np.int64)
    same = np.flatnonzero(x[q:] == x[:-q])
    if not len(same):
        return np.zeros((0, 2), np.int64)
    cut = np.flatnonzero(np.diff(same) != 1)
    first, last = same[np.r_[0, cut + 1]], same[np.r_[cut, len(same) - 1]]
    out = np.stack([first, last + 1 + q], 1)
    return out[out[:, 1] - out[:, 0] >= least]


def _reach(x: np.ndarray, i: int, d: int, step: int) -> int:
    """How many words from ``i`` on (``step`` 1) or before it (-1) equal those ``d`` further on; in growing pieces."""
    n, got, size = len(x), 0, 64
    while True:
        if step > 0:
            m = min(size, n - d - i - got)
            same = x[i + got:i + got + m] == x[i + got + d:i + got + d + m] if m > 0 else np.zeros(0, bool)
        else:
            m = min(size, i - got)
            same = (x[i - got - m:i - got] == x[i - got - m + d:i - got + d])[::-1] if m > 0 else np.zeros(0, bool)
        if m <= 0 or not same.all():
            return got + (int(np.argmin(same)) if m > 0 else 0)
        got, size = got + m, size * 2


def _window_minima(g: np.ndarray, w: int) -> np.ndarray:
    """Least of each ``w`` neighbours, ``w`` a power of two."""
    size = 1
    while size < w:
        g = np.minimum(g[:-size], g[size:])
        size *= 2
    return g


def _seeds(g: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, distance) where the windows' minimum changes to a value that comes again at a distance of scale ``k``."""
    m = _window_minima(g, 1 << (k - 1))
    turns = np.flatnonzero(m[1:] != m[:-1]) + 1
    turns = turns[np.argsort(m[turns], kind="stable")]
    value = m[turns]
    d = np.diff(turns)
    good = (value[1:] == value[:-1]) & (d >= 1 << k) & (d < 2 << k)
    return turns[:-1][good], d[good]


def runs(x: np.ndarray, longest: int) -> np.ndarray:
    """(first, end, period) of all runs in an array of word hashes, in that order; ``longest`` is the most words that can repeat."""
    found = [np.column_stack([s, np.full(len(s), q)]) for q in range(1, min(DIRECT - 1, longest // EXPONENT) + 1)
             if len(s := _stretches(x, q, max(LEAST, EXPONENT * q)))]
    g, size, k = x, 1, DIRECT.bit_length() - 1
    while EXPONENT << k <= longest:
        while size < 2 << k:                           # a hash of 2 * size words from two of size, scrambled so that no structure of the words survives
            g = mix(g[:-size] * _A + mix(g[size:] * _B))
            size *= 2
        at, distance = _seeds(g, k)
        order = np.lexsort((at, distance))
        done = (0, 0)                                  # (distance, end of what is known there)
        # a hash spans more words than its window has places, so its words hold the window's last place wherever in the window it is
        for i, d in zip((at[order] + (1 << (k - 1)) - 1).tolist(), distance[order].tolist()):
            if done[0] == d and i < done[1]:
                continue
            first, end = i - _reach(x, i, d, -1), i + _reach(x, i, d, 1)
            done = (d, end)
            if end - first + d >= EXPONENT * d:
                found.append(np.array([[first, end + d, d]], np.int64))
        k += 1
    if not found:
        return np.zeros((0, 3), np.int64)
    all_runs = np.concatenate(found)
    all_runs = all_runs[np.lexsort((all_runs[:, 2], all_runs[:, 1], all_runs[:, 0]))]
    smallest = np.r_[True, (np.diff(all_runs[:, :2], axis=0) != 0).any(1)]      # one stretch has one smallest period, its divisor
    out = all_runs[smallest]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


_FIELDS = [("n_runs", pa.int64()), *[(c, pa.int64()) for c in ("start", "length", "period", "exponent_milli")], ("runs_sha256", pa.string()), ("collapsed", pa.string())]


def _best(r: list) -> tuple | None:
    """The run with the greatest length / period, compared exactly; then the first, then the smallest period."""
    best = None
    for start, end, q in r:
        if best is None or (end - start) * best[2] > (best[1] - best[0]) * q:
            best = (start, end, q)
    return best


def _gather(data: np.ndarray, ws: np.ndarray, we: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words, with a blank between two of one text; and each text's bounds."""
    size = we - ws
    if not len(ws):
        return np.zeros(0, np.uint8), np.zeros(len(first), np.int64)
    put = np.concatenate([[0], np.cumsum(size + 1)])
    starts = put[first]                                # a text's words end with a blank, which the bounds leave out
    place = np.arange(put[-1]) - np.repeat(put[:-1] - ws, size + 1)
    out = data[np.minimum(place, len(data) - 1)]
    out[put[1:] - 1] = 0x20
    return out, starts


def _one_block(texts: pa.Array, number: list, digest: bool) -> list:
    """The result columns of the texts of one block."""
    data, off = utf8(texts)
    ws, we, first = word_spans(data, off)
    h = word_hashes(data, ws, we)
    picks = []
    for t, g in enumerate(number):                     # crc32 of the id says which texts were made periodic, and how
        lo, n = int(first[t]), int(first[t + 1] - first[t])
        if g is not None and g % 10 == 0 and n:
            g //= 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            picks.append((lo, n, a, p))
    if picks:
        pick = np.arange(len(ws))
        for lo, n, a, p in picks:
            pick[lo + a:lo + n] = lo + a + np.arange(n - a) % p
        ws, we, h = ws[pick], we[pick], h[pick]
    count = np.diff(first)
    texts_of = np.repeat(np.arange(len(count)), count)
    x = np.empty(len(h) + len(count), U)               # the words of text t stand behind t border values
    x[np.arange(len(h)) + texts_of] = h
    x[first[1:] + np.arange(len(count))] = mix(np.arange(1, len(count) + 1, dtype=U) * U(0xD1342543DE82EF95))
    found = runs(x, int(count.max(initial=0)))
    owner = np.searchsorted(first + np.arange(len(first)), found[:, 0], side="right") - 1
    drop = np.zeros(len(h) + 1, np.int64)
    begin, stop = found[:, 0] - owner + found[:, 2], found[:, 1] - owner
    np.add.at(drop, begin, 1)
    np.add.at(drop, stop, -1)
    keep = np.cumsum(drop[:-1]) == 0
    kept_first = np.concatenate([[0], np.cumsum(keep)])[first]
    out, bounds = _gather(data, ws[keep], we[keep], kept_first)
    flat = out.tobytes()
    base = first + np.arange(len(first))
    upto = np.searchsorted(owner, np.arange(len(count) + 1))
    columns = [[] for _ in _FIELDS]
    for t in range(len(count)):
        lo = int(base[t])
        mine = [(s - lo, e - lo, q) for s, e, q in found[upto[t]:upto[t + 1]].tolist()]
        best = _best(mine)
        text = flat[bounds[t]:max(bounds[t], bounds[t + 1] - 1)]
        told = "".join(f"{s},{e - s},{q}\n" for s, e, q in mine)
        row = (len(mine), *((best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4),
               hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(text).hexdigest() if digest else text.decode())
        for c, v in zip(columns, row):
            c.append(v)
    return [pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS)]


def periodic_runs(docs: DataFrame, number: str | None = None, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed), one row a row of ``docs``.

    ``docs`` has doc_id and text; ``number`` names a column by which texts are made periodic before (see
    ``op12``), null: left as they are. start, length and period are those of the run with the
    greatest length / period, null where there is none. ``collapsed`` is the text without the words that a run
    holds after its first period, joined by one blank, or its SHA-256 with ``digest``. Null, empty and blank
    texts have no words. Repeated rows and rows without id are judged one by one; other
    columns are ignored; an empty table gives an empty result. A batch is cut into blocks of
    about 1 MB of text, a longer text is a block of its own and is looked at whole.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (F.col(number) if number else F.lit(None)).cast("long").alias("number"))
    schema = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed string"

    def run(batches):
        for batch in batches:
            for part in blocks(batch, "text"):
                texts = part.column(1)
                data, off = utf8(texts)
                counts = np.diff(word_spans(data, off)[2])
                columns = _one_block(texts, part.column(2).to_pylist(), digest)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), *columns], names=["doc_id", "n_words", *[c for c, _ in _FIELDS]])

    return rows.mapInArrow(task(run), schema)
