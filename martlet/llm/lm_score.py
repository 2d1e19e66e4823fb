"""Language-model scores by online logistic context mixing.

The text that is scored is its lower-cased (A-Z) words and an end. A word that occurs at
least ``SEEN`` times and makes up a share of at least 1 / ``FREQUENT`` of all training tokens
(so at most FREQUENT words do) is a path through a Huffman tree of these words; any other is an escape in that tree and then
its bytes and a blank, each a path through a Huffman tree of bytes. Every binary choice is
predicted by tables addressed by a hash of a context and the tree node: for words the node
alone and the last of the ``TOPICS`` most frequent words that was read (it tells language
and topic); for bytes the last 3 and 5 bytes and the word's whole beginning. The predictions are
mixed in the logistic domain with weights from a gate (how often the contexts were seen,
and whether they were always followed alike). The mixture is refined while a document is
read: after every ``TOGETHER`` choices the document's weights move along the gradient of
the coding cost, starting afresh every ``RUN`` choices. Costs add up to the log probability.

Counts of words, pairs and contexts cover all training rows and are summed by Spark; the
tables that they fill have a fixed size and are broadcast. Gate weights are fitted on all
choices of all training rows, each with its own occurrence taken out of the counts: tasks
count them in histograms of gate and predictions (in ``LEVELS`` steps), whose sums fix the
weights. For the base score the counts of other than frequent words are joined.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martlet.llm import words as W
from martlet.llm.tables import store, task, trim

#: Bytes of context of each predictor, from short to long; 0: the word from its beginning.
ORDERS = (3, 5, 0)
#: Slots of each predictor, as powers of two.
SLOT_BITS = (20, 21, 22)
#: Counts are stored as they are where the smaller is under FEW, but the larger from EXACT on in steps of a factor of exp(STEP); else as log odds
#: in units of UNIT and a class of their sum (less than the first of SUMS, of the second, and more), which stands for the sum beside it.
FEW, EXACT, STEP, UNIT, SUMS = 24, 512, 0.036, 1 / 60, ((60, 54), (300, 130), (math.inf, 1e9))
#: Bound of the log odds, and of their mixture.
BOUND, MIXED = 8.4, 40.0
#: Counts that bound the classes of evidence which choose a gate.
EVIDENCE = (1, 2, 3, 5, 9, 20, 60, 300)
#: Choices after which a document's weights start afresh, choices of one update, and the updates' speed.
RUN, TOGETHER, RATE = 4096, 16, 0.004
FREQUENT, SEEN = 2_000_000, 8
TABLE_TASKS = 64
CHUNK = 1 << 14
END = b"\n"                                                # can't stand in a word
CLASSES = 2 * (len(EVIDENCE) + 1)
TOPICS, TOPIC_SLOT_BITS = 255, 22
#: Steps of each predictor's log odds in the histograms of words' and letters' choices, and their cells for one gate.
LEVELS, CELLS = ((64, 64), (16, 16, 16)), 4096
#: Weight of the gates' first guess, in choices; Newton steps to the fit, and halvings of one.
PRIOR, STEPS, HALVINGS = 10.0, 12, 8

_U = np.uint64
END_HASH = int(W.word_hashes(np.frombuffer(END, np.uint8), np.array([0]), np.array([1])).view(np.int64)[0])
INPUTS = len(ORDERS)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class Code:
    """Huffman tree of symbol counts: each symbol's nodes and choices."""

    def __init__(self, counts: np.ndarray):
        size = len(counts)
        heap = [(int(c) + 1, i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        above, side = np.full(max(1, 2 * size - 1), -1, np.int32), np.zeros(max(1, 2 * size - 1), np.int8)
        for number in range(size, 2 * size - 1):
            (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
            above[x] = above[y] = number
            side[y] = 1
            heapq.heappush(heap, (a + b, number))
        depth = np.zeros(len(above), np.int64)
        for number in range(len(above) - 2, -1, -1):                   # a node's number is above its children's
            depth[number] = depth[above[number]] + 1
        self.first = np.concatenate([np.zeros(1, np.int64), np.cumsum(depth[:size])])
        self.nodes, self.bits = np.empty(self.first[-1], np.int32), np.empty(self.first[-1], np.int8)
        at, place = np.arange(size, dtype=np.int32), self.first[1:] - 1
        while len(at := at[live := above[at] >= 0]):                   # all paths at once, from their ends
            place = place[live]
            self.nodes[place], self.bits[place] = above[at] - size, side[at]
            at, place = above[at], place - 1

    def paths(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of each symbol's first choice, and one more; places of the choices in nodes and bits)."""
        size = self.first[symbols + 1] - self.first[symbols]
        begins = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
        at = np.repeat(self.first[symbols] - begins[:-1], size)
        at += np.arange(len(at))
        return begins, at


def _slots(context: np.ndarray, size: np.ndarray, scattered: np.ndarray, bits: int) -> np.ndarray:
    """Slots in a table of 2 ** bits of choices at scattered nodes, ``size`` of them in each context."""
    slot = np.repeat(context, size)
    slot ^= scattered
    slot *= _U(0xBF58476D1CE4E5B9)
    slot >>= _U(64 - bits)
    return slot.view(np.int64)


def _scattered(node: np.ndarray) -> np.ndarray:
    return node.astype(_U) * _U(0x9E3779B97F4A7C15)


def _letters(code: Code, data: np.ndarray, ws: np.ndarray, we: np.ndarray):
    """Of words and a blank after each: (index of each word's first choice, slots of each predictor, choices)."""
    size = we - ws + 1
    stop = np.cumsum(size)
    word = np.repeat(np.arange(len(ws)), size)
    depth = np.arange(stop[-1] if len(stop) else 0) - (stop - size)[word]
    text = _FOLD[data[np.minimum(ws[word] + depth, len(data) - 1)]]
    text[stop - 1] = 0x20
    h = W.mix(text.astype(_U) + _U(1))
    factor = pow(0xD6E8FEB86659FD93, 3, 1 << 64)
    powers = W._powers(factor, int(depth.max()) + 2 if len(depth) else 2)
    sums = np.cumsum(h * powers[depth])                                # of bytes with weights by depth: equal beginnings have equal sums
    whole = np.concatenate([np.zeros(1, _U), sums])[:-1]
    whole -= whole[(stop - size)[word]]
    contexts = []
    for order in ORDERS:
        c = whole
        if order:
            out = np.zeros(len(text), _U)
            for d in range(1, order + 1):
                out[d:] += np.where(depth[d:] >= d, h[:-d], _U(0)) * _U(pow(factor, d, 1 << 64))
            c = out
        contexts.append(W.mix(c + np.minimum(depth, order or 255).astype(_U) + _U(1000 + order)))
    begins, at = code.paths(text)
    size, node = np.diff(begins), _scattered(code.nodes.take(at))
    slots = [_slots(c, size, node, b) for c, b in zip(contexts, SLOT_BITS)]
    return begins[np.concatenate([np.zeros(1, np.int64), stop])], slots, code.bits.take(at)


def _topic_slots(code: Code, topic: np.ndarray, symbol: np.ndarray):
    """Of (topic, symbol) pairs: (index of each pair's first choice, tree nodes, slots of the topic's predictor, choices)."""
    begins, at = code.paths(symbol)
    node = code.nodes.take(at)
    slot = _slots(W.mix(topic.astype(_U) + _U(7)), np.diff(begins), _scattered(node), TOPIC_SLOT_BITS)
    return begins, node, slot, code.bits.take(at)


def _log_odds(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.clip(np.log((n1 + np.float32(0.3)) / (n0 + np.float32(0.3))), -BOUND, BOUND)


def _evidence(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Class of a slot: how often it was seen, twice, plus 1 if both choices occurred."""
    return (2 * np.searchsorted(EVIDENCE, n0 + n1, side="right") + ((n0 > 0) & (n1 > 0))).astype(np.uint8)


def _told(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Both counts of each slot as one number of 16 bits."""
    least, most = np.minimum(n0, n1), np.maximum(n0, n1)
    large = np.minimum(EXACT + np.rint(np.log(np.maximum(most, EXACT) / EXACT) / STEP), 1023)
    few = (2 * least + (n1 > n0)) * 1024 + np.where(most < EXACT, most, large)
    kind = np.searchsorted([most for most, _ in SUMS[:-1]], n0 + n1, side="right")
    return np.where(least < FEW, few, (2 * FEW + kind) * 1024 + np.rint((_log_odds(n0, n1) + BOUND) / UNIT)).astype(np.uint16)


def _readings():
    """Of each such number, log odds and evidence; and both with one occurrence of choice 0 (first half) or 1 taken out."""
    high, low = np.divmod(np.arange(1 << 16), 1024)
    most = np.where(low < EXACT, low, np.rint(EXACT * np.exp(STEP * (low - EXACT))))
    total = np.array([x for _, x in SUMS])[np.clip(high - 2 * FEW, 0, len(SUMS) - 1)]
    share = 1 / (1 + np.exp(BOUND - low * UNIT))
    n0, n1 = (np.where(high < 2 * FEW, few, own).astype(np.float32) for few, own in (
        (np.where(high % 2, high // 2, most), total * (1 - share)), (np.where(high % 2, most, high // 2), total * share)))
    less0, less1 = np.concatenate([np.maximum(n0 - 1, 0), n0]), np.concatenate([n1, np.maximum(n1 - 1, 0)])
    return _log_odds(n0, n1), _evidence(n0, n1), _log_odds(less0, less1), _evidence(less0, less1)


_ODDS, _SEEN, _ODDS_WITHOUT, _SEEN_WITHOUT = _readings()
_LEVEL = {levels: np.minimum((_ODDS_WITHOUT + BOUND) * (levels / (2 * BOUND)), levels - 1).astype(np.uint8) for levels in {k for own in LEVELS for k in own}}


def _gate(kind: int, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (kind * CLASSES + other.astype(np.int64)) * CLASSES + one


class Symbols:
    """Frequent words by hash, the end and the escape; topics are the most frequent words."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order]
        self.escape = len(hashes)
        self.end = int(np.searchsorted(self.hashes, END_HASH))
        self.code = Code(np.append(self.counts, max(1, total - int(counts.sum()))))
        self.topic = np.zeros(len(hashes) + 1, np.int64)
        ranked = np.lexsort((self.hashes, -self.counts))
        ranked = ranked[ranked != self.end][:TOPICS]
        self.topic[ranked] = np.arange(1, len(ranked) + 1)

    def read(self, h: np.ndarray, first: np.ndarray):
        """(symbols of each document's words and end, topics before them, index of each document's first symbol)."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        symbol = np.insert(np.where(self.hashes[at] == h, at, self.escape), first[1:], self.end)
        edges = first + np.arange(len(first))
        own = self.topic[symbol]
        last = np.where(own > 0, np.arange(len(own)), -1)
        last = np.concatenate([[-1], np.maximum.accumulate(last)[:-1]])
        begin = np.repeat(edges[:-1], np.diff(edges))
        return symbol, np.where(last >= begin, own[last], 0), edges


class Model:
    """Codes, the tables' counts, and gate weights."""

    def __init__(self, symbols: Symbols, letters: Code, word_tables: list[np.ndarray], letter_tables: list[np.ndarray], gates: np.ndarray):
        self.symbols, self.letters, self.gates = symbols, letters, np.ascontiguousarray(gates.T)
        self.word_tables, self.letter_tables = word_tables, letter_tables

    def _rows(self, kind: int, tables: list[np.ndarray], slots: list[np.ndarray], bits: np.ndarray) -> np.ndarray:
        """Log odds towards what was chosen, and last their mixture by the gates."""
        found = [t.take(s) for t, s in zip(tables, slots)]
        gate = _gate(kind, _SEEN.take(found[-2]), _SEEN.take(found[-1]))
        sign = (2 * bits - 1).astype(np.float32)
        rows = np.zeros((len(bits), INPUTS + 1), np.float32)
        mixed = self.gates[-1].take(gate)
        for k, told in enumerate(found):
            x = _ODDS.take(told)
            mixed += self.gates[k].take(gate) * x
            np.multiply(x, sign, out=rows[:, k])
        np.multiply(np.clip(mixed, -MIXED, MIXED), sign, out=rows[:, -1])
        return rows

    def word_rows(self, topic, symbol):
        begins, node, slot, bits = _topic_slots(self.symbols.code, topic, symbol)
        return begins, self._rows(0, self.word_tables, [node, slot], bits)

    def letter_rows(self, data, ws, we):
        begins, slots, bits = _letters(self.letters, data, ws, we)
        return begins, self._rows(1, self.letter_tables, slots, bits)

    def log10(self, data: np.ndarray, ws: np.ndarray, we: np.ndarray, h: np.ndarray, symbol: np.ndarray, topic: np.ndarray, word_edges: np.ndarray) -> np.ndarray:
        """log10 probability of each document, of its words with hashes ``h`` and the symbols, topics and edges read from them."""
        pairs, pair = np.unique(topic * (self.symbols.escape + 1) + symbol, return_inverse=True)
        begins, rows = self.word_rows(*np.divmod(pairs, self.symbols.escape + 1))
        spelled = np.flatnonzero(symbol == self.symbols.escape)
        word = spelled - (np.searchsorted(word_edges, spelled, side="right") - 1)     # index among words: ends taken out
        _, one, rare = np.unique(h[word], return_index=True, return_inverse=True)
        letter_begins, letter_rows = self.letter_rows(data, ws[word][one], we[word][one])
        filler = np.zeros((TOGETHER, INPUTS + 1), np.float32)
        filler[:, -1] = 80                                             # choices that cost nothing, to fill up
        begins = np.concatenate([begins[:-1], begins[-1] + letter_begins])
        rows = np.concatenate([rows, letter_rows, filler])
        token = np.insert(pair, spelled + 1, len(pairs) + rare)        # an escape is followed by the word's bytes
        edges_of_tokens = word_edges + np.searchsorted(spelled, word_edges)
        documents = len(word_edges) - 1
        size = np.diff(begins)[token]
        own = np.diff(np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])[edges_of_tokens])
        size = np.insert(size, edges_of_tokens[1:], -own % TOGETHER)   # each document is filled up to whole updates
        source = np.insert(begins[token], edges_of_tokens[1:], len(rows) - TOGETHER)
        source -= np.cumsum(size) - size
        source = np.repeat(source, size)
        source += np.arange(len(source))
        updates = -(-own // TOGETHER)
        runs = -(-own // RUN)
        doc = np.repeat(np.arange(documents), runs)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs)
        start = (np.cumsum(updates) - updates)[doc] + RUN // TOGETHER * nth
        length = np.minimum(RUN // TOGETHER, updates[doc] - RUN // TOGETHER * nth)
        order = np.argsort(-length, kind="stable")
        doc, start, length = doc[order], start[order], length[order]
        live = np.searchsorted(-length, -np.arange(length[0]), side="left")    # runs that have a t-th update
        edges = np.concatenate([np.zeros(1, np.int64), np.cumsum(live)])
        t = np.arange(edges[-1]) - np.repeat(np.cumsum(length) - length, length)
        moved = np.empty(edges[-1], np.int64)                          # all runs' first updates, their second ones, ...
        moved[edges[t] + np.repeat(np.arange(len(length)), length)] = np.repeat(start, length) + t
        source = source.reshape(-1, TOGETHER).take(moved, axis=0)
        rows = rows.view(np.complex128)[:, 0]                          # a row is taken as one number of 16 bytes
        cost, delta = np.zeros(len(doc)), np.zeros((INPUTS, len(doc)), np.float32)
        for m, lo, hi in zip(live, edges[:-1], edges[1:]):
            own = rows.take(np.ascontiguousarray(source[lo:hi].T)).view(np.float32).reshape(-1, INPUTS + 1)
            own = np.ascontiguousarray(own.T).reshape(INPUTS + 1, TOGETHER, m)
            x = own[-1]
            for k in range(INPUTS):
                x += own[k] * delta[k, :m]
            np.negative(x, out=x)
            np.minimum(x, 2 * np.float32(MIXED), out=x)
            np.exp(x, out=x)
            whole = x + 1
            x /= whole
            cost[:m] += np.log(whole, out=whole).sum(axis=0)
            for k in range(INPUTS):
                delta[k, :m] += np.float32(RATE) * (x * own[k]).sum(axis=0)
        return -np.bincount(doc, weights=cost, minlength=documents) / math.log(10)


def _parts(batches, most: int = 4 << 20):
    """The texts, in columns of about ``most`` bytes; a longer text may stand alone."""
    kept, size = [], 0
    for batch in batches:
        for part in W.blocks(batch, "text", most):
            kept.append(part)
            size += part.nbytes
            if size >= most:
                yield pa.Table.from_batches(kept).column("text")
                kept, size = [], 0
    if kept:
        yield pa.Table.from_batches(kept).column("text")


def _spelt(data: np.ndarray, ws: np.ndarray, we: np.ndarray) -> pa.Array:
    """Words of a text, A-Z lower-cased."""
    size = we - ws
    off = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
    at = np.repeat(ws - off[:-1], size)
    at += np.arange(len(at))
    return pa.StringArray.from_buffers(len(ws), pa.py_buffer(off.astype(np.int32)), pa.py_buffer(_FOLD[data[at]]))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, hash, n) over all rows."""
    def run(batches):
        for column in _parts(batches):
            data, off = W.utf8(column)
            ws, we, _ = W.word_spans(data, off)
            h, at, n = np.unique(W.word_hashes(data, ws, we, fold=True).view(np.int64), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([_spelt(data, ws[at], we[at]), pa.array(h), pa.array(n)], names=["word", "hash", "n"])

    return docs.select("text").mapInArrow(task(run), "word string, hash long, n long").groupBy("word", "hash").agg(F.sum("n").alias("n"))


def _merged(batches, rows: int = 1 << 15):
    """The same rows in fewer batches; rows here are words or pairs, far shorter than texts."""
    kept, n = [], 0
    for batch in batches:
        kept.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
            kept, n = [], 0
    if n:
        yield from pa.Table.from_batches(kept).combine_chunks().to_batches()


def _emit(tables: list[np.ndarray]):
    """Counts in parts; parts without any are left out."""
    for k, table in enumerate(tables):
        for i in range(0, table.shape[1], CHUNK):
            part = table[:, i:i + CHUNK]
            if part.any():
                yield pa.RecordBatch.from_pydict({"part": pa.array([(k << 20) + i // CHUNK], pa.int32()), "counts": pa.array([part.tobytes()], pa.binary())})


def _fill(tables: list[np.ndarray], slots: list[np.ndarray], bits: np.ndarray, weight: np.ndarray) -> None:
    for table, s in zip(tables, slots):
        np.add.at(table.reshape(-1), s + bits.astype(np.int64) * table.shape[1], weight)


def _topic_choices(symbols: Symbols, letters: Code, batch: pa.RecordBatch):
    """Of a batch of (pair, n): slots (nodes and the topic's predictor), choices and how often each was made."""
    begins, node, slot, bits = _topic_slots(symbols.code, *np.divmod(batch.column(0).to_numpy(), symbols.escape + 1))
    return [node, slot], bits, np.repeat(batch.column(1).to_numpy(), np.diff(begins))


def _letter_choices(symbols: Symbols, letters: Code, batch: pa.RecordBatch):
    """The same of a batch of (word, hash, n), for the words that are spelt."""
    h, often = batch.column(1).to_numpy(), symbols.hashes
    rare = np.flatnonzero(often[np.minimum(np.searchsorted(often, h), len(often) - 1)] != h)
    data, off = W.utf8(batch.column(0))
    begins, slots, bits = _letters(letters, data, off[:-1][rare], off[1:][rare])
    return slots, bits, np.repeat(batch.column(2).to_numpy()[rare], np.diff(begins))


def _letter_tables(codes):
    def run(batches):
        tables = [np.zeros((2, 1 << b), np.float32) for b in SLOT_BITS]
        for batch in _merged(batches):
            slots, bits, n = _letter_choices(*codes.value, batch)
            _fill(tables, slots, bits, n.astype(np.float32))
        yield from _emit(tables)
    return run


def _topic_tables(codes):
    def run(batches):
        table = np.zeros((2, 1 << TOPIC_SLOT_BITS), np.float32)
        for batch in _merged(batches):
            (_, slot), bits, n = _topic_choices(*codes.value, batch)
            _fill([table], [slot], bits, n.astype(np.float32))
        yield from _emit([table])
    return run


def _cells(kind: int, tables: list[np.ndarray], slots: list[np.ndarray], bits: np.ndarray) -> np.ndarray:
    """Cell of each choice in the histogram of its kind; its own occurrence is taken out of the counts."""
    cell, seen, own = np.zeros(len(bits), np.int64), [], bits.astype(np.int64) << 16
    for table, slot, levels in zip(tables, slots, LEVELS[kind]):
        told = own + table.take(slot)
        cell *= levels
        cell += _LEVEL[levels].take(told)
        seen.append(_SEEN_WITHOUT.take(told))
    return (_gate(0, seen[-2], seen[-1]) * CELLS + cell) * 2 + bits


def _histogram(kind: int, choices, codes, tables):
    """Counts of all choices by cell, those of letters behind those of words."""
    def run(batches):
        counts = np.zeros(2 * CLASSES * CLASSES * CELLS, np.int64)
        for batch in _merged(batches):
            slots, bits, n = choices(*codes.value, batch)
            np.add.at(counts, _cells(kind, tables.value[kind], slots, bits), n)
        hit = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(hit + kind * len(counts)), pa.array(counts[hit])], names=["cell", "n"])
    return run


def _pairs(codes):
    def run(batches):
        symbols, _ = codes.value
        for column in _parts(batches):
            data, off = W.utf8(column)
            ws, we, first = W.word_spans(data, off)
            symbol, topic, _ = symbols.read(W.word_hashes(data, ws, we, fold=True).view(np.int64), first)
            code, n = np.unique(topic * (symbols.escape + 1) + symbol, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["pair", "n"])
    return run


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in table.column("counts"))
    return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()), "counts": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def _gathered(filled: DataFrame, bits: tuple[int, ...]) -> list[np.ndarray]:
    """The summed parts as tables; their size is fixed by ``bits``."""
    counts = [np.zeros((2, 1 << b), np.float32) for b in bits]
    for row in filled.groupBy("part").applyInArrow(_add, "part int, counts binary").toLocalIterator():
        k, i = divmod(row["part"], 1 << 20)
        counts[k][:, i * CHUNK:(i + 1) * CHUNK] = np.frombuffer(row["counts"], np.float32).reshape(2, CHUNK)
    return counts


def _fit_gates(cell: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of each gate that code the choices of the histograms best: Newton's method, shorter steps where one made it worse."""
    gate, place = np.divmod(cell >> 1, CELLS)
    sign = 2.0 * (cell & 1) - 1
    x = np.zeros((len(cell), INPUTS + 1))
    x[:, -1] = 1
    for kind, levels in enumerate(LEVELS):
        own = np.flatnonzero(gate // (CLASSES * CLASSES) == kind)
        rest = place[own]
        for k in reversed(range(len(levels))):
            rest, level = np.divmod(rest, levels[k])
            x[own, k] = (level + 0.5) * (2 * BOUND / levels[k]) - BOUND
    x *= sign[:, None]                                                 # log odds towards what was chosen
    size = 2 * CLASSES * CLASSES
    start = np.full((size, INPUTS + 1), 0.5)
    start[:, -1] = 0
    gates = start.copy()

    def summed(values: np.ndarray) -> np.ndarray:
        return np.bincount(gate, weights=values, minlength=size)

    def cost(own: np.ndarray) -> np.ndarray:
        return summed(n * np.logaddexp(0, -np.einsum("ij,ij->i", x, own[gate]))) + PRIOR / 2 * ((own - start) ** 2).sum(axis=1)

    now = cost(gates)
    for _ in range(STEPS):
        miss = 1 / (1 + np.exp(np.einsum("ij,ij->i", x, gates[gate])))
        grad = np.stack([summed(n * miss * x[:, k]) for k in range(INPUTS + 1)], axis=1) - PRIOR * (gates - start)
        curve = n * miss * (1 - miss)
        bend = np.stack([[summed(curve * x[:, j] * x[:, k]) for k in range(INPUTS + 1)] for j in range(INPUTS + 1)]).transpose(2, 0, 1)
        move = np.linalg.solve(bend + PRIOR * np.eye(INPUTS + 1), grad[:, :, None])[:, :, 0]
        for _ in range(HALVINGS):
            then = cost(gates + move)
            worse = then > now
            if not worse.any():
                break
            move[worse] /= 2
        move[worse] = 0
        gates += move
        now = np.where(worse, now, then)
    return gates.astype(np.float32)


def train(docs: DataFrame, counted: DataFrame, total: int):
    """(codes, tables, gate weights) fitted on ``docs`` (text), whose word counts (word, hash, n) are given; the end is counted as a word.

    Codes (the Symbols, and the Code of bytes) and tables (of words' and of letters' predictors) are broadcast.
    """
    def bytes_of(batches):
        sums = np.zeros(256)
        for batch in _merged(batches):
            (data, off), n = W.utf8(batch.column(0)), batch.column(2).to_numpy()
            sums += np.bincount(data, weights=np.repeat(n, np.diff(off)), minlength=256)
            sums[0x20] += n.sum()
        yield pa.RecordBatch.from_pydict({"byte": pa.array(np.arange(256)), "n": pa.array(sums)})

    often = {r["hash"]: r["n"] for r in counted.select("hash", "n").filter((F.col("n") * FREQUENT >= total) & (F.col("n") >= SEEN)).collect()}
    often.setdefault(END_HASH, 0)
    symbols = Symbols(np.array(list(often), np.int64), np.array(list(often.values()), np.int64), total)
    histogram = {r["byte"]: r["n"] for r in counted.mapInArrow(bytes_of, "byte long, n double").groupBy("byte").agg(F.sum("n").alias("n")).collect()}
    sc = docs.sparkSession.sparkContext
    codes = sc.broadcast((symbols, Code(np.array([histogram.get(i, 0) for i in range(256)]))))
    pairs = store(docs.select("text").mapInArrow(task(_pairs(codes)), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs").coalesce(TABLE_TASKS)
    counted = counted.coalesce(TABLE_TASKS)
    letters = [_told(*x) for x in _gathered(counted.mapInArrow(task(_letter_tables(codes)), "part int, counts binary"), SLOT_BITS)]
    topic, = _gathered(pairs.mapInArrow(task(_topic_tables(codes)), "part int, counts binary"), (TOPIC_SLOT_BITS,))
    node = np.zeros((2, max(1, symbols.escape + 1)), np.float32)
    begins, at = symbols.code.paths(np.arange(symbols.escape + 1))
    n = np.append(symbols.counts, max(0, total - symbols.counts.sum()))
    np.add.at(node, (symbols.code.bits[at], symbols.code.nodes[at]), np.repeat(n, np.diff(begins)).astype(np.float32))
    tables = sc.broadcast(([_told(*node), _told(*topic)], letters))
    del node, topic, letters
    trim()
    parts = [rows.mapInArrow(task(_histogram(kind, choices, codes, tables)), "cell long, n long") for kind, (rows, choices) in enumerate(((pairs, _topic_choices), (counted, _letter_choices)))]
    cells = parts[0].unionAll(parts[1]).groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toArrow()
    return codes, tables, _fit_gates(*(cells.column(c).to_numpy() for c in ("cell", "n")))


def score(docs: DataFrame, train_docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for every row of ``docs``.

    Both frames have doc_id and text; other columns are ignored. A null text is empty: its
    only token is the end. ``base_score`` is the log10 probability under word counts with
    0.1 added to each, ``score`` that of the mixing model. Repeated rows get equal results,
    each from its own text; a null id stays null. With no training rows all counts are 0.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs, train_docs = (d.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) for d in (docs, train_docs))
    ends = train_docs.groupBy().agg(F.count("*").alias("n")).filter("n > 0").select(F.lit(END.decode()).alias("word"), F.lit(END_HASH).alias("hash"), "n")
    counted = store(word_counts(train_docs).unionAll(ends), "word_counts")
    total, distinct = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    codes, tables, gates = train(train_docs, counted, total)

    number = docs.withColumn("row", F.monotonically_increasing_id())
    divisor = total + 0.1 * (distinct + 1)

    def run(batches):
        own = Model(*codes.value, *tables.value, gates)
        logs = np.append(np.log10((own.symbols.counts + 0.1) / divisor), 0.0)
        counts = np.append(own.symbols.counts, 0)
        for batch in batches:
            for part in W.blocks(batch, "text"):
                data, off = W.utf8(part.column(1))
                ws, we, first = W.word_spans(data, off)
                h = W.word_hashes(data, ws, we, fold=True).view(np.int64)
                symbol, topic, edges = own.symbols.read(h, first)
                rare = symbol == own.symbols.escape
                left = np.concatenate([np.zeros(1, np.int64), np.cumsum(rare)])[edges]
                rare_words = np.delete(rare, edges[1:] - 1)
                size = np.concatenate([np.zeros(1, np.int64), np.cumsum(we - ws + 1)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(np.diff(edges)), pa.array(np.add.reduceat((counts[symbol] > 0).astype(np.int64), edges[:-1])),
                     pa.array(np.add.reduceat(logs[symbol], edges[:-1])), pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), pa.array(h[rare_words])),
                     pa.array(own.log10(data, ws, we, h, symbol, topic, edges)), pa.array(np.diff(size[first]) + 1)],
                    names=["doc_id", "row", "n_tokens", "n_often", "base", "rest", "score", "bytes"])

    scored = store(number.mapInArrow(task(run), "doc_id long, row long, n_tokens long, n_often long, base double, rest array<long>, score double, bytes long"), "scored")
    known = F.coalesce("n", F.lit(0))
    rest = (scored.select("row", F.explode("rest").alias("hash")).join(counted.select("hash", "n").hint("shuffle_hash"), "hash", "left").groupBy("row")
            .agg(F.sum(F.log10((known + 0.1) / F.lit(divisor))).alias("more"), F.count_if(known > 0).alias("n_more")))
    return (scored.join(rest, "row", "left")
            .select("doc_id", "n_tokens", (F.col("n_often") + F.coalesce("n_more", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score",
                    (-F.col("score") * math.log2(10) / F.col("bytes")).alias("bits_per_byte")))
