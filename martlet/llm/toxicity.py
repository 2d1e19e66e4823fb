"""Toxicity scores from class-conditional Kneser-Ney models.

Each class has an interpolated Kneser-Ney model of the bytes of words (orders up
to ``ORDER``, with marks for a word's start and end). Both classes back off to
counts that they share: orders up to ``SHARED`` are estimated once from all training
texts, so a rare expression costs much the same under either class unless its letters
were seen in one of them. A word's evidence is its log-likelihood under the toxic
class less that under the ordinary class, divided by its length; a document is
described by the mean of its words' evidence, the largest, and the excess over
``STRONG``, and a logistic curve turns these into a score.

Counts come from labelled rows: at most ``PER_CLASS`` documents a class, drawn by a hash
of the id, and of each at most ``STRETCH`` characters; one part in five of them fits the
curve instead. The driver's memory and the model's size are bounded by that sample, so it is broadcast; scoring is one pass over the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from martlet.llm import words as W
from martlet.llm.tables import task, trim

#: Labelled documents of a class that the models are fitted on, at most.
PER_CLASS = 3000
#: Characters that are taken of a labelled text in fitting, at most; longer ones give a stretch at a place drawn by the id's hash.
STRETCH = 16_384
ORDER, SHARED = 6, 2
DISCOUNT = 0.75
#: Evidence over which a word counts as strong, in nats a byte.
STRONG = 0.25
#: Slots of a task's memory of words' evidence.
CACHE = 1 << 20

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _spell(data: np.ndarray, ws: np.ndarray, we: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, depth) of the words with a mark before and after each; depth counts from the word's start mark."""
    size = we - ws + 2
    ends = np.cumsum(size)
    depth = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
    out = _FOLD[data[np.clip(np.repeat(ws, size) + depth - 1, 0, max(len(data) - 1, 0))]]
    out[ends - size], out[ends - 1] = 1, 2
    return out, depth


def _gram_keys(text: np.ndarray, depth: np.ndarray):
    """For each order, (positions whose gram of that order lies in the word, gram key). Keys are never 0."""
    h = W.mix(text.astype(np.uint64) + np.uint64(1))
    key = np.zeros(len(text), np.uint64)
    for order in range(1, ORDER + 1):
        shifted = h if order == 1 else h[:-(order - 1)]
        key[order - 1:] += shifted * np.uint64(pow(0xD6E8FEB86659FD93, order - 1, 1 << 64))   # the byte order-1 places back
        at = np.flatnonzero((depth >= order - 1) & (depth > 0))
        yield order, at, W.mix(key[at] + np.uint64(order)) | np.uint64(1)


class Grams:
    """Open-addressed table: gram -> probability and backoff weight in each class."""

    PROBES = 64

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.mask = np.uint64((1 << max(4, int(2 * len(keys)).bit_length())) - 1)
        self.keys = np.zeros(int(self.mask) + 1, np.uint64)
        self.values = np.zeros((int(self.mask) + 1, 4), np.float32)
        self.values[:, 2:] = 1
        left = np.arange(len(keys))
        for probe in range(self.PROBES):
            slot = ((keys[left] >> np.uint64(8)) + np.uint64(probe)) & self.mask
            free = self.keys[slot] == 0
            _, one = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[one]
            self.keys[slot[put]] = keys[left[put]]
            self.values[slot[put]] = values[left[put]]
            left = np.delete(left, put)
            if not len(left):
                break

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Rows (toxic p, ordinary p, toxic backoff, ordinary backoff); unknown: (0, 0, 1, 1)."""
        out = np.tile(np.float32([0, 0, 1, 1]), (len(keys), 1))
        left = np.arange(len(keys))
        for probe in range(self.PROBES):
            slot = ((keys[left] >> np.uint64(8)) + np.uint64(probe)) & self.mask
            there = self.keys[slot]
            hit = there == keys[left]
            out[left[hit]] = self.values[slot[hit]]
            left = left[~hit & (there != 0)]
            if not len(left):
                break
        return out


def _known(text: np.ndarray, depth: np.ndarray, weight: np.ndarray):
    """Order by order (gram keys, context keys, tail keys, whether it begins a word, occurrences)."""
    low = np.zeros(len(text), np.uint64)
    for order, at, key in _gram_keys(text, depth):
        own, index, member = np.unique(key, return_index=True, return_inverse=True)
        context, tail = (low[at[index] - 1], low[at[index]]) if order > 1 else (np.zeros(len(own), np.uint64),) * 2
        starts = depth[at[index]] == order - 1                       # begins with the start mark: nothing can precede it
        yield own, context, tail, starts, np.bincount(member, weights=weight[at], minlength=len(own))
        low[:] = 0
        low[at] = key


def _merged(one: tuple, other: tuple) -> tuple:
    """Grams of two texts of one order as those of both texts together."""
    keys, context, tail, starts, count = (np.concatenate(x) for x in zip(one, other))
    own, index, member = np.unique(keys, return_index=True, return_inverse=True)
    return own, context[index], tail[index], starts[index], np.bincount(member, weights=count, minlength=len(own))


def _counts(grams: list[tuple]) -> list[tuple]:
    """Per order (gram keys, context keys, tail keys, counts): highest order and word starts by occurrence, others by distinct
    continuation, the number of the next order's grams with this tail."""
    found = []
    for (own, context, tail, starts, count), up in zip(grams, [*grams[1:], None]):
        if up is not None:
            distinct = np.bincount(np.searchsorted(own, up[2]), minlength=len(own))
            count = np.where(starts, count, np.maximum(distinct, 1))
        found.append((own, context, tail, count))
    return found


def _estimate(texts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Grams:
    """Kneser-Ney estimates of two classes, orders up to SHARED from both together. A text is (bytes, depths, weights)."""
    grams = [list(_known(*text)) for text in texts]
    shared = _counts([_merged(*own) for own in list(zip(*grams))[:SHARED + 1]])
    classes = [_counts(own) for own in grams]
    table: dict[str, list] = {"keys": [], "values": []}
    lower: list[tuple[np.ndarray, np.ndarray]] = []
    backoffs: list[list[tuple[np.ndarray, np.ndarray]]] = []
    for order in range(1, ORDER + 1):
        use = [shared[order - 1]] * 2 if order <= SHARED else [c[order - 1] for c in classes]
        now = []
        for c, (own, context, tail, count) in enumerate(use):
            groups, member = np.unique(context, return_inverse=True)
            total = np.bincount(member, weights=count)
            types = np.bincount(member)
            if order == 1:
                base = np.full(len(own), 1 / 256)
            else:                                                     # probability of the gram without its first byte
                keys, p = lower[c]
                base = p[np.minimum(np.searchsorted(keys, tail), len(keys) - 1)]
            weight = DISCOUNT * types / total
            now.append((own, np.maximum(count - DISCOUNT, 0) / total[member] + weight[member] * base, groups, weight))
        lower = [(own, p) for own, p, _, _ in now]
        keys = np.unique(np.concatenate([own for own, _, _, _ in now]))
        values = np.tile(np.float32([0, 0, 1, 1]), (len(keys), 1))
        for c, (own, p, _, _) in enumerate(now):
            values[np.searchsorted(keys, own), c] = p
        table["keys"].append(keys)
        table["values"].append(values)
        if order > 1:                                                 # the backoff weight stands with the context's own gram
            above = table["keys"][-2]
            for c, (_, _, groups, weight) in enumerate(now):
                at = np.minimum(np.searchsorted(above, groups), len(above) - 1)
                ok = above[at] == groups
                table["values"][-2][at[ok], 2 + c] = weight[ok]
    return Grams(np.concatenate(table["keys"]), np.concatenate(table["values"]))


def evidence(table: Grams, data: np.ndarray, ws: np.ndarray, we: np.ndarray) -> np.ndarray:
    """Toxic less ordinary log-likelihood of each word, per byte."""
    text, depth = _spell(data, ws, we)
    p = np.full((len(text), 2), 1 / 256, np.float32)
    weight = np.ones((len(text), 2), np.float32)                     # backoff of the context that the next order uses
    before = None
    for order, at, key in _gram_keys(text, depth):
        row = table.get(key)
        if before is not None:
            weight = before[at - 1]
        else:
            weight = np.ones((len(at), 2), np.float32)
        known = row[:, :2] > 0
        p[at] = np.where(known, row[:, :2], weight * p[at])
        before = np.ones((len(text), 2), np.float32)
        before[at] = row[:, 2:]
        if order == 1:                                               # the start mark is a context, though never predicted
            start = np.flatnonzero(depth == 0)
            before[start] = table.get(_start_key(len(start)))[:, 2:]
    llr = np.log(p[:, 0]) - np.log(p[:, 1])
    llr[depth == 0] = 0
    first = np.flatnonzero(depth == 0)
    return np.add.reduceat(llr, first) / (we - ws + 1) if len(first) else np.zeros(0)


def _start_key(n: int) -> np.ndarray:
    key = W.mix(np.array([2], np.uint64))
    return np.repeat(W.mix(key + np.uint64(1)) | np.uint64(1), n)


class Model:
    """Gram table and logistic curve; picklable."""

    def __init__(self, table: Grams, mean: np.ndarray, scale: np.ndarray, curve: np.ndarray):
        self.table, self.mean, self.scale, self.curve = table, mean, scale, curve
        self.seen = None

    def __getstate__(self):
        return self.__dict__ | {"seen": None}

    def word_evidence(self, data, ws, we) -> np.ndarray:
        """Evidence of each word; words met before in this task come from a table with a slot for each hash."""
        if self.seen is None:
            self.seen = np.zeros(CACHE, np.uint64), np.zeros(CACHE, np.float32)
        keys, values = self.seen
        h = W.word_hashes(data, ws, we, fold=True)
        slot = (h >> np.uint64(20)) & np.uint64(CACHE - 1)
        out = values[slot]
        miss = np.flatnonzero(keys[slot] != h)
        if len(miss):
            _, index, inverse = np.unique(h[miss], return_index=True, return_inverse=True)
            new = evidence(self.table, data, ws[miss[index]], we[miss[index]]).astype(np.float32)
            out[miss] = new[inverse]
            at = miss[index]
            keys[slot[at]], values[slot[at]] = 0, 0
            keys[slot[at]] = h[at]
            won = keys[slot[at]] == h[at]
            values[slot[at][won]] = new[won]
        return out

    def features(self, column: pa.Array) -> np.ndarray:
        data, off = W.utf8(column)
        ws, we, first = W.word_spans(data, off, _LETTERS)
        e = self.word_evidence(data, ws, we).astype(np.float64) if len(ws) else np.zeros(0)
        out = np.zeros((len(first) - 1, 3))
        full = np.flatnonzero(np.diff(first))
        if len(full):
            at = first[:-1][full]
            out[full, 0] = np.add.reduceat(e, at) / np.diff(first)[full]
            out[full, 1] = np.maximum.reduceat(e, at)
            out[full, 2] = np.log1p(np.add.reduceat(np.maximum(e - STRONG, 0), at))
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        x = (self.features(column) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + x @ self.curve[1:], -60, 60)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -60, 60)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), x.T @ (y - p) - ridge * b)
        b += np.clip(step, -5, 5)
    return b


def _parts(texts):
    """The texts as arrays of about a megabyte, which bounds the memory of fitting."""
    batch = pa.record_batch([pa.array(texts, pa.string())], names=["text"])
    return [part.column(0) for part in W.blocks(batch, "text")]


def _spelled(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, depths, weights) of the texts' words: each word once, in the order of hashes, with its count as weight."""
    found: dict[int, tuple[bytes, int]] = {}
    for part in _parts(texts):
        data, off = W.utf8(part)
        ws, we, _ = W.word_spans(data, off, _LETTERS)
        own, one, count = np.unique(W.word_hashes(data, ws, we, fold=True), return_index=True, return_counts=True)
        for h, a, b, n in zip(own.tolist(), ws[one].tolist(), we[one].tolist(), count.tolist()):
            word, before = found.get(h) or (data[a:b].tobytes(), 0)
            found[h] = word, before + n
    words, counts = zip(*(found[h] for h in sorted(found))) if found else ((), ())
    data, off = W.utf8(pa.array(words, pa.binary()))
    return *_spell(data, off[:-1], off[1:]), np.repeat(np.array(counts, float), np.diff(off) + 2)


def fit(texts: list[str | None], toxic: np.ndarray, held: np.ndarray) -> Model:
    """Models from the rows that aren't ``held``; the curve from those that are."""
    spelled = [_spelled(t for t, y, h in zip(texts, toxic, held) if y == label and not h) for label in (1, 0)]
    if min(len(t[0]) for t in spelled) == 0 or len(set(toxic[held])) < 2:     # nothing to tell classes by: the share of toxic rows
        share = (toxic.sum() + 0.5) / (len(toxic) + 1)
        return Model(Grams(np.zeros(0, np.uint64), np.zeros((0, 4), np.float32)), np.zeros(3), np.ones(3), np.array([np.log(share / (1 - share)), 0, 0, 0]))
    model = Model(_estimate(spelled), np.zeros(3), np.ones(3), np.zeros(4))
    x = np.concatenate([model.features(part) for part in _parts(t for t, h in zip(texts, held) if h)])
    model.seen = None
    trim()
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    model.curve = _logistic((x - model.mean) / model.scale, toxic[held])
    return model


def sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """At most ``per_class`` labelled texts of each class, drawn by a hash of the id; of long ones a stretch."""
    wanted = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in wanted.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.element_at(F.create_map(*[F.lit(x) for c in (0, 1) for x in (c, min(1.0, 1.5 * per_class / max(1, counts.get(c, 0))))]), F.col("toxic"))
    order = F.xxhash64(F.lit("toxicity"), "doc_id")
    drawn = wanted.filter(F.pmod(order, F.lit(1 << 20)) < share * (1 << 20))
    drawn = drawn.withColumn("place", F.row_number().over(Window.partitionBy("toxic").orderBy(order, "doc_id"))).filter(F.col("place") <= per_class)
    spare = F.char_length("text") - STRETCH
    begin = F.when(spare > 0, F.pmod(F.xxhash64(F.lit("stretch"), "doc_id"), F.greatest(spare, F.lit(1))) + 1).otherwise(1).cast("int")
    text = F.substring("text", begin, F.lit(STRETCH)).alias("text")
    return (docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), F.col("id") == F.col("doc_id"))
            .select("doc_id", text, "toxic", (F.pmod(order, F.lit(5)) == 0).alias("held")).dropDuplicates(["doc_id"]))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fit on the labelled rows given (columns doc_id, toxic); null labels and ids are left out."""
    rows = sorted(sample(docs, labels, per_class).collect(), key=lambda r: r["doc_id"])
    return fit([r["text"] for r in rows], np.array([r["toxic"] for r in rows], int), np.array([r["held"] for r in rows], bool))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of ``docs`` (doc_id, text; other columns are ignored).

    Null, empty and wordless texts get the score of a document without evidence. Repeated
    rows get equal scores; a null id stays null. An empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = held.value
        for batch in batches:
            for part in W.blocks(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own.score(part.column(1)))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(task(run), "doc_id long, score double")
