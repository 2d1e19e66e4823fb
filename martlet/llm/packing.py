"""Packing along a space-filling curve.

Documents become token ids and a vector: every word's hash gives a sign in each of ``DIMS``
directions (a random projection of the hashed bag of words), and the mean signs are the
document's place. Places are put on a Hilbert curve, rows are range-sorted by its key, and
neighbouring documents are laid end to end along the curve and cut into sequences, so
only the last sequence has padding.

Token ids are computed once and kept in a table in the shared folder. Rows are dealt to
ranges of the curve with about as many tokens each, one partition a range; a place that holds
more than a range is cut by a hash of the row. The driver gets one number of tokens for each
range (MOST_RANGES and its hot places at most), and each range lays out its rows in order from there.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from martlet.llm import words as W
from martlet.llm.tables import store, task

SEQUENCE = 2048
END_ID = 1
DIMS, BITS = 4, 10
#: Tokens of a range, about, until there are MOST_RANGES; beyond that ranges grow.
RANGE, MOST_RANGES = 1 << 24, 1 << 15
#: Points of a range that tell where to cut it.
POINTS = 1000
#: Pieces whose ids a task remembers, their bytes, and the slots by which they are found.
REMEMBERED, REMEMBERED_BYTES, SLOTS = 500_000, 1 << 24, 1 << 22


def hilbert_key(places: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of integer places (n, dims), by Skilling's transposition, vectorised over rows."""
    x = places.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:                                          # undo the excess turns of each level
        p = q - 1
        for i in range(dims):
            turned = (x[i] & q) > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(turned, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t = np.where(x[dims - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def places(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Integer places (rows, DIMS) in [0, 2**BITS): mean sign of each row's hashes in each direction."""
    count = np.diff(first)
    full = np.flatnonzero(count)
    mean = np.zeros((len(count), DIMS))
    for d in range(DIMS if len(full) else 0):
        sign = ((h >> np.uint64(7 * d + 3)) & np.uint64(1)).astype(np.int64)
        mean[full, d] = np.add.reduceat(sign, first[:-1][full]) / count[full]
    return np.minimum((mean * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


#: White space other than blank, tab and line ends: texts with any are encoded whole.
_ODD = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BLANK = np.arange(256) != 0x20


def _is_odd(text: str) -> bool:
    """Whether some blank doesn't begin a piece, or the text may hold a special token."""
    return "  " in text or " \n" in text or " \t" in text or " \r" in text or text[-1:] == " " or "<|" in text or _ODD.search(text) is not None


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of all runs [start, start + size), one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class _Encoder:
    """Token ids of texts. A blank always begins a new piece of the tokenizer's pre-split unless it stands inside
    a run of white space, so texts without such runs are cut at blanks, and the ids of pieces are remembered.

    A remembered piece is an entry of flat arrays (hash, run of bytes, run of ids), found by its hash through a table
    of one entry a slot; the bytes are compared too, so two pieces of one hash don't get each other's ids.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.opens = np.zeros(1 << 16, bool)              # tokens that begin with a blank
        for token, i in self.tokenizer.get_vocab().items():
            self.opens[i] = token[0] == "\u0120"          # how byte-level vocabularies write it
        self.ranked = self._ranked()
        self._forget()

    def _ranked(self):
        """The same byte-level merges by rank, for pieces without special tokens; about three times as fast."""
        import public_tokenizers
        import tiktoken
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]      # bytes that such vocabularies write as themselves
        letters = {chr(b): b for b in plain}
        letters.update({chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(plain))})
        ranks = {bytes(letters[c] for c in token): i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if all(c in letters for c in token)}
        ranks = {k: v for k, v in ranks.items() if v not in self.tokenizer.get_added_tokens_decoder()}
        return tiktoken.Encoding("merges", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _forget(self) -> None:
        self.slots = np.full(SLOTS, -1, np.int32)
        self.hashes, self.bytes, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, "<u2")
        self.byte_at, self.id_at = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _fresh(self, raw: np.ndarray, size: np.ndarray, led: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each piece). The pieces that a blank leads come first and are encoded in one text;
        each begins where a token with a blank does. Of the others, each is a text of its own."""
        cut = int(size[led].sum())
        together = np.array(self.ranked.encode_ordinary(raw[:cut].tobytes().decode()), "<u2")
        begins = np.flatnonzero(self.opens[together])
        if len(begins) != led.sum():                       # another pre-split than expected
            cut, led, together, begins = 0, np.zeros(len(led), bool), together[:0], begins[:0]
        ends = cut + np.cumsum(size[~led])
        single = [self.ranked.encode_ordinary(raw[e - n:e].tobytes().decode()) for e, n in zip(ends.tolist(), size[~led].tolist())]
        counts = np.concatenate([np.diff(begins, append=len(together)), np.array([len(x) for x in single], np.int64)])
        return np.concatenate([together, np.array(list(chain.from_iterable(single)), "<u2")]), counts

    def _entries(self, data: np.ndarray, h: np.ndarray, start: np.ndarray, size: np.ndarray, led: np.ndarray) -> np.ndarray:
        """The entry of each piece; pieces not known yet get one."""
        slot = (h >> np.uint64(20)) & np.uint64(SLOTS - 1)
        entry = self.slots[slot].astype(np.int64)
        miss = np.flatnonzero((entry < 0) | (self.hashes[entry] != h) if len(self.hashes) else np.ones(len(h), bool))
        _, at, back = np.unique(h[miss], return_index=True, return_inverse=True)
        new = miss[at]
        order = np.argsort(~led[new], kind="stable")
        new = new[order]
        if len(new):
            raw = data[_runs(start[new], size[new])]
            ids, counts = self._fresh(raw, size[new], led[new])
            number = len(self.hashes) + np.arange(len(new))
            rank = np.empty(len(new), np.int64)
            rank[order] = number
            entry[miss] = rank[back]
            self.slots[slot[new]] = number
            self.hashes, self.bytes, self.ids = np.concatenate([self.hashes, h[new]]), np.concatenate([self.bytes, raw]), np.concatenate([self.ids, ids])
            self.byte_at = np.concatenate([self.byte_at, self.byte_at[-1] + np.cumsum(size[new])])
            self.id_at = np.concatenate([self.id_at, self.id_at[-1] + np.cumsum(counts)])
        return entry

    def column(self, texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The ids of each text (a null has none), the hashes of all stretches between blanks and where each text's begin."""
        data, off = W.utf8(texts)
        plain = [x or "" for x in texts.to_pylist()]
        odd = np.array([_is_odd(x) for x in plain], bool)
        ws, we, first = W.word_spans(data, off, _BLANK)
        stretch = W.word_hashes(data, ws, we)
        owner = np.repeat(np.arange(len(plain)), np.diff(first))
        led = ws > off[owner]
        start, size, h = ws - led, we - ws + led, np.where(led, stretch, ~stretch)

        use = np.flatnonzero(~odd[owner])
        entry = self._entries(data, h[use], start[use], size[use], led[use])
        known = np.diff(self.byte_at)[entry]
        same = known == size[use]
        pos = _runs(self.byte_at[entry], np.where(same, known, 0))
        differs = self.bytes[pos] != data[_runs(start[use], np.where(same, known, 0))]
        if differs.any() or not same.all():               # one hash for two pieces
            bad = np.repeat(np.arange(len(use)), np.where(same, known, 0))[differs]
            odd[owner[use[np.union1d(bad, np.flatnonzero(~same))]]] = True
        counts = np.diff(self.id_at)[entry]
        raw = self.ids[_runs(self.id_at[entry], counts)].tobytes()
        upto = np.zeros(len(plain) + 1, np.int64)
        np.cumsum(np.bincount(owner[use], counts, len(plain)).astype(np.int64), out=upto[1:])
        ends = (2 * upto).tolist()
        out = [self._whole(x) if o else raw[a:b] for x, o, a, b in zip(plain, odd.tolist(), ends, ends[1:])]
        if len(self.hashes) > REMEMBERED or len(self.bytes) > REMEMBERED_BYTES:
            self._forget()
        return out, stretch, first

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return self.column(pa.array(texts, pa.string()))[0]


_encoders: dict[str, _Encoder] = {}


def _tokenise(path: str):
    def run(batches):
        if path not in _encoders:
            _encoders[path] = _Encoder(path)
        end = np.array([END_ID], "<u2").tobytes()
        for batch in batches:
            for part in W.blocks(batch, "text"):
                ids, h, first = _encoders[path].column(part.column(1))
                ids = [x + end for x in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(hilbert_key(places(h, first))), pa.array([len(x) // 2 for x in ids], pa.int64()),
                                                  pa.array(ids, pa.binary())], names=["doc_id", "key", "doc_tokens", "ids"])
    return run


def _cut(length: int, begins: dict[int, int]):
    """Lay out each range's rows from its first place on; pieces end where sequences do."""
    def run(batches):
        current, at = None, 0
        for batch in batches:
            cols = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
            for own, i, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if own != current:
                    current, at = own, begins[own]
                n, start = len(raw) // 2, 0
                wide = np.frombuffer(raw, "<u2").astype("<u4").tobytes()
                while start < n:
                    size = min(n - start, length - at % length)
                    for k, v in zip(cols, (i, start, size, zlib.crc32(wide[4 * start:4 * (start + size)]), n, at // length, at % length)):
                        cols[k].append(v)
                    start, at = start + size, at + size
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in cols.items()})
    return run


def _cuts(coded: DataFrame, total: int, ranges: int) -> list[float]:
    """Keys that cut the curve into ranges of about as many tokens each; a key that holds several ranges is named as often.

    A row gives one point for each ``unit`` of its tokens, the rest by the chance of its tie bits, so about POINTS
    points fall to a range. They settle where ranges end, not what is packed.
    """
    unit = max(1, total // (ranges * POINTS))
    rest = (F.pmod(F.col("tie"), F.lit(unit)) < F.pmod(F.col("doc_tokens"), F.lit(unit))).cast("int")
    points = coded.select(F.explode(F.array_repeat(F.col("key").cast("double"), (F.floor(F.col("doc_tokens") / unit) + rest).cast("int"))).alias("key"))
    return sorted(points.approxQuantile("key", [i / ranges for i in range(1, ranges)], 0.1 / ranges)) if total and ranges > 1 else []


def _ranged(coded: DataFrame, cuts: list[float]) -> tuple[DataFrame, int]:
    """Rows with their range, and the number of ranges; ranges rise with (key, tie).

    Rows from one cut to the next are a range. A key named n > 1 times gets n more for itself, by the high bits of
    the tie, so many equal texts, or many long ones at one place, are no single task's.
    """
    times = Counter(cuts)
    inner = sorted(times)
    split = Bucketizer(splits=[-float("inf"), *(inner or [0.0]), float("inf")], inputCol="place", outputCol="bucket")
    base = 1
    numbers = [(0, 0, 0, None)]
    for i, key in enumerate(inner or [0.0], 1):
        own = times[key] if times[key] > 1 else 0
        numbers.append((i, base, own, int(key)))
        base += own + 1
    table = coded.sparkSession.createDataFrame(numbers, "bucket int, base int, own int, hot long")
    share = F.col("tie").cast("double") / 2.0 ** 64 + 0.5
    placed = split.transform(coded.withColumn("place", F.col("key").cast("double"))).withColumn("bucket", F.col("bucket").cast("int"))
    inside = F.when((F.col("own") > 0) & (F.col("key") == F.col("hot")), F.least(F.floor(share * F.col("own")), F.col("own") - 1)).otherwise(F.col("own"))
    return placed.join(F.broadcast(table), "bucket").withColumn("range", (F.col("base") + inside).cast("int")).drop("place", "bucket", "base", "own", "hot"), base


def pack(docs: DataFrame, tokenizer: str, length: int = SEQUENCE) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all rows of ``docs``.

    ``docs`` has doc_id and text (other columns are ignored); ``tokenizer`` is the path of a
    tokenizer file with ids below 65,536, readable on every executor. A null text is empty
    and has the end id alone. Ties on the curve are ordered by a hash of id and tokens;
    repeated rows are packed each. An empty table gives no pieces.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    coded = docs.mapInArrow(task(_tokenise(tokenizer)), "doc_id long, key long, doc_tokens long, ids binary")
    coded = store(coded.withColumn("tie", F.xxhash64("doc_id", "ids")), "tokens")
    total = coded.agg(F.coalesce(F.sum("doc_tokens"), F.lit(0))).first()[0]
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(total // RANGE, MOST_RANGES))
    ranged, count = _ranged(coded, _cuts(coded, total, ranges))
    begins, at = {}, 0
    for r in ranged.groupBy("range").agg(F.sum("doc_tokens").alias("n")).orderBy("range").collect():
        begins[r["range"]] = at
        at += r["n"]
    return (ranged.select("range", "doc_id", "ids", "key", "tie").repartitionById(count, "range").sortWithinPartitions("range", "key", "tie", "doc_id")
            .select("range", "doc_id", "ids")
            .mapInArrow(task(_cut(length, begins)), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"))
