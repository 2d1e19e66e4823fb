"""Repeated passages across documents: fingerprints, confirmed passages, sharded automata.

A window is ``window`` consecutive words of one document. A word is removed if
some window over it also stands in a document with a smaller id.

1. Every document is winnowed: of its grams of half a window, each window selects
   the least hash. Equal windows select equal grams, so a window that recurs
   contains a fingerprint that recurs (``anchors``).
2. Windows around recurring fingerprints are grouped by hash; those found in two or
   more documents are confirmed. Neighbours are joined to one passage where every
   occurrence of the one is followed by the other and every occurrence of the other
   preceded by the one. So a document holds a passage whole or not at all, no passage
   lies within another, and all windows of a passage first come in the same document.
3. Documents that hold recurring fingerprints are dealt to shards. A passage goes to the
   shards that hold the least frequent of its fingerprints. Where even that one is frequent
   (``COMMON``), the passage goes only to shards in which its first window occurs, so
   a common phrase doesn't send all passages around it to all shards.
4. A shard compiles its passages to one Aho-Corasick automaton over the symbols of their
   words and streams its documents through it: each hit is an occurrence of a passage, once
   its words' 64-bit hashes agree. Shards are sized by their documents and get only passages
   of these, so automata stay bounded as the corpus grows.

Documents without a recurring fingerprint can't hold an occurrence and lose nothing.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martlet.llm import words as W
from martlet.llm.tables import store, task

WINDOW = 50
#: Fingerprints of one shard's documents, about four megabytes of text.
SHARD = 50_000
#: Places of a fingerprint from which on passages aren't sent by it.
COMMON = 64
#: A fingerprint with this share of all places or more has its rows dealt to SALTS join keys; there are at most 1 / HOT.
HOT, SALTS = 0.01, 32


def _extreme(x: np.ndarray, n: int, f) -> np.ndarray:
    """f over each n consecutive values, by doubling."""
    size = 1
    while size * 2 <= n:
        x, size = f(x[:-size], x[size:]), size * 2
    return f(x[:len(x) - (n - size)], x[n - size:]) if n > size else x


def fingerprints(h: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, gram hashes) of the grams that some window of one document selects.

    Of equal grams in a row within ``span`` positions the first and the last stay: a window over one
    between them holds one of these too, so a word said many times has few fingerprints, not one a place.
    """
    k = window // 2
    g, starts = W.grams(h, k), W.gram_starts(first, window)
    if len(h) < window or not starts.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    span = window - k + 1
    least = _extreme(g, span, np.minimum)
    least = np.where(starts[:len(least)], least, np.uint64(0))          # 0: no window starts here
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    most = _extreme(padded, span, np.maximum)[:len(g)]                  # greatest of the minima of windows over a gram
    at = np.flatnonzero((most == g) & (g != 0))
    value, doc = g[at], np.searchsorted(first, at, side="right")
    alike = (value[1:] == value[:-1]) & (doc[1:] == doc[:-1]) & (at[1:] // span == at[:-1] // span)
    keep = np.ones(len(at), bool)
    keep[1:-1] = ~(alike[1:] & alike[:-1])
    return at[keep], value[keep]


def _parts(batches):
    for batch in batches:
        for part in W.blocks(batch, "text"):
            data, off = W.utf8(part.column(part.schema.get_field_index("text")))
            ws, we, first = W.word_spans(data, off)
            yield part, data, ws, we, first


def _anchors(window: int):
    def run(batches):
        for part, data, ws, we, first in _parts(batches):
            at, fp = fingerprints(W.word_hashes(data, ws, we), first, window)
            doc = np.searchsorted(first, at, side="right") - 1
            ids = part.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(ids[doc], pa.int64()), pa.array((at - first[doc]).astype(np.int32))],
                                             names=["fp", "doc_id", "pos"])
    return run


def _windows(window: int):
    """The windows over each document's anchors, with the hashes of the words before and after (0: none)."""
    k = window // 2

    def run(batches):
        for part, data, ws, we, first in _parts(batches):
            h = W.word_hashes(data, ws, we)
            near = part.column(part.schema.get_field_index("anchors"))
            doc = np.repeat(np.arange(len(near)), np.diff(near.offsets.to_numpy()))
            at = near.flatten().to_numpy() + first[doc]
            inside = at + k <= first[doc + 1]                           # another text of this id may be longer
            at, doc = at[inside], doc[inside]
            over = np.zeros(len(h) + 1, np.int64)                       # windows that contain an anchor
            np.add.at(over, np.maximum(at - (window - k), first[doc]), 1)
            np.add.at(over, at + 1, -1)
            starts = (np.cumsum(over)[:-1] > 0) & W.gram_starts(first, window)
            at = np.flatnonzero(starts)
            doc = np.searchsorted(first, at, side="right") - 1
            ids = part.column(0).to_numpy(zero_copy_only=False)
            before = np.where(at > first[doc], h[np.maximum(at - 1, 0)], np.uint64(0)) if len(at) else np.zeros(0, np.uint64)
            after = np.where(at + window < first[doc + 1], h[np.minimum(at + window, len(h) - 1)], np.uint64(0)) if len(at) else before
            yield pa.RecordBatch.from_arrays([pa.array(W.grams(h, window)[at].view(np.int64)), pa.array(ids[doc], pa.int64()), pa.array((at - first[doc]).astype(np.int32)),
                                              pa.array(before.view(np.int64)), pa.array(after.view(np.int64))], names=["hash", "doc_id", "pos", "before", "after"])
    return run


def _passages(window: int):
    """Cut the passages of a document out of its text, with their fingerprints."""
    def run(batches):
        for part, data, ws, we, first in _parts(batches):
            h = W.word_hashes(data, ws, we)
            g = W.grams(h, window)
            starts = part.column(part.schema.get_field_index("starts"))
            doc = np.repeat(np.arange(part.num_rows), np.diff(starts.offsets.to_numpy()))
            pos, wanted, led, goes = (x.to_numpy(zero_copy_only=False) for x in starts.flatten().flatten())
            at = pos + first[doc]
            there = at + window <= first[doc + 1]
            there[there] = g[at[there]] == wanted[there].view(np.uint64)    # not so in another text of this id
            order = np.flatnonzero(there)[np.argsort(at[there], kind="stable")]
            at, doc, led, goes = at[order], doc[order], led[order], goes[order]
            head = np.ones(len(at), bool)
            head[1:] = ~((np.diff(at) == 1) & goes[:-1] & led[1:])
            a, b = at[head], at[np.roll(head, -1)] + window             # the one before a head ends its passage
            size = b - a
            ends = np.cumsum(size)
            first_word = np.concatenate([[0], ends])
            index = np.arange(first_word[-1]) + np.repeat(a - first_word[:-1], size)
            where, fp = fingerprints(h[index], first_word, window)
            fps = pa.ListArray.from_arrays(pa.array(np.searchsorted(where, first_word).astype(np.int32)), pa.array(fp.view(np.int64)))
            texts = [data[i:j].tobytes().decode() for i, j in zip(ws[a].tolist(), we[b - 1].tolist())]
            ids = part.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(g[a].view(np.int64)), pa.array(size.astype(np.int32)), pa.array(ids[doc[head]], pa.int64()), pa.array(texts, pa.string()), fps],
                                             names=["hash", "size", "first_doc", "text", "fps"])
    return run


def symbols(h: np.ndarray) -> str:
    """Two characters for each word, of two alphabets of 256, so hits begin at words and no node has more than 256 children."""
    out = np.empty((len(h), 2), "<u4")
    out[:, 0], out[:, 1] = 0x4000 + ((h >> np.uint64(8)) & np.uint64(255)), 0x5000 + (h & np.uint64(255))
    return out.tobytes().decode("utf-32-le")


class _Shard:
    """Passages of one shard as patterns of one automaton."""

    def __init__(self):
        self.automaton = ahocorasick.Automaton()
        self.compiled = False

    def add(self, first_doc: int, h: np.ndarray) -> None:
        text = symbols(h)
        same = self.automaton.get(text, None)
        if same is None:
            self.automaton.add_word(text, [(first_doc, h)])
        else:                                                           # other words with the same symbols
            same.append((first_doc, h))

    def covered(self, doc_id: int, h: np.ndarray) -> np.ndarray:
        """Which words stand in an occurrence of a passage that a smaller document has too."""
        if not self.compiled:
            self.automaton.make_automaton()
            self.compiled = True
        over = np.zeros(len(h) + 1, np.int64)
        if len(self.automaton):
            for end, passages in self.automaton.iter(symbols(h)):
                stop = (end + 1) // 2
                for first_doc, words in passages:
                    start = stop - len(words)
                    if first_doc < doc_id and np.array_equal(h[start:stop], words):
                        over[start] += 1
                        over[stop] -= 1
        return np.cumsum(over)[:-1] > 0


def _joined(data: np.ndarray, ws: np.ndarray, we: np.ndarray) -> bytes:
    """The words' bytes with one space between, without a Python object for each word."""
    if not len(ws):
        return b""
    size = we - ws + 1
    ends = np.cumsum(size)
    index = np.arange(ends[-1]) + np.repeat(ws - (ends - size), size)
    out = data[np.minimum(index, len(data) - 1)]
    out[ends - 1] = 0x20
    return out[:-1].tobytes()


def _locate(digest: bool):
    """Rows of a shard: its passages, then its documents."""
    def run(batches):
        shard, current = None, None
        for part, data, ws, we, first in _parts(batches):
            h = W.word_hashes(data, ws, we)
            number, ids, kind, version = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("shard", "doc_id", "kind", "version"))
            rows = []
            for i in range(part.num_rows):
                if number[i] != current:
                    shard, current = _Shard(), number[i]
                a, b = first[i], first[i + 1]
                if kind[i] == 0:
                    shard.add(ids[i], h[a:b].copy())
                    continue
                gone = shard.covered(ids[i], h[a:b])
                if gone.any():
                    kept = _joined(data, ws[a:b][~gone], we[a:b][~gone])
                    rows.append((ids[i], version[i], int(gone.sum()), hashlib.sha256(kept).hexdigest() if digest else kept.decode()))
            cols = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                             names=["doc_id", "version", "n_removed", "kept"])
    return run


def _whole(digest: bool):
    """Word count and words of every text, as they are where nothing is removed."""
    def run(batches):
        for part, data, ws, we, first in _parts(batches):
            kept = [_joined(data, ws[a:b], we[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            kept = [hashlib.sha256(x).hexdigest() if digest else x.decode() for x in kept]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(part.schema.get_field_index("version")), pa.array(np.diff(first)), pa.array(kept, pa.string())],
                                             names=["doc_id", "version", "n_words", "kept"])
    return run


class Dealt(NamedTuple):
    """Shard numbers with passages (hash, size, first_doc, text) and with the documents (doc_id, text) to stream through them."""
    passages: DataFrame
    documents: DataFrame


def _hot(again: DataFrame, places: int) -> Column:
    """Whether a fingerprint has HOT or more of all places: a list of at most 1 / HOT."""
    hot = [r["fp"] for r in again.filter(F.col("n") >= max(2, int(HOT * places))).select("fp").limit(int(1 / HOT)).collect()]
    return F.col("fp").isin(hot) if hot else F.lit(False)


def _with(anchors: DataFrame, prints: DataFrame, hot: Column) -> DataFrame:
    """The anchors that have one of ``prints`` (distinct fp); rows of hot ones are dealt to SALTS join keys by document."""
    salted = prints.select("fp", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    salt = F.when(hot, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    return anchors.withColumn("salt", salt).join(salted, ["fp", "salt"]).select("fp", "doc_id", "pos")


def _anchored(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc_id, text, anchors) of the documents with anchors."""
    held = anchors.groupBy("doc_id").agg(F.sort_array(F.collect_set("pos")).alias("anchors")).withColumnRenamed("doc_id", "id")
    return docs.join(held.hint("shuffle_hash"), F.col("doc_id") == F.col("id")).select("doc_id", "text", "anchors")


WINDOWS = "hash long, doc_id long, pos int, before long, after long"


def deal(named: DataFrame, window: int) -> Dealt:
    """Confirm passages and send them to the shards whose documents may hold them; ``named`` has doc_id (not null) and text."""
    spark = named.sparkSession
    anchors = store(named.mapInArrow(task(_anchors(window)), "fp long, doc_id long, pos int"), "anchors")
    places = anchors.count()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-places // SHARD))
    again = store(anchors.groupBy("fp").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n"))
                  .filter("lo < hi").select("fp", "n"), "again")
    hot = _hot(again, places)
    recurring = store(_with(anchors, again, hot), "recurring")
    holding = store(_anchored(named, recurring), "holding")

    found = holding.mapInArrow(task(_windows(window)), WINDOWS)
    starts = F.struct("pos", "hash", (F.col("b0") == F.col("b1")).alias("led"), (F.col("a0") == F.col("a1")).alias("goes"))
    firsts = (found.groupBy("hash").agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("hi"), F.min_by("pos", "doc_id").alias("pos"),
                                        F.min("before").alias("b0"), F.max("before").alias("b1"), F.min("after").alias("a0"), F.max("after").alias("a1"))
              .filter("id < hi").groupBy("id").agg(F.collect_list(starts).alias("starts")))
    cut = (holding.join(firsts.hint("shuffle_hash"), F.col("doc_id") == F.col("id")).select("doc_id", "text", "starts")
           .mapInArrow(task(_passages(window)), "hash long, size int, first_doc long, text string, fps array<long>"))
    passages = store(cut.dropDuplicates(["hash", "size"]), "passages")

    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard")
    chosen = store(passages.select("hash", "size", "first_doc", F.explode(F.array_distinct("fps")).alias("fp")).join(again, "fp")
                   .groupBy("hash", "size", "first_doc").agg(F.min_by("fp", "n").alias("fp"), F.min("n").alias("n")), "chosen")
    homes = recurring.groupBy("fp", shard).agg(F.max("doc_id").alias("last"))
    by_print = chosen.filter(F.col("n") < COMMON).join(homes, "fp").filter("last > first_doc").select("hash", "size", "shard")
    common = chosen.filter(F.col("n") >= COMMON)
    prints = (passages.join(common.select("hash", "size"), ["hash", "size"], "left_semi").select(F.explode("fps").alias("fp")).distinct())
    seen = (_anchored(named, _with(recurring, prints, hot)).mapInArrow(task(_windows(window)), WINDOWS)
            .groupBy("hash", shard).agg(F.max("doc_id").alias("last")))
    by_window = common.join(seen, "hash").filter("last > first_doc").select("hash", "size", "shard")
    wanted = by_print.unionAll(by_window).distinct()
    return Dealt(passages.select("hash", "size", "first_doc", "text").join(wanted, ["hash", "size"]), holding.select(shard, "doc_id", "text"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs`` (doc_id, text; other columns are ignored).

    ``kept`` holds the kept words joined by one space, or their SHA-256 with ``digest``.
    Null and empty texts have no words. Texts shorter than a window lose nothing. Rows of
    one id don't remove from each other; each is judged by its own text. Rows
    without id are never sources and lose nothing. A text is read whole, in one task;
    its passages are cut and located beside others' without a bound on their number.
    An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = deal(docs.filter("doc_id is not null"), window)
    version = F.xxhash64("text").alias("version")
    sent = dealt.passages.select("shard", F.col("first_doc").alias("doc_id"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("version"), "text")
    located = (sent.unionAll(dealt.documents.select("shard", "doc_id", F.lit(1).alias("kind"), version, "text"))
               .repartition("shard").sortWithinPartitions("shard", "kind", "doc_id")
               .mapInArrow(task(_locate(digest)), "doc_id long, version long, n_removed long, kept string").dropDuplicates(["doc_id", "version"]))
    whole = docs.select("doc_id", version, "text").mapInArrow(task(_whole(digest)), "doc_id long, version long, n_words long, kept string")
    located = located.select(F.col("doc_id").alias("id"), F.col("version").alias("of"), "n_removed", F.col("kept").alias("left"))
    return (whole.join(located, (F.col("doc_id") == F.col("id")) & (F.col("version") == F.col("of")), "left")
            .select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("left", "kept").alias("kept")))
