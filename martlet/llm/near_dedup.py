"""Near-duplicate documents: many universal hash minima, banding, verification, components.

A document's set is its distinct five-word shingles. Equal sets form a class
and are compared once. Signatures hold ``BANDS * ROWS`` minima; classes that
agree in all rows of a band share a bucket. Within a bucket each class is
paired with the bucket's least one; after a signature test the pair's full
sets are compared. Components of these links settle almost every bucket; in the
buckets that still hold two components, the remaining pairs across components
are tested too, with a longer signature that is made for these classes alone and
then on full sets, so no link inside a bucket is lost. With 24 bands of 4 rows a
pair of similarity 0.85 shares no bucket with probability below 3e-8, and one
of 0.8 below 4e-6. The signature tests lose more: with thresholds at these
similarities, banding and both tests together lose a pair with probability
below 3e-6 and 2e-5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martlet.llm import words as W
from martlet.llm.components import components
from martlet.llm.tables import store, task

SHINGLE = 5
BANDS, ROWS = 24, 4
#: Agreement of signatures under which a pair isn't compared in full: about five
#: standard deviations of the estimate (96 minima) below the threshold.
SLACK = 0.19
#: The same for the longer signature (512 minima).
WIDE, WIDE_SLACK = 512, 0.08
#: Members of one task's group when texts are compared with a bucket's least class.
GROUP = 256
#: Side of the blocks in which a bucket with several components is searched.
BLOCK = 1024

_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 1 << 63, WIDE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, WIDE, dtype=np.uint64)


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, index of each document's first value): sorted distinct shingle hashes of each document."""
    data, off = W.utf8(column)
    ws, we, first = W.word_spans(data, off)
    h = W.word_hashes(data, ws, we, fold=True)
    ok = W.gram_starts(first, SHINGLE)
    g = W.grams(h, SHINGLE)
    at = np.flatnonzero(ok[:len(g)])
    doc = np.searchsorted(first, at, side="right") - 1
    value = g[at]
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):                                     # the whole sequence as one shingle, by its length
        tail = np.concatenate([W.mix(W.grams(h[first[i]:first[i + 1]], int(count[i])) + W.U(int(count[i]))) for i in short])
        doc, value = np.concatenate([doc, short]), np.concatenate([value, tail])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[fresh], value[fresh]
    return value, np.searchsorted(doc, np.arange(len(count) + 1))


def _minima(value: np.ndarray, at: np.ndarray, count: int) -> np.ndarray:
    """Mixed minima of ``count`` multiply-shift functions over the value runs that begin at ``at``."""
    out = np.empty((len(at), count), np.uint64)
    for k in range(count):                             # the high bits order the values
        out[:, k] = np.minimum.reduceat(value * _A[k] + _B[k], at)
    return W.mix(out >> W.U(32))


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                     ("signature", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _sign(batches):
    for batch in batches:
        for part in W.blocks(batch, "text"):
            value, first = shingle_sets(part.column(1))
            n = np.diff(first)
            full = np.flatnonzero(n)
            high = np.zeros((0, BANDS * ROWS), np.uint64)
            d1, d2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            if len(full):
                at = first[:-1][full]
                high = _minima(value, at, BANDS * ROWS)
                d1[full] = np.add.reduceat(W.mix(value + W.U(1)), at)
                d2[full] = np.bitwise_xor.reduceat(W.mix(value + W.U(2)), at)
            band = np.zeros((len(full), BANDS), np.uint64)
            for r in range(ROWS):
                band = W.mix(band * W.U(0x9E3779B97F4A7C15) + high[:, r::ROWS])
            signature = (high >> W.U(56)).astype(np.uint8)
            sig, keys = [None] * len(n), [[]] * len(n)
            for i, d in enumerate(full):
                sig[d], keys[d] = signature[i].tobytes(), band[i].view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                                              pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], schema=_SIGNED)


def _agreeing(cut: float):
    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, BANDS * ROWS) for i in (2, 3))
            ok = (a == b).mean(axis=1) >= cut
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(ok))
    return run


def _linking(percent: int):
    """Rows come by group: the least class's text, then its members' texts. Returns the members that are linked with it."""
    def run(batches):
        group, base = None, None
        for batch in batches:
            for part in W.blocks(batch, "text"):
                value, first = shingle_sets(part.column(part.schema.get_field_index("text")))
                u, v, salt = (part.column(part.schema.get_field_index(c)).to_numpy() for c in ("u", "v", "salt"))
                keep = []
                for i in range(len(u)):
                    own = value[first[i]:first[i + 1]]
                    if u[i] == v[i]:
                        group, base = (u[i], salt[i]), own.copy()
                    elif group == (u[i], salt[i]):
                        small, large = (own, base) if len(own) < len(base) else (base, own)
                        at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                        both = int((large[at] == small).sum())
                        if 100 * both >= percent * (len(own) + len(base) - both):
                            keep.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(u[keep]), pa.array(v[keep])], names=["u", "v"])
    return run


def _signature_test(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    sig = classes.select("rep", "signature")
    both = (pairs.join(sig.select(F.col("rep").alias("v"), F.col("signature").alias("b")), "v")
            .join(sig.select(F.col("rep").alias("u"), F.col("signature").alias("a")), "u").select("u", "v", "a", "b"))
    return both.mapInArrow(_agreeing(percent / 100 - SLACK), "u long, v long")


def _full_test(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Links among pairs (u < v). Large groups of one u are split; each part gets u's text once."""
    sizes = pairs.groupBy("u").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    member = pairs.join(sizes, "u").select("u", "v", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("salt"))
    base = sizes.select("u", F.col("u").alias("v"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
    wanted = member.unionAll(base)
    texts = docs.join(wanted.hint("shuffle_hash"), docs["doc_id"] == wanted["v"]).select("u", "salt", "v", "text")
    return (texts.repartition("u", "salt").sortWithinPartitions("u", "salt", F.col("v") != F.col("u"), "v")
            .mapInArrow(task(_linking(percent)), "u long, v long").distinct())


def _sign_wide(batches):
    for batch in batches:
        for part in W.blocks(batch, "text"):
            value, first = shingle_sets(part.column(1))
            sig = (_minima(value, first[:-1], WIDE) >> W.U(56)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.tobytes() for x in sig], pa.binary())], names=["rep", "wide"])


def _across(cut: float):
    """Of one pair of blocks, the pairs whose components differ and whose signatures agree; each pair in its first common band only."""
    def run(rows: pa.Table) -> pa.Table:
        rep, comp, side = (rows.column(c).to_numpy() for c in ("rep", "component", "side"))
        wide = np.frombuffer(b"".join(rows.column("wide").to_pylist()), np.uint8).reshape(-1, WIDE)
        keys = np.array(rows.column("bands").to_pylist(), np.int64)
        band = rows.column("band")[0].as_py()
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if side.any() else left
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in left:
            hit = right[comp[right] != comp[i]]
            hit = hit[~(keys[hit, :band] == keys[i, :band]).any(axis=1)]
            hit = hit[(wide[hit] == wide[i]).mean(axis=1) >= cut]
            us.append(np.minimum(rep[hit], rep[i]))
            vs.append(np.maximum(rep[hit], rep[i]))
        return pa.table({"u": np.concatenate(us), "v": np.concatenate(vs)})
    return run


def _remaining(buckets: DataFrame, comps: DataFrame, classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs still to be compared: same bucket, different components, agreeing longer signatures."""
    own = buckets.join(comps.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = (own.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"))
             .filter("lo <> hi").select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts")))
    own = store(own.join(mixed, "bucket"), "mixed")
    member = own.select("rep").distinct()
    wide = (docs.join(member.hint("shuffle_hash"), docs["doc_id"] == member["rep"]).select("rep", "text")
            .mapInArrow(task(_sign_wide), "rep long, wide binary").dropDuplicates(["rep"]))
    cells = (own.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("bucket", "band", "rep", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     (F.col("block") > F.col("other")).cast("int").alias("side"))
             .join(wide, "rep").join(classes.select("rep", "bands"), "rep"))
    return (cells.groupBy("bucket", "i", "j").applyInArrow(_across(percent / 100 - WIDE_SLACK), "u long, v long")
            .distinct())


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text; other columns are ignored).

    Linked are documents whose shingle sets have ``100 * intersection >= percent * union``.
    Null and empty texts and texts without words have an empty set, are linked with nothing and kept.
    ``doc_id`` names a document: repeated rows of one id get the same result. A row without
    id is linked with nothing, has no component and is kept. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = store(docs.mapInArrow(task(_sign), "doc_id long, n_shingles long, d1 long, d2 long, signature binary, bands array<long>"), "signed")
    live = signed.filter("n_shingles > 0 and doc_id is not null")
    least = live.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    member = store(live.select("doc_id", "d1", "d2", "n_shingles").join(least, ["d1", "d2", "n_shingles"]).select("doc_id", "rep").distinct(), "classes")
    reps = member.filter("doc_id = rep").select("rep")
    classes = store(signed.join(reps, signed["doc_id"] == reps["rep"]).select("rep", "signature", "bands").dropDuplicates(["rep"]), "reps")

    banded = classes.select("rep", F.posexplode("bands").alias("band", "key")).select("rep", "band", F.xxhash64("band", "key").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("rep").alias("center"), F.max("rep").alias("last")).filter("center <> last")
    buckets = store(banded.join(shared, "bucket").select("bucket", "band", "rep", "center"), "buckets")

    star = buckets.filter("rep <> center").select(F.col("center").alias("u"), F.col("rep").alias("v")).distinct()
    links = store(_full_test(store(_signature_test(star, classes, percent), "pairs"), docs, percent), "links")
    comps = store(components(links), "components")
    rest = store(_remaining(buckets.select("bucket", "band", "rep"), comps, classes, docs, percent).join(star, ["u", "v"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = store(_full_test(rest, docs, percent), "links")
        comps = store(components(links.unionAll(more)), "components")

    of_class = member.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component_id"))
    return (signed.select("doc_id", "n_shingles").join(of_class, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
