"""Benchmark decontamination by winnowing.

Documents and benchmark items are lists of lower-cased words. Of the grams of ``GRAM``
words in each window of ``WINDOW`` words the least hash is kept as a fingerprint, so
equal windows keep equal fingerprints and no shared window is missed. Fingerprints of
documents are joined with those of the items; a hit is extended to the windows that
selected it, and counts if the whole window's hash equals an item's too. Items shorter
than a window are one window of their own length and are compared at every word position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martlet.llm.native import NOT_ALNUM, fold, let, upto, winnowed, words
from martlet.llm.tables import store

WINDOW, GRAM = 10, 5


def _grams(w: Column, n: int) -> Column:
    """Hashes of n consecutive words at each place; of the words' hashes, so a word is read once."""
    return let(F.transform(w, lambda x: F.xxhash64(x)),
               lambda v: F.transform(upto(F.size(v) - (n - 1)), lambda i: F.xxhash64(*[F.get(v, i + (k - 1)) for k in range(n)])))


def _fingerprints(w: Column) -> Column:
    """Structs (fp, lo, windows) of a word list."""
    def of_grams(h: Column) -> Column:
        return winnowed(h, F.size(w), GRAM, WINDOW, lambda g, i: F.xxhash64(F.get(g, i - 1), F.get(g, i + (WINDOW - GRAM - 1))))
    return let(_grams(w, GRAM), of_grams)


def _worded(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key), words(fold(F.col("text").cast("string")), NOT_ALNUM).alias("w"))


def _windows(df: DataFrame, key: str) -> DataFrame:
    """(key, fp, at, hash): all windows of each row by the fingerprint that they select."""
    found = df.filter(F.size("w") >= WINDOW).select(key, F.explode(_fingerprints(F.col("w"))).alias("f"))
    return found.select(key, "f.fp", "f.lo", "f.windows")


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, at, length): occurrences of item windows; ``at`` counts words from 1."""
    worded, asked = _worded(docs, "doc_id"), _worded(items, "item_id")
    asked_windows = (_windows(asked, "item_id").select("item_id", "fp", F.explode("windows").alias("hash")).distinct())
    met = _windows(worded, "doc_id").join(asked_windows.select("fp").distinct(), "fp", "left_semi")
    extended = met.select("doc_id", "fp", "lo", F.posexplode("windows").alias("step", "hash"))
    out = extended.join(asked_windows, ["fp", "hash"]).select("doc_id", "item_id", (F.col("lo") + F.col("step")).alias("at"), F.lit(WINDOW).alias("length"))
    short = asked.filter((F.size("w") > 0) & (F.size("w") < WINDOW))
    lengths = sorted(r["n"] for r in short.select(F.size("w").alias("n")).distinct().collect())      # at most WINDOW - 1 lengths
    if not lengths:
        return out

    def placed(w: Column) -> Column:
        """Structs (length, at, hash) of the grams of all these lengths, so one pass finds them."""
        return F.flatten(F.array(*[F.transform(_grams(w, n), lambda h, i: F.struct(F.lit(n).alias("length"), (i + 1).alias("at"), h.alias("hash"))) for n in lengths]))

    whole = short.select("item_id", F.explode(placed(F.col("w"))).alias("g"), F.size("w").alias("size")).filter("g.length = size").select("item_id", "g.length", "g.hash")
    return out.unionAll(worded.select("doc_id", F.explode(placed(F.col("w"))).alias("g")).select("doc_id", "g.*").join(whole, ["length", "hash"])
                        .select("doc_id", "item_id", "at", "length"))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``docs``.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored.
    ``n_hit`` counts words inside any occurrence of an item's window, ``n_items`` items with
    an occurring window. Null and empty texts have no words. ``doc_id`` names a document:
    repeated rows get equal results, and rows without id are never hit. Empty tables
    give no rows, or rows without hits.
    """
    found = store(hits(docs.filter("doc_id is not null"), items), "hits")
    words_hit = (found.select("doc_id", "at", "length").distinct()
                 .select("doc_id", F.explode(F.sequence("at", F.col("at") + F.col("length") - 1)).alias("word")).distinct()
                 .groupBy("doc_id").agg(F.count("*").alias("n_hit")))
    by_item = (found.select("doc_id", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
               .groupBy("doc_id").agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items")))
    told = words_hit.join(by_item, "doc_id")
    return (_worded(docs, "doc_id").select("doc_id", F.size("w").cast("long").alias("n_words")).join(told, "doc_id", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
                    F.sha2(F.coalesce("items", F.lit("")).cast("binary"), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated")))


ORACLE = """
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
       FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT d.*, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (n, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
