"""Repeated runs of lines, by winnowing over line hashes.

A run is ``RUN`` consecutive lines with a word (blank lines are skipped). Each run selects
its least line hash as a fingerprint, so equal runs share one. Positions of recurring
fingerprints are joined; a fingerprint is extended both ways to the runs that selected it,
and each of these is compared with the first place, by (doc_id, line), at which an equal
run stands. Lines of later runs are deleted; neighbouring deleted runs make longer ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martlet.llm.native import let, upto, winnowed, words

RUN = 3
_BLANKS = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _worded(lines: Column) -> Column:
    """Numbers (from 1) of the lines with a word."""
    return F.filter(F.transform(lines, lambda x, i: F.when(F.length(F.btrim(x, F.lit(_BLANKS))) > 0, i + 1)), lambda i: i.isNotNull())


def _fingerprints(lines: Column, run: int) -> Column:
    def of_hashes(h: Column) -> Column:
        return winnowed(h, F.size(h), 1, run, lambda g, i: F.xxhash64(F.slice(g, i, run)))
    worded = F.filter(lines, lambda x: F.length(F.btrim(x, F.lit(_BLANKS))) > 0)
    return let(F.transform(worded, lambda x: F.xxhash64(x)), of_hashes)


def later_runs(docs: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, starts): numbers (from 1, among lines with a word) at which runs start that stand earlier too."""
    found = (docs.filter("doc_id is not null").select("doc_id", F.explode(_fingerprints(_lines(F.col("text")), run)).alias("f"))
             .select("doc_id", "f.fp", "f.lo", "f.windows"))
    again = (found.groupBy("fp").agg(F.count("*").alias("n"), F.max(F.size("windows") - F.size(F.array_distinct("windows"))).alias("inside"))
             .filter("n > 1 or inside > 0").select("fp"))
    place = F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("at")
    placed = (found.join(again, "fp").select("doc_id", "fp", "lo", F.posexplode("windows").alias("step", "hash"))
              .withColumn("at", F.col("lo") + F.col("step")).withColumn("place", place.cast("decimal(31,0)")).select("doc_id", "fp", "hash", "at", "place"))
    first = placed.groupBy("fp", "hash").agg(F.min("place").alias("first"), F.max("place").alias("last")).filter("first < last").select("fp", "hash", "first")
    return (placed.join(first, ["fp", "hash"]).filter("place > first").groupBy("doc_id").agg(F.collect_set("at").alias("starts")))


def later_passages(docs: DataFrame, run: int, least: int) -> DataFrame:
    """(doc_id, passages): structs (at, size) of runs of fewer than ``run`` lines with ``least`` words or more that stand earlier too."""
    worded = F.filter(F.transform(_lines(F.col("text")), lambda x: F.struct(x.alias("line"), F.size(words(x)).alias("n"))), lambda x: x["n"] > 0)
    def of_size(xs: Column, size: int) -> Column:
        long = F.filter(upto(F.size(xs) - (size - 1)), lambda i: sum(F.get(xs, i - 1 + k)["n"] for k in range(size)) >= least)
        return F.transform(long, lambda i: F.struct(i.alias("at"), F.lit(size).alias("size"), F.xxhash64(F.lit(size), F.transform(F.slice(xs, i, size), lambda x: x["line"])).alias("hash")))
    found = let(worded, lambda xs: F.concat(*[of_size(xs, size) for size in range(1, run)]))
    place = F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("at")
    placed = (docs.filter("doc_id is not null").select("doc_id", F.explode(found).alias("f")).select("doc_id", "f.at", "f.size", "f.hash")
              .withColumn("place", place.cast("decimal(31,0)")))
    first = placed.groupBy("hash").agg(F.min("place").alias("first"), F.max("place").alias("last")).filter("first < last").select("hash", "first")
    return placed.join(first, "hash").filter("place > first").groupBy("doc_id").agg(F.collect_set(F.struct("at", "size")).alias("passages"))


def remove_runs(docs: DataFrame, run: int = RUN, least: int | None = None, carry: str | None = None) -> DataFrame:
    """(doc_id, n_lines, n_removed, text): every row with its text less the lines of later runs.

    ``docs`` has doc_id and text (a name's other columns are ignored, but the one named by ``carry``, which comes
    back as it was, so that texts need no second join to their rows); ``n_lines`` counts lines
    with a word. Texts in which nothing repeats come back unchanged, nulls as null. Documents
    of fewer than ``run`` lines lose nothing, unless ``least`` is given: then shorter runs that
    hold ``least`` words or more count as well. Rows of one id are one document: repeated rows
    get equal results. Rows without id neither lose lines nor count as earlier. An empty
    table gives an empty result.
    """
    own = [] if carry is None else [carry]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *own)
    later = later_runs(docs, run).withColumnRenamed("doc_id", "id")
    joined = docs.join(later.hint("shuffle_hash"), F.col("doc_id") == F.col("id"), "left").select("doc_id", "text", "starts", *own)
    if least is not None:
        short = later_passages(docs, run, least).withColumnRenamed("doc_id", "id")
        joined = joined.join(short.hint("shuffle_hash"), F.col("doc_id") == F.col("id"), "left").drop("id")
    lines = joined.withColumn("lines", _lines(F.col("text"))).withColumn("worded", _worded(F.col("lines")))
    none = F.array().cast("array<int>")
    gone = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.slice("worded", s, run))))
    gone = F.when(F.col("starts").isNotNull(), gone).otherwise(none)
    if least is not None:
        more = F.flatten(F.transform("passages", lambda x: F.slice(F.col("worded"), x["at"], x["size"])))
        gone = F.array_distinct(F.concat(gone, F.coalesce(more, none)))
    kept = let(F.array_except(F.sequence(F.lit(1), F.size("lines")), F.col("gone")), lambda at: F.array_join(F.transform(at, lambda i: F.get(F.col("lines"), i - 1)), "\n"))
    return (lines.withColumn("gone", gone)
            .select("doc_id", F.size("worded").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_removed"),
                    F.when(F.size("gone") > 0, kept).otherwise(F.col("text")).alias("text"), *own))


ORACLE = """
WITH l AS (SELECT doc_id, j, line, row_number() OVER (PARTITION BY doc_id ORDER BY j) AS i
           FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS j FROM documents)
           WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
runs AS (SELECT a.doc_id, a.i, a.line AS x, b.line AS y, c.line AS z FROM l a JOIN l b ON a.doc_id = b.doc_id AND b.i = a.i + 1 JOIN l c ON a.doc_id = c.doc_id AND c.i = a.i + 2),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, i) AS k FROM runs) WHERE k > 1),
gone AS (SELECT DISTINCT l.doc_id, l.j FROM l JOIN later r ON l.doc_id = r.doc_id AND l.i BETWEEN r.i AND r.i + 2),
kept AS (SELECT a.doc_id, string_agg(a.line, chr(10) ORDER BY a.j) AS text
         FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS j FROM documents) a
         LEFT JOIN gone g ON a.doc_id = g.doc_id AND a.j = g.j WHERE g.j IS NULL GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_lines, coalesce(m, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM l GROUP BY 1) USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS m FROM gone GROUP BY 1) USING (doc_id)
"""
