"""The corpus pipeline: five stages, each one operator of ``martlet.llm`` over all rows that came before.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it to the shared
folder and reads it again as the next stage's docs. Stages but the last return the columns
of documents, whatever other columns those have. Stages decide row by row, also where rows have no id or share one: language ID and
decontamination by a hash of id and text, the two others by a number that counts rows in the order of
(id, hash of the text), rows without id last; it is stored with the rows for the length of the stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martlet.llm import decontaminate, language_id, line_dedup, near_dedup, packing
from martlet.llm.queries import prepare, tokenizer_path
from martlet.llm.tables import documents, store

#: Mean probability of the predicted language under which a document has no language.
MIN_SCORE = 0.3
#: Similarity, in percent, from which documents are near copies here (op3's own contract says 85).
NEAR = 80
#: Words from which on a repeated passage of one or two lines goes too (op7's SQL has three lines or more).
PASSAGE = 50


def _fresh() -> str:
    """A column name that no table has."""
    return f"_{uuid.uuid4().hex}"


def _told_apart() -> Column:
    return F.xxhash64("doc_id", "text")


def _without(docs: DataFrame, name: str, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows whose ``name`` is a doc_id of ``gone``; the column goes too."""
    key = _fresh()
    return docs.join(gone.select(F.col("doc_id").alias(key)).distinct(), F.col(name) == F.col(key), "left_anti").drop(name)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number of their own in a new column, rising with the id."""
    name, order = _fresh(), [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    rows = docs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id())
    return store(rows, "stage-rows"), name


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text, letters or a clear language go; trained on the rows with a known language. Without any, all texts with a letter stay."""
    prepare(spark)
    net, name = language_id.train(docs), _fresh()
    docs = docs.withColumn(name, _told_apart())
    if net.languages == ["und"]:
        return docs.filter(F.col("text").rlike("\\p{L}")).drop(name)
    told = language_id.identify(docs.select(F.col(name).alias("doc_id"), "text"), net)
    return _without(docs, name, told.filter((F.col("lang_pred") == "und") | (F.col("score") < MIN_SCORE)))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of three lines, or of fewer with PASSAGE words, go; a document of which no line is left goes too. ``n_chars`` follows the text."""
    rows, name = _numbered(docs)
    rest = _fresh()
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias(rest)
    told = line_dedup.remove_runs(rows.select(F.col(name).alias("doc_id"), "text", others), least=PASSAGE, carry=rest)
    told = told.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col(rest)["n_chars"]).cast(docs.schema["n_chars"].dataType)
    new = {"text": F.col("text"), "n_chars": n_chars}
    return told.select(*[new.get(c, F.col(rest)[c]).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the least id."""
    prepare(spark)
    rows, name = _numbered(docs)
    near = near_dedup.near_duplicates(rows.select(F.col(name).alias("doc_id"), "text"), percent=NEAR)
    return _without(rows, name, near.filter("not kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    items, name = spark.read.parquet(f"{sf_dir}/benchmark.parquet"), _fresh()
    docs = docs.withColumn(name, _told_apart())
    return _without(docs, name, decontaminate.hits(docs.select(F.col(name).alias("doc_id"), "text"), items))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all that is left, in sequences of 2048 tokens along the curve."""
    prepare(spark)
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), length=2048)


STAGES = [("language_id", identify), ("line_dedup", drop_lines), ("near_dedup", drop_near_duplicates), ("decontamination", drop_contaminated), ("packing", pack)]

#: The network, the merged tokenizer and the curve have no SQL form. A test holds what ``run`` returns against plain versions of the
#: stages after language ID, given what that keeps.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
