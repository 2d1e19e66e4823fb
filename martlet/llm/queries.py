"""The subpackage's registered queries: key -> job(spark, sf_dir), and oracle SQL where SQL can say it.

A query applies its operator to whole tables and derives the contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from martlet.llm import conversations, decontaminate, language_id, line_dedup, lm_score, near_dedup, packing, periodic, quality, sharding, substring_dedup, toxicity, url_filter
from martlet.llm.tables import documents, remainder

#: Rows of a batch that a Python task holds; texts are long, Spark's default is for narrow rows.
BATCH_ROWS = "512"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, BATCH_ROWS)


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def query(key: str, oracle: str | None = None):
    def deco(job):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return job(spark, sf_dir)
        QUERIES[key] = run
        if oracle is not None:
            ORACLE[key] = oracle
        return run
    return deco


@query("op1_substring_dedup")
def op1(spark, sf_dir):
    return substring_dedup.remove_repeats(documents(spark, sf_dir), window=50, digest=True).withColumnRenamed("kept", "kept_sha256")


@query("op2_language_id")
def op2(spark, sf_dir):
    docs = documents(spark, sf_dir)
    net = language_id.train(docs.filter(remainder("doc_id", 4) != 2))
    return (language_id.identify(docs, net)
            .select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"))


@query("op3_minhash_near_dedup")
def op3(spark, sf_dir):
    return near_dedup.near_duplicates(documents(spark, sf_dir), percent=85)


@query("op4_lm_score")
def op4(spark, sf_dir):
    docs = documents(spark, sf_dir)
    scored = lm_score.score(docs, docs.filter(remainder("doc_id", 10) != 0))
    return scored.withColumn("held_out", remainder("doc_id", 10) == 0)


@query("op9_toxicity")
def op9(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(remainder("doc_id", 5) != 0)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op8_consistent_hash_sharding")
def op8(spark, sf_dir):
    return (sharding.assign(documents(spark, sf_dir), 24)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home_shard"))


@query("op10_curve_packing")
def op10(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), length=2048)


@query("op6_decontamination", decontaminate.ORACLE)
def op6(spark, sf_dir):
    return decontaminate.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op7_line_dedup", line_dedup.ORACLE)
def op7(spark, sf_dir):
    return (line_dedup.remove_runs(documents(spark, sf_dir))
            .select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")))


@query("op5_quality_divergence")
def op5(spark, sf_dir):
    return quality.assess(documents(spark, sf_dir))


@query("op11_conversation_repair")
def op11(spark, sf_dir):
    return conversations.repair(conversations.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


@query("op12_periodic_runs")
def op12(spark, sf_dir):
    docs = documents(spark, sf_dir).withColumn("crc_of_id", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    return periodic.periodic_runs(docs, "crc_of_id", digest=True).withColumnRenamed("collapsed", "collapsed_sha256").drop("n_words")


@query("op13_url_filter", url_filter.ORACLE)
def op13(spark, sf_dir):
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.createDataFrame(url_filter.FIXED_RULES, url_filter.RULES))
