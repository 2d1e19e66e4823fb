"""Tables distributed by a key so that joins on it need no shuffle (A10).

Rows are stored in hash buckets of the key and sorted by it; the catalog knows, so Spark joins two such tables
bucket by bucket. A bucket is joined by one task. Keys with more rows than an average bucket (counted exactly; there
are fewer of them than buckets) are therefore kept in a folder beside, and joined by the ordinary join, which splits
skewed partitions.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.sources.sinks import has_data_files


class BucketedTable:
    def __init__(self, spark: SparkSession, name: str, path: str, key: str, buckets: int):
        self.spark, self.name, self.path, self.key, self.buckets = spark, name, path.rstrip("/"), key, buckets

    def save(self, df: DataFrame, sort_by: tuple[str, ...] = ()) -> None:
        per_key = df.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.count(F.lit(1)).alias("n"))
        total = df.count()
        hot = [r[0] for r in per_key.where(F.col("n") * self.buckets > total).select(self.key).collect()] if total >= 1000 * self.buckets else []
        is_hot = F.coalesce(F.col(self.key).isin(hot), F.lit(False)) if hot else F.lit(False)
        bucket = F.pmod(F.hash(self.key), F.lit(self.buckets))              # as Spark's bucketed writer counts them
        spread = F.xxhash64(*df.columns)
        # neighbouring buckets to one task, so a task writes few files; a large bucket to several
        cold = df.where(~is_hot).repartitionByRange(bucket, spread)
        (cold.write.mode("overwrite").format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key, *sort_by)
         .option("path", f"{self.path}/buckets").saveAsTable(self.name))
        if hot:
            df.where(is_hot).write.mode("overwrite").parquet(f"{self.path}/hot")

    def cold(self) -> DataFrame:
        return self.spark.table(self.name)

    def hot(self) -> DataFrame | None:
        path = f"{self.path}/hot"
        return self.spark.read.schema(self.cold().schema).parquet(path) if has_data_files(self.spark, path) else None

    def read(self) -> DataFrame:
        hot = self.hot()
        return self.cold() if hot is None else self.cold().unionByName(hot)

    def hot_keys(self) -> list:
        hot = self.hot()
        return [] if hot is None else [r[0] for r in hot.select(self.key).distinct().collect()]


def join_bucketed(a: BucketedTable, b: BucketedTable) -> DataFrame:
    """Inner join on the common key: buckets without a shuffle, hot keys of either side by the ordinary join."""
    if (a.key, a.buckets) != (b.key, b.buckets):
        raise ValueError("both tables need the same key and number of buckets")
    parts = [a.cold().join(b.cold(), a.key)]
    hot_a, hot_b = a.hot_keys(), b.hot_keys()
    if hot_a:
        parts.append(a.hot().join(b.read().where(F.col(a.key).isin(hot_a)), a.key))
    if hot_b:
        parts.append(a.cold().where(F.col(a.key).isin(hot_b)).join(b.hot(), a.key))
    return functools.reduce(DataFrame.unionByName, parts)
