"""Join operators.

No join here forces a broadcast of a side whose size grows with the data.
Fact-to-dimension joins are left to AQE, which measures the dimension at run
time and broadcasts it only under ``spark.sql.adaptive.autoBroadcastJoinThreshold``;
otherwise it is a sort-merge join whose skewed partitions AQE splits. Sides
with a proven bound (one-row aggregates, one summary row per partition) are
broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, key: str, take: dict[str, str],
           how: str = "left") -> DataFrame:
    """Attach dimension columns ``take`` (dim column -> output name).

    Only the key and the taken columns of ``dim`` are read. A duplicated
    dimension key fans the fact row out (SQL join semantics).
    """
    small = dim.select(F.col(key), *[F.col(c).alias(a) for c, a in take.items()])
    return fact.join(small, key, how)


def hot_keys(fact: DataFrame, key: str, support: float) -> list:
    """Keys that hold at least ``support`` of the rows of ``fact``: at most 1 / support.

    ``freqItems`` is one distributed pass that misses none but also names others; one exact count of
    the candidates leaves those out.
    """
    row = fact.freqItems([key], support).first()
    likely = [k for k in (row[0] if row else []) if k is not None]
    if not likely:
        return []
    c = F.col(key)
    counts = fact.groupBy(F.when(c.isin(likely), c).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r.n for r in counts)
    return [r.k for r in counts if r.k is not None and r.n >= support * total]


#: Tasks over which the rows of one hot key are spread.
SALTS = 32


def skew_split_lookup(fact: DataFrame, dim: DataFrame, key: str, take: dict[str, str],
                      how: str = "left", support: float = 0.01,
                      hot_from: DataFrame | None = None) -> DataFrame:
    """D3 / D1 for a fact side with hot keys: one join, exact.

    Rows of a hot key get a salt from their content, and its dimension rows (those of at most 1/support keys) are
    repeated for each salt, so a key holding a third of the facts never lands in one
    shuffle partition. Rows without a key are salted too; they match nothing. Without a hot key it is the plain join.

    ``hot_from`` (a plain scan holding the key) detects the hot keys when
    ``fact`` is an expensive derived frame; the keys only route rows, so the
    result is exact whichever frame they come from.
    """
    if how not in ("left", "inner"):
        raise ValueError("skew_split_lookup supports left and inner joins")
    hot = hot_keys((hot_from if hot_from is not None else fact).select(key), key, support)
    if not hot:
        return lookup(fact, dim, key, take, how)
    k, salts = F.col(key), F.lit(SALTS)
    salted = fact.withColumn("_salt", F.when(k.isNull() | k.isin(hot), F.pmod(F.xxhash64(*fact.columns), salts)).otherwise(0).cast("int"))
    small = dim.select(k, *[F.col(c).alias(a) for c, a in take.items()])
    spread = small.withColumn("_salt", F.explode(F.when(k.isin(hot), F.sequence(F.lit(0), salts - 1)).otherwise(F.array(F.lit(0)))))
    return salted.join(spread, [key, "_salt"], how).drop("_salt")


def strict_lookup(fact: DataFrame, dim: DataFrame, key: str, column: str, alias: str) -> DataFrame:
    """Correlated scalar subquery ``(select d.col from dim d where d.key = f.key)``.

    The dimension is grouped by key and joined like any other; a key with several rows raises where a
    fact asks for it, and only there. (Spark plans the subquery itself as a nested-loop join wherever it can't broadcast.)
    """
    one = (dim.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_one_key"))
           .agg(F.count(F.lit(1)).alias("_one_n"), F.max(column).alias("_one_value")))
    fail = F.raise_error(F.concat(F.lit(f"more than one row of {column} for {key} "), F.col("_one_key").cast("string")))
    value = F.when(F.col("_one_n") > 1, fail.cast(dim.schema[column].dataType)).otherwise(F.col("_one_value"))
    return fact.join(one, F.col(key) == F.col("_one_key"), "left").select(*[fact[c] for c in fact.columns], value.alias(alias))


def semi(fact: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """D10 ``key IN (SELECT key FROM ...)``: left semi join, no fan-out."""
    return fact.join(keys, on, "left_semi")


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row.

    Each column becomes an uncorrelated scalar subquery: Spark runs the
    aggregate once (merging subqueries over the same input), then uses the
    value as a literal - no join and no pairing of rows at all.
    """
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})


# Largest dimension slice broadcast after an explicit row count (rows, not bytes:
# the slices broadcast here are a few short strings per row).
BROADCAST_MAX_ROWS = 200_000


def broadcast_if_small(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``small`` only when a count proves it under ``max_rows``.

    Used for per-user or per-run slices of small control tables: the count is
    a cheap job over that slice, and beyond the bound the caller's join
    falls back to a shuffle join (which AQE may still convert at run time).
    """
    n = small.count()
    return F.broadcast(small) if n <= max_rows else small


def country_grants(auth: DataFrame, user: Column | str) -> DataFrame:
    """Grants of one user as (opu, n_rows); '' means every country, NULL matches nothing."""
    u = F.lit(user) if isinstance(user, str) else user
    return (auth.where(F.rtrim(F.col("uname")) == F.rtrim(u))
                .groupBy("opu").agg(F.count(F.lit(1)).alias("n_rows")))


def rls_weight(facts: DataFrame, auth: DataFrame, user: Column | str,
               country_col: str = "cntry_cd", weight_col: str = "_rls_w") -> DataFrame:
    """D14 row-level security as a weight instead of a nested-loop join.

    The reference joins every fact row to the user's grant rows on
    ``CASE WHEN length(opu)=0 THEN 'X' ELSE cntry_cd END =
    CASE WHEN length(opu)=0 THEN 'X' ELSE opu END``: a row survives once per
    matching grant. That count is ``n_all + n(cntry_cd)`` where ``n_all`` is
    the user's number of '' grants and ``n(c)`` the grants naming country c.
    Both come from grouped grant rows (at most one per country), so the fact
    side needs one equi-join on the country: broadcast after a row count, so
    the facts are never shuffled by a three-valued key; ``n_all`` is a
    scalar subquery. No cross join, no nested-loop join. Rows with weight 0 are dropped.
    """
    grants = country_grants(auth, user)
    n_all = grants.where(F.length("opu") == 0).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("_n_all")).scalar()
    named = broadcast_if_small(grants.where(F.length("opu") > 0)
                               .select(F.col("opu").alias("_opu"), F.col("n_rows").alias("_n_named")))
    w = (n_all + F.coalesce(F.col("_n_named"), F.lit(0))).cast("long")
    return (facts.join(named, F.col(country_col) == F.col("_opu"), "left")
                 .withColumn(weight_col, w)
                 .where(F.col(weight_col) > 0)
                 .drop("_opu", "_n_named"))


def rls_join(facts: DataFrame, auth: DataFrame, user: Column | str,
             country_col: str = "cntry_cd") -> DataFrame:
    """D14 with the reference's row semantics: each fact row appears once per
    matching grant. Replicates by the weight (at most the user's grant count)."""
    weighted = rls_weight(facts, auth, user, country_col, "_rls_w")
    return (weighted.withColumn("_rls_rep", F.explode(F.array_repeat(F.lit(1), F.col("_rls_w").cast("int"))))
                    .drop("_rls_w", "_rls_rep"))
