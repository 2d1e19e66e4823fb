"""URL filter lists: which rule of a list decides each page's URL.

A rule is a host, a path prefix and an action. It fits its host and all subdomains, where
the URL's path starts with the rule's. As in the lookup protocols of browser block lists, a
URL is not compared with rules: it is expanded into expressions, host suffixes joined to path
prefixes, one for each *shape* (number of labels, length of the path) that some rule has. Their
SHA-256 digests are equi-joined on the first ``PREFIX`` bytes; a hit counts once the whole digests
are equal. Of the rules that hit, the longest decides.

A list of at most ``SMALL`` rules is broadcast after it was counted. A longer one is
shuffled, with the pages' side salted, so that an expression which a third of all
pages have (one host, one top-level domain) is spread over ``SALTS`` tasks. Each page's expressions
are folded into one row before the last shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martlet.llm.native import fold, let

ALLOW, BLOCK = "allow", "block"
#: Bytes of a digest on which expressions and rules are joined.
PREFIX = 4
#: Rules up to which a list is broadcast: some 200 bytes each.
SMALL = 20_000
SALTS = 32
RULES = "host string, path string, action string"


def _prefix(digest: Column) -> Column:
    return F.substring(digest, 1, 2 * PREFIX)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): empty for a null and for a URL without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substring(url, F.instr(url, "://") + 3, F.length(url)), "#", 1))
    rest = F.coalesce(F.substring_index(rest, "?", 1), F.lit(""))
    slash = F.instr(rest, "/")
    host = fold(F.when(slash > 0, F.substring(rest, F.lit(1), slash - 1)).otherwise(rest))
    return host, F.when(slash > 0, F.substring(rest, slash, F.length(rest))).otherwise(F.lit(""))


def _labels(host: Column) -> Column:
    return F.when(host == "", 0).otherwise(F.size(F.split(host, "\\.", -1)))


def compiled(rules: DataFrame) -> DataFrame:
    """(digest, prefix, rule, labels, path_length, host_length, verdict) of a list, one row a host and path; block beats allow there."""
    host, path = fold(F.col("host")), F.col("path")
    known = rules.filter("host is not null and path is not null and action in ('allow', 'block')")
    return (known.groupBy(host.alias("host"), path.alias("path")).agg(F.max("action").alias("verdict"))
            .select(F.sha2(F.concat_ws("\n", "host", "path").cast("binary"), 256).alias("digest"), "verdict", F.concat("host", "path").alias("rule"),
                    _labels(F.col("host")).alias("labels"), F.length("path").alias("path_length"), F.length("host").alias("host_length"))
            .withColumn("prefix", _prefix(F.col("digest"))))


def _expressions(host: Column, path: Column, shapes: list) -> Column:
    """Digests of the host's suffixes and the path's prefixes in all shapes that the URL has."""
    if not shapes:
        return F.array().cast("array<string>")
    listed = F.array(*[F.struct(F.lit(s.labels).alias("labels"), F.lit(s.path_length).alias("length")) for s in shapes])
    fitting = F.filter(listed, lambda s: (s["labels"] <= _labels(host)) & (s["length"] <= F.length(path)))
    return let(F.split(host, "\\.", -1), lambda parts: F.transform(fitting, lambda s: F.sha2(F.concat_ws(
        "\n", F.array_join(F.slice(parts, F.size(parts) - s["labels"] + 1, s["labels"]), "."), F.substring(path, F.lit(1), s["length"])).cast("binary"), 256)))


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW, small: int = SMALL) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row a row of ``pages``; the longest rule that fits decides.

    ``pages`` has page_id and url, ``rules`` host, path and action (``allow`` or ``block``); other columns
    are ignored. Where no rule fits, ``rule`` is null and the verdict ``default``. Of rules of equal length the one
    with the longer host decides, of one rule listed with both actions ``block``. Rules with a null or another
    action are left out; a rule without host fits every URL whose path fits, one without path every path.
    A URL that is null or has no ``://`` has an empty host and path. Pages without id are
    judged as any other; repeated rows come back as often as they are there. An empty list
    gives all pages the default, an empty table gives an empty result. A long URL has no more
    expressions than the list has shapes; shapes are counted over rules, not pages.
    """
    listed = compiled(rules)
    shapes = listed.select("labels", "path_length").distinct().collect()      # numbers of labels by lengths of paths
    few = listed.limit(small + 1).count() <= small

    host, path = url_parts(F.col("url").cast("string"))
    urls = pages.select("page_id", F.col("url").cast("string").alias("url")).groupBy("page_id", "url").agg(F.count("*").alias("copies"))
    urls = urls.withColumn("host", host).withColumn("path", path)
    wanted = urls.withColumn("expression", F.explode_outer(_expressions(F.col("host"), F.col("path"), shapes))).withColumn("start", _prefix(F.col("expression")))
    fits = [F.col("start") == F.col("prefix"), F.col("expression") == F.col("digest")]
    if few:
        listed = F.broadcast(listed)
    else:
        wanted = wanted.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
        listed = listed.withColumn("salted", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        fits.append(F.col("salt") == F.col("salted"))
    found = F.when(F.col("digest").isNotNull(), F.struct((F.col("host_length") + F.col("path_length")).alias("length"), "host_length", "rule", F.col("verdict").alias("action")))
    judged = (wanted.join(listed, fits[0] & fits[1] if few else fits[0] & fits[1] & fits[2], "left")
              .groupBy("page_id", "url").agg(F.max(found).alias("best"), F.max("copies").alias("copies")))
    host, path = url_parts(F.col("url"))
    return (judged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("page_id", host.alias("host"), path.alias("path"), F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict")))


#: The list of the registered query.
FIXED_RULES = [("org", "/", ALLOW), ("example.org", "/es/", BLOCK), ("example.org", "/en/1", BLOCK), ("com", "/fr/", ALLOW), ("com", "/de/", BLOCK)]

ORACLE = r"""
with rules(host, path, action) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest as (select page_id, url, case when strpos(url, '://') > 0 then regexp_extract(substr(url, strpos(url, '://') + 3), '^([^?#]*)', 1) else '' end as r from pages),
parts as (select page_id, url, translate(regexp_extract(coalesce(r, ''), '^([^/]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                 substr(coalesce(r, ''), length(regexp_extract(coalesce(r, ''), '^([^/]*)', 1)) + 1) as path, row_number() over () as k from rest),
fitting as (select k, max_by(r.host || r.path, length(r.host || r.path)) as rule, max_by(r.action, length(r.host || r.path)) as action
            from parts p join rules r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path) group by k)
select page_id, host, path, rule, coalesce(action, 'allow') as verdict from parts left join fitting using (k)
"""
