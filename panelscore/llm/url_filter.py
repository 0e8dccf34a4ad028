"""URL filters: URL expressions matched to rules by hash prefix, confirmed by the full digest.

Every URL is expanded into (host suffix, path prefix) expressions; expressions and rules meet in an
equi-join on the first hex digits of the SHA-256 of the expression, the full digest decides, and the
longest rule wins (of equally long ones: block). Only expressions of a shape that some rule has (number
of host labels, length of path) are made, so the expansion is bounded by the rules' shapes, not by the
URL, and no rule is missed, whether or not its path ends at a ``/``.

DataFrame functions only. The rules are not broadcast by a hint: Spark broadcasts them below its own
threshold, and else splits hot join keys (one host may hold a third of all URLs).

Defined results: further columns may have any name, for inner columns take names that the table does not have; a null URL, or one without ``://``, has an empty host and path and meets no rule; a URL
without a path meets no rule (a rule's path begins with ``/``); repeated rows are judged one by one; an
empty table gives an empty result; with no rules every URL gets the default verdict.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

PREFIX_DIGITS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #``, A-Z lower-cased. Path: from there up to ``?`` or ``#``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, action) with the expression, its digest and its shape; repeated rules collapse, block wins."""
    host = F.translate("host", UPPER, LOWER)
    return (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
            .groupBy(F.concat(host, "path").alias("rule"), F.size(F.split(host, "[.]")).alias("labels"),
                     F.length("path").alias("chars"))
            .agg(F.max((F.col("action") == "block").cast("int")).alias("blocks"))
            .select("rule", "labels", "chars", "blocks", F.sha2("rule", 256).alias("rule_digest"),
                    F.substring(F.sha2("rule", 256), 1, PREFIX_DIGITS).alias("key")))


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: key, host, path, rule (null: none), verdict."""
    ready = prepared_rules(rules)
    # the rules' shapes: at most (labels of a host) x (length of a path) pairs, however many rules there are
    shapes = [(r["labels"], r["chars"]) for r in ready.select("labels", "chars").distinct().collect()]
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key).alias("_k"), host.alias("_host"), path.alias("_path"), F.monotonically_increasing_id().alias("_row"))
    fits = [F.when((F.size(F.split("_host", "[.]")) >= m) & (F.length("_path") >= n) & (F.col("_host") != ""),
                   F.concat(F.substring_index("_host", ".", -m), F.substr(F.col("_path"), F.lit(1), F.lit(n)))) for m, n in shapes]
    expressions = F.array_compact(F.array(*fits)) if fits else F.array().cast("array<string>")
    exploded = (rows.select("*", F.explode_outer(expressions).alias("_e"))
                .select("_row", "_k", "_host", "_path", F.sha2("_e", 256).alias("_digest"))
                .withColumn("_key", F.substring("_digest", 1, PREFIX_DIGITS)))
    met = exploded.join(ready, F.col("_key") == F.col("key"), "left")
    sure = F.col("_digest") == F.col("rule_digest")
    best = F.max(F.when(sure, F.struct(F.length("rule").alias("n"), F.col("blocks"), F.col("rule")))).alias("_best")
    return (met.groupBy("_row", "_k", "_host", "_path").agg(best)
            .select(F.col("_k").alias(key), F.col("_host").alias("host"), F.col("_path").alias("path"),
                    F.col("_best.rule").alias("rule"),
                    F.when(F.col("_best").isNull(), default).when(F.col("_best.blocks") == 1, "block").otherwise("allow").alias("verdict")))


RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in RULES)
    return judge_urls(table(spark, sf_dir, "pages"), spark.sql(f"SELECT * FROM VALUES {values} AS r(host, path, action)"))


ORACLE = """
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rh, rp, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (SELECT page_id, host, path, rh || rp AS rule, action,
             row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC NULLS LAST, action DESC) AS k
      FROM p LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM m WHERE k = 1
"""
