"""A table of looked-up results by domain and provider, with an expiry: lookups, updates, clean-up and figures.

The table is a DataFrame of schema.CACHE (or its columns cache_key, result_json and so on, see of_table); every operation returns a new
one. `now` is a parameter, so that results can be reproduced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import denylisted
from ..schema import CACHE

# Days that a row lives, by status; and days after which it is no longer read.
TTL = {"success": 30, "denylisted": 90, "failed": 7}
READ_DAYS = 30
OLD_COLUMNS = {"cache_key": "key", "result_json": "result", "data": "result"}


def key(domain: Column | str, provider: Column | str) -> Column:
    """md5 of domain:provider."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.md5(F.concat_ws(":", c(domain), c(provider)))


def of_table(df: DataFrame) -> DataFrame:
    """Rows of an older form of the table in the present one: renamed columns, absent ones null, status 'success' where there was none."""
    for old, new in OLD_COLUMNS.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in CACHE.fields]
    return df.select(*cols).withColumn("status", F.coalesce("status", F.lit("success")))


def latest(cache: DataFrame) -> DataFrame:
    """One row per key, the last written; of rows written at once the one that sorts last. Aggregated before the shuffle."""
    rest = [c for c in cache.columns if c != "key"]
    best = F.max(F.struct("created_at", *[F.col(c) for c in rest if c != "created_at"])).alias("b")
    return cache.groupBy("key").agg(best).select("key", *[F.col(f"b.{c}").alias(c) for c in rest]).select(*cache.columns)


def live(cache: DataFrame, now: Column, days: int = READ_DAYS) -> DataFrame:
    """The rows that may be read: not expired, and younger than so many days."""
    return cache.where((F.col("expires_at").isNull() | (F.col("expires_at") > now)) & (F.col("created_at") > now - F.make_dt_interval(F.lit(days))))


def lookup(df: DataFrame, cache: DataFrame, provider: str, now: Column, days: int = READ_DAYS, domain: str = "website_domain") -> DataFrame:
    """df with cached_status and cached_result of its domains; null where nothing is in the cache. Spark broadcasts the cache if it is
    small by its statistics, else both sides are shuffled."""
    found = live(latest(cache), now, days).where(F.col("provider") == provider).select(F.col("domain").alias("_d"), F.col("status").alias("cached_status"), F.col("result").alias("cached_result")).dropDuplicates(["_d"])
    return df.join(found, df[domain] == found["_d"], "left").drop("_d")


def not_cached(df: DataFrame, cache: DataFrame, provider: str, now: Column, days: int = READ_DAYS, domain: str = "website_domain") -> DataFrame:
    """The rows with a domain of which the cache has nothing to be read."""
    known = live(latest(cache), now, days).where(F.col("provider") == provider).select(F.col("domain").alias("_d"))
    return df.where(F.col(domain) != "").join(known, F.col(domain) == F.col("_d"), "left_anti")


def entries(results: DataFrame, now: Column) -> DataFrame:
    """Rows of (domain, provider, status, result, error_reason) as the cache stores them: with key, time and expiry by status."""
    days = F.element_at(F.create_map(*[F.lit(x) for kv in TTL.items() for x in kv]), F.col("status"))
    return results.select(key("domain", "provider").alias("key"), "domain", "provider", "status", "result", "error_reason", now.alias("created_at"), (now + F.make_dt_interval(F.coalesce(days, F.lit(TTL["success"])))).alias("expires_at"))


def upsert(cache: DataFrame, new: DataFrame) -> DataFrame:
    """The cache with the new rows in place of those of the same key, however old the new ones are."""
    fresh = latest(new)
    return latest(cache).join(fresh.select("key"), "key", "left_anti").select(*cache.columns).unionByName(fresh)


def deny(df: DataFrame, provider: str, now: Column, domain: str = "website_domain") -> DataFrame:
    """Cache rows for the domains of df that are not to be looked up."""
    bad = df.where(denylisted(domain) & (F.col(domain) != "")).select(F.col(domain).alias("domain")).distinct()
    return entries(bad.select("domain", F.lit(provider).alias("provider"), F.lit("denylisted").alias("status"), F.lit(None).cast("string").alias("result"), F.lit("denylisted").alias("error_reason")), now)


def without(cache: DataFrame, domain: str, provider: str) -> DataFrame:
    return cache.where(~((F.col("domain") == domain) & (F.col("provider") == provider)))


def without_expired(cache: DataFrame, now: Column) -> DataFrame:
    return cache.where(F.col("expires_at").isNull() | (F.col("expires_at") > now))


def without_failed(cache: DataFrame) -> DataFrame:
    """The cache for another try of what failed."""
    return cache.where(F.coalesce(F.col("status") != "failed", F.lit(True)))


def failed(cache: DataFrame, now: Column) -> DataFrame:
    """The domains and providers whose last lookup failed, and may not be tried again yet."""
    return live(latest(cache), now).where("status = 'failed'").select("domain", "provider", "error_reason")


def stats(cache: DataFrame, now: Column) -> DataFrame:
    """One row: entries, domains, providers, entries by status, expired entries."""
    return cache.agg(
        F.count("*").alias("total"), F.count_distinct("domain").alias("domains"), F.count_distinct("provider").alias("providers"), *[F.count_if(F.col("status") == s).alias(s) for s in TTL], F.count_if(F.col("expires_at") <= now).alias("expired")
    )


def history(cache: DataFrame) -> DataFrame:
    """Each row of a key with its number, from the newest."""
    return cache.withColumn("n", F.row_number().over(W.partitionBy("key").orderBy(F.desc("created_at"), *[F.desc(c) for c in cache.columns if c != "created_at"])))
