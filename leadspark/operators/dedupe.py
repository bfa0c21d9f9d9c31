"""Entity resolution: equal phones, equal domains, alike names and addresses; one best record per group."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..functions import match_key
from ..vocab import FREE_MAIL
from .alike import Blocks, Side
from .components import components, cut

LEAST = 85.0
#: name similarity below which no address can lift a pair to LEAST
NAME_LEAST = (LEAST - 30) / 0.7


def indel(a: str, b: str) -> float:
    """100 * 2 * LCS / (len + len): the ratio of insertions and deletions. Bit-parallel."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & where.get(c, 0)
        s = (s + u) | (s - u)
    return 200.0 * (len(a) - (s & full).bit_count()) / (len(a) + len(b))


def token_sort_ratio(a: str, b: str) -> float:
    return indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text with any part of the longer of its length, or shorter at the ends."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    n = len(a)
    parts = {b[max(0, i) : i + n] for i in range(1 - n, len(b))}
    return max(indel(a, p) for p in parts if p)


def name_address_score(n1: str, a1: str, n2: str, a2: str) -> float:
    """0.7 name + 0.3 address where the names reach 70 and both addresses are there; else 0.8 name."""
    if not n1 or not n2:
        return 0.0
    name = token_sort_ratio(n1, n2)
    return 0.7 * name + 0.3 * partial_ratio(a1, a2) if name >= 70 and a1 and a2 else 0.8 * name


@F.pandas_udf(T.DoubleType())
def _score(n1: pd.Series, a1: pd.Series, n2: pd.Series, a2: pd.Series) -> pd.Series:
    out = []
    for p, q, r, s in zip(n1, a1, n2, a2):
        name = token_sort_ratio(p, r)
        out.append(0.7 * name + 0.3 * partial_ratio(q, s) if name >= NAME_LEAST else 0.8 * name)
    return pd.Series(out)


def phone_usable(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (F.length(c) >= 10)


def domain_usable(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != "") & ~F.lower(c).isin(*FREE_MAIL)


def key_edges(df: DataFrame, id: str = "source_row_id") -> DataFrame:
    """Edges from every row to the first row of its phone and of its domain. Minima are aggregated before they are shuffled."""
    out = None
    for key, ok in (("phone_e164", phone_usable("phone_e164")), ("website_domain", domain_usable("website_domain"))):
        rows = df.where(ok).select(F.col(id).cast("long").alias("b"), F.col(key).alias("k"))
        first = rows.groupBy("k").agg(F.min("b").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
        e = rows.join(first, "k").where("a <> b").select("a", "b")
        out = e if out is None else out.union(e)
    return out


def _signature(c: str) -> Column:
    """Which of the letters a to z a text has once, and which twice or more, as bits."""
    times = lambda v: F.length(c) - F.length(F.replace(F.col(c), F.lit(v)))
    made = F.lit(0).cast("long")
    for k, v in enumerate("abcdefghijklmnopqrstuvwxyz"):
        made = made + F.when(times(v) > 1, F.lit(3 << 2 * k)).when(times(v) > 0, F.lit(1 << 2 * k)).otherwise(0).cast("long")
    return made


def fuzzy_edges(df: DataFrame, linked: DataFrame, id: str = "source_row_id", block: Column | None = None) -> DataFrame:
    """Edges between a row that no key linked and a later row of alike name and address.

    Without a block every such row meets every later row within exact bounds (see all_pairs); the work is quadratic. With a block (a column
    of the row, such as its town) only rows of one block meet. The bounds never lose a pair: names of a pair differ in length by less than
    11 to 17, and share the letters that their longest common subsequence needs."""
    words = F.array_sort(F.filter(F.split(match_key("business_name"), r"[\t-\r\x1c-\x20\x85\p{Z}]+"), lambda w: w != ""))
    rows = df.select(F.col(id).cast("long").alias("i"), F.array_join(words, " ").alias("n"), match_key("address").alias("a"), (block if block is not None else F.lit("")).alias("k")).where("n <> '' and a <> ''")
    alone = linked.select(F.col("id").alias("i"), F.lit(False).alias("o")).distinct()
    rows = rows.join(alone, "i", "left").withColumn("o", F.coalesce("o", F.lit(True))).withColumn("l", F.length("n"))
    if block is None:
        return all_pairs(rows.drop("k"))
    # a bit for the first and the second of each letter: one inserted or deleted letter changes one bit at most
    rows = cut(rows.withColumn("s", _signature("n")))
    x = rows.where("o").select(*[F.col(c).alias(f"{c}1") for c in rows.columns])
    y = rows.select(*[F.col(c).alias(f"{c}2") for c in rows.columns])
    close = (F.col("i1") < F.col("i2")) & (11 * F.greatest("l1", "l2") <= 17 * F.least("l1", "l2")) & (100.0 * F.bit_count(F.col("s1").bitwiseXOR(F.col("s2"))) <= (100.0 - NAME_LEAST) * (F.col("l1") + F.col("l2")) + 1e-6)
    pairs = x.join(y, F.col("k1") == F.col("k2")).where(close & F.col("k1").isNotNull())
    shared = sum((F.least(*[F.length(F.col(c)) - F.length(F.replace(F.col(c), F.lit(v))) for c in ("n1", "n2")]) for v in "aeinorst"), F.lit(0))
    others = F.least(*[F.length(F.translate(F.col(c), "aeinorst", "")) for c in ("n1", "n2")])
    pairs = pairs.where(200.0 * (shared + others) >= NAME_LEAST * (F.col("l1") + F.col("l2")))
    return pairs.where(_score("n1", "a1", "n2", "a2") >= LEAST).select(F.col("i1").alias("a"), F.col("i2").alias("b"))


#: Rows of a block of all_pairs: two blocks are in a task at once.
ROWS = 80_000


def all_pairs(rows: DataFrame, most: int = ROWS) -> DataFrame:
    """Edges (a, b) of rows (i id, n name with its words sorted, a address, o whether no key linked it, l the name's length) that score
    LEAST or more: a before b, and a linked by no key. The rows are cut into blocks by range, those without a link first and by length; every
    two blocks that can hold a pair meet in a task."""
    rows = cut(rows)  # counting, sampling for the ranges and cutting them would make the keys anew
    n = rows.count()
    if not n:
        return rows.sparkSession.createDataFrame([], "a long, b long")
    # four blocks at least make some tasks of a table that is worth it
    rows = rows.repartitionByRange(max(-(-n // most), min(4, -(-n // 2000))), F.col("o").desc(), "l", "n", "i")
    rows = cut(rows.withColumn("b", F.spark_partition_id()))
    size = rows.groupBy("b").agg(F.min("l").alias("low"), F.max("l").alias("high"), F.max("o").alias("o")).orderBy("b").collect()  # a row a block
    meet = [(x.b, y.b) for k, x in enumerate(size) for y in size[k:] if (x.o or y.o) and 11 * x.low <= 17 * y.high and 11 * y.low <= 17 * x.high]
    if not meet:
        return rows.sparkSession.createDataFrame([], "a long, b long")
    sides = [(x, g, 0) for g, (x, _) in enumerate(meet)] + [(y, g, 1) for g, (x, y) in enumerate(meet) if x != y]
    both = rows.join(rows.sparkSession.createDataFrame(sides, "b int, g int, side int"), "b").select("g", "side", "i", "n", "a", "o")
    return both.repartition(min(3 * len(meet), 2000), "g").groupBy("g").applyInArrow(_meet, "a long, b long")


def _meet(table: pa.Table) -> pa.Table:
    def side(k: int) -> Side | None:
        t = table.filter(pc.equal(table["side"], k))
        return Side(t["i"].to_numpy(), t["n"].to_pylist(), t["a"].to_pylist(), t["o"].to_numpy()) if len(t) else None

    found = list(Blocks(side(0), side(1), LEAST, NAME_LEAST, indel, partial_ratio))
    a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def completeness() -> Column:
    """Points for what a record has, 0 to 95."""
    filled = lambda c: F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False)).cast("int")
    number = lambda c: F.trim(F.col(c).cast("string")).try_cast("double")
    core = sum((10 * filled(c) for c in ("business_name", "category", "address", "phone_raw", "google_maps_url")), F.lit(0))
    there = F.coalesce((number("lat") != 0) & (number("lon") != 0), F.lit(False)).cast("int")
    return (core + 15 * filled("website_raw") + 10 * F.coalesce(number("rating") > 0, F.lit(False)).cast("int") + 10 * F.coalesce(F.floor(number("reviews_count")) > 0, F.lit(False)).cast("int") + 10 * there).cast("int")


def merit() -> Column:
    """How good a record is as the one to keep: completeness, website, valid phone, reviews, rating."""
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return completeness() + 20 * yes(F.col("website_normalized") != "") + 15 * yes(F.col("phone_valid")) + F.least(F.coalesce(F.col("reviews_count_normalized"), F.lit(0)) / 10.0, F.lit(50.0)) + 10 * yes(F.col("rating_normalized") >= 4)


def groups(df: DataFrame, id: str = "source_row_id", fuzzy: bool = True, block: Column | None = None) -> DataFrame:
    """(id, component) of every row: its group is named by its smallest id; a row linked to none is its own."""
    exact = cut(key_edges(df, id))
    linked = exact.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    edges = exact.union(fuzzy_edges(df, linked, id, block)) if fuzzy else exact
    found = components(edges)
    return df.select(F.col(id).cast("long").alias("id")).join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))


def deduplicate(df: DataFrame, id: str = "source_row_id", fuzzy: bool = True, block: Column | None = None) -> DataFrame:
    """The best record of each group, in any order (sort by id where the order matters), with duplicate_group_id (1, 2, ... by the groups' smallest ids; null for
    rows without duplicates) and duplicate_count. The best is chosen by aggregation, so that no group is sorted or gathered."""
    member = df.withColumn("_m", merit()).join(groups(df, id, fuzzy, block).withColumnRenamed("id", id), id)
    best = cut(member.groupBy("component").agg(F.min_by(F.col(id), F.struct((-F.col("_m")).alias("m"), F.col(id))).alias(id), F.count("*").cast("int").alias("duplicate_count")))
    several = best.where("duplicate_count > 1").select("component")
    number = several.join(_ranked(several, "component"), "component")
    best = best.join(number, "component", "left").drop("component")
    return df.drop("duplicate_group_id", "duplicate_count").join(best, id)


def _ranked(df: DataFrame, c: str, name: str = "duplicate_group_id") -> DataFrame:
    """Each value of a unique column with its rank from 1, by range partitions: counts per partition give the offsets."""
    parts = cut(df.select(c).repartitionByRange(c).withColumn("_p", F.spark_partition_id()))
    before = parts.groupBy("_p").count().withColumn("_b", F.coalesce(F.sum("count").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("count")  # one row per partition
    return parts.withColumn("_r", F.row_number().over(W.partitionBy("_p").orderBy(c))).join(F.broadcast(before), "_p").select(c, (F.col("_b") + F.col("_r")).cast("int").alias(name))


def skipped(df: DataFrame) -> DataFrame:
    """df as it is when duplicates are not looked for."""
    return df.withColumns({"duplicate_group_id": F.lit(None).cast("int"), "duplicate_count": F.lit(1)})
