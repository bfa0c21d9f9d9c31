"""The size of a firm estimated from signals of different weight, all in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col
from ..vocab import CAREERS, CATEGORY_PRIORS, HEADCOUNT, REVIEW_TIERS, SIGNAL_WEIGHTS, SIZES

_MID = {b: m for b, m, _ in SIZES}


def parse_employees(c: Column | str) -> Column:
    """A typed number of employees: the middle of a range, 1.5 times of 'n+', a plain number; words such as 'approx.' do not matter."""
    t = F.trim(F.regexp_replace(F.lower(F.trim(col(c).cast("string"))), r"^(?:~|≈|ca\.?|circa|approx\.?|approximately|about|around|etwa|rund|environ)\s*", ""))
    low, high = F.regexp_extract(t, r"^(\d+)\s*(?:-|–|—|to|bis)\s*(\d+)", 1), F.regexp_extract(t, r"^(\d+)\s*(?:-|–|—|to|bis)\s*(\d+)", 2)
    more, one = F.regexp_extract(t, r"^(\d+)\s*\+", 1), F.regexp_extract(t, r"^(\d+(?:\.\d+)?)", 1)
    return F.when(low != "", (low.try_cast("double") + high.try_cast("double")) / 2).when(more != "", more.try_cast("double") * 1.5).otherwise(F.nullif(one, F.lit("")).try_cast("double"))


def bucket(n: Column) -> Column:
    out = F
    for name, _, below in SIZES[:-1]:
        out = out.when(n < below, F.lit(name))
    return F.when(n.isNotNull(), out.otherwise(F.lit(SIZES[-1][0])))


def _signal(source: str, mid: Column, evidence: Column, name: Column | None = None) -> Column:
    return F.when(mid.isNotNull(), F.struct(F.lit(source).alias("source"), F.lit(SIGNAL_WEIGHTS[source]).alias("weight"), mid.cast("double").alias("midpoint"), (name if name is not None else bucket(mid)).alias("bucket"), evidence.alias("evidence")))


def _middle(b: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in _MID.items() for x in kv]), b)


def review_signal(reviews: Column | str) -> Column:
    n, out = col(reviews), F
    for least, b in REVIEW_TIERS:
        out = out.when(n >= least, F.lit(b))
    b = F.when(n > 0, out.otherwise(F.lit(None).cast("string")))
    return _signal("review_count", _middle(b), F.concat(F.lit("review_count:"), n.cast("string"), F.lit("_reviews")), b)


def category_signal(canonical: Column | str, category: Column | str, raw_first: bool = False) -> Column:
    """By the first key in the class, else in the typed category (the other way round with raw_first)."""
    def prior(c: Column) -> Column:
        t, out = F.lower(F.coalesce(c, F.lit(""))), F
        for k, b in CATEGORY_PRIORS.items():
            out = out.when(t.contains(k), F.struct(F.lit(k).alias("k"), F.lit(b).alias("b")))
        return out.otherwise(F.lit(None))

    a, b = prior(col(canonical)), prior(col(category))
    p = F.coalesce(b, a) if raw_first else F.coalesce(a, b)
    return _signal("category_prior", _middle(p["b"]), F.concat(F.lit("category_prior:"), p["k"], F.lit("→"), p["b"]), p["b"])


def headcount_signal(text: Column | str) -> Column:
    """The upper median of the head-counts that a text states, from 1 to 100,000."""
    found = F.transform(F.flatten(F.array(*[F.regexp_extract_all(F.coalesce(col(text), F.lit("")), F.lit(f"(?iu){p}"), F.lit(1)) for p in HEADCOUNT])), lambda x: x.try_cast("int"))
    n = F.sort_array(F.filter(found, lambda x: x.between(1, 100_000)))
    mid = F.get(n, F.floor(F.size(n) / 2).cast("int")).cast("double")
    return _signal("explicit_text", mid, F.concat(F.lit("explicit_text:"), F.left(F.get(F.filter(F.array(*[F.regexp_extract(col(text), f"(?iu)({p.replace('(', '(?:', 1)})", 1) for p in HEADCOUNT]), lambda x: x != ""), F.lit(0)), F.lit(60))))


def team_signal(text: Column | str) -> Column:
    """1.3 times the distinct names that stand before a dash and a title; two at least."""
    part = r"[A-ZÀ-ÖØ-ÞĀ-ž][a-zà-öø-ÿā-ſ]+"
    n = F.size(F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(col(text), F.lit("")), F.lit(rf"({part}\s+{part})\s*[-–—]\s*[A-Za-zÀ-ÿ]"), F.lit(1)), lambda x: F.lower(F.trim(x)))))
    return _signal("team_page", F.when(n >= 2, n * 1.3), F.concat(F.lit("team_page:"), n.cast("string"), F.lit("_names")))


def careers_signal(html: Column | str) -> Column:
    yes = F.lower(F.coalesce(col(html), F.lit(""))).rlike("href=[\"'](?:" + "|".join(CAREERS) + ")")
    return _signal("careers_page", F.when(yes, F.lit(_MID["6-20"])), F.lit("careers_page:link"), F.lit("6-20"))


def count_signal(source: str, raw: Column | str) -> Column:
    n = parse_employees(raw)
    return _signal(source, F.when(n > 0, n), F.concat(F.lit(f"{source}:"), col(raw).cast("string")))


def with_estimate(df: DataFrame, signals: list[Column], prefix: str = "company_size") -> DataFrame:
    """df with prefix_bucket, _midpoint, _confidence, _source and _evidence by the signals that are not null: the given count if there is
    one, else the weighted mean; all null without a signal. Every step is a column of its own, so that none is worked out twice."""
    d = df.withColumn("_signals", F.array(*signals)).withColumn("_have", F.filter("_signals", lambda s: s.isNotNull()))
    ordered = F.transform(F.array_sort(F.transform("_have", lambda s, i: F.struct((-s["weight"]).alias("w"), i.alias("i"), s.alias("s")))), lambda x: x["s"])
    d = d.withColumns({"_ranked": ordered, "_weight": F.aggregate("_have", F.lit(0.0), lambda a, s: a + s["weight"]), "_sum": F.aggregate("_have", F.lit(0.0), lambda a, s: a + s["weight"] * s["midpoint"])})
    d = d.withColumns({"_top": F.get("_ranked", F.lit(0)), "_mean": F.when(F.col("_weight") > 0, F.col("_sum") / F.col("_weight"))})
    given, some = F.col("_top.source").isin("api", "jsonld"), F.size("_have") > 0
    d = d.withColumns({
        f"{prefix}_bucket": F.when(given, F.col("_top.bucket")).otherwise(bucket(F.col("_mean"))), f"{prefix}_midpoint": F.when(given, F.col("_top.midpoint")).otherwise(F.col("_mean")),
        f"{prefix}_confidence": F.when(some, F.when(F.col("_weight") >= 7, "high").when(F.col("_weight") >= 3, "medium").otherwise("low")), f"{prefix}_source": F.col("_top.source"),
        f"{prefix}_evidence": F.when(some, F.array_join(F.transform(F.slice("_ranked", 1, 3), lambda s: s["evidence"]), "; ")),
    })
    return d.drop("_signals", "_have", "_ranked", "_weight", "_sum", "_top", "_mean")
