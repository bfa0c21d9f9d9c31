"""Aggregates of a run, each a DataFrame, and the report that puts them into words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

LEAD_BINS = ((0, 40), (40, 60), (60, 80), (80, 100))
TARGET_BINS = ((0, 20), (20, 40), (40, 60), (60, 80), (80, 100))
SIZE_ORDER = ("1", "2-5", "6-20", "21-50", "51-200", "200+")


def totals(df: DataFrame) -> DataFrame:
    """One row: rows, the records that they stand for, and how many were collapsed."""
    return df.agg(F.count("*").alias("total"), F.coalesce(F.sum("duplicate_count"), F.lit(0)).alias("records")).withColumn("collapsed", F.col("records") - F.col("total"))


def share_of(df: DataFrame, column: str) -> DataFrame:
    """(value, n, percent) of each value of a column; null is one of them."""
    n = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return n.withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy()), 1))  # one row per value


def histogram(df: DataFrame, column: str, bins: tuple[tuple[int, int], ...] = LEAD_BINS) -> DataFrame:
    """(bin, low, high, n) with intervals open below and closed above, empty ones too; what is in none (such as the least value itself) is
    not counted."""
    c, out = F.col(column), F
    for k, (low, high) in enumerate(bins):
        out = out.when((c > low) & (c <= high), F.lit(k))
    counted = df.select(out.otherwise(F.lit(None).cast("int")).alias("bin")).where("bin is not null").groupBy("bin").agg(F.count("*").alias("n"))
    all_ = df.sparkSession.createDataFrame([(k, low, high) for k, (low, high) in enumerate(bins)], "bin int, low int, high int")
    return all_.join(counted, "bin", "left").fillna(0, ["n"])


def fill_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, percent): how many values each column has, in one pass; texts that are blank do not count."""
    have = [c for c in columns if c in df.columns]
    kinds = dict(df.dtypes)
    given = lambda c: F.count_if(F.trim(F.col(c)) != "") if kinds[c] == "string" else F.count(c)
    one = df.agg(F.count("*").alias("_all"), *[given(c).alias(c) for c in have])
    if not have:
        return df.sparkSession.createDataFrame([], "column string, n long, percent double")
    return one.unpivot("_all", have, "column", "n").select("column", "n", F.round(100.0 * F.col("n") / F.greatest(F.col("_all"), F.lit(1)), 1).alias("percent"))


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values; ties by value. Null and blank ones do not count."""
    return df.where(F.trim(F.col(column)) != "").groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)


def top_rows(df: DataFrame, by: str, k: int = 20, least: float | None = None, id: str = "source_row_id") -> DataFrame:
    """The k rows with the most of a column, from a least value if one is given; ties by id."""
    d = df if least is None else df.where(F.col(by) >= least)
    return d.where(F.col(by).isNotNull()).orderBy(F.desc(by), F.col(id)).limit(k)


def decision_makers(df: DataFrame) -> DataFrame:
    """One row: how many rows name a decision maker, and with which confidence."""
    named = F.trim(F.col("decision_maker_name")) != ""
    return df.agg(F.count_if(named).alias("found"), *[F.count_if(named & (F.col("decision_maker_confidence") == c)).alias(c) for c in ("high", "medium", "low")])


def sizes(df: DataFrame) -> DataFrame:
    """(bucket, n) in the order of sizes, empty ones too."""
    n = df.groupBy(F.col("company_size_bucket").alias("bucket")).agg(F.count("*").alias("n"))
    order = df.sparkSession.createDataFrame(list(enumerate(SIZE_ORDER)), "ord int, bucket string")
    return order.join(n, "bucket", "left").fillna(0, ["n"]).select("ord", "bucket", "n")


def errors(df: DataFrame, k: int = 10, id: str = "source_row_id") -> DataFrame:
    """The last k errors."""
    return df.where(F.trim(F.col("enrichment_error")) != "").orderBy(F.desc(id)).select(id, "enrichment_error").limit(k)


def points(rules: list[tuple[str, Column, float]], most: float | None = None) -> Column:
    """A score of rules (name, condition or number, points): conditions give their points, numbers are multiplied by them; nulls give
    nothing; held to `most`. Which rules a business scores by is its own affair, and none are built in."""
    total = F.lit(0.0)
    for _, what, n in rules:
        total = total + F.coalesce(what.cast("double") * n, F.lit(0.0))
    return total if most is None else F.least(total, F.lit(float(most)))


def breakdown(rules: list[tuple[str, Column, float]]) -> Column:
    """struct of what each rule of points() gives."""
    return F.struct(*[F.coalesce(what.cast("double") * n, F.lit(0.0)).alias(name) for name, what, n in rules])


def class_of(score: Column, cuts: list[tuple[float, str]], otherwise: str) -> Column:
    """The first class whose cut the score reaches."""
    out = F
    for least, name in cuts:
        out = out.when(score >= least, F.lit(name))
    return F.when(score.isNotNull(), out.otherwise(F.lit(otherwise)))


def _table(title: str, rows: list, heads: list[str]) -> list[str]:
    return [f"## {title}", "", "| " + " | ".join(heads) + " |", "|" + " --- |" * len(heads), *["| " + " | ".join("" if v is None else f"{v:.1f}" if isinstance(v, float) else str(v).replace("|", "/") for v in r) + " |" for r in rows], ""]


SOURCE_FIELDS = ["business_name", "category", "address", "phone_e164", "website_domain", "email_raw", "rating_normalized", "reviews_count_normalized"]
ENRICHED_FIELDS = ["enriched_company_name", "enriched_description", "enriched_linkedin_url", "enriched_facebook_url", "enriched_instagram_url", "enriched_contact_email", "enriched_emails", "decision_maker_name", "decision_maker_title", "legal_owner_name", "legal_vat_id", "website_language", "business_age_years", "estimated_employees", "company_size_bucket", "ingredient_signals"]


def markdown(df: DataFrame, stats: dict | None = None, score: str | None = None) -> str:
    """The report. Only aggregates and top lists come to the driver."""
    t = totals(df).first()
    out = ["# Summary", "", f"Records: {t.total}; before duplicates were collapsed: {t.records} ({t.collapsed} collapsed).", ""]
    if stats:
        out += _table("Run", sorted(stats.items()), ["figure", "value"])
    has = set(df.columns)
    if score and score in has:
        out += _table(f"Histogram of {score}", [(f"({r.low}, {r.high}]", r.n) for r in histogram(df, score).orderBy("bin").collect()], ["range", "n"])
        out += _table(f"Highest {score}", [(r.business_name, r[score]) for r in top_rows(df, score).collect()], ["name", score])
    out += _table("Filled fields", [tuple(r) for r in fill_rates(df, SOURCE_FIELDS + ENRICHED_FIELDS).collect()], ["field", "n", "%"])
    for c, title in (("city", "Towns"), ("category", "Categories")):
        if c in has:
            out += _table(title, [tuple(r) for r in top_values(df, c).collect()], ["value", "n"])
    if "canonical_category" in has:
        out += _table("Classes", [tuple(r) for r in share_of(df, "canonical_category").orderBy(F.desc("n"), "value").collect()], ["class", "n", "%"])
    if "decision_maker_confidence" in has:
        out += _table("Decision makers", [tuple(decision_makers(df).first())], ["found", "high", "medium", "low"])
    if "company_size_bucket" in has:
        out += _table("Sizes", [(r.bucket, r.n) for r in sizes(df).orderBy("ord").collect()], ["employees", "n"])
        out += _table("Sources of sizes", [tuple(r) for r in top_values(df, "company_size_source", 5).collect()], ["source", "n"])
    if "enrichment_error" in has:
        out += _table("Last errors", [tuple(r) for r in errors(df).collect()], ["row", "error"])
    return "\n".join(out)
