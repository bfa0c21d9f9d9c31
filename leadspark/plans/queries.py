"""The engine's operators as queries over the tables of a folder: each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import cache, clean, dedupe, enrich, pages, people, size, verify
from ..operators.jsonld import jsonld
from ..sources import csv as source
from ..sources import sinks
from ..vocab import INGREDIENTS
from . import report

#: The time that expiries are compared with, and the year of ages: fixed, so that results can be reproduced.
NOW, YEAR = "2025-08-01 00:00:00", 2025

#: cleaned_enriched as raw exports would have it: text that expresses what the table has as numbers. Valid in Spark and DuckDB.
LEAD_SRC = (
    "source_row_id", "source_file", "city", "business_name", "category", "address", "phone_raw", "website_normalized AS website_raw", "email_raw", "'https://maps.example/?cid=' || CAST(source_row_id AS STRING) AS google_maps_url",
    "CAST(rating_normalized AS STRING) || ' of 5 stars' AS rating", "'(' || CAST(reviews_count_normalized AS STRING) || ')' AS reviews_count", "CAST(lat AS STRING) AS lat", "CAST(lon AS STRING) AS lon",
)


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _leads(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "cleaned_enriched")


def _src(spark: SparkSession, sf: str) -> DataFrame:
    return _leads(spark, sf).selectExpr(*LEAD_SRC)


def _now() -> Column:
    return F.lit(NOW).cast("timestamp")


def _cache(spark: SparkSession, sf: str) -> DataFrame:
    return cache.of_table(_t(spark, sf, "enrichment_cache"))


def _usable(d: DataFrame, shared: DataFrame) -> DataFrame:
    """Leads with what links them: phones that are numbers, domains that are host names and not shared."""
    phone = F.when(F.col("phone_e164").rlike(r"^\+[0-9]{11,15}$") & ~F.col("phone_e164").rlike("(0{8}|1{8}|9{8})"), F.col("phone_e164"))
    d = d.join(shared.select(F.col("domain").alias("_shared")).distinct(), F.col("website_domain") == F.col("_shared"), "left")
    domain = F.when(F.col("website_domain").contains(".") & F.col("_shared").isNull(), F.col("website_domain"))
    return d.withColumns({"phone_e164": phone, "website_domain": domain}).drop("_shared")


# --- scan, projection, union


def scan_union_canonical(spark, sf):
    """Two sources with headers of their own, in one schema."""
    orgs = _t(spark, sf, "provider_orgs").select(F.col("org_name").alias("Company_Name"), F.col("org_phone").alias("Telephone"), F.col("org_website").alias("URL"), F.col("org_address").alias("Full_Address"), F.col("industry").alias("Sector"))
    leads = _leads(spark, sf).select("business_name", "category", "address", "phone_raw", "website_normalized", "email_raw", "city").withColumnRenamed("website_normalized", "site")
    pick = lambda d, name: d.select(*[(F.col(source.map_columns(d.columns)[c]) if c in source.map_columns(d.columns) else F.lit(None).cast("string")).alias(c) for c in ("business_name", "category", "address", "phone_raw", "website_raw", "email_raw", "city")], F.lit(name).alias("source_file"))
    return source.merge([pick(orgs, "orgs"), pick(leads, "leads")])


def clean_leads(spark, sf):
    """The whole cleaning projection."""
    d = clean.clean(_src(spark, sf))
    return d.select("source_row_id", "business_name", "canonical_category", "phone_e164", "phone_country", "phone_valid", "website_normalized", "website_domain", "rating_normalized", "reviews_count_normalized", "address_street", "address_postcode", "address_city_component", "address_country")


def clean_text_collapse(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", X.clean_text("text").alias("text"))


def rating_reviews(spark, sf):
    return _src(spark, sf).select("source_row_id", X.rating("rating").alias("rating"), X.reviews_count("reviews_count").alias("reviews"), X.safe_int("rating").alias("whole"))


def category_classes(spark, sf):
    return _leads(spark, sf).select("source_row_id", X.category_class("category").alias("class"))


def category_filter(spark, sf):
    d = _leads(spark, sf).select("source_row_id", "category", X.category_class("category").alias("canonical_category"))
    return clean.filter_categories(d, "bakery, tea,, beauty").select("source_row_id")


def city_country(spark, sf):
    cities = {"roslenfeld": "DE", "qualauonne": "FR", "pelranwald": "IT", "ostsketal": "ES", "nörhumales": "PT", "lunlenveen": "NL", "griskeau": "PL"}
    return _leads(spark, sf).select("source_row_id", X.country_of_city("city", cities).alias("country"))


def name_suffix(spark, sf):
    return _leads(spark, sf).select("source_row_id", X.strip_suffix(X.clean_text("business_name")).alias("name"), X.match_key("business_name").alias("match_key"))


def address_components(spark, sf):
    return _leads(spark, sf).select("source_row_id", X.address_parts("address").alias("p")).select("source_row_id", "p.*")


def phone_numbers(spark, sf):
    return _leads(spark, sf).select("source_row_id", X.parse_phone("phone_raw", "phone_country").alias("p")).select("source_row_id", "p.*")


def urls_normalized(spark, sf):
    u = X.normalize_url("org_website")
    return _t(spark, sf, "provider_orgs").where("org_website is not null").select("org_id", u.alias("url"), X.domain_of(u).alias("domain"), X.denylisted("org_website").alias("denied"))


def person_names(spark, sf):
    n = X.person_name("decision_maker_name")
    return _leads(spark, sf).select("source_row_id", n.alias("name"), X.split_name(n)["first"].alias("first"), X.split_name(n)["last"].alias("last"), X.is_person(n).alias("is_person"))


def mail_functions(spark, sf):
    return _leads(spark, sf).where("email_raw is not null").select("source_row_id", X.valid_email("email_raw").alias("valid"), X.valid_email_strict("email_raw").alias("strict"), X.mail_domain("email_raw").alias("domain"), X.generic_mailbox("email_raw").alias("generic"), F.array_join(X.email_pattern(F.array(F.lower(F.trim("email_raw")))), ",").alias("pattern"))


def likely_mails(spark, sf):
    return _leads(spark, sf).where("website_domain is not null").select("source_row_id", F.array_join(X.likely_emails("website_domain", "business_name"), " ").alias("mails"))


def mails_in_texts(spark, sf):
    text = F.concat_ws(" ", "text", F.concat(F.lit("write to Sales@"), "website_domain"), F.lit("or no-reply@x.example"))
    return _t(spark, sf, "documents").select("doc_id", F.array_join(X.emails_in(text, ("domain.com",)), " ").alias("mails"))


# --- resolution


def dedupe_exact(spark, sf):
    """The groups by equal phone or domain."""
    d = _usable(_leads(spark, sf), _t(spark, sf, "shared_domains")).select("source_row_id", "phone_e164", "website_domain", "business_name", "address")
    return dedupe.groups(d, fuzzy=False).select(F.col("id").alias("source_row_id"), "component")


def _collapsible(spark, sf):
    d = _usable(_leads(spark, sf), _t(spark, sf, "shared_domains"))
    raw = _src(spark, sf).select("source_row_id", "google_maps_url", "website_raw", "rating", "reviews_count")
    return d.drop("duplicate_group_id", "duplicate_count").join(raw.select("source_row_id", "google_maps_url", "website_raw"), "source_row_id").withColumns({"rating": F.col("rating_normalized"), "reviews_count": F.col("reviews_count_normalized")})


def dedupe_collapse(spark, sf):
    """One best record per group by equal phone or domain."""
    return dedupe.deduplicate(_collapsible(spark, sf), fuzzy=False).select("source_row_id", "duplicate_group_id", "duplicate_count")


def dedupe_whole(spark, sf):
    """One best record per group by equal phone or domain, or alike names and addresses."""
    return dedupe.deduplicate(_collapsible(spark, sf), fuzzy=True).select("source_row_id", "duplicate_group_id", "duplicate_count")


def dedupe_fuzzy(spark, sf):
    """The pairs of alike names and addresses of a row that no key links and any later row, wherever they are."""
    d = _usable(_leads(spark, sf), _t(spark, sf, "shared_domains")).select("source_row_id", "phone_e164", "website_domain", "business_name", "address")
    exact = dedupe.key_edges(d)
    return dedupe.fuzzy_edges(d, exact.select(F.explode(F.array("a", "b")).alias("id")).distinct())


def completeness_scores(spark, sf):
    return _src(spark, sf).select("source_row_id", dedupe.completeness().alias("points"))


# --- cache


def cache_latest(spark, sf):
    return cache.latest(_cache(spark, sf)).select("key", "status", "created_at")


def cache_keys(spark, sf):
    return _cache(spark, sf).select("key", cache.key("domain", "provider").alias("made"))


def cache_lookup(spark, sf):
    d = _leads(spark, sf).select("source_row_id", "website_domain")
    return cache.lookup(d, _cache(spark, sf), "provider_a", _now(), 3650).select("source_row_id", "cached_status")


def cache_skip(spark, sf):
    return cache.not_cached(_leads(spark, sf).select("source_row_id", "website_domain"), _cache(spark, sf), "provider_a", _now(), 3650).select("source_row_id")


def cache_upsert(spark, sf):
    old = _cache(spark, sf)
    new = cache.entries(old.where("status = 'failed'").select("domain", "provider", F.lit("success").alias("status"), F.lit("{}").alias("result"), F.lit(None).cast("string").alias("error_reason")).distinct(), _now())
    return cache.upsert(old, new).select("key", "status", "expires_at")


def cache_stats(spark, sf):
    return cache.stats(_cache(spark, sf), _now())


def cache_cleanup(spark, sf):
    return cache.without_failed(cache.without_expired(_cache(spark, sf), _now())).select("key", "status", "created_at")


def cache_failures(spark, sf):
    return cache.failed(_cache(spark, sf), _now()).select("domain", "provider")


# --- verification


def verify_mails(spark, sf):
    return verify.verify(_leads(spark, sf).select("source_row_id", "email_raw"), _t(spark, sf, "mx_lookup"), None, "email_raw").select("source_row_id", "verification_status", "verification_confidence")


def verify_counts(spark, sf):
    return verify.status_counts(verify_mails(spark, sf))


def mail_hosts(spark, sf):
    return _t(spark, sf, "mx_lookup").select("domain", F.array_join(verify.by_preference(F.col("hosts")), ",").alias("hosts"))


def mail_preference(spark, sf):
    """Hosts written with preferences, which the table has not: the order of trial."""
    d = spark.sql("SELECT * FROM VALUES ('a', array('20 b.x', '5 a.x', 'c.x')), ('b', array('c.x', '10 d.x')), ('c', array()) AS t(domain, hosts)")
    return d.select("domain", F.array_join(verify.by_preference(F.col("hosts")), ",").alias("hosts"))


def verify_mailboxes(spark, sf):
    """Replies of mailboxes: every mail of the leads whose domain has two hosts or more is answered by them, the less preferred first by name."""
    mx = _t(spark, sf, "mx_lookup")
    mx = mx.withColumn("hosts", F.transform("hosts", lambda h, i: F.concat((F.size("hosts") - i).cast("string"), F.lit(" "), h)))
    leads = _leads(spark, sf).select("source_row_id", "email_raw")
    asked = leads.select(F.lower(F.trim("email_raw")).alias("email")).distinct().join(mx.select(F.lower("domain").alias("d"), F.posexplode(F.transform("hosts", lambda h: F.regexp_replace(h, r"^\d+ ", ""))).alias("i", "host")), F.substring_index("email", "@", -1) == F.col("d"))
    n = F.length("email") + F.col("i")
    probes = asked.select("email", "host", F.element_at(F.array(*map(F.lit, (250, 550, 0, 451, 250))), (n % 5 + 1).cast("int")).alias("code"), (n % 10 == 0).alias("catch_all"))
    return verify.verify(leads, mx, probes, "email_raw").select("source_row_id", "smtp_status", "verification_status", "verification_confidence")


# --- pages


def _pages(spark, sf) -> DataFrame:
    html = F.concat(F.lit('<html lang="'), F.coalesce("lang", F.lit("")), F.lit('"><head><title>'), F.coalesce("website_domain", F.lit("?")), F.lit(" &amp; more | Home</title></head><body>"), F.col("text"), F.lit('<a href="https://www.linkedin.com/company/x">l</a></body></html>'))
    return _t(spark, sf, "documents").select("doc_id", "source", F.col("website_domain").alias("domain"), html.alias("html"))


def page_language(spark, sf):
    return _pages(spark, sf).select("doc_id", pages.language("html").alias("language"))


def page_title(spark, sf):
    return _pages(spark, sf).select("doc_id", pages.title("html").alias("title"), pages.social_links("html")["linkedin"].alias("linkedin"))


def page_age(spark, sf):
    return _pages(spark, sf).select("doc_id", pages.business_age("html", YEAR).alias("age"))


def page_staff(spark, sf):
    return _pages(spark, sf).select("doc_id", pages.staff_tier("html").alias("staff"))


def page_legal(spark, sf):
    return _pages(spark, sf).where("source = 'legal_page'").select("doc_id", people.legal_notice("html").alias("n")).select("doc_id", "n.*")


def page_jsonld(spark, sf):
    return _pages(spark, sf).select("doc_id", jsonld("html").alias("j")).select("doc_id", "j.business_name", "j.address", "j.phone")


def page_people(spark, sf):
    return _pages(spark, sf).select("doc_id", F.explode(people.people(pages.page_text("html"))).alias("p")).select("doc_id", "p.*")


def site_crawl(spark, sf):
    d = _pages(spark, sf).where("domain is not null").select("domain", F.concat(F.lit("https://"), "domain").alias("url"), "html")
    c = pages.crawl(d.select("domain"), d)
    return c.select("domain", "company_name", "linkedin_url", "emails_found", "success")


# --- enrichment


def keyword_signals(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.array_join(F.slice(X.contains_any("text", INGREDIENTS), 1, 5), ",").alias("signals"))


def size_estimates(spark, sf):
    d = enrich.sized(_leads(spark, sf).withColumn("canonical_category", X.category_class("category")))
    return d.select("source_row_id", "company_size_bucket", "company_size_confidence", "company_size_source", "company_size_evidence")


def employee_counts(spark, sf):
    n = size.parse_employees("estimated_employees")
    return _leads(spark, sf).select("source_row_id", n.alias("n"), size.bucket(n).alias("bucket"))


def slim_export(spark, sf):
    return sinks.slim(_leads(spark, sf))


def search_queries(spark, sf):
    return sinks.searches(_leads(spark, sf))


# --- report


def report_totals(spark, sf):
    return report.totals(_leads(spark, sf))


def report_histogram(spark, sf):
    return report.histogram(_leads(spark, sf), "lead_quality_score")


def report_shares(spark, sf):
    return report.share_of(_leads(spark, sf), "enrichment_status")


def report_fill(spark, sf):
    return report.fill_rates(_leads(spark, sf), ["business_name", "category", "address", "phone_e164", "website_domain", "email_raw", "rating_normalized", "reviews_count_normalized", "decision_maker_name", "website_language"])


def report_top_cities(spark, sf):
    return report.top_values(_leads(spark, sf), "city")


def report_top_rows(spark, sf):
    return report.top_rows(_leads(spark, sf), "lead_quality_score", 20, 70).select("source_row_id", "lead_quality_score")


def report_decision_makers(spark, sf):
    return report.decision_makers(_leads(spark, sf))


def report_sizes(spark, sf):
    return report.sizes(_leads(spark, sf).withColumn("company_size_bucket", size.bucket(size.parse_employees("estimated_employees"))))


QUERIES = {k: v for k, v in globals().items() if callable(v) and getattr(v, "__module__", "") == __name__ and not k.startswith("_")}
