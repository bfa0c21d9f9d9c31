"""Enrichment as joins: cached, provided and crawled facts side by side, each column from the first that has it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import contains_any, valid_email
from ..vocab import CERTIFICATES, INGREDIENTS
from . import pages as P
from . import people, size
from .jsonld import jsonld

_CONTACT = "array<struct<name:string,title:string,email:string,linkedin:string>>"
# The three forms of answers: which path holds what.
FORMS = {
    "a": {"name": "name", "description": "description", "industry": "category.industry", "employees": "metrics.employees", "linkedin": "linkedin.handle", "facebook": "facebook.handle", "people": "people"},
    "b": {"name": "organization.name", "description": "organization.description", "industry": "organization.industry", "employees": "organization.estimated_num_employees", "linkedin": "organization.linkedin_url", "facebook": "organization.facebook_url", "people": "people"},
    "c": {"name": "data.organization", "pattern": "data.pattern", "people": "data.emails"},
}


def response(body: Column | str, form: str) -> Column:
    """A provider's JSON answer as struct(company_name, description, industry, employee_count, linkedin_url, facebook_url, email_patterns,
    contacts); contacts are the named or reachable ones of the first three. Nulls for what is missing or no JSON."""
    v = F.try_parse_json(F.col(body) if isinstance(body, str) else body)
    get = lambda k: F.try_variant_get(v, f"$.{FORMS[form][k]}", "string") if k in FORMS[form] else F.lit(None).cast("string")
    raw = F.try_variant_get(v, f"$.{FORMS[form]['people']}", "array<struct<name:string,first_name:string,last_name:string,title:string,position:string,email:string,value:string,linkedin_url:string,linkedin:string>>")
    one = lambda p: F.struct(F.nullif(F.coalesce(p["name"], F.concat_ws(" ", p["first_name"], p["last_name"])), F.lit("")).alias("name"), F.coalesce(p["title"], p["position"]).alias("title"), F.coalesce(p["email"], p["value"]).alias("email"), F.coalesce(p["linkedin_url"], p["linkedin"]).alias("linkedin"))
    contacts = F.filter(F.transform(F.slice(raw, 1, 3), one), lambda p: p["name"].isNotNull() | p["email"].isNotNull())
    pattern = get("pattern")
    return F.struct(
        get("name").alias("company_name"), get("description").alias("description"), get("industry").alias("industry"), get("employees").alias("employee_count"), get("linkedin").alias("linkedin_url"), get("facebook").alias("facebook_url"),
        F.when(pattern.isNotNull(), F.array(pattern)).alias("email_patterns"), F.coalesce(contacts, F.array().cast(_CONTACT)).alias("contacts"),
    )


def free_provider(domain: Column | str) -> Column:
    """A firm's name from the first label of its domain: capitals at words, blanks for hyphens."""
    d = F.col(domain) if isinstance(domain, str) else domain
    return F.initcap(F.replace(F.split_part(d, F.lit("."), F.lit(1)), F.lit("-"), F.lit(" ")))


def supplement(first: DataFrame, *others: DataFrame, by: str = "domain") -> DataFrame:
    """One row per domain of any of the tables; each column from the first table in which it is not null."""
    out = first
    for k, o in enumerate(others):
        same = [c for c in o.columns if c in out.columns and c != by]
        renamed = o.select(by, *[F.col(c).alias(f"_{k}_{c}") if c in same else F.col(c) for c in o.columns if c != by])
        out = out.join(renamed, by, "full").withColumns({c: F.coalesce(c, f"_{k}_{c}") for c in same}).drop(*[f"_{k}_{c}" for c in same])
    return out


def site_facts(visited: DataFrame, year: int) -> DataFrame:
    """(domain, website_language, business_age_years, estimated_employees, jsonld) of each domain's first page."""
    first = visited.groupBy("domain").agg(F.min_by("html", "ordinal").alias("html"))
    return first.select("domain", P.language("html").alias("website_language"), P.business_age("html", year).alias("business_age_years"), P.staff_tier("html").alias("estimated_employees"), jsonld("html").alias("jsonld"), P.page_text("html", False).alias("page_text"), "html")


def sized(df: DataFrame) -> DataFrame:
    """df with its firm's size from what it has: employee_count, jsonld, page_text, html, reviews and categories."""
    has = set(df.columns)
    signals = [size.review_signal("reviews_count_normalized"), size.category_signal("canonical_category", "category")]
    if "employee_count" in has:
        signals.insert(0, size.count_signal("api", "employee_count"))
    if "jsonld" in has:
        signals.append(size.count_signal("jsonld", F.col("jsonld.employee_count")))
    if "page_text" in has:
        signals += [size.headcount_signal("page_text"), size.team_signal("page_text")]
    if "html" in has:
        signals.append(size.careers_signal("html"))
    return size.with_estimate(df, signals)


def apply_legal(df: DataFrame) -> DataFrame:
    """A legal notice overrides the decision maker where it is of high confidence or there was none, and gives its mail where the contact
    had none; tax number, phone and register entry come with an owner."""
    owner = F.col("notice.owner_name").isNotNull()
    over = owner & ((F.col("notice.confidence") == "high") | F.col("decision_maker_name").isNull())
    return df.withColumns({
        "decision_maker_name": F.when(over, F.col("notice.owner_name")).otherwise(F.col("decision_maker_name")),
        "decision_maker_title": F.when(over, F.col("notice.owner_title")).otherwise(F.col("decision_maker_title")),
        "decision_maker_confidence": F.when(over, F.col("notice.confidence")).otherwise(F.col("decision_maker_confidence")),
        "enriched_contact_email": F.coalesce("enriched_contact_email", F.when(owner, F.col("notice.email"))),
        "legal_owner_name": F.col("notice.owner_name"), "legal_vat_id": F.when(owner, F.col("notice.vat_id")), "legal_phone": F.when(owner, F.col("notice.phone")), "legal_registration": F.col("notice.company_registration"),
    }).drop("notice")


def existing_email(df: DataFrame, *columns: str) -> Column:
    """The first valid address of the columns that df has, in lower case."""
    cs = [F.lower(F.trim(F.col(c))) for c in columns if c in df.columns]
    return F.coalesce(*[F.when(valid_email(c), c) for c in cs], F.lit(None).cast("string"))


def signals(df: DataFrame) -> DataFrame:
    """df with the first five words, in alphabetical order, of what its firm works with and of its certificates."""
    text = F.concat_ws(" ", *[c for c in ("enriched_description", "enriched_company_name", "business_name", "category") if c in df.columns])
    return df.withColumns({"ingredient_signals": F.array_join(F.slice(contains_any(text, INGREDIENTS), 1, 5), ", "), "certifications": F.array_join(F.slice(contains_any(text, CERTIFICATES), 1, 5), ", ")})


def enrich(leads: DataFrame, pages: DataFrame, year: int, responses: DataFrame | None = None, form: str = "a", most_pages: int = 5) -> DataFrame:
    """Leads with what pages(domain, url, html) and, if there are any, provider responses(domain, body) say of their domains.

    Every domain is looked up once, however many leads have it; leads without a domain keep nulls. What a provider says comes first,
    then what was crawled; a notice on a legal page overrides the decision maker by apply_legal."""
    domains = leads.where("website_domain <> ''").select(F.col("website_domain").alias("domain")).distinct()
    visited = P.visited(domains, pages, most_pages)
    crawled = P.crawl(domains, pages, most_pages).withColumn("enrichment_provider", F.lit("crawl"))
    found = crawled
    if responses is not None:
        r = responses.groupBy("domain").agg(F.min("body").alias("body")).select("domain", response("body", form).alias("r")).select("domain", *[F.col(f"r.{c}").alias(c) for c in ("company_name", "description", "industry", "employee_count", "linkedin_url", "facebook_url", "contacts")], F.lit("api").alias("enrichment_provider"))
        found = supplement(r, crawled)
    facts = found.join(site_facts(visited, year), "domain", "left").join(people.decision_maker(visited, crawled.select("domain", "emails")).select("domain", F.struct("name", "title", "confidence").alias("dm")), "domain", "left").join(people.legal_pages(domains, pages), "domain", "left")
    column = lambda c, t="string": F.col(c) if c in facts.columns else F.lit(None).cast(t)
    facts = facts.select(
        F.col("domain").alias("website_domain"), F.col("company_name").alias("enriched_company_name"), F.col("description").alias("enriched_description"), column("industry").alias("enriched_industry"), column("employee_count").alias("employee_count"), *[F.col(f"{p}_url").alias(f"enriched_{p}_url") for p in ("linkedin", "facebook", "instagram", "twitter", "tiktok", "youtube")],
        F.array_join("emails", ", ").alias("enriched_emails"), F.coalesce("emails_found", F.lit(0)).alias("enriched_emails_found"), F.array_join("email_patterns", ", ").alias("enriched_email_patterns"), F.get("emails", F.lit(0)).alias("enriched_contact_email"), "enrichment_provider",
        F.col("dm.name").alias("decision_maker_name"), F.col("dm.title").alias("decision_maker_title"), F.col("dm.confidence").alias("decision_maker_confidence"), "website_language", "business_age_years", "estimated_employees", "jsonld", "page_text", "html", "notice",
    )
    facts = apply_legal(facts)
    clash = [c for c in facts.columns if c in leads.columns and c != "website_domain"]
    return signals(sized(leads.drop(*clash).join(facts, "website_domain", "left"))).drop("jsonld", "page_text", "html", "employee_count")
