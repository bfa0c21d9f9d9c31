"""The cleaning projection: LEAD_RAW in, normalised columns added, in one select without Python."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import address_parts, category_class, clean_text, coordinates, country_of_city, domain_of, normalize_url, parse_phone, rating, reviews_count, strip_suffix
from ..schema import ENRICHED


def clean(df: DataFrame, cities: dict[str, str] | None = None) -> DataFrame:
    """Every record cleaned. Nulls stay null in derived columns; texts are trimmed to ''; extra columns are kept as they are."""
    d = df.withColumns({
        "business_name": strip_suffix(clean_text("business_name")),
        "category": clean_text("category"),
        "address": clean_text("address"),
        "email_raw": F.lower(F.trim("email_raw")),
        "_region": country_of_city("city", cities),
    })
    site = F.when(F.trim("website_raw") != "", normalize_url("website_raw"))
    d = d.withColumns({
        "canonical_category": category_class("category"),
        "_phone": parse_phone("phone_raw", "_region"),
        "website_normalized": site,
        "website_domain": domain_of(site),
        "rating_normalized": rating("rating"),
        "reviews_count_normalized": reviews_count("reviews_count"),
        "_at": coordinates("lat", "lon"),
        "_address": address_parts("address"),
    })
    return d.withColumns({
        "phone_e164": F.col("_phone.e164"), "phone_country": F.col("_phone.country"), "phone_valid": F.coalesce("_phone.valid", F.lit(False)), "lat": F.col("_at.lat"), "lon": F.col("_at.lon"),
        "address_street": F.col("_address.street"), "address_postcode": F.col("_address.postcode"), "address_city_component": F.col("_address.city"), "address_country": F.col("_address.country"),
    }).drop("_region", "_phone", "_at", "_address")


def with_enrichment_columns(df: DataFrame) -> DataFrame:
    """df with the columns that enrichment fills, null where it has none of that name."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in ENRICHED.items() if c not in df.columns})


def filter_categories(df: DataFrame, keywords: str) -> DataFrame:
    """Rows whose category or class contains one of the comma-separated words; empty words are ignored, no word keeps all rows."""
    words = [w.strip().lower() for w in keywords.split(",") if w.strip()]
    if not words:
        return df
    has = lambda c: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), w))
    return df.where(has("category") | has("canonical_category"))
