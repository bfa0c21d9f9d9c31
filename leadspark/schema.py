"""The schemas that steps hand over, by name."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "int": T.IntegerType(), "timestamp": T.TimestampType(), "map<string,string>": T.MapType(T.StringType(), T.StringType())}


def struct(text: str) -> T.StructType:
    """A struct type from 'name kind, ...', without a session."""
    parts = [f.strip().replace(";", ",") for f in text.replace("string,string", "string;string").split(",") if f.strip()]
    return T.StructType([T.StructField(*(lambda n, k: (n, _KINDS[k]))(*f.split(maxsplit=1))) for f in parts])


LEAD_RAW = T.StructType([T.StructField(c, T.StringType()) for c in ("city", "business_name", "category", "address", "phone_raw", "website_raw", "email_raw", "google_maps_url", "rating", "reviews_count", "lat", "lon", "source_file")] + [T.StructField("source_row_id", T.LongType())])
PERSON = struct("name string, title string, confidence string")
CACHE = struct("key string, domain string, provider string, status string, result string, error_reason string, created_at timestamp, expires_at timestamp")
JSONLD = struct(
    "business_name string, description string, email string, phone string, address string, lat double, lon double, founder_name string, employee_count string, founding_date string,"
    " social_links map<string,string>, business_type string, opening_hours string, image string, price_range string"
)
SLIM = ("companyName", "email", "website", "phone", "firstName", "lastName", "location", "rating", "reviewsCount", "jobTitle", "department")
#: Columns that enrichment adds, null until it does.
ENRICHED = {
    "enriched_company_name": "string", "enriched_description": "string", "enriched_industry": "string", "enriched_employee_count": "string", "enriched_linkedin_url": "string", "enriched_facebook_url": "string", "enriched_instagram_url": "string", "enriched_twitter_url": "string",
    "enriched_tiktok_url": "string", "enriched_youtube_url": "string", "enriched_emails": "string", "enriched_emails_found": "int", "enriched_email_patterns": "string", "enriched_contact_name": "string", "enriched_contact_title": "string", "enriched_contact_email": "string", "enrichment_provider": "string",
    "enrichment_error": "string", "enriched_at": "timestamp", "decision_maker_name": "string", "decision_maker_title": "string", "decision_maker_confidence": "string", "legal_owner_name": "string", "legal_vat_id": "string", "legal_phone": "string", "legal_registration": "string", "estimated_employees": "string",
    "business_age_years": "int", "website_language": "string", "company_size_bucket": "string", "company_size_midpoint": "double", "company_size_confidence": "string", "company_size_source": "string", "company_size_evidence": "string", "ingredient_signals": "string", "certifications": "string",
    "email_verification_status": "string", "email_verification_confidence": "string", "email_smtp_status": "string",
}
