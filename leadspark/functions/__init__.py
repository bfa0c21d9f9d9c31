"""Scalar functions, Column to Column; all of them run in the JVM."""

from .address import address_parts, country_of_city, postcode
from .category import category_class, contains_any
from .email import email_pattern, emails_in, generic_mailbox, likely_emails, mail_domain, name_from_email, valid_email, valid_email_strict
from .numbers import coordinates, rating, reviews_count, safe_int
from .person import is_person, person_name, split_name
from .phone import parse_phone
from .text import clean_text, first_filled, match_key, strip_suffix
from .url import denylisted, domain_of, host_of, normalize_url

__all__ = [
    "address_parts", "category_class", "clean_text", "contains_any", "coordinates", "country_of_city", "denylisted", "domain_of", "email_pattern", "emails_in", "first_filled", "generic_mailbox", "host_of", "is_person", "likely_emails", "mail_domain",
    "match_key", "name_from_email", "normalize_url", "parse_phone", "person_name", "postcode", "rating", "reviews_count", "safe_int", "split_name", "strip_suffix", "valid_email", "valid_email_strict",
]
