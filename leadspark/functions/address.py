from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import CITIES
from .text import col

# Postcode patterns in the order of trial.
POSTCODES = (
    r"\b[A-Z]{1,2}[0-9][A-Z0-9]?\s?[0-9][A-Z]{2}\b", r"\b[0-9]{5}(?:-[0-9]{4})?\b", r"\b[0-9]{4}\s?[A-Z]{2}\b", r"\b[0-9]{2}-[0-9]{3}\b", r"\b[0-9]{4}-[0-9]{3}\b", r"\b[0-9]{4,5}\b",
)


def postcode(c: Column | str) -> Column:
    """The first postcode of an address, by the first pattern that occurs; '' where none does."""
    return F.coalesce(*[F.nullif(F.regexp_extract(col(c), f"({p})", 1), F.lit("")) for p in POSTCODES], F.lit(""))


def address_parts(c: Column | str) -> Column:
    """struct(street, postcode, city, country) by commas: the first part; the one before the last of three or more, else the last of two;
    the last of three or more. Nulls for a null or empty address, '' for parts that are not there."""
    a = F.when(col(c) != "", col(c))
    parts = F.transform(F.split(a, ","), lambda x: F.trim(x))
    n = F.size(parts)
    return F.struct(
        F.element_at(parts, 1).alias("street"),
        F.when(a.isNotNull(), postcode(a)).alias("postcode"),
        F.when(n > 2, F.get(parts, n - 2)).when(n == 2, F.get(parts, n - 1)).when(n == 1, F.lit("")).alias("city"),
        F.when(n > 2, F.get(parts, n - 1)).when(n >= 1, F.lit("")).alias("country"),
    )


def country_of_city(c: Column | str, cities: dict[str, str] | None = None) -> Column:
    """The country of a large city by its name in lower case; null for others. cities: another table of names to countries."""
    table = cities or {name: country for country, names in CITIES.items() for name in names}
    return F.element_at(F.create_map(*map(F.lit, chain.from_iterable(table.items()))), F.lower(col(c)))
