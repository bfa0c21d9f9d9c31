from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def rating(c: Column | str) -> Column:
    """The first number of a text, held to 0..5; null where there is none. Decimals have a dot."""
    n = F.nullif(F.regexp_extract(col(c).cast("string"), r"(\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")
    return F.when(n.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(5.0), n)))


def reviews_count(c: Column | str) -> Column:
    """The first whole number of a text once brackets and commas are gone; null where there is none."""
    return F.nullif(F.regexp_extract(F.translate(col(c).cast("string"), "(),", ""), r"(\d+)", 1), F.lit("")).try_cast("int")


def coordinates(lat: Column | str, lon: Column | str) -> Column:
    """struct(lat, lon) as doubles; where lat is no number, lon is not read either."""
    a, text = F.trim(col(lat).cast("string")).try_cast("double"), F.trim(col(lat).cast("string"))
    bad = text.isNotNull() & (text != "") & a.isNull()
    return F.struct(a.alias("lat"), F.when(~bad, F.trim(col(lon).cast("string")).try_cast("double")).alias("lon"))


def safe_int(c: Column | str) -> Column:
    """A number or its text as a whole number, cut towards zero; null where it is none."""
    d = F.trim(col(c).cast("string")).try_cast("double")
    return F.when(~F.isnan(d), d.try_cast("int"))
