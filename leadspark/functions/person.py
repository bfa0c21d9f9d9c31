from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import NOT_NAMES, PARTICLES
from .text import col


def split_name(c: Column | str) -> Column:
    """struct(first, last): the first word, and the rest; '' for what is not there."""
    t = F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?U)\s+", " "))
    return F.struct(F.substring_index(t, " ", 1).alias("first"), F.when(t.contains(" "), F.regexp_replace(t, r"^\S+ ", "")).otherwise(F.lit("")).alias("last"))


def person_name(c: Column | str) -> Column:
    """A person's name without brackets, salutations and signs; '' for null."""
    t = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"\([^)]*\)", " ")
    t = F.regexp_replace(t, r"(?i)\b(mr|mrs|ms|dr|prof)\.?\s+", "")
    t = F.regexp_replace(F.translate(t, "|/_", "   "), r"(?U)\s+", " ")
    return F.regexp_replace(t, r"^[ ,.\t\n\r-]+|[ ,.\t\n\r-]+$", "")


def is_person(c: Column | str) -> Column:
    """Whether a text looks like a person's name: two to five words, two of them meaningful, none of a business, no digit, @ or http."""
    v = F.coalesce(col(c), F.lit(""))
    words = F.filter(F.split(F.trim(v), r"(?U)\s+"), lambda w: w != "")
    bare = F.filter(F.transform(words, lambda w: F.lower(F.regexp_replace(w, r"^[.,'-]+|[.,'-]+$", ""))), lambda w: w != "")
    meant = F.filter(bare, lambda w: ~w.isin(*PARTICLES))
    bad = F.exists(meant, lambda w: w.isin(*NOT_NAMES) | ~w.rlike("[A-Za-z]") | (F.length(w) < 2))
    return (v != "") & ~v.contains("@") & ~F.lower(v).contains("http") & ~v.rlike(r"\d") & (F.size(words) >= 2) & (F.size(words) <= 5) & ~bad & (F.size(meant) >= 2)
