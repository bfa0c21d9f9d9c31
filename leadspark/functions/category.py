from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import CATEGORY_TERMS
from .text import col, quoted


def category_class(c: Column | str, terms: dict[str, tuple[str, ...]] | None = None) -> Column:
    """The first class with a term inside the typed category, else 'other'. A term may be part of a longer word."""
    t = F.lower(F.trim(col(c)))
    out = F
    for name, words in (terms or CATEGORY_TERMS).items():
        out = out.when(t.rlike(quoted(words)), F.lit(name))
    return F.coalesce(out.otherwise(F.lit("other")), F.lit("other"))


def contains_any(c: Column | str, words) -> Column:
    """Which of the words a text contains, in alphabetical order."""
    t = F.lower(F.coalesce(col(c), F.lit("")))
    return F.filter(F.array(*[F.lit(w) for w in sorted(set(words))]), lambda w: F.contains(t, w))
