from __future__ import annotations

import re

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import SUFFIXES


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(words) -> str:
    """An alternation of words taken literally, the longest first, for Java and Python."""
    return "|".join(re.sub(r"([.\\+*?\[^\]$(){}=!<>|:\-#/&])", r"\\\1", w) for w in sorted(set(words), key=lambda w: (-len(w), w)))


def clean_text(c: Column | str) -> Column:
    """Trimmed, every run of whitespace one blank; null becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(col(c), r"(?U)\s+", " ")), F.lit(""))


def filled(c: Column | str) -> Column:
    """The trimmed text, or null where it is null, blank or 'nan'."""
    t = F.trim(col(c).cast("string"))
    return F.when((t != "") & (F.lower(t) != "nan"), t)


def first_filled(*cs: Column | str) -> Column:
    """The first of the columns that is filled, or ''."""
    return F.coalesce(*[filled(c) for c in cs], F.lit(""))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is made once, however often f names it (a column used in many places is else written out in each)."""
    return F.element_at(F.transform(F.array(value), f), 1)


def strip_suffix(c: Column | str) -> Column:
    """A display name without the legal form at its end (one, the longest)."""
    return F.trim(F.regexp_replace(col(c), rf"(?iu) (?:{quoted(SUFFIXES)})$", ""))


def _bare(s: str) -> str:
    return s.replace(".", "").replace("/", "").replace("à", "a")


def match_key(c: Column | str) -> Column:
    """A text as compared for duplicates: lower case, no commas and dots, blanks for hyphens, without one legal form."""
    t = F.lower(F.trim(col(c)))
    t = F.trim(F.regexp_replace(F.regexp_replace(t, "[,.]", ""), "-", " "))
    return F.coalesce(F.trim(F.regexp_replace(t, rf" (?:{quoted(map(_bare, SUFFIXES))})$", "")), F.lit(""))
