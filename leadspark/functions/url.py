from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import DENYLIST, PUBLIC_SUFFIXES, TRACKING
from .text import col, quoted


def normalize_url(c: Column | str) -> Column:
    """https, host in lower case, no tracking parameters, no fragment, no slash at the end. Parameters without a value vanish, and
    values of one name are put together where it first stood, as a parser of forms would."""
    t = F.trim(col(c))
    t = F.when(F.startswith(t, F.lit("http://")) | F.startswith(t, F.lit("https://")), t).otherwise(F.concat(F.lit("https://"), t))
    rest = F.regexp_replace(F.regexp_replace(t, r"^https?://", ""), r"#.*$", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1)
    query = F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike(r"^[^=]+=.+$") & ~F.lower(F.regexp_extract(p, r"^([^=]*)", 1)).isin(*TRACKING))
    names = F.array_distinct(F.transform(pairs, lambda p: F.regexp_extract(p, r"^([^=]*)", 1)))
    grouped = F.flatten(F.transform(names, lambda n: F.filter(pairs, lambda p: F.regexp_extract(p, r"^([^=]*)", 1) == n)))
    text = F.array_join(grouped, "&")
    whole = F.concat(F.lit("https://"), host, path, F.when(text != "", F.concat(F.lit("?"), text)).otherwise(F.lit("")))
    return F.regexp_replace(whole, r"/+$", "")


def host_of(c: Column | str) -> Column:
    """The host of a URL, without user and port; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(F.trim(col(c)), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?(?:[^/@?#]*@)?([^/:?#\s]+)", 1)), F.lit(""))


def domain_of(c: Column | str) -> Column:
    """The registrable domain of a URL or host: the public suffix and one label. Suffixes of several labels are those of the vocabulary;
    a name of a single label has an empty suffix (a dot at the end)."""
    h = host_of(c)
    one = F.regexp_extract(h, r"([^.]+\.[^.]+)\.?$", 1)
    two = F.regexp_extract(h, rf"([^.]+\.(?:{quoted(PUBLIC_SUFFIXES)}))\.?$", 1)
    return F.when(h.isNull(), None).when(h.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), F.concat(h, F.lit("."))).when(two != "", two).when(one != "", one).otherwise(F.concat(h, F.lit(".")))


def denylisted(c: Column | str) -> Column:
    """Whether a domain, with or without scheme, www and path, is on the list or under a name on it; true for a missing one."""
    d = F.regexp_replace(F.regexp_replace(F.lower(F.trim(col(c))), r"^https?://", ""), r"^www\.", "")
    d = F.regexp_extract(d, r"^([^/]*)", 1)
    return F.coalesce((col(c) == "") | d.rlike(rf"(?:^|\.)(?:{quoted(DENYLIST)})$"), F.lit(True))
