"""Facts from the text of web pages, as column expressions: mails, links, titles, language, age, staff.

A table of pages (domain, url, html) stands for the network: whoever fetches pages writes it; see sources.live for one that does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import email_pattern, emails_in
from ..functions.text import col, let
from ..vocab import FOUNDED, LANGUAGE_WORDS, LEGAL_ROUTES, PLATFORMS, ROUTES, TITLE_CUTS

_ENTITIES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&copy;": "©", "&uuml;": "ü", "&ouml;": "ö", "&auml;": "ä", "&Uuml;": "Ü", "&Ouml;": "Ö", "&Auml;": "Ä", "&szlig;": "ß", "&eacute;": "é", "&egrave;": "è", "&agrave;": "à", "&ccedil;": "ç", "&ndash;": "–", "&mdash;": "—"}


def unescape(c: Column) -> Column:
    """The common entities as characters; &amp; last."""
    for k, v in [*list(_ENTITIES.items())[1:], ("&amp;", "&")]:
        c = F.replace(c, F.lit(k), F.lit(v))
    return c


def page_text(html: Column | str, newlines: bool = True) -> Column:
    """The text of a page: no scripts and styles, tags as line ends (or nothing), entities as characters, at most two line ends in a row."""
    t = F.regexp_replace(col(html), r"(?is)<(script|style|noscript)\b[^>]*>.*?</\1>", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"(?s)<!--.*?-->", " "), r"(?s)<[^>]*>", "\n" if newlines else "")
    t = unescape(t)
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[ \t\r\f]+", " "), r"\n\s*\n[\s]*", "\n\n")) if newlines else t


def social_links(html: Column | str, url: Column | str | None = None) -> Column:
    """struct of the first link of each platform in the page's anchors; a link from the root gets the page's host."""
    links = F.transform(F.regexp_extract_all(col(html), F.lit(r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1)), lambda h: unescape(h))
    if url is not None:
        root = F.regexp_extract(col(url), r"^([a-zA-Z]+://[^/]+)", 1)
        links = F.transform(links, lambda h: F.when(h.startswith("//"), F.concat(F.lit("https:"), h)).when(h.startswith("/"), F.concat(root, h)).otherwise(h))
    first = lambda p: F.get(F.filter(links, lambda h: h.rlike(f"(?i){p}")), F.lit(0))
    return F.struct(*[first(p).alias(k) for k, p in PLATFORMS.items()])


def title(html: Column | str) -> Column:
    """A firm's name from the page title: cut at the first of the usual additions that it contains; null without a title."""
    raw = F.regexp_extract(col(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    t = F.trim(F.regexp_replace(unescape(raw), r"\s+", " "))
    out = F
    for s in TITLE_CUTS:
        out = out.when(t.contains(s), F.substring_index(t, s, 1))
    return F.when(col(html).rlike(r"(?i)<title"), F.trim(out.otherwise(t)))


def _meta(html: Column, key: str, name: str) -> Column:
    tag = F.regexp_extract(html, rf"(?is)(<meta\b[^>]*?\b{key}\s*=\s*[\"']?{name}[\"'\s/>][^>]*>?)", 1)
    return tag, F.nullif(F.trim(unescape(F.coalesce(F.nullif(F.regexp_extract(tag, r'(?is)\bcontent\s*=\s*"([^"]*)"', 1), F.lit("")), F.regexp_extract(tag, r"(?is)\bcontent\s*=\s*'([^']*)'", 1)))), F.lit(""))


def description(html: Column | str) -> Column:
    """The description of the page's head; that for networks only where there is no tag of the first kind."""
    h = col(html)
    (tag, plain), (_, graph) = _meta(h, "name", "description"), _meta(h, "property", "og:description")
    return F.when(tag != "", plain).otherwise(graph)


def language(html: Column | str) -> Column:
    """The page's language as two capitals: its own statement, else that of its head, else by two telling words (languages in a fixed
    order), else German by more than ten of its letters; null otherwise."""
    h = col(html)
    short = lambda c: F.when(F.length(F.substring_index(F.upper(c), "-", 1)) == 2, F.substring_index(F.upper(c), "-", 1))
    own = short(F.regexp_extract(h, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1))
    head = short(F.coalesce(_meta(h, "http-equiv", "content-language")[1], F.lit("")))

    def by_words(text: Column) -> Column:
        out = F
        for code, words in LANGUAGE_WORDS.items():
            out = out.when(F.size(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(text, w))) >= 2, F.lit(code))
        return out.when(F.length(F.regexp_replace(text, "[^äöüß]", "")) > 10, "DE")

    return F.coalesce(own, head, let(F.lower(page_text(h, newlines=False)), by_words))


def business_age(html: Column | str, year: int) -> Column:
    """Years since the earliest founding or copyright year on a page, from 1900 to `year`; one at least; null without any."""

    def years(t: Column) -> Column:
        found = F.flatten(F.array(*[F.regexp_extract_all(t, F.lit(rf"(?iu){p}(\d{{4}})"), F.lit(1)) for p in FOUNDED], F.regexp_extract_all(t, F.lit(r"(?iu)Od\s+(\d{4})\s+roku"), F.lit(1))))
        return F.array_min(F.filter(F.transform(found, lambda y: y.try_cast("int")), lambda y: y.between(1900, year)))

    # a text without four figures in a row has no year
    first = let(page_text(html, newlines=False), lambda t: F.when(t.rlike(r"\d{4}"), years(t)))
    return let(first, lambda y: F.greatest(F.when(y.isNotNull(), F.lit(1)), F.lit(year) - y))


_UP, _LOW = r"[A-ZÀ-ÖØ-ÞĀ-ž]", r"[a-zà-öø-ÿā-ſ]"


def staff_tier(html: Column | str) -> Column:
    """Employees by how many 'Name - Title' a page has, else by how long its text is; null for short pages without any."""
    return let(page_text(html, newlines=False), _staff)


def _staff(t: Column) -> Column:
    n = F.size(F.regexp_extract_all(t, F.lit(rf"{_UP}{_LOW}+\s+{_UP}{_LOW}+\s*[-–—]\s*[A-Za-zÀ-ÖØ-öø-ÿĀ-ſ ]+"), F.lit(0)))
    by_name = F.when(n >= 50, "50+").when(n >= 20, "20-50").when(n >= 5, "5-20").when(n >= 2, "2-5").when(n >= 1, "1")
    return F.coalesce(by_name, F.when(F.length(t) > 50000, "20-50").when(F.length(t) > 20000, "5-20").when(F.length(t) > 10000, "2-5"))


def candidate_urls(base: Column | str, first: str = "auto") -> Column:
    """The pages of a site that may name people or addresses, the root first, then the routes of one language, then all, each once."""
    order = ["/", *(ROUTES.get(first, ()) if first != "auto" else ()), *[p for ps in ROUTES.values() for p in ps]]
    root = F.regexp_replace(col(base), "/+$", "")
    return F.array(*[col(base) if p == "/" else F.concat(root, F.lit(p)) for p in dict.fromkeys(order)])


def legal_urls(base: Column | str) -> Column:
    """The pages where a firm's legal notice may be, in the order of trial."""
    return F.array(*[F.concat(F.regexp_replace(col(base), "/+$", ""), F.lit(p)) for p in LEGAL_ROUTES])


def visited(domains: DataFrame, pages: DataFrame, most: int = 5, first: str = "auto") -> DataFrame:
    """(domain, url, html, ordinal): of every domain the first `most` candidate pages that the table has. Host names are compared without
    scheme and closing slash."""
    norm = lambda c: F.lower(F.regexp_replace(F.regexp_replace(c, r"^https?://", ""), "/+$", ""))
    wanted = domains.select("domain").distinct().select("domain", F.posexplode(candidate_urls(F.concat(F.lit("https://"), F.col("domain")), first)).alias("ordinal", "wanted"))
    have = pages.select(norm(F.col("url")).alias("_u"), "url", "html").groupBy("_u").agg(F.min_by(F.struct("url", "html"), "url").alias("p"))
    found = wanted.join(have, norm(F.col("wanted")) == F.col("_u")).select("domain", "p.url", "p.html", "ordinal")
    ranks = found.groupBy("domain").agg(F.slice(F.array_sort(F.collect_set("ordinal")), 1, most).alias("kept"))  # at most as many as there are routes
    return found.join(ranks, "domain").where(F.array_contains("kept", F.col("ordinal"))).drop("kept")


def crawl(domains: DataFrame, pages: DataFrame, most: int = 5, first: str = "auto") -> DataFrame:
    """One row per domain of which a page is there: name, description and links of its first page, the mails of all (in the order of
    pages), their patterns, and whether anything was found."""
    v = visited(domains, pages, most, first)
    facts = v.select("domain", "ordinal", title("html").alias("title"), description("html").alias("description"), social_links("html", "url").alias("social"), emails_in("html").alias("mails"))
    agg = facts.groupBy("domain").agg(F.min_by(F.struct("title", "description", "social"), "ordinal").alias("f"), F.array_sort(F.collect_list(F.struct("ordinal", "mails"))).alias("m"))  # one entry per route
    mails = F.array_distinct(F.flatten(F.transform("m", lambda x: x["mails"])))
    return agg.withColumn("emails", mails).select(
        "domain", F.col("f.title").alias("company_name"), F.col("f.description").alias("description"), *[F.col(f"f.social.{p}").alias(f"{p}_url") for p in PLATFORMS], "emails", F.size("emails").alias("emails_found"), email_pattern("emails").alias("email_patterns"),
        ((F.size("emails") > 0) | F.col("f.social.linkedin").isNotNull() | F.coalesce(F.col("f.title") != "", F.lit(False))).alias("success"),
    )
