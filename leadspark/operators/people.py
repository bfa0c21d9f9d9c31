"""People and legal facts on pages: owners from legal notices, names with titles, names behind mail addresses."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import emails_in
from ..functions.text import col
from ..schema import struct
from ..vocab import LEGAL_ROUTES, REGISTERS, TAX_NUMBERS, TITLES
from .pages import page_text

_PART = r"[A-ZÀ-ÖØ-ÞĀ-ž][a-zà-öø-ÿā-ſ]+"
_PARTICLE = r"(?:von|van|de|da|di|del|della|dos|das|du|la|le|el|ten|ter|zum|zur)"
NAME = rf"{_PART}(?:-{_PART})?(?:\s+{_PARTICLE})*(?:\s+{_PART})+"
# More titles that stand beside a name on pages about a firm.
_MORE_TITLES = (
    "managing director|general manager|co-founder|founder|owner|ceo|manager|director|president|principal|head chef|executive chef|pastry chef|head baker|purchasing manager|procurement manager|buyer|inhaberin|inhaber|gründerin|gründer|geschäftsführerin|geschäftsführer"
    "|leiterin|leiter|direktorin|direktor|vorstand|küchenchef|einkaufsleiterin|einkaufsleiter|bäckermeisterin|bäckermeister|konditormeisterin|konditormeister|propriétaire|fondateur|fondatrice|directeur|directrice|gérante|gérant|présidente|président|pdg|chef pâtissier|chef cuisinier"
    "|proprietario|proprietaria|fondatore|direttore|direttrice|amministratore delegato|titolare|responsabile|propietario|propietaria|fundador|fundadora|directora|gerente|presidente|presidenta|jefe de cocina|proprietário|proprietária|diretor|diretora"
    "|eigenaar|eigenares|oprichter|oprichtster|bestuurder|hoofd inkoop|meester bakker|chef-kok|właściciel|właścicielka|założyciel|założycielka|dyrektor|kierownik|prezes|szef kuchni|spa manager|kosmetikerin"
)
OWNER_TITLES = r"(?iu)owner|founder|ceo|inhaber|gründer|geschäftsführer|propriétaire|fondateur|gérant|titolare|proprietari|propietari|fundador|proprietári|eigenaar|oprichter|właściciel|założyciel"

_OWNER = struct("name string, title string, confidence string")


def _owner_patterns(strict: bool):
    flags = 0 if strict else re.I
    return [(re.compile(rf"(?:^|\b)({k})\s*[:\-–—]?\s*({NAME})", flags), re.compile(rf"^\s*({k})\s*[:\-–—]?\s*$", re.I), re.compile(rf"({k})\s*[:\-–—]?\s*({NAME})", flags), re.compile(rf"\b{k}\b", re.I), t) for k, t in TITLES]


_LOOSE, _STRICT = _owner_patterns(False), _owner_patterns(True)
_ALONE, _ANY = re.compile(rf"^({NAME})$"), re.compile(rf"({NAME})")


def find_owner(text: str | None, strict: bool = False) -> tuple[str | None, str | None, str]:
    """(name, title in English, confidence) of who answers for a firm by its legal notice.

    high: title and name on one line or on two following ones; medium: anywhere together; low: a name within 200 characters after a
    title. Unless strict, the capitals of names are not insisted on beside a title."""
    patterns, lines = _STRICT if strict else _LOOSE, (text or "").split("\n")
    for i, line in enumerate(map(str.strip, lines)):
        if not line:
            continue
        for same, alone, _, _, title in patterns:
            if m := same.search(line):
                return m[2].strip(), title, "high"
            if i + 1 < len(lines) and alone.match(line) and (m := _ALONE.match(lines[i + 1].strip())):
                return m[1].strip(), title, "high"
    for _, _, near, _, title in patterns:
        if m := near.search(text or ""):
            return m[2].strip(), title, "medium"
    for _, _, _, word, title in patterns:
        if (m := word.search(text or "")) and (n := _ANY.search((text or "")[m.end() : m.end() + 200])):
            return n[1].strip(), title, "low"
    return None, None, "low"


def owner(text: Column | str, strict: bool = False) -> Column:
    """find_owner as a struct(name, title, confidence) column, in Arrow batches."""

    @F.pandas_udf(_OWNER)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([find_owner(t, strict) for t in s], columns=["name", "title", "confidence"])

    return run(col(text))


def _first(text: Column, patterns, flags: str = "(?iu)") -> Column:
    return F.coalesce(*[F.nullif(F.trim(F.regexp_extract(text, flags + p, 1)), F.lit("")) for p in patterns])


def vat_id(text: Column | str) -> Column:
    """The first tax number by the patterns in order, without blanks."""
    return F.regexp_replace(_first(col(text), TAX_NUMBERS), r"\s+", "")


def registration(text: Column | str) -> Column:
    """The first register entry by the patterns in order."""
    return F.regexp_replace(_first(col(text), REGISTERS), r"[.,;:]+$", "")


def legal_phone(text: Column | str) -> Column:
    """The phone that is labelled as such, else the first international one; separators become one blank."""
    found = _first(col(text), (r"(?:Tel(?:efon|éphone|efono)?\.?\s*:?\s*)((?:\+|00)[\d\s\-/().]{7,20})", r"((?:\+|00)\d[\d\s\-/().]{7,20})"))
    return F.trim(F.regexp_replace(found, r"[\s\-/().]+", " "))


def legal_email(text: Column | str) -> Column:
    """The first address that looks like a person's (first.last@), else the first; none of machines or examples."""
    mails = emails_in(text, ("example.com", "domain.com", "sentry.io", "wixpress.com"))
    personal = F.filter(mails, lambda e: F.substring_index(e, "@", 1).contains(".") & ~e.rlike("^(?:info|contact|hello|support|office|mail)"))
    return F.coalesce(F.get(personal, F.lit(0)), F.get(mails, F.lit(0)))


def legal_notice(html: Column | str) -> Column:
    """struct(owner_name, owner_title, email, phone, company_registration, vat_id, confidence) of a legal page."""
    t = page_text(html)
    o = owner(t)
    fields = {"owner_name": o["name"], "owner_title": o["title"], "email": legal_email(t), "phone": legal_phone(t), "company_registration": registration(t), "vat_id": vat_id(t)}
    points = F.when(o["name"].isNull(), 0).otherwise(F.element_at(F.create_map(F.lit("high"), F.lit(3), F.lit("medium"), F.lit(2), F.lit("low"), F.lit(1)), o["confidence"]))
    for k in ("email", "phone", "company_registration", "vat_id"):
        points = points + fields[k].isNotNull().cast("int")
    return F.struct(*[c.alias(k) for k, c in fields.items()], F.when(points >= 4, "high").when(points >= 2, "medium").otherwise("low").alias("confidence"))


def legal_pages(domains: DataFrame, pages: DataFrame) -> DataFrame:
    """(domain, notice) of each domain's best legal page: of those up to the first of high confidence the one with most fields, the
    earlier one of equals."""
    norm = lambda c: F.lower(F.regexp_replace(F.regexp_replace(c, r"^https?://", ""), "/+$", ""))
    wanted = domains.select("domain").distinct().select("domain", F.posexplode(F.array(*[F.concat(F.lower("domain"), F.lit(p)) for p in LEGAL_ROUTES])).alias("ordinal", "u"))
    have = pages.select(norm(F.col("url")).alias("u"), "html").groupBy("u").agg(F.min("html").alias("html"))
    read = wanted.join(have, "u").select("domain", "ordinal", legal_notice("html").alias("notice"))
    fields = ("owner_name", "owner_title", "email", "phone", "company_registration", "vat_id")
    read = read.withColumn("n", sum((F.col(f"notice.{f}").isNotNull().cast("int") for f in fields), F.lit(0)))
    all_ = read.groupBy("domain").agg(F.min(F.when(F.col("notice.confidence") == "high", F.col("ordinal"))).alias("stop"))
    return read.join(all_, "domain").where("stop is null or ordinal <= stop").groupBy("domain").agg(F.max_by("notice", F.struct("n", -F.col("ordinal"))).alias("notice"))


def people(text: Column | str) -> Column:
    """array<struct(name, title)> of the lines of 6 to 199 characters that hold a name and a title beside it, in their order."""
    lines = F.filter(F.transform(F.split(col(text), "\n"), lambda x: F.trim(x)), lambda x: F.length(x).between(6, 199))
    title = rf"(?iu:{_MORE_TITLES})"
    after = rf"({NAME})\s*[,\-–—|:(]\s*((?:\S+\s+){{0,2}}{title})"
    before = rf"({title})\s*[:\-–—|]\s*({NAME})"

    def of(x: Column) -> Column:
        a, b = F.regexp_extract(x, after, 1), F.regexp_extract(x, before, 2)
        return F.when(a != "", F.struct(a.alias("name"), F.trim(F.regexp_extract(x, after, 2)).alias("title"))).when(b != "", F.struct(b.alias("name"), F.trim(F.regexp_extract(x, before, 1)).alias("title")))

    return F.filter(F.transform(lines, of), lambda p: p.isNotNull())


def decision_maker(visited: DataFrame, mails: DataFrame | None = None) -> DataFrame:
    """(domain, name, title, confidence): of pages (domain, ordinal, html) the first whose first person has an owner's title (high); if no
    page names anybody, the name behind a mail (medium); else the first person named (low). mails: (domain, emails)."""
    from ..functions import name_from_email

    found = visited.select("domain", "ordinal", F.get(people(page_text("html")), F.lit(0)).alias("p")).where("p is not null")
    best = found.groupBy("domain").agg(F.min_by("p", F.when(F.col("p.title").rlike(OWNER_TITLES), F.col("ordinal"))).alias("owner"), F.max(F.col("p.title").rlike(OWNER_TITLES)).alias("any"), F.min_by("p", "ordinal").alias("first"))
    named = best.select("domain", F.when(F.col("any"), F.struct("owner.name", "owner.title", F.lit("high").alias("confidence"))).otherwise(F.struct("first.name", "first.title", F.lit("low").alias("confidence"))).alias("d"))
    if mails is not None:
        names = F.filter(F.transform("emails", name_from_email), lambda n: n.isNotNull())
        by_mail = mails.select("domain", F.get(names, F.lit(0)).alias("name")).where("name is not null").groupBy("domain").agg(F.min("name").alias("name"))
        extra = by_mail.join(named.select("domain"), "domain", "left_anti").select("domain", F.struct("name", F.lit(None).cast("string").alias("title"), F.lit("medium").alias("confidence")).alias("d"))
        named = named.unionByName(extra)
    return named.select("domain", "d.name", "d.title", "d.confidence")
