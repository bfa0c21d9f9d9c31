from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import EXAMPLE_DOMAINS, GENERIC_LOCAL_PARTS, MAILBOXES, NO_REPLY
from .text import col, quoted

SYNTAX = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
INSIDE = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"


def valid_email(c: Column | str) -> Column:
    """Plain syntax test of the trimmed text; false for null."""
    return F.coalesce(F.trim(col(c).cast("string")).rlike(SYNTAX), F.lit(False))


def valid_email_strict(c: Column | str) -> Column:
    """As valid_email, with the limits of the mail standards: 254 characters in all, 64 before the @, no dot at an end or doubled."""
    t = F.trim(col(c).cast("string"))
    return F.coalesce(t.rlike(SYNTAX) & (F.length(t) <= 254) & (F.length(F.substring_index(t, "@", 1)) <= 64) & ~t.rlike(r"^\.|\.@|\.\."), F.lit(False))


def emails_in(c: Column | str, exclude: tuple[str, ...] = EXAMPLE_DOMAINS) -> Column:
    """The distinct addresses of a text in lower case, in the order in which they stand, without those nobody reads and those that
    contain an excluded name."""
    found = F.transform(F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(INSIDE), F.lit(0)), F.lower)
    keep = lambda e: e.rlike(SYNTAX) & ~e.rlike(rf"^(?:{quoted(NO_REPLY)})") & (~e.rlike(quoted(exclude)) if exclude else F.lit(True))
    return F.array_distinct(F.filter(found, keep))


def email_pattern(emails: Column | str) -> Column:
    """The patterns of the local parts that have a dot or an underscore: their first token, wherever it occurs, is 'firstname'."""
    local = F.transform(col(emails), lambda e: F.substring_index(e, "@", 1))
    named = F.filter(local, lambda p: p.rlike("[._]"))

    def pattern(p: Column) -> Column:
        first = F.when(p.contains("."), F.substring_index(p, ".", 1)).otherwise(F.substring_index(p, "_", 1))
        return F.when(first == "", p).otherwise(F.replace(p, first, F.lit("firstname")))

    return F.array_distinct(F.transform(named, pattern))


def mail_domain(c: Column | str) -> Column:
    """What follows the @, in lower case; '' where there is no @."""
    t = F.lower(F.trim(col(c).cast("string")))
    return F.coalesce(F.when(t.contains("@"), F.substring_index(t, "@", -1)), F.lit(""))


def generic_mailbox(c: Column | str) -> Column:
    """Whether the mailbox is nobody's in particular."""
    return F.coalesce(F.lower(F.substring_index(F.trim(col(c).cast("string")), "@", 1)).isin(*GENERIC_LOCAL_PARTS), F.lit(False))


def name_from_email(c: Column | str) -> Column:
    """'First Last' from first.last@ (dot, underscore or hyphen; letters only, two or more each, no generic mailbox); else null."""
    local = F.lower(F.substring_index(F.trim(col(c).cast("string")), "@", 1))
    parts = F.split(local, "[._-]")
    ok = F.coalesce(F.size(parts) >= 2, F.lit(False)) & F.forall(F.slice(parts, 1, 2), lambda p: p.rlike(r"(?U)^\p{L}{2,}$") & ~p.isin(*GENERIC_LOCAL_PARTS))
    return F.when(ok, F.array_join(F.transform(F.slice(parts, 1, 2), F.initcap), " "))


def likely_emails(domain: Column | str, name: Column | str | None = None) -> Column:
    """Mailboxes that a small firm is likely to have, in alphabetical order; the first 20 letters of its name are one."""
    d = F.lower(F.trim(col(domain)))
    boxes = F.array(*[F.lit(m) for m in MAILBOXES])
    if name is not None:
        own = F.substring(F.regexp_replace(F.lower(F.coalesce(col(name), F.lit(""))), "[^a-z0-9]", ""), 1, 20)
        boxes = F.concat(F.when(own != "", F.array(own)).otherwise(F.array().cast("array<string>")), boxes)
    return F.when(d.rlike(r"\.[a-zA-Z]{2,}$"), F.array_sort(F.array_distinct(F.filter(F.transform(boxes, lambda b: F.concat(b, F.lit("@"), d)), lambda e: e.rlike(SYNTAX))))).otherwise(F.array().cast("array<string>"))
