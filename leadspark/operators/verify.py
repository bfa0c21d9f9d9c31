"""The ladder of mail verification: syntax, then the domain's mail hosts, then what a host said of the mailbox.

Lookups are tables: mx(domain, has_mx, hosts) and, if there is one, smtp_probe(email, host, code).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import mail_domain, valid_email_strict

# Fixed values: (status of the mailbox) -> (overall status, confidence).
OUTCOME = {
    "verified": ("verified", "high"), "bounced": ("invalid", "high"), "catch_all": ("likely_valid", "low"), "timeout": ("likely_valid", "medium"), "error": ("likely_valid", "medium"), "unverified": ("likely_valid", "medium"),
}


def by_preference(hosts: Column) -> Column:
    """Hosts written 'preference host' in the order of preference, without it; plain names keep their order after them."""
    pairs = F.transform(hosts, lambda h, i: F.struct(F.coalesce(F.regexp_extract(h, r"^(\d+)\s", 1).try_cast("int"), F.lit(2**30)).alias("p"), i.alias("i"), F.regexp_replace(h, r"^\d+\s+", "").alias("h")))
    return F.transform(F.array_sort(pairs), lambda x: x["h"])


def code_status(code: Column) -> Column:
    """What a reply code says of a mailbox; null where it decides nothing and the next host is asked."""
    return F.when(code == 250, "verified").when(code.between(550, 554), "bounced").when(code == 0, "timeout")


def smtp_status(probes: DataFrame, mx: DataFrame | None = None) -> DataFrame:
    """(email, smtp_status): the first decisive reply in the order in which the domain's mail hosts are preferred (hosts that mx does not
    have come after them, by name); 'error' if none decided; 'catch_all' if an address that cannot exist was accepted by the host that decided."""
    if mx is not None:
        listed = mx.groupBy(F.lower("domain").alias("_d")).agg(F.max("hosts").alias("hosts")).select("_d", F.posexplode(by_preference(F.col("hosts"))).alias("_at", "_h"))
        listed = listed.groupBy("_d", F.lower("_h").alias("_h")).agg(F.min("_at").alias("_at"))
        probes = probes.join(listed, (F.substring_index(F.lower(F.trim("email")), "@", -1) == F.col("_d")) & (F.lower("host") == F.col("_h")), "left")
    at = F.coalesce(F.col("_at"), F.lit(2**30)) if mx is not None else F.lit(0)
    one = probes.select(at.alias("at"), F.lower(F.trim("email")).alias("email"), "host", "code", code_status(F.col("code")).alias("s"), (F.col("catch_all") if "catch_all" in probes.columns else F.lit(False)).alias("c"))
    first = one.groupBy("email").agg(F.min(F.when(F.col("s").isNotNull(), F.struct("at", "host", "s", "c"))).alias("f"))
    return first.select("email", F.when(F.coalesce(F.col("f.c"), F.lit(False)) & (F.col("f.s") == "verified"), "catch_all").otherwise(F.coalesce("f.s", F.lit("error"))).alias("smtp_status"))


def verify(df: DataFrame, mx: DataFrame, probes: DataFrame | None = None, email: str = "email") -> DataFrame:
    """df with email_domain, has_mx, smtp_status, verification_status and verification_confidence, in any order of rows.

    Empty and null addresses are 'unverified', wrong syntax and domains without mail hosts 'invalid'; a domain of which mx knows
    nothing is as one whose hosts did not answer. Repeated rows of mx count as one that says yes if any does."""
    d = df.withColumns({"_e": F.lower(F.trim(F.coalesce(F.col(email), F.lit("")))), "email_domain": mail_domain(email)})
    known = mx.groupBy(F.lower("domain").alias("_d")).agg(F.max("has_mx").alias("has_mx"))
    d = d.join(known, F.col("email_domain") == F.col("_d"), "left").drop("_d")
    if probes is not None:
        said = smtp_status(probes, mx)
        d = d.join(said, d["_e"] == said["email"], "left").drop(said["email"])
    else:
        d = d.withColumn("smtp_status", F.lit(None).cast("string"))
    good = valid_email_strict("_e")
    smtp = F.when((F.col("_e") != "") & good & F.coalesce(F.col("has_mx"), F.lit(True)), F.coalesce("smtp_status", F.lit("unverified")))
    pick = lambda k: F.element_at(F.create_map(*[F.lit(x) for s, o in OUTCOME.items() for x in (s, o[k])]), smtp)
    return d.withColumns({
        "smtp_status": smtp,
        "verification_status": F.when(F.col("_e") == "", "unverified").when(~good, "invalid").when(F.col("has_mx") == F.lit(False), "invalid").otherwise(F.coalesce(pick(0), F.lit("unverified"))),
        "verification_confidence": F.when(F.col("_e") == "", "low").when(~good, "high").when(F.col("has_mx") == F.lit(False), "high").otherwise(F.coalesce(pick(1), F.lit("low"))),
    }).drop("_e")


def status_counts(df: DataFrame) -> DataFrame:
    """How many rows have each verification status; '' counts as unverified."""
    return df.groupBy(F.coalesce(F.nullif(F.trim("verification_status"), F.lit("")), F.lit("unverified")).alias("verification_status")).agg(F.count("*").alias("n"))
