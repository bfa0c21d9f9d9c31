"""A whole run: scan, clean, deduplicate, filter, enrich, verify, write. Steps are lazy; what several sinks read is written once."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import denylisted
from ..operators import cache, clean, dedupe, enrich, verify
from ..operators.checkpoint import Checkpoints
from ..sources import csv as source
from ..sources import sinks
from . import report


@dataclass
class Options:
    """What a run does. Paths of lookup tables are Parquet; those not given are not looked up."""

    dedupe: bool = True
    fuzzy: bool = True
    block: str | None = None
    categories: str = ""
    pages: str | None = None
    responses: str | None = None
    response_form: str = "a"
    cache: str | None = None
    skip_cached: bool = False
    mx: str | None = None
    probes: str | None = None
    max_pages: int = 5
    quick: bool = False
    year: int = 2025
    checkpoints: str | None = None
    resume: bool = False
    stats: dict = field(default_factory=dict)


def prepare(spark: SparkSession, folder: str, o: Options) -> DataFrame:
    """Leads scanned, cleaned, deduplicated and filtered. The category filter comes after duplicates are collapsed, since what counts
    as a duplicate must not depend on it."""
    d = clean.clean(source.read_folder(spark, folder))
    d = dedupe.deduplicate(d, fuzzy=o.fuzzy, block=F.col(o.block) if o.block else None) if o.dedupe else dedupe.skipped(d)
    return clean.filter_categories(d, o.categories)


def with_cached(df: DataFrame, table: DataFrame, now) -> DataFrame:
    """Leads that are not looked up again, with what the cache has of their domains: name, link, number of mails, time, and a provider
    that says so. Leads of which it has nothing stay as they are."""
    d = cache.lookup(df, table, "crawl", now)
    said = lambda k: F.get_json_object("cached_result", f"$.{k}")
    there = F.col("cached_status") == "success"
    kinds = {f.name: f.dataType for f in df.schema.fields}
    new = {"enriched_company_name": said("company_name"), "enriched_linkedin_url": said("linkedin_url"), "enriched_emails_found": F.coalesce(said("emails_found").try_cast("int"), F.lit(0)), "enriched_at": said("enriched_at"), "enrichment_provider": F.lit("cached:crawl")}
    return d.withColumns({k: F.when(there, c.try_cast(kinds[k]) if k in kinds else c).otherwise(F.col(k) if k in kinds else F.lit(None)) for k, c in new.items()}).drop("cached_status", "cached_result")


def complete(leads: DataFrame, o: Options, now=None) -> DataFrame:
    """Leads enriched and verified from the lookup tables of the options."""
    spark, now = leads.sparkSession, now if now is not None else F.current_timestamp()
    d = clean.with_enrichment_columns(leads)
    todo = d
    known: DataFrame | None = None
    if o.cache:
        table = cache.of_table(spark.read.parquet(o.cache))
        if o.skip_cached:
            todo = cache.not_cached(d, table, "crawl", now)
            known = with_cached(d.join(todo.select("source_row_id"), "source_row_id", "left_anti"), table, now)
    if o.pages:
        denied = todo.where(F.coalesce(denylisted("website_domain"), F.lit(False)) & (F.coalesce("website_domain", F.lit("")) != ""))  # hosts of many firms: not looked up
        known = denied if known is None else known.unionByName(denied, allowMissingColumns=True)
        todo = todo.join(denied.select("source_row_id"), "source_row_id", "left_anti")
        responses = spark.read.parquet(o.responses) if o.responses else None
        todo = clean.with_enrichment_columns(enrich.enrich(todo, spark.read.parquet(o.pages), o.year, responses, o.response_form, 2 if o.quick else o.max_pages))
    d = todo if known is None else todo.unionByName(known, allowMissingColumns=True)
    if o.mx and not o.quick:
        v = verify.verify(d, spark.read.parquet(o.mx), spark.read.parquet(o.probes) if o.probes else None, "enriched_contact_email")
        d = v.withColumns({"email_verification_status": F.col("verification_status"), "email_verification_confidence": F.col("verification_confidence"), "email_smtp_status": F.col("smtp_status")}).drop("email_domain", "has_mx", "smtp_status", "verification_status", "verification_confidence")
    return d


def write(df: DataFrame, folder: str, stamp: str, stats: dict | None = None, quick: bool = False) -> dict[str, str]:
    """The files of a run: full table, slim export, search queries, workbook if possible, report; in quick mode the slim export only."""
    out = {"slim": sinks.write_csv(sinks.slim(df), f"{folder}/slim_final_{stamp}.csv")}
    if not quick:
        out["full"] = sinks.write_csv(df, f"{folder}/cleaned_enriched_{stamp}.csv")
        out["searches"] = sinks.write_csv(sinks.searches(df), f"{folder}/searches_{stamp}.csv", bom=False)
        out["report"] = sinks.write_text(df, report.markdown(df, stats), f"{folder}/report_{stamp}.md")
        if path := sinks.write_workbook(df, f"{folder}/cleaned_enriched_{stamp}.xlsx"):
            out["workbook"] = path
    return out


def run(spark: SparkSession, folder: str, out: str, stamp: str, o: Options | None = None) -> dict[str, str]:
    """A run from CSV files to files. With a checkpoint folder each finished step is kept there, and resume goes on from the last."""
    o = o or Options()
    points = Checkpoints(spark, o.checkpoints) if o.checkpoints else None
    at = points.load() if points and o.resume else None
    done = at[1] if at else None
    leads = at[0] if at else prepare(spark, folder, o)
    if points and done not in ("filtered", "enriched"):
        leads = points.load(points.save(leads, "filtered"))[0]
    if done != "enriched":
        leads = complete(leads, o)
    if points and done != "enriched":
        leads = points.load(points.save(leads, "enriched"))[0]
    else:
        tmp = f"{out}/.rows-{stamp}"
        leads.write.mode("overwrite").parquet(tmp)  # several sinks read the rows
        leads = spark.read.parquet(tmp)
    stats = {"records": leads.count(), **o.stats}
    files = write(leads, out, stamp, stats, o.quick)
    if not points:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/.rows-{stamp}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return files
