"""python -m leadspark.cli: a run over a folder of CSV files, the slim export of an earlier one, or the verification of its mails."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from .operators import verify
from .plans import pipeline
from .session import session
from .sources import csv as source
from .sources import sinks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="leadspark", description=__doc__)
    p.add_argument("--version", action="version", version="leadspark 0.1")
    p.add_argument("--input", help="folder of CSV files")
    p.add_argument("--output", default="output", help="folder for results")
    p.add_argument("--master", help="Spark master, if not set by spark-submit")
    p.add_argument("--skip-dedupe", action="store_true")
    p.add_argument("--no-fuzzy", action="store_true", help="duplicates by equal phones and domains only")
    p.add_argument("--block", help="column within which alike names are compared, such as city; default: all rows")
    p.add_argument("--categories", default="", help="comma-separated words that a category must contain")
    p.add_argument("--pages", help="Parquet table of pages (domain, url, html)")
    p.add_argument("--responses", help="Parquet table of provider answers (domain, body)")
    p.add_argument("--response-form", default="a", choices=("a", "b", "c"))
    p.add_argument("--cache", help="Parquet table of earlier results")
    p.add_argument("--skip-cached", action="store_true")
    p.add_argument("--mx", help="Parquet table of mail hosts (domain, has_mx, hosts)")
    p.add_argument("--probes", help="Parquet table of mailbox probes (email, host, code)")
    p.add_argument("--max-pages", type=int, default=5)
    p.add_argument("--quick", action="store_true", help="two pages a site, no verification, slim export only")
    p.add_argument("--year", type=int, default=datetime.now(timezone.utc).year, help="the year to which ages are counted")
    p.add_argument("--checkpoints", help="folder for checkpoints")
    p.add_argument("--resume", action="store_true")
    p.add_argument("--slim-only", action="store_true", help="slim export of the newest result, or of --from-file")
    p.add_argument("--verify-only", action="store_true", help="verify the mails of --from-file")
    p.add_argument("--from-file")
    p.add_argument("--email-column", default="email")
    return p


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    spark = session(a.master)
    if a.slim_only:
        path = a.from_file or source.latest(spark, a.output)
        if not path:
            print("there is no earlier result")
            return 1
        print(sinks.write_csv(sinks.slim(source.read_strings(spark, path)), sinks.slim_path(path)))
        return 0
    if a.verify_only:
        if not (a.from_file and a.mx):
            print("--verify-only needs --from-file and --mx")
            return 1
        rows = verify.verify(source.read_strings(spark, a.from_file), spark.read.parquet(a.mx), spark.read.parquet(a.probes) if a.probes else None, a.email_column).drop("email_domain", "has_mx")
        print(sinks.write_csv(rows, a.from_file.removesuffix(".csv") + "_verified.csv"))
        for r in verify.status_counts(rows).orderBy("verification_status").collect():
            print(r[0], r[1])
        return 0
    if not a.input:
        print("--input is missing")
        return 1
    o = pipeline.Options(dedupe=not a.skip_dedupe, fuzzy=not a.no_fuzzy, block=a.block, categories=a.categories, pages=a.pages, responses=a.responses, response_form=a.response_form, cache=a.cache, skip_cached=a.skip_cached, mx=a.mx, probes=a.probes, max_pages=a.max_pages, quick=a.quick, year=a.year, checkpoints=a.checkpoints, resume=a.resume)
    for kind, path in pipeline.run(spark, a.input, a.output, datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S"), o).items():
        print(kind, path)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
