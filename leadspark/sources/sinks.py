"""Files that come out: CSV with a byte-order mark, the slim export, search queries, a workbook if an engine is there, the report."""

from __future__ import annotations

import uuid
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import first_filled, is_person, person_name, safe_int, split_name, valid_email
from ..schema import SLIM
from ..vocab import SEARCHES

BOM = b"\xef\xbb\xbf"


def _fs(df: DataFrame, path: str):
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(conf)


def write_csv(df: DataFrame, path: str, bom: bool = True) -> str:
    """One CSV file at path, in UTF-8, with a byte-order mark. The parts are written in parallel and joined file by file on the driver's
    side as streams, so that no part needs to fit anywhere."""
    tmp = f"{path}.parts-{uuid.uuid4().hex[:8]}"
    flat = df.select(*[F.array_join(F.col(f"`{c}`").cast("array<string>"), ", ").alias(c) if t.startswith("array") else F.col(f"`{c}`") for c, t in df.dtypes])
    flat.write.csv(tmp, header=False, quote='"', escape='"', emptyValue="", nullValue="")
    jvm, target, fs = _fs(df, path)
    out = fs.create(target, True)
    try:
        header = ",".join('"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n') else c for c in df.columns) + "\n"
        out.write((BOM if bom else b"") + header.encode())
        for s in sorted(fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{tmp}/part-*")) or [], key=lambda s: s.getPath().getName()):
            src = fs.open(s.getPath())
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(src, out, 65536, False)
            src.close()
    finally:
        out.close()
        fs.delete(jvm.org.apache.hadoop.fs.Path(tmp), True)
    return path


def write_text(df: DataFrame, text: str, path: str) -> str:
    """A small text file, such as the report."""
    _, target, fs = _fs(df, path)
    out = fs.create(target, True)
    out.write(text.encode())
    out.close()
    return path


def for_workbook(c: Column) -> Column:
    """A cell that a workbook accepts: no NUL, blanks for other control characters, at most 32,760 characters."""
    return F.left(F.regexp_replace(F.regexp_replace(c, r"\x00", ""), r"[\x01-\x08\x0b\x0c\x0e-\x1f]", " "), F.lit(32_760))


def write_workbook(df: DataFrame, path: str, most_rows: int = 1_000_000) -> str | None:
    """A workbook, if pandas has an engine for it and the rows fit a sheet; else None. The limit is that of the file format."""
    try:
        import openpyxl  # noqa: F401
    except ImportError:
        return None
    if df.limit(most_rows + 1).count() > most_rows:
        return None
    df.select(*[for_workbook(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes]).toPandas().to_excel(path, index=False)
    return path


def slim(df: DataFrame) -> DataFrame:
    """The slim export: eleven columns, '' where nothing is known, whole numbers as such."""
    have = set(df.columns)
    pick = lambda *cs: first_filled(*[c for c in cs if c in have]) if have & set(cs) else F.lit("")
    mails = [c for c in ("enriched_contact_email", "email_raw", "enriched_emails", "legal_email") if c in have]
    mail = F.coalesce(*[F.when(valid_email(F.substring_index(F.lower(F.trim(F.col(c))), ",", 1)), F.substring_index(F.lower(F.trim(F.col(c))), ",", 1)) for c in mails], F.lit("")) if mails else F.lit("")
    who = person_name(pick("decision_maker_name", "legal_owner_name", "enriched_contact_name"))
    name = split_name(F.when(is_person(who), who).otherwise(F.lit("")))
    number = lambda *cs: F.coalesce(*[safe_int(c).cast("string") for c in cs if c in have], F.lit("")) if have & set(cs) else F.lit("")
    made = {
        "companyName": pick("enriched_company_name", "business_name"), "email": mail, "website": pick("website_normalized", "website_raw", "website_domain"), "phone": pick("phone_e164", "phone_raw"), "firstName": name["first"], "lastName": name["last"],
        "location": pick("address", "city"), "rating": pick("rating_normalized", "rating"), "reviewsCount": number("reviews_count_normalized", "reviews_count"), "jobTitle": F.lit(""), "department": F.lit(""),
    }
    return df.select(*[made[c].alias(c) for c in SLIM])


def searches(df: DataFrame) -> DataFrame:
    """Search queries about each named lead: eleven, and two more where town and category are known."""
    name = F.regexp_replace(F.trim(F.col("business_name")), r'^"+|"+$', "")
    phone = "phone_e164" if "phone_e164" in df.columns else "phone_raw"
    out = [F.col("business_name"), F.col("category"), F.col("city"), F.col("website_domain"), F.col(phone).alias("phone")]
    for key, template in SEARCHES.items():
        before, after = template.split("{0}", 1)
        out.append(F.concat(F.lit(before), name, F.lit(after)).alias(key))
    out.append(F.when(F.col("city") != "", F.concat(F.lit('"'), name, F.lit('" "'), F.col("city"), F.lit('"'))).alias("company_location"))
    out.append(F.when(F.col("category") != "", F.concat(F.lit('"'), name, F.lit('" '), F.col("category"))).alias("company_industry"))
    return df.where("business_name is not null and business_name <> ''").select(*out)


def slim_path(source: str) -> str:
    """Where the slim export of a file goes: beside it, slim_final_ for cleaned_enriched_, else _slim at its end."""
    p = PurePosixPath(source)
    return str(p.with_name(p.name.replace("cleaned_enriched_", "slim_final_") if "cleaned_enriched_" in p.name else f"{p.stem}_slim{p.suffix}"))
