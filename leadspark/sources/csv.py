"""CSV exports of any encoding, delimiter and headers, read into one schema."""

from __future__ import annotations

import csv
import logging
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LEAD_RAW
from ..vocab import HEADERS, NA_TOKENS

log = logging.getLogger(__name__)


def _head(spark: SparkSession, path: str, n: int) -> bytes:
    """The first n bytes of a file on any file system that the session knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    s = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(spark._jvm.org.apache.commons.io.input.BoundedInputStream(s, n)))
    finally:
        s.close()


def detect_encoding(head: bytes, cut_off: bool = False) -> str:
    """UTF-16 and UTF-8 by their marks, UTF-8 if the bytes are (but for a last character, if they are cut off), else Latin-1."""
    for mark, name in ((b"\xff\xfe", "UTF-16"), (b"\xfe\xff", "UTF-16"), (b"\xef\xbb\xbf", "UTF-8")):
        if head.startswith(mark):
            return name
    for cut in range(4 if cut_off else 1):
        try:
            head[: len(head) - cut].decode("utf-8")
            return "UTF-8"
        except UnicodeDecodeError:
            continue
    return "ISO-8859-1"


def detect_delimiter(text: str) -> str:
    """The delimiter that the standard sniffer finds in the first 8192 characters, else a comma."""
    try:
        return csv.Sniffer().sniff(text[:8192], delimiters=",;\t|").delimiter if text.strip() else ","
    except csv.Error:
        return ","


def read_csv(spark: SparkSession, path: str) -> tuple[DataFrame, str, str]:
    """(rows, encoding, delimiter): all columns as strings, missing-value tokens as null. Rows with too many fields are left out,
    rows with too few are filled with nulls."""
    head = _head(spark, path, 100_000)
    encoding = detect_encoding(head, len(head) == 100_000)
    text = head.decode("utf-8-sig" if encoding == "UTF-8" else encoding, errors="replace")
    sep = detect_delimiter(text)
    names = next(csv.reader(text.splitlines(), delimiter=sep), [])
    names = [n.strip() or f"_c{k}" for k, n in enumerate(names)]
    seen: dict[str, int] = {}
    unique = []
    for n in names:  # a header may occur twice, in any case
        seen[n.lower()] = seen.get(n.lower(), 0) + 1
        unique.append(n if seen[n.lower()] == 1 else f"{n}.{seen[n.lower()] - 1}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in unique] + [T.StructField("_more", T.StringType()), T.StructField("_broken", T.StringType())])
    df = spark.read.csv(path, schema=schema, sep=sep, encoding=encoding, header=True, multiLine=True, quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_broken", enforceSchema=True, nullValue="\x00", emptyValue="")
    # one field more than the header has: such rows are malformed, as are all with a record beyond it
    df = df.where(F.col("_more").isNull())
    return df.select(*[F.when(~F.col(f"`{n}`").isin(*NA_TOKENS), F.col(f"`{n}`")).alias(n) for n in unique]), encoding, sep


def map_columns(columns: list[str]) -> dict[str, str]:
    """canonical column -> file column. Canonical columns in their order take the first unused file column that is a synonym."""
    used: set[str] = set()
    out = {}
    for canonical, synonyms in HEADERS.items():
        for c in columns:
            if c not in used and c.lower().strip() in synonyms:
                out[canonical] = c
                used.add(c)
                break
    return out


def canonical(df: DataFrame, source_file: str) -> DataFrame:
    """df in the columns of LEAD_RAW but source_row_id; those that the file lacks are null. numbered() counts the rows."""
    found = map_columns(df.columns)
    return df.select(*[(F.col(f"`{found[f.name]}`") if f.name in found else F.lit(None)).cast("string").alias(f.name) for f in LEAD_RAW.fields[:12]], F.lit(source_file).alias("source_file"))


def numbered(df: DataFrame, name: str = "source_row_id") -> DataFrame:
    """df with its rows counted from 0 in the order in which they are read."""
    marked = df.withColumns({"_part": F.spark_partition_id(), "_mark": F.monotonically_increasing_id()})
    # one row per partition: how many rows are before it
    counts = marked.groupBy("_part").agg(F.count("*").alias("n"))
    before = counts.select("_part", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    # the mark's low 33 bits count within the partition
    return marked.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_mark").bitwiseAND(F.lit(2**33 - 1))).drop("_part", "_mark", "_before")


def list_csvs(spark: SparkSession, folder: str) -> list[str]:
    """The paths of a folder's *.csv files, sorted by name."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.csv")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(s.getPath().toString() for s in (found or []))


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    """All CSV files of a folder in the columns of LEAD_RAW, with row ids over all of them. Files that cannot be read are logged and
    passed over; a folder without a readable file is an error."""
    parts = []
    for path in list_csvs(spark, folder):
        try:
            df, _, _ = read_csv(spark, path)
            parts.append(canonical(df, Path(path).name))
        except Exception as e:  # noqa: BLE001 - any unreadable file is passed over
            log.warning("%s was passed over: %s", path, e)
    if not parts:
        raise FileNotFoundError(f"no readable CSV file in {folder}")
    return numbered(merge(parts))


def merge(parts: list[DataFrame]) -> DataFrame:
    """The union of DataFrames by column name; columns that one lacks are null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def latest(spark: SparkSession, folder: str, pattern: str = "cleaned_enriched_*.csv") -> str | None:
    """The path of the folder's newest file of a pattern."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    return max(((s.getModificationTime(), s.getPath().toString()) for s in found), default=(0, None))[1]


def read_strings(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file as strings without any missing-value handling: empty cells stay ''."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, quote='"', escape='"', nullValue="\x00", emptyValue="").fillna("")
