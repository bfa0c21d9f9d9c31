"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import gc
import re
import tempfile
import unicodedata
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Texts people type where there is nothing to say (compared trimmed and in lower case).
MISSING_TEXTS = (
    "?", "-", "--", "---", ".", "..", "...", "0", "00000", "x", "xx", "xxx", "n/a", "na", "n.a.", "none", "null", "nil", "nan",
    "unknown", "not known", "not available", "not applicable", "to be filled", "tbd", "tba", "todo", "missing", "empty", "(empty)", "no phone", "no address",
    "no name", "no website", "keine", "keiner", "kein", "keine angabe", "keine angaben", "kein telefon", "keine adresse", "keine website", "k.a.", "k. a.", "ka",
    "n.n.", "nn", "nicht bekannt", "unbekannt", "nicht verfügbar", "nicht vorhanden", "(leer)", "leer", "entfällt", "inconnu", "aucun", "aucune", "néant", "non disponible",
    "s/n", "s/d", "n/d", "n.d.", "sin datos", "no disponible", "desconocido", "ninguno", "ninguna", "non disponibile", "sconosciuto", "nessuno", "sem dados",
    "desconhecido", "nenhum", "niet beschikbaar", "onbekend", "geen", "n.v.t.", "n/v", "brak", "brak danych", "nieznany", "(please fill in)", "website", "http", "https", "www", "example", "call first",
)


#: The characters of (?U)\s in Java's patterns.
_WHITE = "\t\n\v\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _stripped(c: Column) -> Column:
    """A text without blanks of any kind at its ends."""
    return F.btrim(c, F.lit(_WHITE))


def missing(c: Column | str) -> Column:
    """True where a text is null, blank, or merely stands for "nothing here"."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.lower(_stripped(c))
    return c.isNull() | (t == "") | t.isin(*MISSING_TEXTS)


def is_missing(s: str | None) -> bool:
    """Python twin of :func:`missing`."""
    return s is None or not (t := s.strip().lower()) or t in MISSING_SET


MISSING_SET = frozenset(MISSING_TEXTS)


def usable_phone(c: Column | str) -> Column:
    """The E.164 text, or null where it is missing: no +, too short, or one digit repeated after the calling code."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.regexp_replace(c, r"(?U)\s+", "")
    return F.when(t.rlike(r"^\+[0-9]{8,15}$") & ~t.rlike(r"^\+[0-9]{0,3}?([0-9])\1{7,}$"), t)


def usable_domain(c: Column | str) -> Column:
    """The lower-case host name, or null where it is missing or no host name."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.lower(_stripped(c))
    return F.when(~missing(c) & t.rlike(r"^[^\s.@/]+(\.[^\s.@/]+)+$"), t)


_FOLDS = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ı": "i", "ŀ": "l", "ĳ": "ij", "ﬁ": "fi", "ﬂ": "fl"}


_ACCENTS = {ord(c): unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode() for c in map(chr, range(0xC0, 0x180)) if c not in "×÷"} | {ord(k): v for k, v in _FOLDS.items()}


def plain(s: str) -> str:
    """Lower case without accents."""
    s = s.lower()
    if not s.isascii():
        s = s.translate(_ACCENTS)
        if not s.isascii():
            s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    return s


@lru_cache(200_000)
def fold(s: str) -> str:
    """plain, and ae, oe and ue written for umlauts become a, o and u, so that both spellings agree."""
    s = plain(s)
    return s.replace("ae", "a").replace("oe", "o").replace("ue", "u")


WORD = re.compile(r"[^\W_]+")


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance (a true metric), or most + 1 where it is larger. Myers' bit-parallel recurrence."""
    if a == b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    m = len(a)
    if len(b) - m > most:
        return most + 1
    if not m:
        return len(b)
    peq: dict[str, int] = {}
    for i, c in enumerate(a):
        peq[c] = peq.get(c, 0) | 1 << i
    mask, last = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    left = len(b)
    for c in b:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        left -= 1
        if score - left > most:
            return most + 1
        ph = (ph << 1 | 1) & mask
        mh = (mh << 1) & mask
        pv = mh | ~(xv | ph) & mask
        mv = ph & xv
    return score


_BITS = {c: (1 << 2 * i, 2 << 2 * i) for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")}


@lru_cache(200_000)
def letters(s: str) -> int:
    """Bits of which an edit changes two at most and a swap none: the first and the second of each letter, the kinds of other characters."""
    got = 0
    for c in s:
        one, two = _BITS.get(c) or (1 << 52 + ord(c) % 12,) * 2
        got |= two if got & one else one
    return got


def typing_distance(a: str, b: str, most: int) -> int:
    """As edit_distance, but two neighbours typed in the wrong order are one mistake (optimal string alignment). What their letters put out
    of reach is left at once; the rest by Hyyrö's bit-parallel recurrence between the common beginning and end."""
    if a == b:
        return 0
    n, m = len(a), len(b)
    if abs(n - m) > most or (letters(a) ^ letters(b)).bit_count() > 2 * most:
        return most + 1
    i, k = 0, min(n, m)
    while i < k and a[i] == b[i]:
        i += 1
    j, k = 0, k - i
    while j < k and a[n - 1 - j] == b[m - 1 - j]:
        j += 1
    a, b = a[i : n - j], b[i : m - j]
    n, m = len(a), len(b)
    if not n or not m:
        return n + m
    if n == m == 1 or n == m == 2 and a[0] == b[1] and a[1] == b[0]:
        return 1
    if most < 2 or n < 3 and m < 3:
        return min(2, most + 1)
    peq: dict[str, int] = {}
    for i, c in enumerate(a):
        peq[c] = peq.get(c, 0) | 1 << i
    mask, last = (1 << n) - 1, 1 << (n - 1)
    pv, mv, d0, eq, score, left = mask, 0, 0, 0, n, m
    for c in b:
        before, eq = eq, peq.get(c, 0)
        d0 = ((~d0 & eq) << 1 & before | ((eq & pv) + pv ^ pv) | eq | mv) & mask
        ph = mv | ~(d0 | pv) & mask
        mh = d0 & pv
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        left -= 1
        if score - left > most:
            return most + 1
        ph = (ph << 1 | 1) & mask
        pv = (mh << 1 | ~(d0 | ph)) & mask
        mv = d0 & ph
    return min(score, most + 1)


def segment_keys(s: str, most: int) -> list[str]:
    """Keys of s such that any text within `most` edits has one of them among its segment_probes: s is cut into most + 1 segments."""
    n = len(s)
    return [f"{n}|{k}|{s[n * k // (most + 1) : n * (k + 1) // (most + 1)]}" for k in range(most + 1)]


def segment_probes(s: str, most: int) -> list[str]:
    """Where the segments of a text within `most` edits can stand in s. The first segment k up to whose end there are at most k edits
    has none of its own and exactly k before it, so it is shifted by at most k, and by at most most - k seen from the end."""
    out = {}
    for n in range(max(0, len(s) - most), len(s) + most + 1):
        for k in range(most + 1):
            i, j = n * k // (most + 1), n * (k + 1) // (most + 1)
            for x in range(max(-k, len(s) - n - most + k, -i), min(k, len(s) - n + most - k, len(s) - j) + 1):
                out[f"{n}|{k}|{s[i + x : j + x]}"] = None
    return list(out)


def calm() -> None:
    """Python's collector looks for cycles less often, and no more at what earlier tasks kept: that are texts and numbers in caches, which it
    would walk at the end of every task."""
    gc.set_threshold(100_000, 50, 1000)
    gc.freeze()


def map_batches(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str | T.StructType) -> DataFrame:
    """mapInArrow over lists: fn gets a batch's columns as lists and returns the result's."""
    out = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        calm()
        for b in batches:
            if b.num_rows:
                got = fn({n: c.to_pylist() for n, c in zip(b.schema.names, b.columns)})
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def map_partitions(df: DataFrame, fn: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]], schema: str | T.StructType) -> DataFrame:
    """As map_batches, but fn sees all batches of a partition, one after another."""
    out = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        calm()
        lists = ({n: c.to_pylist() for n, c in zip(b.schema.names, b.columns)} for b in batches if b.num_rows)
        for got in fn(lists):
            yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if at:
        return at
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"file://{tempfile.gettempdir()}/leadspark-checkpoints"  # one machine: tests


_WRITTEN: list[tuple[SparkSession, str]] = []


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the folder of spark.checkpoint.dir, which all executors share, and read it back: its lineage is cut, and
    later steps read only the columns they need. The tables are removed when Python ends."""
    spark = df.sparkSession
    path = f"{_shared_folder(spark).rstrip('/')}/leadspark/{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append((spark, path))
    del df
    gc.collect()
    spark._jvm.System.gc()  # Spark removes the shuffle files of what can no longer be reached
    out = spark.read.schema(schema).parquet(path)
    out._table = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the table of a DataFrame that cut() returned, once what follows from it has been written itself."""
    path = getattr(df, "_table", None)
    if path:
        p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _remove() -> None:
    for spark, path in _WRITTEN:
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session may be gone
            return


def broadcastable(df: DataFrame, most_rows: int) -> bool:
    """Whether df has at most most_rows rows; counts no further."""
    return df.limit(most_rows + 1).count() <= most_rows
