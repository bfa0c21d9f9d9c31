"""Problem 1: one place, many ways to write its address.

Method: addresses are taken apart (street, house number, town, whatever the order); rewrites of abbreviations and spellings are mined
from pairs of addresses that agree elsewhere (town, house number, and a phone or domain), kept if they are statistically significant,
applied, and mined again until no new rewrite appears. Two rows are at one place if street, number and town agree after that.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema

from .common import calm, cut, discard, edit_distance, fold, is_missing, letters, map_batches, map_partitions, missing, typing_distance, usable_domain, usable_phone
from .encoding import _SUSPECT, repaired

# Names and codes of the countries, folded.
COUNTRIES = ("deutschland", "germany", "allemagne", "osterreich", "austria", "schweiz", "suisse", "switzerland", "france", "frankreich", "espana", "spain", "spanien", "italia", "italy", "italien", "portugal", "nederland", "netherlands", "niederlande", "polska", "poland", "polen")
_CODES = r"de|fr|es|it|pt|nl|pl|at|ch"
# What tells floors, units, buildings and keepers apart from places. # stands for a number, @ for a number or letter.
UNITS = (
    "c/o *", "unit @", "int @", "interno @", "loja @", "lok @", "lokal @", "local @", "scala @", "wejscie @", "bat @", "batiment @", "apt @", "app @", "apartment @", "suite @", "whg @", "wohnung @",
    "esc @", "escalera @", "puerta @", "porta @", "stiege @", "room @", "floor @", "level @", "appt @", "box @", "bus @", "oficina @", "sala @", "bloque @", "bloco @", "gebaude @", "building @", "haus @", "aufgang @",
    "# stock links", "# stock rechts", "# stock mitte", "# stock", "# og", "# ug", "# etage", "# floor", "# izq", "# dcha", "# esq", "# dto", "# piso", "# andar", "# verdieping", "# pietro", "# piano", "# hg",
    "hinterhaus", "vorderhaus", "seitenflugel", "eingang hof", "eingang", "achterhuis", "porte gauche", "porte droite", "piano terra", "parter", "bajo", "bajos", "bg", "r/c", "rdc", "rez de chaussee", "erdgeschoss", "souterrain", "entresol", "eg", "dg", "za nord", "za sud", "zi nord", "zi sud", "poligono industrial",
)


def _unit(u: str) -> str:
    u = re.escape(u).replace(r"\ ", r"\.?\s*").replace(r"\#", "#")
    return u.replace("#", r"\d{1,2}\s*(?:\.|o|a|e|er|eme|te|ste|st|nd|rd|th)?").replace("@", r"(?:\d{1,3}\s?[a-z]?|[a-z])").replace(r"\*", r"[^\W\d_]+")


_UNITS = re.compile(r"(?<![\w/])(?:" + "|".join(_unit(u) for u in UNITS) + r")\.?(?![\w/])")
# the word by which each unit is known, as one pattern that shares beginnings
_UNIT_WORDS = re.compile(r"(?<![^\W\d_])(?:" + "|".join(f"{c}(?:{'|'.join(sorted({re.escape(w[1:]) for w in ws}))})" for c, ws in sorted({c: {w for u in UNITS for w in [next(x for x in u.split() if x not in "#@*")] if w[0] == c} for c in {next(x for x in u.split() if x not in "#@*")[0] for u in UNITS}}.items())) + r")(?![^\W_])")
# two letters behind four digits belong to the postcode
_COUNTRY = re.compile(r"[\s,;|/-]+(?:(" + "|".join(COUNTRIES) + r"|espa[?�]a)|(?<!\d{4} )(?:" + _CODES + r"))[\s.,;|/-]*$")
_PREFIX = re.compile(r"(?<!\w)(?:d|f|e|i|p|a|ch|" + _CODES + r")-(?=\d{4,5}(?!\d))")
_BROKEN_RANGE = re.compile(r"(?<=\d)\s?(?:[�?]+|[\x80-\x9f]+|a[\x80-\x9f]+)\s?(?=\d)")
_POSTCODES = (
    re.compile(r"(?<![\w-])(\d{5})(?![\w-])"),
    re.compile(r"(?<![\w-])(\d{4} ?[a-z]{2})(?![\w-])"),
    re.compile(r"(?<![\w-])(\d{4}[ -]\d{3})(?![\w-])"),
    re.compile(r"(?<![\w-])(\d{2}[ -]\d{3})(?![\w-])"),
)
_NUMBER = re.compile(r"(?<![^\W_])(?:(?:nr|no|num|numero|n|hausnr|hnr)\b\.?\s*)?(\d{1,4})(?:\s?([a-h])(?![\w./])|([a-z])(?![\w/]))?(?:\s?[-/]\s?(\d{1,4})(?:\s?([a-h])(?![\w./])|([a-z])(?![\w/]))?(?!\w))?(?![\w])")
_SEPARATOR = re.compile(r"[,;|\n]|\s[-/]\s|/(?=\s)|(?<=\s)/")
_WORD = re.compile(r"[^\W\d_�?]+(?:[�?]+[^\W\d_]*)*|[�?]+[^\W\d_]+")
_DASHES = str.maketrans({c: "-" for c in "–—−‐‑‒―"} | {"№": "no ", "\t": " ", "\xa0": " ", "·": "|", "•": "|", '"': " "})


def _postcode(t: str) -> tuple[str, tuple[int, int]] | None:
    for k, p in enumerate(_POSTCODES):
        found = list(p.finditer(t))
        for m in found if k else found[-1:]:
            code = m[1]
            if k >= 2:
                a, b = re.split(r"[ -]", code)
                if b[0] != "0" and 0 < int(b) - int(a) <= 12 and k == 3:
                    continue  # a range of house numbers
                if k == 3 and " " in code and b[0] != "0" and not 100 <= int(b):
                    continue
            return re.sub(r"[ -]", "", code), m.span()
    return None


@lru_cache(50_000)
def _town_like(word: str, town: str) -> bool:
    return word == town or len(town) > 4 and typing_distance(word, town, 2 if len(town) > 6 else 1) <= (2 if len(town) > 6 else 1)


_BLANKS = re.compile(r"  +")
@lru_cache(50_000)
def _home(city: str | None) -> tuple[str, int]:
    """The town's column, folded and in one word, and of how many words."""
    words = [] if is_missing(city) else _WORD.findall(fold(repaired(city)))
    return "".join(words), max(1, len(words))


def parse(address: str | None, city: str | None) -> tuple[str, str, str, str] | None:
    """(street, number, town, postcode), folded; parts that are not there are empty. None for a missing address.

    street is written in one word, so that compounds agree however they are split. The town is the address's own, else the column's."""
    if is_missing(address):
        return None
    t = fold.__wrapped__(repaired.__wrapped__(address))
    home, home_words = _home(city)
    t = _BLANKS.sub(" ", t.translate(_DASHES))
    for _ in range(2):
        t = _COUNTRY.sub("", t)
    t = _BROKEN_RANGE.sub("-", _PREFIX.sub("", t))
    if _UNIT_WORDS.search(t):
        t = _UNITS.sub(",", t)
    code, town = "", ""
    if got := _postcode(t):
        code, (i, j) = got
        t = t[:i] + "\x01" + t[j:]
    number = ""
    if m := _NUMBER.search(t):
        a, b = m[1].lstrip("0") + (m[2] or m[3] or ""), m[4] and m[4].lstrip("0") + (m[5] or m[6] or "")
        number = f"{a}-{b}" if b else a
        t = t[: m.start()] + "\x02" + t[m.end() :]
    parts = [p for p in _SEPARATOR.split(t)]
    words = [_WORD.findall(p) for p in parts]
    if home:  # the town of the column, wherever it stands
        best = None
        for x, ws in enumerate(words):
            for y in range(len(ws) - home_words + 1):
                if _town_like("".join(ws[y : y + home_words]), home):
                    best = (x, y)
                    if "\x01" in parts[x]:
                        break
            else:
                continue
            break
        if best:
            x, y = best
            town = home
            del words[x][y : y + home_words]
    if not town:
        for x, p in enumerate(parts):
            if "\x01" in p:
                before, _, after = p.partition("\x01")
                one, two = _WORD.findall(before), _WORD.findall(after)
                if len(one) == 1 and two and "\x02" in after and "\x02" not in before:
                    town, words[x] = one[0], two
                elif len(one) > 2 and not two and "\x02" not in before and not any(words[y] for y in range(len(words)) if y != x):
                    town, words[x] = one[-1], one[:-1]
                elif one and two and "\x02" not in p and (len(one) == 1) != (len(two) == 1):
                    # the street on the other side of the postcode, without a separator
                    town, words[x] = ("".join(one), two) if len(one) == 1 else ("".join(two), one)
                elif ws := _WORD.findall(after.split("\x02")[0]):
                    town, words[x] = "".join(ws[:1] if "\x02" in p or len(ws) > 2 and not any(words[:x] + words[x + 1 :]) else ws), (_WORD.findall(before) + (ws[1:] if "\x02" in p or len(ws) > 2 and not any(words[:x] + words[x + 1 :]) else []) + _WORD.findall(after.partition("\x02")[2]))
                elif "\x02" not in before and (ws := _WORD.findall(before)) and any(words[y] for y in range(len(words)) if y != x):
                    town, words[x] = "".join(ws), []
                elif "\x02" in before and (ws := _WORD.findall(before.partition("\x02")[2])):
                    town, words[x] = "".join(ws), _WORD.findall(before.partition("\x02")[0])
                break
        else:
            full = [x for x in range(len(parts)) if words[x]]
            at = next((x for x, p in enumerate(parts) if "\x02" in p), None)
            if len(full) == 1 and at == full[0]:
                before, _, after = parts[at].partition("\x02")
                a, b = _WORD.findall(before), _WORD.findall(after)
                if a and b:
                    town, words[at] = "".join(b), a
                elif len(b) > 2:
                    town, words[at] = b[-1], b[:-1]
            elif len(full) > 1 and at is not None:
                if words[at]:
                    x = [x for x in full if x != at][-1]
                else:  # the number stands alone: the street is beside it, and rather of several words
                    beside = [x for x in (at - 1, at + 1) if x in full]
                    road = max(beside, key=lambda x: (len(words[x]) > 1, x < at), default=full[0])
                    x = [x for x in full if x != road][-1]
                town, words[x] = "".join(words[x]), []
    if town and not any(words):
        words, town = [[town]], home
    street = "".join(w for ws in words for w in ws if w not in COUNTRIES)
    return street, number, town or home, code


# The plain forms: parts between separators, one of which is street and number in either order, the others postcode, town, both, a unit or
# a country. Parts but for house numbers are met again and again, so what each says is kept; what is in no plain form goes to parse().
_BETWEEN = re.compile(r"\s*(?:[,;|\n]|\s[-/]\s)[\s,;|]*")
_ONE = r"\d{1,3}(?: ?[a-hA-H](?![\w./]))?"
_HOUSE = rf"{_ONE}(?: ?[-/–] ?{_ONE})?"
_ROAD = re.compile(rf"(?:(\D{{2,}}?) ?(?<![^\W_])(?:(?i:nr|no|num|numero|n|hausnr|hnr)\b\.? ?)?({_HOUSE})|(?:(?i:nr|no|num|numero|n|hausnr|hnr)\b\.? ?)?({_HOUSE})(?: (\D{{2,}}))?)$")
_CODE_RANGE = re.compile(r"\d\d[a-h]?-\d{3}")
_CODE = r"(?:(?:[defipa]|ch|de|fr|es|it|pt|nl|pl|at)-(?=\d{4}))?(\d{5}|\d{4} ?[a-z]{2}(?![a-z])|\d{4}[- ]\d{3}|\d{2}[- ]\d{3})"
_TOWN = r"([a-z][a-z .'-]*)"
_WHERE = re.compile(rf"(?:{_CODE}(?: {_TOWN})?|{_TOWN} {_CODE})$")
_COUNTRY_NAMES = frozenset((*COUNTRIES, *_CODES.split("|")))
_NUMBER_WORDS = frozenset(("nr", "no", "num", "numero", "n", "hausnr", "hnr"))
_RANGE = str.maketrans("/–", "--")
_ORDINAL = re.compile("(?<=[A-Za-z])[ºª]")
_LEADING = re.compile(r"(?<!\d)0+(?=\d)")


@lru_cache(100_000)
def _said(part: str) -> tuple | None:
    """What a part without house number says: (kind, code, words, letters); None where it is in no plain form. Kinds: nothing (a unit, or no
    words), country, code (with words or without), words."""
    part = _ORDINAL.sub(lambda m: "o" if m[0] == "º" else "a", part)
    if _SUSPECT.search(part):
        return None
    t = _BLANKS.sub(" ", fold.__wrapped__(part).translate(_DASHES)).strip(" .")
    if t in _COUNTRY_NAMES:
        return "country", "", 0, ""
    if _UNIT_WORDS.search(t):
        t = _UNITS.sub(",", t).strip(" ,.")
        if t and _UNIT_WORDS.search(t):
            return None
    if not t:
        return "nothing", "", 0, ""
    code = ""
    if m := _WHERE.match(t):
        code, t = m[1] or m[4], m[2] or m[3] or ""
        if code[2:3] in ("-", " ") and code[3] != "0" and int(code[3:]) - int(code[:2]) <= 12:
            return None  # a range of house numbers
    words = _WORD.findall(t)
    if not code and (not words or any(c.isdigit() for c in t)) or any(w in COUNTRIES for w in words):
        return None
    return "code" if code else "words", code.replace(" ", "").replace("-", ""), len(words), "".join(words)


def plain_form(address: str, city: str | None) -> tuple[str, str, str, str] | None:
    """What parse() makes of an address in a plain form; None where only parse() can tell."""
    house = code = town = street = ""
    towns = last = first = 0
    loose: list[tuple] = []
    for part in _BETWEEN.split(_BLANKS.sub(" ", address).strip()):
        m = _ROAD.match(part)
        if m and not _CODE_RANGE.match(number := (m[2] or m[3]).replace(" ", "").translate(_RANGE).lower()):
            if house:
                return None
            house = _LEADING.sub("", number)
            if road := m[1] or m[4]:
                said = _said(road)
                if said is None or said[0] != "words" or said[3] in _NUMBER_WORDS:
                    return None
                street, first = said[3], bool(m[1])
            said = ("road",)
        else:
            said = _said(part)
            if said is None:
                return None
            if said[0] == "code":
                if code:
                    return None
                code, towns, town = said[1:]
            elif said[0] == "words":
                loose.append(said)
        if last and said[0] != "country":
            return None  # a country stands at the end
        last = said[0] == "country"
    if not house or not code and not loose and not first:
        return None
    if not street:  # the number stands alone: the street is the one part of words beside a postcode
        if not code or len(loose) != 1 or not (towns or city):
            return None
        street = loose.pop()[3]
    if loose:
        if towns or len(loose) > 1:
            return None
        towns, town = loose[0][2:]
    home, n = _home(city)
    if home:
        if home in street or towns and (towns != n or not _town_like(town, home)):
            return None
        town = home
    return street, house, town, code


def parsed(df: DataFrame, id: str, address: str, city: str | None, *keep: str) -> DataFrame:
    """The rows of df with a non-missing address: id, the columns of keep, and street, num, town, code. What is kept passes through Python
    as it is, in its Arrow form."""
    at = F.col(city) if city else F.lit(None).cast("string")
    todo = df.where(~missing(address)).select(F.col(id).cast("long").alias("id"), *keep, F.col(address).alias("_raw"), at.alias("_city"))
    n = 1 + len(keep)
    names = ("street", "num", "town", "code")
    schema = T.StructType([*todo.schema.fields[:n], *[T.StructField(k, T.StringType()) for k in names]])
    arrow = to_arrow_schema(schema)

    def run(batches):
        calm()
        for b in batches:
            got = [plain_form(a, c) or parse(a, c) or ("", "", "", "") for a, c in zip(b.column(n).to_pylist(), b.column(n + 1).to_pylist())]
            parts = [pa.array(x, pa.string()) for x in zip(*got)] or [pa.array([], pa.string())] * 4
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(b.columns[:n], arrow)] + parts, schema=arrow)

    return todo.mapInArrow(run, schema)


def _towns(rows: DataFrame) -> DataFrame:
    """rows with each town in its usual spelling: that of most rows with the same postcode; where there is no postcode, the usual
    spelling within two edits."""
    seen = rows.where("town <> ''").groupBy("code", "town").agg(F.count("*").alias("n"))
    usual = seen.where("code <> ''").groupBy("code").agg(F.max_by("town", F.struct("n", "town")).alias("usual"))
    known = usual.select(F.col("usual").alias("known")).distinct()
    odd = seen.where("code = ''").select("town").distinct().join(known, F.col("town") == F.col("known"), "left_anti")
    near = lambda at: odd.withColumn("k", at("town")).join(known.withColumn("k", at("known")), "k").where(F.levenshtein("town", "known", 2) >= 0)
    either = near(lambda c: F.substring(c, 1, 4)).union(near(lambda c: F.concat(F.lit("$"), F.right(F.col(c), F.lit(4)))))
    mended = either.groupBy(F.col("town").alias("was")).agg(F.min_by("known", F.struct(F.levenshtein("town", "known"), "known")).alias("mended"))
    rows = rows.join(usual, "code", "left").join(mended, (F.col("code") == "") & (F.col("town") == F.col("was")), "left")
    return rows.withColumn("town", F.coalesce("usual", "mended", "town")).drop("usual", "mended", "was", "code")


_LOST = re.compile("[?\ufffd]")


def _differences(s: str, t: str) -> list[tuple[str, str, str]]:
    """The rewrites (where, x, y) at the start or end that turn s into t, with more and more context; none where they differ inside."""
    p = 0
    while p < len(s) and p < len(t) and s[p] == t[p]:
        p += 1
    q = 0
    while q < len(s) - p and q < len(t) - p and s[-1 - q] == t[-1 - q]:
        q += 1
    out = []
    if p <= 5 and q >= 4:
        for c in range(min(4, q - 3)):
            x, y = s[: len(s) - q + c], t[: len(t) - q + c]
            if not x or not y:
                x, y = x or y, ""  # what the one leaves out
            if len(x) <= 9 and len(y) <= 10:
                out.append(("start", x, y))
            if not y:
                break
    elif q <= 2 and p >= 4:
        out = [("end", s[p - c :], t[p - c :]) for c in range(1, 5) if len(s) - p + c <= 9 and len(t) - p + c <= 10 and p - c >= 3]
    return out


class Rewrites:
    """The rewrites mined so far."""

    def __init__(self, found: set[tuple[str, str, str]]):
        self.start: dict[str, list[str]] = defaultdict(list)
        self.end: dict[str, list[str]] = defaultdict(list)
        for where, x, y in sorted(found):
            (self.start if where == "start" else self.end)[x].append(y)
        self.known: dict[str, list[str]] = {}

    def of(self, s: str) -> list[str]:
        """s and all that one rewrite at its start and one at its end make of it."""
        if s in self.known:
            return self.known[s]
        first = [s]
        for n in range(min(10, len(s) - 3)):
            first += [y + s[n:] for y in self.start.get(s[:n], ())]
        out = []
        for f in first:
            out.append(f)
            for n in range(1, min(10, len(f) - 3)):
                out += [f[:-n] + y for y in self.end.get(f[-n:], ())]
        if len(self.known) > 100_000:
            self.known.clear()
        out = self.known[s] = list(dict.fromkeys(out))
        return out


#: A rewrite must occur in so many different streets, in such a share of all streets that begin or end so, and pass this level of the
#: log-likelihood ratio against chance (10.83: one in a thousand).
LEAST, SHARE, LEVEL = 3, 0.02, 10.83


def _significant(counts: list[tuple[str, str, str, int]], occurs: dict[tuple[str, str], int]) -> set[tuple[str, str, str]]:
    """The rewrites (where, x, y, different streets) that are significant. occurs: streets that begin or end with each x."""
    by_x, by_y, n = defaultdict(int), defaultdict(int), 0
    for w, x, y, k in counts:
        by_x[w, x] += k
        by_y[w, y] += k
        n += k
    h = lambda *ks: sum(k * math.log(k / sum(ks)) for k in ks if k > 0)
    got = set()
    for w, x, y, k in counts:
        if x != y and k >= SHARE * occurs.get((w, x), 0):
            a, b, c = k, by_x[w, x] - k, by_y[w, y] - k
            d = max(0, n - a - b - c)
            g = 2 * (h(a, b, c, d) - h(a + b, c + d) - h(a + c, b + d))
            if g >= LEVEL and a * n > by_x[w, x] * by_y[w, y]:
                got.add((w, x, y))
    return got


def _nearest(s: str, options: list[str], t: str) -> str:
    """The option with the fewest edits to t (beyond eight all are alike), s rather than others, then the least."""
    best = (edit_distance(s, t, 8), False, s)
    for o in options:
        if o != s and abs(len(o) - len(t)) <= best[0] and (got := (edit_distance(o, t, min(8, best[0])), True, o)) < best:
            best = got
    return best[2]


def mine(rows: DataFrame) -> tuple[set[tuple[str, str, str]], int]:
    """(rewrites, rounds). Evidence: streets of rows that agree in town and house number and in phone or domain, each against the
    street most of them write. Pairs of a group grow with its spellings, not with its rows. What is sent to the driver are counts of
    rewrites seen in three streets or more; their number is bounded by the pieces of at most 10 letters that streets begin or end with."""
    keyed = None
    for k in ("phone", "domain"):
        # 64 bits stand for town, number and key: two groups that met by chance would be mere noise in the counts
        part = rows.where(f"{k} is not null and num <> '' and street <> ''").select(F.xxhash64("town", "num", F.lit(k), k).alias("key"), "street")
        keyed = part if keyed is None else keyed.union(part)
    seen = keyed.groupBy("key", "street").agg(F.count("*").alias("n"))
    w = W.partitionBy("key")
    top = seen.withColumn("top", F.max_by("street", F.struct("n", F.length("street"), "street")).over(w))
    pairs = cut(top.groupBy("street", "top").agg(F.count("*").alias("n")))
    known: set[tuple[str, str, str]] = set()
    rounds = 0
    while True:
        rounds += 1
        now = frozenset(known)

        def diff(b, now=now):
            r, out = Rewrites(set(now)), {"top": [], "where": [], "x": [], "y": []}
            for s, t in zip(b["street"], b["top"]):
                if s == t or t in (options := r.of(s)) or s in r.of(t):
                    continue
                # what is left after the rewrites known so far
                o = _nearest(s, options, t) if now else s
                for d in _differences(o, t) if not _LOST.search(s + t) else ():
                    for k, v in zip(("top", "where", "x", "y"), (t, *d)):
                        out[k].append(v)
            return out

        counted = map_batches(pairs.where("street <> top"), diff, "top string, where string, x string, y string").groupBy("where", "x", "y").agg(F.count_distinct("top").alias("n")).where(F.col("n") >= LEAST).collect()
        ends = frozenset((c["where"], c.x) for c in counted)

        def occurrences(b, starts=frozenset(x for w, x in ends if w == "start"), tails=frozenset(x for w, x in ends if w == "end")):
            where, found = [], []
            for s in b["street"]:
                for n in range(10):
                    if (x := s[:n]) in starts:
                        where.append("start")
                        found.append(x)
                for n in range(1, 10):
                    if (x := s[-n:]) in tails:
                        where.append("end")
                        found.append(x)
            return {"where": where, "x": found}

        occurs = {(o["where"], o.x): o["count"] for o in map_batches(pairs.select("street").distinct(), occurrences, "where string, x string").groupBy("where", "x").count().collect()} if ends else {}
        new = _significant([(c["where"], c.x, c.y, c.n) for c in counted], occurs) - known
        if not new:
            discard(pairs)
            return _simplest(known), rounds
        known |= new


def _simplest(found: set[tuple[str, str, str]]) -> set[tuple[str, str, str]]:
    """found without the rewrites that another one implies with less context."""
    def implied(w: str, x: str, y: str) -> bool:
        return len(x) > 1 and len(y) > 1 and (x[0] == y[0] and (w, x[1:], y[1:]) in found if w == "end" else x[-1] == y[-1] and (w, x[:-1], y[:-1]) in found)

    return {r for r in found if not implied(*r)}


def _limit(n: int) -> int:
    return 1 if n < 8 else 2 if n < 16 else 3


@lru_cache(200_000)
def bigrams(s: str) -> int:
    """Bits for the pairs of neighbours, of which an edit changes four at most and a swap six."""
    got = 0
    for a, b in zip(s, s[1:]):
        got |= 1 << (27 * ord(a) + ord(b)) % 743
    return got


def cluster(streets: list[tuple[str, int, int]], rewrites: Rewrites) -> dict[str, str]:
    """The streets of one town that have one house number: each to the spelling it stands for. streets: (street, rows here, rows in all).

    A street stands for another if rewrites make them one, or if it is a rare spelling within a few typing mistakes of a frequent one:
    seen in all at most a tenth as often, so that streets which merely resemble each other stay apart. Every rare spelling is compared with
    every frequent one of about its length but for those that its letters or pairs of letters put out of reach."""
    order = sorted(streets, key=lambda x: (-x[2], -x[1], x[0]))
    to: dict[str, str] = {}
    index: dict[str, str] = {}
    near: dict[int, list[list]] = {}  # by length and in order of falling counts: none is left out; letters and pairs are read when needed
    later: list[tuple[int, str, str]] = []  # what is not in near yet
    rare = max(0.1 * order[0][2], 2)
    for s, _, g in order:
        options = rewrites.of(s)
        hit = next((index[o] for o in options if o in index), None)
        damaged = "?" in s or "\ufffd" in s
        if hit is None and (near or later) and (g <= rare or damaged):
            for gc, c, o in later:
                near.setdefault(len(o), []).append([gc, None, None, c, o])
            later.clear()
            best: tuple[int, int, str] | None = None
            for o in options:
                n = len(o)
                if n < len(s):
                    continue  # abbreviations resemble each other too easily
                lost = o.count("?") + o.count("\ufffd") if damaged else 0
                floor = 0 if lost else 10 * g if g > (2 if len(s) >= 10 else 1) else g
                reach, mine, pairs = _limit(n), letters(o), bigrams(o)
                for m in range(n - reach - lost, n + reach + lost + 1):
                    here = near.get(m)
                    if not here:
                        continue
                    most = (reach if m >= n else _limit(m)) + lost
                    if best and best[0] < most:
                        most = best[0]
                    for known in here:
                        gc, common, two, c, spelling = known
                        if gc < floor:
                            break
                        if common is None:
                            known[1], known[2] = common, two = letters(spelling), bigrams(spelling)
                        if (mine ^ common).bit_count() <= 2 * most and (pairs ^ two).bit_count() <= 6 * most:
                            d = typing_distance(o, spelling, most)
                            if d <= most and (best is None or (d, -gc, c) < best):
                                best, most = (d, -gc, c), d
            if best:
                hit = to[best[2]]
        to[s] = hit = hit or s
        for o in options:
            index.setdefault(o, hit)
            if (hit == s or g > 2) and len(o) >= len(s):
                later.append((g, s, o))
    return to


def _hashed(c: str | None) -> Column:
    """A key of the mining: 64 bits are enough for evidence."""
    return F.when(F.col(c).isNotNull(), F.xxhash64(c)) if c else F.lit(None).cast("long")


def places(df: DataFrame, id: str, address: str, city: str | None, phone: str | None = None, domain: str | None = None, *keep: str) -> DataFrame:
    """(id, town, num, street, raw_hash, *keep) for each row with a non-missing address: where it is, in one spelling.

    Parts that an address lacks are empty; rows without number or street denote no place and have an empty one. Null, blank and
    missing addresses give no row; repeated rows give a row each; extra columns of df are ignored; texts of any length are read whole."""
    df = df.select(F.col(id).alias("id"), F.col(address).alias("address"), (F.col(city) if city else F.lit(None).cast("string")).alias("city"), _hashed(phone).alias("phone"), _hashed(domain).alias("domain"), F.xxhash64(F.col(address)).alias("raw_hash"), *keep)
    rows = cut(parsed(df, "id", "address", "city", "phone", "domain", "raw_hash", *keep))
    first, rows = rows, cut(_towns(rows))
    discard(first)
    known, _ = mine(rows)
    shared = df.sparkSession.sparkContext.broadcast(frozenset(known))
    # rows delivered again are no further evidence of a spelling
    seen = rows.where("num <> '' and street <> '' and town <> ''").groupBy("town", "num", "street").agg(F.count_distinct("raw_hash").alias("n"))
    overall = seen.groupBy("street").agg(F.sum("n").alias("g"))
    several = F.count("*").over(W.partitionBy("town", "num")) > 1
    groups = seen.join(overall, "street").withColumn("several", several).where("several").drop("several")

    def run(batches):
        r, at, have = Rewrites(set(shared.value)), None, []

        def flush():
            if len(have) > 1:
                return [(*at, s, t) for s, t in cluster(have, r).items() if s != t]
            return []

        for b in batches:
            out = []
            for town, num, street, n, g in zip(b["town"], b["num"], b["street"], b["n"], b["g"]):
                if (town, num) != at:
                    out += flush()
                    at, have = (town, num), []
                have.append((street, n, g))
            yield dict(zip(("town", "num", "street", "usual"), map(list, zip(*out)) if out else ([], [], [], [])))
        out = flush()
        yield dict(zip(("town", "num", "street", "usual"), map(list, zip(*out)) if out else ([], [], [], [])))

    usual = map_partitions(groups, run, "town string, num string, street string, usual string")
    got = rows.join(usual, ["town", "num", "street"], "left").withColumn("street", F.coalesce("usual", "street")).drop("usual")
    return got.select("id", "town", "num", "street", "raw_hash", *keep)


def same_place(df: DataFrame) -> DataFrame:
    """(source_row_id_a, source_row_id_b) of all pairs of ungrouped leads at one place whose addresses are not stored as one string."""
    leads = df.where("duplicate_group_id is null").select("source_row_id", "address", "city", usable_phone("phone_e164").alias("phone"), usable_domain("website_domain").alias("domain"))
    at = places(leads, "source_row_id", "address", "city", "phone", "domain").where("num <> '' and street <> '' and town <> ''").select("id", "town", "num", "street", "raw_hash")
    at = cut(at)
    a, b = at.select(F.col("id").alias("source_row_id_a"), "town", "num", "street", F.col("raw_hash").alias("ha")), at.select(F.col("id").alias("source_row_id_b"), "town", "num", "street", F.col("raw_hash").alias("hb"))
    return a.join(b, ["town", "num", "street"]).where("source_row_id_a < source_row_id_b and ha <> hb").select("source_row_id_a", "source_row_id_b")
