"""Problem 2: variant spellings of names typed by people.

Method: names are blocked by what an organisation has (its place; its phone or domain where a record has no address). Within a block every
two names are compared word by word (order, abbreviations, legal forms, initials, nicknames); in a large block every two words are, by
bit signatures first, and then the names that this makes candidates. Pivots (metric.py) are not used: the comparison is no metric, and it
reaches three typing mistakes a word (up to six edits where letters are swapped), as far as unrelated words of that length often are.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import addresses
from .common import cut, edit_distance, fold, is_missing, letters, map_batches, map_partitions, missing, typing_distance, usable_domain, usable_phone
from .encoding import repaired
from .metric import CELL

# Legal forms at the end of a firm's name, folded, without dots and blanks.
LEGAL = frozenset("gmbh gmbhcokg gmbhundcokg gmbhucokg gmbhetcokg cokg kg ohg ug ek ekfr ag gbr ev sarl eurl sas sasu sa snc srl srls spa sl slu sll sau lda ltda unipessoal unipessoallda bv vof nv cv spzoo spzook sc spj spk sa ltd llc inc plc co gmbhco".split())
# Ornaments that say nothing.
_ORNAMENT = re.compile(r"(?i)[-–—]\s*(?:seit|since|depuis|desde|dal|sinds|od)\s+\d{4}|№\s?\d+|no\.? ?1\b|€\s?\d+|½\s?preis|wer\?\s*wir!|[™®©•\"„“”*#>]|'{2}")
_SMALL = frozenset("and und et y e i u in fam familie famille family der die das the".split())
# Titles, salutations and roles before or after a person's name, folded, without dots.
TITLES = frozenset("dr prof mag ing dipl kfm med herr frau mr mrs ms mme mlle m dhr mevr drs sr sra srta d dna don dona dott dottssa dra eng sig sigra sgra avv pan pani mgr inz inh owner ceo inhaber inhaberin titolare gerant gerante wlasciciel geschaftsfuhrer director managing co".split()) - {"m", "d", "co"}
# Pet names that are neither the beginning nor the end of the name, folded.
PET_NAMES = {
    "resi": "theresa", "lutz": "ludwig", "uschi": "ursula", "gretel": "margarete", "greta": "margarete", "lexi": "alexander", "tilly": "ottilie", "willi": "wilhelm", "willy": "wilhelm", "basti": "sebastian", "hanni": "johanna", "dorti": "dorte", "zia": "lucrezia", "nora": "eleonora", "bert": "lambertus", "varo": "alvaro", "enzo": "vincenzo", "sandro": "alessandro", "hannes": "johannes", "quel": "raquel", "lupe": "guadalupe", "quim": "joaquim", "tilli": "ottilie", "fritz": "friedrich", "gunni": "gunther",
    "paco": "francisco", "pancho": "francisco", "chico": "francisco", "ginette": "genevieve", "sao": "conceicao", "nel": "petronella", "toto": "salvatore", "lola": "dolores", "beppe": "giuseppe", "peppe": "giuseppe", "pino": "giuseppe",
    "quique": "enrique", "mimmo": "domenico", "charo": "rosario", "toninho": "antonio", "tonio": "antonio", "bia": "beatriz", "daan": "daniel", "mien": "wilhelmina", "mina": "wilhelmina", "nacho": "ignacio", "dudu": "eduardo",
    "edu": "eduardo", "nono": "leonor", "checca": "francesca", "kees": "cornelis", "lello": "raffaele", "hanneke": "johanna", "toon": "antonius", "zosia": "zofia", "gerrit": "gerardus", "olek": "aleksander", "kasia": "katarzyna",
    "betje": "elisabeth", "babette": "elisabeth", "lisbeth": "elisabeth", "gosia": "malgorzata", "basia": "barbara", "staszek": "stanislaw", "wojtek": "wojciech", "jozek": "jozef", "ela": "elzbieta", "pepe": "jose", "bill": "william",
    "bob": "robert", "dick": "richard", "peggy": "margaret", "ted": "edward", "jack": "john", "tom": "thomas", "hans": "johannes", "heinz": "heinrich", "sepp": "josef", "beppi": "josef", "gigi": "luigi", "kuba": "jakub", "jasiek": "jan",
}
_TOKEN = re.compile(r"[^\W_]{3,}-[^\W_]{1,6}\.|[^\W_]+(?:[?�'][^\W_]*)*\.?")
_NO_ORNAMENT = re.compile(r"[A-Za-zÀ-ž .,&]*$")
_RUN_TOGETHER = re.compile(r"(?<=[a-zß-öø-ÿ])(?=[A-ZÀ-ÖØ-Þ])")


# Long legal forms that are recognised with two typing mistakes.
_LONG_FORMS = tuple((x, len(x), letters(x)) for x in ("unipessoallda", "unipessoal", "gmbhcokg"))


def _long_form(tail: str) -> bool:
    """Whether a text of more than eight letters is a long legal form, but for two typing mistakes. The bound of typing_distance comes first."""
    n, got = len(tail), letters(tail)
    return any(abs(m - n) < 3 and (got ^ bits).bit_count() <= 4 and typing_distance(tail, x, 2) <= 2 for x, m, bits in _LONG_FORMS)


@lru_cache(50_000)
def _home(city: str | None) -> tuple[list[str], str, str]:
    """The words of a town's column, folded, the same in one word, and folded as it stands; empty if missing."""
    if is_missing(city):
        return [], "", ""
    s = fold(repaired(city))
    words = _TOKEN.findall(s)
    return words, "".join(words), s


@lru_cache(100_000)
def organisation(name: str, city: str | None) -> str:
    """The words of a firm's name, folded, without legal form, ornaments and town; an abbreviation keeps its dot. Empty if missing."""
    if is_missing(name):
        return ""
    s = repaired(name)
    if not _NO_ORNAMENT.match(s):
        s = _ORNAMENT.sub(" ", s)
    s = fold(_RUN_TOGETHER.sub(" ", s))
    words = [w for w in _TOKEN.findall(s.replace("'", ""))]
    plain = [w.rstrip(".") for w in words]
    home, joined, _ = _home(city)
    while len(words) > 1:  # legal forms, written together or apart, and the town, at the end
        for n in (5, 4, 3, 2, 1):
            tail = "".join(plain[-n:])
            if len(words) > n and (tail in LEGAL or n <= 2 and 8 < len(tail) < 16 and _long_form(tail)):
                words, plain = words[:-n], plain[:-n]
                break
        else:
            n = len(home)
            if n and len(words) > n and typing_distance("".join(plain[-n:]), joined, 2) <= 2:
                words, plain = words[:-n], plain[:-n]
                if len(words) > 1 and plain[-1] == "in":
                    words, plain = words[:-1], plain[:-1]
                continue
            break
    kept = [w for w in words if w.rstrip(".") not in _SMALL] or words
    return " ".join(kept)


@lru_cache(100_000)
def person(name: str) -> str:
    """The words of a person's name, folded, without titles and roles; single letters are initials. Empty if missing."""
    if is_missing(name):
        return ""
    s = re.sub(r"\([^)]*\)|\s/\s.*$", " ", fold(repaired(name)))
    words = [w.rstrip(".") for w in _TOKEN.findall(s.replace("'", ""))]
    kept = [w for w in words if w not in TITLES]
    return " ".join(kept or words)


#: How much two spellings may differ: as those of firms that contradict each other in phone and domain, that do neither, that share one.
STRICT, PLAIN, LOOSE = 0, 1, 2


def _most(n: int, level: int = LOOSE) -> int:
    """The typing mistakes allowed in a word of n letters."""
    if level == STRICT:
        return 0 if n < 5 else 1 if n < 12 else 2
    if level == PLAIN:
        return 0 if n < 3 else 1 if n < 5 else 2 if n < 12 else 3
    return 0 if n < 3 else 1 if n < 5 else 2 if n < 8 else 3


@lru_cache(200_000)
def _alike(a: str, b: str, level: int = LOOSE) -> float:
    """How well two words of firms' names agree: 1 equal, less for typing mistakes and abbreviations, 0 not at all."""
    if a == b:
        return 1.0
    x, y = a.rstrip("."), b.rstrip(".")
    if x == y:
        return 1.0
    if "-" in x or "-" in y:  # kosmetik-st. for kosmetikstudio
        s, t = (x, y) if "-" in x else (y, x)
        if "-" not in t:
            p, q = s.split("-", 1)
            if typing_distance(p, t[: len(p)], 1) <= 1 and len(t) >= len(p) + len(q) - 1:
                return 0.85
            return 0.0
    n = min(len(x), len(y))
    lost = x.count("?") + x.count("�") + y.count("?") + y.count("�")
    most = _most(n, level) + lost
    if abs(len(x) - len(y)) <= most and (d := typing_distance(x, y, most)) <= most:
        return 1 - d / (2 * max(len(x), len(y)))
    for s, t, dotted in ((x, y, a.endswith(".")), (y, x, b.endswith("."))):
        if dotted and len(s) < len(t):
            if t.startswith(s):
                return 0.9 if len(s) > 1 else 0.6
            if len(s) > 2 and min(typing_distance(s, t[: len(s) + k], 1) for k in (-1, 0, 1)) <= 1:
                return 0.8
            if len(s) <= 3 and s[0] == t[0] and _subsequence(s, t) or len(s) > 3 and s[:3] == t[:3]:
                return 0.6
    return 0.0


def _subsequence(s: str, t: str) -> bool:
    it = iter(t)
    return all(c in it for c in s)


@lru_cache(100_000)
def _forms(name: str) -> tuple[list[str], str, str]:
    """A name's words, the name run together, and its words run together in order."""
    words = name.split()
    return words, name.replace(" ", "").replace(".", ""), "".join(sorted(words)).replace(".", "")


@lru_cache(200_000)
def same_organisation(a: str, b: str, level: int = LOOSE) -> bool:
    """Whether two firms' names, as organisation() gives them, may be one firm's: every word of one has a counterpart in the other."""
    if a == b:
        return True
    if b < a:  # the same answer either way
        a, b = b, a
    (p, ja, sa), (q, jb, sb) = _forms(a), _forms(b)
    n = min(len(ja), len(jb))
    most = (n // 12, min(2, n // 9), n * 2 // 9)[level] if n >= 6 else 0
    if most and abs(len(ja) - len(jb)) <= most and (typing_distance(ja, jb, most) <= most or typing_distance(sa, sb, most) <= most):
        return True
    if len(p) > len(q):
        p, q, ja, jb = q, p, jb, ja
    left, strong, lone = list(q), 0, []
    for w in sorted(p, key=lambda w: -len(w)):
        best, at = 0.0, -1
        for k, r in enumerate(left):
            if (s := _alike(w, r, level)) > best:
                best, at = s, k
        if at >= 0:
            r = left.pop(at)
            if best >= 0.7 and not w.endswith("."):
                strong += min(len(w), len(r.rstrip(".")))
        else:
            lone.append(w)
    weighty = [w for w in lone if len(w.rstrip(".")) > 2]
    rest = [w for w in left if len(w.rstrip(".")) > 2]
    if not weighty:
        return strong >= 4
    # words run together or split: the words without a counterpart spell the same
    x, y = "".join(lone).replace(".", ""), "".join(left).replace(".", "")
    n = max(len(x), len(y))
    if n >= 5 and abs(len(x) - len(y)) <= 3 and typing_distance(x, y, 3) <= ((1, 2, 3)[level] if n >= 10 else min(1, level)):
        return True
    if level == LOOSE and strong >= 4 and n >= 4 and len(lone) == len(rest) == 1 and x[0] == y[0] and typing_distance(x, y, 4) <= (3 if n < 8 else n // 3):
        return True  # one mistyped word beside words that agree
    for s, t in ((p, jb), (q, ja)):  # one name inside the other
        s = "".join(s).replace(".", "")
        if len(s) >= 8 and s in t:
            return True
    return not rest and not weighty


@lru_cache(200_000)
def level_of(a: str, b: str) -> int | None:
    """The strictest level at which two firms' names agree; None if they do at none."""
    return next((k for k in (STRICT, PLAIN, LOOSE) if same_organisation(a, b, k)), None)


def allowed(phones: tuple, domains: tuple) -> int:
    """The level for two rows by their phones and domains (null: unknown): LOOSE if one agrees, STRICT if both contradict, else PLAIN."""
    (p, q), (d, e) = phones, domains
    if p is not None and p == q or d is not None and d == e:
        return LOOSE
    return STRICT if None not in (p, q, d, e) else PLAIN


@lru_cache(200_000)
def _in_full(a: str, b: str) -> bool:
    """Whether two or more full words of two persons' names agree, so that the firm's name need not."""
    p, q = ([w for w in n.split() if len(w) > 3] for n in (a, b))
    if len(p) > len(q):
        p, q = q, p
    return len(p) > 1 and all(any(typing_distance(x, y, 1) <= 1 for y in q) for x in p)


@lru_cache(100_000)
def _given(a: str, b: str) -> bool:
    """Whether two given names may be one person's: equal, mistyped, an initial, a pet name, the beginning or the end."""
    if a == b or (len(a) == 1 or len(b) == 1) and a[0] == b[0]:
        return True
    if len(a) == 1 or len(b) == 1:
        full, one = (a, b) if len(b) == 1 else (b, a)
        return PET_NAMES.get(full, full)[0] == one
    n = min(len(a), len(b))
    most = 1 if n < 5 else 2
    if typing_distance(a, b, most) <= most:
        return True
    if n > 2 and (a.startswith(b[:-1] if n > 3 else b) or b.startswith(a[:-1] if n > 3 else a) if abs(len(a) - len(b)) > 1 else False):
        return True
    if n > 2 and (a.endswith(b) or b.endswith(a)) or n == 2 and (a.startswith(b) or b.startswith(a)):
        return True
    for x, y in ((a, b), (b, a)):
        for pet, full in PET_NAMES.items():
            if (x == pet or len(pet) > 4 and typing_distance(x, pet, 1) <= 1) and (y == full or typing_distance(y, full, 2) <= 2):
                return True
    return False


@lru_cache(200_000)
def same_person(a: str, b: str) -> bool:
    """Whether two persons' names, as person() gives them, may be one person's: a full word (the surname) agrees and no other word
    contradicts."""
    if a == b:
        return True
    a, b = sorted((a, b))
    p, q = a.split(), b.split()
    if len(p) > len(q):
        p, q = q, p
    pairs = sorted(((typing_distance(x, y, _most(min(len(x), len(y)))) / max(len(x), len(y)), -len(x), i, j) for i, x in enumerate(p) for j, y in enumerate(q) if min(len(x), len(y)) > 2 and typing_distance(x, y, _most(min(len(x), len(y)))) <= _most(min(len(x), len(y)))))
    used_p, used_q = set(), set()
    for _, _, i, j in pairs:
        if i not in used_p and j not in used_q:
            used_p.add(i)
            used_q.add(j)
    if not used_p:
        ja, jb = "".join(sorted(p)), "".join(sorted(q))
        return len(ja) >= 8 and typing_distance("".join(p), "".join(q), 2) <= 2
    rest_p = [w for i, w in enumerate(p) if i not in used_p]
    rest_q = [w for j, w in enumerate(q) if j not in used_q]
    for w in sorted(rest_p, key=lambda w: -len(w)):
        for k, r in enumerate(rest_q):
            if _given(w, r):
                rest_q.pop(k)
                break
        else:
            full = [r for r in rest_q if len(r) > 1]
            if len(w) > 1 and full or len(w) == 1 and any(len(r) == 1 for r in rest_q) and not full:
                return False  # another given name, another initial
            if len(w) == 1 and full and len(used_p) == 1:
                return False
    return True


def _keys(text: str, is_person: bool) -> list[tuple[str, str]]:
    """(kind, key): the words of a name (w), and the name run together in the orders in which it is compared (j)."""
    words = text.split()
    if is_person:
        return list(dict.fromkeys([("w", w) for w in words if len(w) > 2] + [("j", "".join(words))]))
    runs = (words, sorted(words), sorted(words, key=lambda w: -len(w)))
    return list(dict.fromkeys([("w", w) for w in words] + [("j", "".join(r).replace(".", "")) for r in runs]))


def _reach(kind: str, n: int, is_person: bool) -> int:
    """The typing mistakes beyond which two keys, the shorter of n letters, make no pair."""
    if kind == "w":
        return _most(n)
    return 2 if is_person else max(n * 2 // 9 if n >= 6 else 0, 3 if n >= 7 else 1)


def _signature(s: str) -> int:
    """64 bits, of which a typing mistake changes two at most: the first and second of each letter, the kinds of other characters."""
    got, seen = 0, set()
    for c in s:
        if "a" <= c <= "z":
            k = 2 * (ord(c) - 97)
            got |= 1 << (k + 1 if c in seen else k)
            seen.add(c)
        else:
            got |= 1 << 52 + ord(c) % 12
    return got


def near_keys(left: list[str], right: list[str] | None, kind: str, is_person: bool) -> list[tuple[str, str]]:
    """All pairs of a key of left and one of right (None: two of left) that make their names candidates. Signatures leave out only what
    cannot be within reach; abbreviations and damaged words are compared with every word."""
    odd = lambda k: kind == "w" and not is_person and any(c in k for c in ".-?�")

    def test(x: str, y: str) -> bool:
        if kind == "w" and not is_person:
            return _alike(x, y) > 0
        most = _reach(kind, min(len(x), len(y)), is_person)
        return typing_distance(x, y, most) <= most

    sides = [left, left if right is None else right]
    out = [(x, y) for x in sides[0] if odd(x) for y in sides[1] if x != y and test(x, y)]
    out += [(x, y) for y in sides[1] if odd(y) for x in sides[0] if x != y and test(x, y)]
    xs, ys = ([k for k in side if not odd(k)] for side in sides)
    if not xs or not ys:
        return out
    sx, sy = (np.array([_signature(k) for k in side], np.uint64) for side in (xs, ys))
    nx, ny = (np.array([len(k) for k in side]) for side in (xs, ys))
    most = np.array([_reach(kind, n, is_person) for n in range(max(nx.max(), ny.max()) + 1)])
    for i, x in enumerate(xs):
        reach = most[np.minimum(nx[i], ny)]
        ok = (np.abs(ny - nx[i]) <= reach) & (np.bitwise_count(sy ^ sx[i]) <= 2 * reach)
        if right is None:
            ok[: i + 1] = False
        out += [(x, ys[j]) for j in np.flatnonzero(ok) if x != ys[j] and test(x, ys[j])]
    return out


def _pairs(items: list[tuple[str, str]], person_field: bool) -> list[tuple[int, int, int]]:
    """The pairs of items (name, firm) that name the same, by place in the list, with the level at which they do; an item pairs with
    itself too. Every two names of a small block are compared."""
    out = []
    for i, (a, f) in enumerate(items):
        out.append((i, i, STRICT))
        for j in range(i):
            b, g = items[j]
            if person_field:
                if same_person(a, b) and (not f or not g or same_organisation(f, g) or _in_full(a, b)):
                    out.append((j, i, STRICT))
            elif (level := level_of(a, b)) is not None:
                out.append((j, i, level))
    return out


_COLUMNS = ("id", "placed", "business_name", "decision_maker_name", "city", "town", "p", "d")


def _read(rows: list[tuple], persons: bool = True) -> list[tuple]:
    """Rows of _COLUMNS with their names in comparable form: (id, placed, org, who, org as stored, who as stored, home, p, d); without
    persons who is empty."""
    out = []
    for i, placed, org, who, city, town, p, d in rows:
        out.append((i, placed, organisation(org, city) if org is not None else "", person(who) if persons and who is not None else "", org, who, _home(city)[2] or town, p, d))
    return out


def _named(df: DataFrame) -> DataFrame:
    """Rows of blocks with their names in comparable form: block, id, placed, org, who, org_hash, who_hash, home, p, d."""
    import xxhash

    def hash_(s):
        return 0 if s is None else xxhash.xxh3_64_intdigest(s) - 2**63

    def run(b):
        rows = _read(list(zip(*[b[c] for c in _COLUMNS])))
        got = dict(zip(("id", "placed", "org", "who", "org_hash", "who_hash", "home", "p", "d"), map(list, zip(*rows))))
        return got | {"block": b["block"], "org_hash": [hash_(n) for n in got["org_hash"]], "who_hash": [hash_(n) for n in got["who_hash"]]}

    return map_batches(df, run, "block string, id long, placed boolean, org string, who string, org_hash long, who_hash long, home string, p long, d long")


def blocks(full: DataFrame) -> DataFrame:
    """(block, *_COLUMNS): each lead in the block of its place; and in those of its phone and its domain, if the block has a lead without a
    place."""
    placed = (F.col("num") != "") & (F.col("street") != "") & (F.col("town") != "")
    rest = ["id", placed.alias("placed"), "business_name", "decision_maker_name", "city", "town", F.when(F.col("phone").isNotNull(), F.xxhash64("phone")).alias("p"), F.when(F.col("domain").isNotNull(), F.xxhash64("domain")).alias("d")]
    at = full.where(placed).select(F.concat_ws("|", F.lit("a"), "town", "num", "street").alias("block"), *rest)
    for k in ("phone", "domain"):
        keyed = full.where(F.col(k).isNotNull()).select(F.concat(F.lit(k[0]), F.col(k)).alias("block"), *rest)
        open_ = keyed.where("not placed").select("block").distinct()
        at = at.union(keyed.join(open_, "block", "left_semi"))
    return at


#: Blocks of more rows than this are not paired row by row in one task.
BLOCK_ROWS = 1000
_LINKS = "field_name string, source_row_id_a long, source_row_id_b long"


def _apart(x: tuple, y: tuple, placed_block: bool) -> bool:
    """Whether two rows of a block cannot be of one organisation: in the block of a phone or domain two places are two organisations, and
    without a place the towns must not differ."""
    if placed_block:
        return False
    (px, hx), (py, hy) = x, y
    return px and py or bool(hx and hy and hx != hy and edit_distance(hx, hy, 2) > 2)


def _agree(a: tuple[str, str], b: tuple[str, str], person_field: bool, level: int) -> bool:
    """Whether two items (name, firm) may name the same where their rows allow this level (a stricter one is tried too: the words may pair
    otherwise there)."""
    if not person_field:
        return any(same_organisation(a[0], b[0], k) for k in range(level, STRICT - 1, -1))
    return same_person(a[0], b[0]) and (not a[1] or not b[1] or same_organisation(a[1], b[1]) or _in_full(a[0], b[0]))


def _row_pairs(block: str, rows: list[tuple]) -> list[tuple[str, int, int]]:
    """The links of a block's rows (id, placed, org, who, org as stored, who as stored, home, p, d); p and d stand for phone and domain."""
    out, at = [], block[0] == "a"
    for field, name, stored in (("business_name", 2, 4), ("decision_maker_name", 3, 5)):
        person_field = name == 3
        by_item: dict[tuple[str, str], list[tuple]] = defaultdict(list)
        for r in rows:
            if r[name]:
                by_item[(r[name], r[2] if person_field else "")].append(r)
        items = list(by_item)
        for i, a in enumerate(items):
            for j in range(i + 1):
                b, known = items[j], {}
                for x in by_item[a]:
                    for y in by_item[b]:
                        if x[stored] == y[stored] or x[0] == y[0] or i == j and x[0] > y[0] or _apart((x[1], x[6]), (y[1], y[6]), at):
                            continue
                        level = STRICT if person_field else allowed((x[7], y[7]), (x[8], y[8]))
                        if level not in known:
                            known[level] = i == j or _agree(a, b, person_field, level)
                        if known[level]:
                            out.append((field, min(x[0], y[0]), max(x[0], y[0])))
    return out


def _links(block: str, rows: list[tuple]) -> list[tuple[str, int, int]]:
    """The links of a block's rows of _COLUMNS. Names of which only one is stored have no variants and need not be read."""
    orgs, whos = ({r[k] for r in rows} - {None} for k in (2, 3))
    if len(orgs) < 2 and len(whos) < 2:
        return []
    return _row_pairs(block, _read(rows, len(whos) > 1))


def linked(at: DataFrame) -> DataFrame:
    """(field_name, source_row_id_a, source_row_id_b): the pairs of rows of one block whose names agree and are not stored as one string.

    Blocks of up to BLOCK_ROWS rows are paired as they stream by; larger ones by the joins of _linked, with the same pairs."""
    hot = cut(at.groupBy("block").count().where(F.col("count") > BLOCK_ROWS).select("block"))
    some_hot = bool(hot.limit(1).count())
    cool = at.join(hot, "block", "left_anti") if some_hot else at
    # blocks of one row stay in the JVM; a block here has BLOCK_ROWS rows at most
    streamed = cool.select("block", *_COLUMNS, (F.count("*").over(W.partitionBy("block")) > 1).alias("several")).where("several").drop("several")

    def run(batches):
        block, rows = None, []
        for b in batches:
            out: list = []
            for bl, *r in zip(b["block"], *[b[c] for c in _COLUMNS]):
                if bl != block:
                    out += _links(block, rows)
                    block, rows = bl, []
                rows.append(tuple(r))
            yield dict(zip(("field_name", "source_row_id_a", "source_row_id_b"), map(list, zip(*out)) if out else ([],) * 3))
        out = _links(block, rows)
        yield dict(zip(("field_name", "source_row_id_a", "source_row_id_b"), map(list, zip(*out)) if out else ([],) * 3))

    got = map_partitions(streamed, run, _LINKS)
    if some_hot:
        large = cut(_named(at.join(hot, "block", "left_semi")))
        for field in ("business_name", "decision_maker_name"):
            got = got.union(_linked(large, field).select(F.lit(field).alias("field_name"), "*"))
    return got.distinct()


def _linked(at: DataFrame, field: str) -> DataFrame:
    """Pairs of ids of one block whose names in the field agree and are not stored as one string."""
    name, stored, is_person = ("who", "who_hash", True) if field == "decision_maker_name" else ("org", "org_hash", False)
    have = at.where(F.col(name) != "").select("block", "id", "placed", F.col(name).alias("name"), (F.col("org") if is_person else F.lit("")).alias("firm"), F.col(stored).alias("stored"), "home", "p", "d")
    items = have.groupBy("block", "name", "firm").agg(F.min("stored").alias("s0"), F.max("stored").alias("s1"))
    sized = items.groupBy("block").agg(F.count("*").alias("n"), F.max(F.expr("s0 <> s1")).alias("mixed")).where("n > 1 or mixed")
    small = items.join(sized.where(F.col("n") <= CELL), "block", "left_semi").select("block", "name", "firm").repartition("block").sortWithinPartitions("block")

    def run(batches):
        at_, mine = None, []

        def flush(out):
            for i, j, level in _pairs(mine, is_person):
                out.append((at_, *mine[i], *mine[j], level))

        for b in batches:
            out = []
            for bl, n, f in zip(b["block"], b["name"], b["firm"]):
                if bl != at_:
                    flush(out)
                    at_, mine = bl, []
                mine.append((n, f))
            yield dict(zip(("block", "n1", "f1", "n2", "f2", "level"), map(list, zip(*out)) if out else ([],) * 6))
        out = []
        flush(out)
        yield dict(zip(("block", "n1", "f1", "n2", "f2", "level"), map(list, zip(*out)) if out else ([],) * 6))

    schema = "block string, n1 string, f1 string, n2 string, f2 string, level int"
    pairs = map_partitions(small, run, schema)
    large = cut(items.join(sized.where(F.col("n") > CELL).select("block"), "block", "left_semi").select("block", "name", "firm"))
    if large.limit(1).count():
        pairs = pairs.union(_large(large, is_person, schema))
    a = have.select("block", F.col("id").alias("ia"), F.col("name").alias("n1"), F.col("firm").alias("f1"), F.col("stored").alias("sa"), F.col("placed").alias("pa"), F.col("home").alias("ha"), F.col("p").alias("p1"), F.col("d").alias("d1"))
    b = have.select("block", F.col("id").alias("ib"), F.col("name").alias("n2"), F.col("firm").alias("f2"), F.col("stored").alias("sb"), F.col("placed").alias("pb"), F.col("home").alias("hb"), F.col("p").alias("p2"), F.col("d").alias("d2"))
    both = pairs.join(a, ["block", "n1", "f1"]).join(b, ["block", "n2", "f2"]).where("ia <> ib and sa <> sb")
    both = both.where(f"level <= case when p1 = p2 or d1 = d2 then {LOOSE} when p1 is not null and p2 is not null and d1 is not null and d2 is not null then {STRICT} else {PLAIN} end")
    # in the block of a phone or domain, two places are two organisations; without a place the towns must not differ
    both = both.where("substring(block, 1, 1) = 'a' or (not (pa and pb) and (ha = '' or hb = '' or levenshtein(ha, hb, 2) >= 0))")
    return both.select(F.least("ia", "ib").alias("source_row_id_a"), F.greatest("ia", "ib").alias("source_row_id_b")).distinct()


def _large(items: DataFrame, is_person: bool, schema: str) -> DataFrame:
    """The pairs of blocks too large to compare each name with each. Candidates hold all that the comparison can accept: names that share
    a word within its reach or an abbreviation of one, that are alike when run together, or of which one is inside the other."""
    named = items.select("block", "name").distinct()

    def keys(b):
        rows = [(x, n, *k) for x, n in zip(b["block"], b["name"]) for k in _keys(n, is_person)]
        return dict(zip(("block", "name", "kind", "key"), map(list, zip(*rows)) if rows else ([],) * 4))

    split = cut(map_batches(named, keys, "block string, name string, kind string, key string"))
    # the keys of a block in sides of about so many; every two sides meet in a cell
    parts = split.select("block", "kind", "key").distinct()
    sides = parts.groupBy("block", "kind").agg(F.ceil(F.count("*") / (4 * CELL)).alias("sides"))
    parts = parts.join(sides, ["block", "kind"]).withColumn("side", F.pmod(F.xxhash64("key"), F.col("sides"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)))
    parts = parts.select("block", "kind", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "key").repartition("block", "kind", "low", "high").sortWithinPartitions("block", "kind", "low", "high")

    def run(batches):
        at_, have = None, ([], [])

        def flush():
            if at_ is None:
                return []
            block, kind, low, high = at_
            return [(block, kind, x, y) for x, y in near_keys(have[0], None if low == high else have[1], kind, is_person)]

        for b in batches:
            out = []
            for *at, side, k in zip(*[b[c] for c in ("block", "kind", "low", "high", "side", "key")]):
                if at != at_:
                    out += flush()
                    at_, have = at, ([], [])
                have[side != at[2]].append(k)
            yield dict(zip(("block", "kind", "k1", "k2"), map(list, zip(*out)) if out else ([],) * 4))
        out = flush()
        yield dict(zip(("block", "kind", "k1", "k2"), map(list, zip(*out)) if out else ([],) * 4))

    near = map_partitions(parts, run, "block string, kind string, k1 string, k2 string").distinct()
    near = near.union(split.select("block", "kind", F.col("key").alias("k1"), F.col("key").alias("k2")).distinct())
    x, y = (split.select("block", "kind", F.col("key").alias(f"k{k}"), F.col("name").alias(f"n{k}")) for k in (1, 2))
    candidates = near.join(x, ["block", "kind", "k1"]).join(y, ["block", "kind", "k2"]).select("block", "n1", "n2")
    if not is_person:
        run_together = named.withColumn("s", F.translate("name", " .", ""))
        inner = run_together.where("length(s) >= 8").select("block", F.col("name").alias("n1"), F.col("s").alias("s1"), F.substring("s", 1, 8).alias("g"))
        outer = run_together.where("length(s) >= 8").select("block", F.col("name").alias("n2"), F.col("s").alias("s2"), F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("s") - 7), lambda i: F.substring("s", i, F.lit(8))))).alias("g"))
        candidates = candidates.union(inner.join(outer, ["block", "g"]).where("n1 <> n2 and contains(s2, s1)").select("block", "n1", "n2"))
    candidates = candidates.select("block", F.least("n1", "n2").alias("n1"), F.greatest("n1", "n2").alias("n2")).distinct()
    i, j = items.select("block", F.col("name").alias("n1"), F.col("firm").alias("f1")), items.select("block", F.col("name").alias("n2"), F.col("firm").alias("f2"))
    full = candidates.join(i, ["block", "n1"]).join(j, ["block", "n2"]).where("n1 < n2 or f1 <= f2")

    def check(b):
        out = {c: [] for c in ("block", "n1", "f1", "n2", "f2", "level")}
        for row in zip(*[b[c] for c in ("block", "n1", "f1", "n2", "f2")]):
            _, n, f, m, g = row
            if n == m and f == g:
                level = STRICT
            elif is_person:
                level = STRICT if same_person(n, m) and (not f or not g or same_organisation(f, g) or _in_full(n, m)) else None
            else:
                level = level_of(n, m)
            if level is not None:
                for c, v in zip(out, (*row, level)):
                    out[c].append(v)
        return out

    return map_batches(full.select("block", "n1", "f1", "n2", "f2"), check, schema)


def variants(leads: DataFrame, shared: DataFrame) -> DataFrame:
    """(field_name, source_row_id_a, source_row_id_b): pairs of ungrouped leads whose business_name names one organisation, or whose
    decision_maker_name one person of one organisation, and that are not stored as one string.

    An organisation is at one place: leads with addresses must share it; where one has none, an equal phone or unshared domain must join
    an agreeing name and no contradicting town. Null, blank and missing names pair with nothing; repeated rows pair with the variants
    of their name but not with each other; an empty table gives no row."""
    leads = leads.where("duplicate_group_id is null")
    domains = shared.select(F.lower(F.trim("domain")).alias("domain")).distinct()
    named = leads.where(~(missing("business_name") & missing("decision_maker_name")))
    base = named.select("source_row_id", "address", "city", "business_name", "decision_maker_name", usable_phone("phone_e164").alias("phone"), usable_domain("website_domain").alias("domain"))
    base = base.join(domains.withColumn("is_shared", F.lit(True)), "domain", "left")
    kept = {"k_org": "business_name", "k_who": "decision_maker_name", "k_city": "city", "k_phone": "phone", "k_domain": "domain"}
    base = base.select("source_row_id", "address", "city", "phone", "domain", *[F.col(c).alias(k) for k, c in kept.items() if c != "domain"], F.when(F.col("is_shared").isNull(), F.col("domain")).alias("k_domain"))
    at = addresses.places(base, "source_row_id", "address", "city", "phone", "domain", *kept).select("id", "town", "num", "street", *kept)
    none = base.where(missing("address")).select(F.col("source_row_id").cast("long"), *[F.lit("")] * 3, *kept)
    full = cut(at.union(none).select("id", "town", "num", "street", *[F.col(k).alias(c) for k, c in kept.items()]))
    return linked(cut(blocks(full)))
