"""Problem 6: leads and provider records of one business, without a shared key.

Method: candidates come from blocks of several attributes: the place, the phone, the host, and all places of one house number that are
up to NEAR letters apart in town and street, whatever the names (an exact block, which holds all that MinHash bands of names could add).
Each candidate pair gets similarity features; a logistic model is trained on weak labels (votes of the attributes, strong
agreements against strong contradictions) and its scores are calibrated on pairs it has not seen, so that a confidence is a
probability. Pairs at two different places are none, whatever they share: a business is at one place.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import addresses
from .common import cut, fold, is_missing, map_batches, missing, segment_keys, segment_probes, usable_domain, usable_phone
from .names import _alike, allowed, organisation, same_organisation

#: The labelled pairs that the model is fitted on: at most so many, chosen by hash. Everything else covers all pairs.
TRAIN = 20_000
#: MinHash (with_bands, no block of matches any more): bands of rows; names of trigram similarity 0.5 share a band with probability 0.82, of 0.65 with 0.96.
BANDS, ROWS = 6, 2
#: Places of one house number up to so many letters apart are compared.
NEAR = 3
FEATURES = ("name_same", "name_near", "name_differs", "place_same", "place_differs", "phone_same", "phone_differs", "host_same", "host_differs", "town_same")


def phone_key(c: Column) -> Column:
    """The last ten digits of a phone as typed by anyone: national and international forms agree. Null if fewer than eight."""
    d = F.regexp_replace(F.regexp_replace(c, r"\(0\)", ""), r"[^0-9]", "")
    d = F.regexp_replace(d, "^0+", "")
    return F.when((F.length(d) >= 8) & ~d.rlike(r"^[0-9]{0,3}?([0-9])\1{7,}$"), F.right(d, F.lit(10)))


def host(c: Column) -> Column:
    """The host of a URL as typed, without www; null if there is none."""
    h = F.regexp_extract(F.lower(F.trim(c)), r"^(?:[a-z]+://)?(?:www\.)?([^/?#:\s]+)", 1)
    return F.when(h.rlike(r"^[^.]+(\.[^.]+)+$"), h)


def with_bands(df: DataFrame, name: Column, number: Column) -> DataFrame:
    """df with the column bands: the MinHash bands of a name's trigrams at a house number, computed in the JVM; empty without one of
    them. The trigrams are a column of their own, lest they be made again for every hash."""
    d = df.withColumn("_t", F.concat(F.lit("  "), F.regexp_replace(F.lower(name), r"(?U)[^\p{L}]", ""), F.lit(" ")))
    d = d.withColumn("_grams", F.transform(F.sequence(F.lit(1), F.greatest(F.length("_t") - 2, F.lit(1))), lambda i: F.xxhash64(F.substring("_t", i, F.lit(3)))))
    hashed = lambda k: F.array_min(F.transform("_grams", lambda g: F.xxhash64(g, F.lit(k))))
    least = [hashed(k) for k in range(BANDS * ROWS)]
    made = F.array(*[F.xxhash64(F.lit(k), *least[ROWS * k : ROWS * (k + 1)], number) for k in range(BANDS)])
    return d.withColumn("bands", F.when((F.length("_t") > 3) & (number != ""), made).otherwise(F.array().cast("array<long>"))).drop("_t", "_grams")


def _features(names: tuple[str, str], place: tuple[str, str], phone: tuple, site: tuple, town: tuple[str, str]) -> list[float]:
    a, b = names
    same = float(bool(a and b) and same_organisation(a, b, allowed(phone, site)))
    near = 0.0
    if a and b and not same:
        p, q = sorted((a.split(), b.split()), key=len)
        near = sum(max((_alike(w, r) for r in q), default=0) * len(w) for w in p) / max(1, sum(map(len, p)))
    eq = lambda x: float(bool(x[0] and x[1]) and x[0] == x[1])
    ne = lambda x: float(bool(x[0] and x[1]) and x[0] != x[1])
    return [same, near, float(bool(a and b) and not same), eq(place), ne(place), eq(phone), ne(phone), eq(site), ne(site), eq(town)]


#: Votes of the labelling functions; a pair is labelled a match from MATCH upwards, none up to NO_MATCH, not at all between.
VOTES = {"name_same": 2.0, "name_differs": -2.5, "place_same": 2.0, "place_differs": -4.0, "phone_same": 2.0, "phone_differs": -0.4, "host_same": 2.0, "host_differs": -0.4}
MATCH, NO_MATCH = 3.0, -1.0


def fit(x: np.ndarray, y: np.ndarray, l2: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the intercept) of a logistic regression by Newton's method."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    reg = np.eye(len(w)) * l2
    reg[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + reg, x.T @ (y - p) - reg @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def calibrate(scores: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's (slope, offset) on scores of pairs that the model was not fitted on, with his smoothed targets."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    w = fit(scores[:, None], t, 1e-3)
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def train(pairs: DataFrame) -> tuple[np.ndarray, tuple[float, float]]:
    """(weights, (slope, offset)) from the weak labels of a bounded sample. Without examples of both kinds the votes are the weights."""
    vote = sum((F.col(k) * v for k, v in VOTES.items()), F.lit(0.0))
    labelled = pairs.withColumn("vote", vote).where((F.col("vote") >= MATCH) | (F.col("vote") <= NO_MATCH))
    n = labelled.count()
    share = max(1, n // TRAIN)
    rows = labelled.where(F.pmod(F.xxhash64("lead", "org"), F.lit(share)) == 0).select(*FEATURES, (F.col("vote") > 0).cast("double").alias("y"), F.pmod(F.xxhash64("org", "lead"), F.lit(10)).alias("fold")).limit(2 * TRAIN).collect()
    m = np.array([list(r) for r in rows], float).reshape(-1, len(FEATURES) + 2)
    x, y, part = m[:, : len(FEATURES)], m[:, -2], m[:, -1]
    if len(m) < 20 or not 0 < y.sum() < len(y):
        return np.array([VOTES.get(f, 0.0) for f in FEATURES] + [-1.0]), (1.0, 0.0)
    first, second = part < 7, part >= 7
    if not (0 < y[first].sum() < first.sum() and 0 < y[second].sum() < second.sum()):
        first = second = np.ones(len(y), bool)
    w = fit(x[first], y[first])
    return w, calibrate(x[second] @ w[:-1] + w[-1], y[second])


def records(leads: DataFrame, orgs: DataFrame, shared: DataFrame) -> DataFrame:
    """Both tables in one form: id, is_org, name, city, town, place, phone, host."""
    both = leads.select(
        F.col("source_row_id").cast("long").alias("id"), F.lit(False).alias("is_org"), F.col("business_name").alias("name"), "address", "city", phone_key(usable_phone("phone_e164")).alias("phone"), usable_domain("website_domain").alias("host")
    ).union(
        orgs.select(F.col("org_id").cast("long"), F.lit(True), "org_name", "org_address", F.lit(None).cast("string"), phone_key(F.when(~missing("org_phone"), F.col("org_phone"))), host(F.when(~missing("org_website"), F.col("org_website"))))
    )
    domains = shared.select(F.lower(F.trim("domain")).alias("host")).distinct()
    both = both.join(domains.withColumn("is_shared", F.lit(True)), "host", "left").withColumn("host", F.when(F.col("is_shared").isNull(), F.col("host"))).drop("is_shared")
    kept = {"k_org": "is_org", "k_name": "name", "k_city": "city", "k_phone": "phone", "k_host": "host"}
    both = both.select("id", "address", "city", "phone", "host", *[F.col(c).alias(k) for k, c in kept.items()])
    at = addresses.places(both, "id", "address", "city", "phone", "host", *kept).select("id", "town", "num", "street", *kept)
    none = both.where(missing("address")).select("id", *[F.lit("")] * 3, *kept)
    full = at.union(none).select("id", "town", "num", "street", *[F.col(k).alias(c) for k, c in kept.items()])
    full = full.withColumn("place", F.when((F.col("num") != "") & (F.col("street") != "") & (F.col("town") != ""), F.concat_ws("|", "town", "num", "street")).otherwise(""))
    return full.select("id", "is_org", F.when(~missing("name"), F.col("name")).alias("name"), "city", "town", "place", "phone", "host")


def keyed(df: DataFrame) -> DataFrame:
    """(id, key) of every exact block that a record is in: place, phone, host."""
    exact = F.array(F.when(F.col("place") != "", F.xxhash64(F.lit("a"), "place")), F.when(F.col("phone").isNotNull(), F.xxhash64(F.lit("p"), "phone")), F.when(F.col("host").isNotNull(), F.xxhash64(F.lit("h"), "host")))
    return df.select("id", F.explode(F.filter(exact, lambda x: x.isNotNull())).alias("key"))


def near_places(a: DataFrame, b: DataFrame) -> DataFrame:
    """(a_place, b_place): every place of a and every other one of b with the same house number that are within NEAR edits.

    A number stands between the parts, so the edits of town and street add up: towns of a meet the towns of b within NEAR edits (by
    segments, one of which NEAR edits leave whole), and the places of such towns and one number are compared."""
    parts = lambda d: d.where("place <> ''").select("place", F.split_part("place", F.lit("|"), F.lit(1)).alias("t"), F.split_part("place", F.lit("|"), F.lit(2)).alias("num")).distinct()
    x, y = parts(a), parts(b)

    def split(make):
        return lambda b: {"t": [t for t in b["t"] for _ in make(t, NEAR)], "k": [k for t in b["t"] for k in make(t, NEAR)]}

    p = map_batches(x.select("t").distinct(), split(segment_probes), "t string, k string")
    q = map_batches(y.select("t").distinct(), split(segment_keys), "t string, k string").withColumnRenamed("t", "u")
    towns = p.join(q, "k").where(F.levenshtein("t", "u", NEAR) >= 0).select("t", "u").distinct()
    met = x.withColumnRenamed("place", "a_place").join(towns, "t").join(y.select(F.col("place").alias("b_place"), F.col("t").alias("u"), "num"), ["u", "num"])
    return met.where((F.col("a_place") != F.col("b_place")) & (F.levenshtein("a_place", "b_place", NEAR) >= 0)).select("a_place", "b_place")


def matches(leads: DataFrame, orgs: DataFrame, shared: DataFrame, least: float = 0.75) -> DataFrame:
    """(source_row_id, org_id, confidence) of ungrouped leads and provider records that are one business, from a confidence of `least`.

    Null, blank and missing attributes neither agree nor contradict; a record without any matches nothing; repeated rows match alike;
    an empty table gives no row. Blocks join only leads with provider records, never a table with itself."""
    all_ = cut(records(leads.where("duplicate_group_id is null"), orgs, shared))
    org_keys = keyed(all_.where("is_org")).withColumnRenamed("id", "org")
    candidates = keyed(all_.where("not is_org")).withColumnRenamed("id", "lead").join(org_keys, "key").select("lead", "org")
    near = near_places(all_.where("not is_org"), all_.where("is_org"))
    near = near.join(all_.where("not is_org").select(F.col("id").alias("lead"), F.col("place").alias("a_place")), "a_place").join(all_.where("is_org").select(F.col("id").alias("org"), F.col("place").alias("b_place")), "b_place")
    candidates = candidates.union(near.select("lead", "org")).distinct()
    attributes = ("name", "place", "phone", "host", "town", "city")
    a = all_.where("not is_org").select(F.col("id").alias("lead"), *[F.col(c).alias(f"a_{c}") for c in attributes])
    b = all_.where("is_org").select(F.col("id").alias("org"), *[F.col(c).alias(f"b_{c}") for c in attributes])
    joined = candidates.join(b, "org").join(a, "lead")
    # a name alone says nothing, since like-named firms are elsewhere too: place (but for typing mistakes), phone or host must agree
    some = (F.col("a_place") == F.col("b_place")) & (F.col("a_place") != "") | (F.col("a_phone") == F.col("b_phone")) | (F.col("a_host") == F.col("b_host")) | (F.levenshtein("a_place", "b_place", NEAR) >= 0)
    joined = joined.where(some)

    def run(b):
        f = []
        for n, m, p, q, x, y, u, v, s, t, c, d in zip(*[b[f"{k}_{c}"] for c in attributes for k in "ab"]):
            s, t = s or ("" if is_missing(c) else fold(c)), t or ("" if is_missing(d) else fold(d))
            f.append(_features((organisation(n, c or s) if n else "", organisation(m, d or t) if m else ""), (p, q), (x, y), (u, v), (s, t)))
        # places a typing mistake apart are neither one nor two
        for r, p, q in zip(f, b["a_place"], b["b_place"]):
            if r[4] and _close(p, q):
                r[4] = 0.0
        return {"lead": b["lead"], "org": b["org"], **{n: [r[k] for r in f] for k, n in enumerate(FEATURES)}}

    pairs = cut(map_batches(joined, run, "lead long, org long, " + ", ".join(f"{n} double" for n in FEATURES)))
    w, (slope, offset) = train(pairs)
    score = sum((F.col(n) * float(v) for n, v in zip(FEATURES, w)), F.lit(float(w[-1])))
    scored = pairs.withColumn("confidence", F.round(1 / (1 + F.exp(-(score * slope + offset))), 4))
    return scored.where((F.col("confidence") >= least) & (F.col("place_differs") == 0)).select(F.col("lead").alias("source_row_id"), F.col("org").alias("org_id"), "confidence")


def _close(p: str, q: str) -> bool:
    """Whether two places agree in number and, but for a few letters, in town and street."""
    from .common import typing_distance

    (t, n, s), (u, m, r) = p.split("|"), q.split("|")
    return n == m and typing_distance(t, u, 2) <= 2 and typing_distance(s, r, 4) <= 4
