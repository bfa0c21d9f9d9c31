"""Problem 6."""

import random

import numpy as np
from pyspark.sql import functions as F

from leadspark.llm import linkage as K


def test_keys(spark):
    d = spark.createDataFrame([("+49 (0) 101/46430639", "https://www.Foo.example/de?x=1"), ("0101-46430639", "foo.example/#top"), ("+4910146430639", None), ("call", "no site"), ("+1111111111", "")], "p string, u string")
    got = d.select(K.phone_key(F.col("p")), K.host(F.col("u"))).collect()
    assert [r[0] for r in got] == ["0146430639"] * 3 + [None, None] and [r[1] for r in got] == ["foo.example", "foo.example", None, None, None]


def test_minhash_of_like_names_meets(spark):
    r = random.Random(1)
    rows = []
    for _ in range(200):
        a = "".join(r.choice("abcdefghijklmnop") for _ in range(16))
        rows.append((a, a[:7] + "x" + a[8:], "".join(r.choice("abcdefghijklmnop") for _ in range(16)), "7"))
    d = spark.createDataFrame(rows, "a string, b string, c string, n string")
    for c in "abc":
        d = K.with_bands(d, F.col(c), F.col("n")).withColumnRenamed("bands", f"bands_{c}")
    got = d.select(F.arrays_overlap("bands_a", "bands_b").alias("alike"), F.arrays_overlap("bands_a", "bands_c").alias("other")).collect()
    assert sum(x.alike for x in got) > 170 and sum(x.other for x in got) < 20
    assert K.with_bands(d, F.col("a"), F.lit("")).first().bands == []


def test_fit_and_calibrate():
    r = np.random.default_rng(1)
    x = r.normal(size=(4000, 2))
    y = (r.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))).astype(float)
    w = K.fit(x[:2000], y[:2000])
    slope, offset = K.calibrate(x[2000:] @ w[:2] + w[2], y[2000:])
    p = 1 / (1 + np.exp(-((x @ w[:2] + w[2]) * slope + offset)))
    for low in (0.0, 0.25, 0.5, 0.75):
        here = (p >= low) & (p < low + 0.25)
        assert abs(p[here].mean() - y[here].mean()) < 0.06


def test_rows(spark):
    lead = "source_row_id long, business_name string, address string, city string, phone_e164 string, website_domain string, duplicate_group_id long"
    org = "org_id long, org_name string, org_address string, org_phone string, org_website string, extra string"
    n = 60
    leads = [(k, f"Café Foo{chr(97 + k % 26)}{chr(97 + k // 26)}bar", f"Weg {k + 1}, 10000 Roslenfeld", "Roslenfeld", f"+4930555{k:05d}", f"foo{k}.example", None) for k in range(n)]
    orgs = [(1000 + k, f"Cafe Foo{chr(97 + k % 26)}{chr(97 + k // 26)}bar GmbH", f"10000 Roslenfeld, Weg {k + 1}", f"0305-55{k:05d}", f"https://www.foo{k}.example/x", "e") for k in range(n)]
    orgs += [(2000, "Café Fooaabar", "Weg 99, 10000 Roslenfeld", "030555-00000", "foo0.example", "e"), (2001, "Zimtbäckerei", "Weg 2, 10000 Roslenfeld", None, None, "e"), (2002, None, None, None, None, "e"), (2003, "Café Fooabbar", None, None, "https://portal.example/fooabbar", "e")]
    shared = spark.createDataFrame([("portal.example",)], "domain string")
    a, b = spark.createDataFrame(leads, lead), spark.createDataFrame(orgs, org)
    got = {(r.source_row_id, r.org_id) for r in K.matches(a, b, shared).collect()}
    # another place, another firm at the place, nothing at all, and a mere name match nothing
    assert got == {(k, 1000 + k) for k in range(n)}
    assert K.matches(a.limit(0), b, shared).count() == 0 and K.matches(a, b.limit(0), shared).count() == 0


def test_near_places_equal_brute_force(spark):
    from leadspark.llm.common import edit_distance

    r = random.Random(4)
    towns, streets = ["roslenfeld", "ostsketal"], ["hauptgasse", "hafenweg"]

    def typo(s):
        for _ in range(r.randrange(3)):
            k = r.randrange(len(s))
            s = s[:k] + r.choice(["", "x", s[k] + "y"]) + s[k + 1 :]
        return s

    a, b = ([f"{typo(r.choice(towns))}|{r.choice('17')}|{typo(r.choice(streets))}" for _ in range(120)] for _ in "ab")
    got = {tuple(x) for x in K.near_places(*[spark.createDataFrame([(p,) for p in [*d, ""]], "place string") for d in (a, b)]).collect()}
    want = {(p, q) for p in a for q in b if p != q and p.split("|")[1] == q.split("|")[1] and edit_distance(p, q, 3) <= 3}
    assert got == want and want


def test_near_places_meet_whatever_the_names(spark):
    lead = "source_row_id long, business_name string, address string, city string, phone_e164 string, website_domain string, duplicate_group_id long"
    org = "org_id long, org_name string, org_address string, org_phone string, org_website string"
    n = 60
    name = lambda k: f"Foo{chr(97 + k % 26)}{chr(97 + k // 26)}bar"
    leads = [(k, f"Café {name(k)}", f"Hauptgasse {k + 1}, 10000 Roslenfeld", "Roslenfeld", f"+4930555{k:05d}", f"foo{k}.example", None) for k in range(n)]
    # no phone and no host, and a name whose raw trigrams differ
    orgs = [(1000 + k, f"Cafe {name(k)} GmbH", f"Hauptgasse {k + 1}, 10000 Roslenfeld", f"030555{k:05d}", f"foo{k}.example") for k in range(40)]
    orgs += [(1000 + k, f"{name(k).upper()} CAFÉ GmbH & Co. KG, Roslenfeld", f"Hauptgase {k + 1}, Roslenfeldt", None, None) for k in range(40, n)]
    a, b = spark.createDataFrame(leads, lead), spark.createDataFrame(orgs, org)
    all_ = K.records(a, b, spark.createDataFrame([], "domain string"))
    near = K.near_places(all_.where("not is_org"), all_.where("is_org")).count()
    met = all_.where("not is_org").select("place").join(all_.where("is_org").select("place"), "place").count()
    assert near + met == n
