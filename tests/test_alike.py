"""All pairs of alike names and addresses against brute force."""

import random
import time

import pytest
from pyspark.sql import functions as F

from leadspark.operators import dedupe

WORDS = ["backerei", "schmidt", "cafe", "central", "muller", "haus", "garten", "adler", "日本", "ñandú", "x" * 70, "a\0b"]


def rows(n, seed):
    r = random.Random(seed)
    out = []
    for k in range(n):
        t = " ".join(r.choice(WORDS if r.random() < 0.1 else WORDS[:8]) for _ in range(r.choice((1, 2, 3))))
        if r.random() < 0.4:
            j = r.randrange(len(t))
            t = t[:j] + r.choice("abcxyz") + t[j + 1 :]
        a = f"{r.choice(('hauptstr', 'bahnhofstr', 'am markt'))} {r.randrange(40)} {r.choice(('10115 berlin', '20095 hamburg', 'köln', ''))}"
        a = a * 5 if r.random() < 0.03 else "\0" + a if r.random() < 0.03 else a
        out.append((k, " ".join(sorted(t.split())), a, r.random() < 0.5))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("most", [1000, 60])
def test_all_pairs_equal_brute_force(spark, most):
    """In one group of blocks and in many; long texts, texts with NUL, any script, rows that a key linked."""
    have = rows(300, most)
    want = sorted((x[0], y[0]) for x in have for y in have if x[0] < y[0] and x[3] and dedupe.name_address_score(*x[1:3], *y[1:3]) >= dedupe.LEAST)
    d = spark.createDataFrame(have, "i long, n string, a string, o boolean").withColumn("l", F.length("n"))
    assert sorted(map(tuple, dedupe.all_pairs(d, most).collect())) == want and want


def test_no_rows(spark):
    d = spark.createDataFrame([], "source_row_id long, business_name string, address string")
    assert dedupe.fuzzy_edges(d, spark.createDataFrame([], "id long")).count() == 0


def test_many_rows_end_in_time(spark):
    """16,000 names of equal length and different letters, with one pair planted: 128 million pairs to leave out."""
    r = random.Random(1)
    have = [(k, "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=24)), f"weg {k}") for k in range(16_000)]
    have.append((16_000, have[5][1], "weg 5"))
    d = spark.createDataFrame(have, "source_row_id long, business_name string, address string")
    t = time.perf_counter()
    assert (5, 16_000) in {(x.a, x.b) for x in dedupe.fuzzy_edges(d, spark.createDataFrame([], "id long")).collect()}
    assert time.perf_counter() - t < 60


def test_whole_deduplication_of_many_rows_ends_in_time(spark):
    r = random.Random(2)
    have = [(k, "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=24)), f"weg {k}", None, None) for k in range(16_000)]
    have += [(16_000, have[5][1], "weg 5", "+4930123456", None), (16_001, "other", "platz 1", "+4930123456", None)]
    d = spark.createDataFrame(have, "source_row_id long, business_name string, address string, phone_e164 string, website_domain string")
    t = time.perf_counter()
    got = {x.id for x in dedupe.groups(d).where("component = 5").collect()}
    assert got == {5, 16_000, 16_001} and time.perf_counter() - t < 90
