"""Problem 9."""

import math
import os

import pytest
from pyspark.sql import functions as F

from leadspark.llm import mixing as M

pytestmark = pytest.mark.skipif(not os.path.exists(M.TOKENIZER), reason="no tokenizer")


@pytest.fixture
def docs(spark):
    rows = [(k, f"small source text number {k} " * 3, "small") for k in range(20)] + [(100 + k, f"a large source has many different words such as {k} and {k * 7} " * 2, "large") for k in range(300)]
    rows += [(900, "small source text number 3 " * 3, "small"), (901, None, "small"), (902, "", "large"), (903, "unlisted", "other"), (904, "no source", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_shares_and_repeats(spark, docs):
    targets = spark.createDataFrame([("small", 0.3, 4), ("large", 0.7, 1), ("none", 0.0, 9)], "source string, target_share double, max_repeats int")
    mixture, shares = M.mix(docs, targets)
    got = {r.source: r for r in shares.collect()}
    assert set(got) == {"small", "large"} and abs(got["small"].actual_share - 0.3) < 0.02 and sum(r.actual_share for r in got.values()) == pytest.approx(1, abs=1e-5)
    m = mixture.collect()
    assert max(r.repeats for r in m if r.source == "small") <= 4 and max(r.repeats for r in m if r.source == "large") == 1
    small = {r.repeats for r in m if r.source == "small"}
    assert small <= {got["small"].epochs, got["small"].epochs + 1}  # complete epochs, then a part of one
    ids = [r.doc_id for r in m]
    assert len(ids) == len(set(ids)) and 900 not in ids and 901 not in ids and 903 not in ids
    for s, r in got.items():
        assert sum(x.tokens * x.repeats for x in m if x.source == s) == r.used_tokens <= r.budget
    assert sorted(map(tuple, M.mix(docs, targets)[0].collect())) == sorted(map(tuple, m))  # the same again


def test_prefix_equals_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(M, "PIECE", 30)
    targets = spark.createDataFrame([("large", 1.0, 1)], "source string, target_share double, max_repeats int")
    mixture, _ = M.mix(docs, targets, total=2000)
    texts = M.sized(docs).where("source = 'large'").withColumn("u", (F.pmod(F.xxhash64("text_hash", F.lit(42)), F.lit(2**52)) + 0.5) / float(2**52)).collect()
    total, want = 0, set()
    for t in sorted(texts, key=lambda t: (-math.log(t.u) / t.quality, t.text_hash)):
        total += t.tokens
        if total <= 2000:
            want.add(t.doc_id)
    assert {r.doc_id for r in mixture.collect()} == want


def test_better_texts_come_first(spark):
    rows = [(k, f"various words {k} make better prose than others do {k * 3}", "s") for k in range(150)] + [(1000 + k, f"bad {k} " + "bad " * 14, "s") for k in range(150)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    t = spark.createDataFrame([("s", 1.0, 1)], "source string, target_share double, max_repeats int")
    ids = [r.doc_id for r in M.mix(d, t, total=1500)[0].collect()]
    assert sum(i < 1000 for i in ids) > 2 * sum(i >= 1000 for i in ids)


def test_nothing(spark, docs):
    t = spark.createDataFrame([("s", 1.0, 1)], "source string, target_share double, max_repeats int")
    mixture, shares = M.mix(docs.limit(0), t)
    assert mixture.count() == 0 and shares.first().used_tokens == 0
