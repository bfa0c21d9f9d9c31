"""Problem 7."""

import pytest
from pyspark.sql import functions as F

from leadspark.llm import survivors as S

COLUMNS = "duplicate_group_id long, source_row_id long, source_file string, enriched_at timestamp_ntz, address string, business_name string, decision_maker_name string, phone_e164 string, website_domain string"


@pytest.fixture
def leads(spark):
    rows = [
        (1, 10, "good", "2025-01-01 00:00:00", "A 1", "Bäckerei A", None, "+4930123456789", "a.de"),
        (1, 11, "good", "2025-02-01 00:00:00", "A 1", "BÃ¤ckerei A", "n/a", "+1111111111", "n/a"),
        (1, 12, "bad", "2025-03-01 00:00:00", "B 2", "Other", "Eva", "+4930999999123", ""),
        (2, 20, "none", "2025-01-01 00:00:00", None, "", None, "0", "www"),
        (3, 31, "good", "2025-01-01 00:00:00", "C", "C", "C", None, None),
        (3, 30, "good", "2025-01-01 00:00:00", "D", "D", None, None, None),
        (None, 40, "good", "2025-01-01 00:00:00", "Z", "Z", "Z", "+4930123456788", "z.de"),
    ]
    d = spark.createDataFrame(rows, COLUMNS.replace("timestamp_ntz", "string"))
    return d.withColumn("enriched_at", F.col("enriched_at").cast("timestamp_ntz"))


def test_kept(spark, leads):
    trust = spark.createDataFrame([("good", 5), ("bad", 1)], "source_file string, trust_level int")
    got = {(r.group_id, r.field_name): r.id for r in S.survivors(leads, trust).collect()}
    # trust first, then time, then the smaller id; damaged and missing values never
    assert got == {(1, "address"): 11, (1, "business_name"): 10, (1, "decision_maker_name"): 12, (1, "phone_e164"): 10, (1, "website_domain"): 10, (3, "address"): 30, (3, "business_name"): 30, (3, "decision_maker_name"): 31}
    assert S.survivors(leads.limit(0), trust).count() == 0
    assert {r.id for r in S.survivors(leads, trust.limit(0)).where("field_name = 'address' and group_id = 1").collect()} == {12}  # latest, where all trust is 0


def test_model_tells_good_sources_from_bad(spark):
    import random

    r = random.Random(1)
    rows = []
    for g in range(150):
        for s, right in (("a", 0.95), ("b", 0.9), ("c", 0.9), ("liar", 0.3)):
            rows.append((g, "f", s, "true" if r.random() < right else f"false{r.randrange(3)}", g * 10, 0, None))
    d = spark.createDataFrame([x[:5] for x in rows], "group_id long, field_name string, source string, value string, id long")
    known, quality = S.judge(S.facts(d))
    assert quality["a"][0] > quality["liar"][0] + 0.2
    p = {(x.group_id, x.statement): x.probability for x in known.collect()}
    true, false = [v for k, v in p.items() if k[1] == "true"], [v for k, v in p.items() if k[1] != "true"]
    assert sum(v > 0.5 for v in true) / len(true) > 0.9 and sum(v < 0.5 for v in false) / len(false) > 0.85
