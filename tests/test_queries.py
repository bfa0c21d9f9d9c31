"""Every query runs, and equals its SQL, on the smallest tables; plans of the pure projections hold no Python."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
CORE = entry.core.QUERIES


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return c


def norm(df):
    df = df[sorted(df.columns)]
    text = lambda x: "" if x is None or x != x else f"{x:.6g}" if isinstance(x, float) else str(x)
    return list(df.columns), sorted(re.sub(r"(?<=\d)\.0(?=\||$)", "", "|".join(map(text, r))) for r in df.astype(object).where(df.notna(), None).values.tolist())


@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, db, name):
    got = CORE[name](spark, SF).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql:
        assert norm(got) == norm(db.execute(sql).df())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["clean_leads", "completeness_scores", "size_estimates", "cache_lookup", "verify_mails"])
def test_no_python_in_plan(spark, name):
    plan = CORE[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapInArrow", plan)


def test_filters_and_columns_reach_the_scan(spark):
    plan = CORE["report_top_rows"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lead_quality_score,70)" in plan and "business_name" not in plan.split("ReadSchema")[1]
