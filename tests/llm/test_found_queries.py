"""The pN_ queries over the smallest tables: columns as agreed, no row twice, and SQL where there is some."""

import os

import duckdb
import pytest

from leadspark.llm.queries import QUERIES
from leadspark.llm.sql import ORACLE

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
COLUMNS = {
    "p1_found": ["source_row_id_a", "source_row_id_b"], "p2_found": ["field_name", "source_row_id_a", "source_row_id_b"], "p3_found": ["source_row_id", "field_name"], "p4_found": ["source_row_id", "ref_id"], "p5_found": ["source_row_id", "group_id"], "p6_found": ["source_row_id", "org_id"],
    "p7_found": ["duplicate_group_id", "field_name", "source_row_id"], "p8_found": ["doc_id", "item_id"], "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    d = QUERIES[name](spark, SF)
    rows = d.collect()
    if name in COLUMNS:
        assert d.columns == COLUMNS[name] and len(rows) == len(set(rows))
        if "source_row_id_a" in d.columns:
            assert all(r.source_row_id_a < r.source_row_id_b for r in rows)
    if name in ORACLE:
        c = duckdb.connect()
        for f in os.listdir(SF):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
        got = c.execute(ORACLE[name]).df()
        assert sorted(map(tuple, rows)) == sorted(map(tuple, got[d.columns].itertuples(index=False)))
