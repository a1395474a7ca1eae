"""Every registered query of the subpackage on the smallest tables, with its SQL where there is one."""

import duckdb
import pytest

from sieveline.llm.queries import ORACLE, QUERIES

COLUMNS = {"p1_found": ["name_a", "name_b"], "p2_found": ["delivery_seq", "field"], "p3_found": ["candidate_id", "group_id"], "p4_found": ["delivery_seq", "venue_id"], "p5_found": ["candidate_id_a", "candidate_id_b"], "p7_found": ["group_id", "field", "delivery_seq"], "p8_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id", "reading_level"]}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    df = QUERIES[name](spark, sf)
    rows = df.collect()
    assert rows and df.columns == COLUMNS.get(name, df.columns)
    if name.endswith("found"):
        assert len(set(rows)) == len(rows)
    if name in ORACLE:
        con = duckdb.connect()
        con.execute(f"CREATE VIEW candidate_pair AS SELECT * FROM '{sf}/candidate_pair.parquet'")
        cur = con.execute(ORACLE[name])
        columns = [c[0] for c in cur.description]
        assert {tuple(r[c] for c in columns) for r in rows} == set(cur.fetchall())
