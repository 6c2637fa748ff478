import glob
import os

import pytest

from millrace.llm import queries

SMALL = "/root/testdata/sf0.001"
#: The smallest tables have 11 sites, too few for each to have a twentieth.
FOLDER = {"p6_share": "/root/testdata/sf0.01"}
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")

#: Columns the results must have, with their kinds.
COLUMNS = {
    "p1_found": "field string, row_id bigint", "p2_found": "page_id bigint, line_no int", "p3_found": "field string, row_id bigint", "p4_found": "page_id bigint, line_no int",
    "p5_found": "pair_id bigint", "p6_found": "pair_id bigint", "p7_found": "keep_id bigint, dup_id bigint", "p8_ids": "doc_id bigint, ids array<int>", "p10_found": "doc_id bigint, subject string",
}


def test_each_problem_has_queries():
    assert {int(n[1:].split("_")[0]) for n in queries.queries()} == set(range(1, 11))
    assert set(COLUMNS) <= set(queries.queries()) and set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_runs_and_has_its_columns(spark, name):
    df = queries.queries()[name](spark, FOLDER.get(name, SMALL))
    rows = df.collect()
    if name in COLUMNS:
        assert ", ".join(f"{n} {k}" for n, k in df.dtypes) == COLUMNS[name]
        assert all(x is not None for r in rows for x in r)
    if name.endswith("_found"):
        assert len(set(rows)) == len(rows) > 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    folder = FOLDER.get(name, SMALL)
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.execute(queries.oracle_sql()[name]).to_arrow_table().to_pylist()
    got = [r.asDict() for r in queries.queries()[name](spark, folder).collect()]
    assert sorted(map(repr, (sorted(r.items()) for r in got))) == sorted(map(repr, (sorted(r.items()) for r in want)))
