import importlib
import os

import pytest

ENTRY = importlib.import_module("__spark_entry__")
SMALL = "/root/testdata/sf0.001"


def test_names():
    assert set(ENTRY.oracle_sql()) <= set(ENTRY.queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", sorted(n for n in ENTRY.oracle_sql() if not n.startswith("p")or not n[1].isdigit()))
def test_against_sql(spark, name):
    import glob

    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.execute(ENTRY.oracle_sql()[name]).to_arrow_table().to_pylist()
    got = [r.asDict() for r in ENTRY.queries()[name](spark, SMALL).collect()]
    rounded = lambda rows: sorted(repr(sorted((k, round(v, 6) if isinstance(v, float) else v) for k, v in r.items())) for r in rows)
    assert rounded(got) == rounded(want)
