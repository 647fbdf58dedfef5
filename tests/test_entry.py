import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from checks.catalog import QUERIES
from checks.oracle import ORACLE

DATA = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "events"]
LIGHT = ["units_page", "unlocated_rollup", "unlocated_tree", "pon_id_stored_mode", "grid_clusters", "metric_long", "upsert_units"]


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_a_missing_library_leaves_the_other_queries():
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') and n[2].isdigit() for n in e.queries()))"
    root = os.path.dirname(os.path.abspath(entry.__file__))
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert out == [str(len(QUERIES)), "False"]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
@pytest.mark.parametrize("name", LIGHT)
def test_columns_and_row_count(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    result = con.execute(ORACLE[name])
    columns = sorted(c[0] for c in result.description)
    theirs = result.fetchall()
    df = entry.queries()[name](spark, DATA)
    assert sorted(df.columns) == columns
    assert df.count() == len(theirs) > 0
