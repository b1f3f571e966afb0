"""The registered queries against their SQL, on the smallest driver tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("ENTRY_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
# The queries of basketweave.llm and the pipeline have tests of their own.
OTHERS = re.compile(r"op\d+_|pipeline$")
QUERIES = {n: q for n, q in entry.queries().items() if not OTHERS.match(n)}
ORACLES = {n: q for n, q in entry.oracle_sql().items() if not OTHERS.match(n)}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not found")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["antecedent", "consequent"]


# The `_dense` rows take minutes here and are compared by the driver.
@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if not n.endswith("_dense")])
def test_query_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(found.columns) == sorted(names)
    expected = sorted(map(str, result.fetchall()))
    assert sorted(str(tuple(r[n] for n in names)) for r in found.collect()) == expected
