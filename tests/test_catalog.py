"""Every registered query against its SQL, run by an embedded engine on the same files."""

import importlib.util
import math
import os
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
SF_DIR = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")

spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


# Spark type and the SQL side's name for it.
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def table(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(entry.CATALOG))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(entry.oracle_sql()[name])
    want = table([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    kinds = {r[0]: r[1] for r in db.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()}
    assert {n: KINDS[k] for n, k in df.dtypes} == kinds
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert got[1], "the query finds nothing"


def test_entry(spark):
    assert entry.entry(spark).count() > 0
