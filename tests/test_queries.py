"""Every registered query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from terracover.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are absent")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return repr(float(v)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    df = registry.QUERIES[name](spark, SF)
    found = db.execute(registry.ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    rows = [tuple(plain(r[columns.index(c)]) for c in df.columns) for r in found.fetchall()]
    assert sorted(map(str, (tuple(plain(v) for v in r) for r in df.collect()))) == sorted(map(str, rows))


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(registry.QUERIES) <= set(entry.queries())


def test_import_needs_no_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    assert subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, capture_output=True).returncode == 0
