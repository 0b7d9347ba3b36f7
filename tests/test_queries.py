"""Every registered query against its SQL on the smallest tables."""

import math
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_file

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")

def reconciliation(named):
    """The queries of this package's core; the others have tests of their own."""
    return {n: q for n, q in named.items() if not re.match(r"op\d+_|pipeline$", n)}


QUERIES = reconciliation(entry_file.queries())
ORACLE = reconciliation(entry_file.oracle_sql())


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def comparable(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v

    lines = [tuple(value(line[i]) for i in order) for line in data]
    return [columns[i] for i in order], sorted(lines, key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, database, name):
    df = QUERIES[name](spark, str(FOLDER))
    cursor = database.execute(ORACLE[name])
    wanted = comparable([d[0] for d in cursor.description], cursor.fetchall())
    assert comparable(df.columns, [tuple(r) for r in df.collect()]) == wanted


def test_entry(spark):
    assert entry_file.entry(spark).count() == 1
