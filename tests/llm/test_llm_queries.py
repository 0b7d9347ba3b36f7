"""The registered queries against their SQL, and the pipeline's stages, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from evenframe.llm import queries

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query(spark, name):
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = queries.QUERIES[name](spark, str(FOLDER))
    cursor = connection.execute(queries.ORACLE_SQL[name])
    wanted = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(wanted)
    assert sorted(map(tuple, df.select(wanted).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        kept = stage(spark, docs, str(FOLDER))
        assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        kept.write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    rows = docs.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) and all(len(r["text"]) <= len(texts[r["doc_id"]]) for r in rows)
    packed = corpus_pipeline.run(spark, str(FOLDER)).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in rows}
