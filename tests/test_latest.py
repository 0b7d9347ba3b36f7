import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from evenframe.operators import distinct_key_count, latest_by, latest_cdc
from evenframe.operators.numbering import number_rows
from evenframe import LatestBy, compare
from evenframe.plans.presets import (
    FACT_KEYS,
    FACT_ORDER,
    LEDGER_CHANGED_AT,
    LEDGER_KEYS,
    LEDGER_OPERATION,
)


def ledger(spark, changes):
    schema = ", ".join(f"{k} string" for k in LEDGER_KEYS)
    schema += f", `{LEDGER_OPERATION}` string, {LEDGER_CHANGED_AT} string"
    return spark.createDataFrame(
        [("L", "C", "2023", doc, "1", op, at) for doc, op, at in changes], schema
    )


def test_operation_outranks_recency(spark):
    df = ledger(
        spark,
        [
            ("a", "D", "1"), ("a", "U", "9"), ("a", "I", "0"),
            ("b", "U", "1"), ("b", "U", "3"), ("b", None, "9"),
            ("c", "X", "1"), ("c", None, "2"),
            (None, "I", "1"), (None, "I", "2"),
            ("d", "I", None), ("d", "I", "1"),
        ],
    )
    got = latest_cdc(df, LEDGER_KEYS, LEDGER_OPERATION, LEDGER_CHANGED_AT)
    assert got.columns == df.columns
    short = got.select("AccountingDocument", f"`{LEDGER_OPERATION}`", LEDGER_CHANGED_AT)
    assert rows(short) == sorted(
        [("a", "D", "1"), ("b", "U", "3"), ("c", None, "2"), (None, "I", "2"), ("d", "I", "1")],
        key=repr,
    )
    assert distinct_key_count(df, LEDGER_KEYS).first()[0] == got.count() == 5


SCHEMA = "k int, ts int, v string"
VERSIONS = [
    (1, 10, "a"), (1, 20, "b"), (1, 20, "c"), (2, None, "d"), (2, 5, "e"),
    (3, None, "f"), (3, None, "g"), (None, 1, "h"), (None, 2, "i"),
]


def test_all_ties_equal_rank(spark):
    df = spark.createDataFrame(VERSIONS, SCHEMA)
    df.createOrReplaceTempView("versions")
    wanted = spark.sql(
        "SELECT k, ts, v FROM (SELECT *, rank() OVER (PARTITION BY k ORDER BY ts DESC) AS r "
        "FROM versions) WHERE r = 1"
    )
    assert rows(latest_by(df, ["K"], "TS", ties="all")) == rows(wanted)
    assert rows(wanted.where("k = 1")) == [(1, 20, "b"), (1, 20, "c")]


def test_all_ties_over_two_order_columns(spark):
    df = spark.createDataFrame(
        [(1, 1, None), (1, 1, "x"), (1, 1, "x"), (2, None, None), (2, None, None)], SCHEMA
    )
    got = latest_by(df, ["k"], ["ts", "v"], ties="all")
    assert rows(got) == rows(df.where("v IS NOT NULL OR k = 2"))


def test_one_is_stable(spark):
    df = spark.createDataFrame(VERSIONS, SCHEMA)
    wanted = [(1, 20, "b"), (2, 5, "e"), (3, None, "f"), (None, 2, "i")]
    for parts in (1, 3, 8):
        got = latest_by(df.repartition(parts), ["k"], "ts", ties="one")
        assert rows(got) == sorted(wanted, key=repr)
    got = latest_by(df, ["k"], "ts", tie_break=["v"])
    assert (1, 20, "c") in rows(got)


def test_group_limit_runs_before_the_shuffle(spark):
    df = spark.createDataFrame(VERSIONS, SCHEMA)
    plan = latest_by(df, ["k"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_keep_rank(spark):
    df = spark.createDataFrame(VERSIONS, SCHEMA)
    got = latest_by(df, ["k"], "ts", tie_break=["v"], keep_rank="cnt")
    assert got.count() == len(VERSIONS)
    assert (1, 20, "c", 1) in rows(got) and (1, 20, "b", 2) in rows(got)


def test_numbers_of_hot_keys_equal_the_window(spark):
    rng = random.Random(1)
    data = [(rng.choice([1, 1, 1, 2, 3, None]), rng.randint(0, 5), "x") for _ in range(600)]
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    ranking = [F.col("ts").desc(), F.col("v").asc()]
    plain = number_rows(df, ["k"], ranking, "n")
    split = number_rows(df, ["k"], ranking, "n", rows_per_task=40)
    # equal rows share their numbers out in any order, so the multisets are equal
    assert rows(split) == rows(plain)
    assert split.schema == plain.schema


def test_arguments(spark):
    df = spark.createDataFrame(VERSIONS, SCHEMA)
    with pytest.raises(ValueError):
        latest_by(df, [], "ts")
    with pytest.raises(ValueError):
        latest_by(df, ["nope"], "ts")
    with pytest.raises(ValueError):
        latest_by(df, ["k"], "ts", ties="some")
    with pytest.raises(ValueError):
        latest_by(df, ["k"], "ts", ties="all", keep_rank="cnt")
    with pytest.raises(ValueError):
        latest_by(df, ["k"], "ts", keep_rank="V")
    with pytest.raises(ValueError):
        latest_cdc(df, [], "v", "ts")


@pytest.mark.parametrize("table", list(FACT_KEYS))
def test_fact_tables_against_their_newest_version(spark, table):
    """The files keep old versions; the source has the newest only, ties included."""
    keys = FACT_KEYS[table]
    versions = spark.range(40).select(
        *[(F.col("id") % (2 + i % 2)).alias(k) for i, k in enumerate(keys)],
        F.col("id").cast("decimal(18,2)").alias("amt_meas1"),
        F.expr("TIMESTAMP_NTZ'2024-01-01' + make_interval(0, 0, 0, int(id / 13))").alias("DTEMOD"),
    )
    groups = {}
    for r in versions.collect():
        groups.setdefault(tuple(r[k] for k in keys), []).append(tuple(r))
    newest = [
        r
        for group in groups.values()
        for r in group
        if r[-1] == max(other[-1] for other in group)
    ]
    source = spark.createDataFrame(newest, versions.schema).toDF(
        *[c.lower() for c in versions.columns]
    )
    got = compare(source, versions, table, latest=LatestBy(keys, FACT_ORDER)).first()
    assert (got["Status"], got["Actual rows"]) == ("Passed", str(len(newest)))
    plain = compare(source, versions, table).first()
    assert plain["Status"] == "Failed" and len(newest) < 40


def test_tied_rows_of_a_hot_key_are_split(spark, folder):
    """A third of all rows share one key and the latest time of it."""
    data = spark.range(0, 600_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
        F.lit("2024-01-01").alias("ts"),
        F.sha1(F.col("id").cast("string")).alias("v"),
    )
    data.write.parquet(f"{folder}/hot")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        latest = latest_by(spark.read.parquet(f"{folder}/hot"), ["k"], "ts", ties="all")
        assert len(latest.toPandas()) == 600_000
        plan = latest._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def scans(df):
    """Reads of files in the plan; a shuffle that is used again is not read again."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return text.split("\n(1) ")[0].split("== Initial Plan ==")[0].count("Scan parquet")


def hot_rows(spark, folder):
    made = spark.range(4000).selectExpr(
        "IF(id % 3 = 0, NULL, id % 50) AS k",
        "IF(id % 3 = 0, 9, id % 7) AS t",
        "IF(id % 2 = 0, 0, id) AS v",
    )
    made.repartition(16).write.parquet(f"{folder}/hot")
    return spark.read.parquet(f"{folder}/hot")


@pytest.mark.parametrize("salts", [1, 4])
def test_ties_come_from_one_read(spark, folder, salts):
    df = hot_rows(spark, folder)
    got = latest_by(df, ["k"], "t", ties="all", salts=salts)
    best = {}
    for k, t, _ in df.collect():
        best[k] = max(best.get(k, -1), t)
    assert rows(got) == rows(df.where("false")) + sorted((r for r in rows(df) if r[1] == best[r[0]]), key=repr)
    assert got.columns == ["k", "t", "v"]
    got.collect()
    assert scans(got) == 1
    both = latest_by(df.union(df), ["k"], ["t", "v"], ties="all", salts=salts)
    both.collect()
    assert scans(both) == 2


def test_salts_spread_the_tied_rows_of_a_key(spark, folder):
    df = hot_rows(spark, folder).withColumn("place", F.col("v"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for salts, spread in ((1, False), (4, True)):
            hot = latest_by(df, ["k"], "t", ties="all", salts=salts).where("k IS NULL")
            places = hot.groupBy(F.spark_partition_id()).count().count()
            assert (places > 1) == spread
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
