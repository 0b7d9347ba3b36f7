from pathlib import Path

import pytest
from conftest import rows

from evenframe.plans import (
    NOT_FOUND,
    REPORT_COLUMNS,
    ProfileSpec,
    TableSpec,
    profile_suite,
    run_suite,
    session_settings,
    shuffle_partitions,
)
from evenframe.operators import profile_table
from evenframe.sources import (
    BAR_DOLLAR,
    CRM_SCHEMA,
    RECORD_SEPARATOR,
    read_delimited,
    write_delimited,
    write_profile,
)


def test_a_failing_table_leaves_the_others_alone(spark, folder):
    good = spark.createDataFrame([(1, "a")], "k int, v string")

    def breaks():
        return good.selectExpr("assert_true(k > 1) AS k", "v")

    specs = [
        TableSpec("first", lambda: good, lambda: good),
        TableSpec("missing", lambda: good, lambda: read_delimited(spark, f"{folder}/none")),
        TableSpec("second", lambda: good, lambda: good),
        TableSpec("narrow", lambda: good, lambda: good.drop("v")),
        TableSpec("broken", lambda: good, breaks),
        TableSpec("third", lambda: good, lambda: good.limit(0)),
    ]
    for at_once in (1, 4):
        report = run_suite(spark, specs, at_once)
        assert report.columns == list(REPORT_COLUMNS["rows"])
        assert {f.dataType.simpleString() for f in report.schema.fields} == {"string"}
        got = [r.asDict() for r in report.collect()]
        assert [r["Table"] for r in got] == [s.table for s in specs]
        assert [r["Status"] for r in got] == [
            "Passed", NOT_FOUND, "Passed", "Failed", "Failed", "Failed",
        ]
        assert "PATH_NOT_FOUND" in got[1]["Details"]
        assert got[1]["Expected rows"] == "-1" and got[1]["Actual columns"] == "-6"
        assert got[3]["Details"].startswith("File Structure error")
        assert got[4]["Details"] != "" and got[4]["Expected rows"] == "-1"
        assert got[5]["Expected minus Actual count"] == "1"


def test_profile_layout(spark):
    schema = "Profile string, TOTAL_ROW_COUNT int, X int"
    one = spark.createDataFrame([("Profile", 3, 1)], schema)
    two = spark.createDataFrame([("Profile", 3, 2)], schema)
    report = run_suite(
        spark,
        [
            TableSpec("a", lambda: one, lambda: one, profiles=True),
            TableSpec("b", lambda: one, lambda: two, profiles=True),
            TableSpec("c", lambda: one, lambda: two.drop("TOTAL_ROW_COUNT"), profiles=True),
        ],
    )
    got = {r["Table"]: r for r in report.collect()}
    assert got["a"]["Status"] == "Passed" and got["a"]["Expected rows"] == "3"
    assert got["b"]["Mismatching columns"] == "X"
    assert got["c"]["Status"] == "Failed"


def test_layouts_do_not_mix(spark):
    df = spark.range(1)
    specs = [
        TableSpec("a", lambda: df, lambda: df),
        TableSpec("b", lambda: df, lambda: df, {"mode": "one_way"}),
    ]
    with pytest.raises(ValueError, match="layout"):
        run_suite(spark, specs)


def test_keyed_layout(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    report = run_suite(spark, [TableSpec("a", lambda: df, lambda: df, {"keys": ["k"]})])
    assert report.first()["Latest Distinct Actual Count"] == "1"


def test_profile_suite(spark, folder):
    df = spark.createDataFrame([("1", "x")], "Id string, SystemModstamp string")
    dictionary = spark.createDataFrame([("t", "Id", "Id")], CRM_SCHEMA)
    wrong = spark.createDataFrame([("t", "gone", "Id")], CRM_SCHEMA)
    options = {"rules": "crm", "latest_keys": ["Id"]}
    report = profile_suite(
        spark,
        [
            ProfileSpec("bad", lambda: df, wrong, options),
            ProfileSpec("good", lambda: df, dictionary, options),
        ],
        lambda table: f"{folder}/{table}",
    )
    assert [(r["Table"], r["Status"]) for r in report.collect()] == [
        ("bad", "Failed"), ("good", "Passed"),
    ]
    assert not Path(folder, "bad").exists()
    assert rows(read_delimited(spark, f"{folder}/good")) == [("Profile", "1", "x", "1", "1")]


def test_session_settings():
    assert shuffle_partitions(10) == 8
    assert shuffle_partitions(2**40) == 4096
    assert shuffle_partitions(200 * 2**40) == 65_536
    small, big = session_settings(2**40), session_settings(200 * 2**40)
    assert small["spark.sql.shuffle.partitions"] == "4096"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * 2**20)
    assert int(big["spark.sql.files.maxPartitionBytes"]) > 10**9


def test_profiles_written_read_back_and_compared(spark, folder):
    """Profile both copies to files, each side's own format, and compare the files."""
    expected = spark.createDataFrame(
        [("1", "x", "1.25", "2024-01-01 10:00:00"), ("1", "y", "2.50", "2024-01-02 10:00:00"),
         ("2", None, None, "2024-01-01 10:00:00")],
        "Id string, txt string, amount string, SystemModstamp string",
    )
    dictionary = spark.createDataFrame(
        [("t", "Id", "Id"), ("t", "txt", "Text(10)"), ("t", "amount", "Number(18, 2)")],
        CRM_SCHEMA,
    )
    options = {"rules": "crm", "latest_keys": ["Id"]}

    def files(actual):
        source = profile_table(expected, dictionary, **options)
        write_delimited(source.coalesce(1), f"{folder}/e", BAR_DOLLAR, RECORD_SEPARATOR)
        write_profile(profile_table(actual, dictionary, **options), f"{folder}/a")
        return TableSpec(
            "t",
            lambda: read_delimited(
                spark, f"{folder}/e", BAR_DOLLAR, RECORD_SEPARATOR, infer=True
            ),
            lambda: read_delimited(spark, f"{folder}/a", infer=True),
            profiles=True,
        )

    same = run_suite(spark, [files(expected.repartition(3))]).first()
    assert (same["Status"], same["Expected rows"]) == ("Passed", "2")
    changed = expected.withColumn("amount", expected.amount.cast("decimal(9,2)") + 1)
    changed = changed.withColumn("amount", changed.amount.cast("string"))
    other = run_suite(spark, [files(changed)]).first()
    assert (other["Status"], other["Mismatching columns"]) == ("Failed", "SUM_amount")
