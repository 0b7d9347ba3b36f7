import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from evenframe import LatestBy, compare, compare_profiles
from evenframe.operators import StructureError, align, diff_rows, labelled_diff
from evenframe.plans import compare_totals
from evenframe.plans.reports import REPORT_COLUMNS

NAN = float("nan")


def report(df):
    found = df.collect()
    assert len(found) == 1
    return found[0].asDict()


def random_rows(rng, n):
    return [
        (
            rng.choice([1, 2, 3, None]),
            rng.choice(["a", "b", None, ""]),
            rng.choice([0.0, -0.0, 1.5, NAN, None]),
        )
        for _ in range(n)
    ]


SCHEMA = "k int, t string, d double"


def random_pair(spark, seed):
    rng = random.Random(seed)
    left = random_rows(rng, rng.randint(0, 40))
    right = left[: rng.randint(0, len(left))] + random_rows(rng, rng.randint(0, 10))
    rng.shuffle(right)
    return spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)


@pytest.mark.parametrize("seed", range(4))
def test_totals_equal_counts_and_except_all(spark, seed):
    left, right = random_pair(spark, seed)
    got = compare_totals(left, right).first()
    assert tuple(got) == (
        left.count(),
        right.count(),
        left.exceptAll(right).count(),
        right.exceptAll(left).count(),
    )


@pytest.mark.parametrize("seed", range(3))
def test_diff_rows_equal_except_all(spark, seed):
    left, right = random_pair(spark, seed)
    for chunk in (1, 2, 100):
        got = diff_rows(align(left, right), copies_per_chunk=chunk)
        for side, wanted in (
            ("EXPECTED", left.exceptAll(right)),
            ("ACTUAL", right.exceptAll(left)),
        ):
            assert rows(got.where(F.col("side") == side).drop("side")) == rows(wanted)


@pytest.mark.parametrize("seed", range(2))
def test_labelled_diff_is_distinct(spark, seed):
    left, right = random_pair(spark, seed)
    got = labelled_diff(align(left, right))
    wanted = (
        left.subtract(right)
        .select(F.lit("EXPECTED").alias("side"), "*")
        .union(right.subtract(left).select(F.lit("ACTUAL").alias("side"), "*"))
    )
    assert rows(got) == rows(wanted)


def test_same_frame_passes_in_any_order_and_partitioning(spark):
    left, _ = random_pair(spark, 7)
    got = report(compare(left, left.orderBy(F.desc("t")).repartition(5), "t"))
    assert got["Status"] == "Passed" and got["Details"] == ""
    assert got["Expected minus Actual count"] == got["Actual minus Expected count"] == "0"
    assert list(got) == list(REPORT_COLUMNS["rows"])


def test_swapping_sides_swaps_the_differences(spark):
    left, right = random_pair(spark, 9)
    there, back = report(compare(left, right)), report(compare(right, left))
    assert there["Expected minus Actual count"] == back["Actual minus Expected count"]
    assert there["Expected rows"] == back["Actual rows"]


def test_copies_count(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    right = spark.createDataFrame([(1,), (2,), (2,)], "a int")
    got = report(compare(left, right))
    assert got["Status"] == "Failed"
    assert got["Expected minus Actual count"] == "1"
    assert got["Actual minus Expected count"] == "1"


def test_empty_sides(spark):
    none = spark.createDataFrame([], "a int")
    one = spark.createDataFrame([(None,)], "a int")
    assert report(compare(none, none))["Status"] == "Passed"
    got = report(compare(one, none))
    assert (got["Expected rows"], got["Actual rows"]) == ("1", "0")
    assert got["Expected minus Actual count"] == "1"


def test_distinct_keys_count_nulls_and_do_not_decide(spark):
    left = spark.createDataFrame([(1, "a"), (None, "a"), (None, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (None, "a"), (2, "b")], "k int, v string")
    got = report(compare(left, right, keys=["K"]))
    assert list(got) == list(REPORT_COLUMNS["keys"])
    assert got["Latest Distinct Expected Count"] == "2"
    assert got["Latest Distinct Actual Count"] == "3"
    same = report(compare(left, left, keys=["k"]))
    assert same["Status"] == "Passed"


def test_hot_row_and_hot_key(spark):
    """A third of all rows are copies of one row, another third share a key."""
    left = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 3 == 1, -2).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"),
    )
    right = left.where("v <> 1").unionByName(left.where("k = -1"))
    got = compare_totals(left, right, keys=["k"]).first().asDict()
    assert got == {
        "expected_rows": 30_000,
        "actual_rows": 39_999,
        "expected_minus_actual": 1,
        "actual_minus_expected": 10_000,
        "expected_keys": 10_002,
        "actual_keys": 10_002,
    }
    extra = diff_rows(align(left, right), copies_per_chunk=64)
    assert extra.count() == 10_001


def test_unequal_columns_are_a_structure_error(spark):
    left = spark.createDataFrame([(1, "a")], "k int, v string")
    right = spark.createDataFrame([(1,), (2,)], "k int")
    got = report(compare(left, right, "t"))
    assert got["Status"] == "Failed"
    assert got["Details"].startswith("File Structure error")
    assert "missing [v]" in got["Details"]
    assert (got["Expected rows"], got["Actual rows"]) == ("1", "2")
    assert (got["Expected columns"], got["Actual columns"]) == ("2", "1")
    assert got["Expected minus Actual count"] == "-3"
    assert got["Actual minus Expected count"] == "-4"
    keyed = report(compare(left, right, keys=["k"]))
    assert keyed["Latest Distinct Actual Count"] == "2"
    assert keyed["Actual minus Expected count"] == "-3"
    no_key = report(compare(left, right, keys=["v"]))
    assert no_key["Latest Distinct Expected Count"] == "1"
    assert no_key["Latest Distinct Actual Count"] == "-6"


def test_positions_count_unless_by_name(spark):
    left = spark.createDataFrame([(1, 2)], "a int, b int")
    right = spark.createDataFrame([(2, 1)], "B int, A int")
    assert report(compare(left, right))["Status"] == "Failed"
    assert report(compare(left, right, by="name"))["Status"] == "Passed"
    assert report(compare(left, right, columns=["a", "b"]))["Status"] == "Passed"
    with pytest.raises(StructureError):
        align(left, right.drop("A"), by="name")
    with pytest.raises(ValueError):
        align(left, right, by="ordinal")


def test_column_names_with_slashes_spaces_dots_and_repeats(spark):
    left = spark.createDataFrame([(1, "a", 2.0, 3)], ["/1DH/OPERATION", "Aging Segment", "a.b", "x`y"])
    assert report(compare(left, left, keys=["Aging Segment", "a.b"]))["Status"] == "Passed"
    twice = left.toDF("a", "a", "b", "b")
    assert report(compare(twice, twice))["Status"] == "Passed"
    assert diff_rows(align(twice, left.limit(0))).columns == ["side", "a", "a", "b", "b"]


def test_types_that_differ_meet_as_text_and_are_noted(spark):
    left = spark.createDataFrame([(1, "2")], "a int, b string")
    right = spark.createDataFrame([("1", 2)], "a string, b int")
    got = report(compare(left, right))
    assert got["Status"] == "Passed"
    assert "a: int and string compared as string" in got["Details"]
    bad = spark.createDataFrame([("x", 2)], "a string, b int")
    assert report(compare(left, bad))["Status"] == "Failed"


def test_numeric_widening_and_rounding(spark):
    ints = spark.createDataFrame([(1,)], "a int")
    longs = spark.createDataFrame([(1,)], "a bigint")
    assert report(compare(ints, longs))["Status"] == "Passed"
    near = spark.createDataFrame([(0.1 + 0.2,)], "a double")
    exact = spark.createDataFrame([(0.3,)], "a double")
    assert report(compare(near, exact))["Status"] == "Failed"
    assert report(compare(near, exact, decimals=9))["Status"] == "Passed"


def test_map_columns_compare(spark):
    left = spark.sql("SELECT map('a', 1, 'b', 2) AS m")
    right = spark.sql("SELECT map('b', 2, 'a', 1) AS m")
    assert report(compare(left, right))["Status"] == "Passed"


def test_one_way(spark):
    left = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    more = left.unionByName(left.limit(1))
    got = report(compare(left, more, "t", mode="one_way"))
    assert list(got) == list(REPORT_COLUMNS["profile"])
    assert got["Data Comparison"] == "Data matching"
    assert got["Status"] == "Failed"  # row counts differ
    assert got["Mismatching columns"] == "NA"
    changed = left.withColumn("w", F.col("w") + 1)
    got = report(compare(left, changed, "t", mode="one_way", keys=["k"]))
    assert got["Data Comparison"] == "Data mismatching"
    assert got["Mismatching columns"] == "w"
    assert report(compare(left, left, mode="one_way"))["Status"] == "Passed"
    broken = report(compare(left, left.drop("w"), mode="one_way"))
    assert broken["Data Comparison"] == "-3" and broken["Mismatching columns"] == "NA"


def test_versioned(spark):
    source = spark.createDataFrame([(1, "b", 20), (2, "c", 10)], "k int, v string, DTEMOD int")
    files = spark.createDataFrame(
        [(1, "a", 10), (1, "b", 20), (2, "c", 10), (None, "z", None)],
        "k int, v string, dtemod int",
    )
    latest = LatestBy(keys=["K"], order="dtemod")
    assert report(compare(source, files, latest=latest))["Actual minus Expected count"] == "1"
    kept = files.where("k IS NOT NULL")
    assert report(compare(source, kept, latest=latest))["Status"] == "Passed"
    tied = kept.unionByName(spark.createDataFrame([(1, "x", 20)], kept.schema))
    got = report(compare(source, tied, latest=latest, columns=["k", "v", "dtemod"]))
    assert (got["Actual rows"], got["Status"]) == ("3", "Failed")
    missing = report(compare(source, kept, columns=["k", "nope"]))
    assert missing["Details"].startswith("File Structure error")


def test_profiles(spark):
    schema = "Profile string, TOTAL_ROW_COUNT bigint, SUM_a decimal(30,2), X string"
    left = spark.createDataFrame([("Profile", 5, None, "x")], schema)
    right = spark.sql(
        "SELECT 'Profile' AS Profile, 5L AS TOTAL_ROW_COUNT, "
        "CAST(0 AS DECIMAL(30,2)) AS SUM_a, CAST(NULL AS STRING) AS X"
    )
    got = report(compare_profiles(left, left, "t"))
    assert (got["Status"], got["Expected rows"], got["Actual rows"]) == ("Passed", "5", "5")
    got = report(compare_profiles(left, right, "t"))
    assert got["Status"] == "Failed"
    assert got["Mismatching columns"] == "SUM_a,X"
    reordered = left.select("X", "SUM_a", "TOTAL_ROW_COUNT", "Profile")
    assert report(compare_profiles(left, reordered, by="name"))["Status"] == "Passed"
    got = report(compare_profiles(left, left.drop("X")))
    assert got["Details"].startswith("File Structure error")
    assert got["Expected rows"] == "5"
    got = report(compare_profiles(left, left.drop("TOTAL_ROW_COUNT"), "t"))
    assert got["Status"] == "Failed" and "TOTAL_ROW_COUNT" in got["Details"]


def test_one_exchange_of_the_rows(spark):
    """Both directions come from a single shuffle of the united rows."""
    left, right = random_pair(spark, 3)
    plan = compare(left, right)._jdf.queryExecution().executedPlan().toString()
    assert Counter(plan.split())["hashpartitioning(c0#"] <= 1
    assert plan.count("hashpartitioning(c0") == 1


def test_equally_partitioned_sides_are_not_shuffled_again(spark):
    """As for two tables bucketed alike on the key."""
    left = spark.range(1000).selectExpr("id % 10 AS k", "id AS v").repartition(8, "k")
    right = spark.range(1000).selectExpr("id % 10 AS k", "id + 1 AS v").repartition(8, "k")
    report_frame = compare(left, right)
    assert report(report_frame)["Status"] == "Failed"
    plan = report_frame._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(c0" not in plan


def test_profiles_without_rows_fail(spark):
    empty = spark.createDataFrame([], "TOTAL_ROW_COUNT long, a long")
    report = compare_profiles(empty, empty).first()
    assert report["Status"] == "Failed" and "row count" in report["Details"]


def test_columns_are_counted_before_the_projection(spark):
    left = spark.createDataFrame([(1, 2)], "a int, b int")
    right = left.selectExpr("a", "b", "a AS c")
    for mode in ("two_way", "one_way"):
        got = report(compare(left, right, columns=["a", "b"], mode=mode))
        assert got["Status"] == "Failed"
        assert (got["Expected columns"], got["Actual columns"]) == ("2", "3")
        assert got["Details"] == "2 and 3 columns before the projection"


@pytest.mark.parametrize(
    ("left", "right", "verdict"),
    [
        ("9007199254740993L", "9007199254740992D", "Failed"),
        ("9007199254740992L", "9007199254740992D", "Passed"),
        ("5L", "5.0D", "Passed"),
        ("5L", "5.5D", "Failed"),
        ("0L", "-0.0D", "Passed"),
        ("5L", "double('NaN')", "Failed"),
        ("5L", "1e300D", "Failed"),
        ("CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)", "Passed"),
        ("16777217", "CAST(16777216 AS FLOAT)", "Failed"),
        ("CAST('0.1' AS DECIMAL(10,2))", "0.1D", "Passed"),
        ("CAST('0.1000000000000000055' AS DECIMAL(20,19))", "0.1D", "Failed"),
        ("CAST('0.1' AS DECIMAL(20,19))", "0.1D", "Passed"),
        ("CAST('1.00000000000000000001' AS DECIMAL(38,20))", "CAST(1 AS DECIMAL(38,0))", "Failed"),
        ("CAST(100 AS DECIMAL(38,20))", "CAST(100 AS DECIMAL(38,0))", "Passed"),
        ("CAST(0 AS DECIMAL(38,20))", "CAST(0 AS DECIMAL(38,0))", "Passed"),
        ("CAST('1.5e-10' AS DECIMAL(38,20))", "CAST('1.5e-10' AS DECIMAL(38,30))", "Passed"),
    ],
)
def test_unequal_numbers_of_two_types_never_pass(spark, left, right, verdict):
    sides = spark.sql(f"SELECT {left} AS x"), spark.sql(f"SELECT {right} AS x")
    assert report(compare(*sides))["Status"] == verdict
    assert report(compare(*reversed(sides)))["Status"] == verdict
