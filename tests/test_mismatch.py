import random

import pytest
from conftest import rows

from evenframe.operators import align, diff_rows, mismatch_counts, mismatching_columns
from evenframe.plans import compare

SCHEMA = "k int, a string, b double"


def names(spark, left, right, keys=None, schema=SCHEMA):
    sides = align(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema))
    return mismatching_columns(sides, keys).first()[0]


def test_one_row(spark):
    assert names(spark, [(1, "x", 1.0)], [(1, "x", 1.0)]) == "NA"
    assert names(spark, [(1, "x", 1.0)], [(1, "y", 2.0)]) == "a,b"
    assert names(spark, [(1, None, 1.0)], [(1, None, None)]) == "b"


def test_keyed_counts(spark):
    left = [(1, "x", 1.0), (2, "y", None), (3, "z", 3.0), (None, "n", 0.0)]
    right = [(1, "x", 1.5), (2, None, None), (4, "q", 3.0), (None, "m", -0.0)]
    sides = align(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA))
    # keys 3 and 4 lie on one side only, so each of their columns mismatches
    assert rows(mismatch_counts(sides, ["k"])) == [("a", 4), ("b", 3)]


def test_repeated_keys_compare_as_multisets(spark):
    left = [(1, "x", 1.0), (1, "y", 2.0)]
    assert names(spark, left, list(reversed(left)), ["k"]) == "NA"
    assert names(spark, left, [(1, "x", 2.0), (1, "y", 1.0)], ["k"]) == "NA"
    assert names(spark, left, [(1, "x", 1.0), (1, "x", 2.0)], ["k"]) == "a"
    assert names(spark, left, [(1, "x", 1.0)], ["k"]) == "a,b"


def test_against_brute_force(spark):
    rng = random.Random(5)

    def some():
        return [
            (rng.randint(1, 6), rng.choice(["x", "y", None]), rng.choice([1.0, 2.0, None]))
            for _ in range(rng.randint(0, 15))
        ]

    for _ in range(4):
        left, right = some(), some()
        sides = align(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA))
        wanted = []
        for i, name in ((1, "a"), (2, "b")):
            bad = 0
            for key in {r[0] for r in left + right}:
                e = sorted((r[i] for r in left if r[0] == key), key=repr)
                a = sorted((r[i] for r in right if r[0] == key), key=repr)
                bad += e != a
            wanted.append((name, bad))
        assert rows(mismatch_counts(sides, ["K"])) == wanted


def test_many_columns(spark):
    columns = [f"v{i}" for i in range(80)]
    left = spark.createDataFrame([tuple(range(81))], ["k", *columns])
    right = left.withColumn("v70", left.v70 + 1).withColumn("v3", left.v3 + 1)
    assert mismatching_columns(align(left, right), ["k"]).first()[0] == "v3,v70"


def test_nested_and_map_columns(spark):
    left = spark.sql(
        "SELECT * FROM VALUES (1, map('a', 1, 'b', 2), array(1, null), 'x'), "
        "(2, map('a', 1), array(2), 'x'), (2, map('a', 2), array(2), 'y') AS t(k, m, l, v)"
    )
    right = spark.sql(
        "SELECT * FROM VALUES (1, map('b', 2, 'a', 1), array(1, 1), 'x'), "
        "(2, map('a', 2), array(2), 'x'), (2, map('a', 3), array(2), 'y') AS t(k, m, l, v)"
    )
    sides = align(left, right)
    assert rows(mismatch_counts(sides, ["k"])) == [("l", 1), ("m", 1), ("v", 0)]
    assert mismatching_columns(sides).first()[0] == "m,l"


@pytest.mark.parametrize("wrap", ["m", "array(struct(m AS q, k AS z))", "map(k, m)"])
def test_maps_are_equal_in_any_order_and_at_any_depth(spark, wrap):
    def side(rows):
        return spark.sql(f"SELECT * FROM VALUES {rows} t(k, m)").selectExpr("k", f"{wrap} AS m")

    empty = "CAST(map() AS map<string, int>)"
    expected = side(f"(1, map('a', 1, 'b', null)), (2, map('x', 1)), (3, null), (4, {empty}), (1, map('a', 1, 'b', null))")
    actual = side(f"(1, map('b', null, 'a', 1)), (2, map('x', 2)), (3, null), (4, {empty}), (1, map('a', 1, 'b', null))")
    sides = align(expected, actual, maps="entries")
    assert [tuple(r) for r in mismatch_counts(sides, ["k"]).collect()] == [("m", 1)]
    assert mismatching_columns(sides).first()[0] == "m"
    assert sorted((r["side"], r["k"]) for r in diff_rows(sides).collect()) == [("ACTUAL", 2), ("EXPECTED", 2)]
    report = compare(expected, actual, "t").first()
    assert report["Expected minus Actual count"] == report["Actual minus Expected count"] == "1"
    assert compare(expected, expected, "t", mode="one_way").first()["Status"] == "Passed"
    assert compare(expected, actual, "t", mode="one_way").first()["Mismatching columns"] == "m"
    with pytest.raises(ValueError):
        align(expected, actual, maps="text")
