import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenframe import profile, profile_table, run_profile_sql
from evenframe.functions import statistics as S
from evenframe.functions.statistics import flag_sum, plain_sum
from evenframe.operators import rules as R
from evenframe.operators.profiles import statistics_for
from evenframe.sources import CRM_SCHEMA, ERP_SCHEMA, load_dictionary


def crm(spark, *fields):
    return spark.createDataFrame([("t", f, label) for f, label in fields], CRM_SCHEMA)


def erp(spark, *fields):
    return spark.createDataFrame([("t", *f) for f in fields], ERP_SCHEMA)


def kinds(statistics):
    return [s.kind for s in statistics]


@pytest.mark.parametrize("name", sorted(R.ERP_TEXT))
def test_erp_text(name):
    assert kinds(R.erp_statistics("f", name, None, "target")) == ["SUM_LEN", "COUNT_DISTINCT"]


def test_erp_rules():
    for name in R.ERP_NUMBER:
        (only,) = R.erp_statistics("f", name, 3, "target")
        assert only.name == "SUM_f" and only.decimal == (30, 3)
    for name in R.ERP_TIME:
        assert kinds(R.erp_statistics("f", name, None, "source")) == ["COUNT_DISTINCT", "SUM_LEN"]
    for name in ("char", "OTHER", None):  # names match exactly
        assert kinds(R.erp_statistics("f", name, None, "target")) == ["COUNT_DISTINCT"]


@pytest.mark.parametrize(
    "label, target, source",
    [
        ("Email", ["SUM_LEN", "COUNT_DISTINCT"], None),
        ("PICKLIST (Multi)", ["SUM_LEN", "COUNT_DISTINCT"], None),
        ("Formula (Text)", ["SUM_LEN", "COUNT_DISTINCT"], None),
        ("Hybrid", ["SUM_LEN", "COUNT_DISTINCT"], None),  # holds "id"
        ("Checkbox", ["SUM", "COUNT_DISTINCT"], None),
        ("Formula (Percent)", ["SUM"], None),
        ("Number(18, 2)", ["SUM"], None),
        ("Date/Time", ["COUNT_DISTINCT", "SUM_LEN"], None),
        ("Time", ["COUNT_DISTINCT", "SUM_LEN"], None),
        ("Date", ["COUNT_DISTINCT", "SUM_LEN"], None),
        ("Hierarchy", ["COUNT_DISTINCT"], None),
        (None, ["COUNT_DISTINCT"], None),
    ],
)
def test_crm_rules(label, target, source):
    assert kinds(R.crm_statistics("f", label, "target")) == target
    assert kinds(R.crm_statistics("f", label, "source")) == (source or target)


def test_crm_details():
    (formula,) = R.crm_statistics("f", "Formula (Number)", "target")
    assert formula.decimal == (30, 2)
    (plain,) = R.crm_statistics("f", "Formula (Number)", "source")
    assert plain.decimal is None
    (number,) = R.crm_statistics("f", "Currency(16, 3)", "target")
    assert number.decimal == (16, 3)
    assert R.label_precision("f", "Number(9)") == (9, 0)
    assert R.crm_statistics("f", "Date/Time", "target")[1].first == 19
    assert R.crm_statistics("f", "Date", "target")[1].first == 10
    assert R.crm_statistics("f", "Date", "source")[1].first is None
    with pytest.raises(ValueError, match="f: number label"):
        R.crm_statistics("f", "Auto Number", "target")
    assert kinds(R.crm_statistics("f", "Auto Number", "source")) == ["SUM"]


TEXT_ROWS = [
    ("1", "True", "1.10", "2024-01-01T10:00:00.000Z", "é"),
    ("2", "False", "2.25", "2024-01-02T10:00:00.000Z", None),
    ("2", "1", None, None, "ab"),
    ("3", "maybe", "no number", "2024-01-02T10:00:00.000Z", "ab"),
]
TEXT_SCHEMA = "Id string, flag string, amount string, SystemModstamp string, txt string"


@pytest.mark.parametrize("read_as", ["files", "columnar", "computed"])
def test_crm_profile_over_texts(spark, read_as):
    df = spark.createDataFrame(TEXT_ROWS, TEXT_SCHEMA)
    dictionary = crm(
        spark,
        ("Id", "Id"), ("flag", "Checkbox"), ("amount", "Number(18, 2)"),
        ("SystemModstamp", "Date/Time"), ("txt", "Text(10)"),
    )
    got = profile(df, dictionary, rules="crm", read_as=read_as).collect()
    assert [r.asDict() for r in got] == [
        {
            "Profile": "Profile",
            "TOTAL_ROW_COUNT": 4,
            "MAX_MODIFICATION_DATE": "2024-01-02T10:00:00.000Z",
            "SUM_LEN_Id": 4,
            "COUNT_DISTINCT_Id": 3,
            "SUM_flag": 2,
            "COUNT_DISTINCT_flag": 4,
            "SUM_amount": Decimal("3.35"),
            "COUNT_DISTINCT_SystemModstamp": 2,
            "SUM_LEN_SystemModstamp": 57,
            "SUM_LEN_txt": 5,
            "COUNT_DISTINCT_txt": 2,
        }
    ]


def test_sums(spark):
    df = spark.createDataFrame(
        [(0.1, 2**62, Decimal("1.5"), True, 1.0)] * 3 + [(None, None, None, None, None)],
        "d double, l bigint, n decimal(10,1), b boolean, EDW_MDF_TST double",
    )
    fields = [(c, "DEC", 1) for c in "dln"]
    got = profile(df, erp(spark, *fields, ("b", "INT1", 0))).first().asDict()
    assert got["SUM_d"] == Decimal("0.3")
    assert got["SUM_l"] == Decimal(3 * 2**62)  # beyond bigint
    assert got["SUM_n"] == Decimal("4.5")
    assert got["SUM_b"] == 3


def test_sum_that_does_not_fit_or_is_not_finite_is_null(spark):
    df = spark.createDataFrame([(1e9, float("nan")), (1e9, 1.0)], "a double, b double")
    dictionary = crm(spark, ("a", "Number(9, 2)"), ("b", "Number(18, 2)"))
    got = profile(df, dictionary, rules="crm", change_column="a").first()
    assert got["SUM_a"] is None and got["SUM_b"] is None
    source = profile(df, dictionary, rules="crm", side="source", change_column="a").first()
    assert source["SUM_a"] == 2e9 and source["SUM_b"] is None


@pytest.mark.parametrize("scale", [0, 2, 4])
def test_floating_sums_are_exact(spark, scale):
    rng = random.Random(scale)
    values = [round(rng.uniform(-1e6, 1e6), scale) for _ in range(500)]
    values += [0.1, 0.2, -0.0, 1e15, 123456789012345.0, -2.5e17, None]
    df = spark.createDataFrame([(v, v) for v in values], "d double, EDW_MDF_TST double")
    wanted = sum(Decimal(repr(v)) for v in values if v is not None)
    for parts in (1, 7):
        got = profile(df.repartition(parts), erp(spark, ("d", "CURR", scale))).first()
        assert got["SUM_d"] == wanted.quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)
    only_big = profile(df.where("d > 1e12"), erp(spark, ("d", "CURR", scale))).first()
    assert only_big["SUM_d"] == Decimal("1123456789012345")
    none = profile(df.where("d IS NULL"), erp(spark, ("d", "CURR", scale))).first()
    assert none["SUM_d"] is None


def test_numbers_beyond_any_decimal_are_not_dropped(spark):
    df = spark.createDataFrame(
        [("1", "1", "x", 1e40), ("1e40", "NaN", "2.5", 1.0)], "a string, b string, c string, d double"
    )
    dictionary = crm(spark, *[(f, "Number(18, 2)") for f in "abcd"])
    got = profile(df, dictionary, rules="crm", change_column="a").first()
    assert got["SUM_a"] is None and got["SUM_b"] is None and got["SUM_d"] is None
    assert got["SUM_c"] == Decimal("2.50")


def test_empty_table(spark):
    df = spark.createDataFrame([], TEXT_SCHEMA)
    got = profile(df, crm(spark, ("Id", "Id"), ("flag", "Checkbox")), rules="crm").collect()
    assert [tuple(r) for r in got] == [("Profile", 0, None, None, 0, None, 0)]


def test_many_distinct_counts_in_one_pass(spark):
    df = spark.sql(
        "SELECT * FROM VALUES "
        "(0.0D, -0.0F, TIMESTAMP'2024-01-01 00:00:00', X'00', 1.0, true, 'a', 'x'), "
        "(-0.0D, 0.0F, TIMESTAMP'2024-01-01 00:00:00', X'0000', 1.0, null, 'A', 'x'), "
        "(double('NaN'), null, TIMESTAMP'2024-01-01 00:00:01', null, 2.5, false, '', 'x'), "
        "(double('NaN'), null, null, X'00', null, false, null, 'x') "
        "AS t(d, f, ts, b, n, o, s, c)"
    )
    repeated = df.select("*", *[df[c].alias(f"{c}2") for c in df.columns], df.ts.alias("EDW_MDF_TST"))
    fields = [(c, "OTHER", None) for c in repeated.columns]
    got = profile(repeated, erp(spark, *fields)).first().asDict()
    wanted = {"d": 2, "f": 1, "ts": 2, "b": 2, "n": 2, "o": 2, "s": 3, "c": 1}
    for name, number in wanted.items():
        assert got[f"COUNT_DISTINCT_{name}"] == got[f"COUNT_DISTINCT_{name}2"] == number
    none = profile(repeated.limit(0), erp(spark, *fields)).first()
    assert none["COUNT_DISTINCT_d"] == 0


def test_erp_sides_agree(spark):
    df = spark.createDataFrame([("ab", 1, "20240101")], "a string, n int, EDW_MDF_TST string")
    dictionary = erp(spark, ("a", "CHAR", None), ("n", "INT4", 0), ("EDW_MDF_TST", "DATS", None))
    target = profile(df, dictionary).collect()
    assert target == profile(df, dictionary, side="source", read_as="columnar").collect()
    assert target[0]["SUM_n"] == Decimal(1)


def test_latest_only(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "yy"), ("b", 1, "z")], "Id string, SystemModstamp int, v string"
    )
    got = profile_table(df, crm(spark, ("v", "Text")), rules="crm", latest_keys=["Id"]).first()
    assert got["TOTAL_ROW_COUNT"] == 2 and got["SUM_LEN_v"] == 3


def test_stored_select(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "yy"), ("b", 1, "z")], "Id string, SystemModStamp int, v string"
    )
    select = "Select 'Profile' as Profile, COUNT(*) as N, SUM(LENGTH(v)) as SUM_LEN_v"
    assert tuple(run_profile_sql(df, select, "t").first()) == ("Profile", 3, 4)
    assert spark.table("my_t").count() == 3
    assert tuple(run_profile_sql(df, select, "t", latest_key="Id").first()) == ("Profile", 2, 3)


def test_errors(spark):
    df = spark.createDataFrame(TEXT_ROWS, TEXT_SCHEMA)
    with pytest.raises(ValueError, match="twice"):
        statistics_for(crm(spark, ("a", "Id"), ("A", "Id")), "crm")
    with pytest.raises(ValueError, match="not found"):
        profile(df, crm(spark, ("missing", "Id")), rules="crm")
    with pytest.raises(ValueError, match="read_as"):
        profile(df, crm(spark, ("Id", "Id")), rules="crm", read_as="tape")
    with pytest.raises(ValueError):
        statistics_for(crm(spark), "other")
    with pytest.raises(ValueError):
        statistics_for(crm(spark), "crm", "middle")


def test_dictionary_of_one_table(spark):
    both = spark.createDataFrame(
        [("t", "a", "CHAR", None), ("u", "b", "CHAR", None)], ERP_SCHEMA
    )
    assert [r["FIELDNAME"] for r in load_dictionary(both, "u").collect()] == ["b"]


@pytest.mark.parametrize(
    ("value", "rows", "wanted"),
    [
        ("4e-10D", 1_000_000, "0.0004"),
        ("'4e-10'", 1_000_000, "0.0004"),
        ("-4e-10D", 1_000_000, "-0.0004"),
        ("1234.56D", 1_000_000, "1234560000.0000"),
        ("1.005D", 200_000, "201000.0000"),
        ("'12345678901.00000000001'", 10_000_000, "123456789010000000.0001"),
    ],
)
def test_small_parts_of_values_reach_the_sum(spark, value, rows, wanted):
    df = spark.range(rows).selectExpr(f"{value} AS x", "1 AS changed")
    got = profile(df, erp(spark, ("x", "DEC", 4)), change_column="changed").first()
    assert got["SUM_x"] == Decimal(wanted)


@pytest.mark.parametrize(
    ("values", "wanted"),
    [
        ("1e-11D", 1e-5),
        ("'1e-11'", 1e-5),
        ("-1.23456789e-22D", -1.23456789e-16),
        ("1e300D", None),
        ("CAST(NULL AS DOUBLE)", None),
    ],
)
def test_plain_sums_of_small_values(spark, values, wanted):
    df = spark.range(1_000_000).selectExpr(f"{values} AS x")
    got = df.agg(plain_sum(F.col("x"), df.schema["x"].dataType).alias("s")).first()["s"]
    assert got == (wanted if wanted is None else pytest.approx(wanted, rel=1e-9, abs=0))


def test_flags_that_are_numbers(spark):
    df = spark.createDataFrame(
        [("0.5",), ("True",), ("2.0",), ("False",), ("no",), (None,)], "x string"
    )
    assert df.agg(flag_sum(F.col("x"), df.schema["x"].dataType)).first()[0] == 3.5


@pytest.mark.parametrize("kind, values", [
    ("bigint", [2**63 - 1, 2**63 - 1, -(2**63), -1, 5, None]),
    ("double", [2.0**53 - 1, -(2.0**53) + 1, 1e-20, 0.1, 0.2, -3.75, 1e22, None]),
    ("int", [2**31 - 1, 2**31 - 1, -7]),
])
def test_sums_of_parts_equal_sums_of_decimals(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in values * 3], f"v {kind}")
    digits = 0 if kind != "double" else 2
    got = df.agg(S.decimal_sum(df.v, df.schema["v"].dataType, 38, digits)).first()[0]
    wanted = sum(Decimal(repr(v)) if kind == "double" else Decimal(v) for v in values * 3 if v is not None)
    assert got == wanted.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)


def test_sums_take_few_aggregates(spark):
    df = spark.createDataFrame([(1.5, 2)], "v double, n bigint")
    plan = df.agg(S.decimal_sum(df.v, T.DoubleType(), 30, 2))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("partial_sum(") + plan.count("partial_try_sum(") == 5


def test_profile_of_latest_rows_reads_once_without_copies(spark, folder):
    spark.range(1000).selectExpr(
        "id % 100 AS k", "id AS `EDW_MDF_TST`", "CAST(id % 7 AS STRING) AS c", "id / 8 AS q"
    ).write.parquet(f"{folder}/t")
    dictionary = erp(spark, ("k", "INT4", 0), ("c", "CHAR", 0), ("q", "QUAN", 2), ("EDW_MDF_TST", "DATS", 0))
    df = profile_table(spark.read.parquet(f"{folder}/t"), dictionary, latest_keys=["k"])
    row = df.collect()[0].asDict()
    assert row["TOTAL_ROW_COUNT"] == 100 and row["COUNT_DISTINCT_c"] == 7
    assert row["COUNT_DISTINCT_EDW_MDF_TST"] == 100 and row["SUM_k"] == 4950
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    tree = text.split("\n(1) ")[0].split("== Initial Plan ==")[0]
    assert tree.count("Scan parquet") == 1 and "Expand" not in tree
