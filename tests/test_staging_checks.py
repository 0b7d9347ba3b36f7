from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from evenframe.operators import (
    choose_area,
    column_count_check,
    duplicate_keys,
    has_pii,
    header_frame,
    key_fields,
    map_header,
    row_count_check,
    stage,
    stage_table,
    staged_diff,
    target_fields,
)
from evenframe.sources import (
    BAR_DOLLAR,
    RECORD_SEPARATOR,
    STAGING_SCHEMA,
    read_delimited,
    write_staged,
)

FIELDS = [
    ("Id", "primary", "T_ID", "VARCHAR", None),
    ("Name", None, "T_NAM", "STRING", "PII"),
    ("Flag", None, "T_FLG", "BOOLEAN", None),
    ("Amount", None, "T_AMT", "DECIMAL", None),
    ("Day", None, "T_DAY", "DATE", None),
    ("Stamp", None, "SYS_MST_DAT", "TIMESTAMP", None),
    ("Odd", None, "T_ODD", "VARIANT", None),
    ("Elsewhere", None, "T_ELS", "VARCHAR", None),
]
COLUMNS = ["Odd", "Id", "Name", "Flag", "Amount", "Day", "Stamp", "New"]


def dictionary(spark, fields=FIELDS):
    return spark.createDataFrame(
        [("S", f, "x", key, "T", target, kind, pii) for f, key, target, kind, pii in fields],
        STAGING_SCHEMA,
    )


def files(spark, data=None):
    schema = "filename string, " + ", ".join(f"{c} string" for c in COLUMNS)
    data = data or [
        ("a.csv", "o", " 1 ", " n ", " TRUE", "5", " 2024-01-01 ", "2024-01-01", "w"),
        ("b.csv", None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(data, schema)


def mapping(spark, fields=FIELDS):
    return map_header(header_frame(files(spark).drop("filename")), dictionary(spark, fields))


def test_map_header_keeps_order_and_unknown_columns(spark):
    got = mapping(spark).orderBy("ordinal").collect()
    assert [(r["ordinal"], r["name"]) for r in got] == list(enumerate(COLUMNS, 1))
    assert got[7]["target_field"] is None
    assert key_fields(mapping(spark)) == ["T_ID"]
    assert target_fields(mapping(spark)) == [
        "T_ODD", "T_ID", "T_NAM", "T_FLG", "T_AMT", "T_DAY", "SYS_MST_DAT",
    ]


def test_pii(spark):
    assert has_pii(mapping(spark)).first()[0] is True
    plain = [f[:4] + (None,) for f in FIELDS]
    assert has_pii(mapping(spark, plain)).first()[0] is False
    assert has_pii(mapping(spark).limit(0)).first()[0] is False
    assert choose_area(mapping(spark), "open", "closed").first()["area"] == "closed"
    assert choose_area(mapping(spark, plain), "open", "closed").first()["area"] == "open"


def test_stage_rules(spark):
    got = stage(files(spark), mapping(spark), keep=["filename"])
    assert got.columns == [
        "filename", "Unknown_Column_1", "T_ID", "T_NAM", "T_FLG", "T_AMT", "T_DAY",
        "SYS_MST_DAT", "Unknown_Column_8",
    ]
    assert rows(got) == [
        ("a.csv", "o", "1", "n", "true", "5", "2024-01-01", "2024-01-01", "w"),
        ("b.csv", "#", "#", "#", "false", "0", "1000-01-01", "1000-01-01 00:00:00.000", "#"),
    ]


def test_stage_keeps_native_numbers(spark):
    df = spark.sql("SELECT 1.5D AS Amount UNION ALL SELECT NULL")
    maps = map_header(header_frame(df), dictionary(spark))
    assert rows(stage(df, maps)) == [(0.0,), (1.5,)]


def test_field_mapped_twice_is_an_error(spark):
    with pytest.raises(ValueError, match="twice"):
        stage(files(spark), mapping(spark, FIELDS + [("Id", None, "T_ID2", "VARCHAR", None)]))


def row(file, key, stamp, name="n"):
    return (file, "o", key, name, "true", "1", "2024-01-01", stamp, "w")


STAMPS = [
    row("a.csv", "1", "2024-01-01"),
    row("b.csv", "1", "2024-01-02"),
    row("a.csv", "2", "2024-01-01", "first"),
    row("b.csv", "2", "2024-01-01", "second"),
    row("a.csv", "3", None),
]


def test_stage_table_numbers(spark):
    staged = stage_table(files(spark, STAMPS), mapping(spark))
    got = rows(staged.select("T_ID", "filename", "cnt"))
    assert got == [
        ("1", "a.csv", 2), ("1", "b.csv", 1), ("2", "a.csv", 2), ("2", "b.csv", 1),
        ("3", "a.csv", 1),
    ]
    only = stage_table(files(spark, STAMPS), mapping(spark), latest_only=True)
    assert rows(only) == rows(staged.where("cnt = 1"))
    assert only.schema["cnt"].dataType == staged.schema["cnt"].dataType


def test_no_key_is_refused(spark):
    keyless = [f[:1] + (None,) + f[2:] for f in FIELDS]
    with pytest.raises(ValueError, match="keys"):
        stage_table(files(spark, STAMPS), mapping(spark, keyless))


def test_row_count_check(spark):
    staged = stage_table(files(spark, STAMPS), mapping(spark))
    three = spark.range(3)
    assert row_count_check(staged, three).count() == 0
    assert rows(row_count_check(staged, spark.range(4))) == [(3,)]


def test_staged_diff(spark):
    staged = stage_table(files(spark, STAMPS), mapping(spark))
    target = staged.where("cnt = 1 AND T_ID <> '3'").withColumn(
        "T_NAM", F.when(F.col("T_ID") == "2", "other").otherwise(F.col("T_NAM"))
    )
    twice = target.unionByName(target)  # copies do not count here
    got = staged_diff(staged, twice, ["T_ID", "T_NAM"])
    assert rows(got) == [
        ("ACTUAL", "2", "other"), ("EXPECTED", "2", "second"), ("EXPECTED", "3", "n"),
    ]


def test_duplicate_keys(spark):
    df = spark.createDataFrame(
        [("s", 1), ("s", 1), ("s", 2), (None, 3), (None, 3)], "SRC_SYS_COD string, k int"
    )
    got = duplicate_keys(df, ["SRC_SYS_COD", "K", "SRC_SYS_COD"])
    assert got.columns == ["check", "SRC_SYS_COD", "k"]
    assert rows(got) == [("Duplicates", "s", 1), ("Duplicates", None, 3)]
    assert duplicate_keys(df.limit(0), ["k"]).count() == 0


def test_column_count_check(spark):
    metadata = spark.createDataFrame(
        [("S_PTS_ACC", "a"), ("S_PTS_ACC", "b"), ("S_PTS_ACC", "b"), ("OTHER", "c")],
        "SOURCE_TABLE string, SOURCE_FIELD string",
    )
    two = header_frame(spark.createDataFrame([(1, 2)], "a int, b int"))
    assert column_count_check(metadata, "S_pts_Acc", two).count() == 0
    one = two.limit(1)
    assert rows(column_count_check(metadata, "S_PTS_ACC", one)) == [(2,)]


def test_from_files_to_checks(spark, folder):
    """Files, provenance, staging, stored table, then the three checks."""
    for name, lines in (
        ("day1/a.csv", [("1", " one ", "2024-01-01"), ("2", "two\nlines", "2024-01-01")]),
        ("day2/b.csv", [("1", "ONE", "2024-01-02"), ("3", "", "2024-01-02")]),
    ):
        path = Path(folder, "files", name)
        path.parent.mkdir(parents=True)
        records = [("Id", "Name", "Stamp"), *lines]
        path.write_text("".join("|$".join(r) + "\u001e" for r in records), newline="")
    read = read_delimited(
        spark, f"{folder}/files", BAR_DOLLAR, RECORD_SEPARATOR, with_file=True
    )
    maps = map_header(header_frame(read.drop("filename")), dictionary(spark))
    staged = write_staged(stage_table(read, maps), f"{folder}/staged")
    latest = staged.where("cnt = 1")
    assert staged.count() == 4
    assert rows(latest.select("T_ID", "T_NAM", "SYS_MST_DAT")) == [
        ("1", "ONE", "2024-01-02"), ("2", "two\nlines", "2024-01-01"), ("3", "#", "2024-01-02"),
    ]
    assert {r[0].rsplit("/", 1)[1] for r in latest.select("filename").collect()} == {
        "a.csv", "b.csv",
    }
    target = latest.select(*target_fields(maps))
    assert row_count_check(staged, target).count() == 0
    assert staged_diff(staged, target, target_fields(maps)).count() == 0
    assert duplicate_keys(target, key_fields(maps)).count() == 0
    short = target.where("T_ID <> '3'")
    assert rows(row_count_check(staged, short)) == [(3,)]
    assert rows(staged_diff(staged, short, ["T_ID"])) == [("EXPECTED", "3")]
    assert duplicate_keys(target.unionByName(short), key_fields(maps)).count() == 2
