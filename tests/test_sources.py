from datetime import date
from pathlib import Path

import pytest
from conftest import rows

from evenframe.sources import (
    BAR_DOLLAR,
    RECORD_SEPARATOR,
    TAB,
    jdbc_options,
    read_delimited,
    read_dictionary,
    resolve_paths,
    source_table,
    table_mode,
    write_delimited,
    write_profile,
    write_report,
    write_staged,
    write_text,
)
from evenframe.sources.dictionary import ERP_SCHEMA


def write(folder, name, text):
    path = Path(folder, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8", newline="")


def test_comma_tree(spark, folder):
    write(folder, "2023/01/a.csv", 'a,b\n1,"x,y"\n2,\n')
    write(folder, "2023/02/b.csv", "a,b\n3,é\n")
    got = read_delimited(spark, folder)
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["string", "string"]
    assert rows(got) == [("1", "x,y"), ("2", None), ("3", "é")]
    assert rows(read_delimited(spark, folder, infer=True))[0] == (1, "x,y")
    assert rows(read_delimited(spark, folder, glob="b*.csv")) == [("3", "é")]


def test_record_separator_keeps_line_feeds(spark, folder):
    sep, end = BAR_DOLLAR, RECORD_SEPARATOR
    write(folder, "t/x.csv", f"Id{sep}Text{end}1{sep}one\ntwo{end}2{sep}$|,{end}")
    got = read_delimited(spark, folder, sep=sep, line_sep=end)
    assert rows(got) == [("1", "one\ntwo"), ("2", "$|,")]


def test_written_files_read_back(spark, folder):
    texts = ["plain", None, "a\nb", 'say "x"', "back\\slash", " pad ", "|$", "\t,;", "é "]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    path = f"{folder}/rs"
    write_delimited(df, path, sep=BAR_DOLLAR, line_sep=RECORD_SEPARATOR)
    got = read_delimited(
        spark, path, sep=BAR_DOLLAR, line_sep=RECORD_SEPARATOR, schema=df.schema
    )
    assert rows(got) == rows(df)
    assert not list(Path(path).glob("_SUCCESS"))


def test_empty_texts_read_as_null(spark, folder):
    write_delimited(spark.createDataFrame([("", "x"), (None, "y")], "a string, b string"), folder)
    assert rows(read_delimited(spark, folder)) == [(None, "x"), (None, "y")]


def test_borrowed_schema_goes_by_position(spark, folder):
    write(folder, "x.csv", "q\tr\n1\t2.50\n")
    schema = spark.sql("SELECT 1 AS k, CAST(1 AS DECIMAL(9,2)) AS amount").schema
    got = read_delimited(spark, folder, sep=TAB, schema=schema)
    assert got.columns == ["k", "amount"] and str(got.first()["amount"]) == "2.50"


def test_header_modes(spark, folder):
    write(folder, "1.csv", "a,b\n1,2\n")
    write(folder, "2.csv", "b,a\n20,10\n")
    write(folder, "3.csv", "a,b,c\n5,6,7\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, folder).collect()
    by_name = read_delimited(spark, folder, headers="by_name")
    assert by_name.columns == ["a", "b", "c"]
    assert rows(by_name) == [("1", "2", None), ("10", "20", None), ("5", "6", "7")]
    swapped = read_delimited(
        spark, [f"{folder}/1.csv", f"{folder}/2.csv"], headers="position"
    )
    assert rows(swapped) == [("1", "2"), ("20", "10")]
    with pytest.raises(ValueError):
        read_delimited(spark, folder, headers="any")


def test_by_name_with_odd_paths_and_many_rows(spark, folder):
    lines = "".join(f"{i},{i}\n" for i in range(2000))
    write(folder, "a b/1 é%20.csv", "k,v\n" + lines)
    write(folder, "a b/2.csv", "v,k\n" + lines.replace(",", ",9"))
    got = read_delimited(spark, folder, headers="by_name")
    assert got.count() == 4000
    assert got.where("k LIKE '9%' AND substring(k, 2) = v").count() == 2000


def test_by_name_joins_inferred_types(spark, folder):
    write(folder, "1.csv", "a,b\n1,2\n")
    write(folder, "2.csv", "b,a\nx,10\n")
    got = read_delimited(spark, folder, infer=True, headers="by_name")
    assert rows(got) == [(1, "2"), (10, "x")]


def test_file_names(spark, folder):
    write(folder, "d/1.csv", "a\n1\n")
    write(folder, "d/2.csv", "a\n2\n")
    got = read_delimited(spark, folder, with_file=True)
    assert got.columns == ["filename", "a"]
    assert [Path(r["filename"]).name for r in got.orderBy("a").collect()] == ["1.csv", "2.csv"]
    assert read_delimited(spark, folder, with_file="src").columns == ["src", "a"]


def test_missing_path(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_delimited(spark, f"{folder}/nothing")


def test_paths():
    assert resolve_paths("s3://b/", "T", "glob", folder="SourceProfiling") == (
        "s3://b/T/SourceProfiling/T*.csv"
    )
    assert resolve_paths("/b", "T", "tree") == "/b/T"
    assert resolve_paths("/b", "T", "dated", date(2024, 3, 7)) == "/b/T/2024/03/07"
    assert resolve_paths("/b", "T", "dated", date(2024, 3, 7), compact=True) == "/b/T/20240307"
    with pytest.raises(ValueError):
        resolve_paths("/b", "T", "dated")
    with pytest.raises(ValueError):
        resolve_paths("/b", "T", "other")
    assert table_mode("VWFUNDS", {"vwFunds"}) == "tree"
    assert table_mode("vwCalendar", {"vwFunds"}) == "dated"


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "t", "s", user="u", password="p", driver="d")
    assert plain == {
        "url": "jdbc:x", "dbtable": "s.t", "user": "u", "password": "p", "driver": "d",
        "fetchsize": "10000",
    }
    split = jdbc_options(
        "jdbc:x", "t", where="a > 1", partition_column="id",
        lower_bound=0, upper_bound=100, partitions=4,
    )
    assert split["dbtable"] == "(SELECT * FROM t WHERE a > 1) filtered"
    assert (split["lowerBound"], split["numPartitions"]) == ("0", "4")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")


def test_report_appends(spark, folder):
    one = spark.createDataFrame([("t", "Passed")], "`Table` string, Status string")
    write_report(one, f"{folder}/r")
    write_report(one.unionByName(one).repartition(3), f"{folder}/r")
    assert len(list(Path(folder, "r").glob("*.csv"))) == 2
    assert not Path(folder, "r", "_SUCCESS").exists()
    assert rows(read_delimited(spark, f"{folder}/r")) == [("t", "Passed")] * 3


def test_profile_is_quoted_and_replaced(spark, folder):
    for n in (1, 2):
        write_profile(spark.createDataFrame([("Profile", n)], "Profile string, N int"), f"{folder}/p")
    (file,) = Path(folder, "p").glob("*.csv")
    assert file.read_text() == '"Profile","N"\n"Profile","2"\n'


def test_text_and_staged(spark, folder):
    write_text(spark, "old", f"{folder}/x")
    write_text(spark, "Select 1", f"{folder}/x")
    (file,) = Path(folder, "x").glob("*.txt")
    assert file.read_text() == "Select 1\n"
    df = spark.range(10).selectExpr("id", "cast(id AS string) AS s")
    assert rows(write_staged(df.repartition(3), f"{folder}/s")) == rows(df)


def test_dictionaries(spark, folder):
    write(folder, "d.csv", "DECIMALS,TABNAME,FIELDNAME,DATATYPE,other\n2,T,a,DEC,z\n,T,b,CHAR,z\n")
    got = read_dictionary(spark, f"{folder}/d.csv", "erp")
    assert got.schema == ERP_SCHEMA
    assert [tuple(r) for r in got.collect()] == [("T", "a", "DEC", 2), ("T", "b", "CHAR", None)]
    got.write.parquet(f"{folder}/d")
    assert rows(read_dictionary(spark, f"{folder}/d", "erp")) == rows(got)
    staging = spark.createDataFrame(
        [("SRC", "TGT")], "`source table name` string, `target table name` string"
    )
    assert source_table(staging, "TGT") == "SRC"
    with pytest.raises(ValueError, match="not in the dictionary"):
        source_table(staging, "NONE")
