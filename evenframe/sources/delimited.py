"""Delimited file trees."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenframe.functions.columns import named

# The layouts in use.
COMMA = ","
TAB = "\t"
BAR_DOLLAR = "|$"
RECORD_SEPARATOR = "\u001e"
ENCODING = "UTF-8"
ESCAPE = "\\"

FILE_COLUMN = "filename"
HEADERS = ("strict", "by_name", "position")


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = COMMA,
    line_sep: str | None = None,
    infer: bool = False,
    schema: T.StructType | None = None,
    headers: str | None = None,
    with_file: bool | str = False,
    recursive: bool = True,
    glob: str | None = None,
    multi_line: bool = False,
    escape: str = ESCAPE,
) -> DataFrame:
    """Read files with a header row below ``path``.

    Columns are text unless ``infer`` asks for a pass over the data or
    ``schema`` lends the schema of the other side. ``headers`` says how files
    whose header differs from the first one's are taken:

    ``strict``    the read fails and names the file (the default)
    ``by_name``   files are grouped by header and united by column name
    ``position``  values go by position (the default with a lent schema)

    ``with_file`` adds the path of each row's file, as ``filename`` or under
    the given name. ``multi_line`` lets quoted fields hold record separators;
    such files cannot be split, so prefer a separator the text does not hold.
    ``escape`` is the character before a quote inside a quoted field.
    """
    if headers is None:
        headers = "position" if schema is not None else "strict"
    if headers not in HEADERS:
        raise ValueError(f"headers must be one of {HEADERS}, not {headers!r}")
    if infer and schema is not None:
        raise ValueError("give either infer or schema")

    def reader() -> DataFrameReader:
        read = (
            spark.read.option("header", True)
            .option("sep", sep)
            .option("quote", '"')
            .option("escape", escape)
            .option("encoding", ENCODING)
            .option("multiLine", multi_line)
            .option("recursiveFileLookup", recursive)
            .option("inferSchema", infer)
            .option("enforceSchema", headers != "strict")
        )
        if line_sep is not None:
            read = read.option("lineSep", line_sep)
        if glob is not None:
            read = read.option("pathGlobFilter", glob)
        return read if schema is None else read.schema(schema)

    paths = [path] if isinstance(path, str) else list(path)
    if headers == "by_name":
        if schema is not None:
            raise ValueError("a lent schema goes by position")
        groups = _files_by_header(spark, paths, line_sep, recursive, glob)
    else:
        groups = [paths]
    frames = []
    for files in groups:
        df = reader().csv(files)
        if with_file:
            name = FILE_COLUMN if with_file is True else with_file
            df = df.select(F.col("_metadata.file_path").alias(name), "*")
        frames.append(df)
    united = frames[0]
    for df in frames[1:]:
        united = _unite_by_name(united, df)
    return united


def _unite_by_name(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union by name; where inferred types disagree both sides become text."""
    types = {f.name.lower(): f.dataType for f in left.schema.fields}
    clash = {
        f.name.lower()
        for f in right.schema.fields
        if types.get(f.name.lower(), f.dataType) != f.dataType
        and isinstance(f.dataType, T.StringType)
        != isinstance(types[f.name.lower()], T.StringType)
    }

    def texts(df: DataFrame) -> DataFrame:
        return df.select(
            *[
                named(c).cast("string").alias(c) if c.lower() in clash else named(c)
                for c in df.columns
            ]
        )

    return texts(left).unionByName(texts(right), allowMissingColumns=True)


def _files_by_header(
    spark: SparkSession,
    paths: list[str],
    line_sep: str | None,
    recursive: bool,
    glob: str | None,
) -> list[list[str]]:
    """Files grouped by their header line, the first file's group first.

    The first lines are found by the executors in one pass over the text; the
    driver gets one short line per file, as it gets the file listing anyway.
    """
    read = spark.read.option("recursiveFileLookup", recursive)
    if line_sep is not None:
        read = read.option("lineSep", line_sep)
    if glob is not None:
        read = read.option("pathGlobFilter", glob)
    first_lines = (
        read.text(paths)
        .select(
            "value",
            "_metadata.file_path",
            "_metadata.file_block_start",
            F.monotonically_increasing_id().alias("place"),  # grows along a file
        )
        .where(F.col("file_block_start") == 0)
        .groupBy("file_path")
        .agg(F.min_by("value", "place").alias("header"))
        .orderBy("file_path")
    )
    groups: dict[str, list[str]] = {}
    for row in first_lines.toLocalIterator():
        groups.setdefault(row["header"], []).append(unquote(row["file_path"]))
    return list(groups.values()) or [paths]
