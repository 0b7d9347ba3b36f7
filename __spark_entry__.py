"""Registered queries and the SQL that states the same results.

The *actual* copies are derived from the given tables by plain predicates, the
same ones on both engines: some rows are lost, some changed, some repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import evenframe as ef
from evenframe.functions.durable import new_folder
from evenframe.operators import (
    align,
    header_frame,
    map_header,
    project,
)
from evenframe.plans.suite import ProfileSpec, profile_suite
from evenframe.sources import (
    BAR_DOLLAR,
    CRM_SCHEMA,
    ERP_SCHEMA,
    RECORD_SEPARATOR,
    STAGING_SCHEMA,
    TAB,
    load_dictionary,
    read_delimited,
    write_delimited,
    write_staged,
)

Query = Callable[[SparkSession, str], DataFrame]

try:  # the training-data operators may be left out
    import corpus_pipeline
    from evenframe.llm import queries as llm
except ModuleNotFoundError as missing:
    if not f"{missing.name}.".startswith(("corpus_pipeline.", "evenframe.llm.")):
        raise
    corpus_pipeline = llm = None

SMOKE_DIR = "/root/testdata/sf0.001"

LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
ORDER_COLUMNS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
    "o_orderpriority",
]
LINE_KEY = ["l_orderkey", "l_linenumber"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- derived copies ---------------------------------------------------------


def changed_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """March 1997 is lost, quantities of June 1998 are one higher."""
    lost = "l_shipdate >= TIMESTAMP_NTZ'1997-03-01' AND l_shipdate < TIMESTAMP_NTZ'1997-04-01'"
    later = "l_shipdate >= TIMESTAMP_NTZ'1998-06-01' AND l_shipdate < TIMESTAMP_NTZ'1998-07-01'"
    return (
        table(spark, folder, "lineitem")
        .where(~F.expr(lost))
        .withColumn(
            "l_quantity",
            F.when(F.expr(later), F.col("l_quantity") + 1).otherwise(F.col("l_quantity")),
        )
    )


CHANGED_LINEITEM = """
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CASE WHEN l_shipdate >= TIMESTAMP '1998-06-01' AND l_shipdate < TIMESTAMP '1998-07-01'
              THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem
  WHERE NOT (l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-04-01')
"""


def repeated_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """The changed copy with January 1996 loaded twice more."""
    again = table(spark, folder, "lineitem").where(
        "l_shipdate >= TIMESTAMP_NTZ'1996-01-01' AND l_shipdate < TIMESTAMP_NTZ'1996-02-01'"
    )
    return changed_lineitem(spark, folder).unionByName(again).unionByName(again)


JANUARY = """
  SELECT * FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1996-02-01'
"""
REPEATED_LINEITEM = f"{CHANGED_LINEITEM} UNION ALL {JANUARY} UNION ALL {JANUARY}"


def changed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Urgent pending orders are lost, finished low ones cheaper, some without status."""
    return (
        table(spark, folder, "orders")
        .where(~F.expr("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'"))
        .withColumn(
            "o_totalprice",
            F.expr(
                "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' "
                "THEN o_totalprice * 0.5D ELSE o_totalprice END"
            ),
        )
        .withColumn(
            "o_orderstatus",
            F.expr(
                "CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' "
                "THEN NULL ELSE o_orderstatus END"
            ),
        )
    )


CHANGED_ORDERS = """
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O'
              THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F'
              THEN o_totalprice * CAST(0.5 AS DOUBLE) ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders
  WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')
"""


def versioned_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Every order with an older version; some have a second row of equal date."""
    orders = table(spark, folder, "orders")
    older = orders.withColumns(
        {
            "o_orderdate": F.expr("o_orderdate - INTERVAL 30 DAYS"),
            "o_totalprice": F.expr("o_totalprice * 0.5D"),
        }
    )
    tied = orders.where("o_orderpriority = '5-LOW' AND o_orderstatus = 'F'").withColumn(
        "o_totalprice", F.expr("o_totalprice * 0.5D")
    )
    return orders.unionByName(older).unionByName(tied)


VERSIONED_ORDERS = """
  SELECT * FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * CAST(0.5 AS DOUBLE),
         o_orderdate - INTERVAL 30 DAY, o_orderpriority FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * CAST(0.5 AS DOUBLE),
         o_orderdate, o_orderpriority FROM orders
  WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F'
"""


def changed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """German texts got a trailing mark; the rest is untouched."""
    return table(spark, folder, "documents").withColumn(
        "text", F.expr("CASE WHEN lang = 'de' THEN concat(text, ' *') ELSE text END")
    )


CHANGED_DOCUMENTS = """
  SELECT doc_id, CASE WHEN lang = 'de' THEN concat(text, ' *') ELSE text END AS text,
         lang, source, n_chars FROM documents
"""


def customer_files(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as text files deliver them: two files, padded texts, holes."""
    customer = table(spark, folder, "customer")

    def delivered(file: str, modified: str) -> DataFrame:
        return customer.select(
            F.lit(file).alias("filename"),
            F.col("c_custkey").cast("string").alias("Id"),
            F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("Name"),
            F.expr("nullif(c_mktsegment, 'HOUSEHOLD')").alias("Segment"),
            F.expr(
                "CASE c_mktsegment WHEN 'MACHINERY' THEN ' TRUE' WHEN 'BUILDING' THEN NULL "
                "ELSE 'False ' END"
            ).alias("Active"),
            F.expr("nullif(c_nationkey, 7)").alias("Nation"),
            F.expr("CASE WHEN c_nationkey = 3 THEN NULL ELSE ' 2020-02-29' END").alias("Since"),
            F.expr(modified).alias("Modified"),
            F.col("c_nationkey").cast("string").alias("Extra"),
        )

    return delivered(
        "a.csv", "CASE WHEN c_nationkey = 5 THEN NULL ELSE '2024-01-01 10:00:00.000' END"
    ).unionByName(
        delivered(
            "b.csv",
            "CASE WHEN c_nationkey < 10 THEN '2024-01-01 10:00:00.000' "
            "ELSE '2023-06-01 00:00:00.000' END",
        )
    )


def _delivered_sql(file: str, modified: str) -> str:
    return f"""
  SELECT '{file}' AS filename, CAST(c_custkey AS VARCHAR) AS "Id",
         concat('  ', c_name, ' ') AS "Name",
         nullif(c_mktsegment, 'HOUSEHOLD') AS "Segment",
         CASE c_mktsegment WHEN 'MACHINERY' THEN ' TRUE' WHEN 'BUILDING' THEN NULL
              ELSE 'False ' END AS "Active",
         nullif(c_nationkey, 7) AS "Nation",
         CASE WHEN c_nationkey = 3 THEN NULL ELSE ' 2020-02-29' END AS "Since",
         {modified} AS "Modified", CAST(c_nationkey AS VARCHAR) AS "Extra"
  FROM customer"""


CUSTOMER_FILES = (
    _delivered_sql(
        "a.csv", "CASE WHEN c_nationkey = 5 THEN NULL ELSE '2024-01-01 10:00:00.000' END"
    )
    + " UNION ALL "
    + _delivered_sql(
        "b.csv",
        "CASE WHEN c_nationkey < 10 THEN '2024-01-01 10:00:00.000' "
        "ELSE '2023-06-01 00:00:00.000' END",
    )
)

# --- dictionaries -----------------------------------------------------------

ERP_ROWS = [
    ("lineitem", "l_orderkey", "INT8", 0),
    ("lineitem", "l_partkey", "INT8", 0),
    ("lineitem", "l_suppkey", "SSTRING", None),
    ("lineitem", "l_linenumber", "NUMC", None),
    ("lineitem", "l_quantity", "QUAN", 2),
    ("lineitem", "l_extendedprice", "CURR", 2),
    ("lineitem", "l_discount", "DEC", 4),
    ("lineitem", "l_tax", "DEC", 4),
    ("lineitem", "l_returnflag", "CHAR", None),
    ("lineitem", "l_linestatus", "LANG", None),
    ("lineitem", "l_shipdate", "DATS", None),
    ("orders", "o_orderkey", "INT8", 0),
    ("small", "price", "DEC", 9),
    ("small", "price_text", "CURR", 9),
]
CRM_ROWS = [
    ("orders", "o_orderkey", "Id"),
    ("orders", "o_custkey", "Lookup(Account)"),
    ("orders", "o_orderstatus", "Picklist"),
    ("orders", "o_totalprice", "Currency(18, 2)"),
    ("orders", "o_margin", "Formula (Currency)"),
    ("orders", "o_orderdate", "Date/Time"),
    ("orders", "o_orderday", "Date"),
    ("orders", "o_urgent", "Checkbox"),
    ("orders", "o_orderpriority", "Text(20)"),
    ("orders", "o_shippriority", "Hierarchy"),
    ("events", "event_id", "Number(18, 0)"),
    ("events", "ts", "Date/Time"),
    ("events", "event_type", "Picklist"),
    ("labels", "doc_id", "Number(18, 0)"),
    ("labels", "quality", "Checkbox"),
    ("labels", "toxic", "Boolean"),
    ("returns", "returned", "Checkbox"),
    ("returns", "l_orderkey", "Number(18, 0)"),
]
STAGING_ROWS = [
    ("Account", "Id", "string", "primary", "R_ACC", "ACC_ID", "VARCHAR", None),
    ("Account", "Name", "string", None, "R_ACC", "ACC_NAM", "STRING", "PII"),
    ("Account", "Segment", "string", None, "R_ACC", "ACC_SEG", "VARCHAR", None),
    ("Account", "Active", "boolean", None, "R_ACC", "ACC_ACT", "BOOLEAN", None),
    ("Account", "Nation", "int", None, "R_ACC", "ACC_NAT", "INTEGER", None),
    ("Account", "Since", "date", None, "R_ACC", "ACC_SNC", "DATE", None),
    ("Account", "Modified", "datetime", None, "R_ACC", "SYS_MST_DAT", "TIMESTAMP", None),
]
STAGED_COLUMNS = [
    "ACC_ID", "ACC_NAM", "ACC_SEG", "ACC_ACT", "ACC_NAT", "ACC_SNC", "SYS_MST_DAT",
]


def erp(spark: SparkSession, name: str) -> DataFrame:
    return load_dictionary(spark.createDataFrame(ERP_ROWS, ERP_SCHEMA), name)


def crm(spark: SparkSession, name: str) -> DataFrame:
    return load_dictionary(spark.createDataFrame(CRM_ROWS, CRM_SCHEMA), name)


# --- comparisons ------------------------------------------------------------


def compare_two_way(spark: SparkSession, folder: str) -> DataFrame:
    return ef.compare(
        table(spark, folder, "lineitem"), changed_lineitem(spark, folder), "lineitem"
    )


def compare_one_way(spark: SparkSession, folder: str) -> DataFrame:
    return ef.compare(
        table(spark, folder, "orders"),
        changed_orders(spark, folder),
        "orders",
        mode="one_way",
        keys=["o_orderkey"],
    )


def compare_one_way_no_keys(spark: SparkSession, folder: str) -> DataFrame:
    return ef.compare(
        table(spark, folder, "documents"),
        changed_documents(spark, folder),
        "documents",
        mode="one_way",
    )


def compare_multiset(spark: SparkSession, folder: str) -> DataFrame:
    return ef.compare(
        table(spark, folder, "lineitem"), repeated_lineitem(spark, folder), "lineitem"
    )


def compare_keys(spark: SparkSession, folder: str) -> DataFrame:
    return ef.compare(
        table(spark, folder, "lineitem"),
        changed_lineitem(spark, folder),
        keys=LINE_KEY,
    )


def compare_equal(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    reordered = lineitem.select(*reversed(lineitem.columns))
    return ef.compare(lineitem, reordered, "lineitem", by="name")


def compare_structure(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    return ef.compare(lineitem, changed_lineitem(spark, folder).drop("l_tax"), "lineitem")


def compare_extra_column(spark: SparkSession, folder: str) -> DataFrame:
    """Sides that are equal in the listed columns, one of them with a column more."""
    lineitem = table(spark, folder, "lineitem")
    more = lineitem.withColumn("l_note", F.lit("x"))
    return ef.compare(lineitem, more, "lineitem", columns=lineitem.columns)


def compare_wide_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers beyond 2^53 against the doubles next to them."""
    wide = table(spark, folder, "orders").select(
        (F.col("o_orderkey") + F.lit(2**53)).cast("bigint").alias("id")
    )
    return ef.compare(wide, wide.select(F.col("id").cast("double").alias("id")), "orders")


def compare_empty_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Profile files without a row have no row counts to agree on."""
    profiles = ef.profile(
        table(spark, folder, "lineitem"),
        erp(spark, "lineitem"),
        change_column="l_shipdate",
    ).where("TOTAL_ROW_COUNT < 0")
    return ef.compare_profiles(profiles, profiles, "lineitem")


def compare_text(spark: SparkSession, folder: str) -> DataFrame:
    return ef.compare(
        table(spark, folder, "documents"), changed_documents(spark, folder), "documents"
    )


def compare_versioned(spark: SparkSession, folder: str) -> DataFrame:
    return ef.compare(
        table(spark, folder, "orders"),
        versioned_orders(spark, folder),
        "orders",
        columns=ORDER_COLUMNS,
        latest=ef.LatestBy(keys=["O_ORDERKEY"], order="O_ORDERDATE"),
    )


def lineitem_profiles(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    def of(df: DataFrame) -> DataFrame:
        return ef.profile(
            df, erp(spark, "lineitem"), change_column="l_shipdate", read_as="columnar"
        )

    return of(table(spark, folder, "lineitem")), of(changed_lineitem(spark, folder))


def compare_profiles(spark: SparkSession, folder: str) -> DataFrame:
    expected, actual = lineitem_profiles(spark, folder)
    return ef.compare_profiles(expected, actual, "lineitem")


def mismatching_columns_profile(spark: SparkSession, folder: str) -> DataFrame:
    expected, actual = lineitem_profiles(spark, folder)
    return ef.mismatching_columns(align(expected, actual), name="mismatching_columns")


def mismatching_columns_keyed(spark: SparkSession, folder: str) -> DataFrame:
    sides = align(table(spark, folder, "orders"), changed_orders(spark, folder))
    return ef.mismatch_counts(sides, keys=["o_orderkey"])


def diff_rows(spark: SparkSession, folder: str) -> DataFrame:
    return ef.diff_rows(
        align(table(spark, folder, "lineitem"), repeated_lineitem(spark, folder))
    )


def diff_rows_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Few distinct rows with very many copies each."""
    columns = ["l_returnflag", "l_linestatus"]
    return ef.diff_rows(
        align(
            table(spark, folder, "lineitem"), repeated_lineitem(spark, folder), columns
        ),
        copies_per_chunk=100,
    )


def labelled_diff(spark: SparkSession, folder: str) -> DataFrame:
    return ef.labelled_diff(
        align(table(spark, folder, "lineitem"), repeated_lineitem(spark, folder))
    )


def suite_report(spark: SparkSession, folder: str) -> DataFrame:
    specs = [
        ef.TableSpec(
            "lineitem",
            lambda: table(spark, folder, "lineitem"),
            lambda: repeated_lineitem(spark, folder),
        ),
        ef.TableSpec(
            "customer",
            lambda: table(spark, folder, "customer"),
            lambda: table(spark, folder, "customer"),
        ),
        ef.TableSpec(
            "orders",
            lambda: table(spark, folder, "orders"),
            lambda: changed_orders(spark, folder),
        ),
    ]
    return ef.run_suite(spark, specs)


def suite_not_found(spark: SparkSession, folder: str) -> DataFrame:
    """A suite one of whose tables is missing; the message names a path and is left out."""
    specs = [
        ef.TableSpec(
            "orders",
            lambda: table(spark, folder, "orders"),
            lambda: changed_orders(spark, folder),
        ),
        ef.TableSpec(
            "missing",
            lambda: table(spark, folder, "orders"),
            lambda: table(spark, folder, "no_such_table"),
        ),
        ef.TableSpec(
            "nation",
            lambda: table(spark, folder, "nation"),
            lambda: table(spark, folder, "nation"),
        ),
    ]
    return ef.run_suite(spark, specs).drop("Details")


# --- map columns ------------------------------------------------------------


def order_attributes(orders: DataFrame, *names: str) -> DataFrame:
    """Orders with the named attributes as a map, in that order, within an array of structs."""
    entries = [x for n in names for x in (F.lit(n), F.col(f"o_order{n}"))]
    return orders.select(
        "o_orderkey",
        F.create_map(*entries).alias("attributes"),
        F.array(F.struct(F.create_map(*entries).alias("found"))).alias("nested"),
    )


def attribute_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    expected, actual = table(spark, folder, "orders"), changed_orders(spark, folder)
    return order_attributes(expected, "status", "priority"), order_attributes(actual, "priority", "status")


def compare_maps(spark: SparkSession, folder: str) -> DataFrame:
    return ef.compare(*attribute_sides(spark, folder), "orders")


def diff_map_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = ef.diff_rows(ef.align(*attribute_sides(spark, folder), maps="entries"))
    text = F.transform("attributes", lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("?"))))
    return rows.select("side", "o_orderkey", F.concat_ws(",", text).alias("attributes"))


def mismatching_maps(spark: SparkSession, folder: str) -> DataFrame:
    return ef.mismatch_counts(ef.align(*attribute_sides(spark, folder), maps="entries"), ["o_orderkey"])


# --- latest versions --------------------------------------------------------


def latest_cdc(spark: SparkSession, folder: str) -> DataFrame:
    return ef.latest_cdc(
        table(spark, folder, "events"),
        ["user_id"],
        operation="event_type",
        changed_at="ts",
        priority={"error": 1, "click": 2, "signup": 3},
    )


def latest_cdc_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Changes with the codes D, U and I, and one that has no priority."""
    changes = table(spark, folder, "events").withColumn(
        "operation",
        F.expr("CASE event_type WHEN 'error' THEN 'D' WHEN 'click' THEN 'U' WHEN 'signup' THEN 'I' ELSE 'R' END"),
    )
    return ef.latest_cdc(changes, ["user_id"], operation="operation", changed_at="ts")


def latest_rank(spark: SparkSession, folder: str) -> DataFrame:
    return ef.latest_by(
        table(spark, folder, "lineitem"), ["l_orderkey"], "l_shipdate", ties="all"
    )


def latest_row_number(spark: SparkSession, folder: str) -> DataFrame:
    return ef.latest_by(
        table(spark, folder, "lineitem"), ["l_orderkey"], "l_shipdate", ties="one"
    )


def latest_staged(spark: SparkSession, folder: str) -> DataFrame:
    return ef.latest_by(
        table(spark, folder, "lineitem"),
        ["l_orderkey"],
        "l_shipdate",
        tie_break=["l_returnflag"],
        keep_rank="cnt",
    )


def distinct_key_count(spark: SparkSession, folder: str) -> DataFrame:
    return ef.distinct_key_count(
        table(spark, folder, "events"), ["user_id", "event_type"]
    )


# --- profiles ---------------------------------------------------------------


def profile_erp(spark: SparkSession, folder: str) -> DataFrame:
    return ef.profile(
        table(spark, folder, "lineitem"),
        erp(spark, "lineitem"),
        change_column="l_shipdate",
        read_as="columnar",
    )


def profile_erp_source(spark: SparkSession, folder: str) -> DataFrame:
    return ef.profile(
        table(spark, folder, "lineitem"),
        erp(spark, "lineitem"),
        side="source",
        change_column="l_shipdate",
    )


def crm_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "*",
        "o_totalprice * 0.25D AS o_margin",
        "CAST(o_orderdate AS DATE) AS o_orderday",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'True' WHEN '5-LOW' THEN 'False' "
        "WHEN '2-HIGH' THEN '1' WHEN '3-MEDIUM' THEN 'maybe' END AS o_urgent",
        "nullif(o_orderstatus, 'P') AS o_shippriority",
    )


CRM_ORDERS = """
  SELECT *, o_totalprice * CAST(0.25 AS DOUBLE) AS o_margin,
         CAST(o_orderdate AS DATE) AS o_orderday,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'True' WHEN '5-LOW' THEN 'False'
              WHEN '2-HIGH' THEN '1' WHEN '3-MEDIUM' THEN 'maybe' END AS o_urgent,
         nullif(o_orderstatus, 'P') AS o_shippriority
  FROM orders
"""


def profile_crm(spark: SparkSession, folder: str) -> DataFrame:
    return ef.profile(
        crm_orders(spark, folder),
        crm(spark, "orders"),
        rules="crm",
        change_column="o_orderdate",
        read_as="columnar",
    )


def profile_crm_source(spark: SparkSession, folder: str) -> DataFrame:
    flags = crm_orders(spark, folder).withColumn(
        "o_urgent", F.col("o_orderpriority") == "1-URGENT"
    )
    return ef.profile(
        flags,
        crm(spark, "orders"),
        rules="crm",
        side="source",
        change_column="o_orderdate",
        read_as="columnar",
    )


def profile_crm_flags(spark: SparkSession, folder: str) -> DataFrame:
    return ef.profile(
        table(spark, folder, "labels"),
        crm(spark, "labels"),
        rules="crm",
        change_column="doc_id",
    )


def profile_small_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Sums of doubles and texts that lie below the digits of the result."""
    small = table(spark, folder, "lineitem").select(
        "l_shipdate",
        (F.col("l_extendedprice") * F.lit(1e-15)).alias("price"),
        (F.col("l_extendedprice") * F.lit(1e-15)).cast("string").alias("price_text"),
    )
    return ef.profile(small, erp(spark, "small"), change_column="l_shipdate")


def profile_number_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Flags that are texts of numbers count as these numbers."""
    returns = table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_returnflag") == "A", "True")
        .when(F.col("l_returnflag") == "N", "0.5")
        .otherwise("1.0")
        .alias("returned"),
    )
    return ef.profile(
        returns, crm(spark, "returns"), rules="crm", change_column="l_orderkey"
    )


def profile_crm_datetime(spark: SparkSession, folder: str) -> DataFrame:
    return ef.profile(
        table(spark, folder, "events"), crm(spark, "events"), rules="crm", change_column="ts"
    )


def profile_latest(spark: SparkSession, folder: str) -> DataFrame:
    return ef.profile_table(
        table(spark, folder, "lineitem"),
        erp(spark, "lineitem"),
        change_column="l_shipdate",
        latest_keys=["l_orderkey"],
    )


PROFILE_SELECT = (
    "SELECT 'Profile' AS Profile, COUNT(*) AS TOTAL_ROW_COUNT, "
    "MAX(o_orderdate) AS MAX_MODIFICATION_DATE, "
    "SUM(LENGTH(o_orderpriority)) AS SUM_LEN_o_orderpriority, "
    "COUNT(DISTINCT(o_custkey)) AS COUNT_DISTINCT_o_custkey"
)


def profile_sql_view(spark: SparkSession, folder: str) -> DataFrame:
    return ef.run_profile_sql(table(spark, folder, "orders"), PROFILE_SELECT, "orders")


def profile_sql_latest(spark: SparkSession, folder: str) -> DataFrame:
    return ef.run_profile_sql(
        table(spark, folder, "orders"),
        PROFILE_SELECT,
        "latest_orders",
        latest_key="o_custkey",
        change_column="o_orderdate",
    )


# --- staging and checks -----------------------------------------------------


def staged_customers(
    spark: SparkSession, folder: str, latest_only: bool = True
) -> DataFrame:
    files = customer_files(spark, folder)
    dictionary = load_dictionary(
        spark.createDataFrame(STAGING_ROWS, STAGING_SCHEMA), "R_ACC"
    )
    header = header_frame(files.drop("filename"))
    return ef.stage_table(
        files, map_header(header, dictionary), latest_only=latest_only
    )


def stage_table(spark: SparkSession, folder: str) -> DataFrame:
    return staged_customers(spark, folder, latest_only=False)


def target_customers(spark: SparkSession, folder: str) -> DataFrame:
    """The loaded target: nation 20 is missing, nation 21 has another segment."""
    return (
        table(spark, folder, "customer")
        .where("c_nationkey <> 20")
        .selectExpr(
            "CAST(c_custkey AS STRING) AS ACC_ID",
            "c_name AS ACC_NAM",
            "CASE WHEN c_nationkey = 21 THEN 'NONE' "
            "ELSE coalesce(nullif(c_mktsegment, 'HOUSEHOLD'), '#') END AS ACC_SEG",
            "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'true' ELSE 'false' END AS ACC_ACT",
            "coalesce(nullif(c_nationkey, 7), 0) AS ACC_NAT",
            "CASE WHEN c_nationkey = 3 THEN '1000-01-01' ELSE '2020-02-29' END AS ACC_SNC",
            "'2024-01-01 10:00:00.000' AS SYS_MST_DAT",
        )
    )


TARGET_CUSTOMERS = """
  SELECT CAST(c_custkey AS VARCHAR) AS ACC_ID, c_name AS ACC_NAM,
         CASE WHEN c_nationkey = 21 THEN 'NONE'
              ELSE coalesce(nullif(c_mktsegment, 'HOUSEHOLD'), '#') END AS ACC_SEG,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'true' ELSE 'false' END AS ACC_ACT,
         coalesce(nullif(c_nationkey, 7), 0) AS ACC_NAT,
         CASE WHEN c_nationkey = 3 THEN '1000-01-01' ELSE '2020-02-29' END AS ACC_SNC,
         '2024-01-01 10:00:00.000' AS SYS_MST_DAT
  FROM customer WHERE c_nationkey <> 20
"""


def row_count_check(spark: SparkSession, folder: str) -> DataFrame:
    return ef.row_count_check(
        staged_customers(spark, folder), target_customers(spark, folder)
    )


def row_count_check_pass(spark: SparkSession, folder: str) -> DataFrame:
    return ef.row_count_check(
        staged_customers(spark, folder), table(spark, folder, "customer")
    )


def staged_diff(spark: SparkSession, folder: str) -> DataFrame:
    return ef.staged_diff(
        staged_customers(spark, folder), target_customers(spark, folder), STAGED_COLUMNS
    )


def column_count_check(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as a metadata table: language = table, source = field."""
    documents = table(spark, folder, "documents")
    metadata = documents.selectExpr("upper(lang) AS SOURCE_TABLE", "source AS SOURCE_FIELD")
    header = header_frame(documents.drop("doc_id"))
    return ef.column_count_check(metadata, "en", header)


def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return ef.duplicate_keys(table(spark, folder, "lineitem"), LINE_KEY, copies="copies")


def duplicate_keys_text(spark: SparkSession, folder: str) -> DataFrame:
    return ef.duplicate_keys(table(spark, folder, "documents"), ["lang", "text"])


# --- files ------------------------------------------------------------------


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Comma files, everything text when read back."""
    path = new_folder(spark, "csv")
    write_delimited(table(spark, folder, "customer"), path)
    return read_delimited(spark, path)


def csv_inferred_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "csv-inferred")
    write_delimited(table(spark, folder, "part"), path)
    return read_delimited(spark, path, infer=True).withColumn(
        "p_partkey", F.col("p_partkey").cast("bigint")
    )


def csv_record_separator_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with line feeds, fields parted by two characters."""
    path = new_folder(spark, "csv-rs")
    documents = table(spark, folder, "documents")
    write_delimited(documents, path, sep=BAR_DOLLAR, line_sep=RECORD_SEPARATOR)
    back = read_delimited(spark, path, sep=BAR_DOLLAR, line_sep=RECORD_SEPARATOR)
    return back.withColumns(
        {c: F.col(c).cast("bigint") for c in ("doc_id", "n_chars")}
    )


def tsv_borrowed_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Tab files read under the schema of the other side."""
    path = new_folder(spark, "tsv")
    orders = table(spark, folder, "orders")
    write_delimited(orders, path, sep=TAB)
    return read_delimited(spark, path, sep=TAB, schema=orders.schema)


def compare_files(spark: SparkSession, folder: str) -> DataFrame:
    """A table against tab files of its changed copy, under the table's schema."""
    path = new_folder(spark, "compare-tsv")
    orders = table(spark, folder, "orders")
    write_delimited(changed_orders(spark, folder), path, sep=TAB)
    files = read_delimited(spark, path, sep=TAB, schema=orders.schema)
    return ef.compare(orders, files, "orders")


def stage_files(spark: SparkSession, folder: str) -> DataFrame:
    """Customer files written, read with the file of each row, staged, stored and read back."""
    path = new_folder(spark, "delivered")
    delivered = customer_files(spark, folder)
    for name in ("a", "b"):
        mine = delivered.where(F.col("filename") == f"{name}.csv").drop("filename")
        write_delimited(mine, f"{path}/{name}")
    files = read_delimited(spark, path, with_file=True)
    files = files.withColumn("filename", F.concat(F.regexp_extract("filename", "/([ab])/[^/]*$", 1), F.lit(".csv")))
    dictionary = load_dictionary(spark.createDataFrame(STAGING_ROWS, STAGING_SCHEMA), "R_ACC")
    staged = ef.stage_table(files, map_header(header_frame(files.drop("filename")), dictionary))
    return write_staged(staged, new_folder(spark, "staged"))


def profile_files(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles of two file trees, written by a suite, read back and compared."""
    path = new_folder(spark, "profiles")
    sides = {"expected": table(spark, folder, "lineitem"), "actual": changed_lineitem(spark, folder)}
    for side, rows in sides.items():
        write_delimited(rows, f"{path}/{side}", sep=TAB)
    specs = [
        ProfileSpec(
            side,
            lambda side=side, rows=rows: read_delimited(spark, f"{path}/{side}", sep=TAB, schema=rows.schema),
            erp(spark, "lineitem"),
            {"change_column": "l_shipdate"},
        )
        for side, rows in sides.items()
    ]
    written = profile_suite(spark, specs, lambda side: f"{path}/profile-{side}")
    if written.where("Status != 'Passed'").count():
        raise RuntimeError(str(written.collect()))
    expected, actual = (read_delimited(spark, f"{path}/profile-{side}") for side in sides)
    return ef.compare_profiles(expected, actual, "lineitem")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: two-way comparison of a table with a changed copy."""
    return compare_two_way(spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    found = [
        compare_two_way, compare_one_way, compare_one_way_no_keys, compare_multiset,
        compare_keys, compare_equal, compare_structure, compare_text, compare_versioned,
        compare_extra_column, compare_wide_numbers, compare_empty_profiles,
        profile_small_numbers, profile_number_flags,
        compare_profiles, mismatching_columns_profile, mismatching_columns_keyed,
        diff_rows, diff_rows_copies, labelled_diff, suite_report,
        latest_cdc, latest_rank, latest_row_number, latest_staged, distinct_key_count,
        profile_erp, profile_erp_source, profile_crm, profile_crm_source,
        profile_crm_flags, profile_crm_datetime, profile_latest,
        profile_sql_view, profile_sql_latest,
        stage_table, row_count_check, row_count_check_pass, staged_diff,
        column_count_check, duplicate_keys, duplicate_keys_text,
        csv_roundtrip, csv_inferred_roundtrip, csv_record_separator_roundtrip,
        tsv_borrowed_roundtrip, compare_files,
        suite_not_found, compare_maps, diff_map_rows, mismatching_maps,
        latest_cdc_codes, stage_files, profile_files,
    ]
    named = {query.__name__: query for query in found}
    if llm is not None:
        named |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return named


# --- the same results in SQL ------------------------------------------------


def _two_way_sql(name: str, expected: str, actual: str, n: int, ctes: str = "") -> str:
    return f"""
WITH {ctes} e AS ({expected}), a AS ({actual}),
n AS (
  SELECT (SELECT COUNT(*) FROM e) AS er, (SELECT COUNT(*) FROM a) AS ar,
         (SELECT COUNT(*) FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM a)) AS ea,
         (SELECT COUNT(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM e)) AS ae)
SELECT '{name}' AS "Table",
       CASE WHEN er = ar AND ea = 0 AND ae = 0 THEN 'Passed' ELSE 'Failed' END AS "Status",
       '' AS "Details",
       CAST(er AS VARCHAR) AS "Expected rows", CAST(ar AS VARCHAR) AS "Actual rows",
       '{n}' AS "Expected columns", '{n}' AS "Actual columns",
       CAST(ea AS VARCHAR) AS "Expected minus Actual count",
       CAST(ae AS VARCHAR) AS "Actual minus Expected count"
FROM n"""


def _multiset_differs(column: str) -> str:
    return (
        f"EXISTS ((SELECT {column} FROM e EXCEPT ALL SELECT {column} FROM a) "
        f"UNION ALL (SELECT {column} FROM a EXCEPT ALL SELECT {column} FROM e))"
    )


def _one_way_sql(name: str, expected: str, actual: str, mismatching: str, n: int) -> str:
    return f"""
WITH e AS ({expected}), a AS ({actual}),
m AS (SELECT {mismatching} AS names),
n AS (
  SELECT (SELECT COUNT(*) FROM e) AS er, (SELECT COUNT(*) FROM a) AS ar,
         (SELECT COUNT(*) FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM a)) AS ea)
SELECT '{name}' AS "Table",
       CASE WHEN er = ar AND ea = 0 THEN 'Passed' ELSE 'Failed' END AS "Status",
       '' AS "Details",
       CAST(er AS VARCHAR) AS "Expected rows", CAST(ar AS VARCHAR) AS "Actual rows",
       '{n}' AS "Expected columns", '{n}' AS "Actual columns",
       CASE WHEN ea = 0 THEN 'Data matching' ELSE 'Data mismatching' END AS "Data Comparison",
       CASE WHEN ea = 0 OR names = '' THEN 'NA' ELSE names END AS "Mismatching columns"
FROM n, m"""


def _keyed_mismatch(column: str) -> str:
    return (
        f"(SELECT CAST(COUNT(*) AS BIGINT) FROM e FULL JOIN a ON e.o_orderkey = a.o_orderkey "
        f"WHERE e.o_orderkey IS NULL OR a.o_orderkey IS NULL "
        f"OR e.{column} IS DISTINCT FROM a.{column})"
    )


ERP_PROFILE = """
  SELECT 'Profile' AS "Profile", COUNT(*) AS "TOTAL_ROW_COUNT",
         MAX(l_shipdate) AS "MAX_MODIFICATION_DATE",
         CAST(SUM(l_orderkey) AS DECIMAL(30,0)) AS "SUM_l_orderkey",
         CAST(SUM(l_partkey) AS DECIMAL(30,0)) AS "SUM_l_partkey",
         COUNT(DISTINCT l_suppkey) AS "COUNT_DISTINCT_l_suppkey",
         CAST(SUM(LENGTH(CAST(l_linenumber AS VARCHAR))) AS BIGINT) AS "SUM_LEN_l_linenumber",
         COUNT(DISTINCT l_linenumber) AS "COUNT_DISTINCT_l_linenumber",
         CAST(SUM(l_quantity) AS DECIMAL(30,2)) AS "SUM_l_quantity",
         CAST(SUM(l_extendedprice) AS DECIMAL(30,2))
           AS "SUM_l_extendedprice",
         CAST(SUM(l_discount) AS DECIMAL(30,4)) AS "SUM_l_discount",
         CAST(SUM(l_tax) AS DECIMAL(30,4)) AS "SUM_l_tax",
         CAST(SUM(LENGTH(l_returnflag)) AS BIGINT) AS "SUM_LEN_l_returnflag",
         COUNT(DISTINCT l_returnflag) AS "COUNT_DISTINCT_l_returnflag",
         CAST(SUM(LENGTH(l_linestatus)) AS BIGINT) AS "SUM_LEN_l_linestatus",
         COUNT(DISTINCT l_linestatus) AS "COUNT_DISTINCT_l_linestatus",
         COUNT(DISTINCT l_shipdate) AS "COUNT_DISTINCT_l_shipdate",
         CAST(SUM(LENGTH(CAST(l_shipdate AS VARCHAR))) AS BIGINT) AS "SUM_LEN_l_shipdate"
  FROM {source}"""
ERP_PROFILE_NAMES = [
    "Profile", "TOTAL_ROW_COUNT", "MAX_MODIFICATION_DATE", "SUM_l_orderkey",
    "SUM_l_partkey", "COUNT_DISTINCT_l_suppkey", "SUM_LEN_l_linenumber",
    "COUNT_DISTINCT_l_linenumber", "SUM_l_quantity", "SUM_l_extendedprice",
    "SUM_l_discount", "SUM_l_tax", "SUM_LEN_l_returnflag", "COUNT_DISTINCT_l_returnflag",
    "SUM_LEN_l_linestatus", "COUNT_DISTINCT_l_linestatus", "COUNT_DISTINCT_l_shipdate",
    "SUM_LEN_l_shipdate",
]

CRM_PROFILE = """
SELECT 'Profile' AS "Profile", COUNT(*) AS "TOTAL_ROW_COUNT",
       MAX(o_orderdate) AS "MAX_MODIFICATION_DATE",
       CAST(SUM(LENGTH(CAST(o_orderkey AS VARCHAR))) AS BIGINT) AS "SUM_LEN_o_orderkey",
       COUNT(DISTINCT o_orderkey) AS "COUNT_DISTINCT_o_orderkey",
       CAST(SUM(LENGTH(CAST(o_custkey AS VARCHAR))) AS BIGINT) AS "SUM_LEN_o_custkey",
       COUNT(DISTINCT o_custkey) AS "COUNT_DISTINCT_o_custkey",
       CAST(SUM(LENGTH(o_orderstatus)) AS BIGINT) AS "SUM_LEN_o_orderstatus",
       COUNT(DISTINCT o_orderstatus) AS "COUNT_DISTINCT_o_orderstatus",
       {price} AS "SUM_o_totalprice",
       {margin} AS "SUM_o_margin",
       COUNT(DISTINCT o_orderdate) AS "COUNT_DISTINCT_o_orderdate",
       CAST(SUM(LENGTH({time})) AS BIGINT) AS "SUM_LEN_o_orderdate",
       COUNT(DISTINCT o_orderday) AS "COUNT_DISTINCT_o_orderday",
       CAST(SUM(LENGTH({day})) AS BIGINT) AS "SUM_LEN_o_orderday",
       CAST({flag} AS BIGINT) AS "SUM_o_urgent",
       COUNT(DISTINCT o_urgent) AS "COUNT_DISTINCT_o_urgent",
       CAST(SUM(LENGTH(o_orderpriority)) AS BIGINT) AS "SUM_LEN_o_orderpriority",
       COUNT(DISTINCT o_orderpriority) AS "COUNT_DISTINCT_o_orderpriority",
       COUNT(DISTINCT o_shippriority) AS "COUNT_DISTINCT_o_shippriority"
FROM {source}"""

LINE_ORDER = ", ".join(
    ["l_shipdate DESC NULLS LAST"]
    + [
        f"{c} ASC NULLS FIRST"
        for c in LINE_COLUMNS
        if c not in ("l_orderkey", "l_shipdate")
    ]
)

STAGED_CUSTOMERS = f"""
  SELECT *, CAST(ROW_NUMBER() OVER (
           PARTITION BY ACC_ID ORDER BY SYS_MST_DAT DESC, filename DESC) AS INTEGER) AS cnt
  FROM (
    SELECT filename, COALESCE(TRIM("Id"), '#') AS ACC_ID,
           COALESCE(TRIM("Name"), '#') AS ACC_NAM,
           COALESCE(TRIM("Segment"), '#') AS ACC_SEG,
           COALESCE(LOWER(TRIM("Active")), 'false') AS ACC_ACT,
           COALESCE("Nation", 0) AS ACC_NAT,
           COALESCE(TRIM("Since"), '1000-01-01') AS ACC_SNC,
           COALESCE(TRIM("Modified"), '1000-01-01 00:00:00.000') AS SYS_MST_DAT,
           COALESCE(TRIM("Extra"), '#') AS "Unknown_Column_8"
    FROM ({CUSTOMER_FILES}))"""


def oracle_sql() -> dict[str, str]:
    staged = ", ".join(STAGED_COLUMNS)
    lines = ", ".join(LINE_COLUMNS)
    profile_both = (
        f"WITH e AS ({ERP_PROFILE.format(source='lineitem')}), "
        f"a AS ({ERP_PROFILE.format(source=f'({CHANGED_LINEITEM})')})"
    )
    profile_names = "concat_ws(',', " + ", ".join(
        f"""CASE WHEN e."{c}" IS DISTINCT FROM a."{c}" THEN '{c}' END"""
        for c in ERP_PROFILE_NAMES
    ) + ")"
    keyed_names = "concat_ws(',', " + ", ".join(
        f"CASE WHEN {_keyed_mismatch(c)} > 0 THEN '{c}' END" for c in ORDER_COLUMNS[1:]
    ) + ")"
    document_columns = ["doc_id", "text", "lang", "source", "n_chars"]
    document_names = "concat_ws(',', " + ", ".join(
        f"CASE WHEN {_multiset_differs(c)} THEN '{c}' END" for c in document_columns
    ) + ")"
    priority = (
        "CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END"
    )
    latest_orders = (
        "SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY "
        "o_orderdate DESC, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority) AS rn "
        "FROM orders) WHERE rn = 1"
    )

    def profile_select(source: str) -> str:
        text = PROFILE_SELECT.replace(
            "SUM(LENGTH(o_orderpriority))", "CAST(SUM(LENGTH(o_orderpriority)) AS BIGINT)"
        )
        return f"{text} FROM {source}"

    attributes = "concat('priority=', o_orderpriority, ',status=', coalesce(o_orderstatus, '?'))"

    def suite_row(name: str, expected: str, actual: str, n: int) -> str:
        return f"SELECT * FROM ({_two_way_sql(name, expected, actual, n)})"

    stated = {
        "compare_two_way": _two_way_sql(
            "lineitem", "SELECT * FROM lineitem", CHANGED_LINEITEM, 11
        ),
        "compare_one_way": _one_way_sql(
            "orders", "SELECT * FROM orders", CHANGED_ORDERS, keyed_names, 6
        ),
        "compare_one_way_no_keys": _one_way_sql(
            "documents", "SELECT * FROM documents", CHANGED_DOCUMENTS, document_names, 5
        ),
        "compare_multiset": _two_way_sql(
            "lineitem", "SELECT * FROM lineitem", REPEATED_LINEITEM, 11
        ),
        "compare_keys": f"""
WITH e AS (SELECT * FROM lineitem), a AS ({CHANGED_LINEITEM}),
n AS (
  SELECT (SELECT COUNT(*) FROM e) AS er, (SELECT COUNT(*) FROM a) AS ar,
         (SELECT COUNT(*) FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM a)) AS ea,
         (SELECT COUNT(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM e)) AS ae,
         (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM e)) AS ek,
         (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM a)) AS ak)
SELECT CASE WHEN er = ar AND ea = 0 AND ae = 0 THEN 'Passed' ELSE 'Failed' END AS "Status",
       '' AS "Details",
       CAST(er AS VARCHAR) AS "Expected rows", CAST(ar AS VARCHAR) AS "Actual rows",
       CAST(ea AS VARCHAR) AS "Expected minus Actual count",
       CAST(ae AS VARCHAR) AS "Actual minus Expected count",
       '11' AS "Expected columns", '11' AS "Actual columns",
       CAST(ek AS VARCHAR) AS "Latest Distinct Expected Count",
       CAST(ak AS VARCHAR) AS "Latest Distinct Actual Count"
FROM n""",
        "compare_equal": _two_way_sql(
            "lineitem", "SELECT * FROM lineitem", "SELECT * FROM lineitem", 11
        ),
        "compare_structure": f"""
SELECT 'lineitem' AS "Table", 'Failed' AS "Status",
       'File Structure error: 11 and 10 columns, missing [l_tax], extra []' AS "Details",
       CAST((SELECT COUNT(*) FROM lineitem) AS VARCHAR) AS "Expected rows",
       CAST((SELECT COUNT(*) FROM ({CHANGED_LINEITEM})) AS VARCHAR) AS "Actual rows",
       '11' AS "Expected columns", '10' AS "Actual columns",
       '-3' AS "Expected minus Actual count", '-4' AS "Actual minus Expected count\"""",
        "compare_extra_column": """
SELECT 'lineitem' AS "Table", 'Failed' AS "Status",
       '11 and 12 columns before the projection' AS "Details",
       CAST(COUNT(*) AS VARCHAR) AS "Expected rows", CAST(COUNT(*) AS VARCHAR) AS "Actual rows",
       '11' AS "Expected columns", '12' AS "Actual columns",
       '0' AS "Expected minus Actual count", '0' AS "Actual minus Expected count"
FROM lineitem""",
        "compare_wide_numbers": _two_way_sql(
            "orders",
            "SELECT CAST(o_orderkey + 9007199254740992 AS BIGINT) AS id FROM orders",
            """SELECT CAST(CAST(CAST(o_orderkey + 9007199254740992 AS BIGINT) AS DOUBLE)
                    AS BIGINT) AS id FROM orders""",
            1,
        ).replace(
            "'' AS \"Details\"", "'id: bigint and double compared as exact text' AS \"Details\""
        ),
        "compare_empty_profiles": """
SELECT 'lineitem' AS "Table", 'Failed' AS "Status",
       'a profile has no row count' AS "Details",
       NULL AS "Expected rows", NULL AS "Actual rows",
       '18' AS "Expected columns", '18' AS "Actual columns",
       'Data matching' AS "Data Comparison", 'NA' AS "Mismatching columns"
FROM lineitem LIMIT 1""",
        "compare_text": _two_way_sql(
            "documents", "SELECT * FROM documents", CHANGED_DOCUMENTS, 5
        ),
        "compare_versioned": _two_way_sql(
            "orders",
            "SELECT * FROM orders",
            f"""SELECT {', '.join(ORDER_COLUMNS)} FROM (
                SELECT *, RANK() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) AS r
                FROM ({VERSIONED_ORDERS})) WHERE r = 1""",
            6,
        ),
        "compare_profiles": f"""
{profile_both}, n AS (
  SELECT e."TOTAL_ROW_COUNT" AS er, a."TOTAL_ROW_COUNT" AS ar, {profile_names} AS names
  FROM e, a)
SELECT 'lineitem' AS "Table",
       CASE WHEN er = ar AND names = '' THEN 'Passed' ELSE 'Failed' END AS "Status",
       '' AS "Details",
       CAST(er AS VARCHAR) AS "Expected rows", CAST(ar AS VARCHAR) AS "Actual rows",
       '18' AS "Expected columns", '18' AS "Actual columns",
       CASE WHEN names = '' THEN 'Data matching' ELSE 'Data mismatching' END AS "Data Comparison",
       CASE WHEN names = '' THEN 'NA' ELSE names END AS "Mismatching columns"
FROM n""",
        "mismatching_columns_profile": f"""
{profile_both}
SELECT CASE WHEN names = '' THEN 'NA' ELSE names END AS mismatching_columns
FROM (SELECT {profile_names} AS names FROM e, a)""",
        "mismatching_columns_keyed": (
            f"WITH e AS (SELECT * FROM orders), a AS ({CHANGED_ORDERS}) "
            + " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, {_keyed_mismatch(c)} AS mismatching_keys"
                for c in ORDER_COLUMNS[1:]
            )
        ),
        "diff_rows": f"""
WITH a AS ({REPEATED_LINEITEM})
SELECT 'EXPECTED' AS side, * FROM (SELECT {lines} FROM lineitem EXCEPT ALL SELECT {lines} FROM a)
UNION ALL
SELECT 'ACTUAL' AS side, * FROM (SELECT {lines} FROM a EXCEPT ALL SELECT {lines} FROM lineitem)""",
        "diff_rows_copies": f"""
WITH e AS (SELECT l_returnflag, l_linestatus FROM lineitem),
a AS (SELECT l_returnflag, l_linestatus FROM ({REPEATED_LINEITEM}))
SELECT 'EXPECTED' AS side, * FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM a)
UNION ALL
SELECT 'ACTUAL' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM e)""",
        "labelled_diff": f"""
WITH a AS ({REPEATED_LINEITEM})
SELECT 'EXPECTED' AS side, * FROM (SELECT {lines} FROM lineitem EXCEPT SELECT {lines} FROM a)
UNION ALL
SELECT 'ACTUAL' AS side, * FROM (SELECT {lines} FROM a EXCEPT SELECT {lines} FROM lineitem)""",
        "suite_report": " UNION ALL ".join(
            [
                suite_row("lineitem", "SELECT * FROM lineitem", REPEATED_LINEITEM, 11),
                suite_row("customer", "SELECT * FROM customer", "SELECT * FROM customer", 5),
                suite_row("orders", "SELECT * FROM orders", CHANGED_ORDERS, 6),
            ]
        ),
        "latest_cdc": f"""
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY user_id ORDER BY {priority}, ts DESC, event_id, event_type, value, props) AS rn
  FROM events) WHERE rn = 1""",
        "latest_rank": f"""
SELECT {lines} FROM (
  SELECT *, RANK() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC) AS r
  FROM lineitem) WHERE r = 1""",
        "latest_row_number": f"""
SELECT {lines} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) AS r
  FROM lineitem) WHERE r = 1""",
        "latest_staged": f"""
SELECT {lines}, CAST(ROW_NUMBER() OVER (
         PARTITION BY l_orderkey
         ORDER BY l_shipdate DESC, l_returnflag DESC, l_partkey, l_suppkey, l_linenumber,
                  l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus
       ) AS INTEGER) AS cnt
FROM lineitem""",
        "distinct_key_count": """
SELECT COUNT(*) AS distinct_key_count FROM (SELECT DISTINCT user_id, event_type FROM events)""",
        "profile_erp": ERP_PROFILE.format(source="lineitem"),
        "profile_erp_source": ERP_PROFILE.format(source="lineitem"),
        "profile_crm": CRM_PROFILE.format(
            price="CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DECIMAL(18,2))",
            margin="CAST(SUM(CAST(o_margin AS DECIMAL(18,6))) AS DECIMAL(30,2))",
            time="SUBSTRING(CAST(o_orderdate AS VARCHAR), 1, 19)",
            day="SUBSTRING(CAST(o_orderday AS VARCHAR), 1, 10)",
            flag="""SUM(CASE WHEN o_urgent = 'False' THEN 0 WHEN o_urgent = 'True' THEN 1
                    ELSE TRY_CAST(o_urgent AS DOUBLE) END)""",
            source=f"({CRM_ORDERS})",
        ),
        "profile_crm_source": CRM_PROFILE.format(
            price="CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE)",
            margin="CAST(SUM(CAST(o_margin AS DECIMAL(18,6))) AS DOUBLE)",
            time="CAST(o_orderdate AS VARCHAR)",
            day="CAST(o_orderday AS VARCHAR)",
            flag="SUM(CAST(o_urgent AS INTEGER))",
            source=f"(SELECT * REPLACE (o_orderpriority = '1-URGENT' AS o_urgent) "
            f"FROM ({CRM_ORDERS}))",
        ),
        "profile_crm_flags": """
SELECT 'Profile' AS "Profile", COUNT(*) AS "TOTAL_ROW_COUNT",
       MAX(doc_id) AS "MAX_MODIFICATION_DATE",
       CAST(SUM(doc_id) AS DECIMAL(18,0)) AS "SUM_doc_id",
       CAST(SUM(quality) AS BIGINT) AS "SUM_quality",
       COUNT(DISTINCT quality) AS "COUNT_DISTINCT_quality",
       CAST(SUM(toxic) AS BIGINT) AS "SUM_toxic",
       COUNT(DISTINCT toxic) AS "COUNT_DISTINCT_toxic"
FROM labels""",
        "profile_small_numbers": """
SELECT 'Profile' AS "Profile", COUNT(*) AS "TOTAL_ROW_COUNT",
       MAX(l_shipdate) AS "MAX_MODIFICATION_DATE",
       CAST(SUM(l_extendedprice * 1e-15) AS DECIMAL(30,9)) AS "SUM_price",
       CAST(SUM(l_extendedprice * 1e-15) AS DECIMAL(30,9)) AS "SUM_price_text"
FROM lineitem""",
        "profile_number_flags": """
SELECT 'Profile' AS "Profile", COUNT(*) AS "TOTAL_ROW_COUNT",
       MAX(l_orderkey) AS "MAX_MODIFICATION_DATE",
       SUM(CASE l_returnflag WHEN 'A' THEN 1.0::DOUBLE WHEN 'N' THEN 0.5 ELSE 1.0 END)
         AS "SUM_returned",
       COUNT(DISTINCT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END)
         AS "COUNT_DISTINCT_returned",
       CAST(SUM(l_orderkey) AS DECIMAL(18,0)) AS "SUM_l_orderkey"
FROM lineitem""",
        "profile_crm_datetime": """
SELECT 'Profile' AS "Profile", COUNT(*) AS "TOTAL_ROW_COUNT",
       MAX(ts) AS "MAX_MODIFICATION_DATE",
       CAST(SUM(event_id) AS DECIMAL(18,0)) AS "SUM_event_id",
       COUNT(DISTINCT ts) AS "COUNT_DISTINCT_ts",
       CAST(SUM(LENGTH(SUBSTRING(CAST(ts AS VARCHAR), 1, 19))) AS BIGINT) AS "SUM_LEN_ts",
       CAST(SUM(LENGTH(event_type)) AS BIGINT) AS "SUM_LEN_event_type",
       COUNT(DISTINCT event_type) AS "COUNT_DISTINCT_event_type"
FROM events""",
        "profile_latest": ERP_PROFILE.format(
            source=f"""(SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC,
      l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
      l_returnflag, l_linestatus) AS r FROM lineitem) WHERE r = 1)"""
        ),
        "profile_sql_view": profile_select("orders"),
        "profile_sql_latest": profile_select(f"({latest_orders})"),
        "stage_table": STAGED_CUSTOMERS,
        "row_count_check": f"""
SELECT COUNT(*) AS counts FROM ({STAGED_CUSTOMERS}) WHERE cnt = 1
EXCEPT SELECT COUNT(*) AS counts FROM ({TARGET_CUSTOMERS})""",
        "row_count_check_pass": f"""
SELECT COUNT(*) AS counts FROM ({STAGED_CUSTOMERS}) WHERE cnt = 1
EXCEPT SELECT COUNT(*) AS counts FROM customer""",
        "staged_diff": f"""
WITH s AS (SELECT {staged} FROM ({STAGED_CUSTOMERS}) WHERE cnt = 1),
t AS ({TARGET_CUSTOMERS})
SELECT 'ACTUAL' AS side, * FROM (SELECT {staged} FROM t EXCEPT SELECT {staged} FROM s)
UNION ALL
SELECT 'EXPECTED' AS side, * FROM (SELECT {staged} FROM s EXCEPT SELECT {staged} FROM t)""",
        "column_count_check": """
SELECT COUNT(DISTINCT source) AS actual_col_cnt FROM documents WHERE upper(lang) = upper('en')
EXCEPT SELECT CAST(4 AS BIGINT)""",
        "duplicate_keys": """
SELECT 'Duplicates' AS "check", l_orderkey, l_linenumber, COUNT(*) AS copies
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
        "duplicate_keys_text": """
SELECT 'Duplicates' AS "check", lang, text
FROM documents GROUP BY lang, text HAVING COUNT(*) > 1""",
        "csv_roundtrip": "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM customer",
        "csv_inferred_roundtrip": "SELECT * FROM part",
        "csv_record_separator_roundtrip": "SELECT * FROM documents",
        "tsv_borrowed_roundtrip": "SELECT * FROM orders",
        "suite_not_found": f"""
SELECT * EXCLUDE ("Details") FROM ({suite_row("orders", "SELECT * FROM orders", CHANGED_ORDERS, 6)})
UNION ALL SELECT 'missing', 'Actual or expected data not found', '-1', '-2', '-5', '-6', '-3', '-4'
UNION ALL
SELECT * EXCLUDE ("Details") FROM ({suite_row("nation", "SELECT * FROM nation", "SELECT * FROM nation", 3)})""",
        "compare_maps": _two_way_sql(
            "orders",
            "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders",
            f"SELECT o_orderkey, o_orderstatus, o_orderpriority FROM ({CHANGED_ORDERS})",
            3,
        ),
        "diff_map_rows": f"""
WITH e AS (SELECT o_orderkey, {attributes} AS attributes FROM orders),
a AS (SELECT o_orderkey, {attributes} AS attributes FROM ({CHANGED_ORDERS}))
SELECT 'EXPECTED' AS side, * FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM a)
UNION ALL
SELECT 'ACTUAL' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM e)""",
        "mismatching_maps": (
            f"WITH e AS (SELECT o_orderkey, {attributes} AS pair FROM orders), "
            f"a AS (SELECT o_orderkey, {attributes} AS pair FROM ({CHANGED_ORDERS})) "
            + " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, {_keyed_mismatch('pair')} AS mismatching_keys"
                for c in ("attributes", "nested")
            )
        ),
        "latest_cdc_codes": f"""
SELECT event_id, ts, user_id, event_type, value, props, operation FROM (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY user_id ORDER BY CASE operation WHEN 'D' THEN 1 WHEN 'U' THEN 2 WHEN 'I' THEN 3 ELSE 4 END,
      ts DESC, event_id, event_type, value, props) AS rn
  FROM (SELECT *, CASE event_type WHEN 'error' THEN 'D' WHEN 'click' THEN 'U' WHEN 'signup' THEN 'I'
                  ELSE 'R' END AS operation FROM events)) WHERE rn = 1""",
        "stage_files": f"""
SELECT * REPLACE (CAST("ACC_NAT" AS VARCHAR) AS "ACC_NAT") FROM ({STAGED_CUSTOMERS})""",
        "compare_files": _two_way_sql("orders", "SELECT * FROM orders", CHANGED_ORDERS, 6),
    }
    stated["profile_files"] = stated["compare_profiles"]
    if llm is not None:
        stated |= llm.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            stated["pipeline"] = corpus_pipeline.ORACLE_SQL
    return stated
