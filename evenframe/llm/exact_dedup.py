"""Exact deduplication whose classes are compared by content, not by digest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenframe.functions.durable import durable

from .common import ascii_lower, texts

SALTS = 8


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical after lower-casing A-Z; the largest
    id of equal texts stays. Every map task first folds its own copies into one
    row, salted digest groups are merged next, then the winners of the salts,
    grouping by the whole content each time. A text that fills a third of the
    table so reaches a task as one row per map task and salt.

    Documents find their class by digest. Should one digest stand for several
    contents, the documents of all such digests find it by content instead.

    Null text counts as empty. A row without id ranks below every id: it is
    kept only where no row of its class has one. Rows that repeat an id and a
    text are each reported, with the same verdict. An empty table gives no row;
    further columns are ignored.
    """
    rows = texts(docs, id_column, text_column).select("id", ascii_lower(F.col("text")).alias("content"))
    rows = rows.withColumns({"digest": digest(F.col("content")), "sha": sha256(F.col("content"))})
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    winners = salted.groupBy("digest", "salt", "content").agg(
        F.max("id").alias("winner"), F.count("*").alias("copies")
    )
    classes = winners.groupBy("digest", "content").agg(
        F.max("winner").alias("keep_id"), F.sum("copies").alias("group_size")
    )
    found = durable(classes.drop("content"))
    shared = found.groupBy("digest").count().where("count > 1").select("digest")
    verdicts = ["id", "sha", "keep_id", "group_size"]
    joined = rows.select("id", "sha", "digest").join(found, "digest").select(verdicts)
    if not shared.isEmpty():
        exact = classes.join(shared, "digest", "left_semi")
        single = rows.select("id", "sha", "digest").join(shared, "digest", "left_anti")
        several = rows.join(shared, "digest", "left_semi").join(exact, ["digest", "content"])
        joined = single.join(found, "digest").select(verdicts).union(several.select(verdicts))
    return joined.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all their columns."""
    verdict = exact_dedup(docs, id_column, text_column)
    lost = verdict.where(~F.col("kept")).select(
        F.col("doc_id").alias("lost_id"), F.unhex("text_sha256").alias("lost_sha")
    )
    content = ascii_lower(F.coalesce(docs[text_column].cast("string"), F.lit("")))
    same_id = docs[id_column].cast("long").eqNullSafe(lost["lost_id"])
    return docs.join(lost, same_id & (sha256(content) == lost["lost_sha"]), "left_anti")
