"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Bytes of text that a Python worker handles at a time.
BATCH_BYTES = 2 * 1024**2


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased and nothing else; texts of ASCII take the faster function."""
    plain = F.octet_length(column) == F.char_length(column)
    return F.when(plain, F.lower(column)).otherwise(F.translate(column, UPPER, LOWER))


def texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Only the id and the text, under names that cannot clash; null text is empty."""
    return docs.select(
        docs[id_column].cast("long").alias("id"),
        F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"),
    )


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded bytes, one row at least."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy()
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            limit = (ends[start - 1] if start else 0) + most
            stop = max(start + 1, int(np.searchsorted(ends, limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def partitions_of(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


Work = Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]
Partition = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def per_batch(work: Work, column: str) -> Partition:
    """``work`` applied to the batches of a partition, bounded by the bytes of ``column``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, column):
            yield from work(batch)

    return run


def each_batch(work: Work) -> Partition:
    """``work`` applied to the batches of a partition as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from work(batch)

    return run


#: Groups of documents per shuffle partition.
GROUPS = 1
#: A token is 48 bits of a hash; 16 bits below it hold a count.
LOW = 16
MOST = 2**LOW - 1


def grouped(docs: DataFrame, id_column: str, text_column: str, rest: list[str] | None = None) -> DataFrame:
    """``id, row, text, batch``: documents dealt into small groups by their content.

    ``row`` is the xxhash64 of the text. A group is the same however often and
    in whatever order the input is read. ``rest`` names columns that come along
    as a struct of that name.
    """
    rows = texts(docs, id_column, text_column) if rest is None else docs.select(
        docs[id_column].cast("long").alias("id"),
        F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"),
        F.struct(*[docs[c] for c in rest]).alias("rest"),
    )
    rows = rows.withColumn("row", F.xxhash64("text"))
    return rows.withColumn("batch", F.pmod(F.xxhash64("id", "row"), F.lit(GROUPS * partitions_of(docs))))


def dealt_tokens(lists: list[np.ndarray], batch: int, n_buckets: int) -> pa.Table:
    """The tokens of a group's documents, ``bucket, batch, tokens``.

    Each token comes once, with the number of documents that have it, so one
    that every document has costs a group one number.
    """
    found, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *lists]), return_counts=True)
    packed = found << np.uint64(LOW) | np.minimum(counts, MOST).astype(np.uint64)
    bucket = (found % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    used = np.flatnonzero(np.diff(edges))
    blobs = [packed[order[edges[b] : edges[b + 1]]].tobytes() for b in used.tolist()]
    columns = [pa.array(used, pa.int64()), pa.array([batch] * len(used), pa.int64()), pa.array(blobs, pa.binary())]
    return pa.table(columns, names=["bucket", "batch", "tokens"])


def shared_tokens(table: pa.Table) -> pa.Table:
    """Of a bucket's tokens those of two documents or more, given back to each group.

    The reply holds them with the number of their documents.
    """
    blobs = table.column("tokens").to_pylist()
    packed = np.frombuffer(b"".join(blobs), np.uint64)
    found = packed >> np.uint64(LOW)
    values, at = np.unique(found, return_inverse=True)
    rows = np.bincount(at, (packed & np.uint64(MOST)).astype(float), len(values)).astype(np.int64)
    rows = np.minimum(rows, MOST)[at]
    reply = found << np.uint64(LOW) | rows.astype(np.uint64)
    ends = np.cumsum([len(b) // 8 for b in blobs]).tolist()
    out = [
        reply[start:end][rows[start:end] > 1].tobytes()
        for start, end in zip([0, *ends[:-1]], ends, strict=True)
    ]
    return pa.table({"batch": table.column("batch"), "reply": pa.array(out, pa.binary())})


def known_tokens(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The shared tokens of a group in order, and the number of their documents."""
    packed = np.sort(np.frombuffer(b"".join(blobs), np.uint64))
    return packed >> np.uint64(LOW), (packed & np.uint64(MOST)).astype(np.int64)
