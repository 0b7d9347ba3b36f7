"""Line deduplication that moves hashes and positions, and returns keep bitmaps."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenframe.functions.durable import durable

from .common import each_batch, partitions_of, per_batch, texts

#: What is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
LEAST_LENGTH = 20
LEAST_DOCUMENTS = 3


def _keyed_lines(least_length: int):
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at, high, low, pos = [], [], [], []
        for row, text in enumerate(batch.column("text").to_pylist()):
            for n, line in enumerate(text.split("\n")):
                key = line.strip(BLANKS)
                if len(key) >= least_length:
                    h = xxhash.xxh3_128_intdigest(key.encode().lower())
                    at.append(row)
                    high.append((h >> 64) - (1 << 63))
                    low.append((h & 0xFFFFFFFFFFFFFFFF) - (1 << 63))
                    pos.append(n)
        rows = pa.array(at, pa.int64())
        columns = [batch.column("id").take(rows), batch.column("row").take(rows)]
        columns = [pa.array(high, pa.int64()), pa.array(low, pa.int64()), *columns, pa.array(pos, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["high", "low", "id", "row", "pos"])

    return work


def _dropped(least_documents: int):
    """Streams a sorted partition; a run holds the lines of one hash, largest id first.

    Only the lines of the first ``least_documents - 1`` ids of a run wait for its
    end. The runs at both ends of a partition may go on in its neighbours: what
    waits there comes out as undecided.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["high", "low", "id", "row", "pos", "undecided", "enough"]
        kinds = [pa.int64()] * 4 + [pa.int32(), pa.bool_(), pa.bool_()]
        key, first_run, rank, last_id = None, True, 0, None
        waiting: list[tuple] = []

        def close(out: list, undecided: bool) -> None:
            enough = rank >= least_documents
            if undecided:
                out.extend((*w[:5], True, enough) for w in waiting)
            elif enough:
                out.extend((*w[:5], False, True) for w in waiting if w[5] > 1)
            waiting.clear()

        def table(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

        for batch in batches:
            out: list = []
            for high, low, id_, row, pos in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (high, low) != key:
                    close(out, first_run)
                    first_run = key is None
                    key, rank, last_id = (high, low), 0, None
                if rank == 0 or id_ != last_id:
                    rank, last_id = rank + 1, id_
                if rank >= least_documents:
                    out.append((high, low, id_, row, pos, False, True))
                else:
                    waiting.append((high, low, id_, row, pos, rank))
            yield table(out)
        out = []
        close(out, True)
        yield table(out)

    return run


def _bitmaps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    packed = []
    for positions in batch.column("positions").to_pylist():
        keep = np.ones(8 * (max(positions) // 8 + 1), bool)
        keep[positions] = False
        packed.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
    columns = [batch.column("id"), batch.column("row"), batch.column("n_dropped")]
    yield pa.RecordBatch.from_arrays(
        [*columns, pa.array(packed, pa.binary())], names=["id", "row", "n_dropped", "keep_bitmap"]
    )


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Documents with a fingerprint of the text, which tells rows of one id apart."""
    return texts(docs, id_column, text_column).withColumn("row", F.xxhash64("text"))


def line_keep_bitmaps(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = LEAST_LENGTH,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """``id, row, n_dropped, keep_bitmap`` of the documents that lose lines.

    A line's key is the line without BLANKS at both ends, A-Z lower-cased. Keys
    of ``least_length`` code points found under ``least_documents`` ids lose all
    their lines except those under the largest id. ``row`` is the xxhash64 of
    the text. The bitmap is compressed by zlib; its bits, lowest first, are the
    lines up to the last dropped one, 1 for those that stay.

    Lines travel as 128-bit hashes with id and position. They are partitioned by
    ranges of hash, id and position and sorted, so a line that a third of the
    documents hold spreads over many partitions; what each of these cannot
    decide alone, a few documents' lines, is settled afterwards.

    Null ids count as one document, below every other. Rows that repeat an id
    count as one document. An empty table gives no row.
    """
    docs = _rows(docs, id_column, text_column)
    lines = durable(
        docs.mapInArrow(
            per_batch(_keyed_lines(least_length), "text"),
            "high long, low long, id long, row long, pos int",
        )
    )
    order = [F.col("high"), F.col("low"), F.col("id").desc_nulls_last(), F.col("row"), F.col("pos")]
    found = durable(
        lines.repartitionByRange(partitions_of(docs), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(
            _dropped(least_documents),
            "high long, low long, id long, row long, pos int, undecided boolean, enough boolean",
        )
    )
    undecided = found.where("undecided").withColumn("rank_id", F.coalesce("id", F.lit(-(2**63))))
    runs = (
        undecided.groupBy("high", "low")
        .agg(
            F.countDistinct("rank_id").alias("n"),
            F.max("rank_id").alias("top"),
            F.bool_or("enough").alias("enough"),
        )
        .where(F.col("enough") | (F.col("n") >= least_documents))
        .select("high", "low", "top")
    )
    settled = undecided.join(runs, ["high", "low"]).where("rank_id < top")
    lost = found.where("NOT undecided").select("id", "row", "pos").union(settled.select("id", "row", "pos"))
    lists = lost.groupBy("id", "row").agg(F.collect_set("pos").alias("positions"))
    lists = lists.withColumn("n_dropped", F.size("positions").cast("long"))
    return lists.mapInArrow(each_batch(_bitmaps), "id long, row long, n_dropped long, keep_bitmap binary")


def kept_text(text: str, keep_bitmap: bytes | None) -> str:
    """``text`` without the lines that the bitmap drops."""
    if keep_bitmap is None:
        return text
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep_bitmap), np.uint8), bitorder="little")
    keep = np.ones(max(len(lines), len(bits)), bool)
    keep[: len(bits)] = bits.astype(bool)
    return "\n".join([x for x, k in zip(lines, keep.tolist(), strict=False) if k])


def _digests(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    pairs = zip(batch.column("text").to_pylist(), batch.column("keep_bitmap").to_pylist(), strict=True)
    rows = [(t.count("\n") + 1, sha256(kept_text(t, b).encode()).hexdigest()) for t, b in pairs]
    yield pa.RecordBatch.from_arrays(
        [
            batch.column("id"),
            pa.array([r[0] for r in rows], pa.int64()),
            pa.compute.fill_null(batch.column("n_dropped"), 0),
            pa.array([r[1] for r in rows], pa.string()),
        ],
        names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    )


def line_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **limits: int) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_dropped, kept_sha256``.

    Applies the bitmaps of :func:`line_keep_bitmaps`. Null and empty texts have
    one empty line. Rows that repeat an id and a text come out one by one.
    """
    bitmaps = line_keep_bitmaps(docs, id_column, text_column, **limits)
    bitmaps = bitmaps.withColumnsRenamed({"id": "id_2", "row": "row_2"})
    rows = _rows(docs, id_column, text_column)
    same = F.col("id").eqNullSafe(F.col("id_2")) & (F.col("row") == F.col("row_2"))
    joined = rows.join(bitmaps, same, "left").select("id", "text", "n_dropped", "keep_bitmap")
    return joined.mapInArrow(
        per_batch(_digests, "text"), "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    )
