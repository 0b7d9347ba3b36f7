"""Best-fit packing of token sequences, planned on counts of lengths."""

from __future__ import annotations

import sys
import types
import zlib
from collections.abc import Iterator
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenframe.functions.durable import durable

from .common import each_batch, per_batch, texts

CAPACITY = 2048
END_ID = 0
#: Fixed value: how byte-level BPE files split text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of() -> dict[str, int]:
    """The byte behind each character that byte-level BPE files write for it."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Encoder:
    """Ids of ``tokenizers`` for a byte-level BPE file, at several times its speed.

    Texts of Latin letters go through tiktoken with the same ranks: merging by
    rank gives the same ids. Other texts, and those that hold a special token, go
    through ``tokenizers`` itself. Nothing is remembered between texts.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        self.special = sorted(special)
        byte_of = _byte_of()
        ranks = {
            bytes(byte_of[c] for c in token): rank
            for token, rank in self.library.get_vocab().items()
            if token not in special
        }
        self.ranked = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a text."""
        latin = text.isascii() or max(text) < "ɐ"
        if not latin or any(s in text for s in self.special):
            return self.whole(text)
        ids = self.ranked.encode_ordinary(text)
        return pack_ids(f"<{len(ids)}I", *ids)


def encoder(path: str | None) -> Encoder:
    """The worker's encoder of a file; it outlives tasks, as workers do."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    kept = sys.modules.setdefault("_evenframe_encoders", types.ModuleType("_evenframe_encoders"))
    if path not in vars(kept):
        vars(kept)[path] = Encoder(path)
    return vars(kept)[path]


PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, slot int, earlier long"
)


def _pieces(path: str | None, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        slot = TaskContext.get().partitionId()
        earlier = np.zeros(capacity + 1, np.int64)

        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            rows = []
            for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("id", "text")), strict=True):
                ids = encode(text) + END_ID.to_bytes(4, "little")
                n = len(ids) // 4
                stop = n % capacity or capacity if n > capacity else n
                start = piece = 0
                while start < n:
                    part = ids[4 * start : 4 * stop]
                    length = stop - start
                    kept = part if with_ids else None
                    rows.append(
                        (doc_id, piece, start, length, zlib.crc32(part), kept, slot, int(earlier[length]))
                    )
                    earlier[length] += 1
                    start, stop, piece = stop, stop + capacity, piece + 1
            names = [x.split()[0] for x in PIECES.split(", ")]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

        yield from per_batch(work, "text")(batches)

    return run


class CapacityTree:
    """Segment tree over the remaining capacities; a leaf tells if open bins have it."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        node = self.leaves + capacity
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest open capacity of at least ``least``."""
        node = self.leaves + least
        if self.open[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over ``counts`` of items by length.

    Items of one length are alike and bins of one remaining capacity are alike,
    so both are handled in runs: ``(length, first item, first bin, items per bin,
    offset)``. It places the very items that a loop over all of them would: the
    bin that has just taken an item stays the tightest while another fits.
    """
    tree = CapacityTree(capacity)
    runs: dict[int, list[tuple[int, int]]] = {}
    plan: list[tuple[int, int, int, int, int]] = []
    next_bin = 0

    def put(remaining: int, first: int, n: int) -> None:
        if remaining and n:
            runs.setdefault(remaining, []).append((first, n))
            tree.set(remaining, True)

    for length in sorted(counts, reverse=True):
        done, total = 0, counts[length]
        while done < total:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, first, n = capacity, next_bin, max(1, (total - done) // (capacity // length))
                next_bin += n
            else:
                first, n = runs[remaining].pop()
                if not runs[remaining]:
                    tree.set(remaining, False)
            each = min(remaining // length, total - done)
            used = min(n, (total - done) // each)
            plan.append((length, done, first, each, capacity - remaining))
            put(remaining, first + used, n - used)
            put(remaining - each * length, first, used)
            done += used * each
    return plan


def _placed(plan: list[tuple[int, int, int, int, int]]):
    """Looks every piece up in the plan, by length and number."""
    order = sorted(plan)
    length, number, first, each, offset = (np.array(c, np.int64) for c in zip(*order, strict=True)) if order else [np.zeros(0, np.int64)] * 5
    starts = np.searchsorted(length, np.arange(CAPACITY + 2) if not order else np.arange(length.max() + 2))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        size = batch.column("length").to_numpy()
        item = batch.column("number").to_numpy()
        at = np.empty(len(size), np.int64)
        for n in np.unique(size):
            mine = size == n
            low, high = starts[n], starts[n + 1]
            at[mine] = low + np.searchsorted(number[low:high], item[mine], "right") - 1
        within = item - number[at]
        bins = first[at] + within // each[at]
        places = offset[at] + within % each[at] * size
        keep = [c for c in batch.schema.names if c != "number"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in keep), pa.array(bins), pa.array(places)],
            names=[*keep, "sequence_id", "offset"],
        )

    return each_batch(work)


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer_path: str | None = None,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its ids and END_ID. One of more than ``capacity`` ids is cut
    into pieces of that length, the first of which may be shorter. Sequences
    hold at most ``capacity`` ids without a gap. ``with_ids`` adds ``ids``,
    little-endian 32-bit numbers.

    Texts are encoded once and the pieces stored. The driver sees how many
    pieces have each length, ``capacity`` numbers at most, and plans the whole
    packing from them by best-fit decreasing; tasks then look their pieces up.
    No rows are sorted, and no group is collected: pieces of one length are
    numbered by stored partition, from the counts before it.

    Null text counts as empty, which is one piece of END_ID alone. Rows that
    repeat an id are packed one by one. An empty table gives no row.
    """
    rows = texts(docs, id_column, text_column)
    pieces = durable(rows.mapInArrow(_pieces(tokenizer_path, capacity, with_ids), PIECES))
    counts = pieces.groupBy("slot", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    plan = best_fit({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    numbered = pieces.join(base.drop("n"), ["slot", "length"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    numbered = numbered.select(*columns, (F.col("base") + F.col("earlier")).alias("number"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return numbered.mapInArrow(_placed(plan), f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids``: the filled sequences of ``pack(..., with_ids=True)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda whole, p: F.concat(whole, p["ids"]))
    return rows.select("sequence_id", joined.alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
