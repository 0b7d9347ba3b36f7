"""Tokens of two tokenizers on the same bytes: groups between common ends, and their links."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenframe.functions.durable import new_folder

from .common import small_batches, texts
from .packing import Encoder, _byte_of

SPACE = "▁"
#: Bytes of text whose documents are merged at once and whose id pairs are counted together.
BATCH = 2 * 1024**2
#: Tokens after which a long document goes on in a lane of its own, and places tried for that.
LANE, TRIES = 512, 64
#: Links of a group that are written out one by one; of larger groups equal ones are counted.
PLAIN = 64


class Tokenizers:
    """Ids of a byte-level BPE file (A) and of a SentencePiece file (B) for a text after one blank.

    Texts of Latin letters go through tiktoken with the ranks of file A:
    merging by rank gives the same ids. Others go through ``tokenizers`` itself.
    """

    def __init__(self, path_a: str | None = None, path_b: str | None = None):
        import sentencepiece

        if path_a is None or path_b is None:
            import public_tokenizers

            path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
            path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
        self.a = Encoder(path_a)
        self.a.library.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of, special = _byte_of(), set(self.a.special)
        self.bytes_a = [b""] * self.a.library.get_vocab_size()
        for token, i in self.a.library.get_vocab().items():
            self.bytes_a[i] = token.encode() if token in special else bytes(byte_of[c] for c in token)
        self.bytes_b = [self._spelled(i) for i in range(self.b.vocab_size())]
        self.size_a, self.size_b = (np.array([*map(len, t)], np.int64) for t in (self.bytes_a, self.bytes_b))
        #: What an id adds to the text of its document's groups, inside and at the end of its side.
        self.names = [f"{i}{end}".encode() for n, ends in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")) for i in range(n) for end in ends]

    def _spelled(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        return self.b.id_to_piece(i).replace(SPACE, " ").encode()

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of both; None if the bytes of one are not the text's."""
        whole = " " + text
        latin = text.isascii() or max(text) < "ɐ"
        a = self.a.ranked.encode_ordinary(whole) if latin else self.a.library.encode(whole, add_special_tokens=False).ids
        b = self.b.encode(text)
        wanted = whole.encode()
        same = all(b"".join(map(table.__getitem__, ids)) == wanted for ids, table in ((a, self.bytes_a), (b, self.bytes_b)))
        return (a, b) if same else None


def _tokenizers(path_a: str | None, path_b: str | None) -> Tokenizers:
    """The worker's tokenizers; they outlive tasks, as workers do."""
    kept = vars(sys.modules.setdefault("_evenframe_token_links", types.ModuleType("_evenframe_token_links")))
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = Tokenizers(path_a, path_b)
    return kept[path_a, path_b]


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where merging starts: at each document, and in long ones after about LANE tokens at a common end."""
    stops = np.append(first_a[1:], len(ends_a))
    pieces = np.maximum(stops - first_a - 1, 0) // LANE
    document = np.repeat(np.arange(len(first_a)), pieces)
    number = np.arange(len(document)) - np.repeat(np.cumsum(pieces) - pieces, pieces) + 1
    at, limit = first_a[document] + number * LANE - 1, stops[document]
    found = []
    for _ in range(TRIES):
        at, limit = at[at < limit - 1], limit[at < limit - 1]
        other = np.searchsorted(ends_b, ends_a[at])
        common = ends_b[other] == ends_a[at]
        found.append((at[common] + 1, other[common] + 1))
        at, limit = at[~common] + 1, limit[~common]
    a, b = (np.unique(np.concatenate(c)) for c in zip((first_a, first_b), *found, strict=True))
    return a, b


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, starts_a: np.ndarray, starts_b: np.ndarray) -> np.ndarray:
    """Rows ``first_a, first_b, n_a, n_b``: the groups between common ends, by place.

    One state vector holds the pointers of all lanes. Each step compares the
    ends under them, moves the pointer behind, or both at a cut, and emits the
    groups that the cuts close, whose tokens are all linked. Finished lanes are
    taken out of the vector.
    """
    state = np.stack([starts_a, starts_b, starts_a, starts_b, np.append(starts_a[1:], len(ends_a))])
    groups = [np.zeros((4, 0), np.int64)]
    while state.shape[1]:
        a, b = ends_a[state[0]], ends_b[state[1]]
        cut = a == b
        state[0] += a <= b
        state[1] += b <= a
        groups.append(np.concatenate([state[2:4, cut], state[:2, cut] - state[2:4, cut]]))
        state[2:4, cut] = state[:2, cut]
        open_ = state[0] < state[4]
        if not open_.all():
            state = state[:, open_]
    every = np.concatenate(groups, axis=1)
    return every[:, np.argsort(every[0], kind="stable")]


@dataclass
class Merged:
    """The documents of a batch that have tokens, one after the other."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    groups: np.ndarray

    @staticmethod
    def of(encoded: list[tuple[list[int], list[int]]], tokenizers: Tokenizers) -> Merged:
        first = [np.cumsum([0, *(len(e[k]) for e in encoded)]) for k in range(2)]
        ids = [np.fromiter(chain.from_iterable(e[k] for e in encoded), np.int64, int(first[k][-1])) for k in range(2)]
        first = [f[:-1] for f in first]
        # both sides of a document have the same bytes, so the ends of the whole batch can be compared
        ends = np.cumsum(tokenizers.size_a[ids[0]]), np.cumsum(tokenizers.size_b[ids[1]])
        starts = lanes(*ends, *first) if encoded else first
        return Merged(*ids, *first, lockstep(*ends, *starts))

    def spelled(self, tokenizers: Tokenizers) -> list[str]:
        """Digest of each document's groups, as ``a1,a2|b1;a3|b2,b3``."""
        first_a, first_b, n_a, n_b = self.groups
        names = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        ends = np.zeros((2, max(len(self.ids_a), len(self.ids_b))), np.int64)
        ends[0, first_a + n_a - 1] = ends[1, first_b + n_b - 1] = 1
        names[np.arange(len(self.ids_a)) + np.repeat(first_b, n_a)] = 2 * self.ids_a + ends[0, : len(self.ids_a)]
        names[np.arange(len(self.ids_b)) + np.repeat(first_a + n_a, n_b)] = 2 * (self.ids_b + len(tokenizers.bytes_a)) + ends[1, : len(self.ids_b)]
        edges = [*(self.first_a + self.first_b).tolist(), len(names)]
        parts = (names[s:e].tolist() for s, e in zip(edges, edges[1:], strict=False))
        return [sha256(b"".join(map(tokenizers.names.__getitem__, p))[:-1]).hexdigest() for p in parts]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``document, pair, times`` of all links; a pair is both ids in one number."""
        first_a, first_b, n_a, n_b = self.groups
        document = np.searchsorted(self.first_a, first_a, "right") - 1
        n = n_a * n_b
        plain = n <= PLAIN
        sizes = n[plain]
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        width = np.repeat(n_b[plain], sizes)
        a = self.ids_a[np.repeat(first_a[plain], sizes) + at // width]
        b = self.ids_b[np.repeat(first_b[plain], sizes) + at % width]
        found = [(np.repeat(document[plain], sizes), a << 32 | b, np.ones(len(a), np.int64))]
        for g in np.flatnonzero(~plain):
            a, times_a = np.unique(self.ids_a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
            b, times_b = np.unique(self.ids_b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
            pairs = (a[:, None] << 32 | b).ravel()
            found.append((np.full(len(pairs), document[g]), pairs, np.outer(times_a, times_b).ravel()))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))


KINDS = {
    "batch": pa.int64(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
    "groups_sha256": pa.string(), "places": pa.binary(), "times": pa.binary(), "pairs": pa.list_(pa.int64()), "ns": pa.list_(pa.int64()),
}
SCHEMA = (
    "batch long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "places binary, times binary, pairs array<long>, ns array<long>"
)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(KINDS)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS.values(), strict=True)], names=list(KINDS))


def _merged(path_a: str | None, path_b: str | None):
    """A row per document, and one per batch with its distinct pairs and in how many documents each is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _tokenizers(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        for batch in small_batches(batches, "text", BATCH):
            encoded = [tokenizers.encode(t) if t else None for t in batch.column("text").to_pylist()]
            merged = Merged.of([e for e in encoded if e], tokenizers)
            document, pair, times = merged.links()
            pairs, place = np.unique(pair, return_inverse=True)
            key, at = np.unique(document * len(pairs) + place, return_inverse=True)
            times = np.bincount(at, times, len(key)).astype("<i8")
            owner, place = np.divmod(key, max(1, len(pairs)))
            n = len(merged.first_a)
            edges = np.searchsorted(owner, np.arange(n + 1)).tolist()
            place = place.astype("<i4")
            group = np.diff(np.searchsorted(merged.groups[0], np.append(merged.first_a, len(merged.ids_a))))
            links = np.bincount(owner, times, n).astype(np.int64)
            spelled = merged.spelled(tokenizers)
            rows, k = [], 0
            for doc_id, both in zip(batch.column("id").to_pylist(), encoded, strict=True):
                if not both:
                    rows.append((number, doc_id, 0, 0, 0, 0, "", b"", b"", None, None))
                    continue
                s, e = edges[k], edges[k + 1]
                sizes = len(both[0]), len(both[1]), int(group[k]), int(links[k])
                rows.append((number, doc_id, *sizes, spelled[k], place[s:e].tobytes(), times[s:e].tobytes(), None, None))
                k += 1
            yield _table(rows)
            counts = np.bincount(place, minlength=len(pairs))
            yield _table([(number, *[None] * 8, pairs, counts)])
            number += 1

    return run


def _counted(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of a batch with the corpus-wide counts of their pairs."""
    order = np.argsort(pairs.column("pair").to_numpy())
    n, best = pairs.column("n").to_numpy()[order], pairs.column("best").to_numpy(zero_copy_only=False)[order]
    places, times = ([np.frombuffer(b, k) for b in docs.column(c).to_pylist()] for c, k in (("places", "<i4"), ("times", "<i8")))
    edges = np.cumsum([0, *map(len, places)])
    place, time = np.concatenate([np.zeros(0, "<i4"), *places]), np.concatenate([np.zeros(0, "<i8"), *times])
    sums = [np.diff(np.append(0, np.cumsum(time * value[place]))[edges]) for value in (best, n)]
    kept = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    extra = [pa.array(sums[0]), pa.array(sums[1]), docs.column("groups_sha256")]
    return pa.table([*kept.columns, *extra], names=[*kept.column_names, "n_best", "count_sum", "groups_sha256"])


def token_links(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path_a: str | None = None,
    path_b: str | None = None,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``: one row per document.

    Each text is encoded by both tokenizers after one blank, special tokens as
    plain text. Byte offsets where tokens of both end cut a document into
    groups (:func:`lockstep`); every token of A in a group is linked with every
    one of B. A pair of ids counts as many documents as hold it linked, in the
    whole table. ``n_best`` counts links whose pair has the highest count of
    its A id, ties included; ``count_sum`` adds the counts up over the links.

    Texts are encoded and merged once, and what that gives is stored. Distinct pairs of a
    batch of documents are counted before they are shuffled, and go back to
    the batch with their totals; a batch gets each pair once.

    Null and empty texts, and those whose tokens do not spell them (SentencePiece
    reads U+2581 as a blank), have no tokens: zeros and an empty digest. Rows that repeat an id
    come out and count one by one. An empty table gives no row.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "token-links")
    texts(docs, id_column, text_column).mapInArrow(_merged(path_a, path_b), SCHEMA).write.parquet(folder)
    rows, held = (spark.read.schema(SCHEMA).parquet(folder) for _ in range(2))
    held = held.where("pairs IS NOT NULL").select("batch", F.inline(F.arrays_zip("pairs", "ns"))).withColumnRenamed("pairs", "pair")
    totals = held.groupBy("pair").agg(F.sum("ns").alias("n"))
    highest = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    totals = totals.select("pair", "n", (F.col("n") == highest).alias("best"))
    replies = held.select("batch", "pair").join(totals, "pair")
    rows = rows.where("pairs IS NULL").drop("pairs", "ns")
    kinds = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(_counted, kinds)


def aligned(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path_a: str | None = None,
    path_b: str | None = None,
) -> DataFrame:
    """``doc_id, ids_a, ids_b, stops_a, stops_b``: both encodings of each text, and where its groups end.

    The k-th group holds the tokens before ``stops_a[k]`` and ``stops_b[k]`` that no earlier one holds.
    Texts that have no tokens (:func:`token_links`) have empty arrays. Rows that
    repeat an id come out one by one; an empty table gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _tokenizers(path_a, path_b)
        for batch in small_batches(batches, "text"):
            encoded = [tokenizers.encode(t) if t else None for t in batch.column("text").to_pylist()]
            merged = Merged.of([e for e in encoded if e], tokenizers)
            edges = np.searchsorted(merged.groups[0], np.append(merged.first_a, len(merged.ids_a)))
            rows, k = [], 0
            for both in encoded:
                if not both:
                    rows.append(([],) * 4)
                    continue
                first_a, first_b, n_a, n_b = merged.groups[:, edges[k] : edges[k + 1]]
                rows.append((*both, first_a + n_a - merged.first_a[k], first_b + n_b - merged.first_b[k]))
                k += 1
            columns = [pa.array(c, pa.list_(pa.int64())) for c in list(zip(*rows, strict=True)) or [()] * 4]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["doc_id", "ids_a", "ids_b", "stops_a", "stops_b"])

    kinds = "doc_id long, ids_a array<long>, ids_b array<long>, stops_a array<long>, stops_b array<long>"
    return texts(docs, id_column, text_column).mapInArrow(run, kinds)
