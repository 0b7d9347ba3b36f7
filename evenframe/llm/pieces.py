"""SentencePiece encoding and decoding over a relational lattice of words."""

from __future__ import annotations

import heapq
import re
import sys
import types
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain, count, islice
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenframe.functions.durable import durable

from .common import each_batch, small_batches, texts
from .lockstep import Folded, Lockstep, ragged

SPACE = "▁"
#: Words whose lattices are built as tables, the most frequent ones, and their longest length.
FREQUENT, LONGEST = 50_000, 40
#: Other words that a worker process remembers, and ids in all; beyond them it begins anew.
REMEMBERED, REMEMBERED_IDS = 400_000, 8_000_000
#: Below every path: the score of a character that is no piece.
UNKNOWN_PENALTY = 10.0
#: Model types of the file format.
UNIGRAM, BPE = 1, 2


@dataclass
class PieceTable:
    """The pieces of a model file; a vocabulary is small enough for every task."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    spelled: list[bytes]
    model_type: int
    unknown_score: float
    #: White space that no longer piece holds: words end there as well.
    apart: str = ""
    longest: int = field(default=1)


def _model_type(path: str) -> int:
    """Field 3 of field 2 of the file: what the model's scores mean."""

    def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
        at = 0

        def number() -> int:
            nonlocal at
            value = shift = 0
            while True:
                byte = data[at]
                at += 1
                value |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return value

        while at < len(data):
            tag = number()
            if tag & 7 == 0:
                yield tag >> 3, number()
            else:
                size = {1: 8, 5: 4}.get(tag & 7)
                size = number() if size is None else size
                yield tag >> 3, data[at : at + size]
                at += size

    with open(path, "rb") as file:
        for name, value in fields(file.read()):
            if name == 2:
                return next((v for n, v in fields(value) if n == 3), UNIGRAM)
    return UNIGRAM


def piece_table(path: str | None = None, model_type: int | None = None) -> PieceTable:
    """Reads a model file. ``model_type`` overrules the file's own."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids, spelled = {}, [0] * 256, []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            spelled.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            spelled.append(b"")
        else:
            pieces[piece] = (i, model.get_score(i))
            spelled.append(piece.encode())
    inside = {c for p in pieces if len(p) > 1 for c in p}
    return PieceTable(
        pieces,
        byte_ids,
        spelled,
        _model_type(path) if model_type is None else model_type,
        min(s for _, s in pieces.values()) - UNKNOWN_PENALTY,
        "".join(c for c in "\t\n\r" if c not in inside),
        max(map(len, pieces)),
    )


def word_pattern(table: PieceTable) -> str:
    """Words begin at a run of blanks; no piece has a blank after another character."""
    apart = re.escape(table.apart)
    return f"{SPACE}+[^{SPACE}{apart}]*|[^{SPACE}{apart}]+" + (f"|[{apart}]" if apart else "")


def _fallback(table: PieceTable, character: str) -> list[int]:
    return [table.byte_ids[b] for b in character.encode()]


def best_path(word: str, table: PieceTable) -> list[int]:
    """Viterbi: the ids of greatest total score, of equals the one with the longest last piece."""
    scores, back = [0.0], [(0, None)]
    for end in range(1, len(word) + 1):
        best = (scores[end - 1] + table.unknown_score, end - 1, None)
        known = False
        for start in range(max(0, end - table.longest), end):
            found = table.pieces.get(word[start:end])
            if found and (not known and start == end - 1 or scores[start] + found[1] > best[0]):
                best = (scores[start] + found[1], start, found[0])
                known = True
        scores.append(best[0])
        back.append(best[1:])
    ids, end = [], len(word)
    while end:
        start, piece = back[end]
        ids.append([piece] if piece is not None else _fallback(table, word[start:end]))
        end = start
    return [i for part in reversed(ids) for i in part]


def merged(word: str, table: PieceTable) -> list[int]:
    """Merges the neighbours of greatest score, the leftmost of equals, until none is a piece."""
    n = len(word)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    stop = list(range(1, n + 1))
    heap: list[tuple[float, int, int]] = []

    def offer(a: int) -> None:
        b = right[a]
        if b < n:
            found = table.pieces.get(word[a : stop[b]])
            if found:
                heapq.heappush(heap, (-found[1], a, stop[b]))

    for a in range(n - 1):
        offer(a)
    dead = [False] * n
    while heap:
        _, a, end = heapq.heappop(heap)
        if dead[a] or right[a] >= n or stop[right[a]] != end:
            continue
        b = right[a]
        dead[b], stop[a], right[a] = True, end, right[b]
        if right[a] < n:
            left[right[a]] = a
        offer(a)
        if left[a] >= 0:
            offer(left[a])
    ids: list[int] = []
    a = 0
    while a < n:
        found = table.pieces.get(word[a : stop[a]])
        ids += [found[0]] if found else _fallback(table, word[a : stop[a]])
        a = right[a]
    return ids


def lattice(words: DataFrame, table: PieceTable) -> DataFrame:
    """``word, edges``: the pieces that a word's substrings are.

    Substrings of bounded length are exploded, joined to the pieces by equality
    and grouped by word. An edge is ``start, stop, id, score``; a character that
    is no piece has one with id -1.
    """
    spark: SparkSession = words.sparkSession
    pieces = spark.createDataFrame([(p, i, s) for p, (i, s) in table.pieces.items()], "piece string, id int, score double")
    starts = words.select("word", F.posexplode(F.split("word", "")).alias("start", "c")).where("c != ''")
    ends = F.sequence(F.lit(1), F.least(F.lit(table.longest), F.char_length("word") - F.col("start")))
    spans = starts.select("word", "start", F.explode(ends).alias("size"))
    spans = spans.withColumn("piece", F.expr("substring(word, start + 1, size)"))
    joined = spans.join(F.broadcast(pieces), "piece", "left").where("id IS NOT NULL OR size = 1")
    edge = F.struct(
        "start",
        (F.col("start") + F.col("size")).alias("stop"),
        F.coalesce("id", F.lit(-1)).alias("id"),
        F.coalesce("score", F.lit(table.unknown_score)).alias("score"),
    )
    return joined.groupBy("word").agg(F.array_sort(F.collect_list(edge)).alias("edges"))


def _viterbi() -> str:
    """Fold over the edges by start: the best way to each place, then back from the end."""
    begin = "transform(sequence(0, n), i -> named_struct('score', IF(i = 0, 0D, CAST(NULL AS DOUBLE)), 'start', 0, 'id', -1))"
    better = "s[e.stop].score IS NULL OR s[e.start].score + e.score > s[e.stop].score"
    step = (
        f"IF({better}, transform(s, (x, i) -> IF(i = e.stop, named_struct('score', s[e.start].score + e.score, "
        "'start', e.start, 'id', e.id), x)), s)"
    )
    back = (
        "aggregate(sequence(1, n), named_struct('at', n, 'path', CAST(array() AS ARRAY<STRUCT<start: INT, stop: INT, id: INT>>)), "
        "(s, _) -> IF(s.at = 0, s, named_struct('at', ways[s.at].start, 'path', "
        "concat(array(named_struct('start', ways[s.at].start, 'stop', s.at, 'id', ways[s.at].id)), s.path)))).path"
    )
    return f"aggregate(edges, {begin}, (s, e) -> {step})", back


def _merge() -> str:
    """Fold that takes away a boundary at a time, that between the two best neighbours."""
    # bounds[k] and bounds[k + 2] enclose two neighbours; an edge over them is a merge
    fits = (
        "filter(edges, e -> array_position(b, e.start) > 0 "
        "AND array_position(b, e.stop) = array_position(b, e.start) + 2)"
    )
    best = f"array_max(transform({fits}, e -> named_struct('score', e.score, 'start', -e.start)))"
    drop = f"transform(array({best}), m -> IF(m IS NULL, b, filter(b, (x, i) -> i != array_position(b, -m.start))))[0]"
    return f"aggregate(sequence(1, n), sequence(0, n), (b, _) -> {drop})"


def segmented(words: DataFrame, table: PieceTable) -> DataFrame:
    """``word, best, ids``: the best path, and the ids that the model's type gives.

    Words with a character that is no piece are left out.
    """
    rows = lattice(words, table).withColumn("n", F.char_length("word"))
    ways, back = _viterbi()
    rows = rows.withColumn("ways", F.expr(ways)).withColumn("path", F.expr(back))
    if table.model_type == BPE:
        bounds = F.expr(_merge())
        rows = rows.withColumn("bounds", bounds).withColumn(
            "merged",
            F.expr(
                "transform(sequence(0, size(bounds) - 2), k -> named_struct('start', bounds[k], 'stop', bounds[k + 1], "
                "'id', filter(edges, e -> e.start = bounds[k] AND e.stop = bounds[k + 1])[0].id))"
            ),
        )
    else:
        rows = rows.withColumn("merged", F.col("path"))
    known = F.forall("edges", lambda e: e["id"] >= 0)
    ids = [F.transform(c, lambda p: p["id"]).alias(a) for c, a in (("path", "best"), ("merged", "ids"))]
    return rows.where(known).select("word", *ids)


def frequent_words(rows: DataFrame, table: PieceTable, most: int = FREQUENT) -> DataFrame:
    """The most frequent words of all texts, ties by word; counted before the shuffle."""
    normal = F.concat(F.lit(SPACE), F.replace("text", F.lit(" "), F.lit(SPACE)))
    words = F.regexp_extract_all(normal, F.lit(f"({word_pattern(table)})"), F.lit(1))
    counted = rows.where("text != ''").select(F.explode(words).alias("word")).groupBy("word").count()
    short = counted.where(F.char_length("word") <= LONGEST)
    return short.orderBy(F.desc("count"), "word").limit(most).select("word")


class _Runs:
    """Runs of numbers, one after another, by their own numbers."""

    def __init__(self, runs: Iterable[bytes | list[int]] = (), kind: str = "<u4"):
        runs = [np.frombuffer(r, kind) if isinstance(r, bytes) else np.array(r, kind) for r in runs]
        self.sizes = np.array([len(r) for r in runs], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.values = np.concatenate([np.zeros(0, kind), *runs])

    def add(self, n: int, found: Iterable[Folded]) -> None:
        """``n`` more runs, those of ``found``."""
        base, end, values = len(self.sizes), len(self.values), [self.values]
        self.sizes = np.append(self.sizes, np.zeros(n, np.int64))
        self.starts = np.append(self.starts, np.zeros(n, np.int64))
        for places, sizes, new in found:
            self.sizes[base + places], self.starts[base + places] = sizes, end + np.cumsum(sizes) - sizes
            end += len(new)
            values.append(new)
        self.values = np.concatenate(values)

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of these runs, and where each run ends, with a 0 before."""
        sizes = self.sizes[numbers]
        return self.values[ragged(self.starts[numbers], sizes)], np.append(0, np.cumsum(sizes))


class _Words:
    """Encoded words: best path and ids. Those not known are folded together where they occur."""

    def __init__(self, known: dict[str, tuple[bytes, bytes]], table: PieceTable):
        self.known, self.table = known, table
        self.lockstep = Lockstep(table.pieces, table.unknown_score, lambda c: _fallback(table, c))
        self.spelled = _Runs(table.spelled, "u1")
        self._begin()

    def _begin(self) -> None:
        self.number: dict[str, int] = defaultdict(count().__next__)
        for word in self.known:
            self.number[word]
        self.best = _Runs(best for best, _ in self.known.values())
        self.ids = _Runs(ids for _, ids in self.known.values()) if self.table.model_type == BPE else self.best

    def numbers(self, split: list[list[str]]) -> np.ndarray:
        """The numbers of all words; ``best`` and ``ids`` then have their runs."""
        before = len(self.number)
        if before > len(self.known) + REMEMBERED or len(self.best.values) > REMEMBERED_IDS:
            self._begin()
            before = len(self.number)
        out = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))
        new = list(islice(self.number, before, None))
        groups, long = self.lockstep.groups(new, LONGEST), [at for at, w in enumerate(new) if len(w) > LONGEST]
        self.best.add(len(new), chain(self.lockstep.best(groups), self._alone(new, long, best_path)))
        if self.ids is not self.best:
            self.ids.add(len(new), chain(self.lockstep.merged(groups), self._alone(new, long, merged)))
        return out

    def _alone(self, words: list[str], places: list[int], fold) -> Iterator[Folded]:
        for at in places:
            ids = np.array(fold(words[at], self.table), "<u4")
            yield np.array([at]), np.array([len(ids)]), ids


def _kept(name: str, make):
    """What a worker process keeps under a name; it outlives tasks, as workers do."""
    kept = sys.modules.setdefault("_evenframe_pieces", types.ModuleType("_evenframe_pieces"))
    if vars(kept).get("name") != name:
        vars(kept).update(name=name, value=make())
    return kept.value


def _text(spelled: bytes) -> str:
    return spelled.decode(errors="replace").replace(SPACE, " ").removeprefix(" ")


def decoded(ids: np.ndarray, table: PieceTable) -> str:
    """The text that ids spell, without the blank that encoding puts first."""
    return _text(b"".join(map(table.spelled.__getitem__, ids.tolist())))


def _encoded(spread, name: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make():
            known, table = spread.value
            return _Words(known, table), table

        words, table = _kept(name, make)
        find = re.compile(word_pattern(table)).findall
        for batch in small_batches(batches, "text"):
            given = batch.column("text").to_pylist()
            split = [find(SPACE + text.replace(" ", SPACE)) if text else [] for text in given]
            numbers = words.numbers(split)
            last = np.append(0, np.cumsum([len(found) for found in split]))
            (best, best_ends), (ids, ends) = words.best.joined(numbers), words.ids.joined(numbers)
            best_runs, runs = _cut(best, best_ends[last]), _cut(ids, ends[last])
            if digests:
                letters, letter_ends = words.spelled.joined(ids)
                spelled = map(_text, _cut(letters, letter_ends[ends[last]]))
                same = [s == text.replace(SPACE, " ") for s, text in zip(spelled, given, strict=True)]
                columns = [f(x) for x in (runs, best_runs) for f in (_sizes, _checksums)] + [pa.array(same, pa.bool_())]
                names = ["n_ids", "ids_crc32", "n_best", "best_crc32", "round_trip"]
            else:
                columns, names = [pa.array(x, pa.binary()) for x in (runs, best_runs)], ["ids", "best"]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["doc_id", *names])

    return run


def _cut(values: np.ndarray, ends: np.ndarray) -> list[bytes]:
    blob, ends = values.tobytes(), (ends * values.itemsize).tolist()
    return [blob[start:end] for start, end in zip(ends, ends[1:], strict=False)]


def _sizes(runs: list[bytes]) -> pa.Array:
    return pa.array([len(r) // 4 for r in runs], pa.int64())


def _checksums(runs: list[bytes]) -> pa.Array:
    return pa.array([zlib.crc32(r) for r in runs], pa.int64())


def encode(
    docs: DataFrame,
    table: PieceTable | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    frequent: int = FREQUENT,
    digests: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, ids, best``, little-endian 32-bit numbers.

    ``ids`` are what SentencePiece gives for the model. ``best`` is the path of
    the greatest total score. For Unigram models both are the same; the scores
    of BPE models are ranks of merges, so their ids come from merging instead,
    over the same lattice.

    The ``frequent`` most frequent words are segmented as tables (:func:`lattice`)
    and spread to the tasks: a bounded number of words of bounded length. Words
    beyond them are folded in the same way where they occur, whatever their
    length, so the documents themselves are not shuffled. So are words with a
    character that is no piece. The new words of a batch are folded together,
    those of one length in step (:mod:`.lockstep`); words longer than LONGEST
    one by one.

    ``digests`` gives sizes, checksums and ``round_trip``, whether decoding gives
    the text back, in place of the numbers. Null and empty texts have no ids.
    Rows that repeat an id come out one by one. An empty table gives no row.
    """
    table = piece_table() if table is None else table
    rows = texts(docs, id_column, text_column)
    common = durable(frequent_words(rows, table, frequent))
    found = segmented(common, table).collect()
    known = {r[0]: (pack(f"<{len(r[1])}I", *r[1]), pack(f"<{len(r[2])}I", *r[2])) for r in found}
    del found
    context = docs.sparkSession.sparkContext
    spread = context.broadcast((known, table))
    kinds = "n_ids long, ids_crc32 long, n_best long, best_crc32 long, round_trip boolean" if digests else "ids binary, best binary"
    return rows.mapInArrow(_encoded(spread, f"{context.applicationId}-{spread._jbroadcast.id()}", digests), f"doc_id long, {kinds}")


def decode(encoded: DataFrame, table: PieceTable | None = None) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``. Ids of control pieces spell nothing."""
    table = piece_table() if table is None else table

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [decoded(np.frombuffer(b or b"", "<u4"), table) for b in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(each_batch(work), "doc_id long, text string")
