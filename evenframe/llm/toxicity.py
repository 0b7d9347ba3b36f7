"""Toxicity scores by nearest labelled examples under exact TF-IDF cosine."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenframe.functions.durable import durable

from .common import per_batch, small_batches, texts
from .language import fold

FOLDS, HELD_OUT_FOLD = 5, 0
#: Labelled documents of each class that examples are drawn from, at most.
EXAMPLES = 4096
NEIGHBOURS = 25
#: A vote weighs its cosine over its distance and NEAREST; the prior's weight is added.
NEAREST, PRIOR_MASS = 0.1, 0.5
#: Examples of a block of the index.
BLOCK = 64
#: Words of one example in OFTEN or more are held as columns of the blocks, DENSE of them at most.
OFTEN, DENSE = 32, 512
#: Texts that are looked up together, and blocks that each visits before others are passed over.
TOGETHER, FIRST = 64, 4
#: Cosines that differ by less are ties.
DIGITS = 10
SIGNATURES = 4
SHINGLE = 5
_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def known_counts(texts: list[str], words: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``ends, at, n``: text i has the words ``at[ends[i] : ends[i + 1]]``, in order, ``n`` times each."""
    found = [words_of(t) for t in texts]
    sizes, most = np.array([len(f) for f in found], np.int64), max(1, len(words))
    at = np.fromiter(map(words.get, chain.from_iterable(found), repeat(-1)), np.int64, sizes.sum())
    key = np.repeat(np.arange(len(texts)), sizes) * most + at
    key, n = np.unique(key[at >= 0], return_counts=True)
    return np.searchsorted(key, np.arange(len(texts) + 1) * most), key % most, n


def _signatures(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    signatures = []
    for text in batch.column("text").to_pylist():
        found = words_of(text)
        runs = {" ".join(found[i : i + SHINGLE]) for i in range(max(1, len(found) - SHINGLE + 1))}
        signatures.append([min(xxhash.xxh3_64_intdigest(r, seed) for r in runs) >> 1 for seed in range(SIGNATURES)])
    columns = [batch.column("id"), batch.column("row"), pa.array(signatures, pa.list_(pa.int64()))]
    yield pa.RecordBatch.from_arrays(columns, names=["id", "row", "signature"])


def _word_counts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The distinct words of each text, one a line, and their counts."""
    counts = [Counter(words_of(t)) for t in batch.column("text").to_pylist()]
    columns = [batch.column(c) for c in ("id", "row", "toxic")]
    columns.append(pa.array(["\n".join(c) for c in counts], pa.string()))
    columns.append(pa.array([np.array(list(c.values()), np.int32).tobytes() for c in counts], pa.binary()))
    yield pa.RecordBatch.from_arrays(columns, names=["id", "row", "toxic", "words", "n"])


@dataclass
class Model:
    """Examples as vectors, in an inverted index of blocks with their greatest weights."""

    words: dict[str, int]
    #: What a word's weight in a text is multiplied with.
    scale: np.ndarray
    prior: float
    #: Rate of toxic examples among those without any of the words.
    blank_rate: float
    ids: np.ndarray
    votes: np.ndarray
    labels: np.ndarray
    #: Postings of word w: examples and weights from starts[w] to starts[w + 1].
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    postings: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    n_blocks: int = 0

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        at, n = np.array(list(counts), np.int64), np.array(list(counts.values()), float)
        order = np.argsort(at)
        return self.weighed(at[order], n[order])

    def weighed(self, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The vector of words in order that occur ``n`` times each."""
        weight = (1 + np.log(n)) * self.scale[at]
        return at, weight / np.sqrt((weight**2).sum())

    def counts(self, text: str) -> dict[int, int]:
        known = self.words
        return {known[w]: n for w, n in Counter(words_of(text)).items() if w in known}

    def index(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.n_blocks = -(-len(vectors) // BLOCK)
        word = np.concatenate([np.zeros(0, np.int64), *(at for at, _ in vectors)])
        order = np.argsort(word, kind="stable")
        self.postings = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(at) for at, _ in vectors])[order]
        self.weights = np.concatenate([np.zeros(0), *(x for _, x in vectors)])[order]
        self.starts = np.searchsorted(word[order], np.arange(len(self.words) + 1))

    @cached_property
    def frequent(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each word's column or -1, the blocks' weights by column, and the greatest of each block.

        They are made where the model is used and do not travel with it.
        """
        seen = np.diff(self.starts)
        often = np.flatnonzero(seen * OFTEN >= len(self.ids))
        often = often[np.argsort(-seen[often], kind="stable")][:DENSE]
        column = np.full(len(seen), -1, np.int64)
        column[often] = np.arange(len(often))
        table = np.zeros((self.n_blocks, len(often), BLOCK))
        for c, w in enumerate(often.tolist()):
            span = slice(self.starts[w], self.starts[w + 1])
            table[self.postings[span] // BLOCK, c, self.postings[span] % BLOCK] = self.weights[span]
        return column, table, table.max(axis=2)

    def nearest(self, at: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of the greatest positive cosine, ties by their order."""
        return self.nearest_of([(at, weight)], k)[0]

    def nearest_of(
        self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vector the ``k`` examples of the greatest positive cosine, ties by their order.

        Postings add up the words that few examples have. With the greatest
        weights of a block for the others this bounds the cosines in the block
        from above. Each vector visits the blocks of its greatest bounds, and
        then all that can reach the k-th best cosine found by then.
        """
        column, table, most = self.frequent
        n = self.n_blocks * BLOCK
        score, often = np.zeros((len(vectors), n)), np.zeros((len(vectors), most.shape[1]))
        for row, (at, weight) in enumerate(vectors):
            c = column[at]
            often[row, c[c >= 0]] = weight[c >= 0]
            start, size = self.starts[at[c < 0]], self.starts[at[c < 0] + 1] - self.starts[at[c < 0]]
            place = np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)
            x = np.repeat(weight[c < 0], size) * self.weights[place]
            score[row] = np.bincount(self.postings[place], x, minlength=n)
        blocks = score.reshape(len(vectors), self.n_blocks, BLOCK)
        bound = blocks.max(axis=2) + often @ most.T + 1e-9
        visited = np.zeros(bound.shape, bool)

        def visit(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(axis=0)).tolist():
                rows = np.flatnonzero(wanted[:, b])
                blocks[rows, b] += often[rows] @ table[b]
            visited[wanted] = True

        first = np.zeros(bound.shape, bool)
        np.put_along_axis(first, np.argsort(-bound, axis=1, kind="stable")[:, :FIRST], True, axis=1)
        visit(first)
        kth = max(0, n - k)
        visit(~visited & (bound >= np.partition(score, kth, axis=1)[:, [kth]]))
        blocks[~visited] = 0
        out = []
        for found, least in zip(score, np.partition(score, kth, axis=1)[:, kth].tolist(), strict=True):
            hit = np.flatnonzero((found >= least - 10.0**-DIGITS) & (found > 0))
            cosine = np.round(found[hit], DIGITS)
            order = np.lexsort((hit, -cosine))[:k]
            out.append((hit[order], cosine[order]))
        return out

    def scores(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, list[int]]]:
        """Share of toxic votes, weighted by distance, and the nearest examples' ids, of each text's words and counts."""
        if not len(self.ids):
            return [(self.blank_rate, [])] * len(texts)
        out: list[tuple[float, list[int]]] = [(self.blank_rate, [])] * len(texts)
        some = [i for i, (at, _) in enumerate(texts) if len(at)]
        for start in range(0, len(some), TOGETHER):
            part = some[start : start + TOGETHER]
            for i, (found, cosine) in zip(part, self.nearest_of([self.weighed(*texts[i]) for i in part]), strict=True):
                mass = cosine / (1 - cosine + NEAREST) * self.votes[found]
                total = mass.sum() + PRIOR_MASS
                value = (float((mass * self.labels[found]).sum()) + PRIOR_MASS * self.prior) / total
                out[i] = min(1.0, max(0.0, float(value))), self.ids[found[:3]].tolist()
        return out


def _document_counts(known: Broadcast):
    """How many documents of a partition have each word, and under -1 how many there are."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = known.value
        seen, n = np.zeros(len(words), np.int64), 0
        for batch in small_batches(batches, "text"):
            n += batch.num_rows
            _, at, _ = known_counts(batch.column("text").to_pylist(), words)
            seen += np.bincount(at, minlength=len(words))
        at = np.flatnonzero(seen)
        columns = [pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(seen[at], n), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["at", "n"])

    return work


def _lean(counts: list[tuple[dict, dict[int, int]]], n_words: int) -> np.ndarray:
    """Chi-squared of each word's presence against the label, 0 for words not seen rather in toxic examples."""
    held = np.zeros((2, n_words))
    sizes = np.zeros((2, 1))
    for r, c in counts:
        held[r["toxic"], list(c)] += 1
        sizes[r["toxic"]] += 1
    (b, a), (d, c) = held, sizes - held
    chi2 = sizes.sum() * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * (a + c) * (b + d), 1)
    return np.where(a * d > b * c, chi2, 0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    examples: int = EXAMPLES,
) -> Model:
    """Learns from labelled documents that are not held out.

    At most ``examples`` documents of each class, those of the smallest hash of
    the id, are looked at; votes are weighted so that the classes keep their
    true proportion. Near copies among them count once. All words of the
    examples make up the vectors. A word's weight is its TF-IDF, how rare it is
    coming from all documents, times one and, where it is seen rather in toxic
    examples, the chi-squared of that on top. The driver gets the counted words
    of the examples.

    Of several labels of one document the greatest counts. Without labelled
    documents of both classes, every score is the rate of the class seen, or 0.
    """
    rated = labels.where(labels[label_column].isNotNull() & (fold(labels[id_column], FOLDS) != HELD_OUT_FOLD))
    rated = rated.groupBy(rated[id_column].cast("long").alias("rated_id")).agg(
        (F.max(rated[label_column]) > 0).cast("int").alias("toxic")
    )
    totals = {r["toxic"]: r["n"] for r in rated.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    drawn = [
        rated.where(F.col("toxic") == value).orderBy(F.xxhash64("rated_id"), "rated_id").limit(examples)
        for value in (0, 1)
    ]
    drawn = [r for d in drawn for r in d.collect()]
    spark = docs.sparkSession
    sample = spark.createDataFrame([(r[0], r[1]) for r in drawn], "rated_id long, toxic int")
    rows = texts(docs, id_column, text_column).withColumn("row", F.xxhash64("text"))
    rows = rows.join(F.broadcast(sample), F.col("id") == F.col("rated_id"))
    drawn_texts = durable(rows.select("id", "row", "text", "toxic"))
    signed = drawn_texts.mapInArrow(per_batch(_signatures, "text"), "id long, row long, signature array<long>").collect()
    seen: set[tuple[int, int]] = set()
    first = []
    for r in sorted(signed, key=lambda r: (r["id"], r["row"])):
        signature = set(enumerate(r["signature"]))
        if not signature & seen:
            first.append((r["id"], r["row"]))
        seen |= signature
    firsts = spark.createDataFrame(first, "id long, row long")
    kept = drawn_texts.join(F.broadcast(firsts), ["id", "row"], "left_semi").dropDuplicates(["id", "row"])
    sizes = {r["toxic"]: r["n"] for r in kept.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    empty = np.zeros(0)
    model = Model({}, empty, prior, prior, np.zeros(0, np.int64), empty, empty)
    if len(sizes) < 2:
        return model
    counted = kept.mapInArrow(
        per_batch(_word_counts, "text"), "id long, row long, toxic int, words string, n binary"
    ).toArrow()
    rows = sorted(counted.to_pylist(), key=lambda r: (r["id"], r["row"]))
    del counted
    words: dict[str, int] = {}
    counts = []
    for r in rows:
        at = [words.setdefault(w, len(words)) for w in r.pop("words").split("\n") if w]
        counts.append((r, dict(zip(at, np.frombuffer(r.pop("n"), np.int32).tolist(), strict=True))))
    every = docs.select(F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"))
    known = spark.sparkContext.broadcast(words)
    seen_in = every.mapInArrow(_document_counts(known), "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    seen_in = seen_in.toArrow()
    at, n = seen_in.column("at").to_numpy(), seen_in.column("n").to_numpy()
    known.unpersist()
    n_docs, df = int(n[at < 0].sum()), np.zeros(len(words), np.int64)
    df[at[at >= 0]] = n[at >= 0]
    model.words = words
    model.scale = (1 + np.log((1 + n_docs) / (1 + df))) * (1 + _lean(counts, len(words)))
    share = {y: totals[y] / sizes[y] for y in (0, 1)}
    blank = Counter(r["toxic"] for r, c in counts if not c)
    mass = {y: blank[y] * share[y] for y in (0, 1)}
    model.blank_rate = mass[1] / (mass[0] + mass[1]) if blank else prior
    vectors = [(r, model.vector(c)) for r, c in counts if c]
    # neighbours in the index share their heaviest words, so that whole blocks can be passed over
    vectors.sort(key=lambda rv: (rv[1][0][np.argsort(-rv[1][1], kind="stable")].tolist(), rv[0]["id"]))
    model.ids = np.array([r["id"] for r, _ in vectors], np.int64)
    model.labels = np.array([r["toxic"] for r, _ in vectors], float)
    model.votes = np.array([share[r["toxic"]] for r, _ in vectors]) / max(share.values())
    model.index([v for _, v in vectors])
    return model


def _scored(known: Broadcast):
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = known.value
        ends, at, n = known_counts(batch.column("text").to_pylist(), model.words)
        counts = [(at[a:b], n[a:b].astype(float)) for a, b in zip(ends, ends[1:], strict=False)]
        keys = [(at.tobytes(), n.tobytes()) for at, n in counts]
        distinct = dict(zip(keys, counts, strict=True))
        known_scores = dict(zip(distinct, model.scores(list(distinct.values())), strict=True))
        rows = [known_scores[k] for k in keys]
        scores = np.array([r[0] for r in rows])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("held_out"),
                pa.array(scores, pa.float64()),
                pa.array((scores >= 0.5).astype(np.int32)),
                pa.array([r[1] for r in rows], pa.list_(pa.int64())),
            ],
            names=["doc_id", "held_out", "score", "predicted", "evidence"],
        )

    return work


def toxicity(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, evidence``.

    The score is the share of toxic votes among the NEIGHBOURS nearest examples,
    weighted by distance, together with the prior at PRIOR_MASS. A
    text without any word of the examples, such as an empty or null one, scores
    the toxic rate of such examples. ``evidence`` holds the ids of the three
    nearest examples. Only the text is looked at. An empty table gives no row;
    further columns are ignored.
    """
    rows = docs.select(
        docs[id_column].cast("long").alias("id"),
        (fold(docs[id_column], FOLDS) == HELD_OUT_FOLD).alias("held_out"),
        F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(
        per_batch(_scored(docs.sparkSession.sparkContext.broadcast(model)), "text"),
        "doc_id long, held_out boolean, score double, predicted int, evidence array<long>",
    )
