"""Small cases of each operator: nulls, empty and long texts, ties, repeats, clashes."""

import os
import random
import time
import tracemalloc
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import corpus_pipeline
import pytest
from evenframe.functions.durable import FREES, durable
from evenframe.llm import chat, exact_dedup, induced, language, line_dedup, packing, pieces, quality
from evenframe.llm import shingle_join, suffix_dedup, toxicity
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, keep_id long, kept string, id long, row int"


@pytest.fixture
def documents(spark):
    def make(*rows):
        """Rows of id and text; the other columns clash with names of results."""
        return spark.createDataFrame([(i, t, "en", "s", 7, "x", 9, 1) for i, t in rows], DOCUMENTS)

    return make


def prose(seed, n, words="ab cde fgh ijk lmn opq rst uvw xyz alpha beta gamma".split()):
    r = random.Random(seed)
    return " ".join(r.choice(words) + str(r.randint(0, 99)) for _ in range(n))


def by_id(df, *columns):
    return {r[0]: tuple(r[c] for c in columns) for r in df.collect()}


def lower(text):
    return (text or "").encode().lower()


# --- exact dedup ---------------------------------------------------------------


ROWS = [(1, "Ab"), (2, "aB"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "x" * 200_000), (8, "X" * 200_000)]


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.substring(F.unhex(F.sha2(c, 256)), 1, 0)])
def test_exact_dedup_compares_contents(documents, digest):
    got = by_id(exact_dedup.exact_dedup(documents(*ROWS), digest=digest), "keep_id", "group_size", "kept", "text_sha256")
    assert len(got) == len(ROWS)
    for i, text in ROWS:
        same = [j for j, other in ROWS if lower(other) == lower(text)]
        assert got[i] == (max(same), len(same), i == max(same), sha256(lower(text)).hexdigest())


def test_exact_dedup_of_null_ids_and_nothing(documents):
    rows = exact_dedup.exact_dedup(documents((None, "a"), (1, "a"), (None, "b"))).collect()
    assert sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["kept"]) for r in rows) == [(0, 0, True), (0, 1, False), (1, 1, True)]
    assert exact_dedup.exact_dedup(documents((1, "a")).limit(0)).count() == 0
    kept = exact_dedup.drop_copies(documents((None, "a"), (1, "A"), (None, "b")))
    assert kept.columns == [c.split()[0] for c in DOCUMENTS.split(", ")]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [(0, "b"), (1, "A")]


# --- lines ---------------------------------------------------------------------


def lines_by_hand(rows):
    keys = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(line_dedup.BLANKS).encode().lower()
            if len(key.decode()) >= 20:
                keys.setdefault(key, set()).add(i)
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if len(keys.get(k := x.strip(line_dedup.BLANKS).encode().lower(), ())) < 3 or max(keys[k]) == i
        ]
        out[i] = (len(lines), len(lines) - len(kept), sha256("\n".join(kept).encode()).hexdigest())
    return out


def test_line_dedup(documents):
    common, rare = "A line that many documents hold", "only two documents have this one"
    rows = [(i, f"{prose(i, 3)}\n \t{common.upper() if i % 2 else common}\r\nend\n{common}") for i in range(40)]
    rows += [(100, f"{rare}\nshort"), (101, f"{rare}\nshort"), (102, "short"), (103, None), (104, ""), (105, "\n")]
    got = by_id(line_dedup.line_dedup(documents(*rows)), "n_lines", "n_dropped", "kept_sha256")
    assert got == lines_by_hand(rows)
    assert line_dedup.line_dedup(documents((1, "a")).limit(0)).count() == 0


# --- packing -------------------------------------------------------------------


def test_best_fit_places_what_a_loop_places():
    r = random.Random(1)
    for _ in range(200):
        capacity = r.choice([10, 50, 100])
        lengths = [r.randint(1, capacity) for _ in range(r.randint(0, 150))]
        counts = {n: lengths.count(n) for n in lengths}
        bins, order = {}, sorted(packing.best_fit(counts, capacity))
        for k, (length, first, bin_, each, offset) in enumerate(order):
            last = order[k + 1][1] if k + 1 < len(order) and order[k + 1][0] == length else counts[length]
            for item in range(first, last):
                place = offset + (item - first) % each * length
                bins.setdefault(bin_ + (item - first) // each, []).append((place, length))
        for parts in bins.values():
            assert [p for p, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1]]
        loop = []
        for length in sorted(lengths, reverse=True):
            fitting = [(rest, i) for i, rest in enumerate(loop) if rest >= length]
            if fitting:
                loop[min(fitting)[1]] -= length
            else:
                loop.append(capacity - length)
        assert sorted(capacity - sum(n for _, n in p) for p in bins.values()) == sorted(loop)


def test_packed_pieces_hold_the_ids_of_tokenizers(documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(i, prose(i, 30 * i)) for i in range(30)]
    rows += [(100, None), (101, ""), (102, "a  b \n c"), (103, "<|endoftext|> x 日本 é"), (104, prose(1, 3000)), (104, "twice")]
    packed = packing.pack(documents(*rows), with_ids=True)
    pieces_ = packed.collect()
    ids = {}
    for r in sorted(pieces_, key=lambda r: r["start"]):
        assert r["length"] == len(r["ids"]) // 4 <= 2048 and r["ids_crc32"] == zlib.crc32(r["ids"])
        ids.setdefault(r["doc_id"], []).append(bytes(r["ids"]))
    for i, text in rows:
        if i != 104:
            wanted = [*library.encode(text or "", add_special_tokens=False).ids, 0]
            assert np.frombuffer(b"".join(ids[i]), "<u4").tolist() == wanted
    places = {}
    for r in pieces_:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        assert [p for p, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1]]
        assert sum(n for _, n in parts) <= 2048
    assert packing.sequences(packed).count() == len(places)
    assert packing.pack(documents((1, "a")).limit(0)).count() == 0


def test_encoder_agrees_with_the_library_on_odd_texts():
    encoder = packing.encoder(None)
    r = random.Random(2)
    for _ in range(3000):
        text = "".join(r.choice(" \n\ta'sé1.,#　日") for _ in range(r.randint(0, 14)))
        assert encoder.encode(text) == encoder.whole(text), repr(text)


# --- language ------------------------------------------------------------------


def test_language_id(spark, documents):
    texts = {"en": "the house and the garden of the mother", "de": "das haus und der garten der mutter ist schön"}
    rows = [(i, f"{texts['de' if i % 2 else 'en']} {i}", "de" if i % 2 else "en") for i in range(40)]
    rows += [(100, None, "en"), (101, " 12 !", "de"), (102, "der schöne garten " * 9000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1))
    got = by_id(language.language_id(docs), "held_out", "lang_pred", "score")
    for i, _, lang in rows[:40]:
        assert got[i][:2] == (zlib.crc32(str(i).encode()) % 4 == 2, lang)
    assert [got[i][1:] for i in (100, 101)] == [("und", 0.0)] * 2
    assert got[102][1] == "de" and all(0 <= s <= 1 for _, _, s in got.values())
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == 41
    assert by_id(language.language_id(docs.withColumn("lang", F.lit(None).cast("string"))), "lang_pred")[1] == ("und",)
    assert language.language_id(docs.limit(0)).count() == 0


# --- chat ----------------------------------------------------------------------


def test_preferences(spark):
    kind = "conv_id long, turn long, role string, text string, part int"
    chosen = [(1, 0, "user", "hi<|x"), (1, 1, "assistant", "good"), (1, 2, "user", None), (2, 0, "user", "q"), (2, 0, "user", "q"), (3, None, None, "z")]
    rejected = [(1, 0, "user", "hi<|x"), (1, 1, "assistant", "bad"), (2, 0, "user", "q"), (4, 0, "assistant", "w")]
    frames = [spark.createDataFrame([(*r, 1) for r in rows], kind) for rows in (chosen, rejected)]
    segments = chat.preference_segments(*frames)
    got = {r["conv_id"]: r for r in chat.preference_samples(segments).collect()}
    assert got[1]["prompt"] == "<|user|>\nhi< |x<|end|>\n"
    assert got[1]["chosen"] == "<|assistant|>\ngood<|end|>\n<|user|>\n<|end|>\n"
    assert got[1]["rejected"] == "<|assistant|>\nbad<|end|>\n"
    (start, length), = got[1]["chosen_spans"]
    assert got[1]["chosen"][start : start + length] == "good<|end|>\n"
    assert (got[2]["prompt"], got[2]["chosen"], got[2]["rejected"]) == ("<|user|>\nq<|end|>\n", "", "")
    assert got[3]["prompt"] == "" and got[3]["chosen"] == "<||>\nz<|end|>\n" and got[4]["rejected_spans"]
    assert chat.preference_segments(frames[0].limit(0), frames[1].limit(0)).count() == 0


# --- toxicity ------------------------------------------------------------------


def test_toxicity_learns_and_finds_exact_neighbours(spark, documents):
    rows = [(i, prose(i, 30) + (" nasty vile" if i % 4 == 0 else "")) for i in range(200)] + [(900, None), (901, "")]
    docs = documents(*rows)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows[:200]] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = by_id(toxicity.toxicity(docs, model), "held_out", "score", "predicted")
    assert all(got[i][2] == int(i % 4 == 0) for i in range(200))
    assert got[1][0] == (zlib.crc32(b"1") % 5 == 0) and got[900][2] == got[901][2] == 0
    assert by_id(toxicity.toxicity(docs, toxicity.fit(docs, labels.limit(0))), "score")[1] == (0.0,)


def test_block_index_equals_brute_force():
    r = random.Random(5)
    words = {f"w{i}": i for i in range(12)}
    n = 300
    model = toxicity.Model(words, np.linspace(1, 3, 12), 0.1, 0.0, np.arange(n), np.ones(n), np.zeros(n))
    vectors = [model.vector({w: r.randint(1, 4) for w in r.sample(range(12), r.randint(1, 5))}) for _ in range(n)]
    model.index(vectors)
    dense = np.zeros((n, 12))
    for row, (at, x) in zip(dense, vectors, strict=True):
        row[at] = x
    for at, x in vectors[:40]:
        found, cosine = model.nearest(at, x, 7)
        every = dense[:, at] @ x
        assert np.allclose(cosine, np.sort(every)[::-1][:7]) and np.allclose(every[found], cosine)


def test_all_words_and_examples_are_in_the_index(spark, documents):
    rows = [(i, prose(i, 30) + (" nasty vile" if i % 4 == 0 else "")) for i in range(200)]
    model = toxicity.fit(documents(*rows), spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    learned = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    assert sorted(model.ids) == [i for i, _ in learned]
    assert set(model.words) == {w for _, t in learned for w in t.split()}
    text_of = dict(rows)
    got = by_id(toxicity.toxicity(documents(*rows, (900, "none of them")), model), "evidence", "score")
    assert got.pop(900) == ([], model.blank_rate)
    vectors = {i: dict(zip(*model.vector(model.counts(t)), strict=True)) for i, t in rows}
    for i in text_of:
        cosine = {j: sum(x * vectors[j].get(w, 0) for w, x in vectors[i].items()) for j, _ in learned}
        assert np.allclose([cosine[j] for j in got[i][0]], sorted(cosine.values())[::-1][:3])


@pytest.mark.parametrize("dense", [0, 20, 512])
def test_rare_and_frequent_words_together_equal_brute_force(monkeypatch, dense):
    monkeypatch.setattr(toxicity, "DENSE", dense)
    r = random.Random(7)
    words, n = {f"w{i}": i for i in range(400)}, 1000
    model = toxicity.Model(words, np.linspace(1, 9, 400), 0.1, 0.0, np.arange(n), np.ones(n), np.zeros(n))
    some = [{int(400 * r.random() ** 3): r.randint(1, 4) for _ in range(r.randint(1, 40))} for _ in range(n)]
    vectors = [model.vector(c) for c in some]
    model.index(vectors)
    matrix = np.zeros((n, 400))
    for row, (at, x) in zip(matrix, vectors, strict=True):
        row[at] = x
    for (at, x), (found, cosine) in zip(vectors[:90], model.nearest_of(vectors[:90], 9), strict=True):
        every = matrix[:, at] @ x
        assert np.allclose(cosine, np.sort(every)[::-1][:9]) and np.allclose(every[found], cosine)


def test_words_of_a_batch_are_counted_together_as_alone(monkeypatch):
    words = {w: i for i, w in enumerate(sorted(set(prose(3, 40).split())))}
    texts = [prose(3, 60), "", "none of them", "Nasty " + prose(3, 9).upper(), "", prose(4, 50)]
    wanted = [Counter(words[w] for w in toxicity.words_of(t) if w in words) for t in texts]
    ends, at, n = toxicity.known_counts(texts, words)
    got = [dict(zip(at[a:b].tolist(), n[a:b].tolist(), strict=True)) for a, b in zip(ends, ends[1:])]
    assert got == wanted and any(got) and all(list(g) == sorted(g) for g in got)
    assert [x.tolist() for x in toxicity.known_counts(["a b"], {})] == [[0, 0], [], []]
    assert [x.tolist() for x in toxicity.known_counts([], words)] == [[0], [], []]

    class Known:
        value = toxicity.Model(words, np.linspace(1, 3, len(words)), 0.1, 0.25, np.arange(2), np.ones(2), np.array([0.0, 1]))

    Known.value.index([Known.value.vector(c) for c in (wanted[0], wanted[5] or wanted[3])])
    # a text's words are not looked up one text at a time
    monkeypatch.setattr(toxicity.Model, "counts", None)
    ids = pa.array(range(len(texts)))
    batch = pa.record_batch({"id": ids, "held_out": pa.array([False] * len(texts)), "text": texts})
    (out,) = toxicity._scored(Known)(batch)
    scores = out.column("score").to_pylist()
    assert scores[1] == scores[2] == scores[4] == 0.25 and scores[0] != 0.25 and out.column("evidence")[0].as_py()[0] == 0


# --- shingles ------------------------------------------------------------------


def components_by_hand(rows):
    sets = {i: set(shingle_join.shingles(t or "").tolist()) for i, t in rows}
    least = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a != b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and least[a] > least[b]:
                    least[a], changed = least[b], True
    return {i: (len(s), least[i]) for i, s in sets.items()}


def edited(text, seed, edits):
    words, r = text.split(), random.Random(seed)
    for _ in range(edits):
        words[r.randrange(len(words))] = f"e{r.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("tile", [shingle_join.TILE, 4])
def test_shingle_join_loses_no_link(documents, monkeypatch, tile):
    monkeypatch.setattr(shingle_join, "TILE", tile)
    rows, i = [], 0
    for base in range(12):
        text = prose(base, [8, 40, 70, 90, 200, 400][base % 6])
        for copy in range(8):
            rows.append((i, edited(text, i, copy * len(text.split()) // 60)))
            i += 1
    passage = prose(99, 60)
    rows += [(1000 + k, f"{prose(500 + k, 40)} {passage} {prose(600 + k, 40)}") for k in range(6)]
    rows += [(2000, None), (2001, ""), (2002, "one two"), (2003, "ONE two"), (2004, "a b c d e")]
    got = by_id(shingle_join.shingle_components(documents(*rows)), "n_shingles", "component_id")
    assert got == components_by_hand(rows)


def test_shingle_join_compares_all_that_large_families_leave_apart(documents, monkeypatch):
    monkeypatch.setattr(shingle_join, "TILE", 4)
    monkeypatch.setattr(shingle_join, "GUESTS", 0)
    rows, i = [], 0
    passage = prose(7, 30)
    for base in range(6):
        text = f"{prose(base, 40)} {passage}"
        for copy in range([14, 9, 5, 2, 1, 1][base]):
            rows.append((i, edited(text, i, copy % 3)))
            i += 1
    rows += [(i, rows[0][1]), (i + 1, rows[20][1])]
    got = by_id(shingle_join.shingle_components(documents(*rows)), "n_shingles", "component_id")
    assert got == components_by_hand(rows)


def test_shingle_join_deals_unequal_labels_to_common_tiles(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "TILE", 4)
    labels = {1: [7] * 40 + [100 + k for k in range(6)], 2: [8, 8, 9], 3: [k for k in range(10) for _ in range(3)]}
    rows = [(1000 * f + k, 0, 1.0, label, f) for f, ls in labels.items() for k, label in enumerate(ls)]
    left = spark.createDataFrame(rows, "id long, row long, weight double, label long, family long")
    tiles = {}
    for r in shingle_join._open_tiles(left).collect():
        for t in r["tiles"]:
            tiles.setdefault((r["family"], t["number"]), {True: [], False: []})[t["guest"]].append((r["id"], r["label"]))
    met = set()
    for tile in tiles.values():
        met |= {frozenset((a, b)) for a, x in tile[True] or tile[False] for b, y in tile[False] if x != y}
    wanted = {frozenset((a[0], b[0])) for a in rows for b in rows if a[4] == b[4] and a[3] != b[3]}
    assert met == wanted
    guests = Counter(f for (f, _), tile in tiles.items() for _ in tile[True])
    # only what lies beyond the largest group goes to all 12 and 8 parts
    assert guests == {1: 6 * 12, 3: 27 * 8}


def test_tile_links_of_guests_with_the_others_only():
    a = np.arange(100, dtype=np.uint64)
    sets = [a, a[:95], a[:90], a[:85]]
    guest = np.array([False, False, True, True])
    pairs = shingle_join.tile_links(sets, np.ones(4), np.array([0, 0, 1, 2]), guest)
    assert {guest[i] for i, _ in pairs} == {True} and {guest[j] for _, j in pairs} == {False}
    assert {i for i, _ in pairs} == {2, 3}


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    found = {}
    for folder in folders:
        for d, _, names in os.walk(folder.getPath()):
            found |= {n: os.path.getsize(f"{d}/{n}") for n in names if n.startswith("shuffle_") and n.endswith(".data")}
    return found


@pytest.mark.parametrize("stage", [False, True])
def test_shingle_join_leaves_no_shuffled_text_on_disk(spark, documents, stage):
    docs = documents(*[(i, prose(i // 2, 300)) for i in range(300)]).repartition(4).checkpoint()
    before = shuffle_files(spark)
    found = corpus_pipeline.near_copies(spark, docs, "") if stage else shingle_join.shingle_components(docs)
    left = 0
    for _ in range(20):  # files go in the background
        left = sum(size for name, size in shuffle_files(spark).items() if name not in before)
        if left < 50_000:
            break
        time.sleep(0.5)
    assert left < 50_000
    assert found.count() == (150 if stage else 300)


def test_durable_frees_shuffles_and_keeps_the_setting(spark):
    df = spark.range(1000).repartition(4)
    setting = spark.conf.get(FREES, None)
    before = shuffle_files(spark)
    stored = durable(df, free=True)
    for _ in range(20):
        if not (left := set(shuffle_files(spark)) - set(before)):
            break
        time.sleep(0.5)
    assert not left and stored.count() == 1000 and df.count() == 1000
    assert spark.conf.get(FREES, None) == setting


def test_shingle_join_of_odd_ids_and_nothing(documents):
    rows = shingle_join.shingle_components(documents((None, "a b"), (5, "a b"), (5, "q r"), (6, "q r"))).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in rows) == [(0, 0), (5, 5), (5, 5), (6, 5)]
    assert shingle_join.shingle_components(documents((1, "a")).limit(0)).count() == 0


# --- repeats -------------------------------------------------------------------


def removed_by_hand(rows, length=50):
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        for s in range(len(data) - length + 1):
            w = data[s : s + length]
            first[w] = min(i, first.get(w, i))
    out = {}
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for s in range(len(data) - length + 1):
            if first[data[s : s + length]] < i:
                gone[s : s + length] = True
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        spans = int((gone[1:] < gone[:-1]).sum())
        out[i] = (len(data), int(gone.sum()), spans, sha256(kept).hexdigest())
    return out


def test_suffix_dedup(documents):
    shared = [prose(s, 14) for s in range(4)]
    rows = [(i, f"{prose(50 + i, 9)} {shared[i % 4]} {prose(90 + i, 5)} {shared[(i * 7) % 4]}") for i in range(30)]
    rows += [(40, "=" * 120), (41, "=" * 300), (42, None), (43, ""), (44, "é" * 80), (45, "è" * 80), (46, rows[3][1])]
    got = by_id(suffix_dedup.suffix_dedup(documents(*rows)), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == removed_by_hand(rows)
    kept = suffix_dedup.drop_repeats(documents(*rows))
    assert kept.columns == documents(*rows).columns
    assert {r["doc_id"]: r["text"] for r in kept.collect()}[46] == ""
    assert suffix_dedup.suffix_dedup(documents((1, "a")).limit(0)).count() == 0


def test_windows_of_a_heavy_token_are_dealt_by_all_their_bytes(documents, monkeypatch):
    passage = prose(1, 40)
    rows = [(i, f"{prose(200 + i, 9)} {passage} {prose(400 + i, 9)}") for i in range(60)]
    data = [t.encode() for _, t in rows]
    docs = pa.table({"id": [i for i, _ in rows], "text": [t for _, t in rows]})
    tokens = np.unique(suffix_dedup.window_runs(passage.encode())[2])
    reply = (tokens << np.uint64(suffix_dedup.LOW) | np.uint64(60)).tobytes()

    def most_of_a_key(heavy):
        group = suffix_dedup.Contexts(docs, [reply], 50, heavy)
        places = zip(group.text.tolist(), group.first.tolist(), group.windows.tolist())
        windows = {data[t][f + s : f + s + 50] for t, f, w in places for s in range(w)}
        assert windows == {c[s : s + 50] for c in group.order for s in range(len(c) - 49)}
        return Counter(group.token.tolist()).most_common(1)[0][1]

    assert most_of_a_key(61) > 40 and most_of_a_key(60) == 1
    monkeypatch.setattr(suffix_dedup, "HEAVY", 10)
    got = by_id(suffix_dedup.suffix_dedup(documents(*rows)), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == removed_by_hand(rows)


def test_runs_of_many_texts_are_those_of_each(monkeypatch):
    texts = [prose(s, n).encode() for s, n in enumerate([0, 5, 9, 400, 60, 1, 3000, 12, 12])] + [b"=" * 49, b"=" * 50]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1000)
    got = list(zip(*(x.tolist() for x in suffix_dedup.runs_of(texts)), strict=True))
    each = [(i, *run) for i, t in enumerate(texts) for run in zip(*(x.tolist() for x in suffix_dedup.window_runs(t)), strict=True)]
    assert sorted(got) == each and {i for i, *_ in got} == {2, 3, 4, 6, 7, 8, 10}
    assert [len(x) for x in suffix_dedup.runs_of([])] == [0, 0, 0, 0]


def test_contexts_have_the_same_numbers_in_any_order_of_rows():
    texts = [prose(s % 5, 20) for s in range(12)] + ["", prose(1, 20)]
    rows = list(zip([3, 1, None, 7, 7, 5, 9, 2, 8, 8, 4, 6, 11, None], texts, strict=True))
    tokens = np.unique(np.concatenate([suffix_dedup.window_runs(t.encode())[2] for _, t in rows]))
    reply = (tokens << np.uint64(suffix_dedup.LOW) | np.uint64(2)).tobytes()

    def group(rows):
        docs = pa.table({"id": pa.array([i for i, _ in rows], pa.int64()), "text": [t for _, t in rows]})
        return suffix_dedup.Contexts(docs, [reply], 50, 100)

    one, other = group(rows), group(rows[::-1])
    assert one.order == other.order and (one.owner == other.owner).all() and (one.token == other.token).all()
    by_hand = {}
    for t, f, w, n in zip(one.text.tolist(), one.first.tolist(), one.windows.tolist(), one.number.tolist(), strict=True):
        context = rows[t][1].encode()[f : f + w + 49]
        assert one.order[n] == context
        id_ = suffix_dedup._LEAST if rows[t][0] is None else rows[t][0]
        by_hand[n] = min(id_, by_hand.get(n, id_))
    assert one.owner.tolist() == [by_hand[n] for n in range(len(one.order))]


def test_span_codes_need_memory_of_a_block(monkeypatch):
    text = np.random.default_rng(4).integers(1, 5, 1 << 21).astype(np.int16)
    starts = np.arange(5, len(text) - 1, 997)
    text[starts[7] : starts[9]] = text[starts[2] : starts[4]]
    text[starts[9]] = text[starts[4]]
    tracemalloc.start()
    codes = induced._span_codes(text, starts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * len(text)
    monkeypatch.setattr(induced, "BLOCK", 1 << 22)
    assert (codes == induced._span_codes(text, starts)).all() and codes[7] == codes[2] and len(set(codes)) > 2000


def test_induced_order_spills_and_sorts(tmp_path, monkeypatch):
    monkeypatch.setattr(induced, "HELD", 50)
    monkeypatch.setattr(induced, "BLOCK", 40)
    r = random.Random(3)
    for _ in range(25):
        parts = [bytes(r.choice(b"abc") for _ in range(r.randint(0, 60))) for _ in range(r.randint(1, 8))]
        parts += parts[:2] * r.randint(0, 1)
        text = np.concatenate([np.append(np.frombuffer(p, np.uint8).astype(np.int16) + 1, 0) for p in parts])
        got = np.concatenate(list(induced.suffix_order(text, 50, str(tmp_path))))[::-1]
        keys = [tuple(text[i : i + 50].tolist()) for i in got]
        assert sorted(got.tolist()) == list(range(len(text))) and keys == sorted(keys)
        assert not list(tmp_path.iterdir())


# --- pieces --------------------------------------------------------------------


def test_pieces_are_those_of_the_library(documents):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(i, prose(i, 20 * i) + " The\n mixed Straße") for i in range(8)]
    rows += [(20, None), (21, ""), (22, "  a  b\n c\t é ▁x 日 "), (23, "longword" * 300), (24, " ")]
    table = pieces.piece_table()
    assert table.model_type == pieces.BPE
    encoded = pieces.encode(documents(*rows), table, frequent=200)
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in encoded.collect()}
    assert got == {i: library.encode(t or "") for i, t in rows}
    back = by_id(pieces.decode(encoded, table), "text")
    assert back == {i: ((t or "").replace("▁", " "),) for i, t in rows}


def test_viterbi_is_that_of_a_unigram_model(spark):
    import public_tokenizers
    import sentencepiece

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        data = file.read()
    at = data.rindex(b"tok_v0\x18\x02")
    library = sentencepiece.SentencePieceProcessor(model_proto=data[:at] + b"tok_v0\x18\x01" + data[at + 8 :])
    table = pieces.piece_table(model_type=pieces.UNIGRAM)
    words = sorted({"▁" + w for w in prose(1, 60).split()} | {"▁house", "▁Straße", "▁thandering"})
    rows = pieces.segmented(spark.createDataFrame([(w,) for w in words], "word string"), table).collect()
    assert len(rows) == len(words)
    for r in rows:
        score = sum(table.pieces[library.id_to_piece(i)][1] for i in r["best"])
        wanted = library.encode(r["word"][1:])
        assert score == sum(table.pieces[library.id_to_piece(i)][1] for i in wanted)
        assert r["ids"] == r["best"] == pieces.best_path(r["word"], table)


@pytest.mark.parametrize("model_type", [pieces.UNIGRAM, pieces.BPE])
def test_words_of_a_batch_are_folded_together_as_alone(monkeypatch, model_type):
    table = pieces.piece_table(model_type=model_type)
    r = random.Random(3)
    some = {"".join(r.choice("▁aeinsth.é日🎉\n") for _ in range(r.randint(1, 40))) for _ in range(600)}
    some |= {c * n for c in "aet▁" for n in range(1, 41)} | {"▁" + w for w in prose(4, 80).split()}
    some = sorted(some)
    plain = [(pieces.best_path(w, table), pieces.merged(w, table)) for w in some]
    alone = []
    for name in ("best_path", "merged"):
        fold = getattr(pieces, name)
        monkeypatch.setattr(pieces, name, lambda w, t, fold=fold: alone.append(w) or fold(w, t))
    words = pieces._Words({}, table)
    numbers = words.numbers([some[:300], [], ["x" * 41], some[200:]])
    assert set(alone) == {"x" * 41} and len(set(numbers.tolist())) == len(some) + 1
    given = plain[:300] + [(pieces.best_path("x" * 41, table), pieces.merged("x" * 41, table))] + plain[200:]
    best, ends = words.best.joined(numbers)
    assert [best[a:b].tolist() for a, b in zip(ends, ends[1:])] == [b for b, _ in given]
    if model_type == pieces.BPE:
        ids, ends = words.ids.joined(numbers)
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [i for _, i in given]


def test_words_beyond_those_remembered_are_folded_again(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    table = pieces.piece_table()
    words = pieces._Words({"▁the": (b"\1\0\0\0", b"\2\0\0\0")}, table)
    for split in ([["▁the", "▁house", "▁of"]], [["▁cards", "▁of", "▁the", "▁old"]], [["▁house", "▁the"]], [[]]):
        numbers = words.numbers(split)
        ids, ends = words.ids.joined(numbers)
        wanted = [[2] if w == "▁the" else pieces.merged(w, table) for w in split[0]]
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == wanted
    assert len(words.number) == len(words.ids.sizes) == 2


# --- pipeline ------------------------------------------------------------------


def test_pipeline_stages_keep_what_brute_force_keeps(spark, documents):
    stages = dict(corpus_pipeline.STAGES)
    passage = prose(70, 14)
    rows = [(i, f"{prose(i, 40)} {passage if i % 3 == 0 else ''} {prose(300 + i, 20)}") for i in range(12)]
    rows += [(20, rows[1][1].upper()), (21, rows[2][1]), (22, rows[4][1] + " tail"), (23, edited(rows[5][1], 1, 2))]
    kept = stages["exact_dedup"](spark, documents(*rows), "")
    texts = {}
    for i, text in rows:
        texts[lower(text)] = max(i, texts.get(lower(text), i))
    left = [(i, t) for i, t in rows if texts[lower(t)] == i]
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == left
    kept = stages["near_dedup"](spark, documents(*left), "")
    least = components_by_hand(left)
    near = [(i, t) for i, t in left if least[i][1] == i]
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == near and len(near) < len(left) < len(rows)
    kept = stages["suffix_dedup"](spark, documents(*near), "")
    by_hand = removed_by_hand(near)
    got = {r["doc_id"]: sha256(r["text"].encode()).hexdigest() for r in kept.collect()}
    assert got == {i: x[3] for i, x in by_hand.items()} and any(x[1] for x in by_hand.values())


# --- quality -------------------------------------------------------------------


def test_quality_rules(documents):
    rows = [(i, prose(i, 80)) for i in range(130)]
    rows += [(200, None), (201, ""), (202, "a b c"), (203, " ".join(f"w{i}### x{i}***" for i in range(60)))]
    rows += [(204, "x y z " * 40), (205, "\n".join([prose(7, 12)] * 2 + [prose(i, 12) for i in range(6)]))]
    got = by_id(quality.quality_rules(documents(*rows)), "n_words", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert all(got[i][3:] == (False, True) for i in range(130))
    assert [got[i][3:] for i in (200, 201, 202, 204)] == [(True, False)] * 4
    assert got[203][3:] == (False, False) and got[204][2] == 120 and got[205][1:3] == (1, 24)
    assert quality.quality_rules(documents((1, "a")).limit(0)).count() == 0
