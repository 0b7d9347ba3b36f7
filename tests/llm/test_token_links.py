"""Links of two tokenizers against a plain loop over byte ends."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from evenframe.llm import token_links
from tokenizers import Tokenizer

COLUMNS = "doc_id long, text string, pairs string, batch long, n int"
WORDS = "the of and reinterpretation naïve Straße 3.14 x=y; <|endoftext|> 😀 日本語 a\tb c\n\nd e  f".split(" ")


def by_hand(rows):
    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte_of = token_links._byte_of()

    def ends(parts):
        return np.cumsum([len(p) for p in parts]).tolist()

    found, held = {}, Counter()
    for i, text in rows:
        found[i] = (0, 0, 0, [], "")
        if not text:
            continue
        a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
        a_bytes = [bytes(byte_of[c] for c in a_side.id_to_token(x)) for x in a]
        b_bytes = [bytes([int(b_side.id_to_piece(x)[3:5], 16)]) if b_side.is_byte(x) else b_side.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            continue
        cuts = sorted(set(ends(a_bytes)) & set(ends(b_bytes)))
        groups = [
            ([x for x, e in zip(a, ends(a_bytes)) if low < e <= high], [x for x, e in zip(b, ends(b_bytes)) if low < e <= high])
            for low, high in zip([0, *cuts], cuts)
        ]
        links = [(x, y) for p, q in groups for x in p for y in q]
        spelled = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        found[i] = (len(a), len(b), len(groups), links, sha256(spelled.encode()).hexdigest())
        held.update(set(links))
    top = Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return {
        i: (a, b, g, len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), digest)
        for i, (a, b, g, links, digest) in found.items()
    }


@pytest.fixture
def cases():
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(WORDS) for _ in range(r.randint(1, 40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " "), (103, "a ▁ b"), (104, " lead"), (105, "trail "), (106, "\x00\x1f\x7f\xa0\x85")]
    rows += [(107, "the of " * 5000), (108, "zq" * 4000), (109, " " * 3000), (110, rows[0][1]), (111, "日本" * 500), (112, "-" * 900)]
    return rows


def test_token_links(spark, cases):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in cases], COLUMNS).repartition(3)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {r["doc_id"]: tuple(r[c] for c in names) for r in token_links.token_links(docs).collect()}
    assert got == by_hand(cases)
    assert token_links.token_links(docs.limit(0)).count() == 0


def test_rows_of_one_id_count_each(spark):
    docs = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "one two")], "doc_id long, text string")
    rows = token_links.token_links(docs).collect()
    assert [r["count_sum"] for r in rows] == [3 * rows[0]["n_links"]] * 3


def test_aligned_groups_spell_the_same_bytes(spark, cases):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in cases], COLUMNS)
    sides = token_links.Tokenizers()
    texts = dict(cases)
    for row in token_links.aligned(docs).collect():
        whole = b""
        edges = list(zip([0, *row["stops_a"]], row["stops_a"], [0, *row["stops_b"]], row["stops_b"]))
        for a, a_stop, b, b_stop in edges:
            part = b"".join(sides.bytes_a[i] for i in row["ids_a"][a:a_stop])
            assert part == b"".join(sides.bytes_b[i] for i in row["ids_b"][b:b_stop])
            whole += part
        assert whole == (f" {texts[row['doc_id']]}".encode() if edges else b"")


def test_lanes_do_not_change_groups():
    r = np.random.default_rng(1)
    for _ in range(30):
        size = int(r.integers(1, 20_000))
        ends = [np.unique(np.append(r.integers(1, size + 1, size // k), size)) for k in (2, 3)]
        zero = np.zeros(1, np.int64)
        one = token_links.lockstep(*ends, zero, zero)
        starts = token_links.lanes(*ends, zero, zero)
        assert np.array_equal(one, token_links.lockstep(*ends, *starts))
        assert len(starts[0]) == len(starts[1])
        assert np.array_equal(ends[0][one[0] + one[2] - 1], np.intersect1d(*ends))
