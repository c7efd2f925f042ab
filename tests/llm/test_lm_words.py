"""op9 over words, against a dictionary model of the other documents."""

import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import regex

from quorumdf.llm import lm_scoring

DOCS = "doc_id long, text string"
UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
TOKEN = regex.compile(rf"(?V1)[{UNSPACED}]|[[\p{{L}}\p{{M}}\p{{N}}_]--[{UNSPACED}]]+|\S")


def brute(rows, good):
    split = [(i, TOKEN.findall(t or "")) for i, t in rows]
    size = len({w for _, words in split for w in words} | {"</s>"})

    def model(texts):
        hit, history = Counter(), Counter()
        for words in filter(None, texts):
            marks = ["<s>"] * 4 + words + ["</s>"]
            for at in range(4, len(marks)):
                for k in range(1, 5):
                    hit[tuple(marks[at - k + 1 : at + 1])] += 1
                    history[k, tuple(marks[at - k + 1 : at])] += 1
        return hit, history

    def loss(words, counts):
        if not words:
            return 0.0
        hit, history = counts
        marks, total = ["<s>"] * 4 + words, 0.0
        for at in range(4, len(marks)):
            p = lm_scoring.MIX[-1] / size
            for k, weight in zip((4, 3, 2, 1), lm_scoring.MIX):
                seen = history[k, tuple(marks[at - k + 1 : at])]
                p += weight * (hit[tuple(marks[at - k + 1 : at + 1])] / seen if seen else 1 / size)
            total -= math.log(p)
        return total / len(words)

    out = []
    for n, (i, words) in enumerate(split):
        background = loss(words, model([w for m, (_, w) in enumerate(split) if m != n]))
        chosen = any(w for j, w in split if j in good)
        target = loss(words, model([w for m, (j, w) in enumerate(split) if m != n and j in good])) if chosen else background
        out.append((i is None, i or 0, len(words), round(target, 8), round(background, 8)))
    return sorted(out)


def made(n=40):
    rnd = random.Random(n)
    return [(100 + i, " ".join(rnd.choice(["a", "b", "c", "d.", "e"]) for _ in range(rnd.randint(1, 30)))) for i in range(n)]


ROWS = [
    (1, "the cat sat on the mat. The cat!"), (2, "the dog sat on the mat"), (2, "the dog sat on the mat"), (3, None), (4, " \n\t"), (5, ""),
    (None, "no id here"), (6, "日本語の文 été naïve x_1퟿"), (7, "cat the mat the on sat"), ((1 << 53) + 1, "a"), (8, "word " * 400), *made(),
]


@pytest.mark.parametrize("good", [{1, 2, (1 << 53) + 1, 100, 101, 107}, {7}, set()])
def test_scores_equal_brute_force(spark, good):
    marks = spark.createDataFrame([(i,) for i in good] + [(None,)], "doc_id long")
    docs = spark.createDataFrame(ROWS, DOCS).selectExpr("*", "'x' as block", "1 as id", "true as is_mark")
    got = lm_scoring.score_documents(docs, marks, parts=5).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_symbols, round(r.target_loss, 8), round(r.background_loss, 8)) for r in got) == brute(ROWS, good)


def test_empty_and_lonely_tables(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert lm_scoring.score_documents(spark.createDataFrame([], DOCS), none, parts=2).count() == 0
    got = lm_scoring.score_documents(spark.createDataFrame([(1, "a b a")], DOCS), none, parts=2).first()
    assert got.score == 0 and round(got.background_loss, 9) == round(math.log(3), 9)


def test_tokens_are_those_of_the_pattern():
    rnd = random.Random(3)
    odd = "".join(chr(c) for c in (*range(0x20, 0x250), 0xA0, 0x2028, 0x3000, 0x4E00, 0x3042, 0x30A2, 0xE01, 0x301, 0x200D, 0x1F600, 0x20000, 0x10FFFF, 0xFEFF))
    texts = ["".join(rnd.choice(odd) for _ in range(200)) for _ in range(200)] + ["", " ", odd]
    hashes, sizes = lm_scoring.tokens(texts)
    want = [w for t in texts for w in TOKEN.findall(t)]
    assert sizes.tolist() == [len(TOKEN.findall(t)) for t in texts]
    assert len({*zip(hashes.tolist(), want)}) == len(set(hashes.tolist())) == len(set(want))


def test_copies_stand_apart(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join(f"w{rnd.randint(0, 60)}" for _ in range(80))) for i in range(40)]
    rows += [(50 + i, rows[i][1]) for i in range(8)]
    got = {r.doc_id: r.background_loss for r in lm_scoring.score_documents(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(1,)], "doc_id long")).collect()}
    assert max(got[i] for i in range(8)) < min(got[i] for i in range(8, 40)) / 2


def test_op9_tells_words_of_one_byte_class_apart(spark, tmp_path):
    """Capitals A to E were one symbol; so the two kinds of documents scored alike."""
    rows = [(i, ("ABE CAB " if i < 10 else "BAD DEC ") * 5) for i in range(20)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(5)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r.score for r in lm_scoring.op9_lm_scoring(spark, str(tmp_path)).collect()}
    assert max(got[i] for i in range(10)) < min(got[i] for i in range(10, 20))


def test_places_of_equal_hashes_rise_whatever_their_last_bits():
    rnd = np.random.default_rng(3)
    many = rnd.integers(0, 1 << lm_scoring.BITS, 3000).astype(np.uint64)
    near = (np.uint64(1 << 40) + rnd.integers(0, 8, 3000).astype(np.uint64)).astype(np.uint64)  # unlike ones differ in the bits that a place takes
    for hashes in (many, near, np.r_[many, many], many[:1], many[:0]):
        s, order = lm_scoring.in_order(hashes)
        want = np.argsort(hashes, kind="stable")
        assert (order == want).all() and (s == hashes[want]).all()


def test_tokens_cross_the_pieces_that_are_hashed(monkeypatch):
    texts = ["one two  three", "", "supercalifragilistic 漢字 x" * 9, "two"]
    whole, sizes = lm_scoring.tokens(texts)
    for piece in (1, 3, 7):
        monkeypatch.setattr(lm_scoring, "CACHED", piece)
        got, n = lm_scoring.tokens(texts)
        assert (got == whole).all() and (n == sizes).all()


def test_a_token_is_the_same_at_every_place():
    """Tokens are hashed by 8 bytes at a time, wherever these begin."""
    words = [c * n + e for c in ("a", "é", "ﬁ", "𐐀") for n in (1, 2, 3, 7, 8, 9, 15, 16, 17, 33, 300) for e in ("", "b", "ж")]
    words += ["x" * n + c + "y" * (20 - n) for n in range(21) for c in ("z", "ß")] + ["漢", "€", "😀", "\ud800", "a\u0301"]
    words = sorted(set(words))
    first, sizes = lm_scoring.tokens([" ".join(words)])
    assert sizes.tolist() == [len(words)] and len(set(first.tolist())) == len(words)
    for before in range(1, 9):
        again, sizes = lm_scoring.tokens(["." * before, *words, ""])
        assert sizes.tolist() == [before, *[1] * len(words), 0] and (again[before:] == first).all()
    assert [len(a) for a in lm_scoring.tokens([])] == [0, 0]


def test_hashes_less_than_their_bucket_keep_all_their_bits():
    rnd = np.random.default_rng(5)
    for buckets in (1, 2, 5, 8, 100):
        top = (1 << lm_scoring.BITS) // buckets + 1 - (buckets & (buckets - 1) == 0)
        hashes = np.r_[rnd.integers(0, top, 5000), [top - 1, 0, top - 1, 0]].astype(np.uint64)
        s, order = lm_scoring.in_order(hashes, buckets)
        want = np.argsort(hashes, kind="stable")
        assert (order == want).all() and (s == hashes[want]).all()


def test_a_round_orders_the_places_that_it_needs(monkeypatch):
    """Every round put the places of all shorter n-grams in order, with their counts in both models."""
    parts, rows, sorts = 3, {}, []
    for b in range(parts):
        docs = [(str(i), False, t) for i, t in made() if i % parts == b] + [("100", True, "")]
        batch = pa.RecordBatch.from_pylist([{"block": b, "id": i, "is_mark": m, "text": t} for i, m, t in docs], pa.schema([("block", pa.int32()), ("id", pa.string()), ("is_mark", pa.bool_()), ("text", pa.string())]))
        rows[b] = pa.Table.from_batches(lm_scoring._packed([batch])).to_pandas()
    plain = lm_scoring.in_order
    monkeypatch.setattr(lm_scoring, "in_order", lambda h, *a: sorts.append(len(h)) or plain(h, *a))
    places = {b: len(lm_scoring._block(r, 1)[0].text) for b, r in rows.items()}
    sent = pd.concat([lm_scoring._send_short(parts)((b,), r) for b, r in rows.items()])
    assert not sorts  # counts need no places
    answers = pd.concat([lm_scoring._add(2, parts)((k,), g) for k, g in sent.groupby("bucket")]).assign(round=1)
    for b, r in rows.items():
        sorts.clear()
        lm_scoring._send_long(parts, 3)((b,), r, answers[answers.block == b])
        assert sorts == [places[b]]  # those of bigrams
