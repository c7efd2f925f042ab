"""Words whose polynomial hashes modulo 2**64 agree must not be taken for one, by op1 nor by op9."""

import random

import numpy as np
import pytest

from quorumdf.llm import lm_scoring, ngram_join as N


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


def complement(w):
    return w.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [8, 64, 128, 1024, 4096])
def test_word_hashes_differ(n):
    w, v = thue_morse(n), complement(thue_morse(n))
    assert N.shingle_sets([w])[0][0] != N.shingle_sets([v])[0][0]
    a = lm_scoring.tokens([w, v])[0]
    assert a[0] != a[1]
    assert N.shingle_sets(["x y " + w + " z u"])[0][0] == N.shingle_sets(["  X  Y\t" + w.upper() + "\nz U "])[0][0]


def test_many_words_have_many_hashes():
    rnd = random.Random(1)
    words = sorted({"".join(rnd.choice("abAB0é") for _ in range(rnd.choice([1, 5, 63, 64, 65, 130]))) for _ in range(4000)})
    assert len(set(lm_scoring.tokens([" ".join(words)])[0].tolist())) == len(words)
    lower = sorted({w.translate(str.maketrans("AB", "ab")) for w in words})
    assert len(N.shingle_sets(lower)[0]) == len(lower)


@pytest.mark.parametrize("n", [1024, 4096])
def test_unlike_documents_of_like_hashes_do_not_link(spark, n):
    w, v = thue_morse(n), complement(thue_morse(n))
    tail = " one two three four five six seven eight"
    docs = spark.createDataFrame([(1, w), (2, v), (3, w + tail), (4, v + tail), (5, (w + " ") * 9), (6, (v + " ") * 9), (7, w)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in N.ngram_jaccard_join(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 1}


def plain(a, b):
    def shingles(t):
        w = N.lowered(t).split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    x, y = shingles(a), shingles(b)
    return bool(x and y) and 100 * len(x & y) >= 75 * len(x | y)


def test_verification_equals_sets_of_words():
    rnd = random.Random(2)
    for _ in range(600):
        n = rnd.choice([0, 1, 2, 3, 4, 5, 6, 9, 40, 200])
        words = [rnd.choice("a B c dd é".split()) + str(rnd.randint(0, 6 * n)) for _ in range(n)]
        other = [w if rnd.random() > 0.02 else "x" for w in words] + ["y"] * rnd.choice([0, 0, 1])
        a, b = " ".join(words), "\n".join(other)
        v = N.Vocabulary()
        if rnd.random() < 0.3:
            v.known = {b"!%d" % i: i for i in range(10_000)}  # so many words that a shingle no longer fits one number
        assert v.linked(v.numbers(a), v.numbers(b)) == plain(a, b)


def test_large_vocabularies_are_ranked():
    v = N.Vocabulary()
    v.known = {str(i).encode(): i for i in range(300_000)}
    text = " ".join(str(i * 7919 % 300_000) for i in range(5000))
    assert v.linked(v.numbers(text), v.numbers(text + " 1"))
    assert not v.linked(v.numbers(text), v.numbers(" ".join(reversed(text.split()))))


def test_very_long_text_is_read_whole(spark):
    words = [f"w{i}" for i in range(60_000)]
    a, b, c = " ".join(words), " ".join(words[:-5000] + ["x"] * 5000), " ".join(words[:-5000] + [f"v{i}" for i in range(25_000)])
    docs = spark.createDataFrame([(1, a, "n"), (2, b, "n"), (3, c, "n")], "doc_id long, text string, n_shingles string").withColumnsRenamed({"n_shingles": "component_id"})
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.ngram_jaccard_join(docs).collect()}
    assert got == {1: (59_996, 1), 2: (55_001, 1), 3: (79_996, 3)}
