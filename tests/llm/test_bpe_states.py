"""The automaton against merging by rank, over words of any kind."""

import random

import pytest

from quorumdf.llm import bpe


def merge_by_rank(word, vocab, merges):
    parts, ranks = [bytes([b]) for b in word], {m: r for r, m in reversed(list(enumerate(merges)))}
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        if not found:
            return [vocab[p] for p in parts]
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(6))
def test_random_merges(seed):
    rnd = random.Random(seed)
    letters = [bytes([c]) for c in b"abcd"[: 2 + seed % 3]]
    vocab, merges = {x: i for i, x in enumerate(letters)}, []
    while len(merges) < 25:
        a, b = rnd.choice(list(vocab)), rnd.choice(list(vocab))
        if a + b not in vocab and len(a + b) <= 9:
            vocab[a + b] = len(vocab)
            merges.append((a, b))
    machine = bpe.MergeAutomaton(vocab, merges)
    for _ in range(1500):
        word = b"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 24)))
        assert machine.encode_word(word) == merge_by_rank(word, vocab, merges), word


def test_very_long_words_and_clashing_columns(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rnd = random.Random(1)
    texts = ["x" * 30_000, "".join(rnd.choice("abcdefgh0123") for _ in range(20_000)), "=" * 5000, None, ""]
    docs = spark.createDataFrame([(1, t) for t in texts], "doc_id long, text string").selectExpr("*", "'a' as ids", "2 as n_tokens", "3 as decoded")
    got = sorted((r.n_tokens, r.decoded) for r in bpe.encode_documents(docs).collect())
    assert got == sorted((len(library.encode(t or "", add_special_tokens=False).ids), t or "") for t in texts)
