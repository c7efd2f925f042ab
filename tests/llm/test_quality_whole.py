"""Scores that depend on nothing but the text, against a plain convolution of each text alone."""

import random

import numpy as np
import pytest

from quorumdf.llm import quality_cnn as Q


def brute_score(net, text):
    """The same network by loops over the windows of one text."""
    data = np.frombuffer(text + b"\0" * (-len(text) % Q.STEP + 2 * Q.STEP), np.uint8)
    x = np.zeros((len(data), Q.CHANNELS))
    for i, b in enumerate(data):
        x[i, : Q.EMBED] = net.embed[b]
        for c, lag in enumerate(Q.LAGS):
            x[i, Q.EMBED + c] = i >= lag and b == data[i - lag] and b != 0
    tops = [x[at : at + 2 * Q.STEP].ravel() @ net.filters.T.astype(np.float64) for at in range(0, len(data) - Q.STEP, Q.STEP)]
    z = np.maximum(np.max(tops, axis=0) + net.bias, 0) @ net.out + net.out_bias[0]
    return 1 / (1 + np.exp(-z))


def texts(seed=1, n=60):
    rnd = random.Random(seed)
    return [bytes(rnd.choice(b"abc de\n") for _ in range(rnd.choice([0, 1, 7, 8, 9, 16, 17, 100, 700]))) for _ in range(n)]


@pytest.mark.parametrize("chunk", [1 << 18, 64, 256])
def test_score_equals_the_text_alone(monkeypatch, chunk):
    monkeypatch.setattr(Q, "CHUNK", chunk)
    net, rows = Q.Network(3), texts()
    want = [brute_score(net, t) for t in rows]
    assert net.score(rows) == pytest.approx(want, abs=3e-6)
    assert net.score(rows[::-1])[::-1] == pytest.approx(want, abs=3e-6)


def test_training_finds_the_same_winners_in_any_chunks(monkeypatch):
    net, rows = Q.Network(3), texts(2)
    whole = Q._winners(net, rows)
    monkeypatch.setattr(Q, "CHUNK", 64)
    for a, b in zip(whole, Q._winners(net, rows)):
        assert a == pytest.approx(b, abs=1e-5)


def test_training_reads_whole_texts(spark):
    long = "x" * 300_000 + "tail"
    docs = spark.createDataFrame([(i, long if i == 3 else "t") for i in range(8)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(8)] + [(3, 1, 1)], "doc_id long, quality int, toxic int")
    rows, y = Q.training_rows(docs, labels)
    assert long.encode() in rows and len(rows) == len(y) <= 8


def test_clashing_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "t"), (1, "a b", 8, "u"), (None, None, 9, None)], "doc_id long, text string, score int, __text string")
    got = Q.score_documents(docs, Q.Network(3), out="own")
    assert got.columns == [*docs.columns, "own"]
    assert sorted((r.score, r["__text"] or "") for r in got.collect()) == [(7, "t"), (8, "u"), (9, "")]
    assert Q.score_documents(docs, Q.Network(3)).columns == ["doc_id", "text", "__text", "score"]
