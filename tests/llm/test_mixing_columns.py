"""Mixing moves whole documents and leaves the user's columns alone."""

from quorumdf.llm import mixing


def frame(spark):
    rows = [(i, f"text {i} " + "x" * (200_000 if i == 5 else 3), "a" if i % 3 else None, 0.5, i, "mine", "k", 1) for i in range(30)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, rate double, n_copies int, copy string, shuffle_key string, __source int")


def test_user_columns_stay(spark):
    docs = frame(spark)
    got = mixing.mix(docs)
    assert got.columns == docs.columns
    assert {tuple(r) for r in got.collect()} <= {tuple(r) for r in docs.collect()}
    full = mixing.replicate(docs, outputs=("r", "n", "c", "o")).collect()
    assert len(full) == got.count() and all(0 <= r.c < r.n and r.copy == "mine" for r in full)


def test_outputs_replace_columns_of_their_name(spark):
    got = mixing.replicate(frame(spark))
    assert got.columns == ["doc_id", "text", "source", "__source", *mixing.OUTPUTS]
    assert all(0 <= r.copy < r.n_copies and r.text.startswith(f"text {r.doc_id} ") for r in got.collect())
