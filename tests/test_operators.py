"""Sinks, lifecycle, folds and documents on small tables."""

import random

import pandas as pd
from pyspark.sql import functions as F

from quorumdf.operators import detectors as D
from quorumdf.operators import documents as T
from quorumdf.operators import ledger as L
from quorumdf.operators import observers as O
from quorumdf.operators import sinks as K
from quorumdf.operators import resolution as E


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "k int, v string, w string")
    source = spark.createDataFrame([(2, "B", ""), (3, "C", "z"), (3, "D", "z")], "k int, v string, w string")
    once = K.upsert(target, source, ["k"], ["v"])
    twice = K.upsert(once.drop("action"), source, ["k"], ["v"])
    assert rows(once.drop("action")) == rows(twice.drop("action")) == [(1, "a", "x"), (2, "B", ""), (3, "C", "z")]
    kept = K.upsert(target, spark.createDataFrame([(1, "", None)], "k int, v string, w string"), ["k"], coalesce=True)
    assert rows(kept.drop("action")) == [(1, "a", "x"), (2, "b", None)]


def test_replace_by_key_clears_an_empty_source(spark):
    target = spark.createDataFrame([("p", 1), ("q", 2)], "pattern string, n int")
    assert rows(K.replace_by_key(target, target.limit(0), "pattern", ["p"])) == [("q", 2)]


def test_insert_absent_partial_unique(spark):
    target = spark.createDataFrame([(1, "open"), (2, "closed")], "k int, status string")
    source = spark.createDataFrame([(1, "open"), (2, "open"), (2, "open"), (None, "open")], "k int, status string")
    assert rows(K.insert_absent(target, source, ["k"], when="status = 'open'")) == [(2, "open")]


def test_lifecycle(spark):
    observed = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (None, "a")], "k int, c string")
    prior = spark.createDataFrame([(1, "a", "open"), (2, "a", "closed"), (3, "a", "wont_fix"), (4, "a", "open"), (5, "a", "closed"), (None, "a", "open")], "k int, c string, status string")
    got = {r.k: (r.status, r.action) for r in O.lifecycle(observed, prior, ["k", "c"], live=["open"], closed="closed", frozen=["wont_fix"]).collect()}
    assert got == {1: ("open", "updated"), 2: ("open", "reopened"), 3: ("wont_fix", "updated"), 4: ("closed", "closed"), 5: ("closed", "unchanged"), None: ("open", "updated")}


def test_failed_observer_is_reported(spark):
    good = spark.createDataFrame([(1, "high", 2)], "body_id int, severity string, n long")
    out, failed = O.observe(None, {"good": lambda c: good, "bad": lambda c: c.nothing})
    assert failed == ["bad"] and out.count() == 1


def test_json_key_with_null_value_exists(spark):
    df = spark.createDataFrame([('{"a": null}',), ("{}",), (None,)], "meta string")
    assert [r.x for r in df.select(O.has_key(F.col("meta"), "a").alias("x")).collect()] == [True, False, False]


def test_admission_pauses_until_a_deposit():
    e = pd.DataFrame({"event_id": range(6), "kind": ["deposit", "spend", "spend", "spend", "deposit", "spend"], "amount_cents": [100, -60, -60, -10, 50, -60]})
    got, state = L.fold_admission(e)
    assert [g[1] for g in got] == ["credited", "admitted", "refused_floor", "refused_paused", "credited", "admitted"] and state["balance"] == 30


def islands(spans):
    """The fixpoint rule: the largest span absorbs what touches it until nothing changes."""
    a, b = max(spans, key=lambda s: (s[1] - s[0], -s[0]))
    changed = True
    while changed:
        changed = False
        for x, y in spans:
            if x <= b + 1 and y >= a - 1 and (x < a or y > b):
                a, b, changed = min(a, x), max(b, y), True
    return a, b


def test_segment_islands_equal_the_fixpoint(spark):
    rnd = random.Random(3)
    spans = [(k, s, s + rnd.randint(0, 4)) for k in range(60) for s in (rnd.randint(1, 40) for _ in range(rnd.randint(1, 8)))]
    got = {r.k: (r.start_page, r.end_page) for r in T.merge_segments(spark.createDataFrame(spans, "k int, start_page int, end_page int"), ["k"]).collect()}
    assert got == {k: islands([(a, b) for q, a, b in spans if q == k]) for k in got}


def test_merge_chains_collapse(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (4, 9), (9, 8)], "a long, b long")
    assert {r.node: r.root for r in E.merge_mapping(edges).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 8: 4, 9: 4}


def test_page_windows(spark):
    df = spark.createDataFrame([(1, "\n".join(f"p{i}" for i in range(25)))], "id int, text string")
    got = {r.first_page: r.n_pages for r in T.page_windows(df, "id", "text").collect()}
    assert got == {1: 10, 11: 10, 21: 5}


def test_content_hash_ignores_nul(spark):
    df = spark.createDataFrame([(1, "a\x00b"), (2, "ab")], "id int, text string")
    assert T.content_addressed(df, "id", "text")[0].count() == 1


def test_staff_words_are_marked_as_they_are_listed(spark):
    rows = [(1, "City CLERK Ann"), (2, None), (3, ""), (4, "Ann Lee"), (5, "chief inspector"), (6, "off icer")]
    df = spark.createDataFrame(rows, "motion_id long, petitioner string")
    got = df.select("motion_id", F.coalesce(D.names_staff(), F.lit(False)).alias("marked"), (F.size(D.staff_words()) > 0).alias("listed")).collect()
    assert [r.motion_id for r in got if r.marked] == [1, 5] and all(r.marked == r.listed for r in got if rows[r.motion_id - 1][1] is not None)
    assert {r.motion_id: r.matched for r in D.petitioner_is_staff(df).collect()} == {1: "clerk", 5: "chief,inspector"}
