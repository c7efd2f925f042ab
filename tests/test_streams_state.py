"""Streams against folds over tables, cut into batches in several ways; batches that run twice."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quorumdf.operators.snapshots import Snapshots
from quorumdf.streaming import exactly_once as X
from quorumdf.streaming import jobs as Z
from quorumdf.streaming import ordered as O


@pytest.fixture
def stateful(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    spark.conf.set(name, O.STATE_STORE)
    yield spark
    spark.conf.set(name, old)


START = datetime(2024, 1, 1)


def cut(spark, path, frame, pieces):
    """Files of a stream that takes one a batch, in their order."""
    size = -(-len(frame) // pieces)
    for i in range(pieces):
        part = frame.iloc[i * size : (i + 1) * size]
        if len(part):
            part.to_parquet(f"{path}/part-{i:03d}.parquet", coerce_timestamps="us")
    schema = spark.read.parquet(f"{path}/part-000.parquet").schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def some_events(seed, n=400):
    """Out of order by less than an hour."""
    rnd = random.Random(seed)
    at = pd.Timestamp("2024-01-01")
    rows = []
    for i in range(n):
        at += pd.Timedelta(minutes=rnd.randint(0, 90))
        town = rnd.choice([None, 1, 2])
        rows.append((i, at + pd.Timedelta(minutes=rnd.randint(-25, 25)), town, rnd.choice("ab"), rnd.choice(["observed", "observed", "cleared", "wont_fix", "noted"] if i > n * 0.8 else ["observed", "cleared"])))
    return pd.DataFrame(rows, columns=["event_id", "ts", "town", "key", "kind"]).astype({"town": "Int64"})


@pytest.mark.parametrize("fold", [O.IssueLifecycle(20 * 3_600_000), O.Silence(9 * 3_600_000)], ids=["lifecycle", "silence"])
def test_every_cut_equals_the_fold_over_the_table(stateful, tmp_path, fold):
    frame = some_events(4)
    last = int(frame["ts"].max().timestamp() * 1000)
    frame.to_parquet(f"{tmp_path}/whole.parquet", coerce_timestamps="us")
    table = stateful.read.parquet(f"{tmp_path}/whole.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    want = sorted(map(str, O.folded(table, ["town", "key"], fold, last - 3_600_000).collect()))
    assert len(want) > 20
    for pieces in (1, 4):
        folder = tmp_path / f"cut{pieces}"
        folder.mkdir()
        stream = O.ordered_fold(cut(stateful, folder, frame, pieces), ["town", "key"], fold, "1 hour")
        assert sorted(map(str, Z.run_to_table(stream, "append").collect())) == want


def test_lifecycle_of_one_issue():
    h = 3_600_000
    fold, state = O.IssueLifecycle(10 * h), {}
    rows = O.run_fold(fold, state, [(1 * h, 1, "observed"), (3 * h, 2, "observed"), (14 * h, 3, "observed"), (15 * h, 4, "cleared"), (16 * h, 5, "cleared"), (17 * h, 6, "wont_fix"), (18 * h, 7, "observed"), (19 * h, 8, "wont_fix"), (20 * h, 9, "observed"), (21 * h, 10, "cleared")], 100 * h)
    assert [(r[0] // h, r[1], r[2], r[3] // h, r[5]) for r in rows] == [
        (1, "inserted", "open", 1, None), (3, "updated", "open", 1, None), (13, "closed", "resolved", 1, "not-observed"), (14, "reopened", "open", 14, None),
        (15, "closed", "resolved", 14, "auto-cleared"), (18, "reopened", "open", 18, None), (19, "suppressed", "wont_fix", 18, "operator"), (20, "updated", "wont_fix", 18, None),
    ]


def test_silence_falls_due_without_an_event():
    fold = O.Silence(10)
    assert O.run_fold(fold, {}, [(0, 1), (10, 2), (15, 3)], 25) == []
    assert O.run_fold(fold, {}, [(0, 1), (10, 2), (15, 3)], 26) == [(25, "silent", 15)]
    assert O.run_fold(fold, {}, [(0, 1), (11, 2)], 12) == [(10, "silent", 0), (11, "running", 0)]


def test_a_version_is_all_tables_or_none(spark, tmp_path):
    s = Snapshots(spark, str(tmp_path))
    one, two = spark.range(3), spark.range(5)
    assert s.latest() == (-1, {}) and s.table("a", one.schema).count() == 0
    assert s.publish(0, replace={"a": one}, append={"b": one})
    held = s.table("a", one.schema)
    assert not s.publish(0, replace={"a": two}) and s.table("a", one.schema).count() == 3
    bad = spark.range(1).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        s.publish(1, replace={"a": two, "c": bad})
    assert s.latest()[0] == 0 and s.table("a", one.schema).count() == 3
    assert s.publish(1, replace={"a": two}, append={"b": two})
    assert s.table("a", one.schema).count() == 5 and s.table("b", one.schema).count() == 8 and held.count() == 3


def test_a_batch_that_runs_twice_changes_nothing(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, 1, 2]), rnd.choice([None, "x", "y"]), START + timedelta(minutes=i), i) for i in range(60)]
    df = spark.createDataFrame(rows, X.ACTIVITY)
    s = Snapshots(spark, str(tmp_path / "m"))
    write = X.milestones(s)
    for number in (0, 0, 1, 1, 0, 2):
        write(df.filter((F.col("event_id") >= 20 * number) & (F.col("event_id") < 20 * number + 20)), number)
    seen, want = set(), []
    for town, key, _, i in rows:
        if town is None or key is None or (town, key) not in seen:
            want.append(i)
            seen.add((town, key))
    assert sorted(r.event_id for r in s.table("activity", X.ACTIVITY).collect()) == want


def test_deliveries_by_any_cut(spark, tmp_path):
    rnd = random.Random(2)
    kinds = ["email.bounced", "email.complained", "email.delivered", "email.opened"]
    rows = [(rnd.choice([" A@x.org", "a@x.org", "b@x.org", "", None]), rnd.choice(kinds), START + timedelta(minutes=i), i) for i in range(80)]
    df = spark.createDataFrame(rows, "email string, event_type string, ts timestamp, event_id long")
    status, alerts = {}, []
    for email, kind, _, i in rows:
        email = (email or "").strip().lower()
        if email and kind in X.DELIVERY:
            if X.DELIVERY[kind] == "undeliverable" and status.get(email) != "undeliverable":
                alerts.append(i)
            status[email] = X.DELIVERY[kind]
    for pieces in (1, 4):
        s = Snapshots(spark, str(tmp_path / str(pieces)))
        for n in range(pieces):
            for _ in range(2):
                X.deliveries(s)(df.filter((F.col("event_id") >= 80 // pieces * n) & (F.col("event_id") < 80 // pieces * (n + 1))), n)
        assert {r.email: r.status for r in s.table("status", X.STATUS).collect()} == status
        assert sorted(r.event_id for r in s.table("alert", X.ALERT).collect()) == alerts


def test_comments_until_cutoff_in_batches(spark, tmp_path):
    at = lambda h: START + timedelta(hours=h)
    items = spark.createDataFrame([(1, at(10)), (2, None)], "item_id long, cutoff timestamp")
    rows = [(1, 7, 1, " Support", at(1)), (2, 7, 1, "oppose", at(2)), (3, 8, 1, "maybe", at(3)), (4, 8, 1, "neutral", at(9)), (5, 9, 1, "oppose", at(10)), (6, 9, 3, "oppose", at(1)), (7, 9, 2, "oppose", at(1)), (8, 8, 1, "oppose", at(4)), (9, 7, 1, "support", None)]
    df = spark.createDataFrame(rows, X.COMMENT)
    s = Snapshots(spark, str(tmp_path))
    write = X.comments_until_cutoff(s, items)
    for n, ids in enumerate([[1, 3, 5], [2, 4, 6], [7, 8, 9]]):
        write(df.filter(F.col("comment_id").isin(ids)), n)
        write(df.filter(F.col("comment_id").isin(ids)), n)
    assert sorted(r.comment_id for r in s.table("accepted", X.COMMENT).collect()) == [1, 4]
    got = {r.comment_id: r.reason for r in s.table("rejected", f"{X.COMMENT}, reason string").collect()}
    assert got == {2: "repeat", 3: "stance", 5: "closed", 6: "unknown item", 7: "unknown item", 8: "repeat", 9: "closed"}
    assert [tuple(r) for r in X.tallies(s.table("accepted", X.COMMENT)).collect()] == [(1, 1, 0, 1)]
