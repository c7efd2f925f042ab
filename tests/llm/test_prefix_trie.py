"""The prefix trie against one of dictionaries, with every bound so small that each way through the code is taken."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quorumdf.llm import centroids, prefix_trie as P

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """rows: (conv_id, turn, role, text) whose turns differ within a conversation."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    nodes, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        built = tuple(own.get(c - int(np.fmod(c, 5)), [])[:h] + own[c][h:])
        for d in range(len(built) + 1):
            nodes[built[:d]].append(c)
        ends[built].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in nodes:
        if k:
            children[k[:-1]] += 1
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1].encode()) if k else 0
    return sorted(((m[0], len(k), nodes[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest()) for k, m in nodes.items()), key=str)


def some_rows(seed, n, words=3, longest=12):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-20, 4 * n), n):
        for turn in rnd.sample(range(-5, 3000), rnd.randint(1, longest)):
            rows.append((c, turn, rnd.choice(["user", None, ""]), rnd.choice(["", None, "é" * 3, "hello", "b" * 50][: words + 2])))
    return rows


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("local,block", [(20, 3), (1 << 14, 4096)])
def test_every_way_equals_brute_force(spark, local, block, monkeypatch):
    monkeypatch.setattr(P, "LOCAL", local)
    rows = some_rows(1, 30, words=0, longest=14)
    rows += [(c, t, "user", "same") for c in range(1000, 1025) for t in range(9)]  # one conversation in a third of all
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert result(P.prefix_trie(df, local, block)) == brute(rows)


def test_a_chain_and_a_star(spark):
    rows = [(5, t, "user", str(t)) for t in range(900)] + [(c, 0, "user", f"only {c}") for c in range(100, 400)]
    rows += [(6, t, "user", str(t)) for t in range(0, 900, 2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert result(P.prefix_trie(df, local=100, block=64)) == brute(rows)


def test_query_and_sql(spark, tmp_path):
    rows = some_rows(2, 80) + [(7000, None, "user", "first"), (7000, -3, "user", "second"), (None, 1, "user", "nobody")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("node", "Parent", "depth", "position", "n", "h", "base", "length", "digest", "bucket", "component", "mass", "top"):
        df = df.withColumn(name, F.lit("x"))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = result(P.op13_prefix_trie(spark, str(tmp_path)))
    assert got == brute(rows)
    c = duckdb.connect()
    c.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    out = c.execute(P.OP13_SQL)
    at = [[d[0] for d in out.description].index(x) for x in COLUMNS]
    assert sorted((tuple(r[i] for i in at) for r in out.fetchall()), key=str) == got


def test_ties_repeats_and_empty_tables(spark):
    df = spark.createDataFrame([(10, 1, "a", "x"), (10, 1, "a", "x"), (10, 1, "b", "y"), (10, 2, None, None)], "conv_id long, turn long, role string, text string")
    one, two = (result(P.prefix_trie(d)) for d in (df, df.orderBy(F.desc("role"))))
    assert one == two and max(r[1] for r in one) == 4
    assert result(P.prefix_trie(df.limit(0))) == []
    assert result(P.prefix_trie(spark.createDataFrame([(None, 1, "a", "x")], df.schema))) == []
    # conversation 4 lends from 0, which is absent, and has no turns of its own beyond the first h
    h = zlib.crc32(b"4") % 9
    none = spark.createDataFrame([(4, t, "a", "x") for t in range(h)] + [(3, 0, "a", "z")], df.schema)
    assert result(P.prefix_trie(none)) == brute([(4, t, "a", "x") for t in range(h)] + [(3, 0, "a", "z")])


@pytest.mark.parametrize("shape", ["random", "chain", "star", "forest"])
def test_sums_over_forests(shape):
    rnd = np.random.default_rng(3)
    n = 400
    parent = np.array([-1 if i == 0 or (shape == "forest" and i % 7 == 0) else {"chain": i - 1, "star": 0}.get(shape, int(rnd.integers(max(0, i - 9), i))) for i in range(n)])
    depth, mass = np.zeros(n, int), rnd.integers(1, 5, n)
    values = rnd.integers(0, 9, (n, 2))
    sums = values.copy()
    for i in range(n):
        depth[i] = depth[parent[i]] + 1 if parent[i] >= 0 else 0
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            mass[parent[i]] += mass[i]
            sums[parent[i]] += sums[i]
    assert (centroids.subtree_sums(parent, depth, mass, values) == sums).all()
