"""The trie of conversations' common prefixes, rolled up by centroid decomposition.

Method.  A conversation is a row of turns, a turn the digest of its role and text, so
texts are read once and never shuffled.  A prefix is named by chaining digests: within
blocks of ``BLOCK`` turns in one pass, then over the blocks' ends by the same rule, so
a conversation of any length is dealt out.  Equal names are one node.  One grouping
gives each node its members, its smallest member and its mass, the number of turns of
all members from there on.  Names of parents are the forest's edges.

Subtree sums come from centroid decomposition (``centroids``).  Components of over
``LOCAL`` nodes are split in Spark rounds: every component's centroid is one minimum,
nodes find the part they fall into by their own path's node one below the centroid's
depth, and the path from centroid to top is the centroid's own conversation.  Smaller
components are split in tasks, in chunks of about ``LOCAL`` nodes.  Each round halves
the mass, so chains as long as a third of all turns and nodes with as many children
take the same few rounds.

The conversations that end at a node are joined in ranges of ``RANGE`` ids, then range
by range into one running digest, so no list of them is ever held.

Defined results: rows without a conv_id belong to no conversation and are left out;
null role or text is the empty string; turns that share their number stand in the
order of their digests, a null turn is first; repeated rows are repeated turns; a
remainder has the sign of its dividend; an empty table gives no nodes, any other has
the root.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .centroids import subtree_sums
from .common import shuffle_partitions, table, written

BLOCK = 4096
LOCAL = 1 << 14
RANGE = 4096
#: Parents with more than one in so many of all nodes as children are broadcast; they are fewer.
SHARE = 1000
#: So many rows of component data are broadcast at most; beyond, Spark joins by shuffle and splits hot keys.
SMALL = 100_000
ROOT = b"\x00" * 32
HEADS = 8
_BUCKET = 1024


def turn_rows(df: DataFrame) -> DataFrame:
    """(conv_id, position from 1, digest, size in bytes) of every turn.

    A conversation is counted in ranges of turn numbers, so that a hot one is not one group.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = df.filter("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.coalesce(F.floor(F.col("turn") / _BUCKET), F.lit(-(1 << 62))).alias("bucket"),
        F.unhex(F.sha2(F.concat(F.sha2(role, 256), F.sha2(text, 256)), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    before = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("conv_id", "bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("conv_id", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("conv_id", "bucket").orderBy(F.col("turn").asc_nulls_first(), "digest"))
    return rows.withColumn("at", within).join(offsets, ["conv_id", "bucket"]).select("conv_id", (F.col("offset") + F.col("at")).alias("position"), "digest", "size")


def rebuilt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations' (conv_id, length) and their turns (conv_id, position, digest, size, length)."""
    turns = written(turn_rows(df), "trie-turns")
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    base = (F.col("conv_id") - F.col("conv_id") % 5).alias("base")
    h = (F.crc32(F.col("conv_id").cast("string")) % (HEADS + 1)).alias("h")
    convs = own.select("conv_id", "n", base, h)
    sizes = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = convs.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = written(convs.select("conv_id", "base", "h", "taken", "length"), "trie-convs")
    heads = turns.filter(F.col("position") <= HEADS).withColumnRenamed("conv_id", "base")  # a base lends to nine at most
    lent = convs.filter("taken > 0").join(heads, "base").filter("position <= h").select("conv_id", "position", "digest", "size", "length")
    kept = turns.join(convs, "conv_id").filter("position > h").select("conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "digest", "size", "length")
    return convs.select("conv_id", "length"), lent.unionByName(kept)


def chain_names(rows: DataFrame, block: int) -> DataFrame:
    """(conv_id, position, digest, ...) -> per block: conv_id, block from 0, ``turns`` with the name of each prefix in place of its digest.

    Names are chained within a block; from the second block on, a name also holds that of
    the blocks before, which are named as a row of their own.
    """
    extra = [c for c in rows.columns if c not in ("conv_id", "position", "digest")]
    blocks = rows.withColumn("block", F.floor((F.col("position") - 1) / block)).groupBy("conv_id", "block")
    blocks = blocks.agg(F.sort_array(F.collect_list(F.struct("position", F.col("digest").alias("name"), *extra))).alias("turns"))  # ``block`` of them at most

    def chain(batches):
        for b in batches:
            out = []
            for turns in b.column("turns").to_pylist():
                name = ROOT
                for t in turns:
                    name = t["name"] = hashlib.sha256(name + t["name"]).digest()
                out.append(turns)
            at = b.schema.get_field_index("turns")
            yield b.set_column(at, b.schema.field(at), pa.array(out, b.schema.field(at).type))

    blocks = written(blocks.mapInArrow(chain, blocks.schema), "trie-blocks")
    last = blocks.agg(F.max("block").alias("b")).first().b
    if not last:
        return blocks
    ends = blocks.select("conv_id", (F.col("block") + 1).alias("position"), F.element_at("turns", -1)["name"].alias("digest"))
    prefix = chain_names(ends, block).select("conv_id", F.explode("turns").alias("t")).select("conv_id", F.col("t.position").alias("block"), F.col("t.name").alias("prefix"))
    later = blocks.filter("block > 0").join(prefix, ["conv_id", "block"])
    full = lambda t: t.withField("name", F.unhex(F.sha2(F.concat(F.col("prefix"), t["name"]), 256)))
    later = later.withColumn("turns", F.transform("turns", full)).select(*blocks.columns)
    return written(blocks.filter("block = 0").unionByName(later), "trie-names")


def path_rows(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, node, parent, size, length) of every turn of every rebuilt conversation."""
    blocks = chain_names(rows, block)
    before = F.lag(F.element_at("turns", -1)["name"]).over(Window.partitionBy("conv_id").orderBy("block"))
    several = blocks.filter("block > 0").limit(1).count() > 0
    blocks = blocks.withColumn("before", before if several else F.lit(None).cast("binary"))
    parents = F.concat(F.array(F.coalesce("before", F.lit(ROOT))), F.slice(F.transform("turns", lambda t: t["name"]), F.lit(1), F.size("turns") - 1))
    one = F.zip_with("turns", parents, lambda t, p: F.struct(t["position"].alias("depth"), t["name"].alias("node"), p.alias("parent"), t["size"].alias("size"), t["length"].alias("length")))
    return blocks.select("conv_id", F.explode(one).alias("t")).select("conv_id", "t.*")


def _joined_small(rows: DataFrame, small: DataFrame, n: int, on, how: str = "left") -> DataFrame:
    """A join with data of ``n`` rows: by broadcast up to ``SMALL`` of them, else as Spark sees fit."""
    return rows.join(F.broadcast(small) if n <= SMALL else small, on, how)


def nodes_of(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """node, parent, conv_id, depth, n_convs, mass, n_children, leaves and saved (own shares)."""
    mass = lambda depth: F.sum(F.col("length") - depth + 1)
    found = paths.groupBy("node").agg(F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"), mass(F.col("depth")).alias("mass"), F.first("size").alias("size"))
    root = convs.agg(F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.min("conv_id").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.count(F.lit(1)).alias("n_convs"), mass(F.lit(0)).alias("mass"), F.lit(0).cast("long").alias("size"))
    found = written(found.unionByName(root.filter("n_convs > 0").select(*found.columns)), "trie-nodes")
    children = found.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    out = found.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return written(out.withColumns({"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("size")}), "trie-edges")


def with_parent_conv(nodes: DataFrame, share: int = SHARE) -> DataFrame:
    """Add the parent's conv_id; a parent of very many children is broadcast, so no key of the shuffled join is hot."""
    most = nodes.count() / share
    parents = nodes.filter("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    often = parents.filter(F.col("n_children") > most).drop("n_children").withColumnRenamed("parent_conv_id", "often")  # fewer than ``share`` rows
    rare = parents.filter(F.col("n_children") <= most).drop("n_children")
    rows = nodes.join(F.broadcast(often), "parent", "left")
    hot = rows.filter("often IS NOT NULL OR parent IS NULL").withColumnRenamed("often", "parent_conv_id")
    return hot.unionByName(rows.filter("often IS NULL AND parent IS NOT NULL").drop("often").join(rare, "parent"))


def _split_round(state: DataFrame, paths: DataFrame):
    """Split every component of ``state`` once: (what the nodes on paths are given, the nodes that are left with their new components)."""
    middle = state.filter(F.col("mass") * 2 >= F.col("total")).groupBy("component").agg(F.min(F.struct("mass", (-F.col("depth")).alias("up"), "node", "conv_id", "top_depth")).alias("c"))
    splits = middle.select("component", F.col("c.node").alias("centre"), F.col("c.conv_id").alias("via"), (-F.col("c.up")).alias("centre_depth"), F.col("c.mass").alias("lost"), F.col("c.top_depth").alias("top"))
    splits = written(splits, "trie-splits")
    n = splits.count()
    rows = _joined_small(state, splits.select("component", "centre", "centre_depth"), n, "component")
    step = paths.select("conv_id", F.col("depth").alias("one_below"), F.col("node").alias("part"), F.col("parent").alias("over"))
    rows = rows.withColumn("one_below", F.col("centre_depth") + 1).join(step, ["conv_id", "one_below"], "left")
    below = F.col("over").eqNullSafe(F.col("centre")) & (F.col("depth") > F.col("centre_depth"))
    rows = written(rows.withColumn("side", F.when(F.col("node") == F.col("centre"), "centre").when(below, "below").otherwise("above")), "trie-sides")
    totals = rows.filter("side != 'above'").groupBy("component").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    splits = splits.join(totals, "component")
    way = _joined_small(paths.select(F.col("conv_id").alias("via"), "depth", "node"), splits, n, "via", "inner").filter("depth >= top AND depth <= centre_depth")
    way = way.select("node", "leaves", "saved", F.when(F.col("node") != F.col("centre"), F.col("lost")).alias("lost"))
    at_root = splits.filter("top = 0").select(F.lit(ROOT).alias("node"), "leaves", "saved", F.when(F.col("centre_depth") > 0, F.col("lost")).alias("lost"))
    given = written(way.unionByName(at_root), "trie-given")
    left = rows.filter("side != 'centre'").join(given.select("node", "lost"), "node", "left")
    left = left.select(
        *["node", "parent", "conv_id", "depth", "leaves", "saved"],
        (F.col("mass") - F.coalesce("lost", F.lit(0))).alias("mass"),
        F.when(F.col("side") == "below", F.col("part")).otherwise(F.col("component")).alias("component"),
        F.when(F.col("side") == "below", F.col("one_below")).otherwise(F.col("top_depth")).alias("top_depth"),
    )
    return given.select("node", "leaves", "saved"), written(left, "trie-left")


def _local_sums(rows: DataFrame) -> DataFrame:
    """Subtree sums within components of bounded size; whole components are taken in chunks."""
    columns = ["component", "node", "parent", "depth", "mass", "leaves", "saved"]
    schema = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("leaves", T.LongType()), T.StructField("saved", T.LongType())])

    def solve(frame: pd.DataFrame) -> pa.RecordBatch:
        place = {node: i for i, node in enumerate(frame["node"])}
        parent = np.array([place.get(p, -1) if n != c else -1 for p, n, c in zip(frame["parent"], frame["node"], frame["component"])])
        sums = subtree_sums(parent, frame["depth"].to_numpy(), frame["mass"].to_numpy(), frame[["leaves", "saved"]].to_numpy())
        return pa.record_batch({"node": pa.array(frame["node"], pa.binary()), "leaves": sums[:, 0], "saved": sums[:, 1]})

    def over(batches):
        held = []
        for b in batches:
            held.append(b.to_pandas())
            if sum(map(len, held)) >= LOCAL:
                frame = pd.concat(held, ignore_index=True)
                whole = frame["component"] != frame["component"].iloc[-1]
                if whole.any():
                    yield solve(frame[whole].reset_index(drop=True))
                    frame = frame[~whole].reset_index(drop=True)
                held = [frame]
        if held and sum(map(len, held)):
            yield solve(pd.concat(held, ignore_index=True))

    dealt = rows.select(*columns).repartition(shuffle_partitions(rows.sparkSession), "component").sortWithinPartitions("component")
    return dealt.mapInArrow(over, schema)


def rollup(nodes: DataFrame, paths: DataFrame, local: int = LOCAL) -> DataFrame:
    """node, n_leaves and saved_tokens over each node's subtree, by centroid decomposition."""
    state = nodes.select("node", "parent", "conv_id", "depth", "leaves", "saved", "mass", F.lit(ROOT).alias("component"), F.lit(0).cast("long").alias("top_depth"))
    found = []
    while True:
        parts = written(state.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.max("mass").alias("total")).filter(F.col("n") > local), "trie-parts")
        n = parts.count()  # one in ``local`` nodes at most
        if not n:
            found.append(_local_sums(state))
            break
        rows = _joined_small(state, parts.select("component", "total"), n, "component")
        found.append(_local_sums(rows.filter("total IS NULL")))
        given, state = _split_round(rows.filter("total IS NOT NULL"), paths)
        found.append(given)
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    return every.groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def end_digests(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """node, ends_sha256 of every node at which conversations end."""
    ends = paths.filter("depth = length").select("node", "conv_id").unionByName(convs.filter("length = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string"))  # ``RANGE`` of them at most
    parts = ends.groupBy("node", F.floor(F.col("conv_id") / RANGE).alias("part")).agg(F.array_join(ids, ",").alias("ids"))
    schema = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("ends_sha256", T.StringType())])

    def digest(batches):
        at, state = None, None
        for b in batches:
            nodes, out = [], []
            for node, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()):
                if node == at:
                    state.update(b"," + ids.encode())
                else:
                    if state is not None:
                        nodes.append(at)
                        out.append(state.hexdigest())
                    at, state = node, hashlib.sha256(ids.encode())
            yield pa.record_batch({"node": pa.array(nodes, pa.binary()), "ends_sha256": pa.array(out, pa.string())})
        if state is not None:
            yield pa.record_batch({"node": pa.array([at], pa.binary()), "ends_sha256": pa.array([state.hexdigest()], pa.string())})

    dealt = parts.repartition(shuffle_partitions(parts.sparkSession), "node").sortWithinPartitions("node", "part").select("node", "ids")
    return dealt.mapInArrow(digest, schema)


def prefix_trie(df: DataFrame, local: int = LOCAL, block: int = BLOCK) -> DataFrame:
    """Every node with its prefix's name and its parent's, members, children and sums over its subtree."""
    convs, turns = rebuilt(df)
    paths = written(path_rows(turns, block), "trie-paths")
    nodes = nodes_of(convs, paths)
    out = with_parent_conv(nodes).join(rollup(nodes, paths, local), "node").join(end_digests(convs, paths), "node", "left")
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    out = prefix_trie(table(spark, sf_dir, "conversations"))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


_SQL_CRC = "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ord(x) AS BIGINT) FOR x IN string_split(CAST(c AS VARCHAR), '')]), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda p, q: xor(p >> 1, 3988292384 * (p & 1)))), 4294967295)"
OP13_SQL = f"""WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list({{'r': r, 'x': x}} ORDER BY pos) AS turns FROM t GROUP BY c),
h AS (SELECT c, turns, {_SQL_CRC} % 9 AS h FROM o),
b AS (SELECT h.c, list_concat(coalesce(o.turns[:h.h], []), h.turns[h.h + 1:]) AS turns FROM h LEFT JOIN o ON o.c = h.c - h.c % 5),
p AS (SELECT c, d, turns[:d] AS node, len(turns) = d AS ends FROM (SELECT c, turns, unnest(range(len(turns) + 1)) AS d FROM b)),
n AS (SELECT node, d AS depth, min(c) AS conv_id, count(*) AS n_convs, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends) AS ids FROM p GROUP BY node, d),
k AS (SELECT node[:depth - 1] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(node[depth].x) END AS own FROM n LEFT JOIN k USING (node)),
s AS (SELECT node[:a] AS node, sum(own) AS saved, count(*) FILTER (WHERE n_children = 0) AS n_leaves FROM (SELECT node, own, n_children, unnest(range(depth + 1)) AS a FROM f) GROUP BY 1)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(f.ids, '')) AS ends_sha256
FROM f JOIN s USING (node) LEFT JOIN n q ON f.depth > 0 AND q.node = f.node[:f.depth - 1]"""
