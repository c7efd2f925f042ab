"""op7: anchors against loops over the units, likeness by position against sets of pairs."""

import random
import re

import pytest
import regex

from quorumdf.llm import syncmers

UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
UNIT = regex.compile(rf"(?V1)[{UNSPACED}]|[[\p{{L}}\p{{M}}\p{{N}}_]--[{UNSPACED}]]+|[^\x20\x09-\x0D]")


class Hash:
    """Spark's xxhash64 of strings and of numbers, asked for in one go each."""

    def __init__(self, spark):
        self.spark = spark

    def words(self, words):
        rows = self.spark.createDataFrame([(w,) for w in sorted(set(words))], "w string").selectExpr("w", "xxhash64(w) h").collect()
        return {r.w: r.h for r in rows}

    def numbers(self, tuples):
        rows = self.spark.createDataFrame([(list(t),) for t in sorted(set(tuples))], "t array<long>")
        n = len(next(iter(tuples)))
        return {tuple(r.t): r.h for r in rows.selectExpr("t", f"xxhash64({', '.join(f't[{i}]' for i in range(n))}) h").collect()}


def brute_anchors(spark, text):
    hashes = Hash(spark)
    units = UNIT.findall(text)
    known = hashes.words(units)
    h = [known[u] for u in units]
    pairs = hashes.numbers(list(zip(h, h[1:])))
    inner = [pairs[p] for p in zip(h, h[1:])]
    at = [i for i in range(len(h) - 4) if min(inner[i : i + 4]) in (inner[i], inner[i + 3])]
    five = hashes.numbers([tuple(h[i : i + 5]) for i in at])
    return [(five[tuple(h[i : i + 5])], i) for i in at]


def near(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    for text, out in (("a", "x"), ("b", "y")):
        df = syncmers.with_placed(syncmers.with_anchors(df, text, out), out, out + "p")
    return df.select(syncmers.likeness(df.xp, df.yp).alias("s"), df.x, df.y).first()


def placed(anchors):
    return {(h, p - anchors[max(0, i - 1)][1]) for i, (h, p) in enumerate(anchors)}


@pytest.mark.parametrize("seed", [1, 2])
def test_anchors_and_likeness_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    words = lambda n: " ".join(rnd.choice(["été", "abc", "x_1", "日本", "の文", "a.b", "7", "…", "z"]) + str(rnd.randint(0, 9)) for _ in range(n))
    a, b = words(60) + "\n\t " + words(30), words(20)
    b = a[:200] + b + a[150:]
    row = near(spark, a, b)
    x, y = brute_anchors(spark, a), brute_anchors(spark, b)
    assert [(r.hash, r.position) for r in row.x] == x and [(r.hash, r.position) for r in row.y] == y
    assert row.s == pytest.approx(len(placed(x) & placed(y)) / len(placed(x) | placed(y)))


def test_near_copies_of_any_length(spark):
    words = [f"word{i}" for i in range(41)]
    assert near(spark, " ".join(words[:39]), " ".join(words)).s > 0.8
    assert near(spark, "a b  c", "a b c").s == 1 and near(spark, "", " \n").s == 1 and near(spark, "a", "b").s == 0
    rnd = random.Random(1)
    unspaced = "".join(chr(rnd.randrange(0x4E00, 0x9000)) for _ in range(900))
    assert near(spark, unspaced, unspaced[:600] + " spaced words" * 40).s > 0.3


def test_a_short_passage_of_long_texts_counts(spark):
    rnd = random.Random(2)
    text = lambda: " ".join(str(rnd.randrange(10**6)) for _ in range(20_000))
    passage = " ".join(str(rnd.randrange(10**6)) for _ in range(60))
    row = near(spark, text() + passage, passage + text())
    assert len(row.x) > 8000 and 20 <= len({r.hash for r in row.x} & {r.hash for r in row.y}) and 0 < row.s < 0.02


def test_the_same_anchors_elsewhere_match_but_not_in_another_order(spark):
    rnd = random.Random(3)
    blocks = [" ".join(f"{rnd.choice('abcdefgh')}{rnd.randint(0, 999)}" for _ in range(12)) for _ in range(20)]
    moved = near(spark, " ".join(blocks), "some words put before it all " + " ".join(blocks)).s
    mixed = near(spark, " ".join(blocks), " ".join(reversed(blocks))).s
    assert moved > 0.9 > mixed


def test_ranges_have_names_that_spread(spark):
    names = syncmers.range_names(spark, 40, 10)
    assert len(set(names)) == 40
    tasks = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n int").selectExpr("pmod(hash(n), 10)").collect()]
    assert {tasks.count(t) for t in range(10)} == {4}
    assert re.fullmatch(r"(\d+:-?\d+,?)+", syncmers.fingerprints(spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")).first().fingerprint)
