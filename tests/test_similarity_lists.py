"""Blocks of texts below the threshold of couples: lists and numbers of the like ones, a second threshold, sizes of blocks."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quorumdf.operators import resolution as E


def grams(text):
    return {("  " + w + " ")[i : i + 3] for w in re.findall("[a-z0-9]+", text.lower()) for i in range(len(w) + 1)}


first = lambda t: F.substring_index(t, " ", 1)


def pairs(names, threshold, unlike):
    for i, x in enumerate(names):
        for j, y in enumerate(names):
            g, h = grams(x or ""), grams(y or "")
            if i < j and g and h:
                likeness, alike = round(len(g & h) / len(g | h), 6), x.split(" ")[0] == y.split(" ")[0]
                if likeness >= threshold and (alike or likeness > unlike):
                    yield i, j, likeness, alike


@pytest.mark.parametrize("threshold", [0.3, 0.6])
def test_pairs_and_their_numbers_with_two_thresholds(spark, monkeypatch, threshold):
    for name, value in {"POSTINGS": 5, "BLOCKS": 3, "LARGEST": 30}.items():
        monkeypatch.setattr(E, name, value)
    rnd = random.Random(8)
    names = [" ".join(rnd.choice(["Ann", "Anne", "Lee", "Leigh", "Member", "12", "é"]) for _ in range(rnd.randint(1, 4))) + rnd.choice(["", " 0001", " 0002"]) for _ in range(80)]
    long = " ".join(f"{i:03d}x" for i in range(400))  # more grams than a byte counts
    names += [long, long + " Ann", long.replace("7", "8"), None, "", "---"]
    df = spark.createDataFrame([*enumerate(names), (None, "Ann Lee")], "k long, name string")
    same = (df, df, "k", "name", "k", "name", threshold)
    want = list(pairs(names, threshold, 0.7))
    assert sorted(map(tuple, E.similar_pairs(*same, ordered=True, alike=first, unlike=0.7).select("ka", "kb", "similarity", "alike").collect())) == want
    assert any(r[3] and r[2] <= 0.7 for r in want) and any(not r[3] for r in want)
    counts = Counter()
    for r in E.similar_pairs(*same, ordered=True, alike=first, unlike=0.7, counted=True).collect():
        counts[r.ka, r.similarity, r.alike] += r.n
    assert counts == Counter((i, s, a) for i, _, s, a in want)


def test_products_grow_no_faster_than_blocks_of_the_largest_size(spark, monkeypatch):
    for name, value in {"POSTINGS": 5, "BLOCKS": 4, "LARGEST": 50}.items():
        monkeypatch.setattr(E, name, value)
    df = spark.range(100).select(F.col("id").alias("k"), F.format_string("Supplier#%09d", "id").alias("name"))
    found = E.similar_pairs(df, df, "k", "name", "k", "name", 0.4, ordered=True)
    assert "RoundRobinPartitioning(10)" in found._jdf.queryExecution().executedPlan().toString()  # four blocks and not twenty
    assert found.count() == sum(1 for _ in pairs([f"Supplier#{i:09d}" for i in range(100)], 0.4, 0.4))


def test_what_a_text_lacks_in_similarity_never_becomes_rows(spark):
    """Conditions on similarities hold for lists of keys, before these are made rows."""
    df = spark.range(50).select(F.col("id").alias("k"), F.format_string("Supplier#%09d", "id").alias("name"))
    plan = E.similar_pairs(df, df, "k", "name", "k", "name", 0.4, ordered=True).filter("similarity > 0.7")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("> 0.7") < plan.index("MapInArrow")
