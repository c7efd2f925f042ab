"""The similarity join against all pairs, with grams dealt to many tasks."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quorumdf.operators import resolution as E


def grams(text):
    return {("  " + w + " ")[i : i + 3] for w in re.findall("[a-z0-9]+", text.lower()) for i in range(len(w) + 1)}


@pytest.mark.parametrize("threshold,postings", [(0.4, 3), (0.75, 7), (1.0, 4096)])
def test_pairs_equal_all_pairs(spark, monkeypatch, threshold, postings):
    monkeypatch.setattr(E, "POSTINGS", postings)
    rnd = random.Random(5)
    names = [" ".join(rnd.choice(["Ann", "anne", "Lee", "Leigh", "Customer", "12", "13", "O'Neil", ""]) for _ in range(rnd.randint(0, 3))) + rnd.choice(["", "é", " 0001", " 0002"]) for _ in range(90)] + [None, "", "---"]
    a = spark.createDataFrame(list(enumerate(names)), "k long, name string")
    b = spark.createDataFrame([(100 + i, n) for i, n in enumerate(names[:40])], "k long, name string")
    want = {}
    for i, x in enumerate(names):
        for j, y in [*enumerate(names), *((100 + j, n) for j, n in enumerate(names[:40]))]:
            g, h = grams(x or ""), grams(y or "")
            if g and h and round(len(g & h) / len(g | h), 6) >= threshold:
                want[i, j] = round(len(g & h) / len(g | h), 6)
    own = {(r.ka, r.kb): r.similarity for r in E.similar_pairs(a, a, "k", "name", "k", "name", threshold, ordered=True).collect()}
    assert own == {k: v for k, v in want.items() if k[0] < k[1] < 100}
    rows = E.similar_pairs(a, b, "k", "name", "k", "name", threshold).collect()
    assert len(rows) == len({(r.ka, r.kb) for r in rows}) and {(r.ka, r.kb): r.similarity for r in rows} == {k: v for k, v in want.items() if k[1] >= 100}


@pytest.mark.parametrize("threshold", [0.4, 0.6])
def test_pairs_within_a_group_tell_whether_texts_are_alike(spark, threshold):
    rows = [(i, f"Member {i % 7} Customer#{i:09d}" if i % 3 else f"Customer#{i:09d}", i % 4 if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, name string, body long")
    first = lambda t: F.substring_index(t, " ", 1)
    got = {(r.ka, r.kb): (r.similarity, r.alike) for r in E.similar_pairs(df, df, "k", "name", "k", "name", threshold, ordered=True, alike=first, within="body").collect()}
    want = {}
    for k, x, body in rows:
        for m, y, other in rows:
            g, h = grams(x), grams(y)
            if k < m and body is not None and body == other and round(len(g & h) / len(g | h), 6) >= threshold:
                want[k, m] = round(len(g & h) / len(g | h), 6), x.split(" ")[0] == y.split(" ")[0]
    assert got == want and len({v[1] for v in got.values()}) == 2


def test_products_are_dealt_over_many_tasks(spark):
    n = 2 * E.POSTINGS + 10
    df = spark.range(n).select(F.col("id").alias("k"), F.format_string("Supplier#%09d", "id").alias("name"))
    pairs = E.similar_pairs(df, df, "k", "name", "k", "name", 0.4, ordered=True)
    per = [r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(per) >= 4 and max(per) <= 0.5 * sum(per) and sum(per) > 0.3 * n * n
