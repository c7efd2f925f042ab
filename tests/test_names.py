"""Name expressions and resolution on literal cases."""

import re

import pytest
from pyspark.sql import functions as F

from quorumdf.functions import names as N
from quorumdf.operators import resolution as E


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text,want",
    [("Councilwoman Ms. Sylvia Martin", "Sylvia Martin"), ("Mayor Pro Tem Jones", "Jones"), ("Mayor", "Mayor"), ("Drew Carey", "Drew Carey"), ("  Dr. Hon. Lee ", "Lee")],
)
def test_strip_title(spark, text, want):
    assert one(spark, N.strip_title(F.lit(text))) == want


def iterative(text):
    words = sorted(N.TITLES + N.HONORIFICS, key=lambda w: (N.TITLES + N.HONORIFICS).index(w))
    text = text.strip()
    while True:
        for w in words:
            m = re.match(re.escape(w) + r"\s+", text, re.I)
            if m:
                text = text[m.end() :]
                break
        else:
            return text


def test_strip_title_equals_the_iterative_rule(spark):
    import random

    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(N.TITLES + N.HONORIFICS + ["Ann", "Lee", "Mayoral"]) for _ in range(rnd.randint(1, 5))) for _ in range(200)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", N.strip_title(F.col("t")).alias("x")).collect()
    assert all(r.x == iterative(r.t) for r in rows)


def test_split_name(spark):
    r = one(spark, N.split_name(F.lit("Thomas W. Mercer, Jr")))
    assert (r.first, r.middle, r.last, r.suffix) == ("Thomas", "W.", "Mercer", "Jr")
    assert one(spark, N.split_name(F.lit("Smith"))).last == "Smith"


@pytest.mark.parametrize("a,b,want", [("Bob", "Robert", True), ("R.", "Robert", True), ("Ceretta", "Bradley", False), (None, "Ann", True), ("Ann", "ann", True)])
def test_first_names_agree(spark, a, b, want):
    assert one(spark, N.first_names_agree(F.lit(a).cast("string"), F.lit(b).cast("string"))) is want


def test_unresolvable(spark):
    for text, want in (("(… illegible)", True), ("123", True), ("Unknown", True), ("Ann Lee", False)):
        assert one(spark, N.looks_unresolvable(F.lit(text))) is want


def grams(text):
    out = set()
    for w in re.findall(r"[a-z0-9]+", text.lower()):
        p = f"  {w} "
        out |= {p[i : i + 3] for i in range(len(p) - 2)}
    return out


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.75, 0.9])
def test_similar_pairs_equal_brute_force(spark, threshold):
    import random

    rnd = random.Random(7)
    texts = sorted({" ".join(rnd.choice(["anna", "anne", "hanna", "lee", "leigh", "smith", "smyth", "jones"]) for _ in range(rnd.randint(1, 3))) for _ in range(120)})
    df = spark.createDataFrame([(t,) for t in texts], "name string")
    got = {(r.ka, r.kb) for r in E.similar_pairs(df, df, "name", "name", "name", "name", threshold, ordered=True).collect()}
    want = {(a, b) for a in texts for b in texts if a < b and round(len(grams(a) & grams(b)) / len(grams(a) | grams(b)), 6) >= threshold}
    assert got == want


def test_bulk_resolver_stages(spark):
    officials = spark.createDataFrame([(1, "Bradley Smith"), (2, "Karen R. Brazell"), (3, "Amy Brazell")], "official_id long, canonical_name string")
    alias = spark.createDataFrame([("Brad Smith", 1)], "alias string, official_id long")
    names = spark.createDataFrame([(n,) for n in ["brad smith", "Mayor Brad Smith", "Ceretta Smith", "Councilmember Smith", "A. Brazell", "Brazell", "(illegible)"]], "name string")
    got = {r["name"]: (r.official_id, r.matched_via) for r in E.bulk_resolve(names, alias, officials).collect()}
    assert got["brad smith"] == (1, "alias") and got["Mayor Brad Smith"] == (1, "stripped")
    assert got["Ceretta Smith"] == (None, "none") and got["Councilmember Smith"] == (1, "surname")
    assert got["A. Brazell"] == (3, "surname") and got["Brazell"] == (None, "none") and got["(illegible)"] == (None, "unresolvable")
