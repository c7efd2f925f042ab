"""Runs of patterns, merges over all tables, names within texts: on small tables, against plain loops."""

import random

import pytest

from quorumdf.functions.automaton import Automaton
from quorumdf.operators import detectors as D
from quorumdf.operators import pattern_runs as P
from quorumdf.operators import resolution as E
from quorumdf.operators.snapshots import Snapshots


class Tables:
    def __init__(self, **tables):
        self.__dict__.update(tables)


@pytest.fixture
def civic(spark):
    motion = spark.createDataFrame([(1, "Ok", "staff", 1, 0, 0), (2, "Rezoning of the old mill", "Ann Lee", 2, 1, 0), (3, "A", None, None, 0, 0)], "motion_id long, title string, petitioner string, tally_yes int, tally_no int, tally_abstain int")
    vote = spark.createDataFrame([(1, 5), (2, 5), (2, 6)], "motion_id long, official_id long")
    return Tables(motion=motion, vote=vote, spark=spark)


def kinds(snapshots):
    return sorted((r.pattern_id, r.motion_id) for r in P.findings(snapshots).collect())


def test_patterns_are_replaced_one_by_one(spark, civic, tmp_path):
    s = Snapshots(spark, str(tmp_path))
    one = spark.createDataFrame([(7, 2)], "motion_id long, severity int")
    found = lambda rows: lambda c: P.as_findings(rows, "extra")
    base = [("qa_generic_petitioner", 1), ("qa_short_motion_title", 1), ("qa_short_motion_title", 3), ("qa_tally_mismatch", 2)]
    assert P.run_patterns(civic, s, 0, {"extra": found(one), "other": found(one)}) == []
    assert kinds(s) == sorted([*base, ("extra", 7), ("extra", 7)])
    # one fails and keeps its findings, one finds nothing any more and is cleared
    assert P.run_patterns(civic, s, 1, {"extra": lambda c: c.nothing, "other": found(one.limit(0))}) == ["extra"]
    assert kinds(s) == sorted([*base, ("extra", 7)])
    # the shared scan fails for one of its patterns: the others run alone
    marks = {"qa_short_motion_title": D.MOTION_DETECTORS["qa_short_motion_title"], "qa_tally_mismatch": (lambda: 1 / 0, 2)}
    assert P.run_patterns(civic, s, 2, {}, marks) == ["qa_tally_mismatch"]
    assert kinds(s) == sorted([*base, ("extra", 7)])
    assert kinds(Snapshots(spark, str(tmp_path / "new"))) == []


def test_merges_reach_every_table(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    mapping = E.merge_mapping(spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "a long, b long"))
    vote = spark.createDataFrame([(10, 1, "yes"), (10, 2, "no"), (11, 3, "no"), (11, 2, "yes"), (12, 6, "yes"), (12, 9, "no")], "motion_id long, official_id long, vote_value string")
    term = spark.createDataFrame([(100, 3), (101, 1), (102, 9)], "term_id long, official_id long")
    alias = spark.createDataFrame([(1, "Ann Lee", "m"), (2, "Ann Lee", "x"), (2, "A. Lee", "m"), (3, "A. Lee", "y"), (9, "Bo", "m")], "official_id long, alias string, source string")
    official = spark.createDataFrame([(1, "Ann Lee"), (2, "Anne Lee"), (3, "Ann Lee"), (5, "Cy"), (6, "Cy R"), (9, "Bo")], "official_id long, canonical_name string")
    got = {k: sorted(map(tuple, v.collect())) for k, v in E.merged_tables(vote, term, alias, official, mapping).items()}
    assert got["vote"] == [(10, 1, "yes"), (11, 1, "yes"), (12, 5, "yes"), (12, 9, "no")]
    assert got["term"] == [(100, 1), (101, 1), (102, 9)]
    assert got["alias"] == [(1, "A. Lee", "m"), (1, "Ann Lee", "m"), (1, "Anne Lee", E.MERGE_SOURCE), (5, "Cy R", E.MERGE_SOURCE), (9, "Bo", "m")]
    assert got["official"] == [(1, "Ann Lee"), (5, "Cy"), (9, "Bo")]


def test_automaton_equals_a_search_for_each_word():
    rnd = random.Random(3)
    for _ in range(60):
        words = ["".join(rnd.choice("abé\U0001f0a1") for _ in range(rnd.randint(0, 4))) for _ in range(rnd.randint(0, 9))]
        texts = ["".join(rnd.choice("abéx\U0001f0a1") for _ in range(rnd.randint(0, 18))) for _ in range(rnd.randint(0, 20))]
        a = Automaton(words)
        assert {(i, a.words[k]) for i, k in zip(*a.found(texts))} == {(i, w) for i, t in enumerate(texts) for w in words if w and w in t}


def test_names_within_texts_by_either_way(spark, monkeypatch):
    monkeypatch.setattr(E, "TABLE_LETTERS", 12)  # several automata
    rnd = random.Random(4)
    names = ["".join(rnd.choice("ab ") for _ in range(rnd.randint(1, 11))) for _ in range(40)] + [None, ""]
    texts = ["".join(rnd.choice("ab ") for _ in range(rnd.randint(0, 40))) for _ in range(60)] + [None, "", names[0]]
    t, n = spark.createDataFrame([(x,) for x in texts], "line string"), spark.createDataFrame([(x,) for x in names], "name string")
    want = {(x, w) for x in texts for w in names if x and w and w in x}
    for df in (E.contained(t, "line", n, "name"), E.contained(t, "line", n, "name", most=0), E.contained_by_grams(t, "line", n, "name", gram=3)):
        rows = [tuple(r) for r in df.collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want
    assert E.contained(t.limit(0), "line", n, "name").collect() == [] and E.contained(t, "line", n.limit(0), "name").collect() == []


def test_petitioner_shapes(spark):
    official = spark.createDataFrame([(1, "Ann Lee", "Lee", True), (2, "Bo Day", "Day", False), (3, "Cy O'Neil", None, True)], "official_id long, canonical_name string, last_name string, is_elected boolean")
    said = ["ann lee", "Ann Lee Jones Corp", "Councilmember Lee", "councilmember leeson", "Councilmember Ann Lee", "Mayor Pro Tem Ann Lee, D3", "MAYOR ANN LEE", "Mayor Lee", "Commissioner Ann Lee", "Lee", "Bo Day", "Councilmember Day", "Mayor Cy O'Neil", None]
    motion = spark.createDataFrame([(i, s, "clean") for i, s in enumerate(said)] + [(99, "Ann Lee", "disputed")], "motion_id long, petitioner string, data_status string")
    assert sorted(map(tuple, D.elected_petitioners(motion, official).collect())) == [(0, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 1), (12, 3)]
    staff = motion.withColumnRenamed("petitioner", "recommender")
    long = spark.createDataFrame([(1, "Ann Lee Jones", "Jones", True)], official.schema)
    assert sorted(map(tuple, D.elected_recommenders(staff, long).collect())) == [(1, 1)]


def test_quarantine_runs_no_pattern_of_officials(spark, monkeypatch):
    from quorumdf.operators import pattern_runs as P
    from quorumdf.plans import queries

    def fails(c):
        raise AssertionError("not a pattern of motions")

    for name in set(P.PATTERNS) - {"qa_official_as_petitioner", "qa_official_as_staff_recommender"}:
        monkeypatch.setitem(P.PATTERNS, name, fails)
    assert len(queries()["d16b_quarantine_counts"](spark, "/root/testdata/sf0.001").collect()) == 1
