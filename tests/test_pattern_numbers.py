"""Findings that are alike are staged as one row with their number, and read as so many rows."""

from collections import Counter

from test_similarity_lists import pairs

from quorumdf.operators import pattern_runs as P
from quorumdf.operators.snapshots import Snapshots


class Tables:
    def __init__(self, **tables):
        self.__dict__.update(tables)


def test_findings_of_like_names_are_staged_as_numbers(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(P, "PIECE", 7)
    names = [("City Clerk " if i % 9 == 0 else "") + f"Supplier#{i:09d}" for i in range(60)]
    official = spark.createDataFrame(list(enumerate(names)), "official_id long, canonical_name string")
    one = spark.createDataFrame([(3, 2), (3, 2)], "motion_id long, severity int")
    found = {"typos": lambda c: P.as_findings(P.name_typos(c.official), "typos"), "extra": lambda c: P.as_findings(one, "extra")}
    s = Snapshots(spark, str(tmp_path))
    assert P.run_patterns(Tables(official=official), s, 0, found, {}) == []
    want = Counter()
    for i, _, likeness, _ in pairs([n.lower() for n in names], 0.4, 0.5):
        want["typos", 3 if likeness > 0.7 else 2 if likeness > 0.5 else 1, None, i, None, None] += 1
    want["extra", 2, 3, None, None, None] = 2
    rows = P.findings(s)
    assert ", ".join(f"{c} {t.replace('bigint', 'long')}" for c, t in rows.dtypes) == P.FINDING
    assert Counter(map(tuple, rows.collect())) == want and max(want.values()) > 3 * 7
    staged = spark.read.parquet(*s.latest()[1]["finding-typos"])
    assert staged.count() <= 3 * len(names) < sum(want.values()) / 3
    # nothing found, and nothing published
    assert P.run_patterns(Tables(official=official.limit(0)), s, 1, found, {}) == []
    assert P.findings(s).count() == 2
