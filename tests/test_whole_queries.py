"""Queries over all rows, on fixtures that the cut ones get wrong."""

import itertools
import re
from datetime import date
from types import SimpleNamespace

from quorumdf import plans, views
from quorumdf.operators import observers as O
from quorumdf.plans import whole_queries as W


def test_budget_overdue_reads_odd_ids_and_waits_fourteen_months(spark):
    motions = [(b, i, date(2001, 1, 1).replace(year=y, month=m), "passed", "Adopt annual budget") for b, i, y, m in [
        (1, 2, 1998, 1), (1, 4, 1999, 1), (1, 5, 2001, 6),  # adopted lately, under an odd id
        (2, 6, 1999, 1), (2, 8, 2000, 9),  # a year ago
        (3, 7, 1998, 1), (3, 9, 2000, 1),  # 20 months ago, odd ids alone
    ]]
    motion = spark.createDataFrame(motions, "body_id int, motion_id int, motion_date date, outcome string, title string")
    meetings = [(b, date(2001, m, 20), "x") for b in (1, 2, 3) for m in (6, 7, 8)]
    meeting = spark.createDataFrame(meetings, "body_id int, meeting_date date, minutes_url string")
    got = O.budget_overdue(motion, meeting, "2001-09-01").collect()
    assert [(r.body_id, r.years, r.last_adopted, r.later) for r in got] == [(3, 2, date(2000, 1, 1), 3)]


def civic(spark):
    return SimpleNamespace(
        as_of="2001-09-01",
        governing_body=spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "body_id int, jurisdiction_id int"),
        official=spark.createDataFrame([(1, 1), (2, 2), (5, 3)], "official_id int, body_id int"),
        term=spark.createDataFrame([(1, None), (2, date(2000, 1, 1))], "official_id int, end_date date"),
        contribution=spark.createDataFrame([(1, "pac", date(2000, 1, 1)), (5, "pac", date(2000, 1, 1))], "official_id int, contributor_type string, received date"),
    )


def test_members_and_gifts_of_any_id_count(spark):
    c = civic(spark)
    assert sorted(r.body_id for r in W.c04(c).collect()) == [2, 3]
    assert sorted(r.body_id for r in O.OBSERVERS["member_roster_missing"](c).collect()) == [2, 3]
    assert [(r.body_id, r.members) for r in W.c05(c).collect()] == [(2, 1)]


def test_whole_queries_are_registered_and_run(spark):
    names = [n for n in plans.queries() if n.startswith("c0") and n.endswith("_whole")]
    assert len(names) == 4 and not set(names) & set(plans.oracle_sql())
    c = views.Civic(spark, "/root/testdata/sf0.001")
    assert W.c08(c).count() >= 0 and W.c07(c).count() >= 0


def test_names_and_motions_of_any_id_are_searched(spark):
    names = ["Ann Marie Miller", "Ann Marie Muller", "Bob Stone", "Customer#0000015", "Customer#0000016"]
    customer = spark.createDataFrame(list(enumerate(names, 1)), "c_custkey long, c_name string")
    pets = ["Mayor Ann Marie Miller of Rome", "bob stone", "City Manager for Ann Marie Muller", "City Manager Bob Stone", None, "someone"]
    motion = spark.createDataFrame([(i, i % 2, p, "ordinance" if i == 3 else "resolution") for i, p in enumerate(pets, 1)], "motion_id long, body_id int, petitioner string, motion_type string")
    official = spark.createDataFrame([(1, "Supplier#0000015"), (2, "Bob Stones")], "official_id long, canonical_name string")
    c = SimpleNamespace(customer=customer, motion=motion, official=official)

    def grams(text):
        return {f"  {w} "[i : i + 3] for w in re.findall("[a-z0-9]+", text.lower()) for i in range(len(w) + 1)}

    def alike(a, b):
        x, y = grams(a), grams(b)
        return round(len(x & y) / len(x | y), 6)

    pairs = [(i, j, alike(a, b)) for (i, a), (j, b) in itertools.combinations(enumerate(names, 1), 2)]
    assert sorted(map(tuple, W.e03b(c).collect())) == [p for p in pairs if p[2] >= 0.75] != []
    ranked = {n: sorted((-s, i) for i, o in ((1, "Supplier#0000015"), (2, "Bob Stones")) if (s := alike(n.replace("Customer", "Supplier"), o)) >= 0.65) for n in names}
    assert sorted((r.name, r.rn, r.official_id, r.similarity) for r in W.e04(c).collect()) == sorted((n, k, i, -s) for n, found in ranked.items() for k, (s, i) in enumerate(found, 1))
    titles = ["", "city manager ", "mayor ", "councilmember ", "commissioner "]
    starts = [(m, k) for m, p in enumerate(pets, 1) for k, n in enumerate(names, 1) if p and any(p.lower().startswith(t + n.lower()) for t in titles)]
    assert sorted(map(tuple, W.d11(c).collect())) == starts != []
    inside = [(m, k) for m, p in enumerate(pets, 1) for k, n in enumerate(names, 1) if p and p.startswith("City Manager ") and n.lower() in p.lower()]
    assert sorted(map(tuple, W.d12(c).collect())) == inside != []
    assert sorted(map(tuple, W.f06(c).collect())) == [(0, False), (1, True)]


def test_digest_lines_have_whole_bodies(spark):
    rows = [(1, 10, "user", "oppose", "x" * 500), (1, 11, "user", "support", "no"), (2, 12, "clerk", "neutral", "y")]
    c = SimpleNamespace(citizen_comment=spark.createDataFrame(rows, "item_id int, comment_id int, role string, stance string, text string"))
    assert sorted(map(tuple, W.m04(c).collect())) == [(1, 10, "oppose: " + "x" * 500), (1, 11, "support: no")]
    assert sorted(map(tuple, W.m04_tallies(c).collect())) == [(1, 1, 1, 0)]


def test_linked_failures_are_not_gathered():
    import inspect

    from quorumdf.plans import facts_queries

    assert "collect_list" not in inspect.getsource(facts_queries.h08)
