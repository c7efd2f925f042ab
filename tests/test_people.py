"""Stages of name resolution, repairs and syncs on small tables, with nulls, ties and empty inputs."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from quorumdf.functions import names as N
from quorumdf.operators import facts as R
from quorumdf.operators import health as H
from quorumdf.operators import observers as O
from quorumdf.operators import people as P
from quorumdf.operators import resolution as E

D = date(2001, 5, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def town(spark):
    officials = [(1, "Bradley", "Smith", 1), (2, "Ceretta", "Smith", 1), (3, "William", "Jones", 1), (4, "Ann", "Lee", 1), (5, "Bo", "Lee", 1), (6, "Carl", "Vogelsang", 2), (7, None, "Hand", None)]
    o = spark.createDataFrame(officials, "official_id long, first_name string, last_name string, jurisdiction_id long").withColumn("canonical_name", F.concat_ws(" ", "first_name", "last_name"))
    terms = [(1, 10, date(2000, 1, 1), None), (2, 20, date(1990, 1, 1), date(1995, 1, 1)), (3, 30, date(1990, 1, 1), date(1991, 1, 1)), (4, 40, date(2000, 1, 1), None), (5, 50, date(2000, 1, 1), None), (6, 60, date(2000, 1, 1), None)]
    t = spark.createDataFrame(terms, "official_id long, term_id long, start_date date, end_date date")
    a = spark.createDataFrame([(1, "Brad Smith"), (3, "Mayor Pro-Tem Jones Sr")], "official_id long, alias string")
    return o, a, t


def test_resolver_takes_stages_in_order(spark, town):
    o, a, t = town
    names = ["brad SMITH", "Mayor Brad Smith", "Mr. Smith", "Bill Jones", "A. Lee", "Lee", "Carl Vogelsan", "Nobody Here", None, ""]
    asked = spark.createDataFrame([(n, 1, D) for n in names] + [("Carl Vogelsan", 2, D)], "name string, jurisdiction_id long, as_of date")
    got = {(r.name, r.jurisdiction_id): (r.official_id, r.matched_via) for r in P.resolve_for_meeting(asked.unionAll(asked), o, a, t).collect()}
    assert got == {
        ("brad SMITH", 1): (1, "alias"), ("Mayor Brad Smith", 1): (1, "stripped"), ("Mr. Smith", 1): (1, "surname"),  # the other Smith left in 1995
        ("Bill Jones", 1): (3, "surname"),  # nobody of the name in office: one who once was
        ("A. Lee", 1): (4, "initial"), ("Lee", 1): (None, "ambiguous"), ("Carl Vogelsan", 2): (6, "similar"), ("Carl Vogelsan", 1): (None, "none"),
        ("Nobody Here", 1): (None, "none"), (None, 1): (None, "none"), ("", 1): (None, "none"),
    }
    assert P.resolve_for_meeting(asked.limit(0), o, a, t).count() == 0


def test_aliases_never_contradict_first_names(spark, town):
    o, a, _ = town
    found = [("Ceretta Smith", 1, "surname", D), ("Mr. Smith", 1, "surname", D), ("Mr. SMITH", 2, "surname", date(2000, 1, 1)), ("Brad Smith", 1, "alias", D), ("X", None, "none", D)]
    resolved = spark.createDataFrame(found, "name string, official_id long, matched_via string, as_of date")
    assert rows(P.new_aliases(resolved, o, a)) == [("Mr. SMITH", 2)]


def test_bare_surnames_mean_holders_alone(spark, town):
    o, a, t = town
    names = spark.createDataFrame([("Hand",), ("Jones",), ("Smith",), ("Zoe Smith",), ("Bill Jones",), ("12",)], "name string")
    got = {r.name: r.official_id for r in E.bulk_resolve(names, a, o, t).collect()}
    assert got == {"Hand": None, "Jones": 3, "Smith": None, "Zoe Smith": None, "Bill Jones": 3, "12": None}


def test_roster_match_stays_on_the_body(spark, town):
    o, a, _ = town
    seats = spark.createDataFrame([(1, 100), (6, 200)], "official_id long, body_id long")
    page = spark.createDataFrame([("Brad Smith", 100), ("Brad Smith", 200), ("Carl Vogelsang Jr", 200), (None, 100)], "name string, body_id long")
    assert rows(P.roster_match(page, o, a, seats))[:3] == sorted([("Brad Smith", 100, 1, "alias"), ("Brad Smith", 200, None, None), ("Carl Vogelsang Jr", 200, 6, "similar")], key=str)


def test_filers_match_first_and_last(spark, town):
    o, a, _ = town
    names = spark.createDataFrame([("Brad Q Smith",), ("CERETTA M. SMITH",), ("Smith",), (None,)], "name string")
    assert {r.name: r.official_id for r in P.filer_match(names, o, a).collect()} == {"Brad Q Smith": 1, "CERETTA M. SMITH": 2, "Smith": None, None: None}


def test_historical_officials(spark, town):
    o, _, _ = town
    names = ["Bradley Smith", "Hon. Bradley T. Smith", "Zelda Smith", "B. Smith", "A. Richard Bowman", "Smith", "illegible (3)", None, "Jo Hand"]
    got = {r.canonical_name: (r.action, r.official_id) for r in P.historical_officials(spark.createDataFrame([(n, 1) for n in names], "name string, jurisdiction_id long"), o).collect()}
    assert got == {"Bradley T. Smith": ("alias", 1), "Zelda Smith": ("create", None), "B. Smith": ("alias", 1), "A. Richard Bowman": ("create", None), "Jo Hand": ("alias", 7)}


def test_backfilled_votes(spark, town):
    _, _, t = town
    item = "struct<title:string,individual_votes:array<struct<name:string,vote:string>>,recusals:array<struct<name:string,reason:string>>>"
    data = [(9, D, 0, ("Sell it ", [("S", None), ("T", "no"), ("S", "no"), ("Q", "yes")], [("T", None)])), (9, D, 1, ("Other", [("S", "yes")], None))]
    items = spark.createDataFrame(data, f"meeting_id long, meeting_date date, pos int, item {item}")
    motions = spark.createDataFrame([(1, 9, "Sell it"), (2, 9, "Sell it")], "motion_id long, meeting_id long, title string")
    resolved = spark.createDataFrame([("S", 1), ("T", 2), ("Q", 4)], "name string, official_id long")
    stored = spark.createDataFrame([(2, 4)], "motion_id long, official_id long")
    assert rows(P.backfill_votes(items, motions, resolved, stored, t)) == [(2, 1, 10, "yes", None), (2, 2, None, "conflict_recusal", "recused (no reason given)")]


def test_staff_stubs_and_entries(spark, town):
    o, _, _ = town
    lines = ["Finance Director Ray Day", "Finance Director Ray Day", "Clerk Ray Day", "Clerk Ray Day", "Mayor Bradley Smith", "Mayor Bradley Smith", "Chief Day", "Chief Day", "Once Only", None, None]
    got = P.staff_stubs(spark.createDataFrame([(x, D) for x in lines], "line string, motion_date date"), o)
    assert rows(got) == [("Ray", "Day", 4, D, D, "Clerk Ray Day; Finance Director Ray Day")]
    texts = spark.createDataFrame([("City Clerk Al Poe",), ("Al Poe",), ("Poe",), ("",), (None,)], "t string")
    assert {r.t: tuple(r.p)[:3] for r in texts.select("t", N.staff_entry(F.col("t")).alias("p")).collect()} == {"City Clerk Al Poe": ("City Clerk", "Al", "Poe"), "Al Poe": (None, "Al", "Poe"), "Poe": (None, None, "Poe"), "": ("Staff", None, ""), None: (None, None, None)}
    ballots = spark.createDataFrame([("Jane Doe (I)",), ("Jo Roe dem.",), ("(D)",), (None,)], "t string")
    assert [r[0] for r in ballots.select(N.clean_candidate(F.col("t"))).collect()] == ["Jane Doe", "Jo Roe", "(D)", None]


def test_staff_sync_spares_the_elected_and_an_empty_page(spark, town):
    staff = spark.createDataFrame([(1, "A B", True, True, "x"), (2, "C D", False, True, "y"), (3, "E F", False, False, None)], "official_id long, canonical_name string, is_elected boolean, is_active boolean, display_title string")
    page = spark.createDataFrame([("E F", "Clerk"), ("New One", "Boss"), ("New One", "Boss")], "name string, title string")
    resolved = spark.createDataFrame([("E F", 3), ("New One", None)], "name string, official_id long")
    got = P.sync_staff(page, resolved, staff)
    assert rows(got) == sorted([(1, "A B", True, True, "x", "kept"), (2, "C D", False, False, "y", "departed"), (3, "E F", False, True, "Clerk", "enriched"), (None, "New One", False, True, "Boss", "created")], key=str)
    assert rows(P.staff_aliases(got)) == [("New One", "Boss New One"), ("New One", "New One")]
    assert {r.action for r in P.sync_staff(page.limit(0), resolved, staff).collect()} == {"kept"}


def test_roster_terms(spark, town):
    _, a, t = town
    terms = t.withColumn("seat_id", F.lit(1)).unionByName(t.filter("official_id = 3").withColumn("seat_id", F.lit(2)))
    roster = spark.createDataFrame([("Brad Smith", 1), ("mayor pro-tem jones sr", 2), ("Brad Smith", 3), ("Who", 1)], "name string, seat_id int")
    got = {(r.name, r.seat_id): (r.official_id, r.term_id, r.action) for r in P.roster_terms(roster, a, terms).collect()}
    assert got == {("Brad Smith", 1): (1, 10, "kept"), ("mayor pro-tem jones sr", 2): (3, 30, "reopened"), ("Brad Smith", 3): (1, None, "inserted"), ("Who", 1): (None, None, "inserted")}


def test_bundles(spark):
    data = [("county", "1", "Dougherty County"), ("county", "2", "Clarke County"), ("city", "3", "Gainesville"), ("school_district", "4", "Dougherty County School District"), ("school_district", "5", "Gainesville City School District"),
            ("school_district", "6", "Dougherty School District"), ("school_district", "7", "Clarke School District 4"), ("school_district", "8", "Odd School District"), ("city", "9", "Athens-Clarke County"), ("city", "10", "Columbus"), ("city", "11", None)]
    df = spark.createDataFrame([("GA", *d) for d in data] + [("SC", "city", "12", "Athens-Clarke County")], "state string, kind string, fips string, name string")
    got = {r.fips: (r.bundle_fips, r.rule) for r in P.bundles(df, {"10": "99"}).collect()}
    assert got == {"3": (None, None), "4": ("1", "county"), "5": ("3", "city"), "6": ("1", "base_county"), "7": ("2", "numbered"), "8": (None, None), "9": ("2", "suffix"), "10": ("99", "consolidated"), "11": (None, None), "12": (None, None)}


def test_orphans_need_evidence(spark, town):
    o, a, t = town
    o = o.withColumn("canonical_name", F.when(F.col("official_id") == 7, "Chief Hand").otherwise(F.col("canonical_name")))
    none = t.select("official_id").limit(0)
    lines = spark.createDataFrame([(1, "Finance Director Vogelsang"), (1, "Mr VOGELSANG"), (2, None)], "meeting_id long, line string")
    flagged = spark.createDataFrame([(1,), (4,), (6,), (7,), (7,)], "official_id long")
    out = R.orphan_removal(flagged, o, t.filter("official_id = 1"), none, lines, a, flagged)
    assert rows(out) == [(1, "kept_in_use", 0, 0, 0), (4, "kept_unconfirmed", 0, 0, 0), (6, "deleted", 1, 0, 1), (7, "deleted", 0, 0, 2)]
    assert sorted(r.official_id for r in R.cascade(flagged, out).collect()) == [1, 4]


def test_observers_fail_alone(spark, tmp_path):
    ok = spark.createDataFrame([(1, "high", 1)], "body_id int, severity string, n int")
    bad = ok.withColumn("n", F.expr("cast(raise_error('broken') as int)"))
    out, failed = O.observe_each(None, str(tmp_path), {"ok": lambda c: ok, "late": lambda c: bad, "early": lambda c: c.nothing})
    assert (failed, [r.category for r in out.collect()]) == (["early", "late"], ["ok"])
    assert O.observe_each(None, str(tmp_path), {"late": lambda c: bad}) == (None, ["late"])


def test_rungs_of_an_empty_town(spark):
    empty = lambda schema: spark.createDataFrame([], schema)
    meeting = empty("meeting_id long, body_id long, meeting_date date, minutes_url string, agenda_url string, minutes_stub boolean, agenda_stub boolean")
    fund = spark.createDataFrame([(1, None, None, None)], "jurisdiction_id long, status string, unlocked boolean, needed_usd double")
    got = H.capability_rungs(empty("body_id long, jurisdiction_id long"), meeting, meeting, meeting, empty("official_id long, body_id long"), empty("body_id long"), empty("body_id long"), fund, "2000-01-01").collect()
    assert [r.key for r in got] == list(H.RUNGS) and {r.state for r in got} == {"needs_funding", "coming_soon"}


def test_item_sentences(spark):
    data = [("budget_overdue", 3, D), ("odd_thing", None, None), ("minutes_missing", 2, D), ("agenda_missing", 1, D)]
    df = spark.createDataFrame(data, "category string, n long, since date")
    assert [r[0] for r in df.select(O.item_sentence(F.col("category"), F.col("n"), F.col("since"))).collect()] == [
        "Adopted budget and budget-adoption records — none on record since May 1, 2001.", "Odd thing.", "Meeting minutes — 2 meetings, May 1, 2001 to present.", "Meeting agendas — none on record since May 1, 2001."
    ]


def test_requests_are_reconciled(spark):
    f = [(1, 1, 10, "a", "open"), (2, 1, 10, "b", "open"), (3, 1, 11, "a", "open"), (4, 2, 20, "a", "open"), (5, 3, 30, "a", "open"), (6, 4, 40, "gone", "open"), (7, 5, 50, "a", "closed")]
    findings = spark.createDataFrame(f, "finding_id long, jurisdiction_id long, body_id long, category string, status string")
    observed = findings.filter("category <> 'gone'").select("body_id", "category")
    q = [(1, "sent", 2, date(2001, 1, 1), [1, 2]), (2, "draft", 3, date(2001, 2, 1), [2, 3]), (3, "closed", 4, date(2001, 3, 1), [1, 2, 3]), (4, "sent", 5, date(2001, 1, 1), [4, 4]), (5, "sent", 6, date(2001, 1, 1), None)]
    requests = spark.createDataFrame(q, "request_id long, status string, tone int, created_at date, finding_ids array<long>")
    assert rows(O.reconcile_requests(findings, observed, requests)) == [(1, 2, "update", 3, [1, 2, 3]), (2, 4, "noop", 5, [4]), (3, None, "create", 1, [5])]
    assert rows(O.reconcile_requests(findings, observed.limit(0), requests)) == []


def test_windows_merge_into_documents(spark):
    item = "array<struct<source_page:bigint,title:string>>"
    data = [(1, 1, 0, None, [(5, "Call"), (2, None)], ["B", "A"]), (1, 2, 4, "Council", [(1, " CALL "), (1, "Vote")], ["A", "C"]), (1, 3, 8, "Other", None, None), (2, 1, 0, None, None, None)]
    windows = spark.createDataFrame(data, f"doc int, win int, page_offset int, body string, items {item}, present array<string>")
    got = {r.doc: (r.body, r.present, [tuple(i) for i in r["items"]]) for r in R.merge_extractions(windows, "doc", "win", ["body"], ["present"]).collect()}
    assert got == {1: ("Council", ["B", "A", "C"], [(2, None), (5, "Call"), (5, "Vote")]), 2: (None, [], [])}


def test_a_surname_without_a_day_is_nobody_in_office(spark, town):
    o, _, t = town
    asked = spark.createDataFrame([("Smith", 1, None), ("Smith", 1, D)], "name string, jurisdiction_id long, as_of date")
    found = P.surname_as_of(asked, o, t)
    assert rows(found.select("as_of", "official_id", "active")) == sorted([(None, 1, False), (None, 2, False), (D, 1, True)], key=str)
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()  # a name meets its officials in one row


@pytest.mark.parametrize("resolve", ["meeting", "bulk"])
def test_names_are_derived_once(spark, town, tmp_path, resolve):
    o, a, t = town
    spark.createDataFrame([("Brad Smith", 1, D), ("Carl Vogelsan", 2, D)], "name string, jurisdiction_id long, as_of date").write.parquet(f"{tmp_path}/minutes-names")
    names = spark.read.parquet(f"{tmp_path}/minutes-names")
    found = P.resolve_for_meeting(names, o, a, t) if resolve == "meeting" else E.bulk_resolve(names, a, o, t)
    assert not [f for f in found.inputFiles() if "minutes-names" in f]
    assert {r.name: r.official_id for r in found.collect()}["Brad Smith"] == 1


def test_backfilled_votes_are_made_once_and_take_the_latest_term(spark, tmp_path):
    item = "meeting_id long, meeting_date date, pos long, item struct<title:string,individual_votes:array<struct<name:string,vote:string>>,recusals:array<struct<name:string,reason:string>>>"
    spark.createDataFrame([(1, D, 0, (" T ", [("Ann", "no"), ("Bo", "yes")], [])), (2, None, 0, ("U", [("Ann", "yes")], None))], item).write.parquet(f"{tmp_path}/old-items")
    motions = spark.createDataFrame([(1, "T", 11), (2, "U", 12)], "meeting_id long, title string, motion_id long")
    resolved = spark.createDataFrame([("Ann", 1), ("Bo", 2)], "name string, official_id long")
    stored = spark.createDataFrame([], "motion_id long, official_id long")
    terms = spark.createDataFrame([(1, 7, date(2000, 1, 1), None), (1, 8, date(2000, 1, 1), D), (1, 9, date(2001, 6, 1), None), (2, 5, date(1990, 1, 1), date(1991, 1, 1))], "official_id long, term_id long, start_date date, end_date date")
    found = P.backfill_votes(spark.read.parquet(f"{tmp_path}/old-items"), motions, resolved, stored, terms)
    assert rows(found) == sorted([(11, 1, 8, "no", None), (11, 2, None, "yes", None), (12, 1, None, "yes", None)], key=str)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("] parquet") == 1
