"""Audits of constraints and registry entries on literal fixtures."""

import json

from quorumdf.operators import registry_audit as A
from quorumdf.operators.constraints import Rules, violations


def test_one_row_per_violation(spark):
    a = spark.createDataFrame([(1, "x", 5), (2, None, 6), (3, "z", None), (3, "x", 9), (None, "y", 7)], "id int, kind string, ref int")
    b = spark.createDataFrame([(5, 1), (7, 1), (7, 2), (None, 3)], "key int, n int")
    declared = {"a": Rules(("id",), ("id", "kind"), {"kind": ("x", "y")}, (("id",), ("id", "ref")), {("ref",): ("b", ("key",))}, {"small": "ref < 9"}), "b": Rules(("key", "n"), unique=(("key",), ("key", "n")))}
    got = sorted(tuple(r) for r in violations({"a": a, "b": b}, declared).na.fill("-").collect())
    assert got == [
        ("a", "check(small)", "3", "-"), ("a", "not_null(id)", "null", "-"), ("a", "not_null(kind)", "2", "-"), ("a", "one_of(kind)", "3", "z"),
        ("a", "refers(ref->b)", "2", "6"), ("a", "refers(ref->b)", "3", "9"), ("a", "unique(id)", "3", "2"), ("b", "unique(key)", "7", "2"),
    ]


def test_references_of_several_columns_and_empty_tables(spark):
    child = spark.createDataFrame([(1, 1, 2), (2, 1, 3), (3, None, 3)], "id int, p int, q int")
    parent = spark.createDataFrame([(1, 2)], "x int, y int")
    declared = {"child": Rules(("id",), ("p",), refers={("p", "q"): ("parent", ("x", "y"))}), "parent": Rules(("x",), unique=(("x",),))}
    got = sorted(tuple(r) for r in violations({"child": child, "parent": parent}, declared).collect())
    assert got == [("child", "not_null(p)", "3", None), ("child", "refers(p,q->parent)", "2", "1,3")]
    assert violations({"child": child.limit(0), "parent": parent}, declared).collect() == []
    assert violations({"child": child, "parent": parent.limit(0)}, declared).filter("rule like 'refers%'").count() == 2


SOUND = {
    "agenda_platform": "none_found", "clerk_email_access": "published", "records_custodian_email": "r@x.example", "confidence": "medium", "verified": "draft", "public_comment": {"channel": "email", "recipient_email": "c@x.example"},
    "verification": {"structure_sweep": {"sections_enumerated": ["http://x.example/a"]}, "search_pass": {"queries": ["town agenda", "clerk", "map"], "engine": "web"}, "sibling_control": "minutes parse"},
}
WORDS = {"agenda_platform": ["none_found", "granicus"], "public_comment_channel": ["email", "in_person_only"]}


def entry(**changes):
    return json.dumps({**SOUND, **changes})


def attested(**changes):
    return entry(verification={**SOUND["verification"], **changes})


def test_rules_of_registry_entries(spark):
    cases = [
        (entry(), []), (entry(agenda_platform="granicus", verification=None), []), (entry(agenda_platform="fax"), ["vocabulary(agenda_platform)"]), (entry(confidence="whatever"), []),
        (entry(public_comment={"channel": "fax", "recipient_email": "c"}), ["vocabulary(public_comment.channel)"]), (entry(public_comment="by mail"), []), ("[]", ["readable"]), (None, ["readable"]),
        (attested(structure_sweep={"sections_enumerated": []}), ["structure_sweep"]), (attested(structure_sweep={"sections_enumerated": ["http://a", 7]}), ["structure_sweep"]), (attested(structure_sweep=None), ["structure_sweep"]),
        (attested(search_pass={"queries": ["agenda", "clerk"]}), ["search_pass"]), (attested(search_pass={"queries": ["a", "b", "Minutes"], "engine": "w"}), ["channel_query"]), (attested(search_pass={"queries": ["a", "b", "EMAIL"]}), ["document_query", "search_engine"]),
        (attested(sibling_control=" "), ["sibling_control"]), (entry(confidence="high"), ["adversarial"]), (entry(verified="verified"), ["session_date"]), (entry(verification=None), ["structure_sweep", "search_pass", "sibling_control"]),
    ]
    df = spark.createDataFrame([(i, c, "x") for i, (c, _) in enumerate(cases)], "id int, entry string, claims string")
    audit = A.audited(df, WORDS)
    assert {r.id: r.errors for r in audit.collect()} == {i: errors for i, (_, errors) in enumerate(cases)}
    assert {r.id for r in A.violations(A.audited(df, WORDS, strict=False), "id").collect()} == {2, 4, 6, 7}
    failed = sum(bool(errors) for _, errors in cases)
    assert A.totals(audit).select("n", "passed", "failed").first() == (len(cases), len(cases) - failed, failed)
    assert A.totals(audit.limit(0)).first() == (0, 0, 0, 0)


def test_claims_of_absence(spark):
    long = "Agendas are not   posted " + "x" * 90
    cases = [
        (entry(), ["agenda_platform=none_found"]), (entry(agenda_platform=None), []), (entry(clerk_email_access="none_found", records_custodian_email=""), ["agenda_platform=none_found", "clerk_email_access=none_found", "records_custodian_email is null"]),
        (entry(public_comment=None), ["agenda_platform=none_found", "public_comment.recipient_email is null"]), (entry(public_comment={"channel": "in_person_only"}), ["agenda_platform=none_found", "public_comment.channel=in_person_only", "public_comment.recipient_email is null"]),
        (entry(agenda_platform="x", notable_gaps=[long, 5, "no online minutes", "fine", None, "Empty page"]), ["notable_gaps: " + long[:80], "notable_gaps: no online minutes", "notable_gaps: Empty page"]),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "id int, entry string")
    assert {r.id: r.claims for r in A.audited(df, {}).collect()} == {i: found for i, (_, found) in enumerate(cases)}


def test_entries_are_parsed_once(spark):
    entries = spark.createDataFrame([(1, '{"confidence":"sure","notable_gaps":["none published"]}'), (2, "no JSON"), (3, None)], "entry_id long, entry string")
    broken = A.violations(A.audited(entries, {"confidence": ["high"]}, strict=False), "entry_id")
    assert sorted((r.entry_id, r.rule) for r in broken.collect()) == [(1, "vocabulary(confidence)"), (2, "readable"), (3, "readable")]
    plan = A.violations(A.audited(entries, {"confidence": ["high"]}), "entry_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1
