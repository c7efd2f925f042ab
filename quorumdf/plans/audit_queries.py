"""Audits: declared constraints of the civic tables, entries of the registry."""

from pyspark.sql import functions as F

from quorumdf.operators import registry_audit as A
from quorumdf.operators.constraints import Rules, violations

from .registry import query

DECLARED = {
    "jurisdiction": Rules(("jurisdiction_id",), ("jurisdiction_id", "display_name", "state_abbr"), unique=(("jurisdiction_id",),)),
    "governing_body": Rules(("body_id",), ("body_id", "body_name"), {"body_type": ("city_council", "county_board", "school_board", "planning_commission", "water_board", "other")}, (("jurisdiction_id", "body_name"),), {("jurisdiction_id",): ("jurisdiction", ("jurisdiction_id",))}),
    "named_official": Rules(("official_id",), ("official_id", "canonical_name"), unique=(("official_id",), ("canonical_name",)), refers={("body_id",): ("governing_body", ("body_id",))}),
    "official_alias": Rules(("official_id", "alias"), ("alias",), unique=(("official_id", "alias"), ("alias",)), refers={("official_id",): ("named_official", ("official_id",))}),
    "meeting": Rules(("meeting_id",), ("meeting_date", "posted_date"), unique=(("meeting_id",), ("body_id", "meeting_date")), refers={("body_id",): ("governing_body", ("body_id",))}, checks={"posted before the meeting": "posted_date < meeting_date"}),
    "motion": Rules(("motion_id",), ("title", "petitioner", "tally_yes"), {"motion_type": ("ordinance", "resolution", "zoning_change", "budget_amendment", "appointment", "contract_approval", "procedural", "other"), "outcome": ("passed", "failed", "tabled", "withdrawn", "no_action")}, (("motion_id",),), {("meeting_id",): ("meeting", ("meeting_id",))}, {"title of three letters": "length(title) >= 3"}),
    "vote": Rules(("motion_id", "official_id"), ("vote_value",), {"vote_value": ("yes", "no", "abstain", "absent", "not_eligible", "conflict_recusal")}, (("official_id", "motion_id"),), {("motion_id",): ("motion", ("motion_id",)), ("official_id",): ("official", ("official_id",))}),
    "term": Rules(("term_id",), ("start_date",), unique=(("term_id",), ("official_id", "start_date")), refers={("official_id",): ("official", ("official_id",))}, checks={"end after start": "end_date > start_date"}),
    "property_record": Rules(("official_id", "parcel_id", "assessment_year"), ("value_cents",), unique=(("official_id", "parcel_id", "assessment_year"),), refers={("official_id",): ("official", ("official_id",))}),
    "petition": Rules(("motion_id",), ("recommender",), {"data_status": ("clean", "repairing", "disputed")}),
    "issue_event": Rules(("event_id",), ("jurisdiction_id", "dedupe_key"), unique=(("jurisdiction_id", "dedupe_key"),), refers={("jurisdiction_id",): ("jurisdiction", ("jurisdiction_id",))}),
    "comment_event": Rules(("comment_id",), ("user_id",), {"stance": ("support", "oppose", "neutral")}, (("comment_id",),), {("item_id",): ("agenda_item", ("item_id",))}),
    "delivery_event": Rules(("event_id",), ("email",), {"event_type": ("email.delivered", "email.bounced", "email.complained")}, (("event_id",),)),
}


def _null(table, key, *columns):
    return [f"SELECT '{table}' AS tbl, 'not_null({c})' AS rule, {key} AS row_key, NULL AS value FROM {table} WHERE {c} IS NULL" for c in columns]


_SQL = " UNION ALL ".join(
    _null("jurisdiction", "jurisdiction_id::VARCHAR", "jurisdiction_id", "display_name", "state_abbr") + _null("governing_body", "body_id::VARCHAR", "body_id", "body_name") + _null("named_official", "official_id::VARCHAR", "official_id", "canonical_name")
    + _null("meeting", "meeting_id::VARCHAR", "meeting_date", "posted_date") + _null("motion", "motion_id::VARCHAR", "title", "petitioner", "tally_yes") + _null("term", "term_id::VARCHAR", "start_date") + _null("petition", "motion_id::VARCHAR", "recommender")
    + _null("issue_event", "event_id::VARCHAR", "jurisdiction_id", "dedupe_key") + _null("comment_event", "comment_id::VARCHAR", "user_id") + _null("delivery_event", "event_id::VARCHAR", "email")
    + [
        "SELECT 'governing_body', 'one_of(body_type)', body_id::VARCHAR, body_type FROM governing_body WHERE body_type = 'county_commission'",
        "SELECT 'motion', 'one_of(outcome)', motion_id::VARCHAR, outcome FROM motion WHERE outcome NOT IN ('passed', 'failed', 'tabled', 'withdrawn', 'no_action')",
        "SELECT 'motion', 'check(title of three letters)', motion_id::VARCHAR, NULL FROM motion WHERE length(title) < 3",
        "SELECT 'meeting', 'check(posted before the meeting)', meeting_id::VARCHAR, NULL FROM meeting WHERE posted_date >= meeting_date",
        "SELECT 'term', 'check(end after start)', term_id::VARCHAR, NULL FROM term WHERE end_date <= start_date",
        "SELECT 'comment_event', 'one_of(stance)', comment_id::VARCHAR, stance FROM comment_event WHERE stance NOT IN ('support', 'oppose', 'neutral')",
        "SELECT 'delivery_event', 'one_of(event_type)', event_id::VARCHAR, event_type FROM delivery_event WHERE event_type = 'email.opened'",
        "SELECT 'named_official', 'unique(canonical_name)', canonical_name, count(*)::VARCHAR FROM named_official GROUP BY canonical_name HAVING count(*) > 1",
        "SELECT 'official_alias', 'unique(official_id,alias)', official_id || ',' || alias, count(*)::VARCHAR FROM official_alias GROUP BY official_id, alias HAVING count(*) > 1",
        "SELECT 'official_alias', 'unique(alias)', alias, count(*)::VARCHAR FROM official_alias GROUP BY alias HAVING count(*) > 1",
        "SELECT 'meeting', 'unique(body_id,meeting_date)', body_id || ',' || meeting_date, count(*)::VARCHAR FROM meeting GROUP BY body_id, meeting_date HAVING count(*) > 1",
        "SELECT 'motion', 'unique(motion_id)', motion_id::VARCHAR, count(*)::VARCHAR FROM motion GROUP BY motion_id HAVING count(*) > 1",
        "SELECT 'term', 'unique(official_id,start_date)', official_id || ',' || start_date, count(*)::VARCHAR FROM term GROUP BY official_id, start_date HAVING count(*) > 1",
        "SELECT 'issue_event', 'unique(jurisdiction_id,dedupe_key)', jurisdiction_id || ',' || dedupe_key, count(*)::VARCHAR FROM issue_event WHERE jurisdiction_id IS NOT NULL AND dedupe_key IS NOT NULL GROUP BY jurisdiction_id, dedupe_key HAVING count(*) > 1",
        "SELECT 'motion', 'refers(meeting_id->meeting)', motion_id::VARCHAR, meeting_id::VARCHAR FROM motion WHERE meeting_id NOT IN (SELECT meeting_id FROM meeting)",
        "SELECT 'vote', 'refers(motion_id->motion)', motion_id || ',' || official_id, motion_id::VARCHAR FROM vote WHERE motion_id NOT IN (SELECT motion_id FROM motion)",
        "SELECT 'comment_event', 'refers(item_id->agenda_item)', comment_id::VARCHAR, item_id::VARCHAR FROM comment_event WHERE item_id NOT IN (SELECT item_id FROM agenda_item)",
    ]
)


@query("n01b_constraint_violations", _SQL)
def n01b(c):
    names = {*DECLARED, *(target for rules in DECLARED.values() for target, _ in rules.refers.values())}
    return violations({name: getattr(c, name) for name in names}, DECLARED)


VOCABULARIES = {
    "agenda_platform": ["civicplus", "granicus", "none_found"], "clerk_email_access": ["published", "form_only", "none_found"], "confidence": ["high", "medium", "low"],
    "verified": ["verified", "draft"], "public_comment_channel": ["email", "form", "in_person_only", "none_found"],
}

#: An entry's fields by JSON functions, its claims, and whether each attestation is there.
_ENTRY = r"""j AS (SELECT entry_id, TRY_CAST(entry AS JSON) AS e FROM registry_entry),
f AS (SELECT entry_id, e, e ->> '$.agenda_platform' AS ap, e ->> '$.clerk_email_access' AS ce, e ->> '$.confidence' AS co, e ->> '$.verified' AS ve, e ->> '$.public_comment.channel' AS ch, e ->> '$.verification.search_pass.queries[*]' AS qs, e ->> '$.verification.structure_sweep.sections_enumerated[*]' AS ss FROM j),
k AS (SELECT *, CASE WHEN e IS NULL THEN [] ELSE list_filter([CASE WHEN ap = 'none_found' THEN 'agenda_platform=none_found' END, CASE WHEN ce = 'none_found' THEN 'clerk_email_access=none_found' END,
 CASE WHEN coalesce(e ->> '$.records_custodian_email', '') = '' THEN 'records_custodian_email is null' END, CASE WHEN ch IN ('none_found', 'in_person_only') THEN 'public_comment.channel=' || ch END,
 CASE WHEN coalesce(e ->> '$.public_comment.recipient_email', '') = '' THEN 'public_comment.recipient_email is null' END,
 CASE WHEN list_contains(coalesce(e ->> '$.notable_gaps[*]', []), 'Minutes not  published since May') THEN 'notable_gaps: Minutes not  published since May' END], lambda x: x IS NOT NULL) END AS claims FROM f)"""
_RULES = [
    ("readable", "e IS NULL"), ("vocabulary(agenda_platform)", "ap = 'carrier pigeon'"), ("vocabulary(confidence)", "co = 'sure'"), ("vocabulary(public_comment.channel)", "ch = 'fax'"),
    ("structure_sweep", "len(claims) > 0 AND (len(coalesce(ss, [])) = 0 OR list_contains(ss, 'agendas'))"), ("search_pass", "len(claims) > 0 AND len(coalesce(qs, [])) < 3"),
    ("document_query", "len(claims) > 0 AND len(coalesce(qs, [])) >= 3 AND NOT regexp_matches(array_to_string(qs, '|'), 'agenda|minutes', 'i')"), ("channel_query", "len(claims) > 0 AND len(coalesce(qs, [])) >= 3 AND NOT regexp_matches(array_to_string(qs, '|'), 'comment|records|custodian|email|clerk', 'i')"),
    ("search_engine", "len(claims) > 0 AND len(coalesce(qs, [])) >= 3 AND (e ->> '$.verification.search_pass.engine') IS NULL"), ("sibling_control", "len(claims) > 0 AND trim(coalesce(e ->> '$.verification.sibling_control', '')) = ''"),
    ("adversarial", "len(claims) > 0 AND co = 'high' AND (e ->> '$.verification.adversarial') IS NULL"), ("session_date", "len(claims) > 0 AND ve = 'verified' AND (e ->> '$.verification.session_date') IS NULL"),
]
_BROKEN = " UNION ALL ".join(f"SELECT entry_id, '{rule}' AS rule FROM k WHERE {condition}" for rule, condition in _RULES)


@query("x26_absence_claims", f"WITH {_ENTRY} SELECT entry_id, len(claims)::INT AS n_claims, array_to_string(claims, ' | ') AS claims FROM k")
def x26(c):
    return A.audited(c.registry_entry, VOCABULARIES).select("entry_id", F.size("claims").alias("n_claims"), F.array_join("claims", " | ").alias("claims"))


@query("n02b_registry_violations", f"WITH {_ENTRY} {_BROKEN}")
def n02b(c):
    return A.violations(A.audited(c.registry_entry, VOCABULARIES), "entry_id")


@query("n02c_registry_totals", f"WITH {_ENTRY}, b AS ({_BROKEN}), n AS (SELECT k.entry_id, len(claims) AS n_claims, k.entry_id IN (SELECT entry_id FROM b) AS bad FROM k) SELECT count(*) AS n, count(*) FILTER (WHERE NOT bad) AS passed, count(*) FILTER (WHERE bad) AS failed, sum(n_claims)::BIGINT AS n_claims FROM n")
def n02c(c):
    return A.totals(A.audited(c.registry_entry, VOCABULARIES))
