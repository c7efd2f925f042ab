"""Queries of the observers, the lifecycle and the sinks."""

import uuid

from pyspark.sql import functions as F

from quorumdf.operators import observers as O
from quorumdf.operators import sinks as K
from quorumdf.streaming.jobs import scratch

from .registry import query

AS = "DATE '2001-09-01'"
_SRC = "meta LIKE '%\"minutes_source\"%'"
_UNAV = "meta LIKE '%\"agenda_unavailable\"%'"


def _missing(has, want, grace):
    return f"""SELECT body_id, n, since_date, CASE WHEN n >= 10 THEN 'high' ELSE 'medium' END AS severity FROM (
  SELECT body_id, count(*) AS n, min(meeting_date) AS since_date FROM (
    SELECT *, coalesce(max(CASE WHEN {has} THEN meeting_date END) OVER (PARTITION BY body_id), DATE '1900-01-01') AS mark FROM meeting) a
  WHERE meeting_date > mark AND meeting_date < {AS} - {grace} AND {want} GROUP BY body_id) b WHERE n >= 2"""


MINUTES = _missing(f"(minutes_url IS NOT NULL OR {_SRC})", f"minutes_url IS NULL AND NOT {_SRC} AND NOT {_UNAV}", 45)
AGENDA = _missing("agenda_url IS NOT NULL", f"agenda_url IS NULL AND NOT {_UNAV}", 0)
ROSTER = "SELECT body_id FROM governing_body b WHERE NOT EXISTS (SELECT 1 FROM official o JOIN term t ON o.official_id = t.official_id WHERE t.end_date IS NULL AND o.body_id = b.body_id)"
NOTICE = f"""SELECT *, CASE WHEN shortest < 1 THEN 'high' ELSE 'medium' END AS severity FROM (
 SELECT body_id, count(*) AS n, CAST(min(meeting_date - posted_date) AS INT) AS shortest, min(meeting_date) AS since_date FROM meeting
 WHERE meeting_type = 'regular' AND meeting_date - posted_date BETWEEN 0 AND 2 AND meeting_date >= CAST({AS} - INTERVAL 24 MONTH AS DATE) GROUP BY body_id) a WHERE n >= 2"""
FILINGS = f"""SELECT b.body_id, count(DISTINCT o.official_id) AS n FROM governing_body b JOIN official o ON o.body_id = b.body_id JOIN term t ON t.official_id = o.official_id AND t.end_date IS NULL
 WHERE b.body_type <> 'planning_commission' AND (EXISTS (SELECT 1 FROM data_source d WHERE d.jurisdiction_id = b.jurisdiction_id AND source_type = 'campaign_finance')
  OR b.jurisdiction_id IN (SELECT y.jurisdiction_id FROM finance_filing f JOIN official x ON f.official_id = x.official_id JOIN governing_body y ON x.body_id = y.body_id))
 AND NOT EXISTS (SELECT 1 FROM finance_filing f JOIN official x ON f.official_id = x.official_id JOIN term u ON u.official_id = x.official_id AND u.end_date IS NULL WHERE x.body_id = b.body_id AND f.received >= CAST({AS} - INTERVAL 8 YEAR AS DATE)) GROUP BY 1"""
BUDGETS = f"""WITH p AS (SELECT body_id, count(DISTINCT year(motion_date)) AS years, max(motion_date) AS last_adopted FROM motion
 WHERE outcome = 'passed' AND lower(title) LIKE '%adopt%' AND lower(title) LIKE '%budget%' AND lower(title) NOT LIKE '%amendment%' AND lower(title) NOT LIKE '%adjustment%' GROUP BY 1)
SELECT p.body_id, count(*) AS n FROM p JOIN meeting m ON p.body_id = m.body_id AND m.meeting_date > last_adopted AND minutes_url IS NOT NULL AND m.meeting_date < {AS} JOIN governing_body b ON b.body_id = p.body_id AND b.body_type IN ('city_council', 'county_commission')
WHERE years >= 2 AND last_adopted < CAST({AS} - INTERVAL 14 MONTH AS DATE) GROUP BY 1 HAVING count(*) >= 3"""
OBSERVED = f"""SELECT body_id, severity, n, 'minutes_missing' AS category FROM ({MINUTES}) m UNION ALL SELECT body_id, severity, n, 'agenda_missing' FROM ({AGENDA}) g
 UNION ALL SELECT body_id, severity, n, 'meeting_notice_too_short' FROM ({NOTICE}) x UNION ALL SELECT body_id, 'high', 0, 'member_roster_missing' FROM ({ROSTER}) r
 UNION ALL SELECT body_id, 'high', n, 'campaign_finance_missing' FROM ({FILINGS}) y UNION ALL SELECT body_id, 'medium', n, 'budget_process_missing' FROM ({BUDGETS}) z"""
PRIOR = """SELECT body_id, cat AS category, CASE body_id % 4 WHEN 0 THEN 'open' WHEN 1 THEN 'closed_with_records' WHEN 2 THEN 'records_requested' ELSE 'wont_fix' END AS status, DATE '2000-01-01' + CAST(body_id AS INT) AS opened_at, CASE WHEN body_id % 4 = 1 THEN DATE '2001-02-01' END AS closed_at
 FROM governing_body, (SELECT 'minutes_missing' AS cat UNION ALL SELECT 'agenda_missing' UNION ALL SELECT 'meeting_notice_too_short' UNION ALL SELECT 'campaign_finance_missing' UNION ALL SELECT 'budget_process_missing') c WHERE body_id % 3 <> 0"""


def observed(c):
    """What all observers find, each run for itself, and those that failed."""
    return O.observe_each(c, f"{scratch(c.spark)}/observed-{uuid.uuid4().hex[:12]}")


@query("c02_minutes_missing", MINUTES)
def c02(c):
    return O.minutes_missing(c.meeting, c.as_of)


@query("c03_agenda_missing", AGENDA)
def c03(c):
    return O.agenda_missing(c.meeting, c.as_of)


@query("c04_member_roster_missing", ROSTER)
def c04(c):
    return O.member_roster_missing(c.governing_body, c.official, c.term)


@query("c05_campaign_finance_missing", f"""WITH given AS (SELECT DISTINCT o.body_id, b.jurisdiction_id FROM contribution k JOIN official o ON k.official_id = o.official_id JOIN governing_body b ON b.body_id = o.body_id
 WHERE contributor_type = 'pac' AND received >= CAST({AS} - INTERVAL 96 MONTH AS DATE))
SELECT b.body_id, count(*) AS members FROM governing_body b JOIN official o ON o.body_id = b.body_id WHERE b.jurisdiction_id IN (SELECT jurisdiction_id FROM given) AND b.body_id NOT IN (SELECT body_id FROM given) GROUP BY 1""")
def c05(c):
    return O.campaign_finance_missing(c.governing_body, c.official, c.contribution, c.as_of)


@query("c05b_filings_of_current_members", FILINGS)
def c05b(c):
    return O.finance_filings_missing(c.governing_body, c.official, c.term, c.finance_filing, c.data_source, c.as_of)


@query("c06_notice_too_short", NOTICE)
def c06(c):
    return O.notice_too_short(c.meeting, c.as_of)


@query("c07_budget_overdue", f"""WITH p AS (SELECT body_id, count(DISTINCT year(motion_date)) AS years, max(motion_date) AS last_adopted FROM motion
 WHERE outcome = 'passed' AND regexp_matches(title, '(?i)budget') AND NOT regexp_matches(title, '(?i)amendment|adjustment') GROUP BY 1)
SELECT p.*, later FROM p JOIN (SELECT p.body_id, count(*) AS later FROM p JOIN meeting m ON p.body_id = m.body_id AND m.meeting_date > last_adopted AND minutes_url IS NOT NULL AND m.meeting_date < {AS} GROUP BY 1) l ON p.body_id = l.body_id
WHERE years >= 2 AND last_adopted < CAST({AS} - INTERVAL 14 MONTH AS DATE) AND later >= 3""")
def c07(c):
    return O.budget_overdue(c.motion, c.meeting, c.as_of)


def _prior(c):
    cats = F.explode(F.array(*map(F.lit, ["minutes_missing", "agenda_missing", "meeting_notice_too_short", "campaign_finance_missing", "budget_process_missing"])))
    b = F.col("body_id") % 4
    status = F.when(b == 0, "open").when(b == 1, "closed_with_records").when(b == 2, "records_requested").otherwise("wont_fix")
    return c.governing_body.filter("body_id % 3 <> 0").select("body_id", cats.alias("category"), status.alias("status"), F.date_add(F.lit("2000-01-01").cast("date"), F.col("body_id").cast("int")).alias("opened_at"), F.when(b == 1, F.lit("2001-02-01").cast("date")).alias("closed_at"))


def _fold(frozen):
    still = "p.status IN ('open', 'records_requested'" + (", 'wont_fix'" if frozen else "") + ")"
    return f"""WITH o AS ({OBSERVED}), p AS ({PRIOR}), f AS (
  SELECT coalesce(o.body_id, p.body_id) AS body_id, coalesce(o.category, p.category) AS category, p.status AS prior_status, p.opened_at AS was_opened, p.closed_at AS was_closed,
    CASE WHEN o.body_id IS NOT NULL AND p.status IS NULL THEN 'inserted' WHEN o.body_id IS NOT NULL AND {still} THEN 'updated' WHEN o.body_id IS NOT NULL THEN 'reopened'
         WHEN p.status IN ('open', 'records_requested') THEN 'closed' ELSE 'unchanged' END AS action
  FROM o FULL JOIN p ON o.body_id = p.body_id AND o.category = p.category)
SELECT body_id, category, prior_status, action, CASE WHEN action IN ('inserted', 'reopened') THEN 'open' WHEN action = 'closed' THEN 'closed_with_records' ELSE prior_status END AS status,
 CASE WHEN action IN ('inserted', 'reopened') THEN {AS} ELSE was_opened END AS opened_at, CASE WHEN action = 'closed' THEN {AS} WHEN action IN ('updated', 'unchanged') THEN was_closed END AS closed_at FROM f"""


@query("c08_finding_lifecycle", _fold(False))
def c08(c):
    found, failed = observed(c)
    return O.lifecycle(found, _prior(c), ["body_id", "category"], live=["open", "records_requested"], closed="closed_with_records", protect=F.col("p_category").isin(failed), now=O.day(c.as_of))


@query("h05_issue_lifecycle", _fold(True))
def h05(c):
    found, failed = observed(c)
    return O.lifecycle(found, _prior(c), ["body_id", "category"], live=["open", "records_requested"], closed="closed_with_records", frozen=["wont_fix"], protect=F.col("p_category").isin(failed), now=O.day(c.as_of))


@query("c09_request_per_jurisdiction", f"""WITH o AS ({OBSERVED}) SELECT b.jurisdiction_id, count(*) AS n, string_agg(o.category || ':' || o.body_id, ',' ORDER BY o.category, o.body_id) AS findings FROM o JOIN governing_body b ON o.body_id = b.body_id GROUP BY 1""")
def c09(c):
    found, _ = observed(c)
    rows = found.join(c.governing_body.select("body_id", "jurisdiction_id"), "body_id")
    items = F.transform(F.sort_array(F.collect_list(F.struct("category", "body_id"))), lambda s: F.concat_ws(":", s["category"], s["body_id"].cast("string")))
    return rows.groupBy("jurisdiction_id").agg(F.count(F.lit(1)).alias("n"), F.array_join(items, ",").alias("findings"))


@query("c10_issue_text", f"""WITH o AS ({OBSERVED}), r AS (SELECT *, row_number() OVER (PARTITION BY body_id ORDER BY category) AS i FROM o)
SELECT body_id, string_agg(i || '. ' || category || ' (' || n || ')', chr(10) ORDER BY i) AS body_text FROM r GROUP BY 1""")
def c10(c):
    found, _ = observed(c)
    ordered = F.sort_array(F.collect_list(F.struct("category", "n")))
    per = found.groupBy("body_id").agg(ordered.alias("items"))
    lines = F.transform("items", lambda s, i: F.format_string("%d. %s (%d)", i + 1, s["category"], s["n"]))
    return per.select("body_id", F.array_join(lines, "\n").alias("body_text"))


_T = "SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS seg FROM customer WHERE c_custkey % 2 = 0"
_S = "SELECT c_custkey AS k, upper(c_name) AS name, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE lower(c_mktsegment) END AS seg FROM customer WHERE c_custkey % 3 = 0"


def _target(c):
    return c.customer.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")).alias("seg"))


def _source(c):
    return c.customer.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.upper("c_name").alias("name"), F.when(F.col("c_custkey") % 5 != 0, F.lower("c_mktsegment")).alias("seg"))


@query("k01_append_with_provenance", f"SELECT k, name, seg, NULL AS data_source_id FROM ({_T}) t UNION ALL SELECT k, name, seg, 'run-1' FROM ({_S}) s")
def k01(c):
    return K.append(_target(c), _source(c), "run-1")


@query("k02_upsert", f"""SELECT coalesce(s.k, t.k) AS k, CASE WHEN s.k IS NOT NULL THEN s.name ELSE t.name END AS name, CASE WHEN s.k IS NOT NULL THEN s.seg ELSE t.seg END AS seg,
 CASE WHEN t.k IS NULL THEN 'inserted' WHEN s.k IS NOT NULL THEN 'updated' ELSE 'kept' END AS action FROM ({_T}) t FULL JOIN ({_S}) s ON t.k = s.k""")
def k02(c):
    return K.upsert(_target(c), _source(c), ["k"])


@query("k03_insert_absent", f"SELECT s.* FROM ({_S}) s WHERE NOT EXISTS (SELECT 1 FROM ({_T}) t WHERE t.k = s.k AND t.seg <> '')")
def k03(c):
    return K.insert_absent(_target(c), _source(c), ["k"], when="seg <> ''")


@query("k04_replace_by_key", f"SELECT * FROM ({_T}) t WHERE seg NOT IN ('BUILDING', 'MACHINERY') UNION ALL SELECT * FROM ({_T}) t WHERE seg = 'BUILDING' AND k % 4 = 0")
def k04(c):
    return K.replace_by_key(_target(c), _target(c).filter("seg = 'BUILDING' AND k % 4 = 0"), "seg", ["BUILDING", "MACHINERY"])


@query("k05_fill_nulls", f"SELECT t.k, t.name, CASE WHEN nullif(t.seg, '') IS NULL THEN coalesce(s.seg, t.seg) ELSE t.seg END AS seg, CASE WHEN nullif(t.seg, '') IS NULL AND s.seg IS NOT NULL THEN 'seg' ELSE '' END AS filled FROM ({_T}) t LEFT JOIN ({_S}) s ON t.k = s.k")
def k05(c):
    return K.fill_nulls(_target(c), _source(c), ["k"], ["seg"])


@query("k06_diff_update", f"""SELECT s.k, CASE WHEN t.k IS NULL THEN 'insert' WHEN s.name <> t.name OR (s.seg IS NOT NULL AND s.seg IS DISTINCT FROM t.seg) THEN 'update' ELSE 'unchanged' END AS label,
 concat_ws(',', CASE WHEN s.name IS DISTINCT FROM t.name THEN 'name' END, CASE WHEN s.seg IS NOT NULL AND s.seg IS DISTINCT FROM t.seg THEN 'seg' END) AS changed FROM ({_S}) s LEFT JOIN ({_T}) t ON s.k = t.k""")
def k06(c):
    return K.diff_update(_target(c), _source(c), ["k"])


@query("k07_sync_with_protected_delete", f"SELECT t.* FROM ({_T}) t WHERE EXISTS (SELECT 1 FROM ({_S}) s WHERE s.k = t.k) OR t.seg = 'BUILDING'")
def k07(c):
    return K.sync_delete(_target(c), _source(c), ["k"], "seg = 'BUILDING'")[0]


@query("k08_reconcile_meetings", f"""WITH s AS (SELECT body_id, CASE WHEN meeting_id % 8 = 0 THEN CAST(meeting_date + INTERVAL 365 DAY AS DATE) ELSE meeting_date END AS meeting_date,
   CASE WHEN agenda_url IS NULL AND meeting_id % 2 = 0 THEN 'https://docs.example.org/new/' || meeting_id ELSE agenda_url END AS new_agenda, minutes_url AS new_minutes FROM meeting WHERE meeting_id % 3 <> 0),
 e AS (SELECT s.*, (SELECT min(meeting_id) FROM meeting t WHERE t.body_id = s.body_id AND t.meeting_date = s.meeting_date AND t.agenda_url IS NOT DISTINCT FROM s.new_agenda) AS exact_id,
   (SELECT min(meeting_id) FROM meeting t WHERE t.body_id = s.body_id AND t.meeting_date = s.meeting_date AND t.agenda_url IS NULL AND t.minutes_url IS NULL) AS bare_id FROM s)
SELECT body_id, meeting_date, new_agenda, CASE WHEN exact_id IS NOT NULL THEN 'update' WHEN new_agenda IS NOT NULL AND bare_id IS NOT NULL THEN 'upgrade' ELSE 'insert' END AS action,
 CASE WHEN exact_id IS NOT NULL THEN exact_id WHEN new_agenda IS NOT NULL AND bare_id IS NOT NULL THEN bare_id END AS meeting_id,
 CASE WHEN new_minutes IS NOT NULL THEN 'published' WHEN meeting_date > {AS} THEN 'agenda_published' ELSE 'completed' END AS status FROM e""")
def k08(c):
    later = F.when(F.col("meeting_id") % 8 == 0, F.date_add("meeting_date", 365)).otherwise(F.col("meeting_date"))
    agenda = F.when(F.col("agenda_url").isNull() & (F.col("meeting_id") % 2 == 0), F.concat(F.lit("https://docs.example.org/new/"), F.col("meeting_id").cast("string"))).otherwise(F.col("agenda_url"))
    scraped = c.meeting.filter("meeting_id % 3 <> 0").select("body_id", later.alias("meeting_date"), agenda.alias("agenda_url"), "minutes_url")
    return K.reconcile_meetings(c.meeting, scraped, c.as_of)


@query("k11_replace_children", "SELECT motion_id, official_id, vote_value FROM vote WHERE motion_id % 10 <> 0 UNION ALL SELECT motion_id, official_id, 'yes' FROM vote WHERE motion_id % 20 = 0")
def k11(c):
    v = c.vote.select("motion_id", "official_id", "vote_value")
    new = v.filter("motion_id % 20 = 0").withColumn("vote_value", F.lit("yes"))
    return K.replace_children(c.motion.filter("motion_id % 10 = 0"), v, new, "motion_id")


@query("k13_coalescing_upsert", f"""SELECT coalesce(s.k, t.k) AS k, CASE WHEN s.k IS NOT NULL THEN coalesce(nullif(s.name, ''), t.name) ELSE t.name END AS name, CASE WHEN s.k IS NOT NULL THEN coalesce(nullif(s.seg, ''), t.seg) ELSE t.seg END AS seg,
 CASE WHEN t.k IS NULL THEN 'inserted' WHEN s.k IS NOT NULL THEN 'updated' ELSE 'kept' END AS action FROM ({_T}) t FULL JOIN ({_S}) s ON t.k = s.k""")
def k13(c):
    return K.upsert(_target(c), _source(c), ["k"], coalesce=True)


@query("k14_supersede_failures", """SELECT f.failure_id, f.jurisdiction_id, f.job, min(o.created_at) AS resolved_at FROM failure f LEFT JOIN outcome o ON f.jurisdiction_id = o.jurisdiction_id AND o.status = 'ok' AND o.created_at > f.created_at GROUP BY 1, 2, 3""")
def k14(c):
    ok = c.outcome.filter("status = 'ok'").select("jurisdiction_id", "created_at")
    return K.supersede_failures(c.failure, ok, ["jurisdiction_id"], "created_at").select("failure_id", "jurisdiction_id", "job", "resolved_at")
