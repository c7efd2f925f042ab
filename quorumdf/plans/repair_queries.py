"""Queries of repairs, orphan removal, photos, request lines, the nine rungs and reserved funds."""

from pyspark.sql import functions as F

from quorumdf.operators import facts as R
from quorumdf.operators import health as H
from quorumdf.operators import ledger as L
from quorumdf.operators import observers as O
from quorumdf.streaming import jobs as Z

from .compliance_queries import AGENDA, MINUTES, OBSERVED, _fold, _prior, observed
from .people_queries import _lines, _LINES, _officials
from .registry import query

_FINDINGS = """SELECT t.motion_id, 'qa_tally_mismatch' AS pattern_id, CASE WHEN t.motion_id % 4 = 0 THEN 1 ELSE n_votes + t.motion_id % 9 END AS declared, CASE WHEN t.motion_id % 4 = 0 THEN t.motion_id % 8 ELSE n_votes END AS actual FROM tally t WHERE t.motion_id % 3 = 0
 UNION ALL SELECT motion_id, 'qa_official_as_petitioner', NULL, NULL FROM motion WHERE motion_id % 10 IN (1, 6) UNION ALL SELECT motion_id, 'qa_official_as_staff_recommender', NULL, NULL FROM motion WHERE motion_id % 10 IN (2, 6)"""


@query("r07b_motion_repairs", f"""WITH f AS ({_FINDINGS}), g AS (SELECT motion_id, bool_or(pattern_id = 'qa_tally_mismatch' AND declared = 1 AND actual = 0) AS v, bool_or(pattern_id = 'qa_tally_mismatch' AND declared - actual >= 5) AS b, bool_or(pattern_id = 'qa_official_as_petitioner') AS p, bool_or(pattern_id = 'qa_official_as_staff_recommender') AS s FROM f GROUP BY 1),
m AS (SELECT k.*, 'Clerk ' || petitioner AS recommender, coalesce(v, false) AS v, coalesce(b, false) AND motion_type = 'appointment' AS b, coalesce(p, false) AS p, coalesce(s, false) AS s FROM motion k LEFT JOIN g ON k.motion_id = g.motion_id)
SELECT motion_id, CASE WHEN v THEN 'procedural' ELSE motion_type END AS motion_type, CASE WHEN v THEN 0 ELSE tally_yes END AS tally_yes, CASE WHEN v THEN 0 ELSE tally_no END AS tally_no, CASE WHEN v THEN 0 ELSE tally_abstain END AS tally_abstain, outcome,
 CASE WHEN NOT p THEN petitioner END AS petitioner, CASE WHEN NOT s THEN recommender END AS recommender,
 concat_ws(';', CASE WHEN v THEN 'voice_vote_demote:' || motion_type END, CASE WHEN b THEN 'bundled_tally_escalate:' || coalesce('' || tally_yes, '') END, CASE WHEN p THEN 'official_as_petitioner_clear:' || coalesce(petitioner, '') END, CASE WHEN s THEN 'official_as_staff_recommender_clear:' || coalesce(recommender, '') END) AS log FROM m""")
def r07b(c):
    m, t = F.col("motion_id"), c.tally
    four = m % 4 == 0
    tally = t.filter("motion_id % 3 = 0").select("motion_id", F.lit("qa_tally_mismatch").alias("pattern_id"), F.when(four, 1).otherwise(F.col("n_votes") + m % 9).alias("declared"), F.when(four, m % 8).otherwise(F.col("n_votes")).alias("actual"))
    none = F.lit(None).cast("long")
    named = [c.motion.filter((m % 10).isin(*ids)).select("motion_id", F.lit(p).alias("pattern_id"), none.alias("declared"), none.alias("actual")) for p, ids in [("qa_official_as_petitioner", (1, 6)), ("qa_official_as_staff_recommender", (2, 6))]]
    done = R.repair_motions(c.motion.withColumn("recommender", F.concat(F.lit("Clerk "), "petitioner")), tally.unionByName(named[0]).unionByName(named[1]))
    log = F.array_join(F.transform("repair_log", lambda e: F.concat(e["handler"], F.lit(":"), F.coalesce(e["old"], F.lit("")))), ";")
    return done.withColumn("log", log).drop("repair_log")


@query("r08b_orphans_with_evidence", f"""WITH o AS (SELECT official_id, CASE WHEN official_id % 5 = 2 THEN 'Clerk ' ELSE '' END || first_name || ' ' || last_name AS canonical_name, lower(last_name) AS low FROM person),
h AS (SELECT official_id FROM vote WHERE official_id % 3 = 0 UNION SELECT official_id FROM term WHERE official_id % 7 = 0), l AS (SELECT DISTINCT motion_id, lower(line) AS line FROM ({_LINES}) x WHERE line LIKE 'Chief %'),
s AS (SELECT o.*, (SELECT count(DISTINCT motion_id) FROM l WHERE contains(line, o.low)) AS k, (SELECT count(*) FROM official_alias a WHERE a.official_id = o.official_id) AS na, (SELECT count(*) FROM contribution g WHERE g.official_id = o.official_id) AS nf FROM o),
r AS (SELECT *, CASE WHEN official_id IN (SELECT official_id FROM h) THEN 'kept_in_use' WHEN k = 0 AND NOT starts_with(canonical_name, 'Clerk ') THEN 'kept_unconfirmed' ELSE 'deleted' END AS outcome FROM s)
SELECT official_id, outcome, k AS staff_meetings, CASE WHEN outcome = 'deleted' THEN na ELSE 0 END AS n_alias, CASE WHEN outcome = 'deleted' THEN nf ELSE 0 END AS n_findings FROM r""")
def r08b(c):
    """Every official is flagged; votes of two thirds and most terms are taken as withdrawn meanwhile."""
    title = F.when(F.col("official_id") % 5 == 2, "Clerk ").otherwise("")
    officials = _officials(c).withColumn("canonical_name", F.concat(title, "canonical_name"))
    lines = _lines(c).filter("line like 'Chief %'").select(F.col("motion_id").alias("meeting_id"), "line")
    return R.orphan_removal(officials, officials, c.vote.filter("official_id % 3 = 0"), c.term.filter("official_id % 7 = 0"), lines, c.official_alias, c.contribution)


@query("r18_staff_photos", """WITH p AS (SELECT motion_id, m.official_id, m.name AS caption, first_name || ' ' || last_name AS name, last_name, motion_id % 3 = 0 AS own FROM minutes_name m JOIN person q ON m.official_id = q.official_id),
s AS (SELECT *, contains(lower(caption), lower(name)) AS f, length(last_name) >= 4 AND contains(lower(caption), lower(last_name)) AS l FROM p)
SELECT motion_id, official_id, own::INT + (f OR l)::INT AS score, CASE WHEN own AND (f OR l) THEN 'verified' ELSE 'unverified' END AS status, CASE WHEN own AND f THEN 'auto:source=city_official+caption_matches_canonical_name' WHEN own AND l THEN 'auto:source=city_official+caption_matches_last_name' END AS verified_by FROM s""")
def r18(c):
    rows = c.minutes_name.select("motion_id", "official_id", F.col("name").alias("caption")).join(_officials(c).select("official_id", "canonical_name"), "official_id")
    tier = F.when(F.col("motion_id") % 3 == 0, "city_official").otherwise("press")
    return rows.select("motion_id", "official_id", R.staff_photo(tier, F.col("caption"), F.col("canonical_name")).alias("p")).select("motion_id", "official_id", "p.*")


_HEAD = "CASE WHEN n > 1 THEN '{0} — ' || n || ' meetings, ' || strftime(since_date, '%B %-d, %Y') || ' to present.' ELSE '{0} — none on record since ' || strftime(since_date, '%B %-d, %Y') || '.' END"


@query("x21_item_sentences", f"SELECT body_id, {_HEAD.format('Meeting minutes')} AS sentence FROM ({MINUTES}) m UNION ALL SELECT body_id, {_HEAD.format('Meeting agendas')} FROM ({AGENDA}) a")
def x21(c):
    rows = O.minutes_missing(c.meeting, c.as_of).withColumn("category", F.lit("minutes_missing")).unionByName(O.agenda_missing(c.meeting, c.as_of).withColumn("category", F.lit("agenda_missing")))
    return rows.select("body_id", O.item_sentence(F.col("category"), F.col("n"), F.col("since_date")).alias("sentence"))


_CUT = "1999-09-01"
_FUND = "SELECT jurisdiction_id, CASE jurisdiction_id % 4 WHEN 1 THEN 'active' WHEN 2 THEN 'paused' WHEN 3 THEN 'suspended' END AS status, jurisdiction_id % 5 = 3 AS unlocked, CASE WHEN jurisdiction_id > 0 THEN CAST(jurisdiction_id * 7.25 + 1 AS DOUBLE) END AS needed FROM jurisdiction"


@query("h10b_capability_rungs", f"""WITH mm AS (SELECT m.*, b.jurisdiction_id, m.meeting_date >= DATE '{_CUT}' AS recent, minutes_url IS NOT NULL AND m.meeting_id % 8 <> 0 AS mi, agenda_url IS NOT NULL AS ag, m.meeting_id IN (SELECT meeting_id FROM motion WHERE motion_id % 2 = 0) AS mo, m.meeting_id IN (SELECT meeting_id FROM motion WHERE petitioner IS NULL) AS it FROM meeting m JOIN governing_body b ON m.body_id = b.body_id),
w AS (SELECT f.*, CASE WHEN status IS NULL OR status = 'paused' THEN 'needs_funding' ELSE 'in_progress' END AS pend, (SELECT count(*) FROM governing_body b WHERE b.jurisdiction_id = f.jurisdiction_id) AS nb, (SELECT count(*) FROM mm WHERE mm.jurisdiction_id = f.jurisdiction_id) AS nm,
 (SELECT count(*) FROM mm WHERE mm.jurisdiction_id = f.jurisdiction_id AND minutes_url IS NOT NULL) AS nu, (SELECT count(*) FROM mm WHERE mm.jurisdiction_id = f.jurisdiction_id AND mo) AS nmo,
 (SELECT count(*) FROM mm WHERE mm.jurisdiction_id = f.jurisdiction_id AND recent AND mi) AS rt, (SELECT count(*) FROM mm WHERE mm.jurisdiction_id = f.jurisdiction_id AND recent AND mi AND mo) AS rd,
 (SELECT sum(mi::INT + ag::INT)::BIGINT FROM mm WHERE mm.jurisdiction_id = f.jurisdiction_id AND NOT recent) AS ot, (SELECT sum((mi AND NOT mo)::INT + (ag AND NOT it)::INT)::BIGINT FROM mm WHERE mm.jurisdiction_id = f.jurisdiction_id AND NOT recent) AS ol,
 (SELECT count(DISTINCT o.official_id) FROM official o JOIN term t ON o.official_id = t.official_id JOIN governing_body b ON o.body_id = b.body_id WHERE b.jurisdiction_id = f.jurisdiction_id) AS no,
 (SELECT count(*) FROM ({OBSERVED}) x JOIN governing_body b ON x.body_id = b.body_id WHERE b.jurisdiction_id = f.jurisdiction_id) AS nf,
 (SELECT count(*) FROM contribution k JOIN official o ON k.official_id = o.official_id JOIN governing_body b ON o.body_id = b.body_id WHERE b.jurisdiction_id = f.jurisdiction_id) AS ng FROM ({_FUND}) f)
SELECT jurisdiction_id, 'directory' AS key, 'Government directory' AS label, CASE WHEN nb > 0 THEN 'indexed' ELSE pend END AS state, CASE WHEN nb > 0 THEN nb || ' bodies' ELSE 'pending' END AS detail FROM w
UNION ALL SELECT jurisdiction_id, 'meetings', 'Meetings indexed', CASE WHEN nm > 0 THEN 'indexed' ELSE pend END, CASE WHEN nm > 0 THEN nm || ' meetings' ELSE 'pending' END FROM w
UNION ALL SELECT jurisdiction_id, 'minutes', 'Minutes & votes extracted', CASE WHEN rt > 0 AND rd >= rt THEN 'indexed' WHEN rt > 0 THEN pend WHEN nmo > 0 THEN 'indexed' WHEN nu > 0 THEN pend ELSE 'needs_funding' END,
 CASE WHEN rt > 0 THEN rd || ' of ' || rt || ' recent meetings extracted' WHEN nmo > 0 THEN nmo || ' meetings with votes' WHEN nu > 0 THEN 'pending' ELSE 'no minutes documents found' END FROM w
UNION ALL SELECT jurisdiction_id, 'roster', 'Elected roster', CASE WHEN no > 0 THEN 'indexed' ELSE pend END, CASE WHEN no > 0 THEN no || ' officials' ELSE 'pending' END FROM w
UNION ALL SELECT jurisdiction_id, 'audit', 'Compliance audit', CASE WHEN nf > 0 THEN 'indexed' WHEN nm > 0 THEN 'in_progress' ELSE pend END, CASE WHEN nf > 0 THEN nf || ' findings tracked' ELSE 'pending' END FROM w
UNION ALL SELECT jurisdiction_id, 'historical', 'Historical archive', CASE WHEN coalesce(ot, 0) = 0 THEN 'coming_soon' WHEN ol = 0 THEN 'indexed' WHEN unlocked THEN 'in_progress' ELSE 'needs_funding' END,
 CASE WHEN coalesce(ot, 0) = 0 THEN 'no records beyond the recent window yet' WHEN ol = 0 THEN ot || ' historical documents indexed' WHEN unlocked THEN (ot - ol) || ' of ' || ot || ' historical documents extracted' WHEN needed IS NULL THEN ol || ' documents · price estimate pending'
 ELSE ol || ' documents · ~$' || CASE WHEN needed >= 20 THEN printf('%d', round(needed)::BIGINT) ELSE printf('%.2f', needed) END || ' to unlock' END FROM w
UNION ALL SELECT jurisdiction_id, 'campaign_finance', 'Campaign finance', CASE WHEN ng > 0 THEN 'indexed' ELSE 'coming_soon' END, CASE WHEN ng > 0 THEN ng || ' contributions' ELSE 'coming soon' END FROM w
UNION ALL SELECT jurisdiction_id, 'elections', 'Elections calendar', 'coming_soon', 'coming soon' FROM w UNION ALL SELECT jurisdiction_id, 'budget', 'Budget records', 'coming_soon', 'coming soon' FROM w""")
def h10b(c):
    """Funds, placeholders and agenda items are derived; the recent window starts two years before the as-of day."""
    j = F.col("jurisdiction_id")
    status = F.when(j % 4 == 1, "active").when(j % 4 == 2, "paused").when(j % 4 == 3, "suspended")
    fund = c.jurisdiction.select(j, status.alias("status"), (j % 5 == 3).alias("unlocked"), F.when(j > 0, (j * 7.25 + 1).cast("double")).alias("needed_usd"))
    meeting = c.meeting.withColumn("minutes_stub", F.col("meeting_id") % 8 == 0).withColumn("agenda_stub", F.lit(None).cast("boolean"))
    member = c.official.select("official_id", "body_id").join(c.term.select("official_id"), "official_id", "left_semi")
    gift = c.contribution.select("official_id").join(c.official.select("official_id", "body_id"), "official_id")
    return H.capability_rungs(c.governing_body, meeting, c.motion.filter("motion_id % 2 = 0"), c.motion.filter("petitioner is null"), member, observed(c)[0], gift, fund, _CUT)


@query("c08b_lifecycle_of_each_observer", _fold(False))
def c08b(c):
    """Every observer runs for itself; what a failed one had found stays as it is."""
    found, failed = observed(c)
    return O.lifecycle(found, _prior(c), ["body_id", "category"], live=["open", "records_requested"], closed="closed_with_records", protect=F.col("p_category").isin(failed), now=O.day(c.as_of))


@query("l03b_reserve_and_settle")
def l03b(c):
    return L.reservations(c.reservation_event, ["user_id"], floor=100, reserve=2000)


@query("z05b_reserve_and_settle_stream")
def z05b(c):
    """The same fold as a stream; rows of reaped holds have no event."""
    events = _reservation_stream(c)
    return Z.run_to_table(Z.reservation_stream(events, "user_id", floor=100, reserve=2000), "append")


def _reservation_stream(c):
    """The ledger's requests with the hold that a settlement names, as a producer would send them."""
    stream = Z.read_stream(c.spark, f"{c.sf_dir}/events.parquet").select("event_id", "ts")
    return stream.join(c.reservation_event.drop("ts"), "event_id")


_OPEN = f"SELECT o.body_id * 10 + CASE category WHEN 'agenda_missing' THEN 1 WHEN 'meeting_notice_too_short' THEN 2 WHEN 'member_roster_missing' THEN 3 WHEN 'campaign_finance_missing' THEN 5 WHEN 'budget_process_missing' THEN 6 ELSE 4 END AS finding_id, b.jurisdiction_id, o.body_id, category FROM ({OBSERVED}) o JOIN governing_body b ON o.body_id = b.body_id"


@query("c09b_request_reconcile", f"""WITH f AS ({_OPEN}), g AS (SELECT jurisdiction_id, list(finding_id ORDER BY body_id, finding_id) AS ids FROM f GROUP BY 1),
q AS (SELECT jurisdiction_id * 10 AS request_id, 2 AS tone, DATE '2001-01-01' AS created_at, CASE WHEN jurisdiction_id % 3 = 0 THEN ids ELSE ids[1:2] END AS old FROM g WHERE jurisdiction_id % 3 <> 2 UNION ALL SELECT jurisdiction_id * 10 + 1, 3, DATE '2001-02-01', ids[1:2] FROM g WHERE jurisdiction_id % 3 <> 2),
r AS (SELECT g.jurisdiction_id, g.ids, q.*, row_number() OVER (PARTITION BY g.jurisdiction_id ORDER BY len(old) DESC, created_at DESC) AS i FROM g LEFT JOIN q ON list_has_any(g.ids, q.old))
SELECT jurisdiction_id, request_id, CASE WHEN request_id IS NULL THEN 'create' WHEN list_sort(ids) = list_sort(old) THEN 'noop' ELSE 'update' END AS action, coalesce(tone, 1) AS tone, array_to_string(ids, ',') AS finding_ids FROM r WHERE i = 1""")
def c09b(c):
    """Earlier requests are derived: two in two jurisdictions of three, whole or of the first two findings."""
    rows = observed(c)[0].join(c.governing_body.select("body_id", "jurisdiction_id"), "body_id")
    cat = F.col("category")
    code = F.when(cat == "agenda_missing", 1).when(cat == "meeting_notice_too_short", 2).when(cat == "member_roster_missing", 3).when(cat == "campaign_finance_missing", 5).when(cat == "budget_process_missing", 6).otherwise(4)
    found = rows.select((F.col("body_id") * 10 + code).alias("finding_id"), "jurisdiction_id", "body_id", "category", F.lit("open").alias("status"))
    per = found.groupBy("jurisdiction_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("body_id", "finding_id"))), lambda r: r["finding_id"]).alias("ids")).filter("jurisdiction_id % 3 <> 2")
    old = per.select(F.expr("""stack(3, jurisdiction_id * 10, 'sent', 2, date '2001-01-01', if(jurisdiction_id % 3 = 0, ids, slice(ids, 1, 2)), jurisdiction_id * 10 + 1, 'draft', 3, date '2001-02-01', slice(ids, 1, 2),
        jurisdiction_id * 10 + 2, 'closed', 9, date '2001-03-01', ids) AS (request_id, status, tone, created_at, finding_ids)"""))
    done = O.reconcile_requests(found, rows, old)
    return done.withColumn("finding_ids", F.concat_ws(",", F.col("finding_ids").cast("array<string>")))


_WINDOWS = """SELECT doc, win, (win - 1) * 4 AS page_offset, CASE WHEN l_suppkey % 3 = 0 THEN 'Body ' || l_suppkey END AS body_name,
 1 + quantity % 6 AS p1, l_returnflag || ' item' AS t1, 5 - 4 * (win % 2) AS p2, CASE WHEN win % 2 = 0 THEN ' CONSENT' ELSE 'consent' END AS t2, 'M' || (l_suppkey % 4) AS m1, 'M' || (l_partkey % 4) AS m2 FROM extraction_line"""


@query("r04b_window_merge_whole", f"""WITH w AS ({_WINDOWS}), i AS (SELECT doc, win, 0 AS pos, p1 + page_offset AS page, t1 AS title FROM w UNION ALL SELECT doc, win, 1, p2 + page_offset, t2 FROM w),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc, page, lower(trim(title)) ORDER BY win, pos) AS rn FROM i) a WHERE rn = 1), n AS (SELECT doc, win, 0 AS pos, m1 AS m FROM w UNION ALL SELECT doc, win, 1, m2 FROM w), u AS (SELECT doc, m, min(win * 2 + pos) AS at1 FROM n GROUP BY 1, 2)
SELECT h.doc, h.body_name, (SELECT string_agg(page || ':' || title, ';' ORDER BY page, win, pos) FROM f WHERE f.doc = h.doc) AS items, (SELECT string_agg(m, ';' ORDER BY at1) FROM u WHERE u.doc = h.doc) AS present FROM (SELECT doc, arg_min(body_name, win) FILTER (WHERE body_name IS NOT NULL) AS body_name FROM w GROUP BY 1) h""")
def r04b(c):
    n, s = F.col("win"), F.col("l_suppkey")
    item = lambda page, title: F.struct(page.cast("long").alias("source_page"), title.alias("title"))
    one = item(1 + F.col("quantity") % 6, F.concat("l_returnflag", F.lit(" item")))
    two = item(5 - 4 * (n % 2), F.when(n % 2 == 0, " CONSENT").otherwise("consent"))
    member = lambda x: F.concat(F.lit("M"), (x % 4).cast("string"))
    windows = c.extraction_line.select("doc", "win", ((n - 1) * 4).alias("page_offset"), F.when(s % 3 == 0, F.concat(F.lit("Body "), s.cast("string"))).alias("body_name"), F.array(one, two).alias("items"), F.array(member(s), member(F.col("l_partkey"))).alias("present"))
    done = R.merge_extractions(windows, "doc", "win", ["body_name"], ["present"])
    text = F.transform("items", lambda r: F.concat_ws(":", r["source_page"].cast("string"), r["title"]))
    return done.select("doc", "body_name", F.array_join(text, ";").alias("items"), F.array_join("present", ";").alias("present"))
