"""Queries of payload facts, repairs, corrections and the remaining joins, expressions and lists."""

from pyspark.sql import functions as F

from quorumdf.dealing import parts
from quorumdf.operators import detectors as D
from quorumdf.operators import facts as R
from quorumdf.operators import profiles as P
from quorumdf.operators import sinks as K

from .detector_queries import QA_SQL
from .registry import query

AS = "DATE '2001-09-01'"


def _payloads(c):
    """Stored payloads as JSON text, one per motion, as an extractor leaves them."""
    v = c.vote.join(c.official.select("official_id", "canonical_name"), "official_id")
    votes = F.sort_array(F.collect_list(F.when(F.col("vote_value") != "conflict_recusal", F.struct(F.upper("canonical_name").alias("name"), F.col("vote_value").alias("vote")))))
    out = F.sort_array(F.collect_list(F.when(F.col("vote_value") == "conflict_recusal", F.struct(F.col("canonical_name").alias("name"), F.lit("conflict").alias("reason")))))
    per = v.groupBy("motion_id").agg(votes.alias("individual_votes"), out.alias("recusals"))
    rows = c.motion.join(per, "motion_id", "left")
    item = F.struct(F.col("motion_id").alias("item_number"), F.concat(F.lit(" "), "title", F.lit(" ")).alias("title"), F.col("title").alias("motion_text_verbatim"), F.col("petitioner").alias("summary_plain_english"), "individual_votes", "recusals")
    return rows.select(F.to_json(F.struct(F.array(item).alias("agenda_items"))).alias("payload"))


@query("r01_payload_motions", "SELECT motion_id, trim(title) AS title, concat_ws(chr(10) || chr(10), title, petitioner) AS description FROM motion")
def r01(c):
    return R.payload_motions(R.read_payloads(_payloads(c)))


@query("r02_payload_votes", "SELECT motion_id, official_id, vote_value, CASE WHEN vote_value = 'conflict_recusal' THEN 'conflict' END AS reason FROM vote JOIN official USING (official_id)")
def r02(c):
    return R.payload_votes(R.read_payloads(_payloads(c)), c.official)


@query("r04_window_merge", """SELECT doc, page, low AS title, win FROM (SELECT l_orderkey AS doc, CAST(l_quantity AS INT) % 10 AS page, lower(l_returnflag || l_linestatus) AS low, l_linenumber AS win,
 row_number() OVER (PARTITION BY l_orderkey, CAST(l_quantity AS INT) % 10, lower(l_returnflag || l_linestatus) ORDER BY l_linenumber) AS rn FROM lineitem) a WHERE rn = 1""")
def r04(c):
    items = c.lineitem.select(F.col("l_orderkey").alias("doc"), (F.col("l_quantity").cast("int") % 10).alias("page"), F.lower(F.concat("l_returnflag", "l_linestatus")).alias("title"), F.col("l_linenumber").alias("win"))
    return R.merge_windows(items, "doc", "page", "title", "win")


_TOP = f"SELECT motion_id, pattern_id FROM (SELECT *, row_number() OVER (PARTITION BY motion_id ORDER BY severity DESC, pattern_id) AS rn FROM ({QA_SQL}) q) a WHERE rn = 1"
_DISPATCH = f"""SELECT t.motion_id, CASE WHEN pattern_id = 'qa_tally_mismatch' AND coalesce(n_votes, 0) <= 1 THEN 'voice_vote' WHEN pattern_id = 'qa_tally_mismatch' THEN 'vote_mismatch' WHEN pattern_id IN ('qa_petitioner_is_staff', 'qa_generic_petitioner') THEN 'clear_petitioner' WHEN pattern_id = 'qa_short_motion_title' THEN 'retitle' END AS handler_id
 FROM ({_TOP}) t LEFT JOIN tally y ON t.motion_id = y.motion_id WHERE t.motion_id % 5 < 3"""


def _dispatched(c):
    top = D.top_finding(D.run_detectors(c)).select("motion_id", "pattern_id")
    rows = top.join(c.tally.select("motion_id", F.col("n_votes").alias("recorded")), "motion_id", "left").fillna(0, ["recorded"])
    return R.dispatch(rows.withColumn("attempts", F.col("motion_id") % 5)).select("motion_id", "handler_id")


@query("r06_repair_dispatch", _DISPATCH)
def r06(c):
    return _dispatched(c)


@query("r09_tally_recompute", "SELECT motion_id, count(*) FILTER (WHERE vote_value = 'yes') AS yes, count(*) FILTER (WHERE vote_value = 'no') AS no, count(*) FILTER (WHERE vote_value = 'abstain') AS abstain FROM vote GROUP BY 1")
def r09(c):
    return R.recomputed_tally(c.vote)


@query("r10_repair_summary", f"SELECT handler_id, count(*) AS n FROM ({_DISPATCH}) d GROUP BY 1")
def r10(c):
    return _dispatched(c).groupBy("handler_id").agg(F.count(F.lit(1)).alias("n"))


_SUB = "SELECT conv_id * 1000 + turn AS submission_id, conv_id % 25 AS entity_id, substr(trim(CASE WHEN conv_id % 9 = 0 THEN 'no' ELSE role || ' says ' || (conv_id % 4) END), 1, 200) AS issue FROM conversations"


@query("r11_correction_intake", f"""WITH s AS ({_SUB}), k AS (SELECT DISTINCT entity_id, lower(issue) AS low FROM s WHERE submission_id % 40 = 1), r AS (SELECT s.*, k.low IS NOT NULL AS known, row_number() OVER (PARTITION BY s.entity_id, lower(issue) ORDER BY submission_id) AS rn FROM s LEFT JOIN k ON s.entity_id = k.entity_id AND lower(s.issue) = k.low)
SELECT submission_id, entity_id, CASE WHEN length(issue) < 5 THEN 'invalid' WHEN known OR rn > 1 THEN 'duplicate' ELSE 'accepted' END AS decision FROM r""")
def r11(c):
    issue = F.when(F.col("conv_id") % 9 == 0, "no").otherwise(F.concat("role", F.lit(" says "), (F.col("conv_id") % 4).cast("string")))
    s = c.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("submission_id"), (F.col("conv_id") % 25).alias("entity_id"), issue.alias("issue"))
    return R.correction_intake(s, s.filter("submission_id % 40 = 1"))


@query("r12_correction_resolution", f"""SELECT m.motion_id, CASE WHEN a.entity_id IS NOT NULL THEN 'disputed' ELSE 'clean' END AS state, a.reason FROM motion m LEFT JOIN (SELECT entity_id, min(issue) AS reason FROM ({_SUB}) s WHERE length(issue) >= 5 GROUP BY 1) a ON m.motion_id = a.entity_id""")
def r12(c):
    issue = F.when(F.col("conv_id") % 9 == 0, "no").otherwise(F.concat("role", F.lit(" says "), (F.col("conv_id") % 4).cast("string")))
    a = c.conversations.select((F.col("conv_id") % 25).alias("motion_id"), issue.alias("issue")).filter(F.length("issue") >= 5).groupBy("motion_id").agg(F.min("issue").alias("reason"))
    return c.motion.select("motion_id").join(a, "motion_id", "left").select("motion_id", F.when(F.col("reason").isNotNull(), "disputed").otherwise("clean").alias("state"), "reason")


_BUD = "SELECT b.jurisdiction_id, year(motion_date) + CASE WHEN month(motion_date) >= 4 THEN 1 ELSE 0 END AS fiscal_year, motion_id AS source_id, motion_date AS meeting_date, CASE WHEN motion_id % 4 <> 0 THEN motion_id END AS total FROM motion m JOIN governing_body b ON m.body_id = b.body_id WHERE contains(title, 'budget')"


@query("r14_budget_precedence", f"SELECT jurisdiction_id, fiscal_year, source_id, meeting_date, total FROM (SELECT *, row_number() OVER (PARTITION BY jurisdiction_id, fiscal_year ORDER BY meeting_date DESC, source_id DESC) AS rn FROM ({_BUD}) k WHERE total IS NOT NULL AND fiscal_year <> 1997) a WHERE rn = 1")
def r14(c):
    b = c.motion.filter(F.col("title").contains("budget")).join(c.governing_body.select("body_id", "jurisdiction_id"), "body_id")
    year = F.year("motion_date") + (F.month("motion_date") >= 4).cast("int")
    cand = b.select("jurisdiction_id", year.alias("fiscal_year"), F.col("motion_id").alias("source_id"), F.col("motion_date").alias("meeting_date"), F.when(F.col("motion_id") % 4 != 0, F.col("motion_id")).alias("total"))
    existing = c.jurisdiction.select("jurisdiction_id", F.lit(1997).alias("fiscal_year"), F.lit("state").alias("provider"))
    return R.budget_precedence(cand, existing, "local")


@query("r16_terms_from_winners", """WITH w AS (SELECT DISTINCT official_id % 7 AS seat_id, official_id, year(start_date) AS y FROM term WHERE year(start_date) % 2 = 1), t AS (SELECT seat_id, official_id, make_date(y + 1, 1, 1) AS start_date, make_date(y + 4, 12, 31) AS full_end FROM w),
e AS (SELECT *, lead(start_date) OVER (PARTITION BY seat_id ORDER BY start_date, official_id) AS nxt FROM t), f AS (SELECT *, CASE WHEN nxt IS NULL THEN full_end ELSE least(full_end, nxt - 1) END AS end_date FROM e)
SELECT seat_id, official_id, start_date, end_date, start_date <= DATE '2001-09-01' AND end_date >= DATE '2001-09-01' AS is_current FROM f""")
def r16(c):
    winners = c.term.filter(F.year("start_date") % 2 == 1).select((F.col("official_id") % 7).alias("seat_id"), "official_id", F.year("start_date").alias("year")).distinct()
    return R.terms_from_winners(winners, c.as_of)


@query("r15_roster_sync", "SELECT official_id, official_id % 3 <> 0 AS is_current FROM official WHERE official_id % 2 = 0 UNION ALL SELECT official_id, true FROM official WHERE official_id % 2 = 1 AND official_id % 3 <> 0")
def r15(c):
    stored = c.official.filter("official_id % 2 = 0").select("official_id", F.lit(True).alias("stored"))
    page = c.official.filter("official_id % 3 <> 0").select("official_id", F.lit(True).alias("seen"))
    return stored.join(page, "official_id", "full_outer").select("official_id", F.coalesce("seen", F.lit(False)).alias("is_current"))


@query("x14_page_keyword_score", "SELECT page_id, CASE WHEN contains(lower(html), 'nav') THEN 2 ELSE 0 END + CASE WHEN contains(lower(html), 'email') THEN 3 ELSE 0 END - CASE WHEN contains(lower(html), 'track') THEN 1 ELSE 0 END AS score FROM pages")
def x14(c):
    return c.pages.select("page_id", R.keyword_score(F.col("html"), {"nav": 2, "email": 3, "track": -1}).alias("score"))


@query("x16_time_zone", """SELECT jurisdiction_id, CASE WHEN jurisdiction_id = 2 THEN 'America/Denver' WHEN jurisdiction_id = 3 THEN 'America/Detroit' ELSE CASE state_abbr WHEN 'GA' THEN 'America/New_York' WHEN 'CA' THEN 'America/Los_Angeles' WHEN 'AZ' THEN 'America/Phoenix' WHEN 'IN' THEN 'America/Indiana/Indianapolis' WHEN 'TN' THEN 'America/Chicago' END END AS zone,
 CASE WHEN jurisdiction_id = 2 THEN 'explicit' WHEN jurisdiction_id = 3 THEN 'county' WHEN state_abbr IN ('GA', 'CA', 'AZ') THEN 'state' ELSE 'assumed' END AS source FROM jurisdiction""")
def x16(c):
    j = F.col("jurisdiction_id")
    z = R.time_zone(F.when(j == 2, "America/Denver").when(j == 1, "not a zone"), F.when(j == 3, "America/Detroit"), F.col("state_abbr"))
    return c.jurisdiction.withColumn("z", z).select("jurisdiction_id", "z.zone", "z.source")


@query("x18_notice_days", "SELECT meeting_id, CAST(meeting_date - posted_date AS INT) AS notice FROM meeting WHERE posted_date IS NOT NULL")
def x18(c):
    return c.meeting.filter("posted_date is not null").select("meeting_id", F.datediff("meeting_date", "posted_date").alias("notice"))


@query("x19_comment_cutoff", """SELECT meeting_id, (CAST(meeting_date AS TIMESTAMP) + INTERVAL 18 HOUR + CASE WHEN body_id % 2 = 0 THEN INTERVAL 7 HOUR ELSE INTERVAL 0 HOUR END - INTERVAL 12 HOUR) AS cutoff FROM meeting""")
def x19(c):
    zone = F.when(F.col("body_id") % 2 == 0, "America/Phoenix").otherwise("UTC")
    return c.meeting.select("meeting_id", R.comment_cutoff(F.col("meeting_date"), F.lit(None).cast("string"), zone).alias("cutoff"))


@query("x20_fuzzy_contains", """WITH n AS (SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS hay FROM documents), p AS (SELECT 'licensed under the apache license' AS pin)
SELECT doc_id FROM n, p WHERE contains(hay, pin) OR contains(hay, substr(pin, 1, 40)) OR (contains(hay, 'licensed') AND contains(hay, 'under') AND contains(hay, 'apache') AND contains(hay, 'license'))""")
def x20(c):
    return c.documents.filter(R.text_found(F.col("text"), F.lit("Licensed under the Apache License"))).select("doc_id")


@query("x25_hashes", "SELECT doc_id, sha256(text) AS content_hash, md5(source) AS issue_hash FROM documents")
def x25(c):
    return c.documents.select("doc_id", F.sha2("text", 256).alias("content_hash"), F.md5("source").alias("issue_hash"))


@query("n02_registry_audit", """WITH e AS (SELECT page_id, CASE WHEN NOT starts_with(url, 'https://') THEN 'insecure url' END AS a, CASE WHEN NOT contains(html, '@') THEN 'no contact' END AS b, CASE WHEN contains(url, '?') THEN 'query in url' END AS c FROM pages),
v AS (SELECT page_id, a AS rule FROM e UNION ALL SELECT page_id, b FROM e UNION ALL SELECT page_id, c FROM e) SELECT rule, count(*) AS failed FROM v WHERE rule IS NOT NULL GROUP BY 1""")
def n02(c):
    rules = F.array(
        F.when(~F.col("url").startswith("https://"), "insecure url"), F.when(~F.col("html").contains("@"), "no contact"), F.when(F.col("url").contains("?"), "query in url")
    )
    errors = F.filter(rules, lambda r: r.isNotNull())
    return c.pages.select("page_id", F.explode(errors).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("failed"))


@query("j01_vote_chain", "SELECT j.display_name, v.vote_value, count(*) AS n FROM vote v JOIN motion m ON v.motion_id = m.motion_id JOIN governing_body b ON m.body_id = b.body_id JOIN jurisdiction j ON b.jurisdiction_id = j.jurisdiction_id GROUP BY 1, 2")
def j01(c):
    rows = c.vote.select("motion_id", "vote_value").join(c.motion.select("motion_id", "body_id"), "motion_id")
    rows = rows.join(c.governing_body, "body_id").join(c.jurisdiction, "jurisdiction_id")
    return rows.groupBy("display_name", "vote_value").agg(F.count(F.lit(1)).alias("n"))


@query("j02_left_join_on_predicate", "SELECT b.body_id, count(m.motion_id) AS n FROM governing_body b LEFT JOIN motion m ON b.body_id = m.body_id AND m.motion_type = 'ordinance' AND m.motion_date > DATE '2001-06-01' GROUP BY 1")
def j02(c):
    right = c.motion.filter("motion_type = 'ordinance' and motion_date > date '2001-06-01'").select("body_id", "motion_id")
    return c.governing_body.select("body_id").join(right, "body_id", "left").groupBy("body_id").agg(F.count("motion_id").alias("n"))


@query("j03_semi_anti", "SELECT official_id FROM official o WHERE EXISTS (SELECT 1 FROM vote v WHERE v.official_id = o.official_id AND v.vote_value = 'no') AND NOT EXISTS (SELECT 1 FROM vote v WHERE v.official_id = o.official_id AND v.vote_value = 'conflict_recusal')")
def j03(c):
    of = lambda value: c.vote.filter(F.col("vote_value") == value).select("official_id")
    return c.official.join(of("no"), "official_id", "left_semi").join(of("conflict_recusal"), "official_id", "left_anti").select("official_id")


@query("j11_two_path_attribution", "SELECT f.failure_id, coalesce(b.jurisdiction_id, m.jurisdiction_id, f.jurisdiction_id) AS jurisdiction_id FROM failure f LEFT JOIN governing_body b ON f.failure_id % 50 = b.body_id LEFT JOIN (SELECT meeting_id, jurisdiction_id FROM meeting x JOIN governing_body y ON x.body_id = y.body_id) m ON f.failure_id = m.meeting_id")
def j11(c):
    b = c.governing_body.select(F.col("body_id").cast("long").alias("bid"), F.col("jurisdiction_id").alias("jb"))
    m = c.meeting.select("meeting_id", "body_id").join(c.governing_body.select("body_id", F.col("jurisdiction_id").alias("jm")), "body_id").select("meeting_id", "jm")
    rows = c.failure.withColumn("bid", F.col("failure_id") % 50).join(b, "bid", "left").join(m, F.col("failure_id") == F.col("meeting_id"), "left")
    return rows.select("failure_id", F.coalesce("jb", "jm", "jurisdiction_id").cast("long").alias("jurisdiction_id"))


@query("j14_seat_district_link", "SELECT o.official_id, d.n AS district FROM official o JOIN (SELECT n_nationkey AS n, CAST(n_nationkey AS VARCHAR) AS t FROM nation) d ON regexp_extract(canonical_name, '0*([0-9]+)$', 1) = d.t")
def j14(c):
    d = c.nation.select(F.col("n_nationkey").alias("district"), F.col("n_nationkey").cast("string").alias("t"))
    return c.official.withColumn("t", F.regexp_extract("canonical_name", "0*([0-9]+)$", 1)).join(d, "t").select("official_id", "district")


@query("j15_contest_seat", r"""WITH k AS (SELECT motion_id, CASE WHEN motion_type = 'appointment' THEN 'school_board' ELSE 'city_council' END AS body_type, 'District ' || (motion_id % 9) AS contest FROM motion), s AS (SELECT official_id % 7 AS seat, min(official_id) AS seat_id FROM official GROUP BY 1)
SELECT motion_id, body_type, seat_id FROM k LEFT JOIN s ON CAST(regexp_extract(contest, '(?i)(?:district|ward|dist\.?)\s*[#-]?\s*(\d+)', 1) AS BIGINT) = s.seat""")
def j15(c):
    contest = F.concat(F.lit("District "), (F.col("motion_id") % 9).cast("string"))
    kind = F.when(F.col("motion_type") == "appointment", "school_board").otherwise("city_council")
    k = c.motion.select("motion_id", kind.alias("body_type"), F.regexp_extract(contest, r"(?i)(?:district|ward|dist\.?)\s*[#-]?\s*(\d+)", 1).cast("long").alias("seat"))
    s = c.official.groupBy((F.col("official_id") % 7).alias("seat")).agg(F.min("official_id").alias("seat_id"))
    return k.join(F.broadcast(s), "seat", "left").select("motion_id", "body_type", "seat_id")  # seven seats


@query("a02_conditional_counts", "SELECT body_id, count(*) FILTER (WHERE outcome = 'passed') AS passed, sum(CASE WHEN outcome = 'failed' THEN 1 ELSE 0 END)::BIGINT AS failed FROM motion GROUP BY 1")
def a02(c):
    return c.motion.groupBy("body_id").agg(F.count_if(F.col("outcome") == "passed").alias("passed"), F.sum(F.when(F.col("outcome") == "failed", 1).otherwise(0)).alias("failed"))


@query("a03_count_distinct", "SELECT body_id, count(DISTINCT petitioner) AS petitioners, count(DISTINCT year(motion_date)) AS years FROM motion GROUP BY 1")
def a03(c):
    return c.motion.groupBy("body_id").agg(F.countDistinct("petitioner").alias("petitioners"), F.countDistinct(F.year("motion_date")).alias("years"))


@query("a09_recent_average_per_user", "SELECT user_id, round(avg(-amount_cents), 6) AS avg_cents, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM fund_event WHERE kind = 'spend') a WHERE rn <= 50 GROUP BY 1")
def a09(c):
    from quorumdf.operators.ledger import recent_average

    return recent_average(c.fund_event, ["user_id"], 50)


@query("a10_parsed_entity", "SELECT lower(split_part(p_name, ' ', 1)) AS first, count(*) AS n, count(DISTINCT p_brand) AS titles, min(p_size) AS low, max(p_size) AS high FROM part GROUP BY 1")
def a10(c):
    first = F.lower(F.get(F.split("p_name", " "), F.lit(0)))
    return c.part.groupBy(first.alias("first")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("p_brand").alias("titles"), F.min("p_size").alias("low"), F.max("p_size").alias("high"))


@query("w06_primary_part", "SELECT p_brand, string_agg(p_type, '|' ORDER BY n DESC, p_type) AS types FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2) a GROUP BY 1")
def w06(c):
    per = c.part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "p_type")))
    return per.groupBy("p_brand").agg(F.array_join(F.transform(ordered, lambda s: s["p_type"]), "|").alias("types"))


@query("u04_set_equality", "WITH s AS (SELECT body_id, list_sort(list(DISTINCT motion_type)) AS t FROM motion GROUP BY 1) SELECT body_id, len(t) AS n, t = list_sort(['zoning_change', 'ordinance', 'resolution', 'appointment', 'procedural']) AS same FROM s")
def u04(c):
    wanted = F.array_sort(F.array(*map(F.lit, ["zoning_change", "ordinance", "resolution", "appointment", "procedural"])))
    return c.motion.groupBy("body_id").agg(F.array_sort(F.collect_set("motion_type")).alias("t")).select("body_id", F.size("t").alias("n"), (F.col("t") == wanted).alias("same"))


@query("f03_like_escaped", "SELECT count(*) FILTER (WHERE n_name LIKE 'U_ITED%') AS any_char, count(*) FILTER (WHERE n_name ILIKE '%united%') AS folded FROM nation")
def f03(c):
    return c.nation.agg(F.count_if(F.col("n_name").like("U_ITED%")).alias("any_char"), F.count_if(F.col("n_name").ilike("%united%")).alias("folded"))


@query("f06_array_overlap", "SELECT body_id, list_has_any(list(DISTINCT motion_type), ['ordinance', 'nothing']) AS hit FROM motion GROUP BY 1")
def f06(c):
    wanted = F.array(F.lit("ordinance"), F.lit("nothing"))
    return c.motion.groupBy("body_id").agg(F.arrays_overlap(F.collect_set("motion_type"), wanted).alias("hit"))


@query("k09_calendar_enrich", """WITH s AS (SELECT DISTINCT body_id, meeting_date FROM meeting WHERE meeting_id % 4 = 0 UNION SELECT body_id, meeting_date + 400 FROM meeting WHERE meeting_id % 40 = 0),
m AS (SELECT *, row_number() OVER (PARTITION BY body_id, meeting_date ORDER BY CASE WHEN agenda_url IS NULL THEN 1 ELSE 0 END, meeting_id) AS rn FROM meeting)
SELECT s.body_id, s.meeting_date, m.meeting_id, CASE WHEN m.meeting_id IS NULL THEN 'scheduled' ELSE 'enriched' END AS action FROM s LEFT JOIN m ON s.body_id = m.body_id AND s.meeting_date = m.meeting_date AND rn = 1""")
def k09(c):
    cal = c.meeting.filter("meeting_id % 4 = 0").select("body_id", "meeting_date").union(c.meeting.filter("meeting_id % 40 = 0").select("body_id", F.date_add("meeting_date", 400))).distinct()
    best = P.latest(c.meeting, ["body_id", "meeting_date"], F.col("agenda_url").isNull().cast("int"), "meeting_id").select("body_id", "meeting_date", "meeting_id")
    return cal.join(best, ["body_id", "meeting_date"], "left").withColumn("action", F.when(F.col("meeting_id").isNull(), "scheduled").otherwise("enriched"))


@query("k12_find_or_create", "SELECT n_nationkey + 1000 AS body_id, n_name FROM nation WHERE n_nationkey % 2 = 0")
def k12(c):
    have = c.nation.filter("n_nationkey % 2 = 1").select((F.col("n_nationkey") + 1000).alias("body_id"), "n_name")
    feed = c.nation.select((F.col("n_nationkey") + 1000).alias("body_id"), "n_name").unionByName(c.nation.select(F.lit(None).cast("int").alias("body_id"), F.lit(None).cast("string").alias("n_name")))
    return K.insert_absent(have, feed, ["n_name"])


@query("m02_block_user", "SELECT comment_id, CASE WHEN user_id % 10 = 3 THEN 'rejected' ELSE 'published' END AS status FROM citizen_comment")
def m02(c):
    blocked = c.citizen_comment.filter("user_id % 10 = 3").select("user_id").distinct().withColumn("blocked", F.lit(True))
    return c.citizen_comment.join(blocked, "user_id", "left").select("comment_id", F.when(F.col("blocked"), "rejected").otherwise("published").alias("status"))


@query("m05_home_change_cooldown", """WITH RECURSIVE e AS (SELECT user_id, event_id, ts, event_id % 3 AS home, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
f AS (SELECT user_id, i, event_id, home AS cur, ts AS changed, 'first' AS decision FROM e WHERE i = 1 UNION ALL SELECT e.user_id, e.i, e.event_id, CASE WHEN e.home <> cur AND e.ts >= changed + INTERVAL 30 DAY THEN e.home ELSE cur END, CASE WHEN e.home <> cur AND e.ts >= changed + INTERVAL 30 DAY THEN e.ts ELSE changed END,
 CASE WHEN e.home = cur THEN 'noop' WHEN e.ts >= changed + INTERVAL 30 DAY THEN 'changed' ELSE 'cooldown' END FROM f JOIN e ON e.user_id = f.user_id AND e.i = f.i + 1) SELECT event_id, decision FROM f""")
def m05(c):
    import pandas as pd

    def fold(pdf):
        pdf = pdf.sort_values(["ts", "event_id"])
        out, cur, changed = [], None, None
        for event, ts, home in zip(pdf["event_id"], pdf["ts"], pdf["home"]):
            if cur is None:
                cur, changed, decision = home, ts, "first"
            elif home == cur:
                decision = "noop"
            elif ts >= changed + pd.Timedelta(days=30):
                cur, changed, decision = home, ts, "changed"
            else:
                decision = "cooldown"
            out.append((event, decision))
        return pd.DataFrame(out, columns=["event_id", "decision"])

    rows = c.events.select("user_id", "event_id", "ts", (F.col("event_id") % 3).alias("home"))
    return rows.groupBy("user_id").applyInPandas(fold, "event_id long, decision string")


@query("p15_quarantine_list", f"SELECT m.motion_id, m.title, t.pattern_id, coalesce(n_votes, 0) AS n_votes FROM motion m JOIN ({_TOP}) t ON m.motion_id = t.motion_id LEFT JOIN tally y ON m.motion_id = y.motion_id")
def p15(c):
    top = D.top_finding(D.run_detectors(c)).select("motion_id", "pattern_id")
    return c.motion.select("motion_id", "title").join(top, "motion_id").join(c.tally.select("motion_id", "n_votes"), "motion_id", "left").fillna(0, ["n_votes"])


@query("p16_triage_list", "SELECT failure_id, job, created_at FROM failure WHERE NOT resolved AND job = 'job1'")
def p16(c):
    return c.failure.filter("not resolved and job = 'job1'").select("failure_id", "job", "created_at")


@query("l06_historical_unlock", "SELECT jurisdiction_id, available, needed, CASE WHEN needed IS NULL THEN 'locked' WHEN needed <= 0 OR available >= needed THEN 'unlocked' ELSE 'locked' END AS phase FROM (SELECT jurisdiction_id, sum(amount_cents)::BIGINT AS available, CASE WHEN jurisdiction_id = 4 THEN NULL ELSE (jurisdiction_id - 1) * 1000 END AS needed FROM fund_event GROUP BY 1) a")
def l06(c):
    a = c.fund_event.groupBy("jurisdiction_id").agg(F.sum("amount_cents").alias("available"))
    needed = F.when(F.col("jurisdiction_id") != 4, (F.col("jurisdiction_id") - 1) * 1000)
    phase = F.when(F.col("needed").isNull(), "locked").when((F.col("needed") <= 0) | (F.col("available") >= F.col("needed")), "unlocked").otherwise("locked")
    return a.withColumn("needed", needed).withColumn("phase", phase)


@query("c01_rule_applicability", """WITH r AS (SELECT 'GA' AS st, 'minutes' AS cat, 'city_council' AS bt UNION ALL SELECT 'GA', 'minutes', 'school_board' UNION ALL SELECT 'IN', 'notice', NULL) SELECT b.body_id, r.cat AS category FROM governing_body b JOIN jurisdiction j ON b.jurisdiction_id = j.jurisdiction_id JOIN r ON r.st = j.state_abbr AND (r.bt IS NULL OR r.bt = b.body_type)""")
def c01(c):
    rules = c.spark.createDataFrame([("GA", "minutes", ["city_council", "school_board"]), ("IN", "notice", None)], "state_abbr string, category string, applies_to array<string>")
    every = ["city_council", "county_commission", "school_board", "planning_commission"]
    rules = rules.withColumn("body_type", F.explode(F.coalesce("applies_to", F.array(*map(F.lit, every))))).drop("applies_to")
    rows = c.governing_body.join(c.jurisdiction, "jurisdiction_id")
    return rows.join(F.broadcast(rules), ["state_abbr", "body_type"]).select("body_id", "category")  # the catalog is one row per state and rule


@query("e02_surname_as_of", "SELECT v.motion_id, count(DISTINCT v.official_id) AS n_active FROM vote v JOIN term t ON v.official_id = t.official_id AND t.start_date <= v.motion_date AND coalesce(t.end_date, DATE '9999-12-31') >= v.motion_date GROUP BY 1")
def e02(c):
    n = parts(c.lineitem)
    c.deal("lineitem", "l_orderkey")
    t, v = c.term.select("official_id", "start_date", "end_date"), c.vote.select("motion_id", "official_id", "motion_date").repartition(n, "official_id")
    live = v.join(t, "official_id").filter((F.col("start_date") <= F.col("motion_date")) & (F.col("end_date").isNull() | (F.col("end_date") >= F.col("motion_date"))))
    return live.select("motion_id", "official_id").repartition(n, "motion_id").groupBy("motion_id").agg(F.countDistinct("official_id").alias("n_active"))


@query("e15_staff_stubs", "SELECT lower(petitioner) AS name, count(*) AS n, min(motion_date) AS first_date, max(motion_date) AS last_date FROM motion WHERE petitioner LIKE 'City Manager %' GROUP BY 1 HAVING count(*) >= 2")
def e15(c):
    rows = c.motion.filter(F.col("petitioner").like("City Manager %"))
    return rows.groupBy(F.lower("petitioner").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.min("motion_date").alias("first_date"), F.max("motion_date").alias("last_date")).filter("n >= 2")


@query("h08_resolve_linked_failures", "SELECT failure_id, resolved OR failure_id % 12 = 0 AS resolved FROM failure")
def h08(c):
    linked = c.failure.filter("failure_id % 12 = 0").select("failure_id", F.lit(True).alias("hit"))
    return c.failure.join(linked, "failure_id", "left").select("failure_id", (F.col("resolved") | F.coalesce("hit", F.lit(False))).alias("resolved"))


@query("z04_issue_lifecycle_batch", "SELECT user_id, CASE WHEN bool_or(event_type = 'error') AND max(ts) FILTER (WHERE event_type = 'error') >= coalesce(max(ts) FILTER (WHERE event_type = 'purchase'), TIMESTAMP '1970-01-01') THEN 'open' WHEN bool_or(event_type = 'error') THEN 'resolved' ELSE 'none' END AS status FROM events GROUP BY 1")
def z04(c):
    err = F.max(F.when(F.col("event_type") == "error", F.col("ts")))
    ok = F.max(F.when(F.col("event_type") == "purchase", F.col("ts")))
    per = c.events.groupBy("user_id").agg(err.alias("err"), ok.alias("ok"))
    return per.select("user_id", F.when(F.col("err").isNull(), "none").when(F.col("ok").isNull() | (F.col("err") >= F.col("ok")), "open").otherwise("resolved").alias("status"))
