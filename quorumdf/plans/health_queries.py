"""Queries of pipeline health, documents, comments, predicates, expressions and audits."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from quorumdf.functions import names as N
from quorumdf.operators import documents as T
from quorumdf.operators import health as H
from quorumdf.operators import observers as O

from .registry import query

AS = "DATE '2001-09-01'"


@query("h01_stale_runs", "SELECT user_id, max(ts) AS last_run FROM fund_event GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 36 HOUR")
def h01(c):
    return H.stale_runs(c.fund_event, ["user_id"], "ts", "2024-01-31 00:00:00")


@query("h02_source_drift", f"""WITH g AS (SELECT *, CAST(meeting_date - lag(meeting_date) OVER (PARTITION BY body_id ORDER BY meeting_date, meeting_id) AS INT) AS gap FROM meeting),
p AS (SELECT body_id, count(*) FILTER (WHERE gap > 0) AS n_gaps, median(CASE WHEN gap > 0 THEN gap END) AS median_gap, CAST({AS} - max(meeting_date) AS INT) AS silent,
  count(*) FILTER (WHERE meeting_date >= {AS} - 180 AND meeting_date <= {AS}) AS recent, count(*) FILTER (WHERE meeting_date >= {AS} - 180 AND agenda_url IS NULL) AS dead FROM g GROUP BY 1),
k AS (SELECT *, CASE WHEN n_gaps >= 5 AND silent > greatest(3 * median_gap, 90) THEN 'cold_inventory' WHEN dead >= 3 AND dead > recent / 2.0 THEN 'dead_documents' END AS kind FROM p)
SELECT body_id, n_gaps, median_gap, silent, kind FROM k WHERE kind IS NOT NULL""")
def h02(c):
    return H.source_drift(c.meeting, c.as_of)


@query("h03_failure_rollup", """SELECT jurisdiction_id, job, step, count(*) AS n, max_by(message, (created_at, failure_id)) AS latest, array_to_string((list(failure_id ORDER BY failure_id))[1:10], ',') AS ids FROM failure WHERE NOT resolved GROUP BY 1, 2, 3""")
def h03(c):
    return H.failure_rollup(c.failure)


@query("h06_run_outcome", """SELECT jurisdiction_id, count(*) AS n, count(*) FILTER (WHERE status = 'failed') AS failed,
 CASE WHEN count(*) FILTER (WHERE status = 'failed') = count(*) THEN 'failed' WHEN count(*) FILTER (WHERE status = 'failed') > 0 THEN 'partial' WHEN count(*) FILTER (WHERE status = 'partial') > 0 THEN 'paused' ELSE 'ok' END AS outcome FROM outcome GROUP BY 1""")
def h06(c):
    return H.run_outcome(c.outcome, "jurisdiction_id")


@query("h09_extraction_health", """SELECT method, status, count(*) AS n, sum(n_missing)::BIGINT AS missing, sum(n_garbled)::BIGINT AS garbled FROM outcome GROUP BY 1, 2""")
def h09(c):
    return c.outcome.groupBy("method", "status").agg(F.count(F.lit(1)).alias("n"), F.sum("n_missing").alias("missing"), F.sum("n_garbled").alias("garbled"))


LADDER = """SELECT jurisdiction_id, capability, n, CASE WHEN n = 0 THEN 'coming_soon' WHEN capability IN ('motions', 'contributions') THEN 'indexed' WHEN n * 2 >= meetings THEN 'indexed' ELSE 'in_progress' END AS state FROM (
 WITH m AS (SELECT jurisdiction_id, count(*) AS meetings, count(agenda_url) AS agendas, count(minutes_url) AS minutes, count(packet_url) AS packets FROM meeting x JOIN governing_body b ON x.body_id = b.body_id GROUP BY 1),
 n AS (SELECT jurisdiction_id, count(*) AS motions FROM motion x JOIN governing_body b ON x.body_id = b.body_id GROUP BY 1),
 k AS (SELECT b.jurisdiction_id, count(*) AS gifts FROM contribution x JOIN official o ON x.official_id = o.official_id JOIN governing_body b ON o.body_id = b.body_id GROUP BY 1),
 w AS (SELECT m.*, coalesce(motions, 0) AS motions, coalesce(gifts, 0) AS gifts FROM m LEFT JOIN n ON m.jurisdiction_id = n.jurisdiction_id LEFT JOIN k ON m.jurisdiction_id = k.jurisdiction_id)
 SELECT jurisdiction_id, meetings, 'agendas' AS capability, agendas AS n FROM w UNION ALL SELECT jurisdiction_id, meetings, 'minutes', minutes FROM w UNION ALL SELECT jurisdiction_id, meetings, 'packets', packets FROM w
 UNION ALL SELECT jurisdiction_id, meetings, 'motions', motions FROM w UNION ALL SELECT jurisdiction_id, meetings, 'contributions', gifts FROM w) z"""


@query("h10_capability_ladder", LADDER)
def h10(c):
    return H.capability_ladder(c.meeting, c.motion, c.contribution, c.official, c.governing_body)


@query("h11_capability_transition", f"""WITH n AS ({LADDER}), p AS (SELECT jurisdiction_id, capability, state AS old, CASE WHEN state = 'indexed' AND jurisdiction_id % 2 = 0 THEN DATE '2000-01-01' END AS first_indexed FROM n WHERE capability <> 'packets')
SELECT n.jurisdiction_id, n.capability, state, coalesce(first_indexed, CASE WHEN state = 'indexed' THEN {AS} END) AS first_indexed, state = 'indexed' AND first_indexed IS NULL AS milestone, old IS NULL AS backfilled FROM n LEFT JOIN p ON n.jurisdiction_id = p.jurisdiction_id AND n.capability = p.capability""")
def h11(c):
    now = h10(c)
    first = F.when((F.col("state") == "indexed") & (F.col("jurisdiction_id") % 2 == 0), F.lit("2000-01-01").cast("date"))
    return H.capability_transition(now, now.filter("capability <> 'packets'").withColumn("first_indexed", first), c.as_of)


@query("h12_roster_events", f"""SELECT seat_id, 'joined' AS event, start_date AS event_date, official_id FROM term WHERE start_date <= {AS} UNION ALL SELECT seat_id, 'left', end_date, official_id FROM term WHERE end_date <= {AS}
 UNION ALL SELECT seat_id, 'vacant', max(end_date) FILTER (WHERE end_date <= {AS}), NULL FROM term GROUP BY seat_id HAVING count(*) FILTER (WHERE end_date IS NULL OR end_date > {AS}) = 0 AND max(end_date) FILTER (WHERE end_date <= {AS}) IS NOT NULL""")
def h12(c):
    return H.roster_events(c.term, c.as_of)


@query("h13_milestone_once", "SELECT jurisdiction_id, key, min(event_id) AS event_id FROM (SELECT event_id, user_id % 5 AS jurisdiction_id, event_type || ':' || (user_id % 10) AS key FROM events) a GROUP BY 1, 2")
def h13(c):
    key = F.concat_ws(":", "event_type", (F.col("user_id") % 10).cast("string"))
    return c.events.select("event_id", (F.col("user_id") % 5).alias("jurisdiction_id"), key.alias("key")).groupBy("jurisdiction_id", "key").agg(F.min("event_id").alias("event_id"))


@query("h14_contact_drift", r"""WITH e AS (SELECT page_id, list_distinct(list_transform(regexp_extract_all(html, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}'), lambda x: lower(x))) AS emails, 'clerk@mail' || (page_id % 10) || '.example.com' AS stored, 'mail' || (page_id % 10) || '.example.com' AS domain FROM pages),
o AS (SELECT *, list_filter(emails, lambda x: ends_with(x, '@' || domain)) AS own FROM e)
SELECT page_id, CAST(len(emails) AS INT) AS n_emails, CASE WHEN list_contains(emails, stored) THEN 'verified' WHEN len(list_filter(own, lambda x: regexp_matches(x, 'clerk|records|info'))) > 0 OR len(own) = 1 THEN 'changed' ELSE 'inconclusive' END AS status FROM o""")
def h14(c):
    domain = F.concat(F.lit("mail"), (F.col("page_id") % 10).cast("string"), F.lit(".example.com"))
    return H.contact_drift(c.pages, F.concat(F.lit("clerk@"), domain), domain)


@query("h15_delivery_status", "SELECT user_id, n, CASE l WHEN 'error' THEN 'undeliverable' WHEN 'purchase' THEN 'verified' ELSE 'unchanged' END AS status FROM (SELECT user_id, count(*) AS n, max_by(event_type, (ts, event_id)) AS l FROM events GROUP BY 1) a")
def h15(c):
    return H.delivery_status(c.events)


@query("h16_document_availability", """SELECT event_id, verdict, CASE WHEN verdict = 'inconclusive' THEN old_flag ELSE verdict IN ('placeholder', 'gone') END AS flag FROM (SELECT *, CASE WHEN http_status IN (404, 410) THEN 'gone' WHEN http_status = 200 AND coalesce(content_length, body_bytes) < 2000 THEN 'placeholder' WHEN http_status = 200 THEN 'available' ELSE 'inconclusive' END AS verdict
 FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 404 WHEN 1 THEN 429 ELSE 200 END AS http_status, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 4000 END AS content_length, event_id % 3000 AS body_bytes, event_id % 2 = 0 AS old_flag FROM events) a) b""")
def h16(c):
    e = F.col("event_id")
    probe = c.events.select("event_id", F.when(e % 5 == 0, 404).when(e % 5 == 1, 429).otherwise(200).alias("http_status"), F.when(e % 3 != 0, e % 4000).alias("content_length"), (e % 3000).alias("body_bytes"), (e % 2 == 0).alias("old_flag"))
    return H.availability(probe).select("event_id", "verdict", "flag")


@query("h17_body_verdict", """SELECT user_id, count(*) AS n, CASE WHEN bool_or(event_id % 5 = 2) THEN 'OK' WHEN bool_and(event_id % 5 = 0) THEN 'FAILED' ELSE 'UNVERIFIED' END AS verdict FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) a WHERE rn <= 8 GROUP BY 1""")
def h17(c):
    w = Window.partitionBy("user_id").orderBy(F.desc("event_id"))
    rows = c.events.withColumn("rn", F.row_number().over(w)).filter("rn <= 8")
    verdict = F.when(F.bool_or(F.col("event_id") % 5 == 2), "OK").when(F.bool_and(F.col("event_id") % 5 == 0), "FAILED").otherwise("UNVERIFIED")
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), verdict.alias("verdict"))


@query("h19_incremental_cutoff", f"""SELECT body_id, CASE WHEN known > 0 THEN greatest(least({AS} - 120, coalesce(pending, {AS})), {AS} - 400) END AS cutoff FROM (SELECT body_id, count(minutes_url) AS known, min(CASE WHEN minutes_url IS NULL THEN meeting_date END) AS pending FROM meeting GROUP BY 1) a""")
def h19(c):
    return H.incremental_cutoff(c.meeting, c.as_of)


@query("f01_json_key_existence", "SELECT meeting_id FROM meeting WHERE list_contains(json_keys(meta), 'agenda_unavailable')")
def f01(c):
    return c.meeting.filter(O.has_key(F.col("meta"), "agenda_unavailable")).select("meeting_id")


@query("f02_null_safe_equality", "SELECT meeting_id FROM meeting WHERE replace(agenda_url, 'agenda', 'x') IS NOT DISTINCT FROM replace(minutes_url, 'minutes', 'x')")
def f02(c):
    return c.meeting.filter(F.expr("replace(agenda_url, 'agenda', 'x') <=> replace(minutes_url, 'minutes', 'x')")).select("meeting_id")


@query("f04_regex_pair", "SELECT motion_id FROM motion WHERE regexp_matches(title, '(?i)budget') AND NOT regexp_matches(title, '(?i)amend|adjust')")
def f04(c):
    return c.motion.filter(F.col("title").rlike("(?i)budget") & ~F.col("title").rlike("(?i)amend|adjust")).select("motion_id")


@query("f07_rolling_dates", f"SELECT meeting_id FROM meeting WHERE meeting_date >= {AS} - 180 AND meeting_date < CAST({AS} - INTERVAL 1 MONTH AS DATE)")
def f07(c):
    now = O.day(c.as_of)
    return c.meeting.filter((F.col("meeting_date") >= F.date_sub(now, 180)) & (F.col("meeting_date") < F.add_months(now, -1))).select("meeting_id")


@query("f08_due_for_rescan", f"""SELECT meeting_id FROM (SELECT meeting_id, CASE WHEN meeting_id % 4 <> 0 THEN meeting_id % 40 END AS age FROM meeting) a WHERE age IS NULL OR (meeting_id % 3 = 0 AND age > 7) OR (meeting_id % 3 <> 0 AND age > 30)""")
def f08(c):
    m = F.col("meeting_id")  # what the scans left
    scanned = F.when(m % 4 != 0, F.date_sub(F.lit(c.as_of).cast("date"), (m % 40).cast("int")))
    return H.rescan_due(c.meeting.withColumns({"scanned_on": scanned, "is_placeholder": m % 3 == 0}), c.as_of)


@query("f09_pending_work", "SELECT meeting_id FROM meeting m WHERE minutes_url IS NOT NULL AND NOT EXISTS (SELECT 1 FROM motion k WHERE k.meeting_id = m.meeting_id AND k.motion_type = 'zoning_change')")
def f09(c):
    done = c.motion.filter("motion_type = 'zoning_change'").select("meeting_id")
    return c.meeting.filter("minutes_url is not null").join(done, "meeting_id", "left_anti").select("meeting_id")


@query("f10_build_phase_gate", f"SELECT jurisdiction_id, count(*) FILTER (WHERE keep) AS kept, count(*) FILTER (WHERE NOT keep) AS deferred FROM (SELECT b.jurisdiction_id, meeting_date >= {AS} - 730 OR b.jurisdiction_id % 2 = 0 AS keep FROM meeting m JOIN governing_body b ON m.body_id = b.body_id) a GROUP BY 1")
def f10(c):
    rows = c.meeting.join(c.governing_body, "body_id")
    keep = (F.col("meeting_date") >= F.date_sub(O.day(c.as_of), 730)) | (F.col("jurisdiction_id") % 2 == 0)
    return rows.groupBy("jurisdiction_id").agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("deferred"))


@query("f12_weekly_sweep", "SELECT body_id FROM governing_body WHERE coalesce(TRY_CAST(CASE WHEN body_id % 6 = 0 THEN 'x' ELSE CAST(1000 + body_id AS VARCHAR) END AS BIGINT), 0) % 7 = isodow(DATE '2001-09-01') - 1")
def f12(c):
    fips = F.when(F.col("body_id") % 6 == 0, "x").otherwise((1000 + F.col("body_id")).cast("string"))
    return c.governing_body.withColumn("fips", fips).filter(F.coalesce(F.expr("try_cast(fips as bigint)"), F.lit(0)) % 7 == F.weekday(O.day(c.as_of))).select("body_id")


@query("t01_content_addressed_texts", "SELECT sha256(coalesce(text, '')) AS hash, min(doc_id) AS first_id, count(*) AS n_ids, max(length(text)) AS n_chars FROM documents GROUP BY 1")
def t01(c):
    return T.content_addressed(c.documents, "doc_id", "text")[0]


@query("t02_page_windows", """WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS page, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)
SELECT doc_id, (pos // 10) * 10 + 1 AS first_page, count(*) AS n_pages, string_agg(page, chr(10) ORDER BY pos) AS text FROM p GROUP BY 1, 2""")
def t02(c):
    return T.page_windows(c.documents, "doc_id", "text")


@query("t03_text_verdict", "SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'not_pdf' WHEN length(text) >= 200 THEN 'text' WHEN n_chars * 3 <= 300 THEN 'stub' ELSE 'needs_ocr' END AS verdict FROM documents")
def t03(c):
    magic = F.when(F.col("doc_id") % 11 == 0, "<htm").otherwise("%PDF")
    size = F.when(F.col("n_chars") * 3 <= 300, 5000).otherwise(5001)
    return c.documents.select("doc_id", T.text_verdict(F.length("text"), size, magic).alias("verdict"))


@query("t04_summary_pages", r"""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS page, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
s AS (SELECT *, round(len(regexp_extract_all(lower(page), 'the')) + len(regexp_extract_all(lower(page), 'ing')) + least(length(regexp_replace(page, '[^0-9]', '', 'g')) / 200, 5.0), 6) AS score FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS rn FROM s) SELECT doc_id, CAST(pos AS INT) AS pos, score FROM r WHERE rn <= 5 OR pos < 3""")
def t04(c):
    return T.summary_pages(c.documents, "doc_id", "text", ["the", "ing"], 5)


@query("t05_segment_islands", """WITH s AS (SELECT l_orderkey AS packet, l_linenumber * 3 AS start_page, l_linenumber * 3 + CAST(l_quantity AS INT) % 5 AS end_page FROM lineitem),
m AS (SELECT *, max(end_page) OVER (PARTITION BY packet ORDER BY start_page, end_page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
o AS (SELECT *, CASE WHEN reach IS NULL OR start_page > reach + 1 THEN 1 ELSE 0 END AS opens FROM m),
i AS (SELECT *, sum(opens) OVER (PARTITION BY packet ORDER BY start_page, end_page, opens DESC ROWS UNBOUNDED PRECEDING) AS island FROM o),
g AS (SELECT packet, island, min(start_page) AS a, max(end_page) AS b, count(*) AS n, max(end_page - start_page) AS span, max(CASE WHEN true THEN (end_page - start_page) * 1000000 - start_page END) AS best FROM i GROUP BY 1, 2)
SELECT packet, a AS start_page, b AS end_page, n FROM (SELECT *, row_number() OVER (PARTITION BY packet ORDER BY best DESC) AS rn FROM g) z WHERE rn = 1""")
def t05(c):
    seg = c.lineitem.select(F.col("l_orderkey").alias("packet"), (F.col("l_linenumber") * 3).alias("start_page"), (F.col("l_linenumber") * 3 + F.col("l_quantity").cast("int") % 5).alias("end_page"))
    return T.merge_segments(seg, ["packet"])


@query("t07_token_search", r"SELECT doc_id FROM documents WHERE list_contains(regexp_split_to_array(lower(text), '[^a-z0-9]+'), 'the') AND list_contains(regexp_split_to_array(lower(text), '[^a-z0-9]+'), 'license')")
def t07(c):
    return T.token_search(c.documents, "doc_id", "text", ["the", "license"])


@query("t08_cache_split", "SELECT doc_id, EXISTS (SELECT 1 FROM documents k WHERE k.doc_id % 5 = 0 AND sha256(k.text) = sha256(d.text)) AS hit FROM documents d")
def t08(c):
    rows = c.documents.select("doc_id", T.content_hash(F.col("text")).alias("hash"))
    return T.cache_split(rows, rows.filter("doc_id % 5 = 0"), ["hash"]).select("doc_id", "hit")


@query("m01_comment_admission", """SELECT comment_id, CASE WHEN role <> 'user' THEN 'inactive' WHEN user_id % 4 = 0 THEN 'no_home' WHEN item_id % 7 = 0 THEN 'closed' WHEN rn > 1 THEN 'duplicate' ELSE 'accepted' END AS decision
 FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id, role ORDER BY turn) AS rn FROM citizen_comment) a""")
def m01(c):
    w = Window.partitionBy("user_id", "item_id", "role").orderBy("turn")
    decision = (
        F.when(F.col("role") != "user", "inactive").when(F.col("user_id") % 4 == 0, "no_home").when(F.col("item_id") % 7 == 0, "closed").when(F.row_number().over(w) > 1, "duplicate").otherwise("accepted")
    )
    return c.citizen_comment.select("comment_id", decision.alias("decision"))


@query("m04_digest_compile", """SELECT item_id, count(*) FILTER (WHERE stance = 'support') AS support, count(*) FILTER (WHERE stance = 'oppose') AS oppose, count(*) FILTER (WHERE stance = 'neutral') AS neutral,
 string_agg(stance || ': ' || text, chr(10) ORDER BY comment_id) AS lines FROM citizen_comment WHERE role = 'user' GROUP BY 1""")
def m04(c):
    line = F.concat_ws(": ", "stance", "text")
    lines = F.transform(F.sort_array(F.collect_list(F.struct("comment_id", line.alias("line")))), lambda s: s["line"])
    counts = [F.count_if(F.col("stance") == s).alias(s) for s in ("support", "oppose", "neutral")]
    return c.citizen_comment.filter("role = 'user'").groupBy("item_id").agg(*counts, F.array_join(lines, "\n").alias("lines"))


@query("n01_constraint_audit", """SELECT 'lineitem' AS tbl, 'unique(l_orderkey,l_linenumber)' AS rule, count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) a
 UNION ALL SELECT 'orders', 'fk(o_custkey)', count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
 UNION ALL SELECT 'orders', 'enum(o_orderstatus)', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
 UNION ALL SELECT 'part', 'not_null(p_name)', count(*) FROM part WHERE p_name IS NULL""")
def n01(c):
    row = lambda df, t, r: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("tbl"), F.lit(r).alias("rule"), "n")
    dup = c.lineitem.groupBy("l_orderkey", "l_linenumber").count().filter("count > 1")
    fk = c.orders.join(c.customer.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti")
    return (
        row(dup, "lineitem", "unique(l_orderkey,l_linenumber)").unionAll(row(fk, "orders", "fk(o_custkey)"))
        .unionAll(row(c.orders.filter("o_orderstatus not in ('F', 'O')"), "orders", "enum(o_orderstatus)")).unionAll(row(c.part.filter("p_name is null"), "part", "not_null(p_name)"))
    )


@query("x09_posted_stamp", r"""SELECT motion_id, strptime('Posted ' || strftime(motion_date, '%B') || ' ' || day(motion_date) || ', ' || year(motion_date) || ' 5:' || lpad(CAST(motion_id % 60 AS VARCHAR), 2, '0') || ' PM', 'Posted %B %-d, %Y %-I:%M %p') AS posted_at FROM motion""")
def x09(c):
    from quorumdf.sources.listings import posted_stamp

    text = F.concat(F.lit("Posted "), F.date_format("motion_date", "MMMM d, yyyy"), F.lit(" 5:"), F.lpad((F.col("motion_id") % 60).cast("string"), 2, "0"), F.lit(" PM"))
    return c.motion.select("motion_id", posted_stamp(text).alias("posted_at"))


@query("x12_filing_kind", """SELECT motion_id, CASE WHEN contains(lower(title), 'budget') THEN 'budget' WHEN contains(lower(title), 'parcel') THEN 'land' ELSE 'other' END AS kind, TRY_CAST(regexp_extract(title, '(\\d{3})$', 1) AS INT) AS yr FROM motion""")
def x12(c):
    t = F.lower("title")
    return c.motion.select("motion_id", F.when(t.contains("budget"), "budget").when(t.contains("parcel"), "land").otherwise("other").alias("kind"), F.expr("try_cast(regexp_extract(title, '(\\\\d{3})$', 1) as int)").alias("yr"))


@query("x27_years_of_record", "SELECT official_id, round_even(date_diff('day', min(motion_date), max(motion_date)) / 365.25, 1) AS years FROM vote GROUP BY 1")
def x27(c):
    return c.vote.groupBy("official_id").agg(F.bround(F.datediff(F.max("motion_date"), F.min("motion_date")) / 365.25, 1).alias("years"))


@query("x11_slugify", r"SELECT p_partkey, trim(regexp_replace(lower(p_name || ' (Balance) City'), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part")
def x11(c):
    return c.part.select("p_partkey", N.slug(F.concat("p_name", F.lit(" (Balance) City"))).alias("slug"))
