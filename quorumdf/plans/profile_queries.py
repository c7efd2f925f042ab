"""Profile, dashboard, aggregation, window, top-k, set and join queries."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from quorumdf.operators import profiles as P

from .registry import query

AS = "DATE '2001-09-01'"
CURRENT = f"""SELECT official_id, seat_id, start_date FROM (SELECT *, row_number() OVER (PARTITION BY official_id ORDER BY start_date DESC, term_id DESC) AS rn
  FROM term WHERE start_date <= {AS} AND (end_date IS NULL OR end_date >= {AS})) a WHERE rn = 1"""


@query("p01_identity_current_seat", f"SELECT o.*, c.seat_id, c.start_date FROM official o LEFT JOIN ({CURRENT}) c ON o.official_id = c.official_id")
def p01(c):
    return P.identity(c.official, c.term, c.as_of)


@query("p02_career_history", "SELECT official_id, count(*) AS n_terms, min(start_date) AS first_start, max(end_date) AS last_end, count(*) FILTER (WHERE end_date IS NULL) AS open_terms FROM term GROUP BY 1")
def p02(c):
    return P.career(c.term)


@query("p03_voting_record", """SELECT official_id, motion_id, motion_date, vote_value, motion_type, outcome, rn FROM (
  SELECT v.official_id, v.motion_id, v.motion_date, v.vote_value, motion_type, outcome, row_number() OVER (PARTITION BY v.official_id ORDER BY v.motion_date DESC, v.motion_id DESC) AS rn
  FROM vote v JOIN motion m ON v.motion_id = m.motion_id) a WHERE rn <= 100""")
def p03(c):
    return P.voting_record(c.vote, c.motion)


@query("p04_contributions_by_cycle", "SELECT official_id, cycle, contributor_type, count(*) AS n, sum(amount_cents)::BIGINT AS cents FROM contribution GROUP BY 1, 2, 3")
def p04(c):
    return P.contributions_by_cycle(c.contribution)


@query("p05_top_donors", """WITH s AS (SELECT official_id, contributor_name, sum(amount_cents)::BIGINT AS cents, count(*) AS gifts FROM contribution GROUP BY 1, 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY official_id ORDER BY cents DESC, contributor_name) AS rn FROM s) a WHERE rn <= 50""")
def p05(c):
    return P.top_donors(c.contribution)


@query("p06_property_holdings", "SELECT official_id, canonical_name, parcel_id, assessment_year, value_cents::BIGINT AS value_cents FROM property_record JOIN official USING (official_id)")
def p06(c):
    return c.property_record.join(c.official.select("official_id", "canonical_name"), "official_id")


@query("p07_wealth_by_year", """WITH s AS (SELECT official_id, assessment_year, sum(value_cents)::BIGINT AS cents, count(DISTINCT parcel_id) AS parcels FROM property_record GROUP BY 1, 2)
SELECT *, cents - lag(cents) OVER (PARTITION BY official_id ORDER BY assessment_year) AS change FROM s""")
def p07(c):
    c.deal("lineitem", "l_suppkey", "l_partkey")  # a parcel's records are summed and its owners' years counted where they are
    return P.wealth_by_year(c.property_record)


@query("p08_roster_with_vote_span", f"""SELECT o.*, c.seat_id, c.start_date, coalesce(n_votes, 0) AS n_votes, first_vote, last_vote FROM official o LEFT JOIN ({CURRENT}) c ON o.official_id = c.official_id
LEFT JOIN (SELECT official_id, count(*) AS n_votes, min(motion_date) AS first_vote, max(motion_date) AS last_vote FROM vote GROUP BY 1) v ON o.official_id = v.official_id""")
def p08(c):
    return P.roster(c.official, c.vote, c.term, c.as_of)


@query("p10_petitioner_roster", "SELECT petitioner, count(*) AS n, sum(CAST(round(dollar_amount * 100) AS BIGINT))::BIGINT AS cents, min(motion_date) AS first_date, max(motion_date) AS last_date FROM motion WHERE petitioner IS NOT NULL GROUP BY 1")
def p10(c):
    return P.petitioners(c.motion)


@query("p11_petitioner_records", "SELECT motion_id, petitioner, motion_date, outcome FROM motion WHERE petitioner ILIKE 'city manager%'")
def p11(c):
    return c.motion.filter(F.col("petitioner").ilike("city manager%")).select("motion_id", "petitioner", "motion_date", "outcome")


@query("p12_db_stats", """SELECT (SELECT count(*) FROM motion) AS n_motions, (SELECT count(*) FROM vote) AS n_votes, (SELECT count(*) FROM meeting) AS n_meetings,
 (SELECT min(meeting_date) FROM meeting) AS first_meeting, (SELECT max(meeting_date) FROM meeting) AS last_meeting""")
def p12(c):
    m = c.meeting.agg(F.count(F.lit(1)).alias("n_meetings"), F.min("meeting_date").alias("first_meeting"), F.max("meeting_date").alias("last_meeting"))
    one = lambda df, name: F.broadcast(df.agg(F.count(F.lit(1)).alias(name)))  # noqa: E731  one row each
    return m.crossJoin(one(c.motion, "n_motions")).crossJoin(one(c.vote, "n_votes"))


@query("p13_vote_breakdown", """SELECT v.official_id, motion_type, count(*) FILTER (WHERE vote_value = 'yes') AS yes, count(*) FILTER (WHERE vote_value = 'no') AS no,
 count(*) FILTER (WHERE vote_value = 'abstain') AS abstain, count(*) FILTER (WHERE vote_value = 'conflict_recusal') AS conflict_recusal FROM vote v JOIN motion m ON v.motion_id = m.motion_id GROUP BY 1, 2""")
def p13(c):
    return P.vote_breakdown(c.vote, c.motion)


@query("p14_home_stats", """SELECT j.jurisdiction_id, display_name, count(*) AS n_motions, count(DISTINCT b.body_id) AS n_bodies,
 round(100.0 * count(*) FILTER (WHERE tally_yes > 0 AND tally_no = 0 AND tally_abstain = 0) / count(*), 1)::DOUBLE AS unanimous_pct
 FROM motion m JOIN governing_body b ON m.body_id = b.body_id JOIN jurisdiction j ON b.jurisdiction_id = j.jurisdiction_id GROUP BY 1, 2""")
def p14(c):
    rows = c.motion.join(c.governing_body, "body_id").join(c.jurisdiction, "jurisdiction_id")
    unanimous = (F.col("tally_yes") > 0) & (F.col("tally_no") == 0) & (F.col("tally_abstain") == 0)
    return rows.groupBy("jurisdiction_id", "display_name").agg(
        F.count(F.lit(1)).alias("n_motions"), F.countDistinct("body_id").alias("n_bodies"), F.round(100.0 * F.count_if(unanimous) / F.count(F.lit(1)), 1).cast("double").alias("unanimous_pct")
    )


@query("o02_top_petitioners", "SELECT petitioner, count(*) AS n FROM motion WHERE petitioner IS NOT NULL GROUP BY 1 ORDER BY n DESC, petitioner LIMIT 5")
def o02(c):
    return c.motion.filter("petitioner is not null").groupBy("petitioner").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "petitioner").limit(5)


@query("o03_severity_order", """SELECT failure_id, sev, row_number() OVER (PARTITION BY job ORDER BY CASE sev WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, created_at DESC, failure_id) AS place
 FROM (SELECT *, CASE failure_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS sev FROM failure) a""")
def o03(c):
    sev = F.when(F.col("failure_id") % 3 == 0, "high").when(F.col("failure_id") % 3 == 1, "medium").otherwise("low")
    rank = F.when(F.col("sev") == "high", 0).when(F.col("sev") == "medium", 1).otherwise(2)
    w = Window.partitionBy("job").orderBy(rank, F.desc("created_at"), "failure_id")
    return c.failure.withColumn("sev", sev).select("failure_id", "sev", F.row_number().over(w).alias("place"))


@query("o04_nulls_last", "SELECT meeting_id, row_number() OVER (PARTITION BY body_id ORDER BY posted_date DESC NULLS LAST, meeting_id) AS place FROM meeting")
def o04(c):
    w = Window.partitionBy("body_id").orderBy(F.col("posted_date").desc_nulls_last(), "meeting_id")
    return c.meeting.select("meeting_id", F.row_number().over(w).alias("place"))


@query("w01_meeting_gaps", "SELECT meeting_id, CAST(meeting_date - lag(meeting_date) OVER (PARTITION BY body_id ORDER BY meeting_date, meeting_id) AS INT) AS gap FROM meeting")
def w01(c):
    w = Window.partitionBy("body_id").orderBy("meeting_date", "meeting_id")
    return c.meeting.select("meeting_id", F.datediff("meeting_date", F.lag("meeting_date").over(w)).alias("gap"))


@query("w03_latest_term", "SELECT official_id, term_id FROM (SELECT *, row_number() OVER (PARTITION BY official_id ORDER BY start_date DESC, term_id DESC) AS rn FROM term) a WHERE rn = 1")
def w03(c):
    return c.term.groupBy("official_id").agg(F.max_by("term_id", F.struct("start_date", "term_id")).alias("term_id"))


@query("w04_running_balance", "SELECT event_id, sum(amount_cents) OVER (PARTITION BY jurisdiction_id, user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS balance FROM fund_event")
def w04(c):
    w = Window.partitionBy("jurisdiction_id", "user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return c.fund_event.select("event_id", F.sum("amount_cents").over(w).alias("balance"))


@query("w05_term_supersession", """SELECT term_id, CASE WHEN nxt IS NULL THEN end_date WHEN end_date IS NULL OR end_date >= nxt THEN CAST(nxt - INTERVAL 1 DAY AS DATE) ELSE end_date END AS end_date
 FROM (SELECT *, lead(start_date) OVER (PARTITION BY official_id ORDER BY start_date, term_id) AS nxt FROM term) a""")
def w05(c):
    w = Window.partitionBy("official_id").orderBy("start_date", "term_id")
    before = F.date_sub(F.lead("start_date").over(w), 1)
    return c.term.select("term_id", F.least(F.col("end_date"), before).alias("end_date"))


@query("w07_recent_meetings_per_body", "SELECT body_id, meeting_id, rn FROM (SELECT *, row_number() OVER (PARTITION BY body_id ORDER BY meeting_date DESC, meeting_id DESC) AS rn FROM meeting) a WHERE rn <= 5")
def w07(c):
    return P.latest(c.meeting, ["body_id"], F.desc("meeting_date"), F.desc("meeting_id"), n=5).select("body_id", "meeting_id", "rn")


@query("w09_after_last_document", """SELECT meeting_id FROM (SELECT *, max(CASE WHEN minutes_url IS NOT NULL THEN meeting_date END) OVER (PARTITION BY body_id) AS mark FROM meeting) a
 WHERE meeting_date > coalesce(mark, DATE '1900-01-01')""")
def w09(c):
    mark = F.max(F.when(F.col("minutes_url").isNotNull(), F.col("meeting_date"))).over(Window.partitionBy("body_id"))
    return c.meeting.withColumn("mark", F.coalesce(mark, F.lit("1900-01-01").cast("date"))).filter("meeting_date > mark").select("meeting_id")


@query("u01_lineage_trace", """SELECT source, min(jurisdiction_id) AS jurisdiction_id FROM (
 SELECT body_id % 4 AS source, jurisdiction_id FROM governing_body UNION ALL SELECT CAST(failure_id % 7 AS INT), jurisdiction_id FROM failure UNION ALL SELECT CAST(event_id % 9 AS INT), jurisdiction_id FROM outcome) a GROUP BY 1""")
def u01(c):
    a = c.governing_body.select((F.col("body_id") % 4).cast("long").alias("source"), F.col("jurisdiction_id").cast("long").alias("jurisdiction_id"))
    b = c.failure.select((F.col("failure_id") % 7).alias("source"), "jurisdiction_id")
    d = c.outcome.select((F.col("event_id") % 9).alias("source"), "jurisdiction_id")
    return a.unionByName(b).unionByName(d).groupBy("source").agg(F.min("jurisdiction_id").alias("jurisdiction_id"))


@query("u02_first_claiming_kind", """SELECT url, min_by(kind, ord) AS kind FROM (SELECT agenda_url AS url, 'agenda' AS kind, 0 AS ord FROM meeting UNION ALL SELECT minutes_url, 'minutes', 1 FROM meeting
 UNION ALL SELECT packet_url, 'packet', 2 FROM meeting UNION ALL SELECT replace(agenda_url, 'agenda', 'packet'), 'agenda', 0 FROM meeting WHERE meeting_id % 20 = 3) a WHERE url IS NOT NULL GROUP BY 1""")
def u02(c):
    three = c.meeting.select("meeting_id", F.expr("stack(3, agenda_url, 'agenda', 0, minutes_url, 'minutes', 1, packet_url, 'packet', 2) AS (url, kind, ord)"))
    more = c.meeting.filter("meeting_id % 20 = 3").select("meeting_id", F.expr("replace(agenda_url, 'agenda', 'packet')").alias("url"), F.lit("agenda").alias("kind"), F.lit(0).alias("ord"))
    return three.unionByName(more).filter("url is not null").groupBy("url").agg(F.min_by("kind", "ord").alias("kind"))


@query("u03_candidates_minus_stored", "SELECT minutes_url AS url FROM meeting WHERE minutes_url IS NOT NULL EXCEPT SELECT minutes_url FROM meeting WHERE meeting_id % 2 = 0")
def u03(c):
    urls = c.meeting.filter("minutes_url is not null").select(F.col("minutes_url").alias("url")).distinct()
    return urls.join(c.meeting.filter("meeting_id % 2 = 0").select(F.col("minutes_url").alias("url")), "url", "left_anti")


@query("u05_title_recall", """WITH ref AS (SELECT body_id, title FROM motion WHERE motion_type = 'ordinance'), got AS (SELECT DISTINCT body_id, title FROM motion WHERE motion_type = 'resolution')
SELECT r.body_id, count(*) AS n_ref, count(g.title) AS n_hit, round(count(g.title) * 1.0 / count(*), 6)::DOUBLE AS recall FROM ref r LEFT JOIN got g ON r.body_id = g.body_id AND r.title = g.title GROUP BY 1""")
def u05(c):
    ref = c.motion.filter("motion_type = 'ordinance'").select("body_id", "title")
    got = c.motion.filter("motion_type = 'resolution'").select("body_id", "title").distinct().withColumn("hit", F.lit(1))
    return ref.join(got, ["body_id", "title"], "left").groupBy("body_id").agg(
        F.count(F.lit(1)).alias("n_ref"), F.count("hit").alias("n_hit"), F.round(F.count("hit") / F.count(F.lit(1)), 6).alias("recall")
    )


@query("a04_median_gap", """SELECT body_id, count(*) AS n, median(gap) AS median_gap FROM (SELECT body_id, meeting_date - lag(meeting_date) OVER (PARTITION BY body_id ORDER BY meeting_date, meeting_id) AS gap FROM meeting) a WHERE gap > 0 GROUP BY 1""")
def a04(c):
    w = Window.partitionBy("body_id").orderBy("meeting_date", "meeting_id")
    gaps = c.meeting.select("body_id", F.datediff("meeting_date", F.lag("meeting_date").over(w)).alias("gap")).filter("gap > 0")
    return gaps.groupBy("body_id").agg(F.count(F.lit(1)).alias("n"), F.expr("percentile_cont(0.5) WITHIN GROUP (ORDER BY gap)").alias("median_gap"))


@query("a05_bool_or", "SELECT official_id, coalesce(bool_or(end_date IS NULL), false) AS is_current, coalesce(bool_or(CASE WHEN term_id % 2 = 0 THEN NULL ELSE end_date > DATE '2000-01-01' END), false) AS late FROM term GROUP BY 1")
def a05(c):
    late = F.when(F.col("term_id") % 2 == 0, None).otherwise(F.col("end_date") > F.lit("2000-01-01").cast("date"))
    return c.term.groupBy("official_id").agg(F.coalesce(F.bool_or(F.col("end_date").isNull()), F.lit(False)).alias("is_current"), F.coalesce(F.bool_or(late), F.lit(False)).alias("late"))


@query("a06_ordered_array_agg", """SELECT jurisdiction_id, max_by(message, (created_at, failure_id)) AS latest, array_to_string((list(failure_id ORDER BY created_at DESC, failure_id DESC))[1:10], ',') AS ids FROM failure GROUP BY 1""")
def a06(c):
    w = Window.partitionBy("jurisdiction_id").orderBy(F.desc("created_at"), F.desc("failure_id"))
    ten = c.failure.withColumn("rn", F.row_number().over(w)).filter("rn <= 10")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rn", "failure_id"))), lambda s: s["failure_id"].cast("string")), ",")
    return ten.groupBy("jurisdiction_id").agg(F.min_by("message", "rn").alias("latest"), ids.alias("ids"))


@query("a07_map_sum", """SELECT key, sum(v)::BIGINT AS total FROM (SELECT 'missing' AS key, n_missing AS v FROM outcome UNION ALL SELECT 'garbled', n_garbled FROM outcome) a GROUP BY 1""")
def a07(c):
    kinds = F.from_json(F.to_json(F.create_map(F.lit("missing"), "n_missing", F.lit("garbled"), "n_garbled")), "map<string,bigint>")
    return c.outcome.select(F.explode(kinds).alias("key", "v")).groupBy("key").agg(F.sum("v").alias("total"))


@query("a11_extraction_rollup", """SELECT method, jurisdiction_id, count(*) AS n, count(*) FILTER (WHERE status = 'failed') AS failed, round(100.0 * count(*) FILTER (WHERE status = 'failed') / count(*), 1)::DOUBLE AS failed_pct
 FROM outcome GROUP BY GROUPING SETS ((), (method), (jurisdiction_id))""")
def a11(c):
    failed = F.count_if(F.col("status") == "failed")
    return c.outcome.groupingSets([[], ["method"], ["jurisdiction_id"]], "method", "jurisdiction_id").agg(
        F.count(F.lit(1)).alias("n"), failed.alias("failed"), F.round(100.0 * failed / F.count(F.lit(1)), 1).cast("double").alias("failed_pct")
    )


@query("a12_longest_value", "SELECT body_id, max_by(petitioner, (length(petitioner), motion_id)) AS longest FROM motion WHERE petitioner IS NOT NULL GROUP BY 1")
def a12(c):
    return c.motion.filter("petitioner is not null").groupBy("body_id").agg(F.max_by("petitioner", F.struct(F.length("petitioner"), "motion_id")).alias("longest"))


@query("a13_first_non_null", "SELECT body_id, min_by(posted_date, (meeting_date, meeting_id)) AS first_posted FROM meeting WHERE posted_date IS NOT NULL GROUP BY 1")
def a13(c):
    return c.meeting.filter("posted_date is not null").groupBy("body_id").agg(F.min_by("posted_date", F.struct("meeting_date", "meeting_id")).alias("first_posted"))


@query("a14_ordered_union", """SELECT body_id, array_to_string(list(low ORDER BY pos, low), '|') AS names FROM (SELECT body_id, lower(trim(motion_type)) AS low, min(motion_id) AS pos FROM motion GROUP BY 1, 2) a GROUP BY 1""")
def a14(c):
    first = c.motion.groupBy("body_id", F.lower(F.trim("motion_type")).alias("low")).agg(F.min("motion_id").alias("pos"))
    names = F.transform(F.sort_array(F.collect_list(F.struct("pos", "low"))), lambda s: s["low"])
    return first.groupBy("body_id").agg(F.array_join(names, "|").alias("names"))


@query("j04_term_as_of_vote", """SELECT motion_id, official_id, term_id FROM (SELECT v.motion_id, v.official_id, t.term_id, row_number() OVER (PARTITION BY v.motion_id, v.official_id ORDER BY t.start_date DESC, t.term_id DESC) AS rn
 FROM vote v JOIN term t ON v.official_id = t.official_id AND t.start_date <= v.motion_date AND (t.end_date IS NULL OR t.end_date >= v.motion_date)) a WHERE rn = 1""")
def j04(c):
    t, v = c.term, c.vote.select("motion_id", "official_id", "motion_date")
    inside = (t.start_date <= v.motion_date) & (t.end_date.isNull() | (t.end_date >= v.motion_date))
    return v.join(t, (v.official_id == t.official_id) & inside).groupBy(v.motion_id, v.official_id).agg(F.max_by("term_id", F.struct("start_date", "term_id")).alias("term_id"))


@query("j05_next_siblings", """SELECT a.meeting_id, array_to_string((list(b.meeting_id ORDER BY b.meeting_date, b.meeting_id))[1:3], ',') AS next_ids
 FROM meeting a JOIN meeting b ON a.body_id = b.body_id AND b.meeting_date > a.meeting_date AND b.agenda_url IS NOT NULL GROUP BY a.meeting_id""")
def j05(c):
    """Dates with an agenda get an ordinal; three following ordinals are joined, so no frame grows with a body."""
    dates = c.meeting.filter("agenda_url is not null").groupBy("body_id", "meeting_date").agg(F.sort_array(F.collect_list("meeting_id")).alias("ids"))
    every = c.meeting.select("body_id", "meeting_date").distinct().join(dates, ["body_id", "meeting_date"], "left")
    w = Window.partitionBy("body_id").orderBy("meeting_date")
    none = F.array().cast("array<int>")
    # the next three dates that have an agenda hold at least the next three meetings
    w_after = w.rowsBetween(1, Window.unboundedFollowing)
    nxt = every.withColumn("ord", F.count("ids").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    known = nxt.filter("ids is not null").select("body_id", F.col("ord").alias("o"), "ids")
    steps = nxt.select("body_id", "meeting_date", F.explode(F.sequence(F.col("ord") + 1, F.col("ord") + 3)).alias("o"))
    near = steps.join(known, ["body_id", "o"]).groupBy("body_id", "meeting_date").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("o", "ids"))), lambda s: s["ids"])).alias("following"))
    return c.meeting.select("meeting_id", "body_id", "meeting_date").join(near, ["body_id", "meeting_date"]).select(
        "meeting_id", F.array_join(F.slice("following", 1, 3), ",").alias("next_ids")
    )


@query("j07_keyword_dictionary", """SELECT motion_id, CASE WHEN contains(lower(title), 'budget') THEN 'finance' WHEN contains(lower(title), 'parcel') THEN 'land' WHEN contains(lower(title), 'ok') THEN 'consent' END AS label FROM motion""")
def j07(c):
    rules = c.spark.createDataFrame([(0, "budget", "finance"), (1, "parcel", "land"), (2, "ok", "consent")], "ord int, word string, label string")
    hit = c.motion.select("motion_id", "title").join(F.broadcast(rules), F.lower("title").contains(F.col("word")), "left")  # the rule list is fixed
    return hit.groupBy("motion_id").agg(F.min_by("label", "ord").alias("label"))


@query("j09_correlated_counts", """SELECT b.body_id, (SELECT count(*) FROM meeting m WHERE m.body_id = b.body_id) AS n_meetings, (SELECT count(*) FROM motion m WHERE m.body_id = b.body_id) AS n_motions FROM governing_body b""")
def j09(c):
    m = c.meeting.groupBy("body_id").agg(F.count(F.lit(1)).alias("n_meetings"))
    n = c.motion.groupBy("body_id").agg(F.count(F.lit(1)).alias("n_motions"))
    return c.governing_body.select("body_id").join(m, "body_id", "left").join(n, "body_id", "left").fillna(0)


@query("j10_standing", """SELECT DISTINCT a.body_id, b.body_id AS other FROM governing_body a JOIN governing_body b ON a.body_id = b.body_id OR a.jurisdiction_id = b.body_id OR (a.jurisdiction_id = b.jurisdiction_id AND b.body_type = 'school_board')""")
def j10(c):
    g = c.governing_body.select("body_id", "jurisdiction_id")
    own = g.select("body_id", F.col("body_id").alias("other"))
    county = g.join(c.governing_body.select(F.col("body_id").alias("other")), F.col("jurisdiction_id") == F.col("other")).select("body_id", "other")
    school = c.governing_body.filter("body_type = 'school_board'").select(F.col("body_id").alias("other"), "jurisdiction_id")
    return own.union(county).union(g.join(school, "jurisdiction_id").select("body_id", "other")).distinct()


@query("j12_unnest_props", """SELECT k, count(*) AS n FROM (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) a GROUP BY 1""")
def j12(c):
    return c.events.select(F.explode(F.from_json("props", "map<string,bigint>")).alias("key", "k")).filter("key = 'k'").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
