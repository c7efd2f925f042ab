"""Queries that complete the inventory: staff, enrichment, embedded minutes, photos, digests, contacts."""

from pyspark.sql import functions as F

from quorumdf.functions import names as N
from quorumdf.operators import facts as R
from quorumdf.operators import observers as O
from quorumdf.operators import profiles as P
from quorumdf.operators import resolution as E

from .entity_queries import _GRAMS, _sim
from .registry import query

AS = "DATE '2001-09-01'"


@query("a01_group_having", "SELECT official_id, vote_value, count(*) AS n, min(motion_date) AS first_date FROM vote GROUP BY 1, 2 HAVING count(*) > 20")
def a01(c):
    return c.vote.groupBy("official_id", "vote_value").agg(F.count(F.lit(1)).alias("n"), F.min("motion_date").alias("first_date")).filter("n > 20")


@query("a08_rates", "SELECT body_id, round(100.0 * count(*) FILTER (WHERE outcome = 'passed') / count(*), 1)::DOUBLE AS pct, count(*) FILTER (WHERE outcome = 'passed') * 100 // count(*) AS floor_pct FROM motion GROUP BY 1")
def a08(c):
    passed = F.count_if(F.col("outcome") == "passed")
    rows = c.motion.groupBy("body_id").agg(passed.alias("k"), F.count(F.lit(1)).alias("n"))
    return rows.select("body_id", F.round(100.0 * F.col("k") / F.col("n"), 1).cast("double").alias("pct"), F.expr("(k * 100) div n").alias("floor_pct"))


@query("w08_wealth_change", "SELECT official_id, assessment_year, cents - lag(cents) OVER (PARTITION BY official_id ORDER BY assessment_year) AS change FROM (SELECT official_id, assessment_year, sum(value_cents)::BIGINT AS cents FROM property_record GROUP BY 1, 2) a")
def w08(c):
    return P.wealth_by_year(c.property_record).select("official_id", "assessment_year", "change")


def recommenders(motion, names):
    """Containment as an equi-join: the substrings of the distinct name lengths, eight characters or more."""
    names = names.filter(F.length("low") >= 8)
    lengths = names.select(F.length("low").alias("len")).distinct()
    texts = motion.filter(F.col("petitioner").like("City Manager %")).select("motion_id", F.lower("petitioner").alias("text"))
    probes = texts.crossJoin(F.broadcast(lengths)).filter(F.length("text") >= F.col("len"))  # a few dozen lengths at most
    parts = probes.select("motion_id", F.explode(F.transform(F.sequence(F.lit(1), F.length("text") - F.col("len") + 1), lambda i: F.substring(F.col("text"), i, F.col("len")))).alias("low"))
    return parts.join(names, "low").select("motion_id", "official_id").distinct()


@query("d12_official_as_recommender", """WITH n AS (SELECT c_custkey AS official_id, lower(c_name) AS low FROM customer WHERE length(c_name) >= 8)
SELECT DISTINCT motion_id, official_id FROM motion JOIN n ON contains(lower(petitioner), low) WHERE petitioner LIKE 'City Manager %'""")
def d12(c):
    return recommenders(c.motion, c.customer.select(F.col("c_custkey").alias("official_id"), F.lower("c_name").alias("low")))


@query("e06_bulk_resolver", """WITH n AS (SELECT DISTINCT petitioner AS name FROM motion WHERE petitioner IS NOT NULL), k AS (SELECT min(c_custkey) AS id, lower(c_name) AS low FROM customer GROUP BY 2)
SELECT name, CASE WHEN regexp_matches(name, '[0-9(]') THEN NULL ELSE id END AS official_id, CASE WHEN regexp_matches(name, '[0-9(]') THEN 'unresolvable' WHEN id IS NOT NULL THEN 'alias' ELSE 'none' END AS matched_via FROM n LEFT JOIN k ON lower(name) = low""")
def e06(c):
    alias = c.customer.select(F.col("c_name").alias("alias"), F.col("c_custkey").alias("official_id"))
    return E.bulk_resolve(c.motion.filter("petitioner is not null").select(F.col("petitioner").alias("name")), alias, c.official).select("name", "official_id", "matched_via")


@query("e09_roster_match", "SELECT o.official_id, o.body_id FROM official o JOIN (SELECT upper(canonical_name) AS up, body_id FROM official WHERE official_id % 2 = 0) r ON lower(o.canonical_name) = lower(r.up) AND o.body_id = r.body_id")
def e09(c):
    page = c.official.filter("official_id % 2 = 0").select(F.lower(F.upper("canonical_name")).alias("low"), "body_id")
    return c.official.withColumn("low", F.lower("canonical_name")).join(page, ["low", "body_id"]).select("official_id", "body_id")


@query("e10_filer_match", "SELECT contributor_name, min(c_custkey) AS filer FROM contribution JOIN customer ON lower(c_name) = lower(contributor_name) GROUP BY 1 HAVING count(DISTINCT c_custkey) = 1")
def e10(c):
    ids = c.customer.select(F.lower("c_name").alias("low"), "c_custkey")
    rows = c.contribution.select("contributor_name").distinct().withColumn("low", F.lower("contributor_name")).join(ids, "low")
    return rows.groupBy("contributor_name").agg(F.min("c_custkey").alias("filer"), F.countDistinct("c_custkey").alias("n")).filter("n = 1").drop("n")


@query("e14_vote_backfill_terms", """SELECT v.motion_id, v.official_id, max_by(t.term_id, (t.start_date, t.term_id)) AS term_id FROM vote v LEFT JOIN term t ON v.official_id = t.official_id AND t.start_date <= v.motion_date AND (t.end_date IS NULL OR t.end_date >= v.motion_date) WHERE v.vote_value = 'conflict_recusal' GROUP BY 1, 2""")
def e14(c):
    v = c.vote.filter("vote_value = 'conflict_recusal'").select("motion_id", "official_id", "motion_date")
    t = c.term.select("official_id", "term_id", "start_date", "end_date")
    live = v.join(t, "official_id").filter((F.col("start_date") <= F.col("motion_date")) & (F.col("end_date").isNull() | (F.col("end_date") >= F.col("motion_date"))))
    best = live.groupBy("motion_id", "official_id").agg(F.max_by("term_id", F.struct("start_date", "term_id")).alias("term_id"))
    return v.select("motion_id", "official_id").join(best, ["motion_id", "official_id"], "left")


@query("e17_staff_directory_sync", "SELECT official_id, CASE WHEN official_id % 3 = 0 THEN true WHEN is_elected THEN true ELSE false END AS is_active FROM official")
def e17(c):
    """Those on the directory are active; non-elected ones not seen become inactive, if anything was seen."""
    seen = c.official.filter("official_id % 3 = 0").select("official_id", F.lit(True).alias("seen"))
    return c.official.join(seen, "official_id", "left").select("official_id", (F.coalesce("seen", F.lit(False)) | F.col("is_elected")).alias("is_active"))


@query("e18_reopened_terms", "SELECT official_id, term_id, CASE WHEN has_open THEN 'kept' ELSE 'reopened' END AS action FROM (SELECT official_id, max_by(term_id, (start_date, term_id)) AS term_id, bool_or(end_date IS NULL) AS has_open FROM term GROUP BY 1) a")
def e18(c):
    per = c.term.groupBy("official_id").agg(F.max_by("term_id", F.struct("start_date", "term_id")).alias("term_id"), F.bool_or(F.col("end_date").isNull()).alias("has_open"))
    return per.select("official_id", "term_id", F.when(F.col("has_open"), "kept").otherwise("reopened").alias("action"))


@query("f05_guarded_containment", "SELECT p_partkey FROM part WHERE length(p_name) >= 8 AND contains(lower(p_name || ' ' || p_type), lower(p_name))")
def f05(c):
    return c.part.filter((F.length("p_name") >= 8) & F.lower(F.concat("p_name", F.lit(" "), "p_type")).contains(F.lower("p_name"))).select("p_partkey")


@query("h04_forum_unenriched", f"SELECT m.body_id, count(*) AS n FROM meeting m WHERE meeting_date > DATE '2001-06-01' AND agenda_url IS NOT NULL AND packet_url IS NULL GROUP BY 1")
def h04(c):
    rows = c.meeting.filter("meeting_date > date '2001-06-01' and agenda_url is not null and packet_url is null")
    return rows.groupBy("body_id").agg(F.count(F.lit(1)).alias("n"))


@query("h07_fix_search", "SELECT job, count(*) AS n, max(created_at) AS latest FROM failure WHERE message ILIKE '%ERROR 1%' GROUP BY 1")
def h07(c):
    return c.failure.filter(F.col("message").ilike("%ERROR 1%")).groupBy("job").agg(F.count(F.lit(1)).alias("n"), F.max("created_at").alias("latest"))


@query("h18_time_zone_review", "SELECT jurisdiction_id FROM jurisdiction WHERE state_abbr NOT IN ('GA', 'CA', 'AZ')")
def h18(c):
    none = F.lit(None).cast("string")
    return c.jurisdiction.withColumn("z", R.time_zone(none, none, F.col("state_abbr"))).filter(F.col("z.source").isin("assumed", "default")).select("jurisdiction_id")


@query("j08_similarity_self_join", f"""WITH n AS (SELECT DISTINCT p_name AS name, {_GRAMS.format('p_name')} AS g FROM part)
SELECT a.name AS ka, b.name AS kb FROM n a JOIN n b ON a.name < b.name WHERE {_sim('a.g', 'b.g')} >= 0.5 AND split_part(a.name, ' ', 1) = split_part(b.name, ' ', 1)""")
def j08(c):
    n = c.part.select("p_name").distinct()
    first = lambda t: F.substring_index(t, " ", 1)
    return E.similar_pairs(n, n, "p_name", "p_name", "p_name", "p_name", 0.5, ordered=True, alike=first).filter("alike").select("ka", "kb")


@query("j13_directory_link", "SELECT n.n_nationkey, r.r_regionkey FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE r_regionkey END IS DISTINCT FROM CASE WHEN n_nationkey % 2 = 0 THEN r_regionkey END")
def j13(c):
    rows = c.nation.join(F.broadcast(c.region), F.col("n_regionkey") == F.col("r_regionkey"))  # a handful of regions
    old, new = F.when(F.col("n_nationkey") % 3 != 0, F.col("r_regionkey")), F.when(F.col("n_nationkey") % 2 == 0, F.col("r_regionkey"))
    return rows.filter(~old.eqNullSafe(new)).select("n_nationkey", "r_regionkey")


@query("k10_url_marks", "SELECT meeting_id, CASE WHEN meeting_id % 6 = 0 THEN list_sort(list_distinct(list_concat(json_keys(meta), ['bad_url']))) ELSE list_filter(json_keys(meta), lambda k: k <> 'minutes_source') END AS keys FROM meeting")
def k10(c):
    m = F.from_json("meta", "map<string,string>")
    marked = F.map_concat(m, F.create_map(F.lit("bad_url"), F.lit("404")))
    cleared = F.map_filter(m, lambda k, v: k != "minutes_source")
    return c.meeting.select("meeting_id", F.when(F.col("meeting_id") % 6 == 0, F.array_sort(F.map_keys(marked))).otherwise(F.map_keys(cleared)).alias("keys"))


@query("m03_digest_candidates", f"SELECT item_id, count(*) AS n FROM citizen_comment WHERE role = 'user' GROUP BY 1 HAVING count(*) FILTER (WHERE stance = 'oppose') > 1")
def m03(c):
    rows = c.citizen_comment.filter("role = 'user'")
    due = rows.filter("stance = 'oppose'").groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return rows.join(due.select("item_id"), "item_id", "left_semi").groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))


@query("m06_digest_outcome", """SELECT item_id, CASE WHEN item_id % 5 = 0 THEN 'no_recipient' WHEN n_oppose > n_support THEN 'held' WHEN item_id % 7 = 0 THEN 'failed' ELSE 'sent' END AS outcome FROM (SELECT item_id, count(*) FILTER (WHERE stance = 'oppose') AS n_oppose, count(*) FILTER (WHERE stance = 'support') AS n_support FROM citizen_comment GROUP BY 1) a""")
def m06(c):
    per = c.citizen_comment.groupBy("item_id").agg(F.count_if(F.col("stance") == "oppose").alias("o"), F.count_if(F.col("stance") == "support").alias("s"))
    outcome = F.when(F.col("item_id") % 5 == 0, "no_recipient").when(F.col("o") > F.col("s"), "held").when(F.col("item_id") % 7 == 0, "failed").otherwise("sent")
    return per.select("item_id", outcome.alias("outcome"))


@query("p09_staff_roster", "SELECT lower(split_part(petitioner, ' ', 1)) || ' ' || lower(split_part(petitioner, ' ', 2)) AS title, count(DISTINCT petitioner) AS people, count(*) AS n FROM motion WHERE petitioner LIKE 'City Manager %' GROUP BY 1")
def p09(c):
    rows = c.motion.filter(F.col("petitioner").like("City Manager %"))
    return rows.groupBy(F.lower(F.substring_index("petitioner", " ", 2)).alias("title")).agg(F.countDistinct("petitioner").alias("people"), F.count(F.lit(1)).alias("n"))


@query("r03_attendance_summary", "SELECT motion_id, string_agg(vote_value || '=' || n, ' | ' ORDER BY vote_value) AS summary FROM (SELECT motion_id, vote_value, count(*) AS n FROM vote GROUP BY 1, 2) a GROUP BY 1")
def r03(c):
    per = c.vote.groupBy("motion_id", "vote_value").agg(F.count(F.lit(1)).alias("n"))
    items = F.transform(F.sort_array(F.collect_list(F.struct("vote_value", "n"))), lambda s: F.concat_ws("=", s["vote_value"], s["n"].cast("string")))
    return per.groupBy("motion_id").agg(F.array_join(items, " | ").alias("summary"))


@query("r05_provenance_candidates", "SELECT meeting_id FROM meeting m WHERE minutes_url IS NOT NULL AND EXISTS (SELECT 1 FROM motion k WHERE k.meeting_id = m.meeting_id AND k.tally_yes IS NULL)")
def r05(c):
    gaps = c.motion.filter("tally_yes is null").select("meeting_id")
    return c.meeting.filter("minutes_url is not null").join(gaps, "meeting_id", "left_semi").select("meeting_id")


@query("r07_deterministic_handlers", "SELECT motion_id, CASE WHEN lower(petitioner) = 'staff' OR starts_with(petitioner, 'City Manager') THEN NULL ELSE petitioner END AS petitioner, CASE WHEN lower(petitioner) = 'staff' OR starts_with(petitioner, 'City Manager') THEN 1 ELSE 0 END AS n_log FROM motion")
def r07(c):
    hit = F.coalesce((F.lower("petitioner") == "staff") | F.col("petitioner").startswith("City Manager"), F.lit(False))
    log = F.when(hit, F.array(F.struct(F.lit("clear_petitioner").alias("handler"), F.col("petitioner").alias("old")))).otherwise(F.array().cast("array<struct<handler:string,old:string>>"))
    return c.motion.select("motion_id", F.when(~hit, F.col("petitioner")).alias("petitioner"), F.size(log).alias("n_log"))


@query("r08_orphan_removal", "SELECT official_id FROM official o WHERE is_elected AND NOT EXISTS (SELECT 1 FROM term t WHERE t.official_id = o.official_id) AND NOT EXISTS (SELECT 1 FROM vote v WHERE v.official_id = o.official_id AND v.vote_value = 'conflict_recusal')")
def r08(c):
    out = c.official.filter("is_elected").join(c.term.select("official_id"), "official_id", "left_anti")
    return out.join(c.vote.filter("vote_value = 'conflict_recusal'").select("official_id"), "official_id", "left_anti").select("official_id")


@query("r13_embedded_slice", r"""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS page, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents), f AS (SELECT doc_id, min(pos) AS first_pos FROM p WHERE contains(lower(page), 'license') GROUP BY 1)
SELECT p.doc_id, CAST(first_pos AS INT) AS first_pos, count(*) AS n_pages FROM p JOIN f ON p.doc_id = f.doc_id AND pos >= first_pos AND pos < first_pos + 8 GROUP BY 1, 2""")
def r13(c):
    pages = F.split("text", "\n")
    at = F.array_position(F.transform(pages, lambda p: F.lower(p).contains("license")), True).cast("int") - 1
    rows = c.documents.select("doc_id", pages.alias("pages"), at.alias("first_pos")).filter("first_pos >= 0")
    return rows.select("doc_id", "first_pos", F.size(F.slice("pages", F.col("first_pos") + 1, F.lit(8))).cast("long").alias("n_pages"))


@query("r17_photo_score", "SELECT page_id, score, score >= 2 AS verified FROM (SELECT page_id, CASE WHEN contains(url, '.org') THEN 2 WHEN contains(url, 'www') THEN 1 ELSE 0 END + CASE WHEN contains(lower(html), 'the') THEN 1 ELSE 0 END AS score FROM pages) a")
def r17(c):
    tier = F.when(F.col("url").contains(".org"), 2).when(F.col("url").contains("www"), 1).otherwise(0)
    score = tier + F.when(F.lower("html").contains("the"), 1).otherwise(0)
    return c.pages.select("page_id", score.alias("score"), (score >= 2).alias("verified"))


@query("r19_placeholder_backfill", "SELECT meeting_id, meta LIKE '%agenda_unavailable%' AND agenda_url IS NULL AS placeholder FROM meeting")
def r19(c):
    return c.meeting.select("meeting_id", (O.has_key(F.col("meta"), "agenda_unavailable") & F.col("agenda_url").isNull()).alias("placeholder"))


@query("t06_page_location", r"""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS page, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos, len(string_split(text, chr(10))) AS n FROM documents), h AS (SELECT doc_id, pos, n FROM p WHERE contains(lower(page), 'license'))
SELECT DISTINCT doc_id, CAST(x AS INT) AS page FROM (SELECT doc_id, n, unnest(range(pos - 1, pos + 2)) AS x FROM h) a WHERE x >= 0 AND x < n""")
def t06(c):
    pages = c.documents.select("doc_id", F.size(F.split("text", "\n")).alias("n"), F.posexplode(F.split("text", "\n")).alias("pos", "page"))
    hits = pages.filter(F.lower("page").contains("license"))
    near = hits.select("doc_id", "n", F.explode(F.sequence(F.col("pos") - 1, F.col("pos") + 1)).alias("page"))
    return near.filter("page >= 0 and page < n").select("doc_id", "page").distinct()


@query("x22_docket_json", """SELECT meeting_id, count(*) AS n_items, count(petitioner) AS n_with_petitioner FROM motion GROUP BY 1""")
def x22(c):
    item = F.to_json(F.struct("motion_id", F.substring("title", 1, 500).alias("title"), F.nullif("petitioner", F.lit("")).alias("petitioner")))
    per = c.motion.groupBy("meeting_id").agg(F.sort_array(F.collect_list(item)).alias("docket"))
    return per.select("meeting_id", F.size("docket").cast("long").alias("n_items"), F.size(F.filter("docket", lambda j: j.contains('"petitioner":'))).cast("long").alias("n_with_petitioner"))


@query("x23_failure_taxonomy", "SELECT failure_id, CASE WHEN contains(message, 'error 1') THEN 'timeout' WHEN contains(message, 'error 2') THEN 'parse' WHEN contains(message, 'error') THEN 'other' END AS kind FROM failure")
def x23(c):
    m = F.col("message")
    return c.failure.select("failure_id", F.when(m.contains("error 1"), "timeout").when(m.contains("error 2"), "parse").when(m.contains("error"), "other").alias("kind"))


@query("x24_email_extraction", r"SELECT doc_id, CAST(len(list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}'), lambda e: lower(e)))) AS INT) AS n FROM documents")
def x24(c):
    found = F.regexp_extract_all("text", F.lit(r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})"), 1)
    return c.documents.select("doc_id", F.size(F.array_distinct(F.transform(found, lambda e: F.lower(e)))).alias("n"))


@query("x02_name_parts", """SELECT official_id, split_part(replace(canonical_name, '#', ' '), ' ', 1) AS first, CASE WHEN canonical_name LIKE 'City Clerk %' THEN 'Clerk Supplier' END AS middle,
 split_part(canonical_name, '#', 2) AS last FROM official""")
def x02(c):
    parts = N.split_name(F.regexp_replace("canonical_name", "#", " "))
    return c.official.withColumn("p", parts).select("official_id", F.col("p.first").alias("first"), F.col("p.middle").alias("middle"), F.col("p.last").alias("last"))


@query("z09_replay_equals_batch", "SELECT jurisdiction_id, count(*) AS n, sum(amount_cents)::BIGINT AS cents FROM fund_event GROUP BY 1")
def z09(c):
    from quorumdf.streaming import jobs as Z

    e = Z.fund_events(Z.read_stream(c.spark, f"{c.sf_dir}/events.parquet")).groupBy((F.col("user_id") % 5).alias("jurisdiction_id")).agg(F.count(F.lit(1)).alias("n"), F.sum("amount_cents").alias("cents"))
    return Z.run_to_table(e, "complete", ["jurisdiction_id"])
