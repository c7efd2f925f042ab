"""Queries of entity resolution, ledger and estimates."""

from pyspark.sql import functions as F

from quorumdf.operators import ledger as L
from quorumdf.operators import resolution as E
from quorumdf.streaming.jobs import scratch

from .registry import query

_NAMES = "SELECT DISTINCT p_name AS name FROM part"
_GRAMS = "list_distinct(flatten(list_transform(regexp_extract_all(lower({0}), '[a-z0-9]+'), lambda w: list_transform(range(length(w) + 1), lambda i: substr('  ' || w || ' ', CAST(i AS INT) + 1, 3)))))"


def _sim(a, b):
    return f"round(len(list_intersect({a}, {b})) / (len({a}) + len({b}) - len(list_intersect({a}, {b}))), 6)"


@query("e03_trigram_similar_pairs", f"""WITH n AS (SELECT name, {_GRAMS.format('name')} AS g FROM ({_NAMES}) x)
SELECT a.name AS ka, b.name AS kb, {_sim('a.g', 'b.g')} AS similarity FROM n a JOIN n b ON a.name < b.name WHERE {_sim('a.g', 'b.g')} >= 0.4""")
def e03(c):
    n = c.part.select(F.col("p_name").alias("name")).distinct()
    return E.similar_pairs(n, n, "name", "name", "name", "name", 0.4, ordered=True).select("ka", "kb", "similarity")


@query("e03b_customer_name_typos", f"""WITH n AS (SELECT c_custkey AS k, c_name AS name, {_GRAMS.format('c_name')} AS g FROM customer)
SELECT a.k AS ka, b.k AS kb, {_sim('a.g', 'b.g')} AS similarity FROM n a JOIN n b ON a.k < b.k WHERE {_sim('a.g', 'b.g')} >= 0.75""")
def e03b(c):
    n = c.customer
    return E.similar_pairs(n, n, "c_custkey", "c_name", "c_custkey", "c_name", 0.75, ordered=True).select("ka", "kb", "similarity")


@query("d14_official_name_typos", f"""WITH n AS (SELECT official_id AS k, canonical_name AS name, {_GRAMS.format('canonical_name')} AS g FROM official),
p AS (SELECT a.k AS ka, b.k AS kb, {_sim('a.g', 'b.g')} AS similarity FROM n a JOIN n b ON a.k < b.k)
SELECT ka, kb, similarity, CASE WHEN similarity > 0.7 THEN 3 WHEN similarity > 0.5 THEN 2 ELSE 1 END AS severity FROM p JOIN n x ON ka = x.k JOIN n y ON kb = y.k
WHERE similarity > 0.5 OR (similarity > 0.4 AND lower(split_part(x.name, ' ', 1)) = lower(split_part(y.name, ' ', 1)))""")
def d14(c):
    first = lambda t: F.lower(F.substring_index(t, " ", 1))
    pairs = E.similar_pairs(c.official, c.official, "official_id", "canonical_name", "official_id", "canonical_name", 0.4, ordered=True, alike=first, unlike=0.5)
    pairs = pairs.filter((F.col("similarity") > 0.5) | ((F.col("similarity") > 0.4) & F.col("alike")))
    return pairs.select("ka", "kb", "similarity", F.when(F.col("similarity") > 0.7, 3).when(F.col("similarity") > 0.5, 2).otherwise(1).alias("severity"))


@query("e01_exact_alias", "SELECT upper(canonical_name) AS name, official_id FROM official UNION ALL SELECT 'nobody ' || official_id, NULL FROM official")
def e01(c):
    names = c.official.select(F.upper("canonical_name").alias("name")).unionAll(c.official.select(F.concat(F.lit("nobody "), F.col("official_id").cast("string")).alias("name")))
    return E.exact_alias(names, c.official.select(F.col("canonical_name").alias("alias"), "official_id"))


@query("e04_ranked_candidates", f"""WITH o AS (SELECT official_id, {_GRAMS.format('canonical_name')} AS g FROM official), n AS (SELECT c_name AS name, {_GRAMS.format("replace(c_name, 'Customer', 'Supplier')")} AS g FROM customer),
s AS (SELECT name, official_id, {_sim('n.g', 'o.g')} AS similarity FROM n, o) SELECT name, official_id, similarity, rn FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY similarity DESC, official_id) AS rn FROM s WHERE similarity >= 0.65) a WHERE rn <= 5""")
def e04(c):
    shown = c.customer.select("c_name", F.expr("replace(c_name, 'Customer', 'Supplier')").alias("name"))
    cand = E.ranked_candidates(shown.select("name"), c.official)
    return cand.join(shown, "name").select(F.col("c_name").alias("name"), "official_id", "similarity", "rn")


@query("e05_high_confidence", f"""WITH o AS (SELECT official_id, lower(canonical_name) AS low, {_GRAMS.format('canonical_name')} AS g FROM official), n AS (SELECT canonical_name AS name, {_GRAMS.format('canonical_name')} AS g FROM official WHERE official_id % 2 = 0
 UNION ALL SELECT canonical_name || ' x', {_GRAMS.format("canonical_name || ' x'")} FROM official WHERE official_id % 2 = 1),
e AS (SELECT name, official_id, 'alias' AS matched_via FROM n JOIN o ON lower(name) = low),
s AS (SELECT name, official_id FROM n, o WHERE name NOT IN (SELECT name FROM e) AND {_sim('n.g', 'o.g')} >= 0.9)
SELECT * FROM e UNION ALL SELECT name, min(official_id), 'similar' FROM s GROUP BY name HAVING count(*) = 1""")
def e05(c):
    o = c.official
    names = o.filter("official_id % 2 = 0").select(F.col("canonical_name").alias("name")).unionAll(o.filter("official_id % 2 = 1").select(F.concat("canonical_name", F.lit(" x")).alias("name")))
    return E.high_confidence(names, o, o.select(F.col("canonical_name").alias("alias"), "official_id"))


@query("e11_merge_candidates", f"""WITH n AS (SELECT official_id AS k, {_GRAMS.format('canonical_name')} AS g FROM official), p AS (SELECT a.k AS ka, b.k AS kb, {_sim('a.g', 'b.g')} AS similarity FROM n a JOIN n b ON a.k < b.k WHERE {_sim('a.g', 'b.g')} >= 0.8),
v AS (SELECT official_id, count(*) AS n FROM vote GROUP BY 1), r AS (SELECT p.*, coalesce(x.n, 0) AS na, coalesce(y.n, 0) AS nb FROM p LEFT JOIN v x ON ka = x.official_id LEFT JOIN v y ON kb = y.official_id)
SELECT CASE WHEN na >= nb THEN ka ELSE kb END AS canonical_id, CASE WHEN na >= nb THEN kb ELSE ka END AS duplicate_id, round(greatest(na, nb) / greatest(least(na, nb), 1), 4) AS ratio, similarity FROM r""")
def e11(c):
    pairs = E.similar_pairs(c.official, c.official, "official_id", "canonical_name", "official_id", "canonical_name", 0.8, ordered=True)
    return E.merge_candidates(pairs, c.vote)


@query("e12_apply_merges", """WITH m AS (SELECT official_id AS node, CASE WHEN official_id % 10 IN (1, 2, 3) THEN official_id - official_id % 10 + 1 END AS root FROM official),
r AS (SELECT v.*, coalesce(root, official_id) AS target FROM vote v LEFT JOIN m ON v.official_id = m.node)
SELECT motion_id, target AS official_id, vote_value FROM (SELECT *, row_number() OVER (PARTITION BY target, motion_id ORDER BY CASE WHEN target <> official_id THEN 1 ELSE 0 END, official_id) AS rn FROM r) a WHERE rn = 1""")
def e12(c):
    if c.spark.sparkContext.getCheckpointDir() is None:
        c.spark.sparkContext.setCheckpointDir(scratch(c.spark))
    edges = c.official.filter("official_id % 10 in (1, 2)").select(F.col("official_id").alias("a"), (F.col("official_id") + 1).alias("b"))
    edges = edges.join(c.official.select(F.col("official_id").alias("b")), "b", "left_semi").select("a", "b")
    return E.apply_merges(c.vote, E.merge_mapping(edges))


@query("f11_jurisdiction_slug", "SELECT jurisdiction_id, lower(replace(display_name, ' ', '-')) || '-' || lower(state_abbr) AS slug FROM jurisdiction")
def f11(c):
    return c.jurisdiction.select("jurisdiction_id", F.lower(F.concat_ws("-", F.expr("replace(display_name, ' ', '-')"), "state_abbr")).alias("slug"))


@query("l01_balances", "SELECT jurisdiction_id, sum(CASE WHEN kind <> 'grant' THEN amount_cents ELSE 0 END)::BIGINT AS balance, sum(CASE WHEN kind = 'grant' THEN amount_cents ELSE 0 END)::BIGINT AS held, sum(CASE WHEN kind <> 'grant' THEN amount_cents ELSE -amount_cents END)::BIGINT AS available FROM fund_event GROUP BY 1")
def l01(c):
    return L.balances(c.fund_event)


@query("l02_recent_average", "SELECT jurisdiction_id, round(avg(-amount_cents), 6) AS avg_cents, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY jurisdiction_id ORDER BY ts DESC, event_id DESC) AS rn FROM fund_event WHERE kind = 'spend') a WHERE rn <= 20 GROUP BY 1")
def l02(c):
    return L.recent_average(c.fund_event, ["jurisdiction_id"], 20)


@query("l03_admission", """WITH RECURSIVE e AS (SELECT user_id, event_id, kind, amount_cents AS cents, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM fund_event),
f AS (SELECT user_id, i, event_id, CASE WHEN kind <> 'spend' THEN cents WHEN cents < 0 THEN 0 ELSE cents END AS balance, kind = 'spend' AND cents < 0 AS paused, CASE WHEN kind <> 'spend' THEN 'credited' WHEN cents < 0 THEN 'refused_floor' ELSE 'admitted' END AS decision FROM e WHERE i = 1
 UNION ALL SELECT e.user_id, e.i, e.event_id,
  CASE WHEN kind <> 'spend' THEN balance + cents WHEN paused OR balance + cents < 0 THEN balance ELSE balance + cents END,
  CASE WHEN kind <> 'spend' THEN false ELSE paused OR balance + cents < 0 END,
  CASE WHEN kind <> 'spend' THEN 'credited' WHEN paused THEN 'refused_paused' WHEN balance + cents < 0 THEN 'refused_floor' ELSE 'admitted' END FROM f JOIN e ON e.user_id = f.user_id AND e.i = f.i + 1)
SELECT event_id, decision, balance::BIGINT AS balance FROM f""")
def l03(c):
    return L.admission(c.fund_event, ["user_id"])


_WORK = """SELECT jurisdiction_id, kind, count(*) AS total, count(*) FILTER (WHERE meeting_id % 3 = 0) AS remaining, count(*) FILTER (WHERE meeting_id % 3 = 0 AND meeting_date < DATE '1999-01-01') AS historical FROM (
 SELECT body_id, meeting_id, meeting_date, 'agenda' AS kind, agenda_url AS url FROM meeting UNION ALL SELECT body_id, meeting_id, meeting_date, 'minutes', minutes_url FROM meeting) k JOIN governing_body b ON k.body_id = b.body_id WHERE url IS NOT NULL GROUP BY 1, 2"""


@query("l04_workload", _WORK)
def l04(c):
    return L.workload(c.meeting, c.governing_body, "1999-01-01", F.col("meeting_id") % 3 == 0)


@query("l05_onboarding_estimate", f"""WITH w AS ({_WORK}), r AS (SELECT 'minutes' AS kind, round(avg(-amount_cents), 6) AS avg_cents FROM (SELECT *, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS rn FROM fund_event WHERE kind = 'spend') a WHERE rn <= 50)
SELECT jurisdiction_id, round(sum(remaining * coalesce(avg_cents, 10)), 4) AS cents, CASE WHEN count(*) FILTER (WHERE remaining > 0 AND avg_cents IS NULL) = 0 THEN 'empirical' WHEN count(*) FILTER (WHERE remaining > 0 AND avg_cents IS NOT NULL) = 0 THEN 'default' ELSE 'mixed' END AS basis FROM w LEFT JOIN r ON w.kind = r.kind GROUP BY 1""")
def l05(c):
    latest = c.fund_event.filter("kind = 'spend'").orderBy(F.desc("ts"), F.desc("event_id")).limit(50)
    rates = latest.agg(F.round(F.avg(-F.col("amount_cents")), 6).alias("avg_cents")).withColumn("kind", F.lit("minutes"))
    return L.onboarding_estimate(L.workload(c.meeting, c.governing_body, "1999-01-01", F.col("meeting_id") % 3 == 0), rates)


@query("l07_usage_cost", """SELECT unit_id, model, round(sum((input * pin + output * pout + cache_read * pin * 0.1 + cache_write * pin * 1.25) / 1e6 + pages * 0.001), 6) AS cost FROM (
 SELECT *, CASE model WHEN 'claude-opus-4-1' THEN 15.0 WHEN 'claude-sonnet-4-5' THEN 3.0 WHEN 'claude-3-5-haiku-1' THEN 0.8 ELSE 15.0 END AS pin, CASE model WHEN 'claude-opus-4-1' THEN 75.0 WHEN 'claude-sonnet-4-5' THEN 15.0 WHEN 'claude-3-5-haiku-1' THEN 4.0 ELSE 75.0 END AS pout FROM (
  SELECT user_id AS unit_id, CASE event_id % 4 WHEN 0 THEN 'claude-opus-4-1' WHEN 1 THEN 'claude-sonnet-4-5' WHEN 2 THEN 'claude-3-5-haiku-1' ELSE 'other' END AS model, event_id % 1000 AS input, event_id % 700 AS output, event_id % 300 AS cache_read, event_id % 200 AS cache_write, event_id % 9 AS pages FROM events) a) b GROUP BY 1, 2""")
def l07(c):
    e = F.col("event_id")
    model = F.when(e % 4 == 0, "claude-opus-4-1").when(e % 4 == 1, "claude-sonnet-4-5").when(e % 4 == 2, "claude-3-5-haiku-1").otherwise("other")
    usage = c.events.select(F.col("user_id").alias("unit_id"), model.alias("model"), (e % 1000).alias("input"), (e % 700).alias("output"), (e % 300).alias("cache_read"), (e % 200).alias("cache_write"), (e % 9).alias("pages"))
    return L.usage_cost(usage)
