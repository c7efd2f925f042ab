"""Queries of name resolution over persons as minutes, rosters, filings and directories write them."""

from pyspark.sql import functions as F

from quorumdf.functions import names as N
from quorumdf.operators import facts as R
from quorumdf.operators import people as P
from quorumdf.operators import resolution as E

from .entity_queries import _GRAMS, _sim
from .registry import query


def _officials(c):
    return c.person.withColumn("canonical_name", F.concat_ws(" ", "first_name", "last_name"))


def _asked(c):
    return c.minutes_name.select("name", "jurisdiction_id", F.col("motion_date").alias("as_of"))


# Titles as the derived minutes write them.
def _plain(col):
    return rf"regexp_replace(trim({col}), '(?i)^((Councilmember|Mayor|Mr\.)\s+)+', '')"


_LAST = r"lower(list_extract(string_split_regex({0}, '\s+'), -1))"
_ASKED = "SELECT DISTINCT name, jurisdiction_id, motion_date AS as_of FROM minutes_name"
_LIVE = "EXISTS (SELECT 1 FROM term t WHERE t.official_id = p.official_id AND t.start_date <= n.as_of AND (t.end_date IS NULL OR t.end_date >= n.as_of))"
_SURNAME = f"""SELECT n.name, n.jurisdiction_id, n.as_of, p.official_id, p.first_name, {_LIVE} AS active FROM {{0}} n JOIN person p ON n.jurisdiction_id = p.jurisdiction_id AND lower(p.last_name) = {_LAST.format('n.name')}
 WHERE p.official_id IN (SELECT official_id FROM term)"""
_ALIAS = "SELECT lower(alias) AS low, min(official_id) AS oid FROM official_alias GROUP BY 1"


@query("e02b_surname_candidates", f"""WITH a AS ({_ASKED}), s AS ({_SURNAME.format('a')}), w AS (SELECT *, bool_or(active) OVER (PARTITION BY name, jurisdiction_id, as_of) AS anyone FROM s)
SELECT name, jurisdiction_id, as_of, official_id, active FROM w WHERE active OR NOT anyone""")
def e02b(c):
    return P.surname_as_of(_asked(c), c.person, c.term).select("name", "jurisdiction_id", "as_of", "official_id", "active")


_CAND = f"""SELECT name, official_id, max(similarity) AS similarity FROM (
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY similarity DESC, official_id) AS rn FROM (
  SELECT q.name, p.official_id, {_sim('q.g', 'p.g')} AS similarity FROM {{0}} q, (SELECT official_id, {_GRAMS.format("first_name || ' ' || last_name")} AS g FROM person) p) a WHERE similarity >= 0.65) b WHERE rn <= 5
 UNION ALL SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY similarity DESC, official_id) AS rn FROM (
  SELECT q.name, p.official_id, max({_sim('q.g', 'p.g')}) AS similarity FROM {{0}} q, (SELECT official_id, {_GRAMS.format('alias')} AS g FROM official_alias) p GROUP BY 1, 2) a WHERE similarity >= 0.65) b WHERE rn <= 5) u GROUP BY 1, 2"""


@query("e04b_candidates_by_name_and_alias", f"WITH q AS (SELECT name, {_GRAMS.format('name')} AS g FROM (SELECT DISTINCT name FROM minutes_name) x) {_CAND.format('q')}")
def e04b(c):
    return P.candidates(c.minutes_name, _officials(c), c.official_alias)


_RESOLVED = f"""n AS (SELECT *, {_plain('name')} AS plain FROM ({_ASKED}) x), al AS ({_ALIAS}),
k AS (SELECT n.*, coalesce(a.oid, b.oid) AS oid, CASE WHEN a.oid IS NOT NULL THEN 'alias' WHEN b.oid IS NOT NULL THEN 'stripped' END AS via FROM n LEFT JOIN al a ON lower(n.name) = a.low LEFT JOIN al b ON lower(n.plain) = b.low),
o AS (SELECT DISTINCT plain AS name, jurisdiction_id, as_of FROM k WHERE via IS NULL),
s AS ({_SURNAME.format('o')}), w AS (SELECT *, bool_or(active) OVER (PARTITION BY name, jurisdiction_id, as_of) AS anyone, contains(name, ' ') AND lower(left(name, 1)) = lower(left(first_name, 1)) AS hit FROM s),
g AS (SELECT name, jurisdiction_id, as_of, count(*) AS n1, min(official_id) AS o1, count(*) FILTER (WHERE hit) AS n2, min(official_id) FILTER (WHERE hit) AS o2 FROM w WHERE active OR NOT anyone GROUP BY 1, 2, 3),
r AS (SELECT o.* FROM o LEFT JOIN g ON o.name = g.name AND o.jurisdiction_id = g.jurisdiction_id AND o.as_of = g.as_of WHERE g.name IS NULL),
q AS (SELECT name, {_GRAMS.format('name')} AS g FROM (SELECT DISTINCT name FROM r) x), cd AS ({_CAND.format('q')}),
z AS (SELECT r.name, r.jurisdiction_id, r.as_of, p.official_id, row_number() OVER (PARTITION BY r.name, r.jurisdiction_id, r.as_of ORDER BY similarity DESC, p.official_id) AS i FROM r JOIN cd ON r.name = cd.name JOIN person p ON p.official_id = cd.official_id AND p.jurisdiction_id = r.jurisdiction_id
 WHERE similarity >= 0.75 AND p.official_id IN (SELECT official_id FROM term)),
f AS (SELECT name, jurisdiction_id, as_of, CASE WHEN n1 = 1 THEN o1 WHEN n2 = 1 THEN o2 END AS oid, CASE WHEN n1 = 1 THEN 'surname' WHEN n2 = 1 THEN 'initial' ELSE 'ambiguous' END AS via FROM g UNION ALL SELECT name, jurisdiction_id, as_of, official_id, 'similar' FROM z WHERE i = 1),
res AS (SELECT k.name, k.jurisdiction_id, k.as_of, coalesce(k.oid, f.oid) AS official_id, coalesce(k.via, f.via, 'none') AS matched_via FROM k LEFT JOIN f ON k.plain = f.name AND k.jurisdiction_id = f.jurisdiction_id AND k.as_of = f.as_of)"""


def _resolved(c):
    return P.resolve_for_meeting(_asked(c), _officials(c), c.official_alias, c.term)


@query("e07_meeting_resolver", f"WITH {_RESOLVED} SELECT * FROM res")
def e07(c):
    return _resolved(c)


# First names agree in the derived minutes: none given, equal, an initial of either, or the nickname's full form.
_FULL = "CASE lower({0}) WHEN 'bill' THEN 'william' WHEN 'kate' THEN 'katherine' WHEN 'doug' THEN 'douglas' WHEN 'joe' THEN 'joseph' ELSE lower({0}) END"


def _agree(a, b):
    x, y = f"rtrim(lower({a}), '.')", f"lower({b})"
    return f"({a} IS NULL OR {x} = {y} OR (length({x}) = 1 AND starts_with({y}, {x})) OR {_FULL.format(a)} = {_FULL.format(b)})"


_FIRST = "CASE WHEN contains({0}, ' ') THEN split_part({0}, ' ', 1) END"


@query("e08_new_aliases", f"""WITH {_RESOLVED}, c AS (SELECT lower(name) AS low, name, as_of, r.official_id FROM res r JOIN person p ON r.official_id = p.official_id
 WHERE matched_via <> 'alias' AND lower(name) NOT IN (SELECT lower(alias) FROM official_alias) AND {_agree(_FIRST.format(_plain('name')), 'p.first_name')})
SELECT name AS alias, official_id FROM (SELECT *, row_number() OVER (PARTITION BY low ORDER BY as_of, official_id, name) AS i FROM c) d WHERE i = 1""")
def e08(c):
    return P.new_aliases(_resolved(c), c.person, c.official_alias)


_BULK = rf"""bn AS (SELECT DISTINCT name FROM minutes_name), bal AS ({_ALIAS}),
b1 AS (SELECT bn.name, {_plain('bn.name')} AS plain, regexp_matches(bn.name, '(?i)[0-9(]|illegible|unknown') AS bad, a.oid AS o1, b.oid AS o2 FROM bn LEFT JOIN bal a ON lower(bn.name) = a.low LEFT JOIN bal b ON lower({_plain('bn.name')}) = b.low),
b2 AS (SELECT b1.name, count(*) AS k, min(p.official_id) AS o3 FROM b1 JOIN person p ON lower(p.last_name) = {_LAST.format('plain')} WHERE NOT bad AND o1 IS NULL AND o2 IS NULL
 AND CASE WHEN contains(plain, ' ') THEN {_agree(_FIRST.format('plain'), 'p.first_name')} ELSE p.official_id IN (SELECT official_id FROM term) END GROUP BY 1),
bulk AS (SELECT b1.name, CASE WHEN bad THEN NULL ELSE coalesce(o1, o2, CASE WHEN k = 1 THEN o3 END) END AS official_id,
 CASE WHEN bad THEN 'unresolvable' WHEN o1 IS NOT NULL THEN 'alias' WHEN o2 IS NOT NULL THEN 'stripped' WHEN k = 1 THEN 'surname' ELSE 'none' END AS matched_via FROM b1 LEFT JOIN b2 ON b1.name = b2.name)"""


def _bulk(c):
    return E.bulk_resolve(c.minutes_name, c.official_alias, _officials(c), c.term).select("name", "official_id", "matched_via")


@query("e06b_bulk_resolver_of_persons", f"WITH {_BULK} SELECT * FROM bulk")
def e06b(c):
    return _bulk(c)


@query("e09b_roster_match_on_body", f"""WITH page AS (SELECT DISTINCT m.name, p.body_id FROM minutes_name m JOIN person p ON m.official_id = p.official_id), al AS ({_ALIAS}),
mem AS (SELECT DISTINCT p.official_id, p.body_id, p.first_name || ' ' || p.last_name AS canonical FROM person p JOIN term t ON p.official_id = t.official_id WHERE t.end_date IS NULL),
a AS (SELECT page.name, page.body_id, {_plain('page.name')} AS plain, m.official_id AS hit FROM page LEFT JOIN al x ON lower(page.name) = x.low LEFT JOIN al y ON lower({_plain('page.name')}) = y.low LEFT JOIN mem m ON m.official_id = coalesce(x.oid, y.oid) AND m.body_id = page.body_id),
s AS (SELECT a.name, a.body_id, m.official_id, {_sim(_GRAMS.format('plain'), _GRAMS.format('canonical'))} AS similarity FROM a JOIN mem m ON a.body_id = m.body_id WHERE hit IS NULL),
b AS (SELECT *, row_number() OVER (PARTITION BY name, body_id ORDER BY similarity DESC, official_id) AS i FROM s WHERE similarity >= 0.7)
SELECT a.name, a.body_id, coalesce(hit, b.official_id) AS official_id, CASE WHEN hit IS NOT NULL THEN 'alias' WHEN b.official_id IS NOT NULL THEN 'similar' END AS matched_via FROM a LEFT JOIN b ON a.name = b.name AND a.body_id = b.body_id AND i = 1""")
def e09b(c):
    page = c.minutes_name.select("name", "official_id").join(c.person.select("official_id", "body_id"), "official_id").select("name", "body_id")
    seats = c.person.select("official_id", "body_id").join(c.term.filter("end_date is null").select("official_id"), "official_id", "left_semi")
    return P.roster_match(page, _officials(c), c.official_alias, seats)


@query("e10b_filer_match_stages", f"""WITH n AS (SELECT DISTINCT name, string_split_regex(name, '\\s+') AS w FROM minutes_name), al AS ({_ALIAS}), f AS (SELECT lower(first_name) AS a, lower(last_name) AS z, min(official_id) AS oid FROM person GROUP BY 1, 2 HAVING count(*) = 1)
SELECT n.name, coalesce(x.oid, y.oid, f.oid) AS official_id FROM n LEFT JOIN al x ON lower(n.name) = x.low LEFT JOIN al y ON len(w) > 2 AND lower(w[1] || ' ' || w[-1]) = y.low LEFT JOIN f ON len(w) >= 2 AND lower(w[1]) = f.a AND lower(w[-1]) = f.z""")
def e10b(c):
    return P.filer_match(c.minutes_name, c.person, c.official_alias)


_CALLED = "CASE WHEN length(rtrim(first, '.')) = 1 AND middle IS NOT NULL THEN rtrim(split_part(middle, ' ', 1), '.') ELSE first END"
_PARTS = """{0} AS first, CASE WHEN len(string_split({1}, ' ')) > 2 THEN array_to_string(string_split({1}, ' ')[2:-2], ' ') END AS middle, string_split({1}, ' ')[-1] AS last"""


@query("e13_historical_officials", f"""WITH n AS (SELECT DISTINCT jurisdiction_id, {_plain('name')} AS shown FROM minutes_name WHERE name NOT LIKE 'unknown%'), p AS (SELECT *, {_PARTS.format(_FIRST.format('shown'), 'shown')} FROM n),
b AS (SELECT *, {_CALLED} AS called FROM p WHERE first IS NOT NULL),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY jurisdiction_id, lower(called), lower(last) ORDER BY length(shown) DESC, shown) AS i FROM b) x WHERE i = 1),
m AS (SELECT l.jurisdiction_id, shown, count(*) AS k, min(o.official_id) AS oid, min(o.first_name || ' ' || o.last_name) AS o_name FROM l JOIN person o ON lower(l.last) = lower(o.last_name) AND o.jurisdiction_id = l.jurisdiction_id WHERE {_agree('l.first', 'o.first_name')} OR {_agree('l.called', 'o.first_name')} GROUP BY 1, 2)
SELECT l.jurisdiction_id, l.shown AS canonical_name, first AS first_name, middle AS middle_name, last AS last_name, CASE WHEN k IS NULL THEN 'create' WHEN k > 1 THEN 'ambiguous' WHEN lower(o_name) = lower(l.shown) THEN 'known' ELSE 'alias' END AS action, CASE WHEN k = 1 THEN oid END AS official_id
FROM l LEFT JOIN m ON l.jurisdiction_id = m.jurisdiction_id AND l.shown = m.shown""")
def e13(c):
    return P.historical_officials(c.minutes_name, _officials(c))


def _old_payloads(c):
    """Payloads with the names as minutes write them, one per motion."""
    v = F.struct(F.col("official_id").alias("by"), F.col("name"), F.when(F.col("vote_value") != "conflict_recusal", F.col("vote_value")).alias("vote"))
    r = F.when(F.col("vote_value") == "conflict_recusal", F.struct(F.col("name"), F.when(F.col("official_id") % 2 == 0, "conflict").alias("reason")))
    per = c.minutes_name.groupBy("motion_id").agg(F.sort_array(F.collect_list(v)).alias("individual_votes"), F.sort_array(F.collect_list(r)).alias("recusals"))
    rows = c.motion.join(per, "motion_id")
    item = F.struct(F.col("motion_id").alias("item_number"), F.concat("title", F.lit(" ")).alias("title"), "individual_votes", "recusals")
    return rows.select("meeting_id", F.col("motion_date").alias("meeting_date"), F.to_json(F.struct(F.array(item).alias("agenda_items"))).alias("payload"))


@query("e14b_vote_backfill", f"""WITH {_BULK}, mo AS (SELECT meeting_id, title, max(motion_id) AS motion_id FROM motion GROUP BY 1, 2),
i AS (SELECT mo.motion_id, k.motion_id AS item, k.motion_date, v.official_id AS place, v.name, v.vote_value, b.official_id FROM minutes_name v JOIN motion k ON v.motion_id = k.motion_id JOIN mo ON k.meeting_id = mo.meeting_id AND k.title = mo.title JOIN bulk b ON v.name = b.name WHERE b.official_id IS NOT NULL),
x AS (SELECT i.*, EXISTS (SELECT 1 FROM minutes_name r WHERE r.motion_id = i.item AND r.name = i.name AND r.vote_value = 'conflict_recusal') AS left_out,
 (SELECT max(r.official_id) FROM minutes_name r WHERE r.motion_id = i.item AND r.name = i.name AND r.vote_value = 'conflict_recusal') AS who FROM i),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY motion_id, official_id ORDER BY item, place) AS rn FROM x) y WHERE rn = 1),
n AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM vote s WHERE s.motion_id = f.motion_id AND s.official_id = f.official_id AND (s.motion_id + s.official_id) % 3 = 0))
SELECT motion_id, official_id, (SELECT max_by(term_id, (start_date, term_id)) FROM term t WHERE t.official_id = n.official_id AND t.start_date <= n.motion_date AND (t.end_date IS NULL OR t.end_date >= n.motion_date)) AS term_id,
 CASE WHEN left_out THEN 'conflict_recusal' ELSE vote_value END AS vote_value, CASE WHEN left_out AND who % 2 = 0 THEN 'conflict' WHEN left_out THEN 'recused (no reason given)' END AS notes FROM n""")
def e14b(c):
    """Stored votes, an earlier state, are those whose ids add up to a multiple of three."""
    items = R.read_payloads(_old_payloads(c)).withColumn("pos", F.col("item.item_number"))
    stored = c.vote.filter("(motion_id + official_id) % 3 = 0")
    return P.backfill_votes(items, c.motion, _bulk(c), stored, c.term)


_LINES = """SELECT motion_id, motion_date, CASE motion_id % 6 WHEN 0 THEN 'City Manager ' || first_name || ' ' || last_name || 'x,' WHEN 1 THEN 'Finance Director ' || first_name || ' ' || last_name || 'x' WHEN 2 THEN 'Planning Commission'
 WHEN 3 THEN 'Chief ' || last_name WHEN 4 THEN 'Clerk ' || first_name || ' ' || last_name ELSE 'deputy ' || lower(first_name) || ' ' || last_name || 'x' END AS line FROM minutes_name n JOIN person p ON n.official_id = p.official_id"""


def _lines(c):
    rows = c.minutes_name.select("motion_id", "motion_date", "official_id").join(c.person.select("official_id", "first_name", "last_name"), "official_id")
    m, name = F.col("motion_id") % 6, F.concat_ws(" ", "first_name", "last_name")
    line = F.when(m == 0, F.concat(F.lit("City Manager "), name, F.lit("x,"))).when(m == 1, F.concat(F.lit("Finance Director "), name, F.lit("x"))).when(m == 2, F.lit("Planning Commission"))
    line = line.when(m == 3, F.concat(F.lit("Chief "), "last_name")).when(m == 4, F.concat(F.lit("Clerk "), name)).otherwise(F.concat(F.lit("deputy "), F.lower("first_name"), F.lit(" "), "last_name", F.lit("x")))
    return rows.select("motion_id", "motion_date", line.alias("line"))


@query("x06_recommender_names", rf"""WITH l AS (SELECT motion_id, line FROM ({_LINES}) x)
SELECT DISTINCT line, CASE WHEN ok THEN rtrim(string_split(line, ' ')[-2], ',.;:') END AS first_name, CASE WHEN ok THEN rtrim(string_split(line, ' ')[-1], ',.;:') END AS last_name FROM (
 SELECT *, NOT contains(line, 'Commission') AND string_split(line, ' ')[-2] NOT IN ('Chief') AND regexp_matches(string_split(line, ' ')[-2], '^[A-Z][A-Za-z]+$') AS ok FROM l) y""")
def x06(c):
    rows = _lines(c).select("line").distinct().withColumn("p", N.recommender_name(F.col("line")))
    return rows.select("line", F.col("p.first").alias("first_name"), F.col("p.last").alias("last_name"))


# Names of eight characters or more that stand within a line, as it is spelt; the derived surnames end in a letter of their group.
@query("e15b_staff_stubs_of_persons", rf"""WITH l AS (SELECT line, count(*) AS n, min(motion_date) AS first_date, max(motion_date) AS last_date FROM ({_LINES}) x GROUP BY 1 HAVING count(*) >= 2),
f AS (SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM person p WHERE length(first_name || ' ' || last_name) >= 8 AND contains(lower(line), lower(first_name || ' ' || last_name))
 AND official_id % 3 = 0)), y AS (SELECT *, string_split(line, ' ') AS w FROM f)
SELECT rtrim(w[-2], ',.;:') AS first_name, rtrim(w[-1], ',.;:') AS last_name, sum(n)::BIGINT AS motions, min(first_date) AS first_date, max(last_date) AS last_date, string_agg(line, '; ' ORDER BY line) AS lines FROM y
WHERE NOT contains(line, 'Commission') AND w[-2] <> 'Chief' AND regexp_matches(w[-2], '^[A-Z][A-Za-z]+$') GROUP BY 1, 2""")
def e15b(c):
    """Known officials are those whose ids are multiples of three: the rest of the staff has yet to be found."""
    return P.staff_stubs(_lines(c), _officials(c).filter("official_id % 3 = 0"))


@query("a10b_staff_roster", rf"""SELECT lower(w[-2]) AS first_name, lower(w[-1]) AS last_name, coalesce(string_agg(DISTINCT title, ', ' ORDER BY title), '') AS titles, sum(n)::BIGINT AS meetings, min(a) AS first_date, max(z) AS last_date FROM (
 SELECT string_split(line, ' ') AS w, CASE WHEN len(string_split(line, ' ')) > 2 THEN array_to_string(string_split(line, ' ')[:-3], ' ') END AS title, count(*) AS n, min(motion_date) AS a, max(motion_date) AS z FROM ({_LINES}) x GROUP BY 1, 2) y GROUP BY 1, 2""")
def a10b(c):
    entries = _lines(c).groupBy(F.col("line").alias("entry")).agg(F.count(F.lit(1)).alias("meetings"), F.min("motion_date").alias("first_date"), F.max("motion_date").alias("last_date"))
    return P.staff_roster(entries)


@query("e17b_staff_sync", f"""WITH {_BULK}, page AS (SELECT DISTINCT name, 'Member ' || length(name) AS title FROM minutes_name WHERE motion_id % 2 = 0), seen AS (SELECT page.*, official_id FROM page JOIN bulk USING (name)),
li AS (SELECT official_id, max(title) AS title FROM seen WHERE official_id IS NOT NULL GROUP BY 1)
SELECT p.official_id, first_name || ' ' || last_name AS canonical_name, is_elected, CASE WHEN li.official_id IS NOT NULL THEN true WHEN NOT is_elected AND p.official_id % 4 <> 0 THEN false ELSE p.official_id % 4 <> 0 END AS is_active, coalesce(title, 'old') AS display_title,
 CASE WHEN li.official_id IS NOT NULL THEN 'enriched' WHEN NOT is_elected AND p.official_id % 4 <> 0 THEN 'departed' ELSE 'kept' END AS action FROM person p LEFT JOIN li ON p.official_id = li.official_id
UNION ALL SELECT NULL, name, false, true, title, 'created' FROM seen WHERE official_id IS NULL""")
def e17b(c):
    """The page lists the names of every other motion; one in four officials was inactive before."""
    page = c.minutes_name.filter("motion_id % 2 = 0").select("name", F.concat(F.lit("Member "), F.length("name").cast("string")).alias("title"))
    before = _officials(c).withColumn("is_active", F.col("official_id") % 4 != 0).withColumn("display_title", F.lit("old"))
    return P.sync_staff(page, _bulk(c), before)


@query("e18b_roster_terms", f"""WITH r AS (SELECT DISTINCT name, official_id % 7 AS seat_id FROM minutes_name), al AS ({_ALIAS}), a AS (SELECT r.name, r.seat_id, oid FROM r LEFT JOIN al ON lower(name) = low),
t AS (SELECT *, row_number() OVER (PARTITION BY official_id, seat_id ORDER BY start_date DESC, term_id DESC) AS i FROM term)
SELECT a.name, a.seat_id, oid AS official_id, t.term_id, coalesce(t.start_date, DATE '2020-01-01') AS start_date, CASE WHEN t.term_id IS NULL THEN 'inserted' WHEN t.end_date IS NULL THEN 'kept' ELSE 'reopened' END AS action FROM a LEFT JOIN t ON a.oid = t.official_id AND a.seat_id = t.seat_id AND i = 1""")
def e18b(c):
    roster = c.minutes_name.select("name", (F.col("official_id") % 7).alias("seat_id"))
    return P.roster_terms(roster, c.official_alias, c.term)


_TOWNS = "SELECT kind, name, max(fips) AS fips FROM directory WHERE kind <> 'school_district' GROUP BY 1, 2"


@query("e16_bundles", rf"""WITH t AS ({_TOWNS}), c AS (SELECT name, fips FROM t WHERE kind = 'county'), y AS (SELECT name, fips FROM t WHERE kind = 'city'),
s AS (SELECT *, replace(name, ' School District', '') AS base, regexp_extract(name, '^(.+?) (County )?(Consolidated )?School District( [0-9]+)?$', 1) || ' County' AS num FROM directory WHERE kind = 'school_district'),
j AS (SELECT s.kind, s.fips, s.name, c1.fips AS f1, y1.fips AS f2, c2.fips AS f3, c3.fips AS f4 FROM s LEFT JOIN c c1 ON c1.name = base LEFT JOIN y y1 ON ends_with(base, ' City') AND y1.name = replace(base, ' City', '') LEFT JOIN c c2 ON c2.name = base || ' County' LEFT JOIN c c3 ON c3.name = num),
k AS (SELECT d.kind, d.fips, d.name, c1.fips AS f1, (SELECT max(c.fips) FROM c WHERE ends_with(d.name, '-' || c.name)) AS f2 FROM directory d LEFT JOIN c c1 ON c1.name = d.name WHERE d.kind = 'city')
SELECT 0 AS state, kind, fips, name, coalesce(f1, f2, f3, f4) AS bundle_fips, CASE WHEN f1 IS NOT NULL THEN 'county' WHEN f2 IS NOT NULL THEN 'city' WHEN f3 IS NOT NULL THEN 'base_county' WHEN f4 IS NOT NULL THEN 'numbered' END AS rule FROM j
UNION ALL SELECT 0, kind, fips, name, coalesce(f1, f2), CASE WHEN f1 IS NOT NULL THEN 'same_name' WHEN f2 IS NOT NULL THEN 'suffix' END FROM k""")
def e16(c):
    return P.bundles(c.directory)


@query("x05_goes_by", f"WITH n AS (SELECT DISTINCT name, {_plain('name')} AS shown FROM minutes_name), p AS (SELECT *, {_PARTS.format(_FIRST.format('shown'), 'shown')} FROM n) SELECT name, {_CALLED} AS called FROM p")
def x05(c):
    rows = c.minutes_name.select("name").distinct().withColumn("p", N.split_name(N.strip_title(F.col("name"))))
    return rows.select("name", N.goes_by(F.col("p")).alias("called"))


@query("x13_candidate_names", "SELECT DISTINCT m.name, p.party, m.name AS candidate, m.name || p.party AS ballot_name FROM minutes_name m JOIN (SELECT ' (I)' AS party UNION ALL SELECT ' Dem.' UNION ALL SELECT ' (write-in) ' UNION ALL SELECT ' NP' UNION ALL SELECT '') p ON true")
def x13(c):
    parties = F.explode(F.array(*map(F.lit, [" (I)", " Dem.", " (write-in) ", " NP", ""])))
    rows = c.minutes_name.select("name").distinct().withColumn("party", parties).withColumn("ballot_name", F.concat("name", "party"))
    return rows.select("name", "party", N.clean_candidate(F.col("ballot_name")).alias("candidate"), "ballot_name")
