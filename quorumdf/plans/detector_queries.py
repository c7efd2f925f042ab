"""Queries of the governance and quality detectors."""

from pyspark.sql import functions as F

from quorumdf.dealing import parts
from quorumdf.operators import detectors as D

from .registry import query

_STAFF = "'director', 'administrator', 'attorney', 'clerk', 'manager', 'engineer', 'chief', 'inspector', 'coordinator', 'secretary', 'treasurer', 'superintendent', 'officer'"
_GENERIC = "'staff', 'resident', 'applicant', 'petitioner', 'unknown', 'n/a'"
PARCELS = """SELECT motion_id, meeting_id, body_id, motion_date, motion_type,
    CASE WHEN title LIKE 'Parcel ID %' THEN 'parcel:' || substr(title, 11) WHEN title LIKE 'Parcel No. %' THEN 'parcel:' || substr(title, 12)
         ELSE 'addr:' || replace(upper(substr(title, 13)), '  ', ' ') END AS parcel FROM motion WHERE title LIKE 'Parcel %' OR title LIKE 'Rezoning of %'"""

QA_SQL = f"""
SELECT motion_id, 1 AS severity, 'qa_generic_petitioner' AS pattern_id FROM motion WHERE lower(trim(petitioner)) IN ({_GENERIC}) OR length(lower(trim(petitioner))) < 3
UNION ALL SELECT motion_id, 2, 'qa_petitioner_is_staff' FROM motion WHERE len(list_filter([{_STAFF}], lambda w: contains(lower(petitioner), w))) > 0
UNION ALL SELECT motion_id, 1, 'qa_short_motion_title' FROM motion WHERE length(trim(title)) < 10
UNION ALL SELECT m.motion_id, 2, 'qa_tally_mismatch' FROM motion m LEFT JOIN (SELECT motion_id, count(*) AS recorded FROM vote GROUP BY motion_id) v ON m.motion_id = v.motion_id
  WHERE tally_yes + tally_no + tally_abstain > 0 AND tally_yes + tally_no + tally_abstain <> coalesce(recorded, 0)
"""


@query("d01_unanimity_rate", """
SELECT *, CAST(CASE WHEN pct >= 95 AND n >= 100 THEN 3 WHEN pct >= 90 AND n >= 50 THEN 2 ELSE 1 END AS INT) AS severity FROM (
  SELECT body_id, n, unanimous, unanimous * 100 // n AS pct FROM (
    SELECT body_id, count(*) AS n, count(*) FILTER (WHERE tally_yes > 0 AND tally_no = 0 AND tally_abstain = 0) AS unanimous
    FROM motion WHERE tally_yes + tally_no + tally_abstain > 0 GROUP BY body_id) a WHERE n >= 30) b WHERE pct >= 80""")
def d01(c):
    return D.unanimity_rate(c.motion)


@query("d02_recusal_absence", """
SELECT official_id, body_id, n_votes, years, CASE WHEN n_votes > 300 AND years >= 5 THEN 3 WHEN n_votes > 100 THEN 2 ELSE 1 END AS severity FROM (
  SELECT official_id, min(body_id) AS body_id, count(*) AS n_votes, round_even(date_diff('day', min(motion_date), max(motion_date)) / 365.25, 1) AS years
  FROM vote GROUP BY official_id HAVING count(*) > 50 AND count(*) FILTER (WHERE vote_value = 'conflict_recusal') = 0) a""")
def d02(c):
    return D.recusal_absence(c.vote)


@query("d03_reconsidered_motion", f"""
WITH p AS ({PARCELS}), g AS (
  SELECT body_id, parcel, count(*) AS n, min(motion_date) AS first_date, max(motion_date) AS last_date,
         string_agg(CAST(motion_id AS VARCHAR), ',' ORDER BY motion_date, motion_id) AS motions
  FROM p WHERE motion_type IN ('zoning_change', 'ordinance', 'resolution') GROUP BY body_id, parcel)
SELECT body_id, parcel, n, first_date, last_date, motions, CAST(last_date - first_date AS INT) AS span,
  CASE WHEN n >= 3 AND last_date - first_date <= 365 THEN 3 WHEN last_date - first_date <= 180 THEN 2 ELSE 1 END AS severity
FROM g WHERE n >= 2 AND last_date - first_date <= 730""")
def d03(c):
    out = D.reconsidered_motion(c.motion)
    return out.withColumn("motions", F.array_join(F.transform("evidence", lambda e: e["motion_id"].cast("string")), ",")).drop("evidence")


@query("d04_development_bundle", f"""
WITH p AS ({PARCELS}), g AS (
  SELECT meeting_id, count(DISTINCT parcel) AS n_parcels, list_sort(list(DISTINCT parcel))[1:10] AS s FROM p WHERE motion_type IN ('zoning_change', 'ordinance') GROUP BY meeting_id)
SELECT meeting_id, n_parcels, array_to_string(s, ',') AS samples, CASE WHEN n_parcels >= 5 THEN 3 WHEN n_parcels = 4 THEN 2 ELSE 1 END AS severity FROM g WHERE n_parcels >= 3""")
def d04(c):
    return D.development_bundle(c.motion).withColumn("samples", F.array_join("samples", ","))


@query("d05_pattern_runner", f"SELECT pattern_id, severity, count(*) AS n FROM ({QA_SQL}) q GROUP BY pattern_id, severity")
def d05(c):
    return D.run_detectors(c).groupBy("pattern_id", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("d06_petitioner_is_staff", f"""
SELECT motion_id, array_to_string(hits, ',') AS matched, 2 AS severity FROM (
  SELECT motion_id, list_filter([{_STAFF}], lambda w: contains(lower(petitioner), w)) AS hits FROM motion) a WHERE len(hits) > 0""")
def d06(c):
    return D.petitioner_is_staff(c.motion)


@query("d07_tally_mismatch", """
SELECT m.motion_id, tally_yes + tally_no + tally_abstain AS declared, coalesce(recorded, 0) AS recorded
FROM motion m LEFT JOIN (SELECT motion_id, count(*) AS recorded FROM vote GROUP BY motion_id) v ON m.motion_id = v.motion_id
WHERE tally_yes + tally_no + tally_abstain > 0 AND tally_yes + tally_no + tally_abstain <> coalesce(recorded, 0)""")
def d07(c):
    c.deal("lineitem", "l_orderkey")  # votes are distinct and counted by motion
    return D.tally_mismatch(c.motion, c.vote)


@query("d08_short_motion_title", "SELECT motion_id, length(trim(title)) AS title_length, 1 AS severity FROM motion WHERE length(trim(title)) < 10")
def d08(c):
    return D.short_motion_title(c.motion)


@query("d09_orphan_official", """
SELECT official_id FROM official o WHERE is_elected AND NOT EXISTS (SELECT 1 FROM vote v WHERE v.official_id = o.official_id AND v.body_id = o.body_id)
AND NOT EXISTS (SELECT 1 FROM term t WHERE t.official_id = o.official_id)""")
def d09(c):
    own = c.vote.join(c.official.select("official_id", "body_id"), ["official_id", "body_id"], "left_semi")
    return D.orphan_official(c.official, own, c.term)


@query("d10_low_confidence_meeting", "SELECT meeting_id, body_id FROM meeting WHERE meta ILIKE '%unavailable%'")
def d10(c):
    return D.low_confidence_meeting(c.meeting)


_NAMES = "SELECT custkey AS official_id, name AS canonical_name FROM (SELECT c_custkey AS custkey, c_name AS name FROM customer ) x"


@query("d11_official_as_petitioner", f"""
WITH n AS ({_NAMES})
SELECT DISTINCT motion_id, official_id FROM motion JOIN n ON
  starts_with(lower(petitioner), lower(canonical_name)) OR starts_with(lower(petitioner), 'city manager ' || lower(canonical_name))
  OR starts_with(lower(petitioner), 'mayor ' || lower(canonical_name)) OR starts_with(lower(petitioner), 'councilmember ' || lower(canonical_name)) OR starts_with(lower(petitioner), 'commissioner ' || lower(canonical_name))""")
def d11(c):
    names = c.customer.select(F.col("c_custkey").alias("official_id"), F.col("c_name").alias("canonical_name"))
    tasks = parts(c.orders)
    return D.official_as_petitioner(c.deal("orders", "o_custkey").motion_text, names, tasks)


@query("d13_generic_petitioner", f"SELECT motion_id, lower(trim(petitioner)) AS petitioner, 1 AS severity FROM motion WHERE lower(trim(petitioner)) IN ({_GENERIC}) OR length(lower(trim(petitioner))) < 3")
def d13(c):
    return D.generic_petitioner(c.motion)


@query("d15_staff_looking_officials", "SELECT official_id, canonical_name FROM official o WHERE canonical_name LIKE 'City Clerk %' AND NOT EXISTS (SELECT 1 FROM term t WHERE t.official_id = o.official_id)")
def d15(c):
    return D.staff_looking_official(c.official, c.term)


@query("d16_quarantine_bridge", f"""
WITH q AS ({QA_SQL}), top AS (SELECT motion_id, pattern_id FROM (SELECT *, row_number() OVER (PARTITION BY motion_id ORDER BY severity DESC, pattern_id) AS rn FROM q) a WHERE rn = 1),
s AS (SELECT m.motion_id, pattern_id, CASE WHEN m.motion_id % 41 = 0 THEN 'disputed' WHEN m.motion_id % 43 = 0 THEN 'repairing' ELSE 'clean' END AS old_state FROM motion m LEFT JOIN top ON m.motion_id = top.motion_id),
n AS (SELECT *, CASE WHEN old_state = 'repairing' THEN 'repairing' WHEN pattern_id IS NOT NULL THEN 'disputed' ELSE 'clean' END AS new_state FROM s)
SELECT motion_id, old_state, new_state, CASE WHEN new_state = 'disputed' THEN pattern_id END AS reason FROM n""")
def d16(c):
    m = F.col("motion_id")  # what an earlier run left
    old = F.when(m % 41 == 0, "disputed").when(m % 43 == 0, "repairing").otherwise("clean")
    return D.quarantine(c.motion.withColumn("old_state", old), D.run_detectors(c))


@query("w02_top_finding_per_motion", f"WITH q AS ({QA_SQL}) SELECT motion_id, severity, pattern_id FROM (SELECT *, row_number() OVER (PARTITION BY motion_id ORDER BY severity DESC, pattern_id) AS rn FROM q) a WHERE rn = 1")
def w02(c):
    return D.top_finding(D.run_detectors(c))
