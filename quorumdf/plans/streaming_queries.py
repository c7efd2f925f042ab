"""Streams run over what is there and compared with the batch answer."""

from pyspark.sql import functions as F

from quorumdf.streaming import jobs as Z

from .registry import ORACLES, query


def _events(c):
    return Z.read_stream(c.spark, f"{c.sf_dir}/events.parquet")


@query("z01_milestones_once", "SELECT DISTINCT user_id % 5 AS jurisdiction_id, event_type || ':' || (user_id % 10) AS key FROM events")
def z01(c):
    return Z.run_to_table(Z.milestones_once(_events(c), "400 days"), "append")


@query("z02_health_by_window", """SELECT date_trunc('day', ts) AS day, CASE event_id % 3 WHEN 0 THEN 'text' WHEN 1 THEN 'ocr' ELSE 'vision' END AS method, count(*) AS n, count(*) FILTER (WHERE event_id % 7 = 0) AS failed FROM events WHERE event_type IN ('view', 'click') GROUP BY 1, 2""")
def z02(c):
    return Z.run_to_table(Z.health_by_window(_events(c), "400 days"), "update", ["day", "method"])


@query("z03_silent_sessions", """WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 36 HOUR OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS brk FROM events),
s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS sid FROM g) SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 36 HOUR AS ended, count(*) AS n FROM s GROUP BY user_id, sid""")
def z03(c):
    return Z.silent_sessions(c.events)


@query("z05_ledger_admission", None)
def z05(c):
    return Z.run_to_table(Z.admission_stream(Z.fund_events(_events(c))), "append")


ORACLES["z05_ledger_admission"] = ORACLES["l03_admission"]


@query("z06_comment_tallies", """SELECT CAST(floor(conv_id / 10.0) AS BIGINT) AS item_id, count(*) FILTER (WHERE (conv_id + turn) % 3 = 0) AS support, count(*) FILTER (WHERE (conv_id + turn) % 3 = 1) AS oppose, count(*) FILTER (WHERE (conv_id + turn) % 3 = 2) AS neutral FROM conversations WHERE CAST(floor(conv_id / 10.0) AS BIGINT) % 7 <> 0 GROUP BY 1""")
def z06(c):
    items = c.citizen_comment.select("item_id").distinct().filter("item_id % 7 <> 0")
    stream = Z.read_stream(c.spark, f"{c.sf_dir}/conversations.parquet")
    return Z.run_to_table(Z.comment_tallies(stream, items), "update", ["item_id"])


@query("z07_contact_status", "SELECT user_id, count(*) AS n, max_by(event_type, (ts, event_id)) AS last_event FROM events GROUP BY 1")
def z07(c):
    return Z.run_to_table(Z.contact_status(_events(c)), "update", ["user_id"])


@query("z08_failure_counts", "SELECT user_id % 5 AS jurisdiction_id, 'job' || (event_id % 3) AS job, 'step' || (event_id % 4) AS step, count(*) AS n, max(event_id) AS last_id FROM events WHERE event_type = 'error' GROUP BY 1, 2, 3")
def z08(c):
    return Z.run_to_table(Z.failure_counts(_events(c)), "update", ["jurisdiction_id", "job", "step"])
