"""Streams whose results don't depend on the cut into batches, each against SQL over the whole table."""

import uuid

from pyspark.sql import functions as F

from quorumdf.operators.facts import comment_cutoff
from quorumdf.operators.snapshots import Snapshots
from quorumdf.streaming import exactly_once as X
from quorumdf.streaming import jobs as Z
from quorumdf.streaming import ordered as O
from quorumdf.views import VIEWS

from .registry import query

HOUR = 3_600_000


def _stream(c, view):
    """The stream of a civic view over the events alone."""
    rows = Z.read_stream(c.spark, f"{c.sf_dir}/events.parquet")
    name = f"stream_{uuid.uuid4().hex[:8]}"
    rows.createOrReplaceTempView(name)
    return c.spark.sql(VIEWS[view].replace("FROM events", f"FROM {name}"))


def _ordered(c, events, keys, fold, delay):
    conf, name = c.spark.conf, "spark.sql.streaming.stateStore.providerClass"
    old = conf.get(name)
    conf.set(name, O.STATE_STORE)  # what states of this kind are kept in
    try:
        return Z.run_to_table(O.ordered_fold(events, keys, fold, delay), "append")
    finally:
        conf.set(name, old)


def _batches(c, stream, make):
    root = f"{Z.scratch(c.spark)}/versions-{uuid.uuid4().hex[:12]}"
    snapshots = Snapshots(c.spark, root)
    X.run_batches(stream, make(snapshots), f"{root}/checkpoint")
    return snapshots


_BEFORE = "(SELECT max(epoch_us(ts) // 1000) FROM events)"


@query("z03b_silent_keys_by_timer", f"""WITH e AS (SELECT user_id, epoch_us(ts) // 1000 AS t, lead(epoch_us(ts) // 1000) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events WHERE (epoch_us(ts) // 1000) < {_BEFORE}),
g AS (SELECT *, t + {36 * HOUR} AS due FROM e WHERE coalesce(nxt, {_BEFORE}) > t + {36 * HOUR})
SELECT user_id, due AS at, 'silent' AS state, t AS last_seen FROM g UNION ALL SELECT user_id, nxt, 'running', t FROM g WHERE nxt IS NOT NULL""")
def z03b(c):
    events = Z.read_stream(c.spark, f"{c.sf_dir}/events.parquet").select("user_id", "ts", "event_id")
    return _ordered(c, events, ["user_id"], O.Silence(36 * HOUR), "0 seconds")


_FORGET = 60 * HOUR
#: Rows of a key up to the first that suppresses it count; then observations only refresh.
_ISSUES = f"""WITH e AS (SELECT *, epoch_us(ts) // 1000 AS t FROM issue_event WHERE (epoch_us(ts) // 1000) < {_BEFORE} AND kind <> 'noted'),
a AS (SELECT *, lag(kind) OVER k AS was FROM (SELECT * FROM e WHERE kind <> 'wont_fix') x WINDOW k AS (PARTITION BY jurisdiction_id, dedupe_key ORDER BY t, event_id)),
l AS (SELECT *, max(CASE WHEN kind = 'observed' THEN t END) OVER p AS seen, arg_max(kind, struct_pack(t, event_id)) FILTER (WHERE kind <> 'wont_fix') OVER p AS prev FROM e WINDOW p AS (PARTITION BY jurisdiction_id, dedupe_key ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (SELECT *, prev = 'observed' AND t - seen <= {_FORGET} AS live, min(CASE WHEN kind = 'wont_fix' AND prev = 'observed' AND t - seen <= {_FORGET} THEN struct_pack(t, event_id) END) OVER (PARTITION BY jurisdiction_id, dedupe_key) AS stop FROM l),
f AS (SELECT *, stop IS NOT NULL AND struct_pack(t, event_id) > stop AS frozen, kind = 'observed' AND NOT coalesce(live, false) AND (stop IS NULL OR struct_pack(t, event_id) < stop) AS starts FROM s),
r AS (SELECT *, max(CASE WHEN starts THEN t END) OVER (PARTITION BY jurisdiction_id, dedupe_key ORDER BY t, event_id) AS first_observed,
 coalesce(lead(t) OVER (PARTITION BY jurisdiction_id, dedupe_key ORDER BY t, event_id), {_BEFORE}) AS nxt, lead(t) OVER (PARTITION BY jurisdiction_id, dedupe_key ORDER BY t, event_id) IS NULL AS ends FROM f),
o AS (SELECT jurisdiction_id, dedupe_key, t AS at, CASE WHEN kind = 'observed' THEN CASE WHEN NOT starts THEN 'updated' WHEN seen IS NULL THEN 'inserted' ELSE 'reopened' END WHEN kind = 'cleared' THEN 'closed' ELSE 'suppressed' END AS action,
 CASE WHEN frozen OR kind = 'wont_fix' THEN 'wont_fix' WHEN kind = 'observed' THEN 'open' ELSE 'resolved' END AS status, first_observed, CASE WHEN kind = 'observed' THEN t ELSE seen END AS last_observed,
 CASE kind WHEN 'cleared' THEN 'auto-cleared' WHEN 'wont_fix' THEN 'operator' END AS resolved_by FROM r WHERE kind = 'observed' OR (coalesce(live, false) AND NOT frozen)),
x AS (SELECT jurisdiction_id, dedupe_key, last + {_FORGET} AS at, 'closed' AS action, 'resolved' AS status, first_observed, last AS last_observed, 'not-observed' AS resolved_by FROM
 (SELECT *, t AS last, min(CASE WHEN kind <> 'noted' THEN t END) OVER (PARTITION BY jurisdiction_id, dedupe_key ORDER BY t, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM r) y
 WHERE kind = 'observed' AND NOT frozen AND t + {_FORGET} < coalesce(after, {_BEFORE}))
SELECT * FROM o UNION ALL SELECT * FROM x"""


@query("z04b_issue_lifecycle_stream", _ISSUES)
def z04b(c):
    """Every change of every issue; an org-level issue has no jurisdiction."""
    return _ordered(c, _stream(c, "issue_event"), ["jurisdiction_id", "dedupe_key"], O.IssueLifecycle(_FORGET), "0 seconds")


@query("z01b_milestones_exactly_once", """SELECT jurisdiction_id, dedupe_key, ts, event_id FROM (SELECT *, row_number() OVER (PARTITION BY jurisdiction_id, dedupe_key ORDER BY ts, event_id) AS rn FROM milestone_event) m
WHERE rn = 1 OR dedupe_key IS NULL OR jurisdiction_id IS NULL""")
def z01b(c):
    return _batches(c, _stream(c, "milestone_event"), X.milestones).table("activity", X.ACTIVITY)


_DELIVERED = """d AS (SELECT lower(trim(email)) AS email, event_type, ts, event_id, CASE WHEN event_type = 'email.delivered' THEN 'verified' ELSE 'undeliverable' END AS status FROM delivery_event
 WHERE event_type IN ('email.bounced', 'email.complained', 'email.delivered') AND trim(email) <> '')"""


@query("z07b_delivery_status", f"WITH {_DELIVERED} SELECT email, arg_max(status, struct_pack(ts, event_id)) AS status, max(ts) AS checked_at, arg_max(event_id, struct_pack(ts, event_id)) AS event_id FROM d GROUP BY email")
def z07b(c):
    return _batches(c, _stream(c, "delivery_event"), X.deliveries).table("status", X.STATUS)


@query("z07c_delivery_alerts", f"""WITH {_DELIVERED}, p AS (SELECT *, lag(status) OVER (PARTITION BY email ORDER BY ts, event_id) AS before FROM d)
SELECT email, event_type, ts, event_id FROM p WHERE status = 'undeliverable' AND before IS DISTINCT FROM 'undeliverable'""")
def z07c(c):
    return _batches(c, _stream(c, "delivery_event"), X.deliveries).table("alert", X.ALERT)


_JUDGED = """i AS (SELECT item_id, CAST(meeting_date AS TIMESTAMP) + INTERVAL 6 HOUR + CASE WHEN in_phoenix THEN INTERVAL 7 HOUR ELSE INTERVAL 0 HOUR END AS cutoff FROM agenda_item),
v AS (SELECT comment_id, user_id, k.item_id, lower(trim(stance)) AS stance, ts, CASE WHEN lower(trim(stance)) NOT IN ('support', 'oppose', 'neutral') THEN 'stance' WHEN cutoff IS NULL THEN 'unknown item' WHEN ts >= cutoff THEN 'closed' END AS reason
 FROM comment_event k LEFT JOIN i ON k.item_id = i.item_id),
w AS (SELECT *, row_number() OVER (PARTITION BY user_id, item_id, reason IS NULL ORDER BY ts, comment_id) AS rn FROM v)"""


def _comments(c):
    zone = F.when(F.col("in_phoenix"), "America/Phoenix").otherwise("UTC")
    items = c.agenda_item.select("item_id", comment_cutoff(F.col("meeting_date"), F.lit(None).cast("string"), zone).alias("cutoff"))
    return _batches(c, _stream(c, "comment_event"), lambda s: X.comments_until_cutoff(s, items))


@query("z06b_comments_accepted", f"WITH {_JUDGED} SELECT comment_id, user_id, item_id, stance, ts FROM w WHERE reason IS NULL AND rn = 1")
def z06b(c):
    return _comments(c).table("accepted", X.COMMENT)


@query("z06c_comments_rejected", f"WITH {_JUDGED} SELECT comment_id, user_id, item_id, stance, ts, coalesce(reason, 'repeat') AS reason FROM w WHERE reason IS NOT NULL OR rn > 1")
def z06c(c):
    return _comments(c).table("rejected", f"{X.COMMENT}, reason string")


@query("z06d_tallies_until_cutoff", f"WITH {_JUDGED} SELECT item_id, count(*) FILTER (WHERE stance = 'support') AS support, count(*) FILTER (WHERE stance = 'oppose') AS oppose, count(*) FILTER (WHERE stance = 'neutral') AS neutral FROM w WHERE reason IS NULL AND rn = 1 GROUP BY 1")
def z06d(c):
    return X.tallies(_comments(c).table("accepted", X.COMMENT))
