"""Pipeline health, capabilities, activity and contacts as grouped jobs over all jurisdictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .observers import day


def stale_runs(runs: DataFrame, keys: list[str], time: str, as_of: str, hours: int = 36) -> DataFrame:
    """Keys whose latest run is older than so many hours."""
    last = runs.groupBy(*keys).agg(F.max(time).alias("last_run"))
    return last.filter(F.col("last_run") < F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS"))


def source_drift(meeting: DataFrame, as_of: str) -> DataFrame:
    """Bodies silent for longer than three median gaps (90 days at least), and those with dead documents."""
    w = Window.partitionBy("body_id").orderBy("meeting_date", "meeting_id")
    gaps = meeting.withColumn("gap", F.datediff("meeting_date", F.lag("meeting_date").over(w)))
    per = gaps.groupBy("body_id").agg(
        F.count_if(F.col("gap") > 0).alias("n_gaps"),
        F.expr("percentile_cont(0.5) WITHIN GROUP (ORDER BY CASE WHEN gap > 0 THEN gap END)").alias("median_gap"),
        F.max("meeting_date").alias("last_meeting"),
        F.count_if((F.col("meeting_date") >= F.date_sub(day(as_of), 180)) & (F.col("meeting_date") <= day(as_of))).alias("recent"),
        F.count_if((F.col("meeting_date") >= F.date_sub(day(as_of), 180)) & F.col("agenda_url").isNull()).alias("dead"),
    )
    threshold = F.greatest(3 * F.col("median_gap"), F.lit(90.0))
    silent = F.datediff(day(as_of), "last_meeting")
    kind = F.when((F.col("n_gaps") >= 5) & (silent > threshold), "cold_inventory").when((F.col("dead") >= 3) & (F.col("dead") > F.col("recent") / 2), "dead_documents")
    return per.withColumn("silent", silent).withColumn("kind", kind).filter("kind is not null").select("body_id", "n_gaps", "median_gap", "silent", "kind")


def failure_rollup(failure: DataFrame) -> DataFrame:
    """Open failures per (jurisdiction, job, step) with the latest message and the first ten ids."""
    rows = failure.filter(~F.col("resolved"))
    w = Window.partitionBy("jurisdiction_id", "job", "step").orderBy("failure_id")
    rows = rows.withColumn("rn", F.row_number().over(w))
    first = F.sort_array(F.collect_list(F.when(F.col("rn") <= 10, F.col("failure_id"))))
    return rows.groupBy("jurisdiction_id", "job", "step").agg(
        F.count(F.lit(1)).alias("n"), F.max_by("message", F.struct("created_at", "failure_id")).alias("latest"), F.array_join(first.cast("array<string>"), ",").alias("ids")
    )


def run_outcome(steps: DataFrame, key: str) -> DataFrame:
    """failed when all steps failed, partial when some did, paused when any paused, else ok."""
    per = steps.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "partial").alias("partial"))
    outcome = F.when(F.col("failed") == F.col("n"), "failed").when(F.col("failed") > 0, "partial").when(F.col("partial") > 0, "paused").otherwise("ok")
    return per.select(key, "n", "failed", outcome.alias("outcome"))


def capability_ladder(meeting: DataFrame, motion: DataFrame, contribution: DataFrame, official: DataFrame, body: DataFrame) -> DataFrame:
    """One row per jurisdiction and capability with its state, from one wide aggregation each."""
    b = body.select("body_id", "jurisdiction_id")
    m = meeting.join(b, "body_id").groupBy("jurisdiction_id").agg(
        F.count(F.lit(1)).alias("meetings"), F.count("agenda_url").alias("agendas"), F.count("minutes_url").alias("minutes"), F.count("packet_url").alias("packets")
    )
    n = motion.join(b, "body_id").groupBy("jurisdiction_id").agg(F.count(F.lit(1)).alias("motions"))
    k = contribution.join(official.select("official_id", "body_id"), "official_id").join(b, "body_id").groupBy("jurisdiction_id").agg(F.count(F.lit(1)).alias("gifts"))
    wide = m.join(n, "jurisdiction_id", "left").join(k, "jurisdiction_id", "left").fillna(0)
    rows = wide.select("jurisdiction_id", "meetings", F.expr("stack(5, 'agendas', agendas, 'minutes', minutes, 'packets', packets, 'motions', motions, 'contributions', gifts) AS (capability, n)"))
    state = F.when(F.col("n") == 0, "coming_soon").when(F.col("capability").isin("motions", "contributions"), "indexed").when(F.col("n") * 2 >= F.col("meetings"), "indexed").otherwise("in_progress")
    return rows.select("jurisdiction_id", "capability", F.col("n").cast("long").alias("n"), state.alias("state"))


# The rungs in order with their labels.
RUNGS = {
    "directory": "Government directory", "meetings": "Meetings indexed", "minutes": "Minutes & votes extracted", "roster": "Elected roster", "audit": "Compliance audit",
    "historical": "Historical archive", "campaign_finance": "Campaign finance", "elections": "Elections calendar", "budget": "Budget records",
}


def capability_rungs(body: DataFrame, meeting: DataFrame, motion: DataFrame, item: DataFrame, member: DataFrame, finding: DataFrame, gift: DataFrame, fund: DataFrame, cutoff: str) -> DataFrame:
    """Nine rungs per jurisdiction: key, label, state and detail.

    ``fund`` has jurisdiction_id, status (null: unfunded), unlocked and needed_usd;
    ``member`` and ``gift`` have official_id and body_id, ``finding`` body_id,
    ``motion`` and ``item`` meeting_id.  Documents with a placeholder mark
    (minutes_stub, agenda_stub) aren't there.  Each source is one aggregation.
    """
    b = body.select("body_id", "jurisdiction_id")
    has = lambda df, name: df.select("meeting_id").distinct().withColumn(name, F.lit(True))
    m = meeting.join(b, "body_id").join(has(motion, "moved"), "meeting_id", "left").join(has(item, "listed"), "meeting_id", "left").fillna(False, ["moved", "listed"])
    recent = F.col("meeting_date") >= day(cutoff)
    minutes = F.col("minutes_url").isNotNull() & ~F.coalesce("minutes_stub", F.lit(False))
    agenda = F.col("agenda_url").isNotNull() & ~F.coalesce("agenda_stub", F.lit(False))
    counts = m.groupBy("jurisdiction_id").agg(
        F.count(F.lit(1)).alias("meetings"), F.count("minutes_url").alias("urls"), F.count_if("moved").alias("with_motions"),
        F.count_if(recent & minutes).alias("recent_total"), F.count_if(recent & minutes & F.col("moved")).alias("recent_done"),
        (F.count_if(~recent & minutes) + F.count_if(~recent & agenda)).alias("old_total"),
        (F.count_if(~recent & minutes & ~F.col("moved")) + F.count_if(~recent & agenda & ~F.col("listed"))).alias("old_left"),
    )
    per = lambda df, agg, name: df.join(b, "body_id").groupBy("jurisdiction_id").agg(agg.alias(name))
    n = F.count(F.lit(1))
    wide = fund.select("jurisdiction_id", "status", "unlocked", "needed_usd").join(counts, "jurisdiction_id", "left").join(b.groupBy("jurisdiction_id").agg(n.alias("bodies")), "jurisdiction_id", "left")
    for part in (per(member, F.countDistinct("official_id"), "officials"), per(finding, n, "findings"), per(gift, n, "gifts")):
        wide = wide.join(part, "jurisdiction_id", "left")
    c = F.col
    names = ["meetings", "urls", "with_motions", "recent_total", "recent_done", "old_total", "old_left", "bodies", "officials", "findings", "gifts"]
    wide = wide.fillna(0, names)
    pending = F.when(F.coalesce("status", F.lit("unfunded")).isin("unfunded", "paused"), "needs_funding").otherwise("in_progress")
    text = lambda *xs: F.concat(*[x.cast("string") if not isinstance(x, str) else F.lit(x) for x in xs])
    money = F.when(c("needed_usd") >= 20, F.format_number("needed_usd", 0)).otherwise(F.format_number("needed_usd", 2))
    some = lambda col, unit, empty="pending": F.when(c(col) > 0, text(c(col), f" {unit}")).otherwise(empty)
    there = lambda col, otherwise: F.when(c(col) > 0, "indexed").otherwise(otherwise)
    soon = (F.lit("coming_soon"), F.lit("coming soon"))
    rungs = {
        "directory": (there("bodies", pending), some("bodies", "bodies")),
        "meetings": (there("meetings", pending), some("meetings", "meetings")),
        "minutes": (
            F.when(c("recent_total") > 0, F.when(c("recent_done") >= c("recent_total"), "indexed").otherwise(pending)).when(c("with_motions") > 0, "indexed").when(c("urls") > 0, pending).otherwise("needs_funding"),
            F.when(c("recent_total") > 0, text(c("recent_done"), " of ", c("recent_total"), " recent meetings extracted")).when(c("with_motions") > 0, text(c("with_motions"), " meetings with votes")).when(c("urls") > 0, "pending").otherwise("no minutes documents found"),
        ),
        "roster": (there("officials", pending), some("officials", "officials")),
        "audit": (F.when(c("findings") > 0, "indexed").when(c("meetings") > 0, "in_progress").otherwise(pending), some("findings", "findings tracked")),
        "historical": (
            F.when(c("old_total") == 0, "coming_soon").when(c("old_left") == 0, "indexed").when(c("unlocked"), "in_progress").otherwise("needs_funding"),
            F.when(c("old_total") == 0, "no records beyond the recent window yet").when(c("old_left") == 0, text(c("old_total"), " historical documents indexed"))
            .when(c("unlocked"), text(c("old_total") - c("old_left"), " of ", c("old_total"), " historical documents extracted"))
            .when(c("needed_usd").isNull(), text(c("old_left"), " documents · price estimate pending")).otherwise(text(c("old_left"), " documents · ~$", money, " to unlock")),
        ),
        "campaign_finance": (there("gifts", F.lit("coming_soon")), some("gifts", "contributions", "coming soon")),
        "elections": soon,
        "budget": soon,
    }
    rows = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(RUNGS[k]).alias("label"), state.alias("state"), detail.alias("detail")) for k, (state, detail) in rungs.items()])
    return wide.select("jurisdiction_id", F.explode(rows).alias("r")).select("jurisdiction_id", "r.*")


def capability_transition(now: DataFrame, prior: DataFrame, as_of: str) -> DataFrame:
    """First-indexed day kept or set, and whether a milestone is due."""
    both = now.join(prior.select("jurisdiction_id", "capability", F.col("state").alias("old"), "first_indexed"), ["jurisdiction_id", "capability"], "left")
    indexed = F.col("state") == "indexed"
    first = F.coalesce("first_indexed", F.when(indexed, day(as_of)))
    return both.select("jurisdiction_id", "capability", "state", first.alias("first_indexed"), (indexed & F.col("first_indexed").isNull()).alias("milestone"), F.col("old").isNull().alias("backfilled"))


def roster_events(term: DataFrame, as_of: str) -> DataFrame:
    """joined, left and vacant events of seats up to the day."""
    now = day(as_of)
    joined = term.filter(F.col("start_date") <= now).select("seat_id", F.lit("joined").alias("event"), F.col("start_date").alias("event_date"), "official_id")
    left = term.filter(F.col("end_date") <= now).select("seat_id", F.lit("left").alias("event"), F.col("end_date").alias("event_date"), "official_id")
    seats = term.groupBy("seat_id").agg(F.count_if(F.col("end_date").isNull() | (F.col("end_date") > now)).alias("current"), F.max(F.when(F.col("end_date") <= now, F.col("end_date"))).alias("d"))
    vacant = seats.filter("current = 0 and d is not null").select("seat_id", F.lit("vacant").alias("event"), F.col("d").alias("event_date"), F.lit(None).cast("long").alias("official_id"))
    return joined.unionByName(left).unionByName(vacant)


def contact_drift(pages: DataFrame, stored: Column, domain: Column) -> DataFrame:
    """Contact status per page text: stored address seen, another of the domain, or nothing to tell."""
    found = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})"), 1), lambda e: F.lower(e)))
    own = F.array_sort(F.filter("emails", lambda e: e.endswith("@") | e.endswith(F.concat(F.lit("@"), F.col("domain")))))
    rows = pages.withColumn("emails", found).withColumn("stored", F.lower(stored)).withColumn("domain", domain)
    clerk = F.filter(own, lambda e: e.rlike("clerk|records|info"))
    status = (
        F.when(F.array_contains("emails", F.col("stored")), "verified").when((F.size(clerk) > 0) | (F.size(own) == 1), "changed").otherwise("inconclusive")
    )
    return rows.select("page_id", F.size("emails").alias("n_emails"), status.alias("status"))


def delivery_status(events: DataFrame) -> DataFrame:
    """Contact status per user after the last delivery event."""
    last = events.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last_event"), F.count(F.lit(1)).alias("n"))
    status = F.when(F.col("last_event") == "error", "undeliverable").when(F.col("last_event") == "purchase", "verified").otherwise("unchanged")
    return last.select("user_id", "n", status.alias("status"))


def availability(probe: DataFrame) -> DataFrame:
    """Document verdict of a probe: available, placeholder or gone; inconclusive answers keep the old flag."""
    verdict = (
        F.when(F.col("http_status").isin(404, 410), "gone")
        .when((F.col("http_status") == 200) & (F.coalesce("content_length", "body_bytes") < 2000), "placeholder")
        .when(F.col("http_status") == 200, "available")
        .otherwise("inconclusive")
    )
    return probe.withColumn("verdict", verdict).withColumn("flag", F.when(verdict == "inconclusive", F.col("old_flag")).otherwise(verdict.isin("placeholder", "gone")))


def incremental_cutoff(meeting: DataFrame, as_of: str) -> DataFrame:
    """Per body the day from which to scan: all when cold, else 120 days back, further to the earliest pending, 400 at most."""
    per = meeting.groupBy("body_id").agg(
        F.count_if(F.col("minutes_url").isNotNull()).alias("known"), F.min(F.when(F.col("minutes_url").isNull(), F.col("meeting_date"))).alias("pending")
    )
    cutoff = F.greatest(F.least(F.date_sub(day(as_of), 120), F.coalesce("pending", day(as_of))), F.date_sub(day(as_of), 400))
    return per.select("body_id", F.when(F.col("known") > 0, cutoff).alias("cutoff"))


def rescan_due(meeting: DataFrame, as_of: str) -> DataFrame:
    """Meetings never scanned (``scanned_on`` null), placeholders scanned over seven days ago, others over thirty."""
    age = F.datediff(day(as_of), F.col("scanned_on"))
    due = F.col("scanned_on").isNull() | (F.col("is_placeholder") & (age > 7)) | (~F.col("is_placeholder") & (age > 30))
    return meeting.filter(due).select("meeting_id")
