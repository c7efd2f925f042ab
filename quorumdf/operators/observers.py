"""Compliance observers over all bodies at once, and the lifecycle of what they find."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EARLIEST = "1900-01-01"
BUDGET = r"(?i)budget"
ADOPTS = r"(?i)adopt"
NOT_BUDGET = r"(?i)amendment|adjustment"


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def has_key(meta: Column, key: str) -> Column:
    """Whether a JSON object has the key, also where its value is null."""
    return F.coalesce(F.array_contains(F.json_object_keys(F.coalesce(meta, F.lit("{}"))), key), F.lit(False))


def missing_documents(meeting: DataFrame, has_doc: Column, wanting: Column, as_of: str, grace: int) -> DataFrame:
    """Per body the meetings after its last one with the document that still want it."""
    last = F.max(F.when(has_doc, F.col("meeting_date"))).over(Window.partitionBy("body_id"))
    rows = meeting.withColumn("mark", F.coalesce(last, day(EARLIEST)))
    rows = rows.filter((F.col("meeting_date") > F.col("mark")) & (F.col("meeting_date") < F.date_sub(day(as_of), grace)) & wanting)
    per = rows.groupBy("body_id").agg(F.count(F.lit(1)).alias("n"), F.min("meeting_date").alias("since_date")).filter("n >= 2")
    return per.withColumn("severity", F.when(F.col("n") >= 10, "high").otherwise("medium"))


def minutes_missing(meeting: DataFrame, as_of: str) -> DataFrame:
    source = has_key(F.col("meta"), "minutes_source")
    wanting = F.col("minutes_url").isNull() & ~source & ~has_key(F.col("meta"), "agenda_unavailable")
    return missing_documents(meeting, F.col("minutes_url").isNotNull() | source, wanting, as_of, 45)


def agenda_missing(meeting: DataFrame, as_of: str) -> DataFrame:
    wanting = F.col("agenda_url").isNull() & ~has_key(F.col("meta"), "agenda_unavailable")
    return missing_documents(meeting, F.col("agenda_url").isNotNull(), wanting, as_of, 0)


def member_roster_missing(body: DataFrame, official: DataFrame, term: DataFrame) -> DataFrame:
    """Bodies without a current member."""
    current = official.join(term.filter("end_date is null").select("official_id"), "official_id", "left_semi")
    n = current.groupBy("body_id").agg(F.count(F.lit(1)).alias("members"))
    return body.select("body_id").join(n, "body_id", "left").filter(F.coalesce("members", F.lit(0)) == 0).select("body_id")


def campaign_finance_missing(body: DataFrame, official: DataFrame, contribution: DataFrame, as_of: str) -> DataFrame:
    """Bodies with members in a jurisdiction with finance data, but none of their own in eight years."""
    since = F.add_months(day(as_of), -96)
    given = official.select("official_id", "body_id").join(contribution.filter((F.col("contributor_type") == "pac") & (F.col("received") >= since)).select("official_id"), "official_id", "left_semi")
    gate = given.join(body.select("body_id", "jurisdiction_id"), "body_id").select("jurisdiction_id")
    members = official.groupBy("body_id").agg(F.count(F.lit(1)).alias("members"))
    rows = body.join(gate, "jurisdiction_id", "left_semi").join(members, "body_id")
    return rows.join(given, "body_id", "left_anti").select("body_id", "members")


#: Bodies whose members are elected, and those that adopt a budget by law of their own.
ELECTED = ["city_council", "county_commission", "school_board"]
GENERAL_PURPOSE = ["city_council", "county_commission"]


def finance_filings_missing(body: DataFrame, official: DataFrame, term: DataFrame, filing: DataFrame, source: DataFrame, as_of: str, years: int = 8) -> DataFrame:
    """Elected bodies whose current members have no filing of so many years, where filings are ingested at all.

    A jurisdiction is judged if any of its officials has a filing of any age, or a
    source of campaign finance is registered for it, even one that found nothing.
    Bodies without a current member are another observer's.
    """
    place = official.select("official_id", "body_id").join(body.select("body_id", "jurisdiction_id"), "body_id")
    by_filing = place.join(filing.select("official_id").distinct(), "official_id", "left_semi").select("jurisdiction_id")
    by_source = source.filter("source_type = 'campaign_finance'").select("jurisdiction_id")
    current = place.join(term.filter("end_date is null").select("official_id"), "official_id", "left_semi")
    recent = filing.filter(F.col("received") >= F.add_months(day(as_of), -12 * years)).select("official_id", F.lit(1).alias("has")).distinct()
    per = current.join(recent, "official_id", "left").groupBy("body_id").agg(F.count(F.lit(1)).alias("n"), F.count("has").alias("filed")).filter("filed = 0").drop("filed")
    rows = body.filter(F.col("body_type").isin(ELECTED)).select("body_id", "jurisdiction_id").join(per, "body_id")
    return rows.join(by_filing.unionByName(by_source), "jurisdiction_id", "left_semi").select("body_id", "n")


def notice_too_short(meeting: DataFrame, as_of: str) -> DataFrame:
    """Regular meetings of the last 24 months posted less than three days ahead."""
    notice = F.datediff("meeting_date", "posted_date")
    rows = meeting.withColumn("notice", notice).filter(
        (F.col("meeting_type") == "regular") & (F.col("notice") >= 0) & (F.col("notice") < 3) & (F.col("meeting_date") >= F.add_months(day(as_of), -24))
    )
    per = rows.groupBy("body_id").agg(F.count(F.lit(1)).alias("n"), F.min("notice").alias("shortest"), F.min("meeting_date").alias("since_date")).filter("n >= 2")
    return per.withColumn("severity", F.when(F.col("shortest") < 1, "high").otherwise("medium"))


def budget_overdue(motion: DataFrame, meeting: DataFrame, as_of: str, months: int = 14) -> DataFrame:
    """Bodies that adopted budgets in two or more years but none for so many months, while they kept meeting."""
    passed = motion.filter((F.col("outcome") == "passed") & F.col("title").rlike(ADOPTS) & F.col("title").rlike(BUDGET) & ~F.col("title").rlike(NOT_BUDGET))
    per = passed.groupBy("body_id").agg(F.countDistinct(F.year("motion_date")).alias("years"), F.max("motion_date").alias("last_adopted"))
    per = per.filter((F.col("years") >= 2) & (F.col("last_adopted") < F.add_months(day(as_of), -months)))
    later = meeting.filter(F.col("minutes_url").isNotNull() & (F.col("meeting_date") < day(as_of))).select("body_id", "meeting_date")
    n = per.join(later, "body_id").filter("meeting_date > last_adopted").groupBy("body_id").agg(F.count(F.lit(1)).alias("later"))
    return per.join(n, "body_id").filter("later >= 3")


def _budgets(c) -> DataFrame:
    late = budget_overdue(c.motion, c.meeting, c.as_of).join(c.governing_body.filter(F.col("body_type").isin(GENERAL_PURPOSE)).select("body_id"), "body_id", "left_semi")
    return late.select("body_id", F.lit("medium").alias("severity"), F.col("later").alias("n"))


#: Observer registry: category -> function(civic) -> body_id, severity, n.
OBSERVERS: dict[str, Callable] = {
    "agenda_missing": lambda c: agenda_missing(c.meeting, c.as_of).select("body_id", "severity", "n"),
    "meeting_notice_too_short": lambda c: notice_too_short(c.meeting, c.as_of).select("body_id", "severity", "n"),
    "minutes_missing": lambda c: minutes_missing(c.meeting, c.as_of).select("body_id", "severity", "n"),
    "budget_process_missing": lambda c: _budgets(c),
    "campaign_finance_missing": lambda c: finance_filings_missing(c.governing_body, c.official, c.term, c.finance_filing, c.data_source, c.as_of).select("body_id", F.lit("high").alias("severity"), "n"),
    "member_roster_missing": lambda c: member_roster_missing(c.governing_body, c.official, c.term).select("body_id", F.lit("high").alias("severity"), F.lit(0).cast("long").alias("n")),
}


def observe(civic, registry: dict[str, Callable] | None = None) -> tuple[DataFrame, list[str]]:
    """All observers' rows and the categories whose plan could not be made."""
    parts, failed = [], []
    for category, f in sorted((registry or OBSERVERS).items()):
        try:
            parts.append(f(civic).withColumn("category", F.lit(category)))
        except Exception:
            failed.append(category)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, failed


def observe_each(civic, folder: str, registry: dict[str, Callable] | None = None) -> tuple[DataFrame | None, list[str]]:
    """As ``observe``, with every observer run for itself into a table under the shared folder.

    One that fails, while it is planned or while it runs, is reported and holds up
    no other; its findings are to be protected in the lifecycle.  None where all fail.
    """
    parts, failed = [], []
    for category, f in sorted((registry or OBSERVERS).items()):
        path = f"{folder.rstrip('/')}/{category}"
        try:
            rows = f(civic).withColumn("category", F.lit(category))
            rows.write.mode("overwrite").parquet(path)
            parts.append(rows.sparkSession.read.schema(rows.schema).parquet(path))
        except Exception:
            failed.append(category)
    return (reduce(DataFrame.unionByName, parts) if parts else None), failed


# What the records of a finding are called.
RECORD_TYPES = {
    "agenda_missing": "meeting agendas",
    "minutes_missing": "meeting minutes",
    "member_roster_missing": "appointed-body membership records",
    "meeting_notice_too_short": "meeting-notice policy and short-notice records",
    "campaign_finance_missing": "campaign finance disclosures",
    "budget_overdue": "adopted budget and budget-adoption records",
    "budget_process_missing": "adopted budget and budget-adoption records",
}
UNCOUNTED = ["budget_overdue", "budget_process_missing"]


def item_sentence(category: Column, count: Column, since: Column) -> Column:
    """One line that names what is missing: "Meeting minutes — 3 meetings, March 12, 2026 to present."

    One or none counted, or a category that isn't counted, names the day alone;
    without a day the kind of record stands alone.
    """
    table = F.create_map(*[F.lit(x) for kv in RECORD_TYPES.items() for x in kv])
    kind = F.coalesce(F.try_element_at(table, category), F.replace(category, F.lit("_"), F.lit(" ")))
    head = F.concat(F.upper(F.substring(kind, 1, 1)), F.substring(kind, F.lit(2), F.length(kind)))
    day_text = F.date_format(since, "MMMM d, yyyy")
    many = (F.coalesce(count, F.lit(0)) > 1) & ~category.isin(UNCOUNTED)
    tail = F.when(since.isNull(), ".").when(many, F.concat(F.lit(" — "), count.cast("string"), F.lit(" meetings, "), day_text, F.lit(" to present."))).otherwise(F.concat(F.lit(" — none on record since "), day_text, F.lit(".")))
    return F.concat(head, tail)


def lifecycle(observed: DataFrame, prior: DataFrame, keys: list[str], *, live: list[str], closed: str, frozen: list[str] = (), protect: Column | None = None, now: Column | None = None) -> DataFrame:
    """Fold observed rows into the prior state: the new status and the action per key.

    Observed and unknown is inserted as open; observed and live is updated;
    observed and closed is reopened; observed and frozen stays as it is, its
    fields refreshed.  What is live and no longer observed gets ``closed``,
    unless ``protect`` holds for it.  Keys are compared null-safely.  With ``now``,
    the prior's opened_at and closed_at are carried on: what is inserted or reopened
    opens now and is closed no more, what is closed closes now.
    """
    o = observed.select(*[F.col(k).alias(f"o_{k}") for k in keys], F.lit(True).alias("seen"))
    p = prior.select(*[F.col(k).alias(f"p_{k}") for k in keys], F.col("status").alias("prior_status"), *(["opened_at", "closed_at"] if now is not None else []))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"o_{k}").eqNullSafe(F.col(f"p_{k}"))
    both = o.join(p, on, "full_outer")
    is_live = F.col("prior_status").isin(list(live))
    is_frozen = F.col("prior_status").isin(list(frozen)) if frozen else F.lit(False)
    keep = protect if protect is not None else F.lit(False)
    action = (
        F.when(F.col("seen") & F.col("prior_status").isNull(), "inserted")
        .when(F.col("seen") & (is_live | is_frozen), "updated")
        .when(F.col("seen"), "reopened")
        .when(is_live & ~keep, "closed")
        .otherwise("unchanged")
    )
    status = F.when(action.isin("inserted", "reopened"), "open").when(action == "closed", closed).otherwise(F.col("prior_status"))
    names = [F.coalesce(f"o_{k}", f"p_{k}").alias(k) for k in keys]
    opens = action.isin("inserted", "reopened")
    times = [] if now is None else [F.when(opens, now).otherwise(F.col("opened_at")).alias("opened_at"), F.when(action == "closed", now).when(~opens, F.col("closed_at")).alias("closed_at")]
    return both.select(*names, "prior_status", status.alias("status"), action.alias("action"), *times)


#: Requests that still stand.
LIVE_REQUESTS = ["draft", "ready_for_review", "sent", "responded"]


def reconcile_requests(findings: DataFrame, observed: DataFrame, requests: DataFrame, tone: int = 1) -> DataFrame:
    """One request per jurisdiction with open findings: what to do and with which findings.

    ``findings`` has finding_id, jurisdiction_id, body_id, category and status;
    those no longer observed (body_id, category) are dropped first.  Of the live
    requests (request_id, status, tone, created_at, finding_ids) that share a
    finding the largest counts, then the newest, then the lower id: "noop" where it
    has just these findings, "update" where it has others, "create" without one.
    Its tone stays.  Ids are in order of body and finding.
    """
    still = observed.select("body_id", "category").distinct()
    kept = findings.filter("status = 'open'").join(still, ["body_id", "category"], "left_semi").select("jurisdiction_id", "body_id", "finding_id").distinct()
    wanted = kept.groupBy("jurisdiction_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("body_id", "finding_id"))), lambda r: r["finding_id"]).alias("finding_ids"))
    live = requests.filter(F.col("status").isin(LIVE_REQUESTS))
    shared = live.select("request_id", F.explode(F.array_distinct("finding_ids")).alias("finding_id")).join(kept, "finding_id").select("jurisdiction_id", "request_id").distinct()
    w = Window.partitionBy("jurisdiction_id").orderBy(F.desc("size"), F.desc("created_at"), "request_id")
    had = live.select("request_id", F.col("tone").alias("old_tone"), "created_at", F.size("finding_ids").alias("size"), F.array_sort(F.array_distinct("finding_ids")).alias("old_ids"))
    best = shared.join(had, "request_id").withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn", "size", "created_at")
    rows = wanted.join(best, "jurisdiction_id", "left")
    action = F.when(F.col("request_id").isNull(), "create").when(F.col("old_ids") == F.array_sort("finding_ids"), "noop").otherwise("update")
    return rows.select("jurisdiction_id", "request_id", action.alias("action"), F.coalesce("old_tone", F.lit(tone)).alias("tone"), "finding_ids")
