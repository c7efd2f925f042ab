"""Extraction payloads to facts, repairs, corrections, terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .resolution import contained

PAYLOAD = (
    "struct<meeting:struct<date:date,body_name:string>,agenda_items:array<struct<item_number:bigint,title:string,motion_text_verbatim:string,summary_plain_english:string,"
    "vote_tally:struct<yes:int,no:int,abstain:int>,individual_votes:array<struct<name:string,vote:string>>,recusals:array<struct<name:string,reason:string>>>>>"
)


def read_payloads(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Items of stored payloads; what can't be parsed is left out and can be counted by ``replayable``."""
    keep = [c for c in raw.columns if c != payload]
    listed = raw.select(*keep, F.from_json(payload, PAYLOAD)["agenda_items"].alias("listed"))
    # the outer form, as Spark puts a test of the list before the plain one and would parse each text twice
    return listed.select(*keep, F.posexplode_outer("listed").alias("pos", "item")).filter("pos is not null")


def payload_motions(items: DataFrame) -> DataFrame:
    """Motion rows: trimmed title, description of both texts with a blank line between."""
    return items.select(
        F.col("item.item_number").alias("motion_id"), F.trim("item.title").alias("title"),
        F.concat_ws("\n\n", F.col("item.motion_text_verbatim"), F.col("item.summary_plain_english")).alias("description"),
    )


def payload_votes(items: DataFrame, officials: DataFrame) -> DataFrame:
    """One vote per official and motion: the first listed; a recusal promotes it and adds a row of its own."""
    ids = officials.select(F.lower("canonical_name").alias("low"), "official_id")
    none = lambda kind: F.lit(None).cast(kind)
    named = lambda who, at, vote, reason, out: F.struct(F.lower(who).alias("low"), at.alias("at"), vote.alias("vote_value"), reason.alias("reason"), F.lit(out).alias("recused"))
    votes = F.transform("item.individual_votes", lambda v, i: named(v["name"], i, v["vote"], none("string"), False))
    out = F.transform("item.recusals", lambda r: named(r["name"], none("int"), none("string"), r["reason"], True))
    listed = F.filter(F.array(votes, out), lambda part: part.isNotNull())
    rows = items.select(F.col("item.item_number").alias("motion_id"), F.flatten(listed).alias("listed")).select("motion_id", F.inline("listed")).join(ids, "low")
    both = rows.groupBy("motion_id", "official_id").agg(F.min_by("vote_value", "at").alias("vote_value"), F.min("reason").alias("reason"), F.bool_or("recused").alias("recused"))
    return both.select("motion_id", "official_id", F.when(F.col("recused"), "conflict_recusal").otherwise(F.col("vote_value")).alias("vote_value"), "reason")


def recomputed_tally(votes: DataFrame) -> DataFrame:
    """Tallies from one vote per official; recusals don't count."""
    one = votes.dropDuplicates(["motion_id", "official_id"])
    return one.groupBy("motion_id").agg(*[F.count_if(F.col("vote_value") == v).alias(v) for v in ("yes", "no", "abstain")])


def merge_windows(items: DataFrame, doc: str, page: str, title: str, window: str) -> DataFrame:
    """Items of overlapping windows: the first per (page, casefolded title), in page order."""
    w = Window.partitionBy(doc, page, F.lower(title)).orderBy(window)
    return items.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def merge_extractions(windows: DataFrame, doc: str, window: str, header: list[str], lists: list[str]) -> DataFrame:
    """One row per document of its windows: page numbers of the document, every item once, lists united, first header fields.

    Windows of a document have numbers of their own, page_offset and items (source_page, title).  Of items of one page
    and one title, in any case, the first window's stays; items are in page order,
    of one page as they came.  A header field is the first that isn't null; a list
    has every entry once, where it first stood.  Null lists count as empty.
    """
    rows = windows.select(doc, window, "page_offset", F.posexplode("items").alias("pos", "item"))
    rows = rows.select(doc, window, "pos", (F.col("item.source_page") + F.col("page_offset")).alias("source_page"), F.col("item.title").alias("title"))
    key = F.lower(F.trim(F.coalesce("title", F.lit(""))))
    first = rows.groupBy(doc, "source_page", key.alias("key")).agg(F.min(F.struct(F.col(window).alias("w"), F.col("pos").alias("p"), F.col("title").alias("title"))).alias("r"))
    items = first.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct("source_page", "r.w", "r.p", "r.title"))).alias("items"))
    items = items.select(doc, F.transform("items", lambda r: F.struct(r["source_page"].alias("source_page"), r["title"].alias("title"))).alias("items"))
    in_order = lambda c: F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct(F.col(window).alias("w"), F.coalesce(c, F.array().cast("array<string>")).alias("v")))), lambda r: r["v"])))
    heads = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(window))).alias(c) for c in header]
    whole = windows.groupBy(doc).agg(*heads, *[in_order(F.col(c)).alias(c) for c in lists])
    return whole.join(items, doc, "left").withColumn("items", F.coalesce("items", F.array().cast("array<struct<source_page:bigint,title:string>>")))


def handlers() -> list[tuple[str, Column]]:
    """Ordered handlers of disputed motions: (id, condition); the first that holds takes the motion."""
    return [
        ("voice_vote", (F.col("pattern_id") == "qa_tally_mismatch") & (F.col("recorded") <= 1)),
        ("vote_mismatch", F.col("pattern_id") == "qa_tally_mismatch"),
        ("clear_petitioner", F.col("pattern_id").isin("qa_petitioner_is_staff", "qa_generic_petitioner")),
        ("retitle", F.col("pattern_id") == "qa_short_motion_title"),
    ]


def dispatch(disputed: DataFrame, max_attempts: int = 3) -> DataFrame:
    """handler_id of each disputed motion with attempts left; null where none fits."""
    choice = None
    for name, condition in handlers():
        choice = F.when(condition, name) if choice is None else choice.when(condition, name)
    return disputed.filter(F.col("attempts") < max_attempts).withColumn("handler_id", choice)


#: What a repair appends to a motion's log.
LOG = "array<struct<handler:string,outcome:string,field:string,old:string>>"
BUNDLE_EXCESS = 5


def repair_motions(motion: DataFrame, findings: DataFrame) -> DataFrame:
    """The deterministic repairs of disputed motions, as column rewrites with a log.

    ``findings`` has motion_id, pattern_id, declared and actual (votes of a
    tally mismatch).  A single declared vote without recorded ones is a voice
    vote: procedural, tallies cleared.  An appointment that declares five or more
    votes beyond the recorded is a slate: left as it is and escalated.  Officials
    named as petitioner or recommender are cleared.  Findings without a rule
    leave the motion alone.
    """
    at = lambda p: F.col("pattern_id") == p
    tally, declared, actual = at("qa_tally_mismatch"), F.coalesce("declared", F.lit(0)), F.coalesce("actual", F.lit(0))
    marks = {"voice": tally & (F.col("declared") == 1) & (F.col("actual") == 0), "excess": tally & (declared >= actual + BUNDLE_EXCESS), "petitioner_out": at("qa_official_as_petitioner"), "recommender_out": at("qa_official_as_staff_recommender")}
    per = findings.groupBy("motion_id").agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(k) for k, c in marks.items()])
    rows = motion.join(per, "motion_id", "left").fillna(False, list(marks))
    slate = F.col("excess") & F.coalesce(F.col("motion_type") == "appointment", F.lit(False))
    entry = lambda handler, outcome, field, old: F.struct(F.lit(handler).alias("handler"), F.lit(outcome).alias("outcome"), F.lit(field).alias("field"), old.cast("string").alias("old"))
    log = F.array(
        F.when(F.col("voice"), entry("voice_vote_demote", "repaired", "motion_type", F.col("motion_type"))),
        F.when(slate, entry("bundled_tally_escalate", "unrepairable", "tally_yes", F.col("tally_yes"))),
        F.when(F.col("petitioner_out"), entry("official_as_petitioner_clear", "repaired", "petitioner", F.col("petitioner"))),
        F.when(F.col("recommender_out"), entry("official_as_staff_recommender_clear", "repaired", "recommender", F.col("recommender"))),
    )
    zero = lambda c: F.when(F.col("voice"), F.lit(0)).otherwise(F.col(c)).alias(c)
    return rows.select(
        "motion_id", F.when(F.col("voice"), "procedural").otherwise(F.col("motion_type")).alias("motion_type"), zero("tally_yes"), zero("tally_no"), zero("tally_abstain"),
        F.when(F.col("voice"), F.coalesce("outcome", F.lit("discussed_no_vote"))).otherwise(F.col("outcome")).alias("outcome"),
        F.when(~F.col("petitioner_out"), F.col("petitioner")).alias("petitioner"), F.when(~F.col("recommender_out"), F.col("recommender")).alias("recommender"),
        F.filter(log, lambda e: e.isNotNull()).cast(LOG).alias("repair_log"),
    )


# Titles that mark a name as staff.
STAFF_PREFIXES = [
    "major ", "capt. ", "capt ", "captain ", "lt. ", "lieutenant ", "sgt. ", "sergeant ", "chief ", "officer ", "director ", "administrator ",
    "attorney ", "clerk ", "engineer ", "manager ", "coordinator ", "secretary ", "treasurer ", "superintendent ",
]


def orphan_removal(flagged: DataFrame, officials: DataFrame, votes: DataFrame, terms: DataFrame, staff_present: DataFrame, alias: DataFrame, findings: DataFrame) -> DataFrame:
    """What becomes of officials flagged as orphans: kept where they vote or serve, or nothing shows them as staff; else deleted.

    Staff is who has a staff title before the name, or whose surname stands
    within a ``staff_present`` line (meeting_id, line).  Deleted ones come with
    how many aliases and findings go with them (``cascade`` drops these).
    """
    rows = flagged.select("official_id").distinct().join(officials.select("official_id", "canonical_name", F.lower("last_name").alias("low")), "official_id")
    held = votes.select("official_id").unionByName(terms.select("official_id")).groupBy("official_id").agg(F.count(F.lit(1)).alias("held"))
    rows = rows.join(held, "official_id", "left").fillna(0, ["held"])
    lines = staff_present.select("meeting_id", F.lower("line").alias("line"))
    seen = lines.join(contained(lines, "line", rows, "low"), "line").groupBy("low").agg(F.countDistinct("meeting_id").alias("staff_meetings"))
    rows = rows.join(seen, "low", "left").fillna(0, ["staff_meetings"])
    per = lambda df, name: df.groupBy("official_id").agg(F.count(F.lit(1)).alias(name))
    rows = rows.join(per(alias, "n_alias"), "official_id", "left").join(per(findings, "n_findings"), "official_id", "left").fillna(0, ["n_alias", "n_findings"])
    titled = F.lower("canonical_name").rlike("^(?:" + "|".join(p.replace(".", r"\.") for p in STAFF_PREFIXES) + ")")
    outcome = F.when(F.col("held") > 0, "kept_in_use").when((F.col("staff_meetings") == 0) & ~titled, "kept_unconfirmed").otherwise("deleted")
    return rows.select("official_id", outcome.alias("outcome"), "staff_meetings", *[F.when(outcome == "deleted", F.col(c)).otherwise(F.lit(0)).cast("long").alias(c) for c in ("n_alias", "n_findings")])


def cascade(table: DataFrame, removed: DataFrame) -> DataFrame:
    """The table without the rows of deleted officials."""
    return table.join(removed.filter("outcome = 'deleted'").select("official_id"), "official_id", "left_anti")


def staff_photo(tier: Column, caption: Column, name: Column) -> Column:
    """struct(score, status, verified_by) of a staff photo: the city's own source, and the caption's full name or a surname of four letters or more."""
    low, full = F.lower(F.coalesce(caption, F.lit(""))), F.lower(F.coalesce(name, F.lit("")))
    last = F.coalesce(F.element_at(F.split(F.trim(full), r"\s+"), -1), F.lit(""))
    own = F.coalesce(tier == "city_official", F.lit(False))
    by_name = (low != "") & (full != "") & low.contains(full)
    by_last = (low != "") & ~by_name & (F.length(last) >= 4) & low.contains(last)
    score = own.cast("int") + (by_name | by_last).cast("int")
    reasons = F.concat_ws("+", F.when(own, "source=city_official"), F.when(by_name, "caption_matches_canonical_name"), F.when(by_last, "caption_matches_last_name"))
    return F.struct(score.alias("score"), F.when(score >= 2, "verified").otherwise("unverified").alias("status"), F.when(score >= 2, F.concat(F.lit("auto:"), reasons)).alias("verified_by"))


def correction_intake(new: DataFrame, open_ones: DataFrame, limit: int = 200) -> DataFrame:
    """accepted, duplicate or invalid per submission; equal issues on one entity count once while open."""
    rows = new.withColumn("issue", F.substring(F.trim("issue"), 1, limit)).withColumn("hash", F.md5(F.lower("issue")))
    known = open_ones.select("entity_id", F.md5(F.lower("issue")).alias("hash")).distinct().withColumn("known", F.lit(True))
    w = Window.partitionBy("entity_id", "hash").orderBy("submission_id")
    rows = rows.join(known, ["entity_id", "hash"], "left").withColumn("rn", F.row_number().over(w))
    decision = F.when(F.length("issue") < 5, "invalid").when(F.col("known") | (F.col("rn") > 1), "duplicate").otherwise("accepted")
    return rows.select("submission_id", "entity_id", decision.alias("decision"))


def budget_precedence(candidates: DataFrame, existing: DataFrame, provider: str) -> DataFrame:
    """Per (jurisdiction, year) the local candidate of the newest meeting with figures, unless another provider has the year."""
    other = existing.filter(F.col("provider") != provider).select("jurisdiction_id", "fiscal_year")
    w = Window.partitionBy("jurisdiction_id", "fiscal_year").orderBy(F.desc("meeting_date"), F.desc("source_id"))
    rows = candidates.filter("total is not null").join(other, ["jurisdiction_id", "fiscal_year"], "left_anti")
    return rows.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def terms_from_winners(winners: DataFrame, as_of: str, years: int = 4) -> DataFrame:
    """Terms from Jan 1 after the election, capped the day before the next start on the seat."""
    start, full = F.make_date(F.col("year") + 1, F.lit(1), F.lit(1)), F.make_date(F.col("year") + years, F.lit(12), F.lit(31))
    rows = winners.select("seat_id", "official_id", start.alias("start_date"), full.alias("full_end"))
    w = Window.partitionBy("seat_id").orderBy("start_date", "official_id")
    end = F.least("full_end", F.date_sub(F.lead("start_date").over(w), 1))
    now = F.lit(as_of).cast("date")
    rows = rows.withColumn("end_date", end)
    return rows.select("seat_id", "official_id", "start_date", "end_date", ((F.col("start_date") <= now) & (F.col("end_date") >= now)).alias("is_current"))


def text_found(text: Column, needle: Column) -> Column:
    """Whole needle, its first 40 characters, or all of its first four words of four letters or more."""
    norm = lambda c: F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " "))
    hay, pin = norm(text), norm(needle)
    words = F.slice(F.filter(F.split(pin, " "), lambda w: F.length(w) >= 4), 1, 4)
    return hay.contains(pin) | hay.contains(F.substring(pin, 1, 40)) | ((F.size(words) >= 2) & F.forall(words, lambda w: hay.contains(w)))


# Zones of states with one, and the default.
ONE_ZONE = {"GA": "America/New_York", "CA": "America/Los_Angeles", "AZ": "America/Phoenix"}
ASSUMED_ZONE = {"IN": "America/Indiana/Indianapolis", "TN": "America/Chicago"}
DEFAULT_ZONE = "America/New_York"


def time_zone(explicit: Column, county_zone: Column, state: Column) -> Column:
    """struct(zone, source) by the ladder: explicit, county exception, one-zone state, assumed, default."""
    table = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])[state]
    valid = F.when(explicit.rlike(r"^[A-Z][A-Za-z]+/[A-Za-z_/]+$"), explicit)
    source = F.when(valid.isNotNull(), "explicit").when(county_zone.isNotNull(), "county").when(table(ONE_ZONE).isNotNull(), "state").when(table(ASSUMED_ZONE).isNotNull(), "assumed").otherwise("default")
    return F.struct(F.coalesce(valid, county_zone, table(ONE_ZONE), table(ASSUMED_ZONE), F.lit(DEFAULT_ZONE)).alias("zone"), source.alias("source"))


def comment_cutoff(meeting_date: Column, time: Column, zone: Column, hours: int = 12) -> Column:
    """UTC moment so many hours before the meeting's wall-clock start, 18:00 by default."""
    wall = F.to_timestamp(F.concat_ws(" ", meeting_date.cast("string"), F.coalesce(time, F.lit("18:00"))), "yyyy-MM-dd HH:mm")
    return F.to_utc_timestamp(wall, F.coalesce(zone, F.lit(DEFAULT_ZONE))) - F.expr(f"INTERVAL {hours} HOURS")


def keyword_score(text: Column, weights: dict[str, int]) -> Column:
    out = F.lit(0)
    low = F.lower(text)
    for word, weight in weights.items():
        out = out + F.when(low.contains(word), weight).otherwise(0)
    return out
