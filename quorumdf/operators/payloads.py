"""Stored extraction payloads: read as VARIANT, what is unusable as rows of its own, meetings updated, provenance replayed.

A payload is JSON text of an object, or JSON text of a string that holds such
text; both stand in stored tables.  It is parsed once, as VARIANT, so that one
bad field makes that field null and not the whole payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The words that a payload's fields may hold.
CONFIDENCE = ["high", "medium", "low"]
MOTION_TYPES = ["ordinance", "resolution", "zoning_change", "budget_amendment", "appointment", "contract_approval", "procedural", "other"]
OUTCOMES = ["passed", "failed", "tabled", "withdrawn", "no_action"]
VOTE_VALUES = ["yes", "no", "abstain", "absent", "conflict_recusal"]

MEETING = "struct<date:string,body_name:string,meeting_type:string,meeting_time:string,location:string,called_to_order_at:string,adjourned_at:string,extraction_confidence:string>"
ATTENDANCE = "struct<present:array<string>,absent:array<string>,staff_present:array<string>,others_present:array<string>>"
ITEMS = (
    "array<struct<item_number:string,title:string,motion_text_verbatim:string,summary_plain_english:string,motion_type:string,outcome:string,"
    "vote_tally:struct<yes:int,no:int,abstain:int,absent:int>,individual_votes:array<struct<name:string,vote:string>>,"
    "recusals:array<struct<name:string,reason:string>>,source_page:int>>"
)
FIELDS = {"meeting": MEETING, "attendance": ATTENDANCE, "agenda_items": ITEMS, "document_summary": "string", "extraction_notes": "string"}


def opened(payload: Column) -> Column:
    """The payload as VARIANT; a string that holds JSON text is opened once more; null where it isn't JSON."""
    whole = F.try_parse_json(payload)
    return F.when(F.schema_of_variant(whole) == "STRING", F.try_parse_json(F.try_variant_get(whole, "$", "string"))).otherwise(whole)


def _incomplete(item: Column) -> Column:
    filled = ["title", "summary_plain_english", "vote_tally", "individual_votes", "source_page"]
    missing = item.isNull()
    for name in filled:
        missing = missing | item[name].isNull()
    unknown = lambda c, words: c.isNull() | ~c.isin(words)
    votes = F.exists(item["individual_votes"], lambda v: v["name"].isNull() | unknown(v["vote"], VOTE_VALUES))
    return missing | unknown(item["motion_type"], MOTION_TYPES) | unknown(item["outcome"], OUTCOMES) | F.coalesce(votes, F.lit(True))


def read(stored: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """Each stored row with its payload's fields in ``p`` and, where it can't be replayed, the first ``reason``.

    Reasons, in order: no payload, not JSON, not an object, no confidence, no
    attendance, no items, incomplete item.  An empty list of items or of present
    members is a list.  Numbers in text fields are read as text.  Columns named
    ``p`` or ``reason`` of the table give way to these.
    """
    keep = [c for c in stored.columns if c not in (payload, "p", "reason")]
    rows = stored.select(*keep, F.col(payload).isNull().alias("_none"), opened(F.col(payload)).alias("_v"))
    rows = rows.select(*keep, "_none", "_v", F.struct(*[F.try_variant_get("_v", f"$.{name}", kind).alias(name) for name, kind in FIELDS.items()]).alias("p"))
    confidence = F.col("p.meeting.extraction_confidence")
    reason = (
        F.when(F.col("_none"), "no payload").when(F.col("_v").isNull(), "not JSON").when(~F.schema_of_variant("_v").startswith("OBJECT"), "not an object")
        .when(confidence.isNull() | ~confidence.isin(CONFIDENCE), "no confidence").when(F.col("p.attendance.present").isNull(), "no attendance")
        .when(F.col("p.agenda_items").isNull(), "no items").when(F.exists("p.agenda_items", _incomplete), "incomplete item")
    )
    return rows.select(*keep, "p", reason.alias("reason"))


def items(read_rows: DataFrame, *keys: str) -> DataFrame:
    """One row per item of the payloads that can be replayed, with its place in the list."""
    return read_rows.filter("reason is null").select(*keys, F.posexplode("p.agenda_items").alias("pos", "item"))


def rejects(read_rows: DataFrame, *keys: str) -> DataFrame:
    """What can't be replayed, and why."""
    return read_rows.filter("reason is not null").select(*keys, "reason")


def latest(stored: DataFrame, url: str, at: str, tie: str, payload: str = "raw_payload") -> DataFrame:
    """Per url the payload stored last; undated ones come last, of equal moments the greatest ``tie`` wins.

    Rows without a payload don't count.  ``max_by`` combines before the shuffle,
    so one text a url and task moves.
    """
    rows = stored.filter(F.col(payload).isNotNull() & F.col(url).isNotNull())
    order = F.struct(F.col(at).isNotNull(), F.col(at), F.col(tie))
    return rows.groupBy(url).agg(F.max_by(F.struct(tie, payload), order).alias("_last")).select(url, f"_last.{tie}", f"_last.{payload}")


def attendance_notes(p: Column) -> Column:
    """Present and absent members, the extraction's confidence and its notes, each part only where there is one."""
    named = lambda label, names: F.when(F.size(names) > 0, F.concat(F.lit(f"{label}: "), F.array_join(names, ", ")))
    attendance, notes = p["attendance"], F.nullif(p["extraction_notes"], F.lit(""))
    return F.concat_ws(
        " | ", named("present", attendance["present"]), named("absent", attendance["absent"]),
        F.concat(F.lit("extraction_confidence="), p["meeting"]["extraction_confidence"]), F.concat(F.lit("notes: "), notes),
    )


def updated_meetings(meetings: DataFrame, read_rows: DataFrame, url: str) -> DataFrame:
    """Meetings with what their payload says; those without one that can be replayed stay as they are.

    The notes, the gavel times and the lists of staff and others are replaced (an
    empty list becomes null); time, place and summary only where the payload has
    one, the time being the stated one or else the call to order.  ``read_rows``
    has one row per url, as from ``latest``.
    """
    own = ["status", "attendance_notes", "called_to_order_at", "adjourned_at", "meeting_time", "location", "staff_present", "others_present", "minutes_ai_summary"]
    said = read_rows.filter("reason is null").select(F.col(url).alias("_url"), F.col("p").alias("_p"))
    rows = meetings.join(said, meetings["minutes_url"] == said["_url"], "left")
    p, hit = F.col("_p"), F.col("_url").isNotNull()
    text = lambda c: F.nullif(c, F.lit(""))
    some = lambda c: F.when(F.size(c) > 0, c)
    new = {
        "status": F.lit("minutes_published"), "attendance_notes": attendance_notes(p), "called_to_order_at": p["meeting"]["called_to_order_at"], "adjourned_at": p["meeting"]["adjourned_at"],
        "meeting_time": F.coalesce(text(p["meeting"]["meeting_time"]), text(p["meeting"]["called_to_order_at"]), F.col("meeting_time")),
        "location": F.coalesce(text(p["meeting"]["location"]), F.col("location")), "staff_present": some(p["attendance"]["staff_present"]), "others_present": some(p["attendance"]["others_present"]),
        "minutes_ai_summary": F.coalesce(text(p["document_summary"]), F.col("minutes_ai_summary")),
    }
    keep = [c for c in meetings.columns if c not in own]
    return rows.select(*keep, *[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) for c in own])


def provenance_candidates(meetings: DataFrame, facts: DataFrame, stored: DataFrame, column: str, url: str = "minutes_url") -> DataFrame:
    """Meetings with facts that lack ``column`` and a stored payload, and what a replay of the latest would do.

    ``facts`` are motions (column source_page, url minutes_url) or agenda items
    (extraction_confidence, agenda_url).  ``reason`` is null where the payload can
    be replayed; a meeting leaves the set once its facts have the column.
    """
    gaps = facts.filter(F.col(column).isNull()).groupBy("meeting_id").agg(F.count(F.lit(1)).alias("n_gaps"))
    open_ones = meetings.filter(F.col(url).isNotNull()).select("meeting_id", F.col(url).alias("source_url")).join(gaps, "meeting_id")
    wanted = stored.join(open_ones.select("source_url").distinct(), "source_url", "left_semi")
    last = read(latest(wanted, "source_url", "ingested_at", "source_id"))
    replayed = last.select("source_url", "source_id", "reason", F.when(F.col("reason").isNull(), F.size("p.agenda_items")).otherwise(0).alias("n_items"))
    return open_ones.join(replayed, "source_url").select("meeting_id", "source_id", "n_gaps", "n_items", "reason")
