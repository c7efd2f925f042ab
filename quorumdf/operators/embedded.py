"""Minutes that stand inside a later meeting's packet.

A packet's pages are read once: every "minutes of <date>" heading becomes a row
(packet, date, first page), and meetings find theirs by an equi-join on packet
and date.  No pattern is run per meeting, and page texts move only for hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOOKAHEAD = 3
SLICE_PAGES = 8

# The names of months.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]

#: White space of all scripts, as packets carry no-break spaces from their layout.
_S = r"[\s\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"
HEADING = rf"(?iu)minutes{_S}of{_S}(?:the{_S})?({'|'.join(MONTHS)}){_S}(0?[1-9]|[12][0-9]|3[01]),{_S}([0-9]{{4}})"


def headings(packets: DataFrame) -> DataFrame:
    """source_url, year, month, day and the first page (from 0) of every dated minutes heading.

    ``packets`` has source_url, once each, and pages.  A null page has no heading;
    a date that no calendar has meets no meeting.
    """
    pages = packets.select("source_url", F.posexplode("pages").alias("page", "text"))
    found = pages.select("source_url", "page", F.explode(F.regexp_extract_all("text", F.lit(HEADING), F.lit(0))).alias("h"))
    part = lambda i: F.regexp_extract("h", HEADING, i)
    number = F.array_position(F.array(*[F.lit(m.lower()) for m in MONTHS]), F.lower(part(1))).cast("int")
    dated = found.select("source_url", "page", part(3).cast("int").alias("year"), number.alias("month"), part(2).cast("int").alias("day"))
    return dated.groupBy("source_url", "year", "month", "day").agg(F.min("page").alias("first_page"))


def next_packets(meetings: DataFrame, candidates: DataFrame, ahead: int = LOOKAHEAD) -> DataFrame:
    """Each candidate with its body's next packets after its day: meeting_id, meeting_date, k (from 1) and source_url.

    The packets of a body are numbered by date (of one day by id); a candidate
    counts those up to its day and asks for the following numbers, an equi-join.
    """
    body = Window.partitionBy("body_id")
    has = F.col("agenda_url").isNotNull()
    days = meetings.select("body_id", "meeting_id", "meeting_date", "agenda_url", F.count_if(has).over(body.orderBy("meeting_date").rangeBetween(Window.unboundedPreceding, 0)).alias("seen"))
    packets = meetings.filter(has).select("body_id", F.row_number().over(body.orderBy("meeting_date", "meeting_id")).cast("long").alias("number"), F.col("agenda_url").alias("source_url"))
    asked = days.join(candidates.select("meeting_id"), "meeting_id", "left_semi").select("body_id", "meeting_id", "meeting_date", "seen", F.explode(F.sequence(F.lit(1), F.lit(ahead))).alias("k"))
    return asked.withColumn("number", F.col("seen") + F.col("k")).join(packets, ["body_id", "number"]).select("meeting_id", "meeting_date", "k", "source_url")


def without_minutes(meetings: DataFrame, motions: DataFrame) -> DataFrame:
    """Meetings that nothing tells about: no minutes, no motions, not marked as embedded or unavailable."""
    keys = F.coalesce(F.map_keys(F.try_variant_get(F.try_parse_json("meta"), "$", "map<string,variant>")), F.array().cast("array<string>"))
    flagged = F.arrays_overlap(keys, F.array(F.lit("minutes_source"), F.lit("agenda_unavailable")))
    return meetings.filter(F.col("minutes_url").isNull() & ~flagged).join(motions.select("meeting_id"), "meeting_id", "left_anti")


def embedded_minutes(meetings: DataFrame, motions: DataFrame, packets: DataFrame, ahead: int = LOOKAHEAD, pages: int = SLICE_PAGES) -> DataFrame:
    """Per meeting whose minutes a later packet holds: packet_url, first_page and the slice of at most ``pages`` pages.

    The first of the next ``ahead`` packets with the meeting's date in a heading
    gives the slice, from its first such page.  Packets without stored text are
    passed over but count among the next ones, as their meetings do.
    """
    asked = next_packets(meetings, without_minutes(meetings, motions), ahead)
    day = F.col("meeting_date")
    asked = asked.select("meeting_id", "k", "source_url", F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"))
    hits = asked.join(headings(packets), ["source_url", "year", "month", "day"]).groupBy("meeting_id").agg(F.min(F.struct("k", "first_page", "source_url")).alias("hit"))
    hits = hits.select("meeting_id", "hit.source_url", "hit.first_page")
    text = F.array_join(F.slice("pages", F.col("first_page") + 1, F.lit(pages)), "\n")
    return hits.join(packets, "source_url").select("meeting_id", F.col("source_url").alias("packet_url"), "first_page", text.alias("slice"))
