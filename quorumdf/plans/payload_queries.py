"""Queries of stored payloads and of minutes inside later packets."""

from pyspark.sql import functions as F

from quorumdf.operators import embedded as M
from quorumdf.operators import payloads as P

from .registry import query

#: The payloads read by JSON functions: j is the object, reason why it can't be replayed.
_READ = """s AS (SELECT *, CASE WHEN json_type(TRY_CAST(raw_payload AS JSON)) = 'VARCHAR' THEN TRY_CAST(raw_payload AS JSON) ->> '$' ELSE raw_payload END AS t FROM {0}),
o AS (SELECT * EXCLUDE (t), TRY_CAST(t AS JSON) AS j FROM s),
rd AS (SELECT *, CASE WHEN raw_payload IS NULL THEN 'no payload' WHEN j IS NULL THEN 'not JSON' WHEN json_type(j) <> 'OBJECT' THEN 'not an object'
 WHEN coalesce(j ->> '$.meeting.extraction_confidence', '') NOT IN ('high', 'medium', 'low') THEN 'no confidence' WHEN json_type(j, '$.attendance.present') IS DISTINCT FROM 'ARRAY' THEN 'no attendance' WHEN json_type(j, '$.agenda_items') IS DISTINCT FROM 'ARRAY' THEN 'no items'
 WHEN len(j -> '$.agenda_items[*].source_page') < json_array_length(j, '$.agenda_items') OR list_contains(j ->> '$.agenda_items[*].outcome', 'unknown') OR list_contains(j ->> '$.agenda_items[*].individual_votes[*].vote', 'aye') THEN 'incomplete item' END AS reason FROM o)"""
_ALL = _READ.format("stored_payload")
_LAST = """lp AS (SELECT * FROM stored_payload WHERE raw_payload IS NOT NULL AND source_url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY ingested_at DESC NULLS LAST, source_id DESC) = 1),
""" + _READ.format("lp")


@query("s04_payload_reasons", f"WITH {_ALL} SELECT source_id, reason, CASE WHEN reason IS NULL THEN json_array_length(j, '$.agenda_items')::BIGINT END AS n_items, CASE WHEN reason IS NULL THEN json_array_length(j, '$.attendance.present')::BIGINT END AS n_present FROM rd")
def s04(c):
    good = F.col("reason").isNull()
    size = lambda path: F.when(good, F.size(path).cast("long"))
    return P.read(c.stored_payload).select("source_id", "reason", size("p.agenda_items").alias("n_items"), size("p.attendance.present").alias("n_present"))


@query("s04b_payload_items", f"""WITH {_ALL} SELECT source_id, item ->> '$.item_number' AS item_number, trim(item ->> '$.title') AS title, (item ->> '$.source_page')::INT AS source_page, (item ->> '$.vote_tally.yes')::INT AS yes, json_array_length(item, '$.individual_votes')::BIGINT AS n_votes
FROM (SELECT source_id, unnest(j -> '$.agenda_items[*]') AS item FROM rd WHERE reason IS NULL) x""")
def s04b(c):
    rows = P.items(P.read(c.stored_payload), "source_id")
    return rows.select("source_id", "item.item_number", F.trim("item.title").alias("title"), "item.source_page", F.col("item.vote_tally.yes").alias("yes"), F.size("item.individual_votes").cast("long").alias("n_votes"))


@query("r03b_meeting_update", f"""WITH {_LAST}, u AS (SELECT source_url, j, nullif(j ->> '$.meeting.called_to_order_at', '') AS called FROM rd WHERE reason IS NULL)
SELECT meeting_id, CASE WHEN j IS NULL THEN status ELSE 'minutes_published' END AS status,
 CASE WHEN j IS NULL THEN attendance_notes ELSE concat_ws(' | ', 'present: ' || nullif(array_to_string(j ->> '$.attendance.present[*]', ', '), ''), 'absent: ' || nullif(array_to_string(j ->> '$.attendance.absent[*]', ', '), ''), 'extraction_confidence=' || (j ->> '$.meeting.extraction_confidence'), 'notes: ' || nullif(j ->> '$.extraction_notes', '')) END AS attendance_notes,
 CASE WHEN j IS NULL THEN called_to_order_at ELSE called END AS called_to_order_at, CASE WHEN j IS NULL THEN adjourned_at END AS adjourned_at, coalesce(nullif(j ->> '$.meeting.meeting_time', ''), called, meeting_time) AS meeting_time,
 coalesce(j ->> '$.meeting.location', location) AS location, j ->> '$.attendance.staff_present[0]' AS first_staff, coalesce(j ->> '$.document_summary', minutes_ai_summary) AS minutes_ai_summary
FROM meeting_detail LEFT JOIN u ON source_url = minutes_url""")
def r03b(c):
    none = F.lit(None).cast("array<string>")
    meetings = c.meeting_detail.withColumn("staff_present", none).withColumn("others_present", none)
    last = P.read(P.latest(c.stored_payload, "source_url", "ingested_at", "source_id"))
    rows = P.updated_meetings(meetings, last, "source_url")
    return rows.select("meeting_id", "status", "attendance_notes", "called_to_order_at", "adjourned_at", "meeting_time", "location", F.get("staff_present", F.lit(0)).alias("first_staff"), "minutes_ai_summary")


@query("r05b_provenance_replay", f"""WITH {_LAST}, g AS (SELECT meeting_id, count(*) AS n_gaps FROM payload_item WHERE NOT has_page GROUP BY 1)
SELECT m.meeting_id, source_id, n_gaps, CASE WHEN reason IS NULL THEN json_array_length(j, '$.agenda_items')::INT ELSE 0 END AS n_items, reason FROM meeting m JOIN g ON g.meeting_id = m.meeting_id JOIN rd ON source_url = minutes_url""")
def r05b(c):
    motions = c.payload_item.select("meeting_id", F.when(F.col("has_page"), F.lit(1)).alias("source_page"))
    return P.provenance_candidates(c.meeting, motions, c.stored_payload, "source_page")


@query("r13b_embedded_minutes", r"""WITH cand AS (SELECT * FROM packet_meeting WHERE minutes_url IS NULL AND (meta IS NULL OR (meta NOT LIKE '{"minutes_source"%' AND meta NOT LIKE '{"agenda_unavailable"%')) AND meeting_id NOT IN (SELECT meeting_id FROM packet_motion)),
n AS (SELECT c.meeting_id, c.meeting_date, x.agenda_url, row_number() OVER (PARTITION BY c.meeting_id ORDER BY x.meeting_date, x.meeting_id) AS k FROM cand c JOIN packet_meeting x ON x.body_id = c.body_id AND x.meeting_date > c.meeting_date AND x.agenda_url IS NOT NULL QUALIFY k <= 3),
p AS (SELECT n.*, pages, unnest(pages) AS page, generate_subscripts(pages, 1) - 1 AS pos FROM n JOIN packet_text ON source_url = agenda_url),
h AS (SELECT * FROM p WHERE regexp_matches(page, 'minutes\s+of\s+(the\s+)?' || strftime(meeting_date, '%B') || '\s+0?' || day(meeting_date) || ',\s+' || year(meeting_date), 'i') QUALIFY row_number() OVER (PARTITION BY meeting_id ORDER BY k, pos) = 1)
SELECT meeting_id, agenda_url AS packet_url, pos::INT AS first_page, md5(array_to_string(pages[pos + 1 : pos + 8], chr(10))) AS slice_md5 FROM h""")
def r13b(c):
    found = M.embedded_minutes(c.packet_meeting, c.packet_motion, c.packet_text)
    return found.select("meeting_id", "packet_url", "first_page", F.md5("slice").alias("slice_md5"))
