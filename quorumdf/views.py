"""Civic tables derived from the driver's star schema.

The derivation is one list of named SQL selects that Spark and an ANSI engine
read alike, so a query and its oracle start from identical rows.  ``Civic`` gives
each of them as a DataFrame; ``with_views`` puts the ones a query needs in front
of an oracle's SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from quorumdf.dealing import dealt
from quorumdf.operators.snapshots import settled

#: The explicit clock of every query over the civic tables and over the events.
AS_OF = "2001-09-01"
AS_OF_EVENTS = "2024-01-31"

TABLES = "region nation customer supplier part orders lineitem events documents pages conversations".split()

VIEWS = {
    "jurisdiction": """SELECT r_regionkey AS jurisdiction_id, r_name AS display_name,
        CASE r_regionkey % 5 WHEN 0 THEN 'GA' WHEN 1 THEN 'IN' WHEN 2 THEN 'AZ' WHEN 3 THEN 'TN' ELSE 'CA' END AS state_abbr,
        1000 + r_regionkey AS fips FROM region""",
    "governing_body": """SELECT n_nationkey AS body_id, n_regionkey AS jurisdiction_id, n_name AS body_name,
        CASE n_nationkey % 4 WHEN 0 THEN 'city_council' WHEN 1 THEN 'county_commission' WHEN 2 THEN 'school_board' ELSE 'planning_commission' END AS body_type
        FROM nation""",
    "official": """SELECT s_suppkey AS official_id, CASE WHEN s_suppkey % 22 = 0 THEN 'City Clerk ' || s_name ELSE s_name END AS canonical_name, s_suppkey % 5 <> 0 AS is_elected, s_nationkey AS body_id FROM supplier""",
    "docket": """SELECT o_orderkey AS motion_id, o_custkey, c_name, c_nationkey AS body_id, CAST(o_orderdate AS DATE) AS motion_date,
        year(o_orderdate) AS y, month(o_orderdate) AS m, o_totalprice, o_orderpriority, o_orderstatus
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "meeting_month": """SELECT body_id, body_id * 10000 + (y - 1990) * 12 + m AS meeting_id, min(motion_date) AS meeting_date FROM docket GROUP BY body_id, y, m""",
    "meeting": """SELECT meeting_id, body_id, meeting_date,
        CASE WHEN meeting_id % 9 = 0 THEN 'workshop' ELSE 'regular' END AS meeting_type,
        CASE WHEN meeting_id % 5 = 0 OR (body_id % 4 = 0 AND meeting_date > DATE '2000-06-01') THEN NULL ELSE 'https://docs.example.org/minutes/' || meeting_id END AS minutes_url,
        CASE WHEN meeting_id % 7 = 0 OR (body_id % 4 = 1 AND meeting_date > DATE '2000-06-01') THEN NULL ELSE 'https://docs.example.org/agenda/' || meeting_id END AS agenda_url,
        CASE WHEN meeting_id % 10 = 3 THEN 'https://docs.example.org/packet/' || meeting_id END AS packet_url,
        CASE WHEN meeting_id % 13 = 0 THEN NULL ELSE meeting_date - CAST(meeting_id % 6 AS INT) END AS posted_date,
        CASE WHEN meeting_id % 25 = 0 THEN '{"minutes_source":"packet"}' WHEN meeting_id % 35 = 0 THEN '{"agenda_unavailable":null}' ELSE '{}' END AS meta
        FROM meeting_month WHERE NOT (body_id % 6 = 0 AND meeting_date > DATE '2000-12-31')""",
    "vote": """SELECT v.motion_id, v.official_id, d.body_id, d.motion_date,
        CASE WHEN v.official_id % 3 = 0 AND (v.motion_id + v.official_id) % 97 = 0 THEN 'conflict_recusal'
             WHEN (v.motion_id * 7 + v.official_id) % CASE d.body_id % 4 WHEN 0 THEN 6 WHEN 1 THEN 24 WHEN 2 THEN 48 ELSE 120 END = 0 THEN 'no'
             WHEN (v.motion_id + 3 * v.official_id) % 211 = 0 THEN 'abstain' ELSE 'yes' END AS vote_value
        FROM (SELECT DISTINCT l_orderkey AS motion_id, l_suppkey AS official_id FROM lineitem) v JOIN docket d ON v.motion_id = d.motion_id""",
    "tally": """SELECT motion_id, count(*) AS n_votes,
        sum(CASE WHEN vote_value = 'yes' THEN 1 ELSE 0 END) AS n_yes, sum(CASE WHEN vote_value = 'no' THEN 1 ELSE 0 END) AS n_no,
        sum(CASE WHEN vote_value = 'abstain' THEN 1 ELSE 0 END) AS n_abstain, sum(CASE WHEN vote_value = 'conflict_recusal' THEN 1 ELSE 0 END) AS n_recused
        FROM vote GROUP BY motion_id""",
    "motion": """SELECT d.motion_id, d.body_id, d.body_id * 10000 + (d.y - 1990) * 12 + d.m AS meeting_id, d.motion_date,
        CASE d.o_orderpriority WHEN '1-URGENT' THEN 'zoning_change' WHEN '2-HIGH' THEN 'ordinance' WHEN '3-MEDIUM' THEN 'resolution' WHEN '4-NOT SPECIFIED' THEN 'appointment' ELSE 'procedural' END AS motion_type,
        CASE WHEN d.motion_id % 17 = 0 THEN 'Ok' WHEN d.motion_id % 23 = 0 AND NOT (d.body_id % 5 = 2 AND d.motion_date > DATE '2000-03-01') THEN 'Adopt annual budget for the fiscal year'
             WHEN d.motion_id % 7 = 0 THEN 'Parcel No. G' || (10 + d.o_custkey % 40) || '-' || (d.y - 1000) || 'A' WHEN d.motion_id % 5 = 0 THEN 'Rezoning of ' || (100 + d.o_custkey % 40) || ' Old  Mill Road' ELSE 'Parcel ID ' || (100 + d.o_custkey % 40) || ' ' || (d.y - 1000) END AS title,
        CASE WHEN d.motion_id % 19 = 0 THEN 'staff' WHEN d.motion_id % 29 = 0 THEN 'City Manager ' || d.c_name WHEN d.motion_id % 31 = 0 THEN NULL ELSE d.c_name END AS petitioner,
        d.o_totalprice AS dollar_amount,
        CASE WHEN d.motion_id % 37 = 0 THEN NULL ELSE t.n_yes + CASE WHEN d.motion_id % 11 = 0 THEN 1 ELSE 0 END END AS tally_yes,
        t.n_no AS tally_no, t.n_abstain AS tally_abstain,
        CASE WHEN d.o_orderstatus = 'P' THEN 'failed' ELSE 'passed' END AS outcome
        FROM docket d LEFT JOIN tally t ON d.motion_id = t.motion_id""",
    "term_year": """SELECT l_suppkey AS official_id, s_nationkey AS body_id, year(l_shipdate) AS y, min(CAST(l_shipdate AS DATE)) AS first_day, max(CAST(l_shipdate AS DATE)) AS last_day
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_suppkey, s_nationkey, year(l_shipdate)""",
    "term": """SELECT official_id * 100 + (y - 1990) AS term_id, official_id, official_id % 7 AS seat_id, first_day AS start_date,
        CASE WHEN y = 2001 AND body_id % 8 <> 7 THEN NULL ELSE last_day END AS end_date FROM term_year WHERE official_id % 11 <> 0""",
    "contribution": """SELECT l_orderkey * 10 + l_linenumber AS contribution_id, l_suppkey AS official_id, c_name AS contributor_name,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 'corporate' WHEN c_mktsegment = 'MACHINERY' AND s_nationkey % 6 <> 5 THEN 'pac' ELSE 'individual' END AS contributor_type,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_cents, year(l_shipdate) AS cycle, CAST(l_shipdate AS DATE) AS received
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""",
    "finance_filing": """SELECT official_id, received FROM contribution WHERE contributor_type = 'pac'""",
    "data_source": """SELECT jurisdiction_id, CASE WHEN jurisdiction_id % 2 = 0 THEN 'minutes' ELSE 'campaign_finance' END AS source_type FROM jurisdiction""",
    "person": """SELECT s_suppkey AS official_id, s_nationkey AS body_id, n_regionkey AS jurisdiction_id, s_suppkey % 5 <> 0 AS is_elected,
        CASE s_suppkey % 12 WHEN 0 THEN 'Robert' WHEN 1 THEN 'Bill' WHEN 2 THEN 'Karen' WHEN 3 THEN 'Amy' WHEN 4 THEN 'James' WHEN 5 THEN 'Steven' WHEN 6 THEN 'Kate' WHEN 7 THEN 'Thomas' WHEN 8 THEN 'Ceretta' WHEN 9 THEN 'Michael' WHEN 10 THEN 'Doug' ELSE 'Joe' END AS first_name,
        CASE s_suppkey % 13 WHEN 0 THEN 'Baker' WHEN 1 THEN 'Carter' WHEN 2 THEN 'Dunn' WHEN 3 THEN 'Ellis' WHEN 4 THEN 'Foster' WHEN 5 THEN 'Grant' WHEN 6 THEN 'Hayes' WHEN 7 THEN 'Irwin' WHEN 8 THEN 'Keller' WHEN 9 THEN 'Lowell' WHEN 10 THEN 'Mason' WHEN 11 THEN 'Nolan' ELSE 'Parker' END
        || translate('' || CAST(floor(s_suppkey / 39.0) AS BIGINT), '0123456789', 'abcdefghij') AS last_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "official_alias": """SELECT official_id, first_name || ' ' || last_name AS alias FROM person WHERE official_id % 4 <> 3
        UNION ALL SELECT official_id, 'Mayor ' || first_name || ' ' || last_name FROM person WHERE official_id % 6 = 0""",
    "minutes_name": """SELECT v.motion_id, v.official_id, v.motion_date, v.vote_value, CASE WHEN v.motion_id % 10 = 0 THEN b.jurisdiction_id ELSE p.jurisdiction_id END AS jurisdiction_id,
        CASE (v.motion_id + v.official_id) % 10 WHEN 0 THEN 'Councilmember ' || last_name WHEN 1 THEN first_name || ' ' || last_name WHEN 2 THEN 'Mayor ' || upper(first_name) || ' ' || last_name
             WHEN 3 THEN 'Mr. ' || substr(first_name, 1, 1) || '. ' || last_name WHEN 4 THEN first_name || ' ' || last_name || 'e' WHEN 5 THEN last_name
             WHEN 6 THEN 'J. ' || first_name || ' ' || last_name WHEN 7 THEN 'Zelda Q. ' || last_name WHEN 8 THEN 'unknown member' ELSE first_name || ' ' || last_name END AS name
        FROM vote v JOIN person p ON v.official_id = p.official_id JOIN governing_body b ON v.body_id = b.body_id""",
    "directory": """SELECT 'county' AS kind, min(official_id) * 10 AS fips, last_name || ' County' AS name, 0 AS state FROM person GROUP BY last_name
        UNION ALL SELECT CASE WHEN official_id % 8 < 5 THEN 'school_district' ELSE 'city' END, official_id * 10 + 1,
        CASE official_id % 8 WHEN 0 THEN last_name || ' County School District' WHEN 1 THEN last_name || ' City School District' WHEN 2 THEN last_name || ' School District 3'
             WHEN 3 THEN last_name || ' County Consolidated School District' WHEN 4 THEN first_name || ' School District' WHEN 5 THEN 'Old-' || first_name || '-' || last_name || ' County'
             WHEN 6 THEN last_name ELSE last_name || ' County' END, 0 FROM person""",
    "property_record": """SELECT l_suppkey AS official_id, l_partkey AS parcel_id, year(l_shipdate) AS assessment_year, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS value_cents
        FROM lineitem GROUP BY l_suppkey, l_partkey, year(l_shipdate)""",
    "fund_event": """SELECT event_id, user_id % 5 AS jurisdiction_id, user_id, ts,
        CASE event_type WHEN 'purchase' THEN 'deposit' WHEN 'signup' THEN 'grant' ELSE 'spend' END AS kind,
        CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE -1 END * (1 + CAST(round(value * 100) AS BIGINT) % 5000) AS amount_cents,
        event_type FROM events""",
    "reservation_event": """SELECT user_id, event_id, ts, CASE event_type WHEN 'purchase' THEN 'deposit' WHEN 'signup' THEN 'grant' WHEN 'view' THEN 'reserve' WHEN 'click' THEN 'settle'
        ELSE CASE event_id % 4 WHEN 0 THEN 'suspend' WHEN 1 THEN 'release' ELSE 'resume' END END AS kind, 1 + CAST(round(value * 100) AS BIGINT) % CASE WHEN event_type IN ('purchase', 'signup') THEN 5000 ELSE 3000 END AS cents,
        event_id % 3 <> 0 AS essential, max(CASE WHEN event_type = 'view' THEN event_id END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS hold FROM events""",
    "extraction_line": """SELECT l_orderkey AS doc, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag) AS win,
        l_partkey, l_suppkey, l_returnflag, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem""",
    "failure": """SELECT event_id AS failure_id, user_id % 5 AS jurisdiction_id, ts AS created_at,
        'job' || (event_id % 3) AS job, 'step' || (event_id % 4) AS step, 'error ' || (event_id % 100) AS message,
        event_id % 6 = 0 AS resolved FROM events WHERE event_type = 'error'""",
    "outcome": """SELECT event_id, user_id % 5 AS jurisdiction_id, ts AS created_at,
        CASE event_id % 3 WHEN 0 THEN 'text' WHEN 1 THEN 'ocr' ELSE 'vision' END AS method,
        CASE WHEN event_id % 7 = 0 THEN 'failed' WHEN event_id % 5 = 0 THEN 'partial' ELSE 'ok' END AS status,
        event_id % 4 AS n_missing, event_id % 2 AS n_garbled FROM events WHERE event_type IN ('view', 'click')""",
    "citizen_comment": """SELECT conv_id * 1000 + turn AS comment_id, CAST(floor(conv_id / 10.0) AS BIGINT) AS item_id, turn, role, conv_id AS user_id, text,
        CASE (conv_id + turn) % 3 WHEN 0 THEN 'support' WHEN 1 THEN 'oppose' ELSE 'neutral' END AS stance FROM conversations""",
    "issue_event": """SELECT event_id, ts, CASE WHEN user_id % 9 = 0 THEN NULL ELSE user_id % 5 END AS jurisdiction_id, 'step' || (user_id % 40) AS dedupe_key,
        CASE event_type WHEN 'error' THEN 'observed' WHEN 'purchase' THEN 'cleared' WHEN 'signup' THEN CASE WHEN event_id % 11 = 0 THEN 'wont_fix' ELSE 'noted' END ELSE 'noted' END AS kind FROM events""",
    "delivery_event": """SELECT event_id, ts, CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 3 = 0 THEN ' Clerk' || user_id || '@Town.example' ELSE 'clerk' || user_id || '@town.example' END AS email,
        CASE event_type WHEN 'error' THEN 'email.bounced' WHEN 'signup' THEN 'email.complained' WHEN 'purchase' THEN 'email.delivered' ELSE 'email.opened' END AS event_type FROM events""",
    "milestone_event": """SELECT event_id, ts, CASE WHEN user_id % 10 = 9 THEN NULL ELSE user_id % 5 END AS jurisdiction_id, CASE WHEN event_type <> 'view' THEN event_type || ':' || (user_id % 10) END AS dedupe_key FROM events""",
    "comment_event": """SELECT event_id AS comment_id, user_id, (event_id * 7 + user_id) % 31 AS item_id, ts, CASE event_id % 5 WHEN 0 THEN 'support' WHEN 1 THEN ' Oppose' WHEN 2 THEN 'neutral' WHEN 3 THEN 'SUPPORT' ELSE CASE WHEN event_id % 3 = 0 THEN 'maybe' ELSE 'oppose' END END AS stance FROM events""",
    "agenda_item": """SELECT n_nationkey AS item_id, DATE '2024-01-04' + CAST(n_nationkey AS INT) AS meeting_date, n_nationkey % 2 = 0 AS in_phoenix FROM nation""",
    "petition": """SELECT o_orderkey AS motion_id, p.body_id, CASE WHEN o_orderkey % 13 = 0 THEN 'disputed' WHEN o_orderkey % 17 = 0 THEN 'repairing' ELSE 'clean' END AS data_status,
        CASE o_orderkey % 12 WHEN 0 THEN first_name || ' ' || last_name WHEN 1 THEN 'Councilmember ' || last_name WHEN 2 THEN 'COUNCILMEMBER ' || first_name || ' ' || upper(last_name) WHEN 3 THEN 'Mayor ' || first_name || ' ' || last_name
             WHEN 4 THEN 'Mayor Pro Tem ' || first_name || ' ' || last_name || ', District 3' WHEN 5 THEN first_name || ' ' || last_name || ' LLC' WHEN 6 THEN last_name WHEN 7 THEN 'Mayor ' || last_name WHEN 8 THEN 'Councilmember ' || last_name || 'son'
             WHEN 9 THEN NULL ELSE 'Applicant ' || o_custkey END AS petitioner,
        CASE o_orderkey % 9 WHEN 0 THEN 'City Manager ' || first_name || ' ' || last_name WHEN 1 THEN upper(first_name || ' ' || last_name) || ' and staff' WHEN 2 THEN NULL WHEN 3 THEN 'Planning Director' WHEN 4 THEN first_name || '  ' || last_name
             WHEN 5 THEN 'for ' || first_name || ' ' || last_name || ' by ' || first_name || ' ' || last_name || 'son' ELSE 'Staff ' || o_custkey END AS recommender
        FROM (SELECT o_orderkey, o_custkey, 1 + o_custkey % n AS who FROM orders CROSS JOIN (SELECT count(*) AS n FROM supplier) z) o JOIN person p ON p.official_id = o.who""",
    "named_official": """SELECT official_id, body_id, is_elected, first_name || ' ' || last_name AS canonical_name, last_name FROM person""",
    "payload_item": """SELECT meeting_id, motion_id, '{"item_number":"' || motion_id || '","title":" ' || title || '","summary_plain_english":"On ' || motion_type || '","motion_type":"' || motion_type || '","outcome":"'
        || CASE WHEN motion_id % 997 = 0 THEN 'unknown' ELSE outcome END || '","vote_tally":{"yes":' || coalesce(tally_yes, 0) || ',"no":' || coalesce(tally_no, 0) || '},"individual_votes":['
        || CASE WHEN motion_id % 3 = 0 THEN '{"name":"Ann Lee","vote":"yes"}' WHEN motion_id % 1009 = 0 THEN '{"name":"Ann Lee","vote":"aye"}' ELSE '' END || ']'
        || CASE WHEN motion_id % 601 = 0 THEN '' WHEN motion_id % 5 = 0 THEN ',"source_page":"' || (1 + motion_id % 40) || '"' ELSE ',"source_page":' || (1 + motion_id % 40) END || '}' AS item, motion_id % 4 <> 0 AS has_page FROM motion""",
    "payload_object": """SELECT m.meeting_id, minutes_url, '{"meeting":{"meeting_time":' || CASE m.meeting_id % 3 WHEN 0 THEN '"19:00"' WHEN 1 THEN 'null' ELSE '""' END || ',"called_to_order_at":' || CASE WHEN m.meeting_id % 4 = 0 THEN 'null' ELSE '"18:05"' END
        || CASE WHEN m.meeting_id % 2 = 0 THEN ',"location":"Hall ' || m.meeting_id || '"' ELSE '' END || ',"extraction_confidence":"' || CASE m.meeting_id % 17 WHEN 0 THEN 'unsure' WHEN 1 THEN 'low' WHEN 2 THEN 'high' ELSE 'medium' END || '"},'
        || CASE WHEN m.meeting_id % 19 = 0 THEN '' ELSE '"attendance":{"present":[' || CASE WHEN m.meeting_id % 6 = 0 THEN '' ELSE '"Ann Lee","Member ' || m.meeting_id % 40 || '"' END || ']' || CASE WHEN m.meeting_id % 5 = 1 THEN ',"absent":["Bo Day"]' ELSE '' END
        || CASE WHEN m.meeting_id % 7 = 1 THEN ',"staff_present":["Clerk ' || m.meeting_id || '"]' ELSE ',"staff_present":[]' END || '},' END || '"agenda_items":[' || items || '],"extraction_notes":"' || CASE WHEN m.meeting_id % 8 = 1 THEN 'two pages dark' ELSE '' END || '"'
        || CASE WHEN m.meeting_id % 9 = 1 THEN ',"document_summary":"In short ' || m.meeting_id || '"' ELSE '' END || '}' AS obj
        FROM meeting m JOIN (SELECT meeting_id, string_agg(item, ',') AS items FROM payload_item GROUP BY meeting_id) i ON i.meeting_id = m.meeting_id""",
    "stored_payload": """SELECT meeting_id * 10 + v AS source_id, minutes_url AS source_url, CASE WHEN meeting_id % 14 = 0 AND v = 0 THEN NULL ELSE TIMESTAMP '2001-01-01 00:00:00' END AS ingested_at,
        CASE WHEN v = 0 AND meeting_id % 11 = 2 THEN substr(obj, 1, length(obj) - 3) WHEN v = 0 AND meeting_id % 11 = 3 THEN '[1]' WHEN v = 0 AND meeting_id % 11 = 4 THEN NULL
             WHEN meeting_id % 11 = 1 THEN '"' || replace(obj, '"', chr(92) || '"') || '"' ELSE obj END AS raw_payload
        FROM payload_object CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1 AS v) z WHERE v = 0 OR meeting_id % 4 = 0""",
    "meeting_detail": """SELECT meeting_id, minutes_url, 'scheduled' AS status, 'old notes' AS attendance_notes, '17:00' AS called_to_order_at, '21:00' AS adjourned_at, CASE WHEN meeting_id % 2 = 1 THEN '18:30' END AS meeting_time,
        CASE WHEN meeting_id % 3 = 0 THEN 'Old Hall' END AS location, 'old summary' AS minutes_ai_summary FROM meeting""",
    "packet_meeting": """SELECT doc_id AS meeting_id, CAST(floor(doc_id / 200.0) AS BIGINT) AS body_id, DATE '1999-01-05' + CAST(7 * (doc_id % 200) AS INT) AS meeting_date,
        CASE WHEN doc_id % 3 = 0 THEN 'https://docs.example.org/minutes/' || doc_id END AS minutes_url, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE 'https://docs.example.org/agenda/' || doc_id END AS agenda_url,
        CASE WHEN doc_id % 25 = 1 THEN '{"minutes_source":"embedded"}' WHEN doc_id % 35 = 1 THEN '{"agenda_unavailable":null}' WHEN doc_id % 6 = 1 THEN NULL ELSE '{"note":"minutes_source"}' END AS meta FROM documents""",
    "packet_motion": """SELECT doc_id AS meeting_id FROM documents WHERE doc_id % 11 = 0""",
    "packet_date": """SELECT doc_id, trim(substr('January  February March    April    May      June     July     August   SeptemberOctober  November December ', 9 * month(d) - 8, 9)) AS mon,
        '' || day(d) AS dd, CASE WHEN day(d) < 10 THEN '0' ELSE '' END || day(d) AS padded, ', ' || year(d) AS yy, coalesce(text, '') AS body
        FROM (SELECT doc_id, text, DATE '1999-01-05' + CAST(7 * (doc_id % 200 - 1 - doc_id % 5) AS INT) AS d FROM documents) q""",
    "packet_text": """SELECT 'https://docs.example.org/agenda/' || doc_id AS source_url, split(CASE doc_id % 8 WHEN 0 THEN 'Minutes of the ' || mon || ' ' || dd || yy || ' Regular Meeting' || chr(10) || body
        WHEN 1 THEN body || chr(10) || 'MINUTES  OF ' || upper(mon) || ' ' || padded || yy || chr(10) || 'Roll call' WHEN 2 THEN body || chr(10) || 'Approve minutes' || chr(9) || 'of the ' || mon || '  ' || dd || yy || '.'
        WHEN 3 THEN 'Minutes for ' || mon || ' ' || dd || yy || chr(10) || body WHEN 4 THEN 'Minutes of February 31' || yy || chr(10) || body || chr(10) || 'minutes of ' || mon || ' ' || padded || yy || chr(10) || 'Minutes of ' || mon || ' ' || dd || yy
        WHEN 5 THEN body ELSE body || chr(10) || 'Minutes of the ' || mon || ' ' || dd || yy END, chr(10)) AS pages FROM packet_date WHERE doc_id % 13 <> 0""",
    "registry_entry": """SELECT c_custkey AS entry_id, 'town-' || c_custkey AS slug, CASE WHEN c_custkey % 101 = 0 THEN 'no JSON' ELSE '{"agenda_platform":"' || CASE c_custkey % 6 WHEN 0 THEN 'none_found' WHEN 1 THEN 'carrier pigeon' ELSE 'civicplus' END || '"'
        || CASE c_custkey % 5 WHEN 0 THEN ',"clerk_email_access":"none_found"' WHEN 1 THEN ',"clerk_email_access":null' ELSE ',"clerk_email_access":"published"' END || CASE c_custkey % 4 WHEN 0 THEN ',"records_custodian_email":"clerk@town.example"' WHEN 1 THEN ',"records_custodian_email":""' ELSE ',"records_custodian_email":"r@town.example"' END
        || ',"confidence":"' || CASE c_custkey % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'sure' END || '","verified":"' || CASE WHEN c_custkey % 2 = 0 THEN 'verified' ELSE 'draft' END || '"'
        || CASE c_custkey % 7 WHEN 0 THEN ',"public_comment":{"channel":"in_person_only"}' WHEN 1 THEN ',"public_comment":{"channel":"fax","recipient_email":"c@town.example"}' WHEN 2 THEN '' ELSE ',"public_comment":{"channel":"email","recipient_email":"c@town.example"}' END
        || CASE c_custkey % 8 WHEN 0 THEN ',"notable_gaps":["Minutes not  published since May","budget is online"]' WHEN 1 THEN ',"notable_gaps":["none"]' WHEN 2 THEN ',"notable_gaps":[]' ELSE '' END
        || CASE c_custkey % 9 WHEN 0 THEN '' ELSE ',"verification":{"structure_sweep":{"sections_enumerated":[' || CASE c_custkey % 10 WHEN 0 THEN '' WHEN 1 THEN '"agendas"' ELSE '"https://town.example/agendas"' END || ']},"search_pass":{"queries":['
        || CASE c_custkey % 11 WHEN 0 THEN '"town agenda"' WHEN 1 THEN '"budget","map","news"' WHEN 2 THEN '"Minutes","map","news"' ELSE '"agenda","clerk email","map"' END || ']' || CASE WHEN c_custkey % 12 = 0 THEN '' ELSE ',"engine":"web"' END || '},"sibling_control":"'
        || CASE WHEN c_custkey % 13 = 0 THEN ' ' ELSE 'minutes parse' END || '"' || CASE WHEN c_custkey % 14 < 7 THEN ',"adversarial":"2-of-3"' ELSE '' END || CASE WHEN c_custkey % 15 < 9 THEN ',"session_date":"2001-05-01"' ELSE '' END || '}' END || '}' END AS entry FROM customer""",
}

#: Motions without their tallies, for what reads none: every other column of ``motion``, which has one row a motion as well.
VIEWS["motion_text"] = re.sub(r",\s+CASE WHEN d\.motion_id % 37 .*? AS tally_abstain| LEFT JOIN tally t ON .*$", "", VIEWS["motion"], flags=re.DOTALL)


def needed(sql: str, held: tuple | dict = ()) -> list[str]:
    """Views that a text names, with those they build on but for those held, in order of definition."""
    found, todo = set(), [sql]
    while todo:
        text = todo.pop()
        for name in VIEWS:
            if name not in found and name not in held and re.search(rf"\b{name}\b", text):
                found.add(name)
                todo.append(VIEWS[name])
    return [v for v in VIEWS if v in found]


def with_views(sql: str) -> str:
    """The SQL with the civic views it names as common table expressions in front."""
    names = needed(sql)
    head = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in names)
    body = sql.strip()
    if not names:
        return body
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {head},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


class Civic:
    """Civic and driver tables of one folder as lazily read DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.as_of = AS_OF
        self.held: dict[str, DataFrame] = {}

    def deal(self, table: str, *keys: str) -> Civic:
        """From now on the views get the table's rows dealt by key (``dealing``)."""
        setattr(self, table, dealt(getattr(self, table), *keys))
        return self

    def settle(self, *views: str) -> Civic:
        """Write views once; from now on they and the views that build on them read what was written."""
        for name in views:
            self.held[name] = settled(getattr(self, name))
            setattr(self, name, self.held[name])
        return self

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in VIEWS:
            views = needed(VIEWS[name], self.held) + [name]
            text = " ".join(VIEWS[v] for v in views)
            for t in [*TABLES, *self.held]:
                if re.search(rf"\b{t}\b", text):
                    getattr(self, t).createOrReplaceTempView(t)
            head = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in dict.fromkeys(views))
            frame = self.spark.sql(f"WITH {head} SELECT * FROM {name}")
            setattr(self, name, frame)
            return frame
        raise AttributeError(name)
