"""Stored payloads and minutes inside packets on literal fixtures and against brute force."""

import datetime as dt
import json
import random
import re

import pytest

from quorumdf.operators import embedded as M
from quorumdf.operators import payloads as P

ITEM = {"title": "Rezone", "summary_plain_english": "s", "motion_type": "ordinance", "outcome": "passed", "vote_tally": {"yes": 3}, "individual_votes": [{"name": "Ann", "vote": "yes"}], "source_page": 4}
GOOD = {"meeting": {"extraction_confidence": "high"}, "attendance": {"present": ["Ann Lee", "Bo Day"], "absent": ["Cy Fox"], "staff_present": []}, "agenda_items": [ITEM], "extraction_notes": "dark scan"}


def without(path):
    copy = json.loads(json.dumps(GOOD))
    node = copy
    for key in path[:-1]:
        node = node[key]
    del node[path[-1]]
    return json.dumps(copy)


def changed(**fields):
    return json.dumps({**GOOD, "agenda_items": [{**ITEM, **fields}]})


CASES = [
    (json.dumps(GOOD), None), (json.dumps(json.dumps(GOOD)), None), (json.dumps({**GOOD, "agenda_items": []}), None), (changed(source_page="4"), None), (changed(individual_votes=[]), None),
    (None, "no payload"), ("", "not JSON"), ("{", "not JSON"), (json.dumps("{"), "not JSON"), ("[]", "not an object"), ("null", "not an object"), ("7", "not an object"),
    (without(["meeting"]), "no confidence"), (json.dumps({**GOOD, "meeting": {"extraction_confidence": "sure"}}), "no confidence"), (without(["attendance", "present"]), "no attendance"), (json.dumps({**GOOD, "attendance": "all"}), "no attendance"),
    (without(["agenda_items"]), "no items"), (json.dumps({**GOOD, "agenda_items": "x"}), "no items"), (json.dumps({**GOOD, "agenda_items": [ITEM, None]}), "incomplete item"), (without(["agenda_items", 0, "source_page"]), "incomplete item"),
    (changed(outcome="maybe"), "incomplete item"), (changed(motion_type=None), "incomplete item"), (changed(source_page="four"), "incomplete item"), (changed(individual_votes=[{"name": "Ann", "vote": "aye"}]), "incomplete item"), (changed(individual_votes="none"), "incomplete item"),
]


def test_reasons_of_payloads(spark):
    df = spark.createDataFrame([(i, text, "mine", "theirs") for i, (text, _) in enumerate(CASES)], "id int, raw_payload string, p string, reason string")
    rows = P.read(df)
    assert rows.columns == ["id", "p", "reason"]
    got = {r.id: r.reason for r in rows.collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(CASES)}
    assert P.items(rows, "id").count() == sum(reason is None for _, reason in CASES) - 1
    assert P.rejects(rows, "id").count() == sum(reason is not None for _, reason in CASES)


def test_no_payloads_at_all(spark):
    df = spark.createDataFrame([], "id int, raw_payload string")
    assert P.read(df).collect() == [] and P.items(P.read(df), "id").collect() == []


def test_latest_payload_by_moment_then_id(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    rows = [("a", 1, day(2), "x"), ("a", 2, day(3), "y"), ("a", 3, None, "z"), ("a", 4, day(4), None), ("b", 5, None, "u"), ("b", 6, None, "v"), ("c", 7, day(1), "p"), ("c", 8, day(1), "q"), (None, 9, day(1), "r"), ("d", 10, day(1), None)]
    df = spark.createDataFrame(rows, "source_url string, source_id int, ingested_at timestamp, raw_payload string")
    got = {r.source_url: (r.source_id, r.raw_payload) for r in P.latest(df, "source_url", "ingested_at", "source_id").collect()}
    assert got == {"a": (2, "y"), "b": (6, "v"), "c": (8, "q")}


def test_meetings_take_what_payloads_say(spark):
    said = {**GOOD, "meeting": {"extraction_confidence": "low", "meeting_time": "", "called_to_order_at": "18:05"}, "document_summary": ""}
    stored = spark.createDataFrame([("u1", json.dumps(said)), ("u2", "{"), ("u4", json.dumps({**GOOD, "attendance": {"present": []}, "extraction_notes": ""}))], "url string, raw_payload string")
    old = ("scheduled", "old", "17:00", "21:00", "18:30", "Hall", ["s"], ["o"], "sum")
    meetings = spark.createDataFrame([(i, u, *old) for i, u in enumerate(["u1", "u2", None, "u4"])], "meeting_id int, minutes_url string, status string, attendance_notes string, called_to_order_at string, adjourned_at string, meeting_time string, location string, staff_present array<string>, others_present array<string>, minutes_ai_summary string")
    got = {r.meeting_id: tuple(r)[2:] for r in P.updated_meetings(meetings, P.read(stored), "url").collect()}
    assert got[0] == ("minutes_published", "present: Ann Lee, Bo Day | absent: Cy Fox | extraction_confidence=low | notes: dark scan", "18:05", None, "18:05", "Hall", None, None, "sum")
    assert got[1] == got[2] == old
    assert got[3] == ("minutes_published", "extraction_confidence=high", None, None, "18:30", "Hall", None, None, "sum")


def test_replays_leave_once_filled(spark):
    meetings = spark.createDataFrame([(1, "u1"), (2, "u2"), (3, "u3"), (4, None)], "meeting_id int, minutes_url string")
    stored = spark.createDataFrame([("u1", 1, None, json.dumps(GOOD)), ("u2", 2, None, "{"), ("u4", 4, None, json.dumps(GOOD))], "source_url string, source_id int, ingested_at timestamp, raw_payload string")
    facts = spark.createDataFrame([(1, None), (1, None), (1, 3), (2, None), (3, None), (4, None)], "meeting_id int, source_page int")
    got = sorted(tuple(r) for r in P.provenance_candidates(meetings, facts, stored, "source_page").collect())
    assert got == [(1, 1, 2, 1, None), (2, 2, 1, 0, "not JSON")]
    assert P.provenance_candidates(meetings, facts.fillna(1), stored, "source_page").collect() == []


def brute(meetings, motions, packets, ahead=3, pages=8):
    found = {}
    for m in meetings:
        meta = json.loads(m["meta"]) if m["meta"] else {}
        if m["minutes_url"] or m["meeting_id"] in motions or "minutes_source" in meta or "agenda_unavailable" in meta:
            continue
        later = sorted((x["meeting_date"], x["meeting_id"], x["agenda_url"]) for x in meetings if x["body_id"] == m["body_id"] and x["meeting_date"] > m["meeting_date"] and x["agenda_url"])[:ahead]
        d = m["meeting_date"]
        pattern = re.compile(rf"minutes\s+of\s+(?:the\s+)?{d.strftime('%B')}\s+(?:{d.day}|{d.day:02d}),\s+{d.year}", re.I)
        for _, _, url in later:
            at = next((i for i, page in enumerate(packets.get(url) or []) if page and pattern.search(page)), None)
            if at is not None:
                found[m["meeting_id"]] = (url, at, "\n".join(packets[url][at : at + pages]))
                break
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_embedded_minutes_by_brute_force(spark, seed):
    rng = random.Random(seed)
    start = dt.date(2024, 5, 30)
    meetings, packets = [], {}
    for i in range(120):
        day = start + dt.timedelta(days=rng.randrange(60))
        url = f"u{i}" if rng.random() < 0.8 else None
        meta = rng.choice([None, "{}", '{"minutes_source":"x"}', '{"agenda_unavailable":null}', '{"note":"minutes_source"}'])
        meetings.append({"meeting_id": i, "body_id": rng.randrange(3), "meeting_date": day, "minutes_url": "m" if rng.random() < 0.2 else None, "agenda_url": url, "meta": meta})
        if url and rng.random() < 0.9:
            pages = ["", "Roll call"] * rng.randrange(1, 7)
            for _ in range(3):
                d = start + dt.timedelta(days=rng.randrange(60))
                gap = rng.choice([" ", "  ", "\t", " ", " "])
                text = rng.choice(["Minutes of the {m} {d}, {y}", "MINUTES{g}OF {m} {d:02d}, {y} Regular", "approve minutes of{g}the{g}{m}{g}{d},{g}{y}5", "Minutes of {m} 0{d:02d}, {y}", "Minutes {m} {d}, {y}", "minutes of {m} {d},{y}"])
                pages[rng.randrange(len(pages))] = text.format(m=d.strftime("%B"), d=d.day, y=d.year, g=gap)
            packets[url] = pages
    motions = {i for i in range(120) if rng.random() < 0.1}
    m = spark.createDataFrame(meetings, "meeting_id int, body_id int, meeting_date date, minutes_url string, agenda_url string, meta string")
    got = M.embedded_minutes(m, spark.createDataFrame([(i,) for i in motions], "meeting_id int"), spark.createDataFrame(list(packets.items()), "source_url string, pages array<string>"))
    expected = brute(meetings, motions, packets)
    assert expected and {r.meeting_id: (r.packet_url, r.first_page, r.slice) for r in got.collect()} == expected


def test_embedded_minutes_of_nothing(spark):
    m = spark.createDataFrame([(1, 1, dt.date(2024, 7, 8), None, None, None), (2, None, None, None, "u", "{")], "meeting_id int, body_id int, meeting_date date, minutes_url string, agenda_url string, meta string")
    none, texts = spark.createDataFrame([], "meeting_id int"), spark.createDataFrame([("u", None), ("v", [None, "Minutes of February 31, 2024"])], "source_url string, pages array<string>")
    assert M.embedded_minutes(m, none, texts).collect() == []
    assert M.embedded_minutes(m.limit(0), none, texts.limit(0)).collect() == []


def test_payloads_are_parsed_once_and_both_lists_of_an_item_count(spark):
    """A null list or null item gives nothing; who is only among the recusals has recused; the first listed vote counts."""
    from quorumdf.operators import facts

    def item(n, votes, out):
        return {"item_number": n, "title": "T", "individual_votes": votes, "recusals": out}

    texts = [
        json.dumps({"agenda_items": [item(1, [{"name": "ANN", "vote": "no"}, {"name": "ann", "vote": "yes"}, {"name": "Bo", "vote": "yes"}], [{"name": "bo", "reason": "kin"}, {"name": "Cy", "reason": None}]), None]}),
        json.dumps({"agenda_items": [item(2, None, [{"name": "Ann", "reason": "b"}, {"name": "Ann", "reason": "a"}]), item(3, [{"name": "Bo", "vote": None}], None), item(4, None, None)]}),
        json.dumps({"agenda_items": []}), "{}", "no JSON", None,
    ]
    raw = spark.createDataFrame([(t,) for t in texts], "payload string")
    officials = spark.createDataFrame([(1, "Ann"), (2, "Bo"), (3, "Cy")], "official_id long, canonical_name string")
    found = facts.payload_votes(facts.read_payloads(raw), officials)
    assert {(r.motion_id, r.official_id): (r.vote_value, r.reason) for r in found.collect()} == {
        (1, 1): ("no", None), (1, 2): ("conflict_recusal", "kin"), (1, 3): ("conflict_recusal", None), (2, 1): ("conflict_recusal", "a"), (3, 2): (None, None),
    }
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
