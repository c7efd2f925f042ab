"""Parsers on literal pages."""

import datetime as dt

from quorumdf.sources import listings as S


def test_agenda_listing(spark):
    html = """<table><tr class="catAgendaRow"><td><a href="/AgendaCenter/ViewFile/Agenda/_02032025-41?html=true">City Council Work Session</a>
    Posted January 30, 2025 4:05 PM <a href="/AgendaCenter/ViewFile/Minutes/_02032025-41">Minutes</a></td></tr>
    <tr><td>no row</td></tr><tr class="catAgendaRow"><td><a href="/AgendaCenter/ViewFile/Agenda/_13402025-42">bad date</a></td></tr></table>"""
    rows = S.listing_to_meetings(spark.createDataFrame([(1, html)], "page_id int, html string")).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.meeting_date == dt.date(2025, 2, 3) and r.item == 41 and r.meeting_type == "workshop"
    assert r.agenda_url.endswith("_02032025-41") and r.minutes_url.endswith("_02032025-41")
    assert r.posted_at == dt.datetime(2025, 1, 30, 16, 5)


def test_anchor_listing_last_wins(spark):
    html = """<a href="https://docs.google.com/document/d/ABC_1/edit">1-5-24 Minutes</a><a href="/x/b.pdf">1-5-2024 again</a>
    <a href="/x/c.pdf">13-45-24 bad</a><a href="/x/d.html">2-1-24 no file</a><a href="https://docs.google.com/document/d/Q-9/view">3-1-24</a>"""
    rows = {r.doc_date: r.url for r in S.anchors_to_docs(spark.createDataFrame([(1, html)], "page_id int, html string")).collect()}
    assert rows == {dt.date(2024, 1, 5): "/x/b.pdf", dt.date(2024, 3, 1): "https://docs.google.com/document/d/Q-9/export?format=pdf"}


def test_board_list(spark):
    html = """<h2>Other</h2><ul><li>No One</li></ul><h3>Board Members</h3><ul><li>Ann Lee, Chair (expires June 30, 2026)</li><li><a href="mailto:b@x.org">Email Bob Ray</a>, Member</li><li>Cy Poe</li></ul><h2>Next</h2><li>Z</li>"""
    rows = {r["name"]: r for r in S.board_list_members(spark.createDataFrame([(1, html)], "page_id int, html string"), "Board Members").collect()}
    assert set(rows) == {"Ann Lee", "Bob Ray", "Cy Poe"}
    assert rows["Ann Lee"].role == "Chair" and rows["Ann Lee"].expires == dt.date(2026, 6, 30)
    assert rows["Bob Ray"].email == "b@x.org" and rows["Cy Poe"].role is None


def test_calendar_uses_the_events_own_date(spark):
    ics = "BEGIN:VTIMEZONE\r\nDTSTART:20240310T020000\r\nEND:VTIMEZONE\r\nBEGIN:VEVENT\r\nDTSTART;TZID=X:20250506T180000\r\nSUMMARY:Council\r\nLOCATION:- City Hall\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nDTSTART:20250507T000000\r\nSUMMARY:Day\r\nEND:VEVENT"
    rows = {r.title: r for r in S.ical_events(spark.createDataFrame([(1, ics)], "page_id int, text string"), from_date="2025-01-01").collect()}
    assert rows["Council"].event_date == dt.date(2025, 5, 6) and rows["Council"].event_time == "18:00" and rows["Council"].location == "City Hall"
    assert rows["Day"].event_time is None


def test_event_json_is_local_time(spark):
    j = '{"id": 7, "eventName": "Special Called Meeting", "startDateTime": "2025-02-03T18:00:00Z", "publishedFiles": [{"type": "Minutes", "fileId": 3}, {"type": "Agenda Packet", "fileId": 4}, {"type": "Minutes", "fileId": 5}]}'
    r = S.events_to_meetings(spark.createDataFrame([(j,), ("not json",)], "payload string")).filter("id = 7").first()
    assert (r.meeting_date, r.meeting_time, r.meeting_type) == (dt.date(2025, 2, 3), "18:00", "special")
    assert (r.agenda_file, r.minutes_file, r.packet_file) == (4, 3, 4)


def test_roster_table(spark):
    html = "<tr><td>Vacant</td><td>Seat 1</td><td></td><td>N/A</td></tr><tr><td><a href='x?EID=12'>Ann</a></td><td>Mayor</td><td>1 Main</td><td>555</td></tr><tr><td>short</td></tr>"
    rows = S.roster_table_members(spark.createDataFrame([(1, html)], "page_id int, html string")).collect()
    assert [(r["name"], r.vacant, r.phone, r.eid) for r in rows] == [("Vacant", True, None, None), ("Ann", False, "555", "12")]


def test_districts_probe_keys(spark):
    j = '{"features": [{"properties": {"DIST": "x", "District_N": "3", "NAME": " "}}, {"properties": {"DIST": "2", "Name": "North"}}, {"properties": {"other": "1"}}]}'
    rows = S.features_to_districts(spark.createDataFrame([(j,)], "payload string"), ["dist", "district_n"], ["name"]).collect()
    assert [(r.number, r["name"]) for r in rows] == [(3, "District 3"), (2, "North")]
