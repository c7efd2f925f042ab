"""Parsers of listing pages, calendars and JSON feeds as column expressions over a table of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Patterns of meeting names and their types, tried in this order.
MEETING_TYPES = [(r"\bwork session\b", "workshop"), (r"\bspecial(\s+called)?\b", "special"), (r"\bemergency\b", "emergency"), (r"\bexecutive session\b", "executive_session")]


def posted_stamp(text: Column) -> Column:
    """Timestamp of "Posted Month D, YYYY H:MM AM" anywhere in a text; null where there is none."""
    found = F.regexp_extract(text, r"(?i)Posted\s+(?:on\s+)?([a-z]+\s+\d{1,2},\s*\d{4}\s+\d{1,2}:\d{2}\s*[ap]m)", 1)
    plain = F.regexp_replace(F.regexp_replace(F.initcap(found), r"\s*,\s*", ", "), r"\s+", " ")
    plain = F.regexp_replace(F.regexp_replace(plain, r"(?i)\s?am$", " AM"), r"(?i)\s?pm$", " PM")
    return F.try_to_timestamp(F.nullif(plain, F.lit("")), F.lit("[MMMM][MMM] d, yyyy h:mm a"))


def meeting_type(name: Column) -> Column:
    """The first matching pattern decides."""
    kind = F.lit("regular")
    for pattern, label in reversed(MEETING_TYPES):
        kind = F.when(name.rlike(f"(?i){pattern}"), label).otherwise(kind)
    return kind


def table_rows(pages: DataFrame, html: str, id_col: str) -> DataFrame:
    """One row per <tr> block of every page with its position."""
    rows = F.regexp_extract_all(html, F.lit(r"(?s)<tr\b([^>]*>.*?)</tr>"), 1)
    return pages.select(id_col, F.posexplode(rows).alias("pos", "row"))


def listing_to_meetings(pages: DataFrame, html: str = "html", id_col: str = "page_id") -> DataFrame:
    """Agenda-listing rows: date and id from the link, query dropped, minutes link of the same row, type, posted stamp."""
    rows = table_rows(pages, html, id_col).filter(F.col("row").rlike("catAgendaRow"))
    link = lambda kind: F.nullif(F.regexp_extract("row", rf'href="(/[^"?]*ViewFile/{kind}/_\d{{8}}-\d+)', 1), F.lit(""))
    rows = rows.withColumn("agenda_url", link("Agenda")).withColumn("minutes_url", link("Minutes"))
    ref = F.coalesce("agenda_url", "minutes_url")
    rows = rows.withColumn("stamp", F.regexp_extract(ref, r"_(\d{8})-(\d+)", 1)).withColumn("item", F.regexp_extract(ref, r"_(\d{8})-(\d+)", 2))
    date = F.expr("try_to_date(stamp, 'MMddyyyy')")
    text = F.regexp_replace("row", r"<[^>]*>", " ")
    return rows.withColumn("meeting_date", date).filter("meeting_date is not null").select(
        id_col, "meeting_date", F.col("item").cast("long").alias("item"), "agenda_url", "minutes_url", meeting_type(text).alias("meeting_type"), posted_stamp(text).alias("posted_at")
    )


def anchors_to_docs(pages: DataFrame, html: str = "html", id_col: str = "page_id") -> DataFrame:
    """Anchors whose text starts with M-D-YY(YY): the last of a date wins; document links become export links."""
    both = F.regexp_extract_all(html, F.lit(r'(?s)(<a\b[^>]*href="[^"]*"[^>]*>.*?</a>)'), 1)
    rows = pages.select(id_col, F.posexplode(both).alias("pos", "a"))
    rows = rows.withColumn("href", F.regexp_extract("a", r'href="([^"]*)"', 1)).withColumn("label", F.trim(F.regexp_replace("a", r"<[^>]*>", "")))
    part = lambda i: F.regexp_extract("label", r"^(\d{1,2})-(\d{1,2})-(\d{4}|\d{2})(?!\d)", i)
    year = F.when(F.length(part(3)) == 2, F.concat(F.lit("20"), part(3))).otherwise(part(3))
    rows = rows.withColumn("d", F.concat_ws("-", year, F.lpad(part(1), 2, "0"), F.lpad(part(2), 2, "0")))
    rows = rows.withColumn("doc_date", F.expr("try_to_date(d, 'yyyy-MM-dd')")).filter("doc_date is not null")
    doc = F.regexp_extract("href", r"document/d/([A-Za-z0-9_-]+)", 1)
    url = F.when(doc != "", F.concat(F.lit("https://docs.google.com/document/d/"), doc, F.lit("/export?format=pdf"))).when(F.col("href").endswith(".pdf"), F.col("href"))
    return rows.withColumn("url", url).filter("url is not null").groupBy(id_col, "doc_date").agg(F.max_by("url", "pos").alias("url"))


def board_list_members(pages: DataFrame, heading: str, html: str = "html", id_col: str = "page_id") -> DataFrame:
    """Members in the list after a heading: "Name, Role (expires D)", three date formats, e-mail of the item."""
    block = F.regexp_extract(html, rf"(?is)<h[1-4][^>]*>[^<]*{heading}[^<]*</h[1-4]>(.*?)(?:<h[1-4]|$)", 1)
    rows = pages.select(id_col, F.posexplode(F.regexp_extract_all(block, F.lit(r"(?is)<li[^>]*>(.*?)</li>"), 1)).alias("pos", "li"))
    raw = F.trim(F.regexp_replace(F.regexp_replace("li", r"<[^>]*>", ""), r"^\s*Email\s+", ""))
    rows = rows.withColumn("raw", raw).withColumn("email", F.nullif(F.regexp_extract("li", r'mailto:([^"?]+)', 1), F.lit("")))
    when = F.regexp_extract("raw", r"(?i)\(\s*(?:term )?expires:?\s*([^)]*)\)", 1)
    expires = F.coalesce(*[F.expr(f"try_to_date(expires_text, '{f}')") for f in ("MMMM d, yyyy", "M/d/yyyy", "yyyy-MM-dd")])
    rest = F.trim(F.regexp_replace("raw", r"\s*\([^)]*\)\s*$", ""))
    rows = rows.withColumn("expires_text", when).withColumn("rest", rest)
    role = F.nullif(F.trim(F.regexp_extract("rest", r"^[^,]*,(.*)$", 1)), F.lit(""))
    return rows.select(id_col, F.trim(F.substring_index("rest", ",", 1)).alias("name"), role.alias("role"), expires.alias("expires"), "email", "raw")


def ical_events(files: DataFrame, text: str = "text", id_col: str = "page_id", from_date: str | None = None) -> DataFrame:
    """VEVENT blocks only: start date and time (000000 is no time), summary and place."""
    rows = files.select(id_col, F.posexplode(F.regexp_extract_all(text, F.lit(r"(?s)BEGIN:VEVENT(.*?)END:VEVENT"), 1)).alias("pos", "event"))
    start = lambda i: F.nullif(F.regexp_extract("event", r"DTSTART[^:\r\n]*:(\d{8})(?:T(\d{6}))?", i), F.lit(""))
    rows = rows.withColumn("d", start(1)).withColumn("t", F.nullif(start(2), F.lit("000000")))
    field = lambda name: F.trim(F.regexp_extract("event", rf"(?m)^{name}[^:\r\n]*:([^\r\n]*)", 1))
    out = rows.select(
        id_col, F.expr("try_to_date(d, 'yyyyMMdd')").alias("event_date"), F.concat_ws(":", F.substring("t", 1, 2), F.substring("t", 3, 2)).alias("event_time"),
        field("SUMMARY").alias("title"), F.regexp_replace(field("LOCATION"), r"^- ", "").alias("location"),
    ).withColumn("event_time", F.nullif("event_time", F.lit(""))).filter("event_date is not null")
    return out if from_date is None else out.filter(F.col("event_date") >= F.lit(from_date).cast("date"))


def events_to_meetings(feed: DataFrame, payload: str = "payload") -> DataFrame:
    """Vendor event JSON: first agenda else packet, first minutes; a trailing Z is local time; midnight is no time."""
    schema = "struct<id:bigint,eventName:string,startDateTime:string,publishedAgendaTimeStamp:string,publishedFiles:array<struct<type:string,fileId:bigint>>>"
    e = feed.select(F.from_json(payload, schema).alias("e")).select("e.*")
    of = lambda kind: F.get(F.filter("publishedFiles", lambda f: f["type"] == kind), F.lit(0))["fileId"]
    wall = F.regexp_replace("startDateTime", "Z$", "")
    time = F.nullif(F.substring(wall, 12, 5), F.lit("00:00"))
    return e.select(
        "id", F.to_date(F.substring(wall, 1, 10)).alias("meeting_date"), time.alias("meeting_time"), meeting_type(F.col("eventName")).alias("meeting_type"),
        F.coalesce(of("Agenda"), of("Agenda Packet")).alias("agenda_file"), of("Minutes").alias("minutes_file"), of("Agenda Packet").alias("packet_file"),
        F.try_to_timestamp(F.regexp_replace("publishedAgendaTimeStamp", "Z$", "")).alias("posted_at"),
    )


def roster_table_members(pages: DataFrame, html: str = "html", id_col: str = "page_id") -> DataFrame:
    """Four-cell rows of a roster table: name, position, address, phone; vacancies marked, '' and N/A null."""
    cells = F.transform(F.regexp_extract_all("row", F.lit(r"(?s)<td\b[^>]*>(.*?)</td>"), 1), lambda c: F.trim(F.regexp_replace(c, r"<[^>]*>", "")))
    rows = table_rows(pages, html, id_col).withColumn("cells", cells).filter(F.size("cells") >= 4)
    cell = lambda i: F.nullif(F.nullif(F.get("cells", F.lit(i)), F.lit("")), F.lit("N/A"))
    return rows.select(
        id_col, cell(0).alias("name"), cell(1).alias("position"), cell(2).alias("address"), cell(3).alias("phone"),
        (F.upper(F.get("cells", F.lit(0))) == "VACANT").alias("vacant"), F.nullif(F.regexp_extract("row", r"EID=(\d+)", 1), F.lit("")).alias("eid"),
    )


def features_to_districts(collection: DataFrame, number_keys: list[str], name_keys: list[str], payload: str = "payload") -> DataFrame:
    """GeoJSON features: the first number key that casts to int, the first name key that isn't blank; else rejected."""
    schema = "struct<features:array<struct<properties:map<string,string>>>>"
    rows = collection.select(F.posexplode(F.from_json(payload, schema)["features"]).alias("pos", "f"))
    rows = rows.withColumn("p", F.transform_keys(F.col("f.properties"), lambda k, v: F.lower(k)))
    number = F.coalesce(*[F.expr(f"try_cast(p['{k.lower()}'] as int)") for k in number_keys])
    name = F.coalesce(*[F.nullif(F.trim(F.col("p")[k.lower()]), F.lit("")) for k in name_keys], F.concat(F.lit("District "), number.cast("string")))
    return rows.select("pos", number.alias("number"), name.alias("name")).filter("number is not null")


def latest_payload(payloads: DataFrame, key: str, order: str) -> DataFrame:
    """The latest row per key, ties by the payload's hash."""
    w = Window.partitionBy(key).orderBy(F.desc(order), F.xxhash64(*payloads.columns))
    return payloads.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
