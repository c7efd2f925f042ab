"""File readers on literal files."""

import datetime as dt
import json

from pyspark.sql import functions as F

from quorumdf import schemas
from quorumdf.sources import files as S


def test_gazetteer_delimiters(spark, tmp_path):
    for i, sep in enumerate("|\t"):
        p = tmp_path / f"g{i}.txt"
        p.write_bytes(f"USPS{sep}GEOID{sep}NAME   \nGA{sep}13001{sep}Cañon city\nGA{sep}13002\n".encode("latin-1"))
        rows = S.read_gazetteer(spark, str(p)).collect()
        assert [(r.GEOID, r.NAME) for r in rows] == [("13001", "Cañon city")]


def test_place_parts(spark, tmp_path):
    p = tmp_path / "p.csv"
    p.write_text("SUMLEV,STATE,COUNTY,PLACE,POPESTIMATE2024\n157,13,001,00100,50\n157,13,003,00100,70\n157,13,002,00100,70\n157,13,001,00000,9\n162,13,001,00100,9\n157,13,001,00200,A\n")
    got = {r.place_fips: (r.primary_county, r.counties) for r in S.counties_of_places(S.read_place_parts(spark, str(p))).collect()}
    assert got == {"1300100": ("13002", ["13002", "13003", "13001"]), "1300200": ("13001", ["13001"])}


def test_property_capture(spark, tmp_path):
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"records": [{"parcel_id": "1", "assessment_year": 2020}, {"parcel_id": "", "assessment_year": 2020}, {"parcel_id": "2"}]}, indent=1))
    ok, rejected = S.read_property_capture(spark, str(p))
    assert ok.count() == 1 and rejected.count() == 2


def test_filings(spark, tmp_path):
    p = tmp_path / "f.json"
    p.write_text(json.dumps({"items": [{"guid": "a", "documentName": "Jacqueline Rivera-Player-2025 CCDR", "dateReceived": "2025-09-30T10:00"}, {"guid": "b", "documentName": "DOI form", "dateReceived": "x"}]}))
    got = {r.guid: r for r in S.read_filing_docs(spark, str(p)).collect()}
    assert (got["a"].person, got["a"].year, got["a"].kind, got["a"].received) == ("Jacqueline Rivera-Player", 2025, "contribution_report", dt.date(2025, 9, 30))
    assert got["b"].kind == "declaration" and got["b"].received is None


def test_bio_page(spark):
    html = '<h1>Staff Directory</h1><h2>Ann Lee</h2><img src="/logo.png" alt="City logo"><img src="https://x.gov/a.jpg" alt="HEADSHOT Ann"><div>Title: <b>Clerk</b></div><p>' + "word " * 40 + "</p>"
    r = S.bio_pages(spark.createDataFrame([(1, html)], "page_id int, html string"), "x.gov").first()
    assert (r["name"], r.title, r.photo_url, r.tier) == ("Ann Lee", "Clerk", "https://x.gov/a.jpg", 2) and r.bio.startswith("word")


def test_typed_scan_fills_missing_columns(spark, tmp_path):
    spark.range(2).select(F.col("id").alias("official_id")).write.parquet(f"{tmp_path}/official")
    df = schemas.read_table(spark, str(tmp_path), "official")
    assert df.count() == 2 and df.first().canonical_name is None
    assert all(spark.createDataFrame([], ddl).columns for ddl in schemas.DDL.values())
