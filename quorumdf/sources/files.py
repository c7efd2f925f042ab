"""Readers of delimited and JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """A gazetteer whose delimiter the header shows ('|', else tab); header names trimmed, Latin-1, short rows dropped."""
    header = spark.read.option("encoding", "ISO-8859-1").text(path).first()
    if header is None:
        return spark.createDataFrame([], "geoid string")
    sep = "|" if "|" in header.value else "\t"
    names = [n.strip() for n in header.value.split(sep)]
    rows = (
        spark.read.option("sep", sep).option("encoding", "ISO-8859-1").option("header", True).option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True).schema(", ".join(f"`{n}` string" for n in names)).csv(path)
    )
    return rows.filter(F.col(f"`{names[-1]}`").isNotNull())


def read_place_parts(spark: SparkSession, path: str, population: str = "POPESTIMATE2024") -> DataFrame:
    """Sub-county rows (SUMLEV 157) with a place; a population that isn't a number is 0."""
    rows = spark.read.option("header", True).csv(path)
    rows = rows.filter((F.col("SUMLEV") == "157") & F.col("PLACE").isNotNull() & ~F.col("PLACE").isin("", "00000"))
    return rows.select(
        F.concat("STATE", "PLACE").alias("place_fips"), F.concat("STATE", "COUNTY").alias("county_fips"), F.coalesce(F.expr(f"try_cast({population} as bigint)"), F.lit(0)).alias("population")
    )


def counties_of_places(parts: DataFrame) -> DataFrame:
    """Primary county (largest part, tie to the lowest code) and all counties in that order."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("population")).alias("p"), "county_fips"))), lambda s: s["county_fips"])
    return parts.groupBy("place_fips").agg(ordered.alias("counties")).withColumn("primary_county", F.get("counties", F.lit(0)))


def read_property_capture(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records with parcel and year, rejected ones) of a capture file."""
    schema = "records array<struct<official_match_hint:string,parcel_id:string,assessment_year:int,market_value:double,exemptions:array<string>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("records").alias("r")).select("r.*")
    ok = F.col("parcel_id").isNotNull() & (F.trim("parcel_id") != "") & F.col("assessment_year").isNotNull()
    return rows.filter(ok), rows.filter(~F.coalesce(ok, F.lit(False)))


def filing_kind(name: Column) -> Column:
    """Kind of a campaign document by its title, first rule wins."""
    low = F.lower(name)
    return (
        F.when(low.rlike(r"\bccdr\b|contribution disclosure"), "contribution_report").when(low.rlike(r"\bpfd\b|personal financial"), "financial_disclosure")
        .when(low.rlike("affidavit"), "affidavit").when(low.rlike(r"\bdoi\b|declaration of intent"), "declaration").when(low.rlike("choosing option"), "option_form")
        .when(low.rlike("qualif"), "qualifying").otherwise("other")
    )


def filing_person(name: Column) -> Column:
    """struct(person, year): the words before the year or kind, and the largest year in the title."""
    years = F.regexp_extract_all(name, F.lit(r"((?:19|20)\d{2})"), 1)
    person = F.trim(F.regexp_replace(F.regexp_replace(name, r"(?i)[\s_-]*(?:(?:19|20)\d{2}|ccdr|pfd|doi|affidavit).*$", ""), r"[\s_-]+$", ""))
    return F.struct(F.nullif(person, F.lit("")).alias("person"), F.array_max(F.transform(years, lambda y: y.cast("int"))).alias("year"))


def read_filing_docs(spark: SparkSession, path: str) -> DataFrame:
    """Public-document list metadata as filings."""
    schema = "items array<struct<guid:string,documentName:string,documentType:string,dateReceived:string>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("items").alias("i")).select("i.*")
    who = filing_person(F.col("documentName"))
    return rows.select("guid", filing_kind(F.col("documentName")).alias("kind"), who.person.alias("person"), who.year.alias("year"), F.expr("try_to_date(substring(dateReceived, 1, 10))").alias("received"))


def bio_pages(pages: DataFrame, domain: str, html: str = "html", id_col: str = "page_id") -> DataFrame:
    """Name, photo, labelled values and tier of directory pages."""
    images = F.regexp_extract_all(html, F.lit(r"(<img\b[^>]*>)"), 1)
    tagged = F.get(F.filter(images, lambda t: t.rlike("(?i)headshot")), F.lit(0))
    other = F.get(F.filter(images, lambda t: t.rlike(r'(?i)alt="[^"]+"') & ~t.rlike("(?i)logo|icon|banner")), F.lit(0))
    photo = F.coalesce(tagged, other)
    heads = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<h[12][^>]*>(.*?)</h[12]>"), 1), lambda h: F.trim(F.regexp_replace(h, r"<[^>]*>", "")))
    good = F.filter(heads, lambda h: (F.length(h) > 0) & (F.length(h) < 60) & ~h.rlike("(?i)^(city of|staff|directory)"))
    text = F.regexp_replace(html, r"<[^>]*>", "\n")
    label = lambda name: F.nullif(F.trim(F.regexp_extract(text, rf"(?i){name}:\s*\n*([^\n]+)", 1)), F.lit(""))
    src = F.nullif(F.regexp_extract(photo, r'src="([^"]*)"', 1), F.lit(""))
    alt = F.regexp_replace(F.regexp_extract(photo, r'alt="([^"]*)"', 1), r"(?i)\s*(headshot|photo|portrait).*$", "")
    paragraphs = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<p[^>]*>(.*?)</p>"), 1), lambda p: F.trim(F.regexp_replace(p, r"<[^>]*>", "")))
    long = F.filter(paragraphs, lambda p: F.length(p) >= 100)
    bio = F.array_max(F.transform(long, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"]
    host = F.expr("try_parse_url(photo_url, 'HOST')")
    rows = pages.select(id_col, F.coalesce(F.get(good, F.lit(0)), F.nullif(alt, F.lit(""))).alias("name"), label("Title").alias("title"), src.alias("photo_url"), bio.alias("bio"))
    return rows.withColumn("tier", F.when(F.col("photo_url").isNull(), 0).when(host.isNull() | host.endswith(domain), 2).otherwise(1))
