"""Recovered text: content addressing, page windows, page choice, segments, token search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumdf.dealing import dealt


def content_hash(text: Column) -> Column:
    """SHA-256 of the text without NUL characters."""
    return F.sha2(F.translate(text, "\x00", ""), 256)


def content_addressed(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(one row per distinct text, every id with its hash)."""
    rows = docs.select(F.col(id_col), content_hash(F.col(text)).alias("hash"), F.col(text).alias("text"))
    texts = rows.groupBy("hash").agg(F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("n_ids"), F.max(F.length("text")).cast("long").alias("n_chars"))
    return texts, rows.select(id_col, "hash")


def page_windows(docs: DataFrame, id_col: str, text: str, size: int = 10, mark: str = "\n") -> DataFrame:
    """Windows of so many pages with their 1-based first page; pages are split at the mark."""
    pages = docs.select(id_col, F.posexplode(F.split(F.col(text), mark)).alias("pos", "page"))
    window = F.floor(F.col("pos") / size).alias("window")
    per = pages.groupBy(id_col, window).agg(F.count(F.lit(1)).alias("n_pages"), F.sort_array(F.collect_list(F.struct("pos", "page"))).alias("rows"))
    joined = F.array_join(F.transform("rows", lambda r: r["page"]), mark)
    return per.select(id_col, (F.col("window") * size + 1).alias("first_page"), "n_pages", joined.alias("text"))


def text_verdict(chars: Column, size: Column, magic: Column) -> Column:
    return F.when(magic != "%PDF", "not_pdf").when(chars >= 200, "text").when(size <= 5000, "stub").otherwise("needs_ocr")


def summary_pages(docs: DataFrame, id_col: str, text: str, cues: list[str], top: int, lead: int = 3) -> DataFrame:
    """The pages with the most cues and digits, and the first ones, in page order."""
    pages = docs.select(id_col, F.posexplode(F.split(F.col(text), "\n")).alias("pos", "page"))
    score = F.lit(0.0)
    for cue in cues:
        score = score + F.regexp_count(F.lower("page"), F.lit(cue))
    score = score + F.least(F.length(F.regexp_replace("page", "[^0-9]", "")) / 200, F.lit(5.0))
    w = Window.partitionBy(id_col).orderBy(F.desc("score"), "pos")
    ranked = pages.withColumn("score", F.round(score, 6)).withColumn("rn", F.row_number().over(w))
    return ranked.filter((F.col("rn") <= top) | (F.col("pos") < lead)).select(id_col, F.col("pos").cast("int").alias("pos"), "score")


def merge_segments(segments: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the island of adjacent or overlapping spans that holds the largest span."""
    segments = dealt(segments, *keys)
    w = Window.partitionBy(*keys).orderBy("start_page", "end_page")
    reach = F.max("end_page").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = segments.withColumn("new", (reach.isNull() | (F.col("start_page") > reach + 1)).cast("int"))
    # of equal spans the one that opens an island comes first
    again = Window.partitionBy(*keys).orderBy("start_page", "end_page", F.desc("new")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("island", F.sum("new").over(again))
    islands = rows.groupBy(*keys, "island").agg(
        F.min("start_page").alias("start_page"), F.max("end_page").alias("end_page"), F.count(F.lit(1)).alias("n"),
        F.max(F.struct((F.col("end_page") - F.col("start_page")).alias("span"), (-F.col("start_page")).alias("early"))).alias("largest"),
    )
    best = Window.partitionBy(*keys).orderBy(F.desc("largest.span"), F.desc("largest.early"))
    return islands.withColumn("rn", F.row_number().over(best)).filter("rn = 1").select(*keys, "start_page", "end_page", "n")


def token_search(docs: DataFrame, id_col: str, text: str, words: list[str]) -> DataFrame:
    """Documents with all the words, by an equi-join on the token table."""
    tokens = docs.select(id_col, F.explode(F.array_distinct(F.split(F.lower(text), r"[^a-z0-9]+"))).alias("token"))
    wanted = docs.sparkSession.createDataFrame([(w.lower(),) for w in words], "token string")
    hits = tokens.join(F.broadcast(wanted), "token")  # the query's words
    return hits.groupBy(id_col).agg(F.countDistinct("token").alias("n")).filter(F.col("n") == len(words)).select(id_col)


def cache_split(requests: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """Each request marked hit or miss."""
    known = cache.select(*keys).distinct().withColumn("hit", F.lit(True))
    return requests.join(known, keys, "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
