"""Document fingerprints by closed syncmers, in DataFrame functions alone.

Method.  A text of any length is a row of units: its words, single letters of
scripts written without spaces, and single other characters; white space says
nothing.  Of the k-mers of units, those are anchors whose minimal inner s-mer (by
hash) lies at either edge.  Whether a k-mer is an anchor depends on nothing
outside of it, so an edit moves or changes only the anchors that it touches.

The fingerprint has every anchor with its position, counted in units.  Two texts
match by position: an anchor is matched if the other text has it, too, at the
same distance from the anchor before.  Distances instead of places make passages
match wherever they stand.  The likeness of two texts is the Jaccard similarity
of their sets of such placed anchors.

Anchors are more than the text, so only texts are shuffled and the neighbour's
anchors are made again.  Neighbours in id order are found without one global sort:
quantiles of the ids cut the table into ranges, every range is ordered for itself,
and the row at each cut is also sent to the range above, so texts are shuffled
once.  The ranges have names that Spark's hash deals evenly to the tasks.

Defined results: null text is the empty text; texts with fewer than k units, or
without an anchor, have the hash of all their units as their one anchor, at 0;
rows that repeat an id stand next to each other by their texts; a null id is the
smallest; the only document of a table is its own neighbour; very long texts are
read whole; other columns are ignored, whatever their names; an empty table gives
none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, table, whole_text

K, S = 5, 2
RANGES_PER_PARTITION = 2
LOWEST = -(1 << 63)
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
#: A letter of an unspaced script, a run of other letters, marks and numbers, or any other character but the six of white space.
UNIT = rf"[{_UNSPACED}]|[\p{{L}}\p{{M}}\p{{N}}_&&[^{_UNSPACED}]]+|[^\x20\x09-\x0D]"


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: every anchor of column ``text`` as (hash, position), in the order of the text.

    The steps are columns of their own, so that no lambda makes an array again.
    """
    h, inner, middle, spots = (f"__{out}_{i}" for i in range(4))
    at = lambda a, i: F.get(F.col(a), i)
    df = df.withColumn(h, F.transform(F.regexp_extract_all(F.col(text), F.lit(UNIT), F.lit(0)), lambda u: F.xxhash64(u)))
    df = df.withColumn(inner, F.zip_with(F.col(h), F.slice(F.col(h), F.lit(S), F.size(h)), lambda x, y: F.xxhash64(x, y)))
    # the smaller of the two inner s-mers that lie at no edge
    df = df.withColumn(middle, F.zip_with(F.slice(F.col(inner), 2, F.size(inner)), F.slice(F.col(inner), 3, F.size(inner)), lambda x, y: F.least(x, y)))
    edge = lambda i: F.least(at(inner, i), at(inner, i + K - S)) <= at(middle, i)
    # naming ``middle`` twice keeps the optimiser from moving it into the lambda
    df = df.withColumn(spots, F.when((F.size(h) >= K) & (F.size(middle) > 0), F.filter(F.sequence(F.lit(0), F.size(h) - K), edge)))
    one = lambda x, i: F.struct(x.alias("hash"), i.alias("position"))
    found = F.transform(spots, lambda i: one(F.xxhash64(*[at(h, i + j) for j in range(K)]), i))
    whole = F.array(one(F.xxhash64(F.col(h)), F.lit(0)))
    return df.withColumn(out, F.when(F.size(F.coalesce(F.col(spots), F.array())) > 0, found).otherwise(whole)).drop(h, inner, middle, spots)


def with_placed(df: DataFrame, anchors: str, out: str) -> DataFrame:
    """Add ``out``: the distinct placed anchors, each a hash of the anchor's and its distance from the one before."""
    before = F.concat(F.slice(F.col(anchors), 1, 1), F.slice(F.col(anchors), 1, F.size(anchors) - 1))
    placed = F.zip_with(F.col(anchors), before, lambda x, y: F.xxhash64(x["hash"], x["position"] - y["position"]))
    return df.withColumn(out, F.array_distinct(placed))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of placed anchors without repeats."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def as_text(anchors: Column) -> Column:
    """Anchors as ``position:hash``, with commas between."""
    return F.array_join(F.transform(anchors, lambda x: F.concat(x["position"].cast("string"), F.lit(":"), x["hash"].cast("string"))), ",")


def _below(cuts: list[int], key: Column) -> Column:
    """How many of the sorted cuts lie below the key, by binary search."""
    size = 1
    while size <= len(cuts):
        size *= 2
    padded = F.array(*[F.lit(c) for c in cuts + [(1 << 63) - 1] * (size - len(cuts))])
    steps, step = [], size // 2
    while step:
        steps.append(step)
        step //= 2
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda lo, st: F.when(F.get(padded, lo + st - 1) < key, lo + st).otherwise(lo))


def id_cuts(ids: DataFrame, ranges: int) -> list[int]:
    """Ids of the table that cut it into about equal ranges; the last is the largest id.

    The driver gets at most ``ranges`` numbers; the two passes read ids alone.
    """
    shares = F.array(*[F.lit((i + 1) / ranges) for i in range(ranges)])
    rough = ids.agg(F.percentile_approx("key", shares, 10 * ranges).alias("q")).first().q
    if not rough:
        return []
    rough = sorted(set(rough))[:-1]
    tops = ids.groupBy(_below(rough, F.col("key")).alias("b")).agg(F.max("key").alias("top"))
    return sorted(r.top for r in tops.collect())


def range_names(spark, ranges: int, partitions: int) -> list[int]:
    """Numbers for the ranges, such that Spark's hash partitioning deals as many to every task."""
    each = -(-ranges // partitions)
    tried = spark.range(64 * ranges + 64).select(F.col("id").cast("int").alias("name"))
    rows = tried.select("name", F.pmod(F.hash("name"), F.lit(partitions)).alias("task")).collect()  # 64 numbers a range
    by_task: dict[int, list[int]] = {}
    for r in rows:
        by_task.setdefault(r.task, []).append(r.name)
    names = [names[i] for i in range(each) for names in by_task.values() if i < len(names)]
    return (names + [r.name for r in rows if r.name not in set(names)])[:ranges]


def with_next(docs: DataFrame, id_col: str, carried: list[str], ranges: int | None = None) -> DataFrame:
    """Add ``next_<c>`` for each carried column: its value in the next row by descending id.

    After the last row comes the first.  Expects a column ``key`` (non-null long).
    """
    spark = docs.sparkSession
    cuts = id_cuts(docs.select("key"), ranges or RANGES_PER_PARTITION * shuffle_partitions(spark))
    if not cuts:
        return docs.withColumns({f"next_{c}": F.col(c) for c in carried}).limit(0)
    n = len(cuts)
    placed = docs.withColumn("range", _below(cuts, F.col("key")))
    at_cut = F.get(F.array(*map(F.lit, cuts)), F.col("range")) == F.col("key")
    copies = F.when(at_cut, F.array(F.struct(F.col("range").alias("r"), F.lit(0).alias("guest")), F.struct(((F.col("range") + 1) % n).alias("r"), F.lit(1).alias("guest"))))
    placed = placed.withColumn("__to", F.explode(copies.otherwise(F.array(F.struct(F.col("range").alias("r"), F.lit(0).alias("guest"))))))
    names = F.array(*map(F.lit, range_names(spark, n, shuffle_partitions(spark))))
    placed = placed.withColumn("range", F.get(names, F.col("__to.r"))).withColumn("guest", F.col("__to.guest")).drop("__to")
    order = Window.partitionBy("range").orderBy("guest", F.col("key").desc(), F.col("tie"))
    return placed.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried}).filter("guest = 0").drop("range", "guest")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, the anchors as (hash, position) and as text, for every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = with_anchors(rows, "text", "anchors")
    return rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "anchors", as_text(F.col("anchors")).alias("fingerprint"))


def edited_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("key", F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))).withColumn("tie", F.xxhash64("text"))
    rows = with_next(rows, id_col, ["text"])
    third = F.floor(F.length("text") / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.expr("substring(text, 1, length(text) - int(floor(length(text) / 3)))"), F.substring("next_text", F.lit(1), third)))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    for text, fp in (("text", "fp"), ("next_text", "next_fp"), ("edited", "edited_fp")):
        rows = with_placed(with_anchors(rows, text, fp), fp, f"{fp}_placed")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp_placed"), F.col("edited_fp_placed")).alias("near_edited"),
        likeness(F.col("fp_placed"), F.col("next_fp_placed")).alias("near_next"),
    )


def op7_fingerprints(spark, sf_dir: str) -> DataFrame:
    return edited_neighbours(table(spark, sf_dir, "documents"))
