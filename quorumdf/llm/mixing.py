"""Mixing sources to target weights by Poisson replication.

Method.  A source's repetition rate is the number of documents that its target
weight asks for over the number it has.  A document's count of copies is drawn
from a Poisson distribution with that mean by inverting its distribution function
at a number in [0, 1) that a hash of the seed and the id gives, so every document
decides alone and the same on every run.  Rates above ``PART`` are drawn as sums
of equal Poisson parts, each with a hash of its own, so no term underflows.  The
documents are exploded by their counts and shuffled globally by a hash of seed,
id and copy.

Target weights: given per source, or by temperature: n ** ``temperature`` of the
source's documents n (1 keeps the proportions, 0 makes all sources equal).  The
mix has ``budget`` documents in expectation; by default as many as there are.

Defined results: a null source is a source of its own, named ''; a null id hashes
as 'null'; rows that repeat an id get equal counts; sources without a given
weight get none; null and empty texts are documents as any; an empty table gives
none; very long texts move as any, once; columns of ``docs`` are carried along.  One
that has the name of an output gives way to it, so name the outputs otherwise to
keep both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, shuffle_partitions, table, written

SEED = "mix-1"
TEMPERATURE = 0.5
PART = 32.0
TERMS = 160  # the chance of more copies than terms in a part is below 2 ** -53


def unit_hash(*parts) -> Column:
    """A number in [0, 1) of 52 bits from the parts' text."""
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, budget: float | None = None) -> DataFrame:
    """__source, rate and the distribution function of one part, per source."""
    sizes = docs.groupBy(F.coalesce("source", F.lit("")).alias("__source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        sizes = sizes.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(float(temperature))))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "__source string, w double")
        sizes = sizes.join(given, "__source", "left").fillna(0.0, ["w"])
    sums = sizes.agg(F.sum("w").alias("all_w"), F.sum("n").alias("all_n"))
    total = F.lit(float(budget)) if budget is not None else F.col("all_n").cast("double")
    rates = sizes.crossJoin(F.broadcast(sums)).withColumn("rate", total * F.col("w") / F.col("all_w") / F.col("n"))  # one row of sums
    rates = rates.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")).withColumn("mean", F.col("rate") / F.col("parts"))
    first = F.exp(-F.col("mean"))
    start = F.struct(first.alias("p"), first.alias("sum"), F.array(first).alias("cdf"))
    grown = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        start,
        lambda s, k: F.struct(
            (s["p"] * F.col("mean") / k).alias("p"),
            (s["sum"] + s["p"] * F.col("mean") / k).alias("sum"),
            F.array_append(s["cdf"], s["sum"] + s["p"] * F.col("mean") / k).alias("cdf"),
        ),
        lambda s: s["cdf"],
    )
    return rates.select("__source", "rate", "parts", grown.alias("cdf"))


OUTPUTS = ("rate", "n_copies", "copy", "shuffle_key")


def replicate(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, budget: float | None = None, seed: str = SEED, id_col: str = "doc_id", outputs: tuple[str, str, str, str] = OUTPUTS) -> DataFrame:
    """The documents by their numbers of copies, with the four ``outputs`` beside their columns, shuffled.

    The rates are written first: Spark then knows their size and broadcasts them
    where they are small, so texts move once, in the shuffle at the end.
    """
    docs = docs.drop(*outputs)
    rate, n_copies, copy, order = outputs
    taken = [*docs.columns, *outputs]
    source, cdf, parts, one_u, mean_rate = (free_name(taken, n) for n in ("__source", "__cdf", "__parts", "__u", "__rate"))
    rates = source_rates(docs.select("source"), weights, temperature, budget)
    rates = written(rates.select(F.col("__source").alias(source), F.col("rate").alias(mean_rate), F.col("parts").alias(parts), F.col("cdf").alias(cdf)), "rates")
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    joined = docs.withColumn(source, F.coalesce("source", F.lit(""))).join(rates, source)
    drawn = F.aggregate(
        F.sequence(F.lit(0), F.col(parts) - 1),
        F.lit(0),
        lambda s, j: s + F.size(F.filter(cdf, lambda c: c <= unit_hash(F.lit(seed), name, j.cast("string")))),
    )
    joined = joined.withColumn(one_u, unit_hash(F.lit(seed), name, F.lit("0")))
    one = F.size(F.filter(cdf, lambda c: c <= F.col(one_u)))
    counted = joined.withColumn(n_copies, F.when(F.col(parts) == 1, one).otherwise(drawn))
    copies = counted.filter(F.col(n_copies) > 0).withColumn(copy, F.explode(F.sequence(F.lit(0), F.col(n_copies) - 1)))
    keyed = copies.withColumn(order, F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), name, F.col(copy).cast("string"))))
    keyed = keyed.select(*docs.columns, F.col(mean_rate).alias(rate), n_copies, copy, order)
    return keyed.repartition(shuffle_partitions(docs.sparkSession), order).sortWithinPartitions(order)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The shuffled copies with the columns of ``docs`` alone, whatever their names."""
    outputs = tuple(free_name(docs.columns, n) for n in OUTPUTS)
    return replicate(docs, outputs=outputs, **options).select(*docs.columns)


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = replicate(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.round("rate", 9).alias("rate"), F.col("n_copies").cast("int").alias("n_copies"), F.col("copy").cast("int").alias("copy"), "shuffle_key", "text")


OP5_SQL = r"""
WITH s AS (
  SELECT coalesce(source, '') AS src, count(*) AS n, pow(CAST(count(*) AS DOUBLE), 0.5) AS w FROM documents GROUP BY 1
), t AS (
  SELECT sum(w) AS all_w, CAST(sum(n) AS DOUBLE) AS all_n FROM s
), r AS (
  SELECT src, all_n * w / all_w / n AS rate, CAST(greatest(1, ceil(all_n * w / all_w / n / 32.0)) AS INTEGER) AS parts FROM s, t
), d AS (
  SELECT doc_id, source, text, rate, parts, rate / parts AS mean, coalesce(CAST(doc_id AS VARCHAR), 'null') AS name
  FROM documents JOIN r ON coalesce(source, '') = src
), u AS (
  SELECT d.*, p.j, CAST(CAST('0x' || substr(md5('mix-1:' || name || ':' || CAST(p.j AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM d, LATERAL (SELECT unnest(range(parts)) AS j) p
), k AS (
  SELECT src, kk, sum(exp(-rate / parts + kk * ln(rate / parts) - lgamma(kk + 1))) OVER (PARTITION BY src ORDER BY kk) AS cdf
  FROM r, (SELECT unnest(range(161)) AS kk)
), c AS (
  SELECT u.doc_id, u.source, u.text, u.rate, u.name, u.j, count(k.kk) AS n
  FROM u LEFT JOIN k ON k.src = coalesce(u.source, '') AND k.cdf <= u.u GROUP BY ALL
), n AS (
  SELECT doc_id, source, text, rate, name, CAST(sum(n) AS INTEGER) AS n_copies FROM c GROUP BY ALL
)
SELECT doc_id, source, round(rate, 9) AS rate, n_copies, CAST(x.copy AS INTEGER) AS copy,
       md5('mix-1:order:' || name || ':' || CAST(x.copy AS VARCHAR)) AS shuffle_key, text
FROM n, LATERAL (SELECT unnest(range(n_copies)) AS copy) x
"""
