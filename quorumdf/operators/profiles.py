"""Profile and dashboard results for all officials and bodies at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], *order, n: int = 1) -> DataFrame:
    """The first ``n`` rows per key in the order given."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def identity(official: DataFrame, term: DataFrame, as_of: str) -> DataFrame:
    """Officials with their current seat: a term without an end or ending later."""
    now = F.lit(as_of).cast("date")
    current = term.filter((F.col("start_date") <= now) & (F.col("end_date").isNull() | (F.col("end_date") >= now)))
    current = latest(current, ["official_id"], F.desc("start_date"), F.desc("term_id")).select("official_id", "seat_id", "start_date")
    return official.join(current, "official_id", "left")


def career(term: DataFrame) -> DataFrame:
    return term.groupBy("official_id").agg(
        F.count(F.lit(1)).alias("n_terms"), F.min("start_date").alias("first_start"), F.max("end_date").alias("last_end"), F.count_if(F.col("end_date").isNull()).alias("open_terms")
    )


def voting_record(vote: DataFrame, motion: DataFrame, n: int = 100) -> DataFrame:
    """The latest votes of every official with the motion's context."""
    rows = vote.select("official_id", "motion_id", "motion_date", "vote_value").join(motion.select("motion_id", "motion_type", "outcome"), "motion_id")
    return latest(rows, ["official_id"], F.desc("motion_date"), F.desc("motion_id"), n=n)


def contributions_by_cycle(contribution: DataFrame) -> DataFrame:
    return contribution.groupBy("official_id", "cycle", "contributor_type").agg(F.count(F.lit(1)).alias("n"), F.sum("amount_cents").alias("cents"))


def top_donors(contribution: DataFrame, n: int = 50) -> DataFrame:
    sums = contribution.groupBy("official_id", "contributor_name").agg(F.sum("amount_cents").alias("cents"), F.count(F.lit(1)).alias("gifts"))
    return latest(sums, ["official_id"], F.desc("cents"), "contributor_name", n=n)


def wealth_by_year(prop: DataFrame) -> DataFrame:
    """Assessed value, parcels and change against the year before, per official and year."""
    per = prop.groupBy("official_id", "assessment_year").agg(F.sum("value_cents").alias("cents"), F.countDistinct("parcel_id").alias("parcels"))
    w = Window.partitionBy("official_id").orderBy("assessment_year")
    return per.withColumn("change", F.col("cents") - F.lag("cents").over(w))


def roster(official: DataFrame, vote: DataFrame, term: DataFrame, as_of: str) -> DataFrame:
    """Officials with the span of their votes; each side is summed before the join."""
    span = vote.groupBy("official_id").agg(F.count(F.lit(1)).alias("n_votes"), F.min("motion_date").alias("first_vote"), F.max("motion_date").alias("last_vote"))
    return identity(official, term, as_of).join(span, "official_id", "left").fillna(0, ["n_votes"])


def petitioners(motion: DataFrame) -> DataFrame:
    rows = motion.filter("petitioner is not null")
    return rows.groupBy("petitioner").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("dollar_amount") * 100).cast("long")).alias("cents"), F.min("motion_date").alias("first_date"), F.max("motion_date").alias("last_date")
    )


def vote_breakdown(vote: DataFrame, motion: DataFrame) -> DataFrame:
    """Votes by motion type and value, one column per value."""
    rows = vote.select("official_id", "motion_id", "vote_value").join(motion.select("motion_id", "motion_type"), "motion_id")
    values = ["yes", "no", "abstain", "conflict_recusal"]
    return rows.groupBy("official_id", "motion_type").agg(*[F.count_if(F.col("vote_value") == v).alias(v) for v in values])
