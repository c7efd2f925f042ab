"""Further entries of queries without SQL: ``tests/test_whole_queries.py`` holds them against brute force on fixtures.

Those of the same name without ``_whole`` are over all rows, too, and have SQL.
"""

from pyspark.sql import functions as F

from quorumdf.dealing import parts
from quorumdf.operators import detectors as D
from quorumdf.operators import observers as O
from quorumdf.operators import resolution as E

from .compliance_queries import _prior
from .registry import query
from .remaining_queries import recommenders


@query("c04_member_roster_missing_whole")
def c04(c):
    return O.member_roster_missing(c.governing_body, c.official, c.term)


@query("c05_campaign_finance_missing_whole")
def c05(c):
    return O.campaign_finance_missing(c.governing_body, c.official, c.contribution, c.as_of)


@query("c07_budget_overdue_whole")
def c07(c):
    return O.budget_overdue(c.motion, c.meeting, c.as_of)


@query("c08_finding_lifecycle_whole")
def c08(c):
    observed, _ = O.observe(c)
    return O.lifecycle(observed, _prior(c), ["body_id", "category"], live=["open", "records_requested"], closed="closed_with_records")


@query("e03b_customer_name_typos_whole")
def e03b(c):
    n = c.customer
    return E.similar_pairs(n, n, "c_custkey", "c_name", "c_custkey", "c_name", 0.75, ordered=True).select("ka", "kb", "similarity")


@query("e04_ranked_candidates_whole")
def e04(c):
    shown = c.customer.select("c_name", F.expr("replace(c_name, 'Customer', 'Supplier')").alias("name"))
    cand = E.ranked_candidates(shown.select("name").distinct(), c.official)
    return cand.join(shown, "name").select(F.col("c_name").alias("name"), "official_id", "similarity", "rn")


def d11(c, motion=None, tasks=1):
    names = c.customer.select(F.col("c_custkey").alias("official_id"), F.col("c_name").alias("canonical_name"))
    return D.official_as_petitioner(c.motion if motion is None else motion, names, tasks)


@query("d11_official_as_petitioner_whole")
def d11_dealt(c):
    tasks = parts(c.orders)
    return d11(c, c.deal("orders", "o_custkey").motion_text, tasks)


@query("d12_official_as_recommender_whole")
def d12(c):
    return recommenders(c.motion, c.customer.select(F.col("c_custkey").alias("official_id"), F.lower("c_name").alias("low")))


@query("f06_array_overlap_whole")
def f06(c):
    return c.motion.groupBy("body_id").agg(F.bool_or(F.coalesce(F.col("motion_type").isin("ordinance", "nothing"), F.lit(False))).alias("hit"))


@query("m04_digest_lines_whole")
def m04(c):
    """One row per line of a digest, with the whole body; order by comment_id within an item."""
    return c.citizen_comment.filter("role = 'user'").select("item_id", "comment_id", F.concat_ws(": ", "stance", "text").alias("line"))


@query("m04_digest_tallies_whole")
def m04_tallies(c):
    counts = [F.count_if(F.col("stance") == s).alias(s) for s in ("support", "oppose", "neutral")]
    return c.citizen_comment.filter("role = 'user'").groupBy("item_id").agg(*counts)
