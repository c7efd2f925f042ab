"""Exact deduplication by skew-safe combining.

Method: every map task first combines its own equal texts (the partial
aggregation), groups are then merged per (digest, salt), and the winners of the
salts are combined per digest.  Each of the three steps groups by the digest
*and* the whole normalised text, so a digest collision never joins two texts.

A hot text leaves one row per map task, which the salts spread over ``salts``
reducers, so the last step sees at most ``salts`` rows of any text.

Defined results
  * null text counts as the empty text; all empty texts are one group;
  * a null ``doc_id`` never wins while the group has another id;
  * rows that repeat a ``doc_id`` each count and each get a result row, and
    ``kept`` is true for the first id's rows;
  * an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, table, whole_text

SALTS = 16


def _digested(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    norm = F.regexp_replace(whole_text(text_col), SPACE, " ")
    return docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm")).withColumn("text_sha256", F.sha2("norm", 256))


def groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """One row per distinct normalised text: text_sha256, norm, keep_id, group_size."""
    rows = _digested(docs, text_col, id_col)
    salted = (
        rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
        .groupBy("text_sha256", "salt", "norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    return salted.groupBy("text_sha256", "norm").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def exact_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Documents find their group by a key that stays unique even when digests
    collide: texts of one digest are told apart by a second, unrelated hash and
    the length.  The join moves ids and digests only, never texts; Spark's
    adaptive skew join splits the document side of a hot group.
    """
    tag = [F.length("norm").alias("norm_len"), F.xxhash64("norm").alias("norm_hash")]
    classes = groups(docs, text_col, id_col, salts).select("text_sha256", *tag, "keep_id", "group_size")
    members = _digested(docs, text_col, id_col).select("doc_id", "text_sha256", *tag)
    joined = members.join(classes, ["text_sha256", "norm_len", "norm_hash"])
    return joined.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_first(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents that stay, with all their columns, as a filtering stage.

    The winners' ids come back to the documents by a hash join that builds on
    the ids, so texts move once and are not sorted for it.  Of rows that repeat
    the winning id with an equal text, one stays.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))  # noqa: E731  no id is written as ''
    won = groups(docs, text_col, id_col).select(name("keep_id").alias("__name"), F.xxhash64("norm").alias("__hash"))
    marked = docs.withColumn("__name", name(id_col)).withColumn("__hash", F.xxhash64(F.regexp_replace(whole_text(text_col), SPACE, " ")))
    kept = marked.join(won.hint("shuffle_hash"), ["__name", "__hash"], "left_semi")
    # by the join's own keys, so the rows stay where they are
    same = Window.partitionBy("__name", "__hash").orderBy(F.xxhash64(*[c for c in docs.columns if c != text_col]))
    return kept.withColumn("__nth", F.row_number().over(same)).filter("__nth = 1").select(*docs.columns)


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm
)
SELECT d.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size,
       (d.doc_id = g.keep_id) AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
"""
