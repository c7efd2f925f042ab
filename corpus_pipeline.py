"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet in the shared folder and read again as the next one's docs.
Stages keep the columns of ``documents``; the last one returns the tokens.

Defined results: null and empty texts pass as empty texts do in each operator;
rows that repeat an id and a text are reduced to one by the dedup stage; an empty
table gives an empty result; extra columns are carried unchanged to the last stage,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumdf.llm import bpe, exact_dedup, mixing, ngram_join, quality_cnn
from quorumdf.llm.common import free_name, table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network predicts to be good."""
    model = quality_cnn.fit(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs.columns, "score")
    scored = quality_cnn.score_documents(docs, model, out=score)
    return scored.filter(F.col(score) >= quality_cnn.THRESHOLD).select(*docs.columns)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts."""
    return ngram_join.keep_one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in random order."""
    return mixing.mix(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding."""
    out = bpe.encode_documents(docs)
    return out.select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("n-gram Jaccard join", near_dedup_stage),
    ("mixing sources to target weights", mixing_stage),
    ("BPE encoding and decoding", encode_stage),
]

#: A trained network and a tokenizer have no SQL form; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage{i}")
    return docs
