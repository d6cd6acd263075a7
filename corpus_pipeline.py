"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's input.

Every stage keeps the columns of ``documents`` but the last, which returns the
kept documents' token counts and digests. The stages inherit the edge cases of
their operators; an empty table passes through all of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.llm.common import fresh, stored, table
from parcelmart.llm.cotrain import score, train
from parcelmart.llm.decontaminate import find_contamination
from parcelmart.llm.line_dedup import dedup_lines
from parcelmart.llm.near_dedup import near_duplicates
from parcelmart.llm.queries import bpe_digest
from parcelmart.session import checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier rejects go."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).where("accepted").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 and more code points in 5 and more documents stay in one of them; ``n_chars`` follows the text."""
    out = dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates stays, the one with the smallest id. Rows of one id go together."""
    found = stored(near_duplicates(docs), "near-duplicates")
    gone = found.groupBy("doc_id").agg(F.max("kept").alias("kept")).where(~F.col("kept"))
    gone = gone.select(F.col("doc_id").alias(fresh("gone", docs)))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone[gone.columns[0]]), "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word window of a benchmark item go."""
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("contamination.items") == 0).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of what is left, and back: counts and digests."""
    return bpe_digest(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage's result is a written table."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex[:12]}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{k}")
    return docs


#: The classifier and the tokenizer are beyond SQL; the tests hold the rows against a brute-force version.
ORACLE_SQL = None
