"""The corpus pipeline: documents in, token ids of the cleaned corpus out.

Stages, in order: quality rules (documents that the rules reject go), toxicity
(documents that score as toxic go), near duplicates (of each group the document
with the least id stays), benchmark decontamination (documents that contain a
test item go) and byte-level BPE.  Each stage reads what its predecessor kept,
written as Parquet; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, jaccard_join, quality_rules, toxicity
from tidemark.llm.common import table
from tidemark.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9; its model is fitted on the documents it is given."""
    return quality_rules.filter_documents(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1; its grammar is learned from the documents it is given."""
    return toxicity.filter_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4, with shingles of five words and a Jaccard similarity of 0.8."""
    return jaccard_join.keep_one(docs, 5, 80, 100)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5."""
    return decontaminate.filter_documents(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: (doc_id, n_tokens, ids)."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality rules", quality), ("toxicity", toxic), ("near duplicates", near_duplicates), ("decontamination", contamination), ("byte-level BPE", encode)]

#: No SQL can train the models; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
