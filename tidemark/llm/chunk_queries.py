"""Registered query of BPE with chunk reuse (no SQL: tested against the tokenizer's own library)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunk_bpe
from .common import table


def op12_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    done = chunk_bpe.decode(chunk_bpe.encode(table(spark, sf_dir, "documents", "doc_id", "text"), path), path)
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


ORACLES: dict[str, str] = {}
