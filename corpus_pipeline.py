"""From raw documents to packed sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from domloom.llm import stages
from domloom.llm.common import shared_folder, table

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stages.drop_toxic),
    ("minhash_near_dedup", stages.drop_near_copies),
    ("suffix_array_dedup", stages.cut_repeats),
    ("benchmark_decontamination", stages.drop_contaminated),
    ("best_fit_packing", stages.pack_sequences),
]

#: Trained scores, tokens of edit distance and packing have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each one's rows go through the cluster's shared folder."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
