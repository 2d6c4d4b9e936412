"""The pipeline's stages: each applies one operator's decisions to all documents that it is given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from domloom.llm import decontaminate, minhash, packing, repeats, toxicity
from domloom.llm.common import in_small_batches, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below 0.3; the model learns from the labelled ones among ``docs``."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the least id, of each component of documents alike in 0.8 of their five-word shingles."""
    in_small_batches(spark)
    return minhash.keep_one(docs, 80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that an earlier document has are cut out; documents of nothing else go."""
    in_small_batches(spark)
    return repeats.cut_texts(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage within a tenth of a benchmark item's length in edits go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4,096 tokens, counted with the tokenizer."""
    import public_tokenizers

    return packing.pack_counted(docs, public_tokenizers.path("byte_bpe_50k.json"))
