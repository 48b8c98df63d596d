"""The training-data pipeline: quality, near-duplicates, benchmark, mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every
stage's result to the shared scratch folder and hands it to the next. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from omnitally.llm import op3_decontamination, op5_tokens, op8_mixing, op9_simhash, op10_quality
from omnitally.llm.common import documents, materialize
from omnitally.sources.tables import read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the adaptive quality fences of their language and source."""
    return op10_quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of every SimHash component."""
    return op9_simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return op3_decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents repeated for every epoch of their source, cut at its budget."""
    return op8_mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Positions and checksums of the token ids, read back from the wavelet shards."""
    return op5_tokens.write_and_read(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: The fences come from quantile sketches and the ids from a tokenizer: no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs
