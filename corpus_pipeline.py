"""The training-corpus pipeline: quality, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read
again as the next stage's documents. All but the last return the columns of documents, whatever
further columns these have; texts are read whole; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm import decontamination, jaccard_join, mixing, quality, sharding
from quarterdeck.llm.base import read, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go (score below 0.3).

    Null and empty texts are scored as texts without words. Rows that repeat a text share its
    verdict; a score of exactly 0.3 stays.
    """
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.scored(docs, model).where("predicted = 1").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal 5-word shingle sets (Jaccard >= 0.8) stays.

    That is the one of the smallest id, nulls last; rows that repeat id and text are one document.
    Null, empty and separator-only texts belong to no group and all stay.
    """
    return jaccard_join.deduplicated(docs, width=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go.

    Null and empty texts leak nothing. Every row of a leaking text goes; null items and items under
    three words are never looked for.
    """
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stays as often as the mix takes it: not at all, once or twice.

    Null sources are a source of their own. Rows that repeat id, source and text get the same
    copies; a source without words is left out.
    """
    return mixing.mixed(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard and its slot there.

    The last stage returns placement rows: id, size, checksum, law, shard, slot, and lang, source
    and n_chars of the document; its text and further columns stay behind. Null texts have size 1;
    repeated rows are placed one by one.
    """
    return sharding.shard_documents(docs, keep=("lang", "source", "n_chars"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing to target weights", mixing_stage),
    ("sharding", sharding_stage),
]

# The classifier, the components and the balanced sample have no SQL form; tests hold each stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
