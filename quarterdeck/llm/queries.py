"""One registered query per operator, over the operator's whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm import jaccard_join, source_audit, url_filter
from quarterdeck.llm.base import read
from quarterdeck.llm.decontamination import find_leaks
from quarterdeck.llm.jaccard_join import shingle_groups
from quarterdeck.llm.language_id import language_report
from quarterdeck.llm.mixing import mix_sources
from quarterdeck.llm.personal_data import personal_data_report
from quarterdeck.llm.quality import quality_scores
from quarterdeck.llm.repeats import repeat_report
from quarterdeck.llm.secret_scan import secret_report
from quarterdeck.llm.sharding import shard_documents
from quarterdeck.llm.spelling import group_spellings
from quarterdeck.llm.weighted_sampling import compare_neighbours


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item, verbatim or re-parameterised."""
    leaks = find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return leaks.drop("doc_key")


def op2_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The balanced mix of all sources to their target weights."""
    return mix_sources(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_ngram_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents."""
    return language_report(read(spark, sf_dir, "documents"))


def op4_consistent_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, their edited texts and their likeness to the next one."""
    return compare_neighbours(read(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that occur elsewhere."""
    return repeat_report(read(spark, sf_dir, "documents"))


def op6_quadratic_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_temporal_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict under the list entries active at its fetch time."""
    pages = read(spark, sf_dir, "pages")
    return url_filter.filter_captures(url_filter.page_captures(pages), url_filter.page_list(pages))


def op8_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return secret_report(read(spark, sf_dir, "documents"))


def op9_bounded_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 7 of all documents by the bounded consistent-hash ring."""
    return shard_documents(read(spark, sf_dir, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connected components of documents with a 3-word shingle Jaccard of at least 0.9."""
    return shingle_groups(read(spark, sf_dir, "documents"))


def op11_prefix_suffix_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frequent words of all documents and the forms that they are single edits of."""
    return group_spellings(read(spark, sf_dir, "documents"))


def op12_perfect_hash_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share differences between the sources of each language, and their leading terms."""
    return source_audit.audit_sources(read(spark, sf_dir, "documents"))


def op13_deobfuscated_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents, plain or disguised."""
    return personal_data_report(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_template_decontamination": op1_template_decontamination,
    "op2_cube_mixing": op2_cube_mixing,
    "op3_ngram_language_id": op3_ngram_language_id,
    "op4_consistent_weighted_sampling": op4_consistent_weighted_sampling,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_quadratic_quality": op6_quadratic_quality,
    "op7_temporal_url_filter": op7_temporal_url_filter,
    "op8_secret_automaton": op8_secret_automaton,
    "op9_bounded_ring_sharding": op9_bounded_ring_sharding,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_prefix_suffix_tiling": op11_prefix_suffix_tiling,
    "op12_perfect_hash_audit": op12_perfect_hash_audit,
    "op13_deobfuscated_pii": op13_deobfuscated_pii,
}

ORACLE: dict[str, str] = {
    "op7_temporal_url_filter": url_filter.ORACLE,
    "op10_ngram_jaccard_join": jaccard_join.ORACLE,
    "op12_perfect_hash_audit": source_audit.ORACLE,
}
