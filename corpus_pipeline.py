"""A corpus pipeline over ``documents``: five stages, each reading what the one before it has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.llm.common import table, written
from skygrid.llm.decontamination import find_contamination, without_spans
from skygrid.llm.line_windows import remove_repeated_windows
from skygrid.llm.quality_crf import score_quality
from skygrid.llm.set_join import similarity_components
from skygrid.llm.source_mixing import mixed_blocks


# What operators read; all other columns pass them under names that no operator adds.
READ = ("doc_id", "text", "source")


def _edited(docs: DataFrame, edit: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``edit`` of ``docs`` with the columns of ``docs`` in their order: a user's column keeps its values whatever its name."""
    away = {c: f"_given_{k}" for k, c in enumerate(docs.columns) if c not in READ}
    return edit(docs.withColumnsRenamed(away)).select([F.col(away.get(c, c)).alias(c) for c in docs.columns])


def _counted(docs: DataFrame) -> DataFrame:
    """The character count made anew where there is one."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain of line labels does not reject. Null and empty texts are rejected."""
    return _edited(docs, lambda d: score_quality(d, table(spark, sf_dir, "labels")).where("predicted = 1"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later occurrences of repeated three-line windows (a text may become empty)."""
    return _counted(_edited(docs, remove_repeated_windows))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of smallest id; rows of one id stay or go together, null ids stay."""
    found = similarity_components(docs)
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words inside occurrences of benchmark phrases."""
    return _counted(_edited(docs, lambda d: without_spans(find_contamination(d, table(spark, sf_dir, "benchmark")))))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mixture: blocks of words by shard and slot, with the ids of the documents they are made of."""
    return mixed_blocks(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

# A fitted chain classifier has no SQL; tests hold every stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
