"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next one's ``docs``.  All but the last
return the columns of ``documents``.

Null, empty or repeated rows, ties, empty tables and extra columns are treated
as each operator's module says; extra columns are carried to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keyflow.llm import decontaminate, line_dedup, near_dup, packing, quality
from keyflow.llm.common import save, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the lines that an earlier line of the corpus matches."""
    return line_dedup.remove_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return near_dup.keep_one(docs, size=5, percent=80)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 1024 tokens."""
    return packing.pack(docs, packing.tokenizer_path("byte_bpe_50k.json"), packing.tokenizer_path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", remove_benchmark),
    ("packing", pack_sequences),
]

#: token ids, tilings and the packing itself are beyond SQL; tests hold every stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what goes between them is written to the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
