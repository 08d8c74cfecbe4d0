"""Documents to training tokens: quality rules, line dedup, near-duplicates, benchmark decontamination, encoding.

Each stage works on all that the one before it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platework.llm import leaks, lines, near, quality, sentencepiece
from platework.llm.common import read, stored
from platework.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Similarity of word shingles from which documents are near-duplicates here; ``op5_near_duplicates`` has its own.
NEAR_PERCENT = 80


def _documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents``, with the length of the text as it is now."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a base rule or are outliers of their language and source go."""
    return _documents(quality.kept_rows(docs))


def _with_words(found: DataFrame) -> DataFrame:
    """Without documents that have lost all their words with lines."""
    return found.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go but for their first place; a document that loses all its words goes."""
    return _documents(_with_words(lines.without_recurring_lines(docs)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the smallest id. Of the long lines that otherwise
    different documents still share, one copy stays."""
    kept = near.one_of_each(docs, percent=NEAR_PERCENT)
    return _documents(_with_words(lines.without_long_lines(kept)))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark go, and documents that are mostly such passages."""
    return _documents(leaks.decontaminated(docs, read(spark, sf_dir, "benchmark")))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its token ids, and whether they decode to its text."""
    found = sentencepiece.encode(docs, tokenizer_path(), decoded=True)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.xxhash64("decoded").eqNullSafe(F.col("text_hash")).alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", encoding),
]
#: Robust estimates, components and segmentations are beyond SQL; ``tests/llm/test_pipeline.py`` has plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
