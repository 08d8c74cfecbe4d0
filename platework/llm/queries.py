"""The queries of this package, each over the whole of its tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platework.llm import (
    extraction, leaks, lines, near, oracles, quality, secret_spans, sentencepiece, substrings, suffix_arrays, token_counts,
    turns, variants, warc,
)
from platework.llm.common import read
from platework.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "piece_bpe_32k.model", folder: str = "/opt/tokenizers") -> str:
    return f"{folder}/{name}"


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of tokens and chunks, a hash of the ids, and whether decoding gives the text back."""
    docs = read(spark, sf_dir, "documents")
    encoded = sentencepiece.encode(docs, tokenizer_path(), decoded=True)
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "n_chunks", F.xxhash64("ids").alias("ids_hash"),
        F.xxhash64("decoded").alias("decoded_hash"),
        (F.xxhash64("decoded") == F.col("text_hash")).alias("round_trip"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of tokens and the score of the best segmentation."""
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), tokenizer_path())


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as ARC archives, converted to WARC archives and read back."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = warc.round_trip(pages, new_folder(spark, "arc"), new_folder(spark, "warc"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, dropped lines and the hash of what is left."""
    kept = lines.without_recurring_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: size of its shingle set, its component and whether it is the one kept of it."""
    return near.near_duplicates(read(spark, sf_dir, "documents")).drop("text_hash")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: its main text."""
    return extraction.main_text(read(spark, sf_dir, "pages"))


def op7_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes, removed bytes and runs of them, and the hash of what is left."""
    return suffix_arrays.without_repeats(read(spark, sf_dir, "documents")).drop("kept")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the counts of the base rules, the squared distance to its group and the verdict."""
    found = quality.judged(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words in occurrences of item windows, and the items that these come from."""
    found = leaks.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    hit = leaks.hit_words()
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, removed words and the hash of what is left."""
    return substrings.without_repeats(read(spark, sf_dir, "documents")).drop("kept")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation, after damage: its faults and the cheapest repair."""
    conversations = read(spark, sf_dir, "conversations")
    return turns.repaired(turns.damaged(conversations), conversations)


def op12_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: secrets by kind, and where they stand."""
    found = secret_spans.scan(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in secret_spans.KINDS],
        F.sha2(secret_spans.written("spans", "assign", "access", "hex"), 256).alias("base_sha256"),
        secret_spans.written("spans").alias("spans"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per word: its occurrences, near words, usual form and the last of the forms."""
    return variants.variants(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_sentencepiece, op2_warc, op3_line_dedup, op4_token_counts, op5_near_duplicates, op6_main_text,
    op7_suffix_arrays, op8_quality_rules, op9_decontamination, op10_substrings, op11_conversation_repair,
    op12_secret_scans, op13_spelling_variants)}
ORACLES: dict[str, str] = {
    "op2_warc": oracles.WARC, "op3_line_dedup": oracles.LINES, "op5_near_duplicates": oracles.NEAR,
    "op7_suffix_arrays": oracles.BYTES, "op9_decontamination": oracles.LEAKS, "op10_substrings": oracles.WORDS}
