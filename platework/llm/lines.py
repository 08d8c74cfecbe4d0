"""Line dedup by a log-template tree, in DataFrame functions only.

A line goes down a tree of fixed depth: number of tokens, then its leading tokens, with tokens that hold a digit read
as variable. Where too few documents share the leading tokens for a template to recur, one of them may be a variable
field, and the line goes down by its trailing tokens instead. The lines that meet in a leaf share templates where they
agree: a token that ``min_docs`` documents' lines, and a share of the leaf's, have at a place is constant there, any other
is the value of a variable field. What is left of a line with its values masked is its template, so that a leaf has as
many as its lines agree on, if enough of the places are constant; else the line is a template of its own. Templates found
in ``min_docs`` documents or more are dropped everywhere but where they stand first (smallest document, first line).

Lines are counted per leaf and distinct line before tokens are looked at, so a line that a third of all documents hold
is one row by then; joins on leaves and lines are plain equi-joins that Spark can split.

``without_long_lines`` is for passages: a line of ``LONG_WORDS`` words or more, taken literally, is dropped from its
second document on. It belongs after near-duplicates are gone: before, it would leave the short lines of copies behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platework.llm.common import row_hash, same, stored

DEPTH, MIN_DOCS, MIN_CONSTANT = 3, 10, 0.6
#: Part of a leaf's documents that have a constant token at least: a leaf holds up to as many templates as fit.
MIN_SHARE = 0.05
#: Words from which a line is a passage, and documents from which that recurs.
LONG_WORDS, LONG_MIN_DOCS = 8, 2
VARIABLE = "<*>"
_BLANKS = " \t\r\f\x0b"


def parsed_lines(df: DataFrame, id_column: str, text_column: str, depth: int) -> DataFrame:
    """A row per line with a token: document, place, tokens with variable fields, leaves by leading and by trailing tokens,
    and line."""
    rows = df.select(
        F.col(id_column).alias("id"), row_hash(text_column).alias("text_hash"),
        F.posexplode(F.split(F.col(text_column), "\n")).alias("pos", "line"))
    line = F.btrim("line", F.lit(_BLANKS))
    masked = F.when(
        F.col("line").rlike("[0-9]"), F.regexp_replace("line", r"(?<!\S)[^\s0-9]*+[0-9]\S*", VARIABLE),
    ).otherwise(F.col("line"))
    found = rows.withColumn("line", line).where("line != ''").withColumn("tokens", F.split(masked, r"\s+"))
    return found.select(
        "id", "text_hash", "pos", "tokens",
        F.xxhash64(F.size("tokens"), F.slice("tokens", 1, depth)).alias("lead"),
        F.xxhash64(F.size("tokens"), F.slice(F.reverse("tokens"), 1, depth), F.lit("trailing")).alias("trail"),
        F.xxhash64("tokens").alias("line"))


def templates(lines: DataFrame, keys: DataFrame, min_docs: int, min_constant: float, min_share: float) -> DataFrame:
    """Per distinct line of a leaf that may hold a recurring template: (line, leaf, template)."""
    counted = stored(keys.select("id", "text_hash", "lead", "trail", "line").distinct().groupBy("lead", "trail", "line").agg(
        F.count("*").alias("n_docs")), "distinct-lines")
    leading = stored(counted.groupBy("lead").agg(F.sum("n_docs").alias("lead_docs")).where(F.col("lead_docs") >= min_docs), "leads")
    placed = stored(counted.join(leading, "lead", "left").select(
        "line", "n_docs", F.when(F.col("lead_docs").isNull(), F.col("trail")).otherwise(F.col("lead")).alias("leaf")), "leaves")
    busy = stored(placed.groupBy("leaf").agg(F.sum("n_docs").alias("all_docs")).where(F.col("all_docs") >= min_docs), "busy")
    wanted = stored(placed.join(busy, "leaf"), "lines")
    tokens = lines.select("line", "tokens").join(wanted.select("line"), "line").groupBy("line").agg(F.first("tokens").alias("tokens"))
    known = stored(tokens.join(wanted, "line"), "tokens")
    each = known.select("leaf", "all_docs", "n_docs", F.posexplode("tokens").alias("place", "token"))
    constant = each.groupBy("leaf", "place", "token").agg(
        F.sum("n_docs").alias("n"), F.first("all_docs").alias("all_docs"),
    ).where((F.col("n") >= min_docs) & (F.col("n") >= min_share * F.col("all_docs")))
    # at most 1 / min_share tokens a place
    shape = stored(constant.groupBy("leaf").agg(F.collect_set(F.struct("place", "token")).alias("shape")), "shapes")
    matched = known.join(shape, "leaf", "left")
    masked = F.transform("tokens", lambda t, k: F.when(
        F.array_contains("shape", F.struct(k.alias("place"), t.alias("token"))), t))
    constants = F.size(F.filter("masked", lambda t: t.isNotNull()))
    of = matched.withColumn("masked", masked)
    belongs = F.col("shape").isNotNull() & (constants >= min_constant * F.size("tokens"))
    return of.select(
        "line", "leaf", F.when(belongs, F.xxhash64(F.lit(0), "masked")).otherwise(F.col("line")).alias("template"))


def dropped_lines(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", depth: int = DEPTH, min_docs: int = MIN_DOCS,
    min_constant: float = MIN_CONSTANT, min_share: float = MIN_SHARE,
) -> DataFrame:
    """Per document with dropped lines: id, ``text_hash`` and ``dropped`` (places of lines, from 0, ascending)."""
    lines = parsed_lines(df, id_column, text_column, depth)
    keys = stored(lines.drop("tokens"), "line-keys")
    of = stored(templates(lines, keys, min_docs, min_constant, min_share), "line-templates")
    named = stored(keys.select("id", "text_hash", "pos", "line").join(of, "line").select(
        "id", "text_hash", "pos", "leaf", "template"), "templates")
    return _recurring_places(named, min_docs)


def dropped_long_lines(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = LONG_WORDS,
    min_docs: int = LONG_MIN_DOCS,
) -> DataFrame:
    """As ``dropped_lines``, of literal lines: those that agree in all tokens, digits too, ``words`` of them at least."""
    rows = df.select(
        F.col(id_column).alias("id"), row_hash(text_column).alias("text_hash"),
        F.posexplode(F.split(F.col(text_column), "\n")).alias("pos", "line"))
    tokens = F.split(F.btrim("line", F.lit(_BLANKS)), r"\s+")
    found = rows.select("id", "text_hash", "pos", tokens.alias("tokens")).where(F.size("tokens") >= words)
    return _recurring_places(stored(found.select(
        "id", "text_hash", "pos", F.xxhash64(F.lit(1), "tokens").alias("leaf"), F.xxhash64("tokens").alias("template")),
        "long-lines"), min_docs)


def _recurring_places(named: DataFrame, min_docs: int) -> DataFrame:
    """Per document the places of lines (``leaf``, ``template``) that stand in ``min_docs`` documents, but for the first
    place of each."""
    recurring = stored(named.groupBy("leaf", "template", "id", "text_hash").agg(F.min("pos").alias("pos")).groupBy(
        "leaf", "template").agg(
        F.count("*").alias("n_docs"), F.min(F.struct("id", "text_hash", "pos")).alias("first"),
    ).where(F.col("n_docs") >= min_docs), "recurring")
    found = named.join(recurring, ["leaf", "template"]).where(~F.struct("id", "text_hash", "pos").eqNullSafe(F.col("first")))
    return found.groupBy("id", "text_hash").agg(
        F.array_sort(F.array_distinct(F.collect_list("pos"))).alias("dropped"))


def without_recurring_lines(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``df`` with all their columns, the text without dropped lines, ``n_lines`` and ``n_dropped``.

    Null texts stay null and empty ones empty (no lines, none dropped). Lines without a token are never dropped. Rows
    equal in id and text are one document that repeats: each copy is treated alike. Rows that only share an id are
    documents of their own. An empty table gives an empty result. A column named like a result is replaced by it.
    """
    return _without(df, dropped_lines(df, id_column, text_column, **options), id_column, text_column)


def without_long_lines(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """As ``without_recurring_lines``, by ``dropped_long_lines``."""
    return _without(df, dropped_long_lines(df, id_column, text_column, **options), id_column, text_column)


def _without(df: DataFrame, found: DataFrame, id_column: str, text_column: str) -> DataFrame:
    rows = df.withColumns({"__id": F.col(id_column), "__hash": row_hash(text_column)})
    joined = rows.join(
        found, rows["__id"].eqNullSafe(found["id"]) & (rows["__hash"] == found["text_hash"]), "left",
    ).select(rows["*"], found["dropped"].alias("__dropped"))
    lines, drop = F.split(F.col(text_column), "\n"), F.col("__dropped")
    kept = F.array_join(F.filter(lines, lambda line, k: ~F.array_contains(drop, k)), "\n")
    counted = joined.withColumns({
        "n_lines": F.when(F.coalesce(text_column, F.lit("")) == "", 0).otherwise(F.size(lines)).cast("long"),
        "n_dropped": F.when(drop.isNull(), 0).otherwise(F.size(drop)).cast("long"),
        text_column: F.when(drop.isNull(), F.col(text_column)).otherwise(kept)})
    return counted.drop("__id", "__hash", "__dropped")
