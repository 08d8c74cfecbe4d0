"""Left joins against lookups and dimensions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 500_000
_KEYLESS_PARTS = 1 << 20


def _any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


@dataclass(frozen=True)
class LookupSize:
    rows: int
    repeated_keys: int


def measure_lookup(lookup: DataFrame, keys: list[str]) -> LookupSize:
    """Row count and number of keys used more than once, in one pass over the key columns."""
    per_key = lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") > 1).alias("repeated")
    ).first()
    return LookupSize(row["rows"], row["repeated"])


def left_lookup(df: DataFrame, lookup: DataFrame, on: dict[str, str]) -> DataFrame:
    """Left equi join; ``on`` maps columns of ``df`` to the lookup's, whose key columns are dropped.

    Without a broadcast mark the strategy is Spark's: broadcast below its size threshold, else a
    shuffle join that adaptive execution may still turn round or split.
    """
    renamed = {right: f"__key_{i}" for i, right in enumerate(on.values())}
    lookup = lookup.withColumnsRenamed(renamed)
    condition = [df[left] == lookup[renamed[right]] for left, right in on.items()]
    return df.join(lookup, condition, "left").drop(*renamed.values())


def spread_left_join(
    df: DataFrame, lookup: DataFrame, on: dict[str, str], rows_per_task: int = ROWS_PER_TASK, hint: str | None = None
) -> DataFrame:
    """``left_lookup`` by shuffle in which no key sits in one task, however many rows it holds.

    Keys are counted once. The rows of a key with more than ``rows_per_task`` are dealt over as many parts as that
    takes, rows without a key over ever so many, and only the lookup rows of dealt keys are copied, to each of their
    parts. How the counts meet rows and lookup is left to Spark, and so is the join unless ``hint`` names a strategy.
    Nothing is dropped or sampled.
    """
    keyless = _any_of(F.col(left).isNull() for left in on)
    per_key = df.where(~keyless).groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    names = {left: f"__hot_{i}" for i, left in enumerate(on)}
    hot = per_key.where(F.col("__n") > rows_per_task).select(
        *[F.col(left).alias(name) for left, name in names.items()],
        F.ceil(F.col("__n") / rows_per_task).cast("int").alias("__parts"),
    )
    parts = F.when(keyless, F.lit(_KEYLESS_PARTS)).otherwise(F.coalesce("__parts", F.lit(1)))
    rows = df.join(hot, [F.col(left) == F.col(name) for left, name in names.items()], "left").withColumn(
        "__part", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), parts.cast("long")).cast("int")
    )
    dealt = (
        lookup.join(hot, [F.col(right) == F.col(names[left]) for left, right in on.items()], "left")
        .withColumn("__lookup_part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)))
        .drop(*names.values(), "__parts")
    )
    if hint:
        dealt = dealt.hint(hint)
    joined = left_lookup(rows.drop(*names.values(), "__parts"), dealt, {**on, "__part": "__lookup_part"})
    return joined.drop("__part")


#: Keys that are told apart as hot, at most; the sketch tracks many more, so that counts are off by a small share only.
HOT_KEYS, TRACKED = 64, 4096


def hot_keys(column: str) -> Column:
    """An aggregate to observe while a table is written: its most frequent keys with their approximate counts."""
    return F.expr(f"approx_top_k(`{column}`, {HOT_KEYS}, {TRACKED})")


def dealt_left_join(
    df: DataFrame, lookup: DataFrame, left: str, right: str, hot: list[tuple[object, int]], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``spread_left_join`` on one key whose frequent values are known, as from ``hot_keys``: ``df`` is read once, and only
    the rows of values with more than ``rows_per_task`` rows, and those without a key, are dealt out.

    The counts only say how many parts a value is dealt over, so rows are right whatever the sketch has missed.
    """
    parts = {k: -(-n // rows_per_task) for k, n in hot if k is not None and n > rows_per_task}
    deal = F.when(F.col(left).isNull(), F.lit(_KEYLESS_PARTS))
    copies = F.lit(1)
    for value, n in parts.items():
        deal = deal.when(F.col(left) == F.lit(value), F.lit(n))
        copies = F.when(F.col(right) == F.lit(value), F.lit(n)).otherwise(copies)
    rows = df.withColumn("__part", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), deal.otherwise(1).cast("long")).cast("int"))
    dealt = lookup.withColumn("__lookup_part", F.explode(F.sequence(F.lit(0), copies - 1)))
    return left_lookup(rows, dealt, {left: right, "__part": "__lookup_part"}).drop("__part")


def unique_lookup(df: DataFrame, lookup: DataFrame, on: dict[str, str]) -> DataFrame:
    """Left join against a lookup whose keys are counted first: a repeated one would multiply rows, so it raises.

    Whether the lookup is broadcast is left to Spark's estimate of its bytes.
    """
    repeated = measure_lookup(lookup, list(on.values())).repeated_keys
    if repeated:
        raise ValueError(f"lookup has {repeated} repeated key(s) on {list(on.values())}")
    return left_lookup(df, lookup, on)
