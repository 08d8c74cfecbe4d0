"""Quality rules: robust multivariate outliers of text statistics, per language and source.

Each text gives a vector of transformed statistics. Location and scatter per (language, source) are those of the
minimum-covariance-determinant estimate: from each of several starts on, the ``SHARE`` of the rows that lie nearest give
the next mean and covariance (a concentration step), as long as the determinant falls by ``MIN_FALL``; the start that ends
with the least determinant counts. That end must come, as floors keep the determinant from falling for ever: no number of
steps is set. The rows within the ``WITHIN`` quantile of that estimate then give the final one. A text is rejected if its
squared Mahalanobis distance exceeds ``CUTOFF``, which a normal text does with a chance of ``TAIL``. The least spreads of
``FEATURES`` are floors: they count only where a group has hardly any spread itself.

A step reads the distinct vectors once: they are counted and summed by bins of distance, and the bin in which the share is
reached counts with the part of its rows that is still wanted, so that a step always holds the share exactly. Vectors are
whole multiples of 1/``UNIT``, so that sums do not depend on the order of rows; no group is gathered anywhere, and a hot
group is summed where its rows are. The final estimate of a group is drawn towards that of all rows with the weight of
``PRIOR_ROWS`` rows, so that small groups need no rule of their own.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platework.llm.common import (
    WordHashes, as_bytes, bound_batches, in_batches, row_hash, same, schemas, sent_if_small, stored, window_hashes,
)

SHARE, TAIL, PRIOR_ROWS = 0.75, 1e-6, 200
#: Least fall of the determinant's logarithm with which steps go on; quantile of the rows that give the final estimate.
MIN_FALL, WITHIN = 1e-4, 0.975
#: Shares of the first step from each start: the medians and quartiles, the same with the inner half first, the plain mean
#: and covariance.
STARTS = (SHARE, 0.5, SHARE)
UNIT = 256
#: Mean word lengths above this count as this, which is far beyond any cutoff.
LONGEST_WORD = 1e5
#: What counts as white space and as a symbol, and the base rules.
SPACES, SYMBOLS = b" \t\n\r\x0b\f", b"#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
#: The transformed statistics, and the least spread of each that counts (in its own units): about what chance makes of
#: texts of 50 words, so that a corpus without repeats does not reject a text for a single one.
FEATURES = {"length": 0.25, "word_length": 0.25, "symbols": 0.03, "repeated_lines": 0.15, "repeated_words": 0.11}
DIMS = len(FEATURES)


def _quantile(tail: float) -> float:
    """The value that chi-square with five degrees of freedom exceeds with a chance of ``tail``."""
    low, high = 0.0, 1_000.0
    for _ in range(100):
        x = (low + high) / 2
        above = math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3)
        low, high = (x, high) if above > tail else (low, x)
    return low


CUTOFF = _quantile(TAIL)
#: Squared distances are counted in bins of a 64th of a power of two.
BINS, LEAST_DISTANCE = 64, 1e-6


def repeated_words(h: np.ndarray) -> int:
    """Words in windows of three words that occur twice or more."""
    if len(h) < 4:
        return 0
    _, place, times = np.unique(window_hashes(h, 3), return_inverse=True, return_counts=True)
    often = np.flatnonzero(times[place] > 1)
    hit = np.zeros(len(h), bool)
    for k in range(3):
        hit[often + k] = True
    return int(hit.sum())


def statistics(df: DataFrame, id_column="doc_id", text_column="text", lang="lang", source="source") -> DataFrame:
    """Per row: the id, ``row_hash``, language, source and the counts of the base rules, over the whole text.

    A null text has no words. Rows that share an id are told apart by ``row_hash``; other columns are not read.
    """
    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(
        F.col(id_column).alias("id"), row_hash(text_column, lang, source).alias("row_hash"),
        F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"),
        F.col(text_column).alias("text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    known = WordHashes()

    def run(batch):
        each = []
        for text in as_bytes(batch["text"]):
            text = text or b""
            words = text.split()
            lines = [x for x in text.split(b"\n") if x.strip()]
            blanks = sum(map(text.count, (bytes([c]) for c in SPACES)))
            symbols = sum(map(text.count, (bytes([c]) for c in SYMBOLS)))
            each.append((
                len(words), len(text.decode()) - blanks, symbols, len(lines) - len(set(lines)),
                repeated_words(known.of(words)), len(lines)))
        counts = zip(names, np.array(each, np.int64).reshape(-1, len(names)).T, strict=True)
        return {c: batch[c] for c in ("id", "row_hash", "lang", "source")} | dict(counts)

    counts = ", ".join(f"{n} long" for n in names)
    return in_batches(rows, run, f"id {kind}, row_hash long, lang string, source string, {counts}")


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def vector() -> list:
    """The transformed statistics in multiples of 1/UNIT: logarithm of the length, mean word length, and square roots
    of shares."""
    part = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    values = [
        F.log1p("n_words"), F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)),
        part("n_symbols", "word_chars"), part("n_dup_lines", "n_lines"), part("n_repeat_words", "n_words")]
    return [F.round(F.least(v, F.lit(LONGEST_WORD)) * UNIT).cast("long").alias(f"x{k}") for k, v in enumerate(values)]


def _pairs() -> list[tuple[int, int]]:
    return [(a, b) for a in range(DIMS) for b in range(a, DIMS)]


def _wide(value):
    """An exact sum of whole numbers."""
    return F.sum(value.cast("decimal(38,0)")).cast("double")


def _sums(vectors: DataFrame, *by: str) -> DataFrame:
    """Counts, sums and sums of products per group: exact, in decimals."""
    x = [F.col(f"x{k}") for k in range(DIMS)]
    return vectors.groupBy("lang", "source", *by).agg(
        F.sum("times").cast("double").alias("n"),
        F.array(*[_wide(F.col("times") * v) for v in x]).alias("s"),
        F.array(*[_wide(F.col("times").cast("decimal(20,0)") * (x[a] * x[b])) for a, b in _pairs()]).alias("q"))


def _estimate(n: float, s: np.ndarray, q: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance from sums; trimming to the nearest rows makes scatter smaller, which is made up for."""
    mean = s / n
    cov = np.zeros((DIMS, DIMS))
    for (a, b), value in zip(_pairs(), q, strict=True):
        cov[a, b] = cov[b, a] = value / n - mean[a] * mean[b]
    return mean / UNIT, cov / UNIT**2 * _consistency(share)


@cache
def _consistency(share: float) -> float:
    """Factor by which normal scatter shrinks when the nearest ``share`` of the rows is kept, inverted: from chi-square
    draws with a fixed seed."""
    if share >= 1:
        return 1.0
    d2 = np.sort(np.random.default_rng(0).chisquare(DIMS, 200_000))
    return DIMS / d2[: int(share * len(d2))].mean()


def _floored(cov: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The covariance with no spread, in any direction, below the least ones; unchanged where there is none."""
    values, axes = np.linalg.eigh(cov / np.outer(least, least))
    if values[0] >= 1:
        return cov
    return (axes * np.maximum(values, 1)) @ axes.T * np.outer(least, least)


def estimates(sums: DataFrame, pooled: DataFrame, share: float, prior: float = PRIOR_ROWS) -> DataFrame:
    """Per group its mean and inverse covariance, drawn towards the pooled ones. ``pooled`` is one row."""
    row = pooled.first()
    if row is None or not row.n:
        all_mean, all_cov = np.zeros(DIMS), np.eye(DIMS)
    else:
        all_mean, all_cov = _estimate(row.n, np.array(row.s), np.array(row.q), share)
    least = np.array(list(FEATURES.values()))

    def run(batch):
        means, inverses = [], []
        for n, s, q in zip(*(batch[c].to_pylist() for c in ("n", "s", "q")), strict=True):
            mean, cov = _estimate(n, np.array(s), np.array(q), share)
            w = n / (n + prior)
            means.append((w * mean + (1 - w) * all_mean).tolist())
            inverses.append(np.linalg.inv(_floored(w * cov + (1 - w) * all_cov, least)).ravel().tolist())
        return {"lang": batch["lang"], "source": batch["source"], "mean": means, "inverse": inverses}

    return in_batches(sums, run, "lang string, source string, mean array<double>, inverse array<double>")


def distance():
    """Squared Mahalanobis distance of a row to its group's estimate."""
    gap = [F.col(f"x{k}") / UNIT - F.col("mean")[k] for k in range(DIMS)]
    terms = [
        gap[a] * gap[b] * F.col("inverse")[a * DIMS + b] * (1 if a == b else 2) for a, b in _pairs()]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return F.greatest(out, F.lit(0.0))


def _bin():
    return F.floor(F.log2(F.greatest(F.col("d2"), F.lit(LEAST_DISTANCE))) * BINS).cast("int")


def _with_distance(vectors: DataFrame, found: DataFrame, *more: str) -> DataFrame:
    return vectors.join(found, same(vectors, found, "lang", "source")).select(
        vectors["*"], found["mean"], found["inverse"], *[found[c] for c in more]).withColumn("d2", distance())


_STATE = "lang string, source string, start int, mean array<double>, inverse array<double>, logdet double, share double, active boolean"


def _step(vectors: DataFrame, found: DataFrame, share: float, min_fall: float) -> DataFrame:
    """One concentration step from each estimate of ``found``: where the determinant falls the new one, else the old one,
    no longer ``active``. The bins of a group and start, some thousands at most, are read in their order by one task."""
    binned = _sums(_with_distance(vectors, found, "start").withColumn("bin", _bin()), "start", "bin")
    old = found.alias("old")
    ordered = binned.join(old, same(binned, found, "lang", "source", "start")).select(
        binned["*"], *[F.col(f"old.{c}") for c in ("mean", "inverse", "logdet", "share")],
    ).repartition("lang", "source", "start").sortWithinPartitions("lang", "source", "start", "bin")
    kinds, arrow = schemas(_STATE)
    least = np.array(list(FEATURES.values()))

    def run(batches):
        out, now, bins = [], None, []

        def close():
            first = bins[0]
            new_mean, cov = nearest(
                *(np.array([r[c] for r in bins], np.float64) for c in ("n", "s", "q")), first["share"])
            cov = _floored(cov, least)
            logdet = float(np.linalg.slogdet(cov)[1])
            fell = logdet < first["logdet"] - min_fall
            # after a first step with another share the determinants do not compare
            inner = first["share"] != share
            out.append({
                **dict(zip(("lang", "source", "start"), now, strict=True)), "share": share, "active": fell,
                "mean": new_mean.tolist() if fell else first["mean"],
                "inverse": np.linalg.inv(cov).ravel().tolist() if fell else first["inverse"],
                "logdet": (float("inf") if inner else logdet) if fell else first["logdet"]})

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["lang"], row["source"], row["start"])
                if key != now:
                    if bins:
                        close()
                    now, bins = key, []
                bins.append(row)
        if bins:
            close()
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    bound_batches(vectors.sparkSession)
    return ordered.mapInArrow(run, kinds)


def nearest(n: np.ndarray, s: np.ndarray, q: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of the ``share`` of the rows in the nearest bins, whose counts and sums these are; the bin in
    which it is reached counts with the part that is wanted."""
    before = np.concatenate([[0.0], np.cumsum(n)[:-1]])
    part = np.clip((share * n.sum() - before) / n, 0, 1)
    return _estimate(share * n.sum(), part @ s, part @ q, share)


def concentrated(vectors: DataFrame, share: float = SHARE, min_fall: float = MIN_FALL) -> DataFrame:
    """Per group the mean and inverse covariance of the estimate with the least determinant. ``vectors`` is stored."""
    middle, plain = _middle(vectors), _sums(vectors)
    wide = plain.select("lang", "source", F.lit(2).alias("start"), "n", "s", "q")
    least = np.array(list(FEATURES.values()))

    def classical(batch):
        means, inverses = [], []
        for n, s, q in zip(*(batch[c].to_pylist() for c in ("n", "s", "q")), strict=True):
            mean, cov = _estimate(n, np.array(s), np.array(q), 1.0)
            means.append(mean.tolist())
            inverses.append(np.linalg.inv(_floored(cov, least)).ravel().tolist())
        return {c: batch[c] for c in ("lang", "source", "start")} | {"mean": means, "inverse": inverses}

    third = in_batches(wide, classical, "lang string, source string, start int, mean array<double>, inverse array<double>")
    starts = middle.select(
        "lang", "source", F.explode(F.array(F.lit(0), F.lit(1))).alias("start"), "mean", "inverse").unionByName(third)
    shares = F.element_at(F.array(*[F.lit(x) for x in STARTS]), F.col("start") + 1)
    found = stored(starts.select(
        "*", F.lit(float("inf")).alias("logdet"), shares.alias("share"), F.lit(True).alias("active")), "starts")
    ended = None
    while True:
        found = stored(_step(vectors, sent_if_small(found, "mean", "inverse"), share, min_fall), "estimates")
        done = found.where(~F.col("active"))
        ended = done if ended is None else ended.unionByName(done)
        found = found.where("active")
        if found.isEmpty():
            break
    best = ended.groupBy("lang", "source").agg(F.min(F.struct("logdet", "start", "mean", "inverse")).alias("best"))
    return best.select("lang", "source", "best.mean", "best.inverse")


def _middle(vectors: DataFrame) -> DataFrame:
    """Start: per group the median and the spread (from quartiles) of each statistic, as a diagonal covariance."""
    long = vectors.select("lang", "source", "times", F.posexplode(F.array(*[f"x{k}" for k in range(DIMS)])).alias("k", "x"))
    counted = long.groupBy("lang", "source", "k", "x").agg(F.sum("times").alias("count"))
    each = Window.partitionBy("lang", "source", "k")
    run = counted.withColumns({
        "before": F.sum("count").over(each.orderBy("x")), "all": F.sum("count").over(each)})
    at = lambda p: F.min(F.when(F.col("before") >= F.ceil(F.col("all") * p), F.col("x"))) / UNIT
    found = run.groupBy("lang", "source", "k").agg(at(0.25).alias("lo"), at(0.5).alias("mid"), at(0.75).alias("hi"))
    least = F.array(*[F.lit(float(v)) for v in FEATURES.values()])
    spread = F.greatest((F.col("hi") - F.col("lo")) / 1.349, F.element_at(least, F.col("k") + 1))
    return found.withColumn("spread", spread).groupBy("lang", "source").agg(
        F.sort_array(F.collect_list(F.struct("k", "mid", "spread"))).alias("all")).select(
        "lang", "source", F.col("all.mid").alias("mean"),
        F.array(*[
            1 / F.pow(F.col("all")[a]["spread"], 2) if a == b else F.lit(0.0)
            for a in range(DIMS) for b in range(DIMS)]).alias("inverse"))


def judged(
    df: DataFrame, id_column="doc_id", text_column="text", lang="lang", source="source", share: float = SHARE,
    min_fall: float = MIN_FALL, cutoff: float = CUTOFF,
) -> DataFrame:
    """Per row: the id, ``row_hash``, the counts, ``base_failed``, ``d2`` and ``kept``.

    The estimates are made from the rows that pass the base rules; where a group has none, nothing is kept or judged
    by it. Null languages and sources are groups of their own. Repeated rows count each; rows with equal statistics fall on
    one side together; an empty table gives an empty result.
    """
    stats = statistics(df, id_column, text_column, lang, source)
    rows = stored(stats.select("*", base_failed().alias("base_failed"), *vector()), "statistics")
    vectors = stored(rows.where(~F.col("base_failed")).groupBy("lang", "source", *[f"x{k}" for k in range(DIMS)]).agg(
        F.count(F.lit(1)).alias("times")), "vectors")
    robust = stored(concentrated(vectors, share, min_fall), "estimates")
    within = _with_distance(vectors, sent_if_small(robust, "mean", "inverse")).where(
        F.col("d2") <= _quantile(1 - WITHIN)).drop("mean", "inverse", "d2")
    sums = stored(_sums(within), "sums")
    pooled = sums.agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[k]) for k in range(DIMS)]).alias("s"),
        F.array(*[F.sum(F.col("q")[k]) for k in range(len(_pairs()))]).alias("q"))
    found = sent_if_small(stored(estimates(sums, pooled, WITHIN), "estimates"), "mean", "inverse")
    judged_rows = rows.join(found, same(rows, found, "lang", "source"), "left").select(
        rows["*"], found["mean"], found["inverse"]).withColumn("d2", distance())
    return judged_rows.select(
        F.col("id").alias(id_column), "row_hash", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "d2",
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(True))).alias("kept"))


def kept_rows(df: DataFrame, id_column="doc_id", text_column="text", lang="lang", source="source", **options) -> DataFrame:
    """The rows of ``df`` that are kept, with all their columns."""
    out = judged(df, id_column, text_column, lang, source, **options).where(~F.col("kept"))
    out = out.select(F.col(id_column).alias("__id"), F.col("row_hash").alias("__hash")).distinct()
    rows = df.withColumns({"__id": F.col(id_column), "__hash": row_hash(text_column, lang, source)})
    return rows.join(out, same(rows, out, "__id", "__hash"), "left_anti").select(*[f"`{c}`" for c in df.columns])
