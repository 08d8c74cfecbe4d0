"""Spelling variants: words that differ in one code point, found by grams of variable length, and their usual forms.

The gram dictionary holds what is frequent among the words. A word is taken apart into grams that grow until they are
rare, so that the lists of words per gram stay short. For each word and each part of it the bounds on what one edit can
touch name the grams that stay whatever is edited there; a near word has all of them for the part in which the two first
differ. So the lists of these grams are merged to the words that are in all of them, split by the text outside that part,
and every pair left is verified.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platework.llm.common import in_batches, stored

RUN = "[A-Za-zÀ-ÿ]"
MIN_LENGTH, MIN_COUNT, TIMES = 7, 2, 10
#: Every so manyth run, by crc32, loses a code point.
DAMAGED = 31
#: Lengths of grams; the longest are cut further for short words. Grams of up to ``LONGEST - 1`` may be in the dictionary.
SHORTEST, LONGEST = 2, 8
#: Parts of a word, in one of which a pair first differs.
ZONES = 4
#: A gram is frequent above so many places, or above a share of all places that leaves at most so many frequent grams of a
#: length: that bounds the dictionary, which goes through the driver, whatever the size of the table.
MIN_LIST, FREQUENT = 32, 100_000
_BEGIN, _END = "^", "$"


def words(docs: DataFrame, damaged: int | None = DAMAGED, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the distinct words and how often they occur, those of at least ``min_length`` code points and
    ``min_count`` occurrences. Where ``damaged`` divides the crc32 h of ``doc_id:word``, the word loses its code point
    h % length first. Null ids count as one space."""
    run = F.explode(F.regexp_extract_all("text", F.lit(f"({RUN}{{{min_length},}})"), F.lit(1)))
    runs = docs.select(F.col("doc_id").cast("string").alias("id"), run.alias("run")).select(
        "id", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("word"))
    if damaged is not None:
        h = F.crc32(F.concat(F.coalesce("id", F.lit(" ")), F.lit(":"), F.col("word")))
        runs = runs.select("word", h.alias("h")).select(F.when(
            F.col("h") % damaged == 0, F.expr(
                "concat(substring(word, 1, cast(h % length(word) as int)), substring(word, cast(h % length(word) as int) + 2))")
        ).otherwise(F.col("word")).alias("word")).where(F.length("word") >= min_length)
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def frequent_grams(found: DataFrame) -> frozenset[str]:
    """The grams of padded words that are frequent. All that are part of a frequent one are frequent."""
    padded = found.select(F.concat(F.lit(_BEGIN), "word", F.lit(_END)).alias("word"))
    places = found.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    least = max(MIN_LIST, places // FREQUENT)
    grams = F.explode(F.flatten(F.transform(
        F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST - 1), F.length("word"))),
        lambda size: F.transform(
            F.sequence(F.lit(1), F.length("word") - size + 1), lambda at: F.substr(F.col("word"), at, size)))))
    counted = padded.select(grams.alias("gram")).groupBy("gram").count().where(F.col("count") > least)
    return frozenset(r[0] for r in counted.select("gram").collect())


class Grams:
    """Words taken apart by a dictionary. Of a pair of near words, ``size`` is the length of the shorter, in both."""

    def __init__(self, frequent: frozenset[str]):
        self.frequent = frequent

    @staticmethod
    def longest(size: int) -> int:
        """No gram is longer than half of the padded word, so that the first gram or the last is beyond any one edit."""
        return min(LONGEST, (size + 2) // 2)

    @staticmethod
    def zones(size: int) -> list[tuple[int, int]]:
        """The places of the padded word in ``ZONES`` parts: first, one after the last."""
        ends = [(size + 2) * k // ZONES for k in range(ZONES + 1)]
        return list(zip(ends, ends[1:], strict=False))

    def _grows(self, gram: str, longest: int) -> bool:
        return len(gram) < longest and (len(gram) < SHORTEST or gram in self.frequent)

    def of(self, word: str, longest: int) -> list[tuple[int, str]]:
        """(place, gram), each the shortest rare one from its place on, without those inside the one before."""
        out, reach = [], 0
        for at in range(len(word) - SHORTEST + 1):
            end = at + SHORTEST
            while end < len(word) and self._grows(word[at:end], longest):
                end += 1
            if end > reach:
                out.append((at, word[at:end]))
                reach = end
        return out

    def keys(self, word: str, size: int) -> list[tuple[str, str, str]]:
        """Of the pairs whose shorter word has ``size`` code points, for each zone: the grams, with their places, that no
        edit in that zone can touch, and what stands before and behind it. Two near words share all of these for the zone
        in which they first differ.

        An edit changes grams that hold it, those to its left that could grow over it, with all that lie inside such, and
        those to its right that could be inside one grown from its left. No zone leaves a word without grams.
        """
        longest, padded = self.longest(size), _BEGIN + word + _END
        grams, n, out = self.of(padded, longest), len(padded), []
        for first, end in self.zones(size):
            grown = next(
                (p for p in range(max(0, first - longest + 1), first) if self._grows(padded[p:first], longest)), first)
            # places behind the zone are counted from the end
            behind = n - (size + 2 - end)
            swallowed = behind + 1
            while swallowed < n and swallowed - behind + 2 <= longest and self._part(padded[behind:swallowed]):
                swallowed += 1
            stay = "|".join([
                *[f"{at}<{g}" for at, g in grams if at < grown],
                *[f"{n - at - len(g)}>{g}" for at, g in grams if at >= behind and at + len(g) > swallowed]])
            out.append((stay, padded[:first], padded[behind:]))
        return out

    def _part(self, gram: str) -> bool:
        return len(gram) < SHORTEST or gram in self.frequent


def _index(found: DataFrame) -> DataFrame:
    """(size, zone, list, word, n): a word in the merged list of each zone's grams, among words of its own length and of
    one less. A list is split by the text outside the zone, so that verifying begins with the join and no list is gone
    through pair by pair; lists go by hashes, and what else falls into one is verified like the rest."""
    grams = found.sparkSession.sparkContext.broadcast(frequent_grams(found))
    known = {}

    def run(batch):
        takes = known.get(0) or known.setdefault(0, Grams(grams.value))
        sizes, lists = [], []
        words = batch["word"].to_pylist()
        for word in words:
            for size in (len(word), len(word) - 1):
                sizes.append(size)
                lists += [xxhash.xxh3_64_intdigest(f"{size} {' '.join(k)}") for k in takes.keys(word, size)]
        rows = pa.array(np.repeat(np.arange(len(words), dtype=np.int32), 2 * ZONES))
        return {
            "size": np.repeat(np.array(sizes, np.int32), ZONES), "zone": np.tile(np.arange(ZONES, dtype=np.int32), len(sizes)),
            "list": np.array(lists, np.uint64).view(np.int64), "word": batch["word"].take(rows), "n": batch["n"].take(rows)}

    return in_batches(found, run, "size int, zone int, list long, word string, n long")


def links(found: DataFrame) -> DataFrame:
    """(word, near, near_n): all pairs of words one edit apart, both ways. ``found`` is a stored table."""
    index = stored(_index(found), "grams")
    # both sides are stored, so that the join can be split at grams with many words
    asking = index.where(F.col("size") == F.length("word")).select("size", "zone", "list", F.col("word").alias("a"), F.col("n").alias("a_n"))
    listed = index.select("zone", "list", F.col("word").alias("b"), F.col("n").alias("b_n"))
    # a pair comes by the lists of the zone in which it first differs, and no others
    start = lambda zone: f"int((size + 2) * ({zone}) / {ZONES}) - 1"
    alike = lambda zone: f"substring(a, 1, {start(zone)}) = substring(b, 1, {start(zone)})"
    differs_here = F.expr(f"(zone = 0 OR {alike('zone')}) AND (zone = {ZONES - 1} OR NOT {alike('zone + 1')})")
    pairs = asking.join(listed, ["zone", "list"]).where(
        (F.col("a") != F.col("b")) & differs_here & (F.levenshtein("a", "b", 1) == 1))
    both = F.when(
        F.length("a") == F.length("b"), F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")))
    ).otherwise(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))))
    return pairs.select(F.inline(both))


def variants(docs: DataFrame, times: int = TIMES, damaged: int | None = DAMAGED, min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT) -> DataFrame:
    """Words of the texts with their usual forms.

    Reads ``doc_id`` and ``text``; other columns are not read. Result, one row per word: ``word``, ``n``, ``n_near``
    (words that differ from it by one code point put in, left out or replaced), ``form`` (the most frequent of these, the
    least in code-point order of several, if it occurs at least ``times`` as often as the word; else null), ``form_n``, and
    ``root`` (the last word that forms lead to; the word itself without one). Null and empty texts have no words; rows
    that repeat count each; an empty table gives an empty result.

    Frequent grams are a bounded dictionary; a list holds the words of one length, or one more, that
    differ in one quarter only.
    """
    found = stored(words(docs, damaged, min_length, min_count), "words")
    best = links(found).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("top"))
    top_n = -F.col("top.less")
    follows = F.col("top").isNotNull() & (top_n >= times * F.col("n"))
    judged = stored(found.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(follows, F.col("top.near")).alias("form"), F.when(follows, top_n).alias("form_n")), "forms")
    # each form is ``times`` as frequent as the one before: that bounds the steps, and doubling them needs few rounds
    most = judged.agg(F.max("n")).first()[0] or 0
    steps = int(math.log(max(most, 1), max(times, 2))) + 1
    root = judged.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(steps - 1, 0).bit_length()):
        after = root.select(F.col("word").alias("via"), F.col("root").alias("later"))
        root = stored(root.join(after, F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("later", "root").alias("root")), "roots")
    return judged.join(root, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
