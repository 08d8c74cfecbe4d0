"""Benchmark decontamination by a generalised suffix automaton over the words of the test items.

Training words are streamed through the automaton, which gives the longest match that ends at each word. A match of
``WINDOW`` words or more ends a window of ``WINDOW`` item words; an item of fewer words is one window. Words outside
the items, and stretches without as many consecutive word pairs of the items as the shortest window has, cannot end a
window and are skipped at once.

The items are taken in blocks of bounded size, one at a time, so that what the driver holds and sends to the executors is
bounded however many items there are, and however long: an automaton has at most two states per word, and every document
meets every block.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platework.llm.common import as_bytes, in_batches, row_hash, same, stored

WINDOW = 10
#: Words of the items in a block; with the bytes of their texts this bounds the driver's and the executors' memory.
BLOCK_WORDS = 500_000
#: A document that loses more than this share of its words is dropped by ``decontaminated``.
MAX_COVERAGE = 0.5

#: Lower case for A-Z; every other ASCII character that is no digit or letter parts words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile(rb"[^\x20]+")
#: The same for texts in lower case, as a pattern.
_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PAIRS = 1 << 20


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Automaton:
    """States of the generalised suffix automaton, with the items that each state's strings occur in."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window, self.vocabulary = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for item, words in items:
            if words:
                coded.append((item, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]))
        for _, word_ids in coded:
            state = 0
            for w in word_ids:
                state = self._extend(state, w)
        self.shortest = min([window, *(len(x) for _, x in coded)])
        self.found_by_length(coded)
        self.pairs = np.zeros(_PAIRS, bool)
        for _, word_ids in coded:
            x = np.asarray(word_ids, np.int64)
            self.pairs[self._pair(x[:-1], x[1:])] = True

    @staticmethod
    def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 1_000_003 + b * 7_919) & (_PAIRS - 1)

    def _extend(self, last: int, w: int) -> int:
        """Append word ``w`` to the item that ends in state ``last``."""
        known = self.next[last].get(w)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            return self._clone(last, w, known)
        state = self._new(self.length[last] + 1, {})
        while last != -1 and w not in self.next[last]:
            self.next[last][w] = state
            last = self.link[last]
        if last == -1:
            self.link[state] = 0
        else:
            known = self.next[last][w]
            self.link[state] = known if self.length[known] == self.length[last] + 1 else self._clone(last, w, known)
        return state

    def _new(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, last: int, w: int, known: int) -> int:
        copy = self._new(self.length[last] + 1, dict(self.next[known]))
        self.link[copy], self.link[known] = self.link[known], copy
        while last != -1 and self.next[last].get(w) == known:
            self.next[last][w] = copy
            last = self.link[last]
        return copy

    def found_by_length(self, coded: list) -> None:
        """``items[s]``: items with the full window whose longest form is in state s; ``short[s]``: items of fewer
        words than a window that end in s, with their length."""
        self.items: dict[int, set] = {}
        self.short: dict[int, list] = {}
        for item, word_ids in coded:
            state = 0
            for at, w in enumerate(word_ids):
                state = self.next[state][w]
                if at + 1 >= self.window:
                    self.items.setdefault(self.window_state(state), set()).add(item)
            if len(word_ids) < self.window:
                self.short.setdefault(state, []).append((len(word_ids), item))

    def window_state(self, state: int) -> int:
        """The state of the last ``window`` words of a state's strings."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def match(self, words: list[bytes]) -> tuple[np.ndarray, set, int]:
        """Which words lie in an occurrence of a window, the items whose windows occur, and the longest match."""
        n = len(words)
        get, items, longest = self.vocabulary.get, set(), 0
        hit = np.zeros(n, bool)
        ids = np.fromiter([get(w, -1) for w in words], np.int64, n)
        known = ids >= 0
        if self.shortest >= 2:
            linked = np.zeros(n, bool)  # a word and the next one
            if n > 1:
                linked[:-1] = known[:-1] & known[1:] & self.pairs[self._pair(ids[:-1], ids[1:])]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], linked.view(np.int8), [0]])))
            runs = [(a, b + 1) for a, b in edges.reshape(-1, 2).tolist() if b + 1 - a >= self.shortest]
        else:
            edges = np.flatnonzero(np.diff(np.concatenate([[0], known.view(np.int8), [0]])))
            runs = edges.reshape(-1, 2).tolist()
        following, link, length, window, short = self.next, self.link, self.length, self.window, self.short
        for a, b in runs:
            state, size = 0, 0
            for at, w in enumerate(ids[a:b].tolist(), a):
                while state and w not in following[state]:
                    state = link[state]
                    size = length[state]
                if w in following[state]:
                    state, size = following[state][w], size + 1
                longest = max(longest, size)
                if size >= window:
                    hit[at + 1 - window : at + 1] = True
                    items |= self.items[self.window_state(state)]
                if short:
                    up = state
                    while up > 0:
                        for count, item in short.get(up, ()):
                            if count <= size:
                                hit[at + 1 - count : at + 1] = True
                                items.add(item)
                        up = link[up]
        return hit, items, longest


def spans(hit: np.ndarray) -> list[list[int]]:
    """First and one after the last word of each run of hit words."""
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))).reshape(-1, 2).tolist()


def pieces(benchmark: DataFrame, item_column: str, text_column: str, window: int, limit: int) -> DataFrame:
    """(item, words) of the distinct items; one of more than ``limit`` words in pieces that overlap by all but a word of a
    window, so that they have its windows and no others."""
    lower = F.translate(F.col(text_column), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = benchmark.select(
        F.col(item_column).alias("item"), F.regexp_extract_all(lower, F.lit(f"({_ITEM_WORD})"), F.lit(1)).alias("words"))
    rows = rows.where(F.size("words") > 0).distinct()
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)), F.lit(limit))
    return rows.select("item", "words", F.explode(starts).alias("start")).select(
        "item", F.slice("words", F.col("start") + 1, F.lit(limit + window - 1)).alias("words"))


def blocks(found: DataFrame, limit: int) -> list[DataFrame]:
    """Stored pieces dealt into blocks. They are counted by many small hash buckets, and as many of these make a block as
    stay below ``limit`` words; at most one bucket's words more."""
    total = found.agg(F.sum(F.size("words"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("item", "words"), F.lit(max(1, 16 * total // limit)))
    sizes = found.groupBy(bucket.alias("bucket")).agg(F.sum(F.size("words")).alias("n")).orderBy("bucket").collect()
    dealt, size = [[]], 0
    for row in sizes:
        if size and size + row["n"] > limit:
            dealt.append([])
            size = 0
        dealt[-1].append(row["bucket"])
        size += row["n"]
    return [found] if len(dealt) == 1 else [found.where(bucket.isin(b)) for b in dealt]


def matches(
    df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per row: the id, ``text_hash``, ``n_words``, ``spans`` (runs of hit words: first, one after the last), ``items``
    (sorted ids of items with occurring windows) and ``longest`` (words of the longest match).

    A null text has no words, like an empty one. Items with null or wordless texts have no windows. Item ids may be of any
    type; items that share an id, a null one too, count as one. Rows equal in id and text each give a row; rows that only
    share an id are told apart by ``text_hash``. An empty benchmark hits nothing. Other columns are not read.

    The driver holds one block of items at a time: its automaton goes to the executors, and is given up once the block's
    matches are stored.
    """
    spark = df.sparkSession
    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), row_hash(text_column).alias("text_hash"))
    item_kind = benchmark.schema[item_column].dataType.simpleString()
    found = []
    dealt = blocks(stored(pieces(benchmark, item_column, item_text, window, block_words), "items"), block_words)
    for block in dealt:
        items = [(r.item, [w.encode() for w in r.words]) for r in block.collect()]  # bounded by block_words
        shared = spark.sparkContext.broadcast(Automaton(items, window))

        def run(batch, shared=shared):
            automaton, out = shared.value, {"id": batch["id"], "text_hash": batch["text_hash"]}
            each = []
            for text in as_bytes(batch["text"]):
                words = words_of(text or b"")
                hit, items, longest = automaton.match(words)
                each.append((len(words), spans(hit) if longest else [], list(items), longest))
            for name, values in zip(("n_words", "spans", "items", "longest"), zip(*each, strict=True), strict=True):
                out[name] = list(values)
            return out

        matched = in_batches(
            rows, run,
            f"id {kind}, text_hash long, n_words long, spans array<array<int>>, items array<{item_kind}>, longest int")
        if len(dealt) == 1:
            return matched.withColumn("items", F.array_sort("items")).withColumnRenamed("id", id_column)
        found.append(stored(matched, "matches"))
        shared.destroy()
    every = found[0]
    for other in found[1:]:
        every = every.unionByName(other)
    # Rows equal in id and text meet in a group once per block; each of them comes back.
    merged = every.groupBy("id", "text_hash").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("longest").alias("longest"),
        (F.count("*") / len(found)).cast("int").alias("copies"))
    one = F.aggregate(
        F.array_sort("spans"), F.expr("cast(array() as array<array<int>>)"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s[0] <= F.element_at(F.element_at(done, -1), 2)),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.array(
                F.element_at(F.element_at(done, -1), 1), F.greatest(s[1], F.element_at(F.element_at(done, -1), 2))))),
        ).otherwise(F.concat(done, F.array(s))))
    return merged.withColumn("spans", F.when(F.size("spans") > 0, one).otherwise(F.col("spans"))).select(
        F.col("id").alias(id_column), "text_hash", "n_words", "spans", "items", "longest",
        F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")).drop("copy")


def hit_words():
    """Number of hit words of a row of ``matches``."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0]).cast("long"))


def without_spans(text: bytes, removed: list[list[int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    out, at = [], 0
    for a, b in removed:
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, text[at:]])


def decontaminated(
    df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    max_coverage: float = MAX_COVERAGE, **options,
) -> DataFrame:
    """The rows of ``df`` with all their columns, without the hit spans; rows that lose more than ``max_coverage`` of
    their words are dropped. Rows without hits are returned as they are, nulls included."""
    found = matches(df, benchmark, id_column, text_column, **options).where(F.size("spans") > 0)
    found = found.select(
        F.col(id_column).alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans"),
        (hit_words() / F.col("n_words") > max_coverage).alias("__drop")).dropDuplicates(["__id", "__hash"])
    rows = df.withColumns({"__id": F.col(id_column), "__hash": row_hash(text_column)})
    joined = rows.join(found, same(rows, found, "__id", "__hash"), "left").select(
        *[rows[f"`{c}`"] for c in df.columns], found["__spans"], found["__drop"])
    joined = joined.where(F.coalesce(~F.col("__drop"), F.lit(True)))

    names = df.columns

    def run(batch):
        out = {c: batch[c] for c in names}
        texts, removed = as_bytes(batch[text_column]), batch["__spans"].to_pylist()
        if any(removed):
            out[text_column] = [
                t if not s else without_spans(t, s) for t, s in zip(texts, removed, strict=True)]
            out[text_column] = [None if t is None else t.decode() for t in out[text_column]]
        return out

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return in_batches(joined, run, columns)
