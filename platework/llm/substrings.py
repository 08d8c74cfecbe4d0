"""Substring dedup over words by prefix-partitioned suffix trees.

Suffixes start at the windows of runs that may share ``WINDOW`` words (see ``repeats``) and are split by a prefix they
share into groups that fit a task: the gram of ``GRAM`` words that the run's windows have in common, several grams to
a group; grams that are too frequent are taken apart by the whole window. A group's tree is grown from its root
breadth-first: the suffixes of a node are split by ever longer prefixes, a suffix alone in its node is a leaf and
left, and a branch with suffixes of one document only can tell nothing. Inner nodes of ``WINDOW`` words or more are
the repeats.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from platework.llm import repeats
from platework.llm.common import WordHashes, as_bytes, in_batches, mixed

WINDOW, GRAM = 50, 8

_HASHES = WordHashes()


def codes(text: bytes) -> np.ndarray:
    return _HASHES.of(text.split())


def masks(contents: list[bytes], rank: np.ndarray, start: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each content a mask of the windows that also start in an earlier document."""
    words = [np.frombuffer(c, np.uint64) for c in contents]
    sizes = np.array([len(w) for w in words])
    begins = np.cumsum(sizes) - sizes
    text = np.concatenate(words)
    windows = sizes - window + 1
    owner = np.repeat(np.arange(len(words)), windows)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = begins[owner] + within
    node = np.zeros(len(owner), np.int64)
    depth = 0
    while depth < window and len(node):
        step = min(max(depth, 4), window - depth)  # prefixes of 4, 8, 16, 32, ... words
        branch = np.zeros(len(node), np.uint64)
        for k in range(step):
            branch = mixed(branch + text[place + depth + k])
        order = np.lexsort((branch, node))
        new = np.append(True, (np.diff(node[order]) != 0) | (branch[order][1:] != branch[order][:-1]))
        starts = np.flatnonzero(new)
        count = np.diff(starts, append=len(order))
        low = np.minimum.reduceat(rank[owner[order]], starts)
        high = np.maximum.reduceat(rank[owner[order]], starts)
        inner = np.repeat((count > 1) & (low < high), count)
        node = np.repeat(np.arange(len(starts)), count)[inner]
        lowest = np.repeat(low, count)[inner]
        owner, within, place = (x[order][inner] for x in (owner, within, place))
        depth += step
    out = np.zeros(len(words), np.uint64)
    if len(node):
        later = rank[owner] > lowest
        np.bitwise_or.at(out, owner[later], np.uint64(1) << within[later].astype(np.uint64))
    return out.view(np.int64)


def without_repeats(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, gram: int = GRAM,
) -> DataFrame:
    """Per row: the id, ``n_words``, ``n_removed``, ``kept`` (the remaining words joined by one space) and
    ``kept_sha256``.

    Removed is each word of a ``window`` of consecutive words that also starts in a document with a smaller id. Null
    and empty texts have no words; texts with fewer words than the window lose nothing. A null id counts as the
    smallest; rows with equal ids are one document for this purpose and take nothing from each other. An empty table
    gives an empty result; other columns are not read.
    """
    repeated = repeats.repeated_runs(df, id_column, text_column, codes, window, gram)
    firsts = repeats.first_places(repeated)
    contents = repeats.with_content(firsts, df, id_column, text_column, lambda t: codes(t).tobytes(), 8, window)
    answers = repeats.masks(contents, lambda c, r, s: masks(c, r, s, window), 8, window, by_document=True)
    spans = repeats.covered(repeated, firsts, answers, by_document=True)
    rows = repeats.with_spans(df, spans, id_column, text_column)

    def run(batch):
        each = []
        for text, found in zip(as_bytes(batch["text"]), batch["spans"].to_pylist(), strict=True):
            words = (text or b"").split()
            n = len(words)
            if found:
                bounds = [0, *repeats.removed_units(np.array(found), window, n).ravel().tolist(), n]
                words = [w for a, b in zip(bounds[::2], bounds[1::2], strict=True) for w in words[a:b]]
            kept = b" ".join(words)
            each.append((n, n - len(words), kept, hashlib.sha256(kept).hexdigest()))
        names = ("n_words", "n_removed", "kept", "kept_sha256")
        return {id_column: batch["id"]} | {n: list(v) for n, v in zip(names, zip(*each, strict=True), strict=True)}

    kind = df.schema[id_column].dataType.simpleString()
    return in_batches(rows, run, f"`{id_column}` {kind}, n_words long, n_removed long, kept binary, kept_sha256 string")
