"""Exact dedup of byte strings by suffix arrays.

Contents of runs that may share ``WINDOW`` bytes (see ``repeats``) are joined to shards, all runs of a gram in one
shard, and each shard's suffix array is made by induced sorting: suffixes are classified, the substrings between
leftmost-smaller suffixes are sorted and named, the string of names is sorted in turn, and all other suffixes are
induced from these in one walk up and one down the array, bucket by bucket in numpy. The common prefixes of neighbours
in the array, taken in text order, tell which suffixes share ``WINDOW`` bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from platework.llm import repeats
from platework.llm.common import as_bytes, in_batches, mixed

WINDOW, GRAM = 100, 37
#: Rounds of sorting names: each doubles the number of substrings that are told apart, so that 9 reach over 1,024
#: bytes, more than a run has.
ROUNDS = 9

_CODES = np.random.default_rng(100).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def codes(text: bytes) -> np.ndarray:
    return _CODES[np.frombuffer(text, np.uint8)]


def smaller_types(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one. The last symbol is the single least."""
    change = np.flatnonzero(s[:-1] != s[1:])
    return np.append(np.repeat(s[change] < s[change + 1], np.diff(change, prepend=-1)), True)


def induced(s: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, symbols: int) -> np.ndarray:
    """The suffix array that the given order of the leftmost smaller suffixes induces."""
    counts = np.bincount(s, minlength=symbols)
    ends = np.cumsum(counts)
    heads = ends - counts
    order = leftmost[np.argsort(s[leftmost], kind="stable")]
    seeded = np.bincount(s[leftmost], minlength=symbols)
    array = np.full(len(s), -1, np.int64)
    first = np.cumsum(seeded) - seeded
    seeds = [order[first[c] : first[c] + seeded[c]] for c in range(symbols)]

    def place(found: np.ndarray, fill: np.ndarray, up: bool) -> None:
        keys = s[found]
        by = np.argsort(keys, kind="stable")
        keys, found = keys[by], found[by]
        n = np.bincount(keys, minlength=symbols)
        within = np.arange(len(keys)) - (np.cumsum(n) - n)[keys]
        if up:
            array[fill[keys] + within] = found
            fill += n
        else:
            array[fill[keys] - 1 - within] = found
            fill -= n

    def before(found: np.ndarray, wanted: bool) -> np.ndarray:
        found = found[found > 0] - 1
        return found[smaller[found] == wanted]

    used = np.flatnonzero(counts)
    fill = heads.copy()
    for c in used:  # larger suffixes, ascending
        at = heads[c]
        while at < fill[c]:
            part = array[at : fill[c]]
            at = fill[c]
            place(before(part, False), fill, True)
        place(before(seeds[c], False), fill, True)
    top = ends.copy()
    array[0] = len(s) - 1  # the last symbol's suffix is the least
    for c in used[::-1]:  # smaller suffixes, descending
        at = ends[c]
        while at > top[c]:
            part = array[top[c] : at][::-1]
            at = top[c]
            place(before(part, True), top, False)
        place(before(array[heads[c] : fill[c]][::-1], True), top, False)
    return array


def suffix_array(data: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array of symbols below ``symbols - 1`` (suffixes equal in all that the rounds compare: by place)."""
    s = np.append(data.astype(np.uint16) + 1, np.uint16(0))
    smaller = smaller_types(s)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    rank_of = np.zeros(len(s), np.int64)
    rank_of[leftmost] = np.arange(len(leftmost))
    array = induced(s, smaller, leftmost, symbols)
    is_leftmost = np.zeros(len(s), bool)
    is_leftmost[leftmost] = True
    by_substring = array[is_leftmost[array]]
    # Names: neighbours are equal if their substrings, up to the next leftmost suffix, have equal hashes and lengths.
    up, down = repeats._powers(len(s) + 1)
    total = np.append(np.uint64(0), np.cumsum((s.astype(np.uint64) + np.uint64(1)) * up[: len(s)]))
    ends = np.append(leftmost[1:] + 1, len(s))
    digest = mixed((total[ends] - total[leftmost]) * down[leftmost] + (ends - leftmost).astype(np.uint64))
    sorted_digest = digest[rank_of[by_substring]]
    names = np.empty(len(leftmost), np.int64)
    names[rank_of[by_substring]] = np.cumsum(np.append(0, sorted_digest[1:] != sorted_digest[:-1])) + 1
    reach = 1
    for _ in range(ROUNDS):
        if names.max(initial=0) == len(names):
            break
        follow = np.append(names[reach:], np.zeros(min(reach, len(names)), np.int64))[: len(names)]
        _, names = np.unique(names * (len(names) + 2) + follow, return_inverse=True)
        names = names + 1
        reach *= 2
    return induced(s, smaller, leftmost[np.argsort(names, kind="stable")], symbols)[1:]


def common_prefixes(data: np.ndarray, array: np.ndarray, longest: int) -> np.ndarray:
    """Symbols, up to ``longest``, that each suffix shares with the one before it in the array: by place in the text.

    The comparison runs in text order (permuted), seven symbols at a time over what still agrees; the symbol that differs
    is then found within the seven.
    """
    n = len(data)
    words = np.zeros(n + longest + 8, np.uint64)
    padded = np.append(data, np.zeros(longest + 16, data.dtype)).astype(np.uint64)
    for k in range(7):
        words |= padded[k : k + len(words)] << np.uint64(9 * k)
    previous = np.full(n, -1, np.int64)
    previous[array[1:]] = array[:-1]
    shared = np.zeros(n, np.int64)
    alive = np.flatnonzero(previous >= 0)
    for at in range(0, longest, 7):
        differ = words[alive + at] ^ words[previous[alive] + at]
        same = differ == 0
        ended, differ = alive[~same], differ[~same]
        shared[ended] = at
        for k in range(1, 7):
            shared[ended[differ & np.uint64((1 << 9 * k) - 1) == 0]] = at + k
        alive = alive[same]
        if not len(alive):
            break
    shared[alive] = longest
    return np.minimum(shared, longest)


def masks(contents: list[bytes], rank: np.ndarray, start: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each content a mask of the windows that also start earlier: by document, then by start."""
    sizes = np.array([len(c) for c in contents])
    begins = np.cumsum(sizes + 1) - sizes - 1
    joined = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8).astype(np.uint16) + 1
    joined[begins + sizes] = 0  # parts contents
    array = suffix_array(joined, 258)
    owner = np.repeat(np.arange(len(contents)), sizes + 1)
    within = np.arange(len(joined)) - begins[owner]
    whole = (within + window <= sizes[owner])[array]
    follows = (common_prefixes(joined, array, int(sizes.max()))[array] >= window) & whole
    key = (rank[owner].astype(np.int64) << 40) + start[owner] + within
    # Classes of equal windows are neighbours in the array; a suffix with fewer bytes is a class by itself.
    starts = np.flatnonzero(~follows)
    lowest = np.minimum.reduceat(key[array], starts)
    lowest = np.repeat(lowest, np.diff(starts, append=len(array)))
    later = array[whole & (key[array] > lowest)]
    out = np.zeros(len(contents), np.uint64)
    np.bitwise_or.at(out, owner[later], np.uint64(1) << within[later].astype(np.uint64))
    return out.view(np.int64)


def without_repeats(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, gram: int = GRAM,
) -> DataFrame:
    """Per row: the id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept`` (the remaining bytes)
    and ``kept_sha256``.

    Removed is each byte of a ``window``-byte string that also starts earlier: in a document with a smaller id, or
    earlier in the same one. Null texts count as empty; texts shorter than the window lose nothing. A null id counts as
    the smallest. Of texts that share an id the one with the smaller hash comes first; a row repeated as a whole is one
    document, and each of its rows loses the same. An empty table gives an empty result; other columns are not read.
    """
    repeated = repeats.repeated_runs(df, id_column, text_column, codes, window, gram)
    firsts = repeats.first_places(repeated)
    contents = repeats.with_content(firsts, df, id_column, text_column, lambda t: t, 1, window)
    answers = repeats.masks(contents, lambda c, r, s: masks(c, r, s, window), 1, window, by_document=False)
    spans = repeats.covered(repeated, firsts, answers, by_document=False)
    rows = repeats.with_spans(df, spans, id_column, text_column)

    def run(batch):
        each = []
        for text, found in zip(as_bytes(batch["text"]), batch["spans"].to_pylist(), strict=True):
            text, edges = text or b"", np.zeros((0, 2), np.int64)
            kept = text
            if found:
                edges = repeats.removed_units(np.array(found), window, len(text))
                bounds = [0, *edges.ravel().tolist(), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
            each.append((len(text), len(text) - len(kept), len(edges), kept, hashlib.sha256(kept).hexdigest()))
        names = ("n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")
        return {id_column: batch["id"]} | {n: list(v) for n, v in zip(names, zip(*each, strict=True), strict=True)}

    kind = df.schema[id_column].dataType.simpleString()
    return in_batches(
        rows, run, f"`{id_column}` {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
