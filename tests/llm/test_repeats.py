"""Both exact dedup operators against every window in a dictionary."""

import random

import brute
import numpy as np
import pytest
from texts import columns, documents, frame

from platework.llm import repeats, substrings, suffix_arrays


def expected(docs, found):
    return sorted(((i, *found[k]) for k, (i, _) in enumerate(docs)), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(spark, seed):
    docs = documents(seed)
    random.Random(seed).shuffle(docs)
    found = suffix_arrays.without_repeats(frame(spark, docs))
    assert columns(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected(docs, brute.byte_repeats(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, seed):
    docs = [*documents(seed), (None, documents(seed)[3][1])]
    found = substrings.without_repeats(frame(spark, docs))
    assert columns(found, "doc_id", "n_words", "n_removed", "kept_sha256") == expected(docs, brute.word_repeats(docs))


def test_frequent_grams_are_taken_apart(spark, monkeypatch):
    """The way for grams with too many contents gives the same."""
    monkeypatch.setattr(repeats, "MANY", 1)
    docs = documents(3)
    found = suffix_arrays.without_repeats(frame(spark, docs))
    assert columns(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected(docs, brute.byte_repeats(docs))
    found = substrings.without_repeats(frame(spark, docs))
    assert columns(found, "doc_id", "n_words", "n_removed", "kept_sha256") == expected(docs, brute.word_repeats(docs))


def test_pieces(monkeypatch):
    """A text cut into pieces has the same windows."""
    codes = suffix_arrays.codes(random.Random(1).randbytes(5_000))
    monkeypatch.setattr(repeats, "PIECE", 333)
    _, _, place = repeats.runs(codes, 100, 37)
    windows = np.concatenate([np.arange(p // 128, p // 128 + p % 128) for p in place])
    assert windows.tolist() == list(range(5_000 - 99))


@pytest.mark.parametrize("alphabet", ["ab", "a", "abcdefgh"])
def test_suffix_array(alphabet):
    rng = random.Random(4)
    data = np.array([alphabet.index(rng.choice(alphabet)) for _ in range(700)])
    array = suffix_arrays.suffix_array(data, 12)
    assert array.tolist() == sorted(range(700), key=lambda k: data[k:].tolist())


def test_rows_that_repeat(spark):
    text = " ".join(f"w{k}" for k in range(80))
    docs = [(1, text), (1, text), (2, text), (2, "x " + text)]
    found = suffix_arrays.without_repeats(frame(spark, docs))
    n = len(text)
    assert columns(found, "doc_id", "n_removed") == [(1, 0), (1, 0), (2, n), (2, n)]
    found = substrings.without_repeats(frame(spark, docs))
    assert columns(found, "doc_id", "n_removed") == [(1, 0), (1, 0), (2, 80), (2, 80)]


def test_empty_table(spark):
    assert suffix_arrays.without_repeats(frame(spark, [])).count() == 0
    assert substrings.without_repeats(frame(spark, [])).count() == 0
