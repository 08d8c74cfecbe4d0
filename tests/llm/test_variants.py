"""Spelling variants against comparing all words with each other."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import frame

from platework.llm import variants as v


def counted(docs):
    out = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{' ' if i is None else i}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            out[word] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]


def expected(docs):
    n = counted(docs)
    near = defaultdict(list)
    for a in n:
        for b in n:
            if is_near(a, b):
                near[a].append(b)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, n[w], len(near[w]), form.get(w), n.get(form.get(w)), root(w)) for w in n)


def found(spark, docs):
    return sorted(tuple(r) for r in v.variants(frame(spark, docs)).select("word", "n", "n_near", "form", "form_n", "root").collect())


def made(seed):
    rng = random.Random(seed)
    parts = ["tion", "heit", "the", "en", "schl", "bl", "que", "an", "er", "é", "Ü", "a", "a"]
    common = ["".join(rng.choices(parts, k=rng.randint(3, 6))) for _ in range(60)]

    def edited(w):
        k, kind = rng.randrange(len(w)), rng.random()
        return w[:k] + ("" if kind < 0.4 else rng.choice("xyz") + ("" if kind < 0.7 else w[k])) + w[k + 1 :]

    variants = [edited(w) for w in common for _ in range(4)]
    variants += [edited(w) for w in variants[::3]]
    docs = []
    for i in range(200):
        words = rng.choices(common, weights=[1 / (1 + k) for k in range(60)], k=60) + rng.choices(variants, k=8)
        words = [w.upper() if rng.random() < 0.05 else w for w in words]
        docs.append((i, rng.choice([" ", "\n", "1", "-"]).join(words)))
    docs += [(1_000 + k, "wordchain " * 5 + "wordchainx " * (k % 3 == 0) + "wordchainxy" * (k < 3)) for k in range(200)]
    return docs + [(None, docs[0][1]), (5, docs[5][1]), (900, None), (901, ""), (902, "×÷×÷×÷×÷ " * 3)]


@pytest.mark.parametrize("seed, least", [(1, 32), (2, 2)])
def test_words_and_forms(spark, seed, least, monkeypatch):
    monkeypatch.setattr(v, "MIN_LIST", least)  # a dictionary with and without long grams
    docs = made(seed)
    want = expected(docs)
    assert found(spark, docs) == want
    assert any(form for *_, form, _, _ in want) and any(root not in (form, word) for word, _, _, form, _, root in want)


def test_empty_tables(spark):
    assert found(spark, [(1, None)]) == [] and v.variants(frame(spark, [(1, "")]).limit(0)).collect() == []


def test_long_words_and_one_word(spark):
    long = "ab" * 3_000
    docs = [(k, f"{long} {long[:-1]}") for k in range(2, 40)] + [(1, "solitary solitary")]
    assert found(spark, docs) == expected(docs)


_WORD = st.text("ab", min_size=2, max_size=22)


@settings(max_examples=600, deadline=None)
@given(_WORD, st.data())
def test_a_near_word_is_in_the_lists_of_the_zone_that_differs(word, data):
    """The bounds hold for any dictionary that has all parts of its grams."""
    grams = data.draw(st.sets(st.text("ab^$", min_size=2, max_size=7), max_size=12))
    padded = f"^{word}$"
    grams |= {padded[a : a + k] for a, k in data.draw(st.sets(st.tuples(st.integers(0, 20), st.integers(2, 7)), max_size=6))}
    takes = v.Grams(frozenset(g[a:b] for g in grams for a in range(len(g)) for b in range(a + 2, len(g) + 1)))
    at, kind = data.draw(st.integers(0, len(word))), data.draw(st.sampled_from(["put in", "replace"]))
    other = word[:at] + data.draw(st.sampled_from("abc")) + word[at + (kind == "replace") :]
    if other == word or len(other) not in (len(word), len(word) + 1) or (kind == "replace" and at == len(word)):
        return
    size, ours, theirs = len(word), f"^{word}$", f"^{other}$"
    first = next(k for k, (x, y) in enumerate(zip(ours, theirs, strict=False)) if x != y)
    zone = next(k for k, (a, b) in enumerate(takes.zones(size)) if a <= first < b)
    key = takes.keys(word, size)[zone]
    assert key[0] and key == takes.keys(other, size)[zone]
