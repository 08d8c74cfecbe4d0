"""What the methods rest on, for random inputs; no session needed."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from platework.llm import leaks, repeats, sentencepiece, suffix_arrays


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=12, max_size=60), st.binary(max_size=40), st.binary(max_size=40), st.binary(max_size=40))
def test_equal_windows_lie_in_runs_of_one_gram(shared, a, b, c):
    """Wherever a window occurs, the gram chosen for it is the same, at the same place in it."""
    text = a + shared + b + shared + c
    anchors, _, places = repeats.runs(suffix_arrays.codes(text), 12, 5)
    of = {}
    for anchor, place in zip(anchors.tolist(), places.tolist(), strict=True):
        for start in range(place // 128, place // 128 + place % 128):
            assert of.setdefault(text[start : start + 12], anchor) == anchor


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=25), min_size=1, max_size=4), st.text("abcd", max_size=60))
def test_automaton_tracks_the_longest_match(items, text):
    automaton = leaks.Automaton([(k, list(map(str.encode, x))) for k, x in enumerate(items)], window=3)
    found = automaton.match(list(map(str.encode, text)))[2]
    lengths = [n for n in range(len(text) + 1) if any(text[a : a + n] in x for a in range(len(text) - n + 1) for x in items)]
    # Stretches too short for a window are skipped; their matches count as none.
    assert found == (max(lengths) if max(lengths) >= automaton.shortest else found) and found <= max(lengths)


@settings(max_examples=40, deadline=None)
@given(st.integers(2, 6), st.integers(0, 2**32 - 1))
def test_matrices_combine_in_any_grouping(chunks, seed):
    rng = np.random.default_rng(seed)
    found = [np.where(rng.random((4, 4)) < 0.3, -np.inf, rng.integers(-50, 0, (4, 4)).astype(float)) for _ in range(chunks)]
    both = lambda a, b: np.max(a[:, :, None] + b[None, :, :], axis=1)
    grouped = found[-1]
    for m in reversed(found[:-1]):
        grouped = both(m, grouped)
    last = sentencepiece.entered_scores([*found, found[0]])[-1]
    assert np.array_equal(last, grouped[0])
