import random

import brute
import numpy as np
from texts import columns, documents, frame

import corpus_pipeline
from platework.llm import near


def expected(docs):
    return sorted(((i, *x) for (i, _), x in zip(docs, brute.near(docs).values(), strict=True)), key=repr)


def test_components(spark):
    rng = random.Random(2)
    docs = documents(4, 40)
    base = " ".join(f"w{rng.randrange(500)}" for _ in range(300)).split()
    for k in range(60):  # a chain and a cloud around one text, on both sides of the threshold
        w = list(base)
        for _ in range(k % 8):
            w[rng.randrange(300)] = f"n{rng.randrange(9999)}"
        docs.append((100 + k, " ".join(w)))
    docs += [(3, "only four words here"), (4, "Only FOUR words here"), (None, " ".join(base)), (None, "no id of its own")]
    found = near.near_duplicates(frame(spark, docs))
    assert columns(found, "doc_id", "n_shingles", "component_id", "kept") == expected(docs)


def test_threshold_of_the_pipeline(spark):
    """Pairs of similarity 0.80 to 0.85: the stage takes them, op5's default does not."""
    rng = random.Random(5)
    docs = []
    for k in range(40):
        w = [f"w{rng.randrange(10**6)}" for _ in range(104)]
        docs.append((2 * k, " ".join(w)))
        docs.append((2 * k + 1, " ".join(["x", *w[: 52], f"n{k}", *w[53:], "y"]) if k % 2 else " ".join([*w[:97], *"abcdefghijk"])))
    want = {docs[k][0] for k, x in brute.near(docs, 80).items() if x[2]}
    assert len(want) < len({docs[k][0] for k, x in brute.near(docs).items() if x[2]})
    kept = corpus_pipeline.near_dedup(spark, frame(spark, docs), "")
    assert {r.doc_id for r in kept.collect()} == want


def test_miss_chance_follows_the_threshold():
    for percent in (50, 80, 85, 95):
        bands, least = near.shape(percent)
        assert (1 - (percent / 100) ** near.ROWS) ** bands <= near.MISS
        rng = np.random.default_rng(percent)
        share = percent / 100 + (1 - percent / 100) / 256
        assert (rng.binomial(bands * near.ROWS, share, 100_000) < least).sum() <= 3
    assert near.shape(85)[0] == 28 and near.shape(80)[0] == 44 and near.shape(100) == (1, near.ROWS)


def test_large_buckets_are_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 10)
    test_components(spark)


def test_one_of_each_keeps_columns(spark):
    docs = [(5, "a b c d e f"), (2, "A b c d e f"), (9, None), (8, ""), (7, "other words stand in this one")]
    kept = near.one_of_each(frame(spark, docs))
    assert kept.columns == frame(spark, docs).columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7, 8, 9]


def test_stars_on_a_long_path(spark):
    links = [(bytes([k]), bytes([k + 1])) for k in range(60)] + [(b"\xf0", b"\xf1")]
    rows = near.components(spark.createDataFrame(links, "a binary, b binary")).collect()
    found = {bytes(r.node): bytes(r.component) for r in rows}
    assert len(found) == len(rows) == 63
    assert {v for k, v in found.items() if k < b"\xf0"} == {b"\x00"} and found[b"\xf1"] == b"\xf0"


def test_minima_do_not_depend_on_neighbours():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1, 5, 40_000, 7)]
    together = near.minima(sets)
    assert all((near.minima([s])[0] == row).all() for s, row in zip(sets, together, strict=True))


def test_empty_table(spark):
    assert near.near_duplicates(frame(spark, [])).count() == 0
