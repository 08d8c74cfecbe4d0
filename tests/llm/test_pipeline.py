"""Each stage on what the one before it kept, against plain versions."""

import random

import brute
import pytest
from texts import documents

import corpus_pipeline
from platework.llm import lines, near, quality
from platework.llm.common import stored


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and the result of every stage, as rows by document."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    rng = random.Random(8)
    docs = [(i, t) for i, t in documents(6, 80) if t is None or len(t.split()) != 4]
    base = " ".join(rng.choices([f"w{k}" for k in range(400)], k=150))
    docs += [(500 + k, base.replace(" w7 ", f" n{k} ")) for k in range(5)]
    item = " ".join(f"i{k}" for k in range(20))
    docs += [(600, " ".join(rng.choices([f"u{k}" for k in range(900)], k=90)) + "\n" + item + "\nand on"), (601, f"{item} " * 1)]
    rows = [(i, t, "en" if k % 3 else None, "src", None if t is None else len(t)) for k, (i, t) in enumerate(docs)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    found, df = [rows], spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        df = stored(stage(spark, df, folder), name.replace(" ", "-"))
        found.append([tuple(r) for r in df.collect()])
        if name != "sentencepiece":
            assert tuple(df.columns) == corpus_pipeline.COLUMNS
    ends = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, ends.collect())) == sorted(found[-1])
    return found


def test_quality(stages):
    before, after = stages[0], {r[0] for r in stages[1]}
    failed = {r[0] for r in before if brute.base(r[1])[5]}
    assert failed and not failed & after
    assert quality.MIN_WORDS == 50 and {600, 500} <= after


def test_lines(stages):
    before, after = {r[0]: r[1] for r in stages[1]}, {r[0]: r[1] for r in stages[2]}
    assert set(after) <= set(before) and all(t is not None for t in after.values())
    for i, t in after.items():
        rest = iter(before[i].split("\n"))
        assert t == before[i] or all(line in rest for line in t.split("\n"))
    assert lines.MIN_DOCS == 10


def test_near(stages):
    docs = [(r[0], r[1]) for r in stages[2]]
    kept = {docs[k][0] for k, x in brute.near(docs).items() if x[2]}
    assert {r[0] for r in stages[3]} == kept and len(kept) < len(docs)


def test_long_lines_of_different_documents(spark):
    rng = random.Random(3)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage, short = words(30), "just a short line"
    docs = [(k, f"{words(70)}\n{short}\n {passage}\n{words(60)}") for k in range(4)]
    docs += [(10, f"{docs[0][1]} and more"), (11, docs[1][1]), (12, passage), (13, f"{words(9)}\n{words(9)}"), (14, None)]
    rows = [(i, t, "en", "src", None) for i, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lined = stored(corpus_pipeline.line_dedup(spark, df, ""), "lined")
    found = {r.doc_id: r.text for r in corpus_pipeline.near_dedup(spark, lined, "").collect()}
    kept = {k: docs[k][1].replace(f"\n {passage}", "") if k else docs[0][1] for k in range(4)}
    assert found == kept | {13: docs[7][1], 14: None}  # copies go whole: no rest of theirs stays


def test_decontamination(stages):
    left = [(r[0], r[1]) for r in stages[4]]
    items = [(1, " ".join(f"i{k}" for k in range(20)))]
    assert not any(x[4] for x in brute.leaks(left, items).values())
    hit = {d[0] for d, x in zip(stages[3], brute.leaks([(r[0], r[1]) for r in stages[3]], items).values(), strict=True) if x[4]}
    assert hit == {600} and 600 in dict(left) and {r for r in stages[3] if r[0] not in hit} <= set(stages[4])


def test_encoding(stages):
    assert {r[0] for r in stages[5]} == {r[0] for r in stages[4]}
    assert all(trip and n == len(ids) for _, n, ids, trip in stages[5])


def test_near_dedup_writes_no_copy_of_the_texts(spark, monkeypatch):
    written = []

    def recorded(df, label):
        written.append((label, tuple(df.columns)))
        return stored(df, label)

    monkeypatch.setattr(corpus_pipeline, "stored", recorded)
    monkeypatch.setattr(near, "stored", recorded)
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text, "en", "src", None), (2, text + " end", "en", "src", None), (3, "other words here", "en", "src", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()}
    assert found == {1, 3}
    assert [label for label, columns in written if "text" in columns] == []
