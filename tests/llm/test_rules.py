"""Quality rules, decontamination and line dedup."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from texts import columns, documents, frame

from platework.llm import leaks, lines, quality


# --- quality

def test_base_rules(spark):
    docs = documents(5)
    docs += [(100, "a a a a\n#x#\n#x#\n\x1c\xa0é"), (100, "one two " * 60), (None, "$ % & " * 40)]
    found = quality.judged(frame(spark, docs))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert columns(found, "doc_id", *names) == sorted(((i, *brute.base(t)) for i, t in docs), key=repr)
    assert found.where("base_failed and kept").count() == 0


def test_outliers_go_and_the_rest_stays(spark):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choices("etaoinshr", k=rng.randint(2, 9))) for _ in range(2_000)]
    docs = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(60, 900)))) for k in range(400)]
    docs += [(1_000 + k, " ".join(w + "###" for w in rng.choices(vocabulary, k=100))) for k in range(20)]
    found = quality.judged(frame(spark, docs))
    assert found.where("doc_id < 1000 and not kept").count() == 0
    assert found.where("doc_id >= 1000 and kept").count() == 0


def test_outliers_of_each_statistic(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("etaoinshr", k=rng.randint(2, 9))) for _ in range(5_000)]
    words = lambda n: rng.choices(vocabulary, k=n)
    docs = [(k, " ".join(words(rng.randint(150, 450)))) for k in range(400)]
    half = words(150)
    out = {
        "length": " ".join(words(20_000)),
        "word_length": " ".join(3 * w for w in words(250)),
        "symbols": " ".join([*words(200), *["#|#"] * 30]),
        "repeated_lines": "\n".join([*["of it"] * 60, *[" ".join(words(3)) for _ in range(60)]]),
        "repeated_words": " ".join([*words(155), *half[:60], *words(1), *half[:60]]),
    }
    docs += [(1_000 + k, t) for k, t in enumerate(out.values())]
    found = {r.doc_id: r for r in quality.judged(frame(spark, docs)).collect()}
    assert all(found[k].kept for k in range(400))
    names = list(quality.FEATURES)
    assert {names[k] for k in range(5) if found[1_000 + k].base_failed} <= {"repeated_lines"}
    assert not any(found[1_000 + k].kept for k in range(5)), {n: found[1_000 + k].d2 for k, n in enumerate(names)}


def _against_numpy(spark, df):
    import math

    rows = [(r.doc_id, r.text, r.lang, r.source) for r in df.select("doc_id", "text", "lang", "source").collect()]

    def half_up(v):
        return math.floor(v * quality.UNIT + 0.5)

    vectors = []
    for _, text, lang, source in rows:
        n, chars, symbols, dup, repeated, failed = brute.base(text)
        lines = sum(bool(brute.WORD.search(x)) for x in (text or "").split("\n"))
        x = [half_up(v) for v in (
            math.log1p(n), chars / max(n, 1), math.sqrt(symbols / max(chars, 1)), math.sqrt(dup / max(lines, 1)),
            math.sqrt(repeated / max(n, 1)))]
        vectors.append(((lang, source), None if failed else x))
    want = brute.robust(vectors, quality)
    got = {(r.doc_id, r.lang, r.source, r.n_words): r for r in quality.judged(df).collect()}
    assert len(got) == len({(i, la, so, brute.base(t)[0]) for i, t, la, so in rows})
    differ = 0
    for k, (i, text, lang, source) in enumerate(rows):
        row = got[i, lang, source, brute.base(text)[0]]
        if k in want:
            assert row.d2 == pytest.approx(want[k], rel=1e-6, abs=1e-6)
            assert row.kept == (want[k] <= quality.CUTOFF)
            differ += not row.kept
        else:
            assert not row.kept
    return differ


def test_verdicts_are_those_of_numpy(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("etaoinshr", k=rng.randint(2, 9))) for _ in range(800)]
    docs = []
    for k in range(700):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(40, 600)))
        if k % 50 == 0:
            text = " ".join(w + "#$" for w in text.split())
        lang, source = rng.choice([("en", "web"), ("en", "web"), ("en", "books"), ("de", None), (None, "x")])
        docs += [(k, text, lang, source)] * (40 if k == 3 else 1)
    docs += [(2_000, "so " * 70, "xx", "alone"), (2_001, " ".join(vocabulary[:200]), "yy", "alone"), (2_002, None, "en", "web")]
    docs = [(i, t, la, so) for i, (_, t, la, so) in enumerate(docs)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    assert _against_numpy(spark, df) >= 10


def test_verdicts_on_the_drivers_documents_are_those_of_numpy(spark):
    from pathlib import Path

    path = "/root/testdata/sf0.01/documents.parquet"
    if not Path(path).exists():
        pytest.skip("no driver tables")
    assert _against_numpy(spark, spark.read.parquet(path)) > 0


def test_steps_end_where_rows_lie_at_the_edge(spark):
    """Two shapes of equal weight: no step count is set, and the end comes."""
    docs = [(k, " ".join(["ab"] * (60 + k % 2 * 300 + j))) for k in range(40) for j in range(5)]
    docs = [(i, " ".join(f"{w}{n}" for n, w in enumerate(t.split()))) for i, (_, t) in enumerate(docs)]
    assert quality.judged(frame(spark, docs)).where("kept").count() == 200


def test_cutoff_and_floor():
    draws = np.random.default_rng(0).chisquare(5, 200_000)
    assert abs((draws > quality._quantile(0.025)).mean() - 0.025) < 0.002 and abs(quality.CUTOFF - 35.89) < 0.01
    least = np.array(list(quality.FEATURES.values()))
    wide = np.diag(least**2 * 4)
    assert (quality._floored(wide, least) == wide).all()
    assert np.allclose(quality._floored(np.zeros((5, 5)), least), np.diag(least**2))


def test_quality_of_odd_tables(spark):
    assert quality.judged(frame(spark, [])).count() == 0
    one = frame(spark, [(1, "word " * 3), (None, None)]).withColumn("lang", F.lit(None).cast("string"))
    assert columns(quality.judged(one), "doc_id", "kept") == [(1, False), (None, False)]
    kept = quality.kept_rows(frame(spark, documents(1)))
    assert kept.columns == frame(spark, []).columns


# --- decontamination

def items(seed):
    rng = random.Random(seed)
    docs = [t for _, t in documents(seed) if t]
    found = [(k, " ".join(rng.choice(docs).split()[5 : 5 + rng.randint(9, 40)])) for k in range(25)]
    found += [(None, found[1][1]), (None, " ".join(docs[5].split()[:12])), found[2]]
    return [*found, (90, None), (91, " ,.! "), (92, "zzz"), (93, "Never, Seen-Before"), (3, found[0][1])]


@pytest.mark.parametrize(("seed", "block"), [(1, 10**6), (2, 10**6), (1, 60)])
def test_leaks(spark, seed, block):
    docs, tests = documents(seed), items(seed)
    docs += [(200, "ABC-never seen before"), (201, docs[3][1]), (201, docs[4][1])]
    benchmark = spark.createDataFrame(tests, "item_id long, text string")
    found = leaks.matches(frame(spark, docs), benchmark, block_words=block).select(
        "doc_id", "n_words", leaks.hit_words().alias("n_hit"), F.size("items").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ","), 256).alias("sha"),
        (F.size("spans") > 0).alias("hit"))
    assert columns(found, *found.columns) == sorted(((docs[k][0], *x) for k, x in brute.leaks(docs, tests).items()), key=repr)


@pytest.mark.parametrize("block", [10**6, 40])
def test_leaks_of_items_with_text_ids_in_blocks(spark, block):
    """A long item is cut into pieces, equal rows of the benchmark count once, and each block is small."""
    docs = documents(4)
    long = " ".join(t for _, t in docs[:6] if t)
    tests = [("long", long), ("b,c", docs[2][1]), (None, docs[3][1]), ("zz", "zzz"), *[("many", docs[4][1])] * 300]
    benchmark = spark.createDataFrame(tests, "item_id string, text string")
    found = leaks.matches(frame(spark, docs), benchmark, block_words=block).select(
        "doc_id", "n_words", leaks.hit_words().alias("n_hit"), F.size("items").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("sha"), (F.size("spans") > 0).alias("hit"))
    assert columns(found, *found.columns) == sorted(((docs[k][0], *x) for k, x in brute.leaks(docs, tests).items()), key=repr)
    parts = leaks.blocks(leaks.pieces(benchmark, "item_id", "text", leaks.WINDOW, block).persist(), block)
    sizes = [b.agg(F.sum(F.size("words"))).first()[0] for b in parts]
    assert (len(sizes) == 1 if block > 1000 else len(sizes) > 5) and max(sizes) <= max(2 * block + 20, 10**6 * (block > 1000))


def test_spans_are_cut_out(spark):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, f"Before it: {item.upper()}! And after, quite some more words to go on with than there were."),
            (2, item), (3, "clean"), (None, None)]
    found = leaks.decontaminated(frame(spark, docs), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert columns(found, "doc_id", "text") == sorted([
        (1, "Before it: ! And after, quite some more words to go on with than there were."), (3, "clean"), (None, None)],
        key=repr)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert leaks.decontaminated(frame(spark, docs), empty).count() == 4
    assert leaks.matches(frame(spark, []), empty).count() == 0


# --- lines

def test_recurring_templates_go(spark):
    docs = [(k, f"Page {k} of 30\nText number{'x' * k} of its own\nServed by host-{k}.example in {k * 3} ms\n\nEnd{'y' * k}")
            for k in range(12)]
    docs += [(50, None), (51, ""), (52, "Page 9 of 30"), (53, "\n \n")]
    found = lines.without_recurring_lines(frame(spark, docs), min_docs=5)
    texts = dict(columns(found, "doc_id", "text"))
    assert texts[0] == docs[0][1]  # first place of each template
    assert texts[4] == "\nEndyyyy"  # "Text <field> of its own" meets by its trailing tokens
    assert (texts[50], texts[51], texts[52], texts[53]) == (None, "", "", "\n \n")
    counts = {r.doc_id: (r.n_lines, r.n_dropped) for r in found.collect()}
    assert counts[4] == (5, 3) and counts[51] == (0, 0) and counts[50] == (0, 0) and counts[53] == (3, 0)


def test_templates_generalise_places_without_digits(spark):
    names = "anna bert carl dora emil fritz gerd hans ida jan".split()
    docs = [(k, f"user {n} logged in from the web") for k, n in enumerate(names)]
    docs += [(20 + k, f"{n} wrote something else here today") for k, n in enumerate(names)]
    found = lines.without_recurring_lines(frame(spark, docs), min_docs=5, depth=1)
    kept = dict(columns(found, "doc_id", "text"))
    assert kept[0] == docs[0][1] and all(kept[k] == "" for k in range(1, 10))
    assert kept[20] == docs[10][1] and all(kept[20 + k] == "" for k in range(1, 10))  # meet by their trailing tokens


def test_a_leaf_holds_several_templates(spark):
    """Two templates with the same leading tokens, one whose first token is a field, and lines that agree in little."""
    word = lambda k: "w" + "abcdefghij"[k % 10] * (1 + k // 10)
    docs = [(k, f"see also the {word(k)} page for details now\nown {word(k)} {word(k + 1)} {word(3 * k + 2)} text") for k in range(50)]
    docs += [(100 + k, f"see also the list of {word(k)} topics here") for k in range(50)]
    docs += [(200 + k, f"{word(k)} wrote this on our page today") for k in range(50)]
    found = lines.without_recurring_lines(frame(spark, docs))
    texts = dict(columns(found, "doc_id", "text"))
    first = {0: "see also the wa page for details now", 100: docs[50][1], 200: docs[100][1]}
    for at, text in first.items():
        assert texts[at].split("\n")[0] == text
    assert all(texts[100 + k] == "" and texts[200 + k] == "" for k in range(1, 50))
    assert all(texts[k].startswith("own ") for k in range(1, 50))


def test_lines_stay_native(spark):
    plan = lines.without_recurring_lines(frame(spark, documents(1)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert lines.without_recurring_lines(frame(spark, [])).count() == 0
