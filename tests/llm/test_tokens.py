"""Encoding, decoding and counting against the C++ library, with the vocabulary read as a unigram model."""

import random

import numpy as np
import pytest
import sentencepiece as spm
from pyspark.sql import functions as F

from platework.llm import sentencepiece, token_counts
from platework.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def model(tmp_path_factory):
    """The vocabulary as a unigram model; scores of -1e9 raised, which leave no digits in the library's 32-bit sums."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(tokenizer_path(), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    for piece in model.pieces:
        piece.score = max(piece.score, -40_000)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


@pytest.fixture(scope="module")
def library(model):
    return spm.SentencePieceProcessor(model_file=model)


def texts() -> list[str | None]:
    rng = random.Random(5)
    words = "the theory of Émile naïve tokenization 日本語 \U0001f600 x supercalifragilistic aaaaaaa 12345 don't".split()
    made = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(40)]
    return [None, "", " ", "a", "\n", "a\n\nb", "\x00\x7f", "日本", "A" * 100, *made, made[0]]


def rows(spark, values):
    data = [(None if k in (7, 20) else k % 45, t, "x", "y") for k, t in enumerate(values)]
    return spark.createDataFrame(data, "doc_id long, text string, ids string, n_tokens string")


@pytest.mark.parametrize("chunk", [7, 64, 32_768])
def test_encode_equals_library(spark, model, library, chunk):
    values = texts()
    found = sentencepiece.encode(rows(spark, values), model, chunk=chunk).collect()
    ids = sorted(((t, None if t is None else library.encode(t)) for t in values), key=repr)
    hashes = {t: r for t, r in rows(spark, values).select("text", F.xxhash64("text")).distinct().collect()}
    back = {h: t for t, h in hashes.items()}
    assert sorted(((back[r.text_hash], r.ids) for r in found), key=repr) == ids
    assert chunk > 100 or max(r.n_chunks for r in found) > 1


def test_pieces_over_chunk_ends(spark, model, library):
    """No blanks at all: a single stretch reaches over many chunks."""
    rng = random.Random(3)
    values = ["".join(rng.choices("theraionsting", k=n)) for n in (50, 200, 333)]
    found = sentencepiece.encode(rows(spark, values), model, chunk=20).orderBy("doc_id").collect()
    assert [r.ids for r in found] == [library.encode(t) for t in values]


@pytest.mark.parametrize("group", [1, 2, 3, 1000])
def test_groups_of_chunks(spark, model, library, group):
    """However many chunks are combined at once, the ids are the library's."""
    rng = random.Random(9)
    values = ["".join(rng.choices("theraions ting", k=n)) for n in (50, 150, 333)] + [None, "", "a" * 90, "a" * 90]
    found = sentencepiece.encode(rows(spark, values), model, chunk=9, group=group).orderBy("doc_id").collect()
    assert [r.ids for r in found] == [None if t is None else library.encode(t) for t in values]


def test_matrices_combine_in_any_order():
    rng = np.random.default_rng(4)
    matrices = [np.where(rng.random((5, 5)) < 0.3, -np.inf, rng.integers(-9, 0, (5, 5))) for _ in range(7)]
    first = np.array([0.0] + [-np.inf] * 4)
    one_by_one = sentencepiece.entered_scores([*matrices, None], first)[-1]
    assert (np.max(first[:, None] + sentencepiece.combined(matrices, sentencepiece.product), axis=0) == one_by_one).all()
    plain = [[max(a[i, k] + b[k, j] for k in range(5)) for j in range(5)] for i in range(5) for a, b in [matrices[:2]]]
    assert (sentencepiece.product(*matrices[:2]) == np.array(plain)).all()
    maps = [rng.integers(-1, 5, 5) for _ in range(7)]
    joined = sentencepiece.combined(maps, sentencepiece.composed)
    for last in range(5):
        state = last
        for m in reversed(maps):
            state = int(m[state]) if state >= 0 else -1
        assert joined[last] == state


def test_round_trip(spark):
    values = [*texts(), "  two  blanks ", "tab\tand\r\n"]
    encoded = sentencepiece.encode(rows(spark, values), tokenizer_path(), chunk=50)
    found = sentencepiece.decode(encoded, tokenizer_path(), keep=("text_hash",))
    assert found.where(~F.xxhash64("decoded").eqNullSafe(F.col("text_hash"))).count() == 0
    both = sentencepiece.encode(rows(spark, values), tokenizer_path(), chunk=50, decoded=True)
    assert both.count() == len(values)
    assert both.where(~F.xxhash64("decoded").eqNullSafe(F.col("text_hash"))).count() == 0


def test_counts_equal_library(spark, model, library):
    values = texts()
    found = token_counts.count_tokens(rows(spark, values), model).collect()
    assert sorted(r.n_tokens for r in found) == sorted(len(library.encode(t or "")) for t in values)


def test_empty_table(spark):
    empty = rows(spark, [])
    assert sentencepiece.encode(empty, tokenizer_path()).count() == 0
    assert token_counts.count_tokens(empty, tokenizer_path()).count() == 0
