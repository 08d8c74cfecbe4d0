"""Token counts without tokens: an Aho-Corasick automaton finds the vocabulary's pieces in one walk, and a dynamic
programme carries the best score of each prefix and the number of its pieces; no path is kept or walked back. Stretches of
text between which no piece reaches are counted once and remembered."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platework.llm.common import in_batches
from platework.llm.unigram import Vocabulary, remembered


def count_tokens(df: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: the id, ``n_tokens`` (pieces of the best segmentation, no begin or end marks) and its ``score``.

    Null and empty texts have no tokens and the score 0. Rows that repeat, or share an id, are counted each by itself;
    an empty table gives an empty result; other columns are not read. Texts of any length are counted whole. ``model``
    is the path of a SentencePiece model on the driver; its size bounds what is sent to the executors.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary.load(model))

    def run(batch):
        known = remembered(vocabulary, with_ids=False)
        rows, bounds = known.rows_of(batch["text"].to_pylist())
        _, _, sizes, scores = known.arrays()
        sizes, scores = sizes[rows], scores[rows]
        each = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
        return {
            id_column: batch[id_column],
            "n_tokens": np.array([sizes[a:b].sum(dtype=np.int64) for a, b in each], np.int64),
            "score": np.array([scores[a:b].sum() for a, b in each], np.float64),
        }

    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(F.col(id_column), F.col(text_column).alias("text"))
    return in_batches(rows, run, f"`{id_column}` {kind}, n_tokens long, score double")
