"""Encoding and decoding with a SentencePiece vocabulary as a max-plus parallel scan.

A text is cut into chunks of characters. Where a piece may reach over a chunk's end, the path through the chunks is
described by how far it reaches (its state). Each chunk yields the matrix of best scores from entry state to exit
state. Matrices combine associatively (max of sums): those of neighbouring chunks are joined two by two into one per
group, groups in parallel; one pass over a text's groups gives the scores each group is entered with, and one pass
within each group, again in parallel, those of its chunks. With these, a chunk knows for each exit state the entry
state and ids of the best path; these maps combine associatively in the same two levels from the last chunk back,
which settles every chunk's exit state, and each chunk's ids are read off independently.

Only texts of more than one chunk take part in the scan. What is kept of a chunk for it is ``longest ** 2`` numbers; of
the largest text that Spark can hold (2 GiB) at most 256 chunks meet in a group, and 256 groups. Sums of scores are
regrouped by that; they are exact in 64 bits for scores that are 32-bit floats of like size, as a vocabulary's are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platework.llm.common import in_batches, row_hash, same, stored
from platework.llm.unigram import SPACE, Remembered, Vocabulary, backward, forward, gathered, remembered

CHUNK = 32_768
#: Neighbouring chunks whose matrices are combined in one task.
GROUP = 256
#: Ids that are turned to bytes at once.
STEP_IDS = 1 << 16


class Encoder:
    """Matrices and paths of chunks."""

    def __init__(self, known: Remembered):
        self.known, self.vocabulary, self.finder = known, known.vocabulary, known.vocabulary.finder()

    def ends(self, text: str) -> list:
        return self.vocabulary.matches(self.known.automaton, text)

    def parts(self, text: str, size: int) -> tuple[str, str, int]:
        """A chunk of ``size`` characters with the characters after it: the stretch it begins in, the whole stretches
        inside, and where the stretch that holds its end begins (0: the first one does)."""
        first = self.finder.match(text).end()
        if first > size:
            return text, "", 0
        at = text.rfind(" ", first, size + 1)
        while at > first and text[at - 1] == " ":
            at -= 1
        last = max(at, first)  # a stretch begins here, and so do those found from here on
        for m in self.finder.finditer(text, last):
            if m.start() > size:
                break
            last = m.start()
        return text[:first], text[first:last], last

    def inside(self, text: str) -> tuple[np.ndarray, float]:
        """Ids and score of whole stretches."""
        rows = self.known.rows_inside(text) if text else np.zeros(0, np.int64)
        flat, starts, sizes, scores = self.known.arrays()
        return gathered(flat, starts[rows], sizes[rows]), float(scores[rows].sum())

    def matrix(self, text: str, size: int, first: bool) -> np.ndarray:
        """Best scores from each entry state (row) to each exit state (column); -inf where there is no path."""
        states = self.vocabulary.longest
        out = np.full((states, states), -np.inf)
        head, middle, tail_at = self.parts(text, size)
        exits = range(min(states, len(text) - size + 1))
        entries = range(1 if first else min(states, size, len(head) + (tail_at > 0)))
        if tail_at == 0:  # one stretch reaches over the whole chunk
            ends = self.ends(text)
            for i in entries:
                best, _ = forward(self.vocabulary, ends, text, {i: 0.0}, size)
                out[i, : len(exits)] = [-np.inf if best[size + j] is None else best[size + j] for j in exits]
            return out
        through, tail = self.inside(middle)[1], text[tail_at:]
        best, _ = forward(self.vocabulary, self.ends(tail), tail, {0: 0.0}, size - tail_at)
        right = np.array([-np.inf if best[size - tail_at + j] is None else best[size - tail_at + j] for j in exits])
        ends = self.ends(head)
        for i in entries:
            left = forward(self.vocabulary, ends, head, {i: 0.0}, len(head))[0][len(head)]
            if left is not None:
                out[i, : len(exits)] = left + through + right
        return out

    def paths(self, text: str, size: int, entered: np.ndarray) -> tuple[list[int], list[list[int]], list[int]]:
        """Given the scores a chunk is entered with: the ids common to all exits, the further ids and the entry state
        of the best path to each exit state (-1: none)."""
        states = self.vocabulary.longest
        start = {i: float(s) for i, s in enumerate(entered) if s > -np.inf}
        head, middle, tail_at = self.parts(text, size)
        exits = range(min(states, len(text) - size + 1))
        rest, entry, ids = [[] for _ in range(states)], [-1] * states, []
        if tail_at == 0:
            best, by = forward(self.vocabulary, self.ends(text), text, start, size)
            for j in exits:
                if best[size + j] is not None:
                    rest[j], entry[j] = backward(self.vocabulary, text, by, size + j)
            return ids, rest, entry
        best, by = forward(self.vocabulary, self.ends(head), head, {k: v for k, v in start.items() if k <= len(head)}, len(head))
        ids, came = backward(self.vocabulary, head, by, len(head))
        ids += self.inside(middle)[0].tolist()
        tail = text[tail_at:]
        best, by = forward(self.vocabulary, self.ends(tail), tail, {0: 0.0}, size - tail_at)
        for j in exits:
            if best[size - tail_at + j] is not None:
                rest[j], entry[j] = backward(self.vocabulary, tail, by, size - tail_at + j)[0], came
        return ids, rest, entry


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product: best scores over two neighbouring stretches, from those over each."""
    return np.max(a[:, :, None] + b[None, :, :], axis=1)


def combined(parts: list, join) -> object:
    """Neighbours joined two by two until one is left; ``join`` is associative."""
    while len(parts) > 1:
        parts = [join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def entered_scores(matrices: list[np.ndarray], first: np.ndarray) -> list[np.ndarray]:
    """The scores that each of neighbouring stretches is entered with, given those of the first."""
    scores = [first]
    for m in matrices[:-1]:
        scores.append(np.max(scores[-1][:, None] + m, axis=0))
    return scores


def composed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Entry state for each exit state over two neighbouring stretches, from those of each (-1: no path)."""
    return np.where(b >= 0, a[b], -1)


def exit_states(entries: list[np.ndarray], last: int) -> list[int]:
    """The state in which each of neighbouring stretches is left, given that of the last: the one in which the next is
    entered."""
    states = [last]
    for entry in reversed(entries[1:]):
        states.append(int(entry[states[-1]]))
    return states[::-1]


def encode(
    df: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text", chunk: int = CHUNK,
    decoded: bool = False, group: int = GROUP,
) -> DataFrame:
    """Per row: the id, ``text_hash``, ``ids`` (the pieces' ids, without begin and end marks), ``n_chunks`` and, with
    ``decoded``, the text that decoding the ids gives.

    Null texts have null ids, empty texts none. Rows equal in id and text are encoded alike, each in a row of its own;
    rows that only share an id are told apart by ``text_hash``. Ties between segmentations go as in the C++ library
    (see ``unigram``). An empty table gives an empty result; other columns are not read.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary.load(model))
    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), row_hash(text_column).alias("text_hash"))

    def encoder() -> Encoder:
        return Encoder(remembered(shared, with_ids=True))

    def whole(batch):
        """Texts of one chunk: entered and left in state 0, so each stretch is on the best path as it is."""
        texts = batch["text"].to_pylist()
        known = remembered(shared, with_ids=True)
        rows, bounds = known.rows_of(texts)
        flat, starts, sizes, _ = known.arrays()
        sizes = sizes[rows]
        offsets = np.concatenate([[0], np.cumsum(sizes)])[bounds].astype(np.int32)
        lists = pa.ListArray.from_arrays(
            pa.array(offsets), pa.array(gathered(flat, starts[rows], sizes)), mask=pa.array([t is None for t in texts]))
        found = {
            "id": batch["id"], "text_hash": batch["text_hash"], "ids": lists, "n_chunks": np.ones(len(texts), np.int32)}
        return found | ({"decoded": texts_of(lists, shared)} if decoded else {})

    def cut(batch):
        out = {"id": [], "text_hash": [], "k": [], "size": [], "last": [], "part": []}
        for i, h, t in zip(batch["id"].to_pylist(), batch["text_hash"].to_pylist(), batch["text"].to_pylist(), strict=True):
            t = " " + t.replace(SPACE, " ")
            for k, at in enumerate(range(0, len(t), chunk)):
                part = t[at : at + chunk + shared.value.longest - 1]
                size = min(chunk, len(t) - at)
                for name, value in zip(out, (i, h, k, size, at + chunk >= len(t), part), strict=True):
                    out[name].append(value)
        return out

    def matrices(batch):
        parts = zip(batch["part"].to_pylist(), batch["size"].to_pylist(), batch["k"].to_pylist(), strict=True)
        found = [encoder().matrix(part, size, k == 0).ravel().tolist() for part, size, k in parts]
        return {"id": batch["id"], "text_hash": batch["text_hash"], "k": batch["k"], "scores": found}

    def square(scores) -> list[np.ndarray]:
        return [np.asarray(x).reshape(shared.value.longest, -1) for x in scores]

    def begin() -> np.ndarray:
        return np.where(np.arange(shared.value.longest) == 0, 0.0, -np.inf)

    def joined_matrices(group):
        group = group.sort_values("k")
        found = combined(square(group["scores"]), product)
        return group[["id", "text_hash", "g"]].head(1).assign(scores=[found.ravel().tolist()])

    def scan_groups(group):
        group = group.sort_values("g")
        found = entered_scores(square(group["scores"]), begin())
        return group[["id", "text_hash", "g"]].assign(entered=[x.tolist() for x in found])

    def scan_chunks(group):
        group = group.sort_values("k")
        found = entered_scores(square(group["scores"]), np.asarray(group["entered"].iloc[0]))
        return group[["id", "text_hash", "k"]].assign(entered=[x.tolist() for x in found])

    def paths(batch):
        parts = zip(batch["part"].to_pylist(), batch["size"].to_pylist(), batch["entered"].to_pylist(), strict=True)
        found = [encoder().paths(part, size, np.asarray(entered)) for part, size, entered in parts]
        names = dict(zip(("body", "rest", "entry"), map(list, zip(*found, strict=True)), strict=True))
        return {"id": batch["id"], "text_hash": batch["text_hash"], "k": batch["k"]} | names

    def joined_maps(group):
        group = group.sort_values("k")
        found = combined([np.asarray(x) for x in group["entry"]], composed)
        return group[["id", "text_hash", "g"]].head(1).assign(entry=[found.tolist()])

    def settle_groups(group):
        group = group.sort_values("g")
        return group[["id", "text_hash", "g"]].assign(left=exit_states([np.asarray(x) for x in group["entry"]], 0))

    def settle_chunks(group):
        group = group.sort_values("k")
        states = exit_states([np.asarray(x) for x in group["entry"]], int(group["left"].iloc[0]))
        return group[["id", "text_hash", "k"]].assign(left=states)

    out = f"id {kind}, text_hash long, ids array<int>, n_chunks int" + ", decoded string" * decoded
    short = F.col("text").isNull() | (F.length("text") < chunk)
    one = in_batches(rows.where(short), whole, out)

    long = rows.where(~short)
    copies = long.groupBy("id", "text_hash").agg(F.count("*").alias("copies"))
    parts = stored(
        in_batches(long, cut, f"id {kind}, text_hash long, k int, size int, last boolean, part string")
        .dropDuplicates(["id", "text_hash", "k"]), "chunks")
    key = f"id {kind}, text_hash long, k int"
    by_group, group_key = F.floor(F.col("k") / group).cast("int"), ("id", "text_hash", "g")

    def over_groups(chunks, what, join, scan, result):
        """Each chunk with what its group is entered with (or left in): the chunks of a group joined to one, groups by
        themselves, then one row per group scanned."""
        key = f"id {kind}, text_hash long, g int"
        groups = chunks.groupBy(*group_key).applyInPandas(join, f"{key}, {what}")
        scanned = stored(groups.groupBy("id", "text_hash").applyInPandas(scan, f"{key}, {result}"), "scanned-groups")
        return chunks.join(scanned, same(chunks, scanned, *group_key)).select(chunks["*"], scanned[result.split(" ")[0]])

    scores = stored(in_batches(parts, matrices, f"{key}, scores array<double>").withColumn("g", by_group), "matrices")
    entered = over_groups(scores, "scores array<double>", joined_matrices, scan_groups, "entered array<double>").groupBy(
        *group_key).applyInPandas(scan_chunks, f"{key}, entered array<double>")
    joined = parts.join(entered, same(parts, entered, "id", "text_hash", "k")).select(parts["*"], entered["entered"])
    found = stored(in_batches(joined, paths, f"{key}, body array<int>, rest array<array<int>>, entry array<int>"), "paths")
    maps = found.select("id", "text_hash", "k", "entry", by_group.alias("g"))
    left = over_groups(maps, "entry array<int>", joined_maps, settle_groups, "left int").groupBy(
        *group_key).applyInPandas(settle_chunks, f"{key}, left int")
    chosen = found.join(left, same(found, left, "id", "text_hash", "k")).select(
        found["id"], found["text_hash"], found["k"],
        F.concat(found["body"], F.element_at(found["rest"], left["left"] + 1)).alias("part"))
    many = chosen.groupBy("id", "text_hash").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("k", "part"))), lambda x: x["part"])).alias("ids"),
        F.count("*").cast("int").alias("n_chunks"))
    many = many.join(copies, same(many, copies, "id", "text_hash")).select(
        many["id"], many["text_hash"], many["ids"], many["n_chunks"],
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).drop("copy")
    if decoded:
        many = decode(many, model, keep=("id", "text_hash", "ids", "n_chunks"))
    return one.unionByName(many).withColumnRenamed("id", id_column)


_BYTES: dict[int, tuple] = {}


def piece_bytes(shared) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pieces' bytes joined, with each one's start and size."""
    vocabulary = shared.value
    if vocabulary.fingerprint not in _BYTES:
        sizes = np.array([len(t) for t in vocabulary.texts])
        _BYTES[vocabulary.fingerprint] = (
            np.frombuffer(b"".join(vocabulary.texts), np.uint8), (np.cumsum(sizes) - sizes).astype(np.int32), sizes.astype(np.int32))
    return _BYTES[vocabulary.fingerprint]


def texts_of(lists: pa.ListArray, shared) -> list[str | None]:
    """The texts of lists of ids, some ten thousand ids at a time."""
    flat, starts, sizes = piece_bytes(shared)
    ids, offsets, known = lists.values.to_numpy(), lists.offsets.to_numpy(), lists.is_valid().to_pylist()
    out: list[str | None] = []
    at = 0
    while at < len(known):
        to = max(int(np.searchsorted(offsets, offsets[at] + STEP_IDS, side="right")) - 1, at + 1)
        part = ids[offsets[at] : offsets[to]]
        joined = gathered(flat, starts[part], sizes[part]).tobytes()
        bounds = np.concatenate([[0], np.cumsum(sizes[part], dtype=np.int64)])[offsets[at : to + 1] - offsets[at]].tolist()
        out += [
            joined[a:b].removeprefix(b" ").decode(errors="replace") if k else None
            for a, b, k in zip(bounds[:-1], bounds[1:], known[at:to], strict=True)]
        at = to
    return out


def decode(df: DataFrame, model: str, ids_column: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``decoded``: the text of the ids, without the blank that encoding puts first.

    Null ids give null, no ids the empty text. Byte pieces are joined to characters, bytes that are no UTF-8 become
    U+FFFD; ids outside the vocabulary are an error.
    """
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(model))

    def run(batch):
        return {c: batch[c] for c in keep} | {"decoded": texts_of(batch[ids_column], shared)}

    kept = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return in_batches(df.select(ids_column, *[c for c in keep if c != ids_column]), run, f"{kept}, decoded string")
