"""What both exact dedup operators need: places where a stretch of ``window`` units (bytes or words) may repeat.

Each window is assigned the least hash among its grams (of fewer units), and consecutive windows with the same gram
form a run. Equal windows choose equal grams at equal places, so a window can only repeat where its gram does. Rows
here are runs: a few per hundred units of text, keyed by gram (``anchor``) and by the run's content (``run``). Copies
of a run are one row with its first place from then on. Runs of grams with several contents go, with their content, to
the operator's own method, which tells for each of their windows whether it also starts earlier in another run.

A run has 64 windows at most, so such an answer is a bit mask. ``place`` is ``start * 128 + windows``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platework.llm.common import as_bytes, in_batches, mixed, row_hash, same, sent_if_small, stored

#: Units of a text that are looked at together, and bytes of run contents that go to one group.
PIECE, GROUP_BYTES = 1 << 19, 1 << 20
#: A gram with more contents than this is taken apart into windows, which are grouped by their own hashes.
MANY = 20_000
_PLACES = np.uint64((1 << 21) - 1)

_BASE = np.uint64(0xD1342543DE82EF95)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 14)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def runs(codes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, run, place) of each run of windows of a text given as one 64-bit code per unit."""
    out = []
    for at in range(0, max(len(codes) - window + 1, 0), PIECE):
        part = codes[at : at + PIECE + window - 1]
        n = len(part)
        up, down = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(part * up[:n], out=total[1:])
        grams = mixed((total[gram:] - total[:-gram]) * down[: n - gram + 1])
        order = (grams & ~_PLACES) | np.arange(len(grams), dtype=np.uint64)
        best = (sliding_minimum(order, window - gram + 1) & _PLACES).astype(np.int64)
        starts = np.flatnonzero(np.diff(best, prepend=-1))
        counts = np.diff(starts, append=len(best))
        content = mixed((total[starts + counts - 1 + window] - total[starts]) * down[starts] + counts.astype(np.uint64))
        out.append((grams[best[starts]].view(np.int64), content.view(np.int64), (starts + at) * 128 + counts))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def repeated_runs(
    df: DataFrame, id_column: str, text_column: str, codes: Callable[[bytes], np.ndarray], window: int, gram: int,
) -> DataFrame:
    """The runs whose gram occurs twice or more: anchor, run, id, ``text_hash``, place."""
    if window - gram + 1 > 64:
        raise ValueError("a run would have more than 64 windows")
    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(
        F.col(id_column).alias("id"), row_hash(text_column).alias("text_hash"), F.col(text_column).alias("text"))

    def run(batch):
        found = [runs(codes(t or b""), window, gram) for t in as_bytes(batch["text"])]
        sizes = [len(x[0]) for x in found]
        which = pa.array(np.repeat(np.arange(len(found)), sizes))
        names = dict(zip(("anchor", "run", "place"), (np.concatenate(x) for x in zip(*found, strict=True)), strict=True))
        return {k: pa.array(v) for k, v in names.items()} | {c: batch[c].take(which) for c in ("id", "text_hash")}

    found = in_batches(rows, run, f"anchor long, run long, id {kind}, text_hash long, place long")
    # Counted before the shuffle, then joined: unlike a window, Spark can split a join at a gram that many texts hold.
    often = stored(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    return stored(found.join(often, "anchor"), "runs")


def first_places(repeated: DataFrame) -> DataFrame:
    """Per anchor and run its first place, how often it occurs, and how many contents its anchor has."""
    found = stored(repeated.groupBy("anchor", "run").agg(
        F.min(F.struct("id", "text_hash", "place")).alias("first"), F.count("*").alias("times")), "firsts")
    several = stored(found.groupBy("anchor").agg(F.count("*").alias("contents")).where("contents > 1"), "several")
    return stored(
        found.join(several, "anchor", "left").withColumn("contents", F.coalesce("contents", F.lit(1))), "contents")


def with_content(
    firsts: DataFrame, df: DataFrame, id_column: str, text_column: str, content: Callable[[bytes], bytes], width: int,
    window: int,
) -> DataFrame:
    """Runs of anchors with several contents: anchor, run, first id, text_hash and place, and ``content`` (the units
    of the run; ``width`` bytes each in what ``content`` gives for a text)."""
    kind = df.schema[id_column].dataType.simpleString()
    several = firsts.where("contents > 1")
    wanted = stored(several.groupBy(F.col("first.id").alias("id"), F.col("first.text_hash").alias("text_hash")).agg(
        F.collect_list(F.struct("anchor", "run", "first.place", "contents")).alias("wanted")), "wanted")
    keys = sent_if_small(wanted.select(F.col("id").alias("key_id"), F.col("text_hash").alias("key_hash")))
    rows = df.select(
        F.col(id_column).alias("id"), row_hash(text_column).alias("text_hash"), F.col(text_column).alias("text"))
    rows = rows.join(
        keys, F.col("id").eqNullSafe(F.col("key_id")) & (F.col("text_hash") == F.col("key_hash")), "left_semi")
    rows = rows.join(
        wanted.withColumnsRenamed({"id": "of_id", "text_hash": "of_hash"}),
        F.col("id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")),
    ).select("id", "text_hash", "text", "wanted")

    def run(batch):
        out = {k: [] for k in ("anchor", "run", "place", "contents", "content")}
        which = []
        for k, (text, runs_here) in enumerate(zip(as_bytes(batch["text"]), batch["wanted"].to_pylist(), strict=True)):
            data = content(text or b"")
            for r in runs_here:
                start, count = divmod(r["place"], 128)
                which.append(k)
                for name in ("anchor", "run", "place", "contents"):
                    out[name].append(r[name])
                out["content"].append(data[start * width : (start + count - 1 + window) * width])
        return out | {c: batch[c].take(pa.array(which, pa.int64())) for c in ("id", "text_hash")}

    # A row that repeats gives its runs again; they count once, as they have the same places.
    return in_batches(
        rows, run,
        f"anchor long, run long, id {kind}, text_hash long, place long, contents long, content binary")


def exact(table: pa.Table) -> pd.DataFrame:
    """As pandas with integers that may be missing, instead of floats."""
    return table.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}.get)


def order_of(table: pa.Table) -> np.ndarray:
    """Dense rank of each row's first document among those of the table, nulls first."""
    documents = exact(table.select(["id", "text_hash"]))
    ranked = documents.drop_duplicates().sort_values(["id", "text_hash"], na_position="first")
    ranked["rank"] = np.arange(len(ranked))
    return documents.merge(ranked, on=["id", "text_hash"], how="left")["rank"].to_numpy()


def masks(
    contents: DataFrame, method: Callable[[list[bytes], np.ndarray, np.ndarray], np.ndarray], width: int, window: int,
    by_document: bool,
) -> DataFrame:
    """(anchor, run, mask): bit k is set if the run's window k also starts earlier in another run.

    ``method`` gets the contents of a group with the rank of each one's first document and its start, and returns a
    mask for each. With ``by_document`` only starts in other, earlier documents (by id) count.
    """
    schema = pa.schema([("anchor", pa.int64()), ("run", pa.int64()), ("mask", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        if by_document:
            rank = exact(table.select(["id"]))["id"].rank(method="dense", na_option="top").to_numpy().astype(np.int64)
            start = np.zeros(len(rank), np.int64)
        else:
            rank, start = order_of(table), table["place"].to_numpy() // 128
        found = method(table["content"].to_pylist(), rank, start)
        keep = found != 0
        return pa.table({
            "anchor": table["anchor"].to_numpy()[keep], "run": table["run"].to_numpy()[keep],
            "mask": found[keep].astype(np.int64)}, schema=schema)

    held = stored(contents, "contents")
    size = held.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    few = held.where(F.col("contents") <= MANY).withColumn(
        "part", F.pmod(F.xxhash64("anchor"), F.lit(size // GROUP_BYTES + 1)))
    found = few.groupBy("part").applyInArrow(run, "anchor long, run long, mask long")

    def windows(batch):
        out, which = {"one": [], "two": [], "bit": []}, []
        for k, (data, place) in enumerate(zip(as_bytes(batch["content"]), batch["place"].to_pylist(), strict=True)):
            for bit in range(place % 128):
                digest = _xxh128(data[bit * width : (bit + window) * width])
                out["one"].append(digest[0])
                out["two"].append(digest[1])
                out["bit"].append(bit)
                which.append(k)
        names = ("anchor", "run", "id", "text_hash", "place")
        return out | {c: batch[c].take(pa.array(which, pa.int64())) for c in names}

    kind = contents.schema["id"].dataType.simpleString()
    many = in_batches(
        held.where(F.col("contents") > MANY).drop("contents"), windows,
        f"anchor long, run long, id {kind}, text_hash long, place long, one long, two long, bit int")
    at = F.struct("id") if by_document else F.struct(
        "id", "text_hash", (F.shiftright("place", 7) + F.col("bit")).alias("start"))
    many = many.withColumn("at", at)
    lowest = many.groupBy("one", "two").agg(F.min("at").alias("lowest"))
    later = many.join(lowest, ["one", "two"]).where(F.col("lowest") < F.col("at"))
    later = later.groupBy("anchor", "run").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    return found.unionByName(later)


def _xxh128(data: bytes) -> tuple[int, int]:
    import xxhash

    return tuple(np.frombuffer(xxhash.xxh3_128_digest(data), np.int64).tolist())


def covered(repeated: DataFrame, firsts: DataFrame, answers: DataFrame, by_document: bool) -> DataFrame:
    """Per document with such windows: id, ``text_hash``, ``spans`` (flat list: first window start, one after the
    last, ...), of the windows that also start earlier."""
    told = firsts.join(answers, ["anchor", "run"], "left").where("times > 1 or mask is not null")
    told = told.select("anchor", "run", "first", F.coalesce("mask", F.lit(0)).cast("long").alias("mask"))
    told = stored(told, "told")  # so that both sides of the next join are shuffled for it, and hot keys can be split
    kind = repeated.schema["id"].dataType.simpleString()
    here = F.col("id").eqNullSafe(F.col("first.id"))
    if not by_document:
        here = here & (F.col("text_hash") == F.col("first.text_hash")) & (F.col("place") == F.col("first.place"))
    found = repeated.join(told, ["anchor", "run"]).select(
        "id", "text_hash", "place", F.when(here, F.col("mask")).otherwise(F.lit(-1).cast("long")).alias("mask"))
    found = found.where("mask != 0").groupBy("id", "text_hash").agg(
        F.collect_list("place").alias("places"), F.collect_list("mask").alias("masks"))

    def run(batch):
        spans = []
        for places, bits in zip(batch["places"], batch["masks"], strict=True):
            place, mask = places.values.to_numpy(), bits.values.to_numpy().view(np.uint64)
            starts, counts = place // 128, place % 128
            within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            bit = (np.repeat(mask, counts) >> within.astype(np.uint64)) & np.uint64(1)
            at = np.unique((np.repeat(starts, counts) + within)[bit == 1])
            edge = np.flatnonzero(np.diff(at) != 1)
            firsts_, lasts = at[np.concatenate([[0], edge + 1])], at[np.concatenate([edge, [len(at) - 1]])]
            spans.append(np.stack([firsts_, lasts + 1], axis=1).ravel())
        return {"id": batch["id"], "text_hash": batch["text_hash"], "spans": pa.array(spans, pa.list_(pa.int64()))}

    return stored(in_batches(found, run, f"id {kind}, text_hash long, spans array<long>"), "spans")


def removed_units(spans: np.ndarray, window: int, n: int) -> np.ndarray:
    """Edges (first, one after the last, ...) of the runs of units that the windows starting in the spans cover."""
    edges = spans.reshape(-1, 2)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, edges[:, 0], 1)
    np.add.at(change, edges[:, 1] - 1 + window, -1)
    inside = np.cumsum(change) > 0
    return np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8))).reshape(-1, 2)


def with_spans(df: DataFrame, spans: DataFrame, id_column: str, text_column: str, *columns: str) -> DataFrame:
    """Rows of ``df`` (id, ``text`` and ``columns``) with the spans of their document, if any."""
    rows = df.select(
        F.col(id_column).alias("id"), row_hash(text_column).alias("text_hash"), F.col(text_column).alias("text"),
        *[F.col(f"`{c}`") for c in columns])
    found = sent_if_small(spans, "spans")
    return rows.join(found, same(rows, found, "id", "text_hash"), "left").select(rows["*"], found["spans"])
