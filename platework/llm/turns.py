"""Conversations whose turns are missing, empty, cut off, repeated or out of order, and their cheapest repair."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platework.llm.common import bound_batches, schemas, stored
from platework.llm.repair import CHUNK, Joined, Written, sign, transfers

BLANKS = " \t\n\x0b\x0c\r"
_NEXT = {("s", "u"), ("u", "a"), ("a", "u")}
#: Solved chunks that a task remembers by their signs; conversations mostly repeat a few patterns.
REMEMBERED = 50_000


def _kind(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as faulty sources give them, by crc32 of ``conv_id:turn`` modulo 20: 0 is dropped, 1 loses its text, 2 its
    ``.!?``, 3 comes twice, 4 has the role user. Nulls count as one space."""
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                     F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(named) % 20).alias("__fault")).where("__fault > 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("__fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("__fault") == 1, "").when(F.col("__fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(True), F.when(F.col("__fault") == 3, 2).otherwise(1))).alias("__each"),
    ).drop("__each")


def _with_digest(rows: DataFrame) -> DataFrame:
    """Rows with the digest that stands for role and text, and settles the order of rows of one turn and role."""
    return rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))


def _order() -> list:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _signs(rows: DataFrame) -> DataFrame:
    """One row per distinct row of a conversation: its number of copies, and whether an earlier turn says the same."""
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    fault = F.when(last == "", 2).when(~last.isin(".", "!", "?"), 1).otherwise(0)
    # copies of a row are counted before the shuffle: one that is repeated without end is one row per task
    counted = stored(
        rows.groupBy("conv_id", "turn", "role", "digest").agg(
            F.count(F.lit(1)).alias("times"), F.any_value(fault).alias("fault")), "turns")
    # null turns come first, so that a struct of (is there a turn, turn) has the order of the rows
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = stored(
        counted.groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("first"), F.count(F.lit(1)).alias("turns"))
        .where("turns > 1").drop("turns"), "first-turns")
    one, other = counted.alias("one"), first.alias("other")
    joined = one.join(
        other, F.col("one.conv_id").eqNullSafe(F.col("other.conv_id")) & (F.col("one.role") == F.col("other.role"))
        & (F.col("one.digest") == F.col("other.digest")), "left")
    again = F.col("other.first").isNotNull() & ~F.col("other.first").eqNullSafe(
        F.struct(F.col("one.turn").isNotNull().alias("known"), F.col("one.turn").alias("turn")))
    return joined.select(
        "one.conv_id", "one.turn", "one.role", "one.digest", "one.times",
        F.when(F.col("fault") == 2, 2).when(again, 3).otherwise(F.col("fault")).alias("fault"))


def _chunks(signs: DataFrame) -> DataFrame:
    """(conv_id, place, signs, edits): the rows in order, in chunks, with the cheapest edits of each.

    Rows are dealt by ranges, so that a conversation of any size is spread over tasks; only the first and the last
    conversation of a task can go on elsewhere. What is told apart by ``place`` is in the order of the rows.
    """
    kinds, arrow = schemas(
        f"conv_id {_kind(signs, 'conv_id')}, place long, signs string, "
        "edits array<struct<entry:int,leave:int,cost:long,audit:string>>")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << 33
        known, out, count = {}, [], 0

        def edits(text: str, whole: bool):
            key = (text, whole)
            if key not in known:
                if len(known) >= REMEMBERED:
                    known.clear()
                found = transfers(text, whole)
                if len(text) > 64:  # long ones do not come again
                    return found
                known[key] = found
            return known[key]

        def put(conv, text, whole):
            nonlocal count
            out.append((conv, base + count, text, edits(text, whole)))
            count += 1

        def flushed():
            found = pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], arrow.field(0).type), pa.array([r[1] for r in out], pa.int64()),
                 pa.array([r[2] for r in out], pa.string()),
                 pa.array([[dict(zip(("entry", "leave", "cost", "audit"), x, strict=True)) for x in r[3]] for r in out],
                          arrow.field(3).type)], schema=arrow)
            out.clear()
            return found

        conv, text, opened, first = None, "", False, True
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "role", "times", "fault")]
            for next_conv, role, times, fault in zip(*columns, strict=True):
                if text or opened:
                    if next_conv != conv:
                        # an opened or first conversation may have begun elsewhere
                        put(conv, text, not (opened or first))
                        text, opened, first = "", False, False
                conv = next_conv
                left = sign(role, fault)
                spare = sign(role, fault if fault == 2 else 3)
                while times:
                    take = min(times, CHUNK - len(text))
                    text += left + spare * (take - 1)
                    left, times = spare, times - take
                    if len(text) == CHUNK:
                        put(conv, text, False)
                        text, opened = "", True
                if len(out) >= 256:
                    yield flushed()
        if text:
            put(conv, text, False)  # may go on elsewhere
        if out:
            yield flushed()

    ordered = signs.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    bound_batches(signs.sparkSession)
    return ordered.mapInArrow(solve, kinds)


class _Conversation:
    """What is gathered while the rows of one conversation go by."""

    def __init__(self, conv):
        self.conv, self.joined, self.faults, self.written = conv, Joined(), [0, 0, 0], None
        self.low = self.high = self.turn = None
        self.turns = self.illegal = self.cost = 0
        self.before, self.pieces, self.digest, self.begun = None, [], hashlib.sha256(), False

    def chunk(self, signs, edits):
        self.faults = [n + sum(signs.count(sign(r, k)) for r in "sua-") for n, k in zip(self.faults, (2, 3, 1), strict=True)]
        self.joined.add([(x["entry"], x["leave"], x["cost"], x["audit"]) for x in edits])

    def _write(self, turns):
        for role, text in turns:
            self.digest.update(("\n" if self.begun else "").encode() + f"{role}:{text}".encode())
            self.begun = True

    def row(self, turn, role, text):
        if self.written is None:
            self.cost, self.pieces = self.joined.result()
            self.written = Written(self.pieces)
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
            self.turns += 1
        self.illegal += self.before is not None and (self.before, role[:1]) not in _NEXT
        self.before = role[:1]
        self._write(self.written.row(role, text))

    def result(self):
        if self.written is not None:
            self._write(self.written.rest())
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.faults, self.illegal, self.cost, "".join(self.pieces), self.digest.hexdigest())


def repaired(rows: DataFrame, every: DataFrame) -> DataFrame:
    """Faults and the cheapest repair of each conversation of ``every`` (column ``conv_id``).

    ``rows`` has ``conv_id``, ``turn`` (whole numbers), ``role`` and ``text``; other columns are not read. Rows are taken
    by turn, nulls first; ties by role, then by the SHA-256 of the text. Null roles and texts count as one space, null
    ids are one conversation. A role that begins with none of s, u, a (an empty one too) cannot be kept. Result:
    ``conv_id``, ``gaps`` (missing turns between the first and the last), ``blank``, ``duplicate``, ``truncated`` (rows by
    their first fault), ``illegal`` (neighbours out of order), ``cost``, ``audit`` (K keep, R rerole, D delete, I insert)
    and ``repaired_sha256`` of the repaired ``role:text`` lines. A conversation without rows has zeros, an empty audit
    and the hash of nothing; an empty table an empty result.

    Memory of a task: one chunk's lattice, and one letter per row of the conversation at hand (as long as its result);
    texts only pass through. The hash needs a conversation's texts one after the other, in one task.
    """
    rows = _with_digest(rows)
    chunks = _chunks(_signs(rows))
    kind = _kind(rows, "conv_id")
    parts = [
        (every.select("conv_id").distinct(), {}),
        (chunks, {"place": F.col("place"), "signs": F.col("signs"), "edits": F.col("edits")}),
        (rows, {"turn": F.col("turn"), "role": F.col("role"), "digest": F.col("digest"), "text": F.col("text")}),
    ]
    wanted = {"place": "long", "signs": "string", "edits": chunks.schema["edits"].dataType.simpleString(),
              "turn": "long", "role": "string", "digest": "binary", "text": "string"}
    whole = None
    for step, (part, has) in enumerate(parts):
        one = part.select(
            "conv_id", F.lit(step).alias("step"),
            *[has.get(c, F.lit(None)).cast(t).alias(c) for c, t in wanted.items()])
        whole = one if whole is None else whole.unionByName(one)
    kinds, arrow = schemas(
        f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        "repaired_sha256 string")

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, now = [], None

        def flushed():
            done = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), arrow, strict=True)], schema=arrow)
            found.clear()
            return done

        for batch in batches:
            names = ("conv_id", "step", "signs", "edits", "turn", "role", "text")
            for conv, step, signs, edits, turn, role, text in zip(
                    *[batch.column(n).to_pylist() for n in names], strict=True):
                if now is None or now.conv != conv:
                    if now is not None:
                        found.append(now.result())
                    now = _Conversation(conv)
                if step == 1:
                    now.chunk(signs, edits)
                elif step == 2:
                    now.row(turn, role, text)
                if len(found) >= 256:
                    yield flushed()
        if now is not None:
            found.append(now.result())
        if found:
            yield flushed()

    order = [F.col("conv_id").asc_nulls_first(), "step", "place", F.col("turn").asc_nulls_first(), "role", "digest"]
    bound_batches(rows.sparkSession)
    return whole.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(follow, kinds)
