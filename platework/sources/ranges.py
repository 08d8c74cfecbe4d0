"""Documents of any size, read by byte ranges and cut at the ends of their records.

Spark splits a text file by bytes; with ``]`` as line end, the text that begins in a range comes as pieces that each end
before a ``]``. There, a JSON lexer is in one of two states (inside a string or not) at some depth. What a range
does to either state is a small row, and rows of neighbouring ranges combine associatively: the state by parity, the depth by
sums. Windows over them (a row per range, not per record) tell every range how it is entered; a second read cuts each range
by itself. Only elements that reach over a range's end are put together from two or more ranges.

The text stays within its task in both reads. It is numpy on byte arrays, since Spark has no function with a running
state over bytes; everything else is DataFrame code.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platework.functions import documents as d
from platework.functions.text import to_int
from platework.schemas import CONTRACT
from platework.session import new_folder
from platework.sources.documents import contract_rows, fault_of, only_good
from platework.sources.tables import read_table, write_table

RANGE_BYTES = 128 << 20
#: Bytes that are lexed at once.
STEP_BYTES = 4 << 20
#: Ranges are broadcast up to this many (a file's name and some numbers each), else joined by shuffle.
FEW_RANGES = 20_000

_QUOTE, _COMMA, _OPEN, _CLOSE = ord('"'), ord(","), b"[{", b"]}"
_ESCAPE = re.compile(rb"\\.", re.DOTALL)
_BLANK = b" \t\r\n"
_SUMMARY = "source_file string, at long, flips int, deltas array<int>, opened array<map<int,boolean>>"
_PIECES = "source_file string, at long, seq int, element boolean, first boolean, last boolean, nth int, part string"
_ARROW = {
    "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()),
    "array<map<int,boolean>>": pa.list_(pa.map_(pa.int32(), pa.bool_())),
}


class Lexed:
    """A stretch of text that ends where a ``]`` follows: which bytes are brackets or commas outside strings, and the
    depth after each byte relative to its begin."""

    def __init__(self, text: bytes, inside: bool):
        self.text = text
        # An escaped character is never a quote. A backslash at the very end would escape a "]": no matter in a string.
        plain = np.frombuffer(_ESCAPE.sub(b"  ", text) if b"\\" in text else text, np.uint8)
        quotes = plain == _QUOTE
        self.quotes = np.flatnonzero(quotes)
        within = (np.cumsum(quotes, dtype=np.int32) + inside) & 1
        outside = (within == 0) & ~quotes
        opens = outside & ((plain == _OPEN[0]) | (plain == _OPEN[1]))
        closes = outside & ((plain == _CLOSE[0]) | (plain == _CLOSE[1]))
        self.opens, self.closes = np.flatnonzero(opens), np.flatnonzero(closes)
        self.commas = np.flatnonzero(outside & (plain == _COMMA))
        self.depth = np.cumsum(opens.astype(np.int32) - closes, dtype=np.int32)
        self.delta = int(self.depth[-1]) if len(text) else 0

    def opens_data(self, at: int) -> bool:
        """Whether the bracket at this place begins an array under the key ``data``. The key stands in the same piece,
        as no ``]`` lies between."""
        if self.text[at] != _OPEN[0]:
            return False
        n = int(np.searchsorted(self.quotes, at))
        if n < 2 or self.text[int(self.quotes[n - 1]) + 1 : at].strip(_BLANK) != b":":
            return False
        try:
            return json.loads(self.text[int(self.quotes[n - 2]) : int(self.quotes[n - 1]) + 1]) == "data"
        except ValueError:
            return False


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes | None]]:
    """Per range its text in stretches of some megabytes; None after the last. Pieces but a file's first begin with the
    ``]`` that ended the one before."""
    key, held, size = None, [], 0
    for batch in batches:
        for name, at, piece in zip(*(batch[c].to_pylist() for c in ("source_file", "at", "piece")), strict=True):
            if key != (name, at):
                if key is not None:
                    yield *key, b"".join(held)
                    yield *key, None
                key, held, size = (name, at), [piece if at == 0 else b"]" + piece], 0
            elif size > STEP_BYTES:
                yield name, at, b"".join(held)
                held, size = [b"]" + piece], 0
            else:
                held += [b"]", piece]
            size += len(piece) + 1
    if key is not None:
        yield *key, b"".join(held)
        yield *key, None


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """What each range does to a lexer that enters it outside (0) or inside (1) a string: whether the state flips, by how
    much the depth changes, and for every relative depth whether the last bracket opened there began an array of data."""
    flips, deltas, opened = 0, [0, 0], [{}, {}]
    for name, at, text in _stretches(batches):
        if text is None:
            yield {"source_file": name, "at": at, "flips": flips, "deltas": deltas, "opened": [list(x.items()) for x in opened]}
            flips, deltas, opened = 0, [0, 0], [{}, {}]
            continue
        for entered in (0, 1):
            found = Lexed(text, bool(entered ^ flips))
            before = (found.depth[found.opens] - 1 + deltas[entered])[::-1]
            for depth, i in zip(*np.unique(before, return_index=True), strict=True):
                opened[entered][int(depth)] = found.opens_data(int(found.opens[len(before) - 1 - i]))
            deltas[entered] += found.delta
        flips ^= len(found.quotes) & 1


@dataclass
class Cutter:
    """Cuts the text of one range into elements of ``data`` and the rest, given how the range is entered."""

    inside: bool
    depth: int
    within: bool  # inside the array of data
    first: bool = False  # the element at hand begins in this range
    seq: int = 0
    nth: int = 0

    def __post_init__(self):
        self.held: list[bytes] = []

    def _out(self, element: bool, last: bool) -> dict:
        row = {"seq": self.seq, "element": element, "first": element and self.first, "last": last,
               "nth": self.nth, "part": b"".join(self.held).decode(errors="replace")}
        self.seq, self.nth, self.held = self.seq + 1, self.nth + row["first"], []
        return row

    def cut(self, text: bytes) -> Iterator[dict]:
        found = Lexed(text, self.inside)
        depth = found.depth + self.depth
        commas = found.commas[depth[found.commas] == 2]
        down, up = found.opens[depth[found.opens] == 2], found.closes[depth[found.closes] == 1]
        at = 0
        for place in np.sort(np.concatenate([commas, down, up])).tolist():
            byte = text[place]
            if byte == _COMMA:
                if self.within:
                    self.held.append(text[at:place])
                    yield self._out(True, True)
                    at, self.first = place + 1, True
            elif byte in _OPEN:
                if found.opens_data(place):
                    self.held.append(text[at : place + 1])
                    yield self._out(False, True)
                    at, self.within, self.first = place + 1, True, True
            elif self.within:
                self.held.append(text[at:place])
                yield self._out(True, True)
                at, self.within = place, False
        self.held.append(text[at:])
        self.inside ^= bool(len(found.quotes) & 1)
        self.depth += found.delta

    def end(self) -> Iterator[dict]:
        yield self._out(self.within, False)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    def entries():
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("source_file", "at", "inside", "depth", "within"))
            for name, at, *state in zip(*columns, strict=True):
                entered.setdefault((name, at), state)
            yield batch

    entered: dict[tuple, list] = {}
    cutter = None
    for name, at, text in _stretches(entries()):
        if cutter is None:
            cutter = Cutter(*entered[name, at])
        for row in cutter.cut(text) if text is not None else cutter.end():
            yield {"source_file": name, "at": at, **row}
        if text is None:
            cutter = None


def _mapped(rows: DataFrame, function: Callable, schema: str, step: int = 4096) -> DataFrame:
    """``function`` from a task's batches to dicts, some thousand rows or megabytes at a time."""
    arrow = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in T.StructType.fromDDL(schema)])

    def run(batches):
        held, size = [], 0
        for row in function(batches):
            held.append(row)
            size += len(row.get("part", ""))
            if len(held) >= step or size > STEP_BYTES:
                yield pa.RecordBatch.from_pylist(held, schema=arrow)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return rows.mapInArrow(run, schema)


@contextmanager
def _ranges_of(spark: SparkSession, size: int):
    """Ranges that depend on the files and ``size`` only, not on the cores at hand, so that two reads have the same."""
    wanted = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0",
              "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _stored(rows: DataFrame, label: str) -> DataFrame:
    folder = new_folder(rows.sparkSession, label)
    write_table(rows, folder)
    return read_table(rows.sparkSession, folder)


def _sized(ranges: DataFrame) -> DataFrame:
    return F.broadcast(ranges) if ranges.count() <= FEW_RANGES else ranges


def _entries(summary: DataFrame) -> DataFrame:
    """How each range is entered: running sums over a file's ranges, one row each."""
    so_far = Window.partitionBy("source_file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    states = summary.withColumn("inside", F.coalesce(F.sum("flips").over(so_far), F.lit(0)) % 2 == 1)
    states = states.withColumn("state", F.col("inside").cast("int")).withColumn(
        "depth", F.coalesce(F.sum(F.get("deltas", "state")).over(so_far), F.lit(0)).cast("int"))
    states = states.withColumn("opened", F.try_element_at(F.get("opened", "state"), 1 - F.col("depth")))
    within = F.coalesce(F.last("opened", ignorenulls=True).over(so_far), F.lit(False)) & (F.col("depth") >= 2)
    return states.select("source_file", "at", "inside", "depth", within.alias("within"))


def cut_documents(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The stored pieces of all documents: text outside ``data``, and elements of ``data``, whole or in parts."""
    def read() -> DataFrame:
        lines = spark.read.option("lineSep", "]").text(path)
        return lines.select(
            F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("at"),
            F.col("value").cast("binary").alias("piece"))

    with _ranges_of(spark, range_bytes):
        summary = _stored(_mapped(read(), _summaries, _SUMMARY), "range-summaries")
    entries = _stored(_entries(summary).coalesce(1), "range-entries")
    small = entries.count() <= FEW_RANGES
    with _ranges_of(spark, range_bytes):
        lines = read()
        if not small:  # a shuffle takes the order of pieces away
            lines = lines.withColumn("nth_piece", F.monotonically_increasing_id())
        other = (F.broadcast(entries) if small else entries).withColumnsRenamed({"source_file": "f", "at": "a"})
        joined = lines.join(other, (F.col("source_file") == F.col("f")) & (F.col("at") == F.col("a")), "left")
        if not small:
            joined = joined.repartition("source_file", "at").sortWithinPartitions("source_file", "at", "nth_piece")
        changed = F.raise_error(F.concat(F.lit("file changed while it was read: "), F.col("source_file")))
        joined = joined.select(
            "source_file", "at", "piece", F.when(F.col("inside").isNull(), changed.cast("boolean")).otherwise(F.col("inside")).alias("inside"),
            "depth", "within")
        return _stored(_mapped(joined, _pieces, _PIECES), "record-pieces")


def elements(pieces: DataFrame) -> DataFrame:
    """The elements of ``data``: file, place among its elements (from 0) and text. Those that reach over the end of a range are put
    together; the rest is not shuffled."""
    in_file = Window.partitionBy("source_file").orderBy("at")
    offsets = pieces.where("element").groupBy("source_file", "at").agg(F.count_if("first").alias("n")).select(
        F.col("source_file").alias("f"), F.col("at").alias("a"),
        F.coalesce(F.sum("n").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    offsets = _stored(offsets, "record-offsets")
    placed = pieces.where("element").join(
        _sized(offsets), (F.col("source_file") == F.col("f")) & (F.col("at") == F.col("a"))).withColumn(
        "position", F.col("offset") + F.col("nth"))
    whole = placed.where("first AND last").select("source_file", "position", F.col("part").alias("record"))
    running = Window.partitionBy("source_file").orderBy("at", "seq")
    broken = placed.where("NOT (first AND last)").withColumn("piece_of", F.sum(F.col("first").cast("int")).over(running))
    joined = broken.groupBy("source_file", "piece_of").agg(
        F.min("position").alias("position"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "seq", "part"))), lambda x: x["part"]), "").alias("record"))
    return whole.unionByName(joined.select("source_file", "position", "record"))


def _text_of(record: str) -> Column:
    """The record as ``decode`` gives it."""
    return F.get(F.from_json(F.concat(F.lit("["), F.col(record), F.lit("]")), "array<string>"), 0)


def split_documents(
    spark: SparkSession, path: str | list[str], contract=CONTRACT, range_bytes: int = RANGE_BYTES, now: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Documents and records of JSON files of any size, each file read by as many tasks as it has ranges.

    Documents: ``source_file``, ``loaded_at``, the header's ``names``, the ``fault`` (as in ``decoded_documents``) and
    ``records``, their number. Records: ``source_file``, ``position`` and ``record``, the text. A document with one record
    that is no JSON is no JSON, and so is one whose root is an array. Strings are in double quotes; a document that names
    ``data`` twice has a fault. An empty file is no document. Both tables are stored in the shared folder.
    """
    pieces = cut_documents(spark, path, range_bytes)
    found = elements(pieces)
    good = F.coalesce(F.json_array_length(F.concat(F.lit("["), F.col("record"), F.lit("]"))) == 1, F.lit(False))
    records = _stored(found.select(
        "source_file", "position", F.rlike("record", F.lit(r"^[ \t\r\n]*$")).alias("blank"), good.alias("good"),
        _text_of("record").alias("record")), "split-records")
    counts = records.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("blank").alias("blanks"), F.count_if(~F.col("good") & ~F.col("blank")).alias("bad"))
    heads = pieces.where("NOT element").groupBy("source_file").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "seq", "part"))), lambda x: x["part"]), "").alias("raw"),
        F.count_if(F.col("last")).alias("arrays"))
    heads = heads.join(counts.withColumnRenamed("source_file", "f"), F.col("source_file") == F.col("f"), "left")
    empty = (F.col("n") == 1) & (F.col("blanks") == 1)
    json_good = d.is_whole_json("raw") & (F.coalesce(F.col("bad"), F.lit(0)) == 0) & (
        F.coalesce(F.col("blanks"), F.lit(0)) - F.coalesce(empty.cast("int"), F.lit(0)) == 0)
    docs = heads.select(
        "source_file", "arrays", F.when(F.coalesce(empty, F.lit(True)), F.lit(0)).otherwise(F.col("n")).cast("long").alias("records"),
        F.when(json_good, d.decode("raw")).alias("doc"))
    fault = F.when(F.col("arrays") > 1, F.lit("names data twice")).otherwise(fault_of(contract))
    docs = _stored(docs.select(
        "source_file", (F.current_timestamp() if now is None else now).alias("loaded_at"),
        d.field_names(F.col("doc")).alias("names"), fault.alias("fault"), "records"), "split-documents")
    return docs, records.where("NOT blank").select("source_file", "position", "record")


def parse_split(
    docs: DataFrame, records: DataFrame, contract=CONTRACT, on_missing: str = "abort", load_ts: Column | None = None,
    int_cast: Callable[[Column], Column] = to_int,
) -> DataFrame:
    """The rows of ``parse_documents`` from the tables of ``split_documents``. The join by file is Spark's: a broadcast
    of the headers below its size threshold, else by shuffle, which it splits at files with many records."""
    if on_missing not in ("abort", "reject"):
        raise ValueError(f"on_missing must be 'abort' or 'reject', not {on_missing!r}")
    message = F.concat(F.col("source_file"), F.lit(" "), F.col("fault"))
    docs = docs.where("fault is null") if on_missing == "reject" else only_good(docs, F.col("fault").isNull(), message)
    positions = F.struct(*[d.field_position(F.col("names"), f).alias(f"p{i}") for i, (f, _, _) in enumerate(contract)])
    heads = docs.select(F.col("source_file").alias("f"), "loaded_at", positions.alias("at"))
    return contract_rows(records.join(heads, F.col("source_file") == F.col("f")), contract, load_ts, int_cast)
