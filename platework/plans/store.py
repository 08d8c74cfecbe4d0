"""Tables that runs write, and the manifest that says which of their folders count.

A run first puts its number and the tables it means to write on record (``begin``), then writes each table to a folder of
its own, ``<root>/<table>/run=<run>``, and last publishes all of them with one row each, in one file. Readers go by the
published rows alone: a run that ends anywhere before that leaves every table as it was, and its number is not used again.

A table is written whole, added to, or lies in buckets by a hash of its key, of which a run writes those that change: its
current rows are then each bucket's last published folder. Published folders are never changed, so any earlier state can
be read as well. How many rows went into each folder and bucket is observed while it is written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platework.session import stored_bytes, writing
from platework.sources.tables import OPTIONS

BUCKET, RUN = "bucket", "run"
#: A task that writes buckets sorts its rows, which take many times the bytes of the files that they come from: it reads so
#: many bytes at most, so that it need not spill, unless that made more than so many tasks.
SORTED_SPLIT, MOST_SPLITS = 8 << 20, 100_000
#: Bucket of rows that are only added to, beside the buckets by key.
UNKEYED = -1
_INTENTS = "run string, batch long, step string, names array<string>, begun_at timestamp"
_VERSIONS = (
    "name string, run string, batch long, place int, adds boolean, buckets array<int>, counts map<int,bigint>, rows long, "
    "facts string, layout string, written_at timestamp")


@dataclass(frozen=True)
class Batch:
    """A run of one step: its name in folders, and its number, which is larger than that of any begun before."""

    run: str
    number: int


@dataclass(frozen=True)
class Entry:
    """One table as a run has written it. ``buckets``: those that were written anew, None for a table without buckets.
    ``adds``: earlier folders count on. ``counts``: rows by bucket; ``facts``: what else is to be remembered."""

    name: str
    run: str
    batch: int
    schema: T.StructType
    rows: int
    adds: bool = False
    whole: bool = False
    buckets: tuple[int, ...] | None = None
    counts: dict[int, int] = field(default_factory=dict)
    facts: dict = field(default_factory=dict)
    written_at: datetime | None = None


@dataclass
class Table:
    """The folders that a table consists of now."""

    entries: list[Entry] = field(default_factory=list)
    plain: list[Entry] = field(default_factory=list)
    by_bucket: dict[int, Entry] = field(default_factory=dict)
    added: list[Entry] = field(default_factory=list)

    def apply(self, entry: Entry) -> None:
        self.entries.append(entry)
        if entry.whole:
            self.plain, self.by_bucket, self.added = [], {}, []
        if entry.buckets is None:
            self.plain.append(entry)
        elif entry.adds:
            self.added.append(entry)
        else:
            self.by_bucket.update(dict.fromkeys(entry.buckets, entry))

    @property
    def batch(self) -> int:
        """The last run that wrote the table."""
        return self.entries[-1].batch

    @property
    def last(self) -> Entry:
        return self.entries[-1]

    @property
    def rows(self) -> int:
        """Rows of the table, as observed when they were written."""
        return sum(e.rows for e in [*self.plain, *self.added]) + sum(
            e.counts.get(b, 0) for b, e in self.by_bucket.items())

    def fact(self, name: str):
        """A number that was observed with every entry, over the current folders of a table that is added to."""
        return sum(e.facts.get(name) or 0 for e in [*self.plain, *self.added])


def bucket_of(key: str, buckets: int) -> Column:
    """Spark's own hash of the key: rows that a shuffle by the key has dealt out lie by bucket as well, where the number
    of partitions and that of buckets divide one another."""
    return F.pmod(F.hash(key), F.lit(buckets)).cast("int")


def per_bucket(bucket: Column, buckets: int) -> Column:
    """Rows per bucket, as an aggregate that can be observed: a histogram with a bin for every bucket there may be, so that
    only bins of one and the same bucket are ever merged."""
    return F.histogram_numeric(bucket.cast("double"), F.lit(max(2, buckets)))


def _path(root: str, name: str) -> str:
    return f"{root}/{name}"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.schema(schema).parquet(path)


def begin(spark: SparkSession, root: str, step: str, names: Iterable[str], now: datetime) -> Batch:
    """Put a run of a step on record before it writes anything."""
    last = [0]
    for table, schema in (("intents", _INTENTS), ("versions", _VERSIONS)):
        if (known := _read(spark, _path(root, table), schema)) is not None:
            last.append(known.agg(F.max("batch")).first()[0] or 0)
    batch = Batch(uuid.uuid4().hex, max(last) + 1)
    row = [(batch.run, batch.number, step, list(names), now)]
    spark.createDataFrame(row, _INTENTS).coalesce(1).write.mode("append").parquet(_path(root, "intents"))
    return batch


def write(
    df: DataFrame, root: str, name: str, batch: Batch, fmt: str = "parquet", adds: bool = False, whole: bool = True,
    buckets: Iterable[int] | None = None, measures: dict[str, Column] | None = None, facts: dict | None = None,
) -> Entry:
    """Write one table's folder of a run; nothing of it counts before it is published.

    With ``buckets`` the rows have a column ``bucket``; the rows of each are counted on the way, as are ``measures``
    (aggregates), which become facts of the entry. A run that writes to one table twice writes to different buckets.
    """
    observed = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    measures = dict(measures or {})
    counted = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in measures.items()]]
    if buckets is not None:
        buckets = tuple(buckets)
        counted.append(per_bucket(F.col(BUCKET), len(buckets)).alias("by_bucket"))
    writer = df.observe(observed, *counted).write.format(fmt).mode("append").options(**OPTIONS.get(fmt, {}))
    spark, splits = df.sparkSession, None
    if buckets is not None:
        writer = writer.partitionBy(BUCKET)
        splits = max(SORTED_SPLIT, stored_bytes(spark, root) // MOST_SPLITS)
    with writing(spark, splits):
        writer.save(f"{_path(root, name)}/{RUN}={batch.run}")
    found = observed.get
    counts: dict[int, int] = {}
    for x in found.get("by_bucket") or ():
        # bins of a bucket may stand side by side, and merged ones lie where the division of their mean left them
        bucket = round(x["x"])
        counts[bucket] = counts.get(bucket, 0) + round(x["y"])
    found = {n: [_plain(x) for x in v] if isinstance(v, list) else v for n, v in found.items()}
    return Entry(
        name, batch.run, batch.number, df.schema, found["rows"], adds, whole and not adds, buckets, counts,
        {**(facts or {}), **{n: found[n] for n in measures}})


def _plain(row):
    """A bin of a histogram as its bucket, a frequent key with its count as a pair."""
    return round(row["x"]) if "x" in row else (row["item"], row["count"])


def publish(spark: SparkSession, root: str, entries: list[Entry], now: datetime) -> None:
    """Make folders that were written whole count, all at once."""
    rows = [
        (e.name, e.run, e.batch, k, e.adds, None if e.buckets is None else list(e.buckets), e.counts, e.rows,
         json.dumps({"whole": e.whole, **e.facts}, default=str), e.schema.json(), now)
        for k, e in enumerate(entries)]
    spark.createDataFrame(rows, _VERSIONS).coalesce(1).write.mode("append").parquet(_path(root, "versions"))


def published(spark: SparkSession, root: str, through: int | None = None) -> dict[str, Table]:
    """The tables as of now, or as of a batch. The manifest has a row per run and table."""
    found: dict[str, Table] = {}
    known = _read(spark, _path(root, "versions"), _VERSIONS)
    if known is None:
        return found
    if through is not None:
        known = known.where(F.col("batch") <= through)
    for r in known.orderBy("batch", "place").collect():
        facts = json.loads(r["facts"])
        whole = facts.pop("whole")
        entry = Entry(
            r["name"], r["run"], r["batch"], T.StructType.fromJson(json.loads(r["layout"])), r["rows"], r["adds"], whole,
            None if r["buckets"] is None else tuple(r["buckets"]), r["counts"], facts, r["written_at"])
        found.setdefault(entry.name, Table()).apply(entry)
    return found


def load(
    spark: SparkSession, root: str, name: str, table: Table, fmt: str = "parquet", buckets: Iterable[int] | None = None,
    since: int | None = None, keep_bucket: bool = False,
) -> DataFrame:
    """The rows of a table, of some buckets of it, or those added after batch ``since``. One scan, whose folders are
    pruned before they are read."""
    wanted = None if buckets is None else set(buckets)
    tests, runs = [], set()
    by_run: dict[str, list[int]] = {}
    for b, e in table.by_bucket.items():
        if (wanted is None or b in wanted) and e.counts.get(b):
            by_run.setdefault(e.run, []).append(b)
    for e in table.added:
        if wanted is None and e.rows and (since is None or e.batch > since):
            by_run.setdefault(e.run, []).extend(e.buckets)
    for run, some in by_run.items():
        runs.add(run)
        tests.append((F.col(RUN) == run) & F.col(BUCKET).isin(some))
    runs |= {e.run for e in table.plain if e.rows and (since is None or e.batch > since)}
    schema = table.last.schema
    if not runs:
        empty = spark.createDataFrame([], schema)
        return empty if keep_bucket or BUCKET not in schema.names else empty.drop(BUCKET)
    base = _path(root, name)
    df = spark.read.format(fmt).schema(T.StructType([*schema, T.StructField(RUN, T.StringType())])).option(
        "basePath", base).load([f"{base}/{RUN}={r}" for r in sorted(runs)])
    if tests:
        df = df.where(reduce(lambda a, b: a | b, tests))
    return df.select(*[c for c in schema.names if keep_bucket or c != BUCKET])
