"""What the text operators share: tables, identities of rows, Arrow batches, word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from platework.session import new_folder

#: Rows and bytes that a Python worker gets at once, so that its memory does not grow with long texts.
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20

#: Added to the words of a window by their place (odd multiples of one number, modulo 2**64).
_PLACES = [np.uint64(0x9E3779B97F4A7C15 * k % 2**64) for k in range(1, 65)]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_batches(df: DataFrame, function: Callable[[dict[str, pa.Array]], dict], schema: str) -> DataFrame:
    """``function`` gets the columns of a batch by name and returns those of ``schema``.

    Batches are bounded in rows and bytes; a result may have more or fewer rows than its batch.
    """
    bound_batches(df.sparkSession)
    kinds, arrow = schemas(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function({n: batch.column(i) for i, n in enumerate(batch.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in arrow],
                    schema=arrow,
                )

    return df.mapInArrow(run, kinds)


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def schemas(ddl: str) -> tuple[T.StructType, pa.Schema]:
    """Spark's and Arrow's schema of a DDL text."""
    kinds = T.StructType.fromDDL(ddl)
    return kinds, pa.schema([(f.name, to_arrow_type(f.dataType)) for f in kinds])


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the folder that all executors share, and read again: a cut of the lineage that
    outlives lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_hash(*columns: str):
    """With the id it tells rows apart that share an id; rows equal in id and columns get equal results."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def same(left: DataFrame, right: DataFrame, *columns: str):
    """Equality of the columns, nulls equal to nulls."""
    found = None
    for c in columns:
        one = left[f"`{c}`"].eqNullSafe(right[f"`{c}`"])
        found = one if found is None else found & one
    return found


class WordHashes(dict):
    """64-bit hash of each word, remembered; cleared when full, so that memory stays bounded."""

    limit = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` consecutive word hashes."""
    n = len(h) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        if n > 0:
            out = mixed(out + h[k : k + n] + _PLACES[k % 64])
    return out


#: Bytes up to which a table is sent to every executor instead of being joined by a shuffle.
BROADCAST_BYTES = 16 << 20


def sent_if_small(df: DataFrame, *sized: str, text: str | None = None) -> DataFrame:
    """A stored table, marked for broadcast if its rows (64 bytes each, 16 for each element of the columns ``sized``,
    and the bytes of the column ``text``) are proven to be few bytes; else as it is, for a shuffled join."""
    size = F.lit(64)
    if text is not None:
        size = size + F.lit(128) + F.coalesce(F.octet_length(text), F.lit(0))
    for c in sized:
        size = size + 16 * F.coalesce(F.size(c), F.lit(0))
    total = df.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df
