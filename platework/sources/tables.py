"""Reference loads and table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from platework import schemas
from platework.session import writing

#: Layers repeat few texts and long keys: about a quarter less on disk than with Spark's default. A task reads whole row
#: groups, whose rows take many times their bytes when they are sorted: some hundred thousand rows each.
OPTIONS = {"parquet": {"compression": "zstd", "parquet.block.size": str(16 << 20)}}


def load_reference(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A typed CSV with a header line; a cell that does not fit its type fails the load."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def _literal(value: str | int | None) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A few fixed rows as part of the plan, so that Spark knows how small they are and broadcasts them."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    columns = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema)
    names = ", ".join(schema.names)
    return spark.sql(f"SELECT {columns} FROM VALUES {values} AS fixed({names})")


def zip_demographics(spark: SparkSession) -> DataFrame:
    return literal_table(spark, schemas.ZIP_DEMOGRAPHICS_ROWS, schemas.ZIP_DEMOGRAPHICS)


def state_goals(spark: SparkSession) -> DataFrame:
    return literal_table(spark, schemas.STATE_GOALS_ROWS, schemas.STATE_GOALS)


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet", partition_by: list[str] | None = None
) -> None:
    """Full reload of a table. The path must not be one that ``df`` reads."""
    writer = df.write.format(fmt).mode(mode).options(**OPTIONS.get(fmt, {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with writing(df.sparkSession):
        writer.save(path)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(df, path, mode="append", fmt=fmt)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Name every table for use in SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def small_result(df: DataFrame, max_rows: int = 10_000):
    """The rows as a pandas frame for display; more than ``max_rows`` raise rather than reach the driver."""
    rows = df.limit(max_rows + 1).toPandas()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows: aggregate or limit before bringing them to the driver")
    return rows
