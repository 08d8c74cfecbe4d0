"""Registrations, applications and documents derived from the driver's tables.

Every row of ``lineitem`` becomes a bronze registration of the vehicle its order stands for (about four
snapshots per vehicle), with the faults that the rules are about: missing keys, unknown and missing
types, negative and missing ranges, unreadable years and locations. Every order becomes an incentive
application, about three per vehicle that has any. ``documents`` become self-describing JSON documents.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platework.functions.text import to_int
from platework.plans import gold, quality, silver
from platework.schemas import BEV, PHEV
from platework.session import new_folder, split_bytes, stored_bytes
from platework.sources.tables import state_goals, write_table, zip_demographics

YEAR_SHIFT = 28
#: Suppliers, two numbers each (some 50 bytes in a hash table), that are sent to every executor at most.
FEW_SUPPLIERS = 500_000


# Known schemas save the job that reads them from a file's footer.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by their keys before costly work on each, where the table is small and lies in fewer files than there
    are cores; else the files, or their splits, deal it out, and nothing is shuffled."""
    spark, files = df.sparkSession, df.inputFiles()
    cores = spark.sparkContext.defaultParallelism
    few = len(files) < cores and stored_bytes(spark, *map(unquote, files)) < cores * split_bytes(spark)
    return df.repartition(*keys) if few else df


def _sent_if_few(suppliers: DataFrame) -> DataFrame:
    return F.broadcast(suppliers) if suppliers.count() <= FEW_SUPPLIERS else suppliers


def _text(column) -> Column:
    return F.col(column).cast("string") if isinstance(column, str) else column.cast("string")


def _vin(order_key: Column) -> Column:
    return F.concat(F.lit("V"), F.lpad(order_key.cast("string"), 9, "0"))


def bronze(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """One row per lineitem. Suppliers are broadcast if they are few; how parts and nations are joined is Spark's choice.
    Suppliers come first, as two numbers, and texts last, so that what a join may shuffle is narrow.

    ``lines`` may be a stream of lineitems.
    """
    if lines is None:
        lines = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", "l_linenumber")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    nations = table(spark, sf_dir, "nation")
    suppliers = _sent_if_few(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"))
    rows = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    ).join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    size = F.col("p_size")
    ev_type = (
        F.when(size <= 30, F.lit(BEV)).when(size <= 46, F.lit(PHEV))
        .when(size == 47, F.lit("Hydrogen Fuel Cell")).when(size == 48, F.lit("Gasoline Vehicle"))
    )
    quantity = F.col("l_quantity").cast("int")
    ev_range = (
        F.when(F.col("l_discount") > 0.095, F.lit(None).cast("int"))
        .when((F.col("l_tax") > 0.075) & (F.col("l_discount") < 0.005), -quantity)
        .otherwise(quantity * 6)
    )
    eligibility = (
        F.when(F.col("l_returnflag") == "A", F.lit("Clean Alternative Fuel Vehicle Eligible"))
        .when(F.col("l_returnflag") == "N", F.lit("Eligibility unknown as battery range has not been researched"))
        .otherwise(F.lit("Not eligible due to low battery range"))
    )
    year = F.when(size == 20, F.lit("n/a")).otherwise((F.year("l_shipdate") + YEAR_SHIFT).cast("string"))
    point = F.when(size == 21, F.lit("unknown")).otherwise(
        F.concat(
            F.lit("POINT (-"), _text(F.col("s_nationkey") + 100), F.lit(".5 "),
            _text(F.col("n_regionkey") + 30), F.lit(".25)"),
        )
    )
    return rows.select(
        F.when(size != 13, _vin(F.col("l_orderkey"))).alias("VIN"),
        F.lower("n_name").alias("COUNTY"),
        F.concat(F.lit("city "), _text("l_suppkey")).alias("CITY"),
        F.when(F.col("n_regionkey") <= 2, F.lit("WA")).otherwise(F.lit("OR")).alias("STATE"),
        _text(F.col("s_nationkey") + 98101).alias("POSTAL_CODE"),
        to_int(year).alias("MODEL_YEAR"),
        F.lower("p_brand").alias("MAKE"),
        F.lower("p_name").alias("MODEL"),
        ev_type.alias("EV_TYPE"),
        eligibility.alias("CAFV_ELIGIBILITY"),
        ev_range.alias("ELECTRIC_RANGE"),
        F.floor("p_retailprice").cast("int").alias("BASE_MSRP"),
        _text("l_linenumber").alias("LEGISLATIVE_DISTRICT"),
        point.alias("VEHICLE_LOCATION"),
        F.concat(F.lit("utility "), _text("n_regionkey")).alias("ELECTRIC_UTILITY"),
        F.lpad(_text("l_suppkey"), 11, "0").alias("CENSUS_TRACT"),
        F.col("l_shipdate").alias("LOAD_TS"),
        F.concat(F.lit("feed/"), _text("l_partkey"), F.lit(".json")).alias("SOURCE_FILE"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("RECORD_POSITION"),
    )


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key, urgent = F.col("o_orderkey"), F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit("APPROVED"))
        .when(F.col("o_orderstatus") == "O", F.lit("PENDING")).otherwise(F.lit("DENIED"))
    )
    submitted = F.col("o_orderdate").cast("date")
    return orders.select(
        key.alias("application_id"),
        _vin(key - key % 3).alias("vin"),
        submitted.alias("submitted_date"),
        _text(F.col("o_custkey") % 25 + 98101).alias("applicant_zip"),
        F.when(urgent, F.lit("BEV")).otherwise(F.lit("PHEV")).alias("vehicle_type"),
        F.concat(F.lit("BRAND#"), _text(F.col("o_custkey") % 25 + 1)).alias("make"),
        F.concat(F.lit("MODEL "), _text(F.col("o_custkey") % 7)).alias("model"),
        (F.year("o_orderdate") + YEAR_SHIFT).alias("model_year"),
        F.when(urgent, F.lit(7500)).otherwise(F.lit(4000)).cast("decimal(10,2)").alias("incentive_amount"),
        status.alias("status"),
        F.when(status != "PENDING", F.date_add(submitted, (key % 20).cast("int"))).alias("reviewed_date"),
        F.when(
            status == "DENIED",
            F.when(urgent, F.lit("Income exceeds threshold")).otherwise(F.lit("MSRP exceeds cap")),
        ).alias("denial_reason"),
        F.col("o_orderdate").alias("updated_at"),
    )


class Layers:
    """The layers over the derived registrations, each built when asked for.

    With ``stored`` silver is written once and read back, as in a full run; that pays where a query
    reads it several times.
    """

    def __init__(
        self, spark: SparkSession, sf_dir: str, mode: str = "reference", grain: str = "reference", stored: bool = False
    ):
        self.spark, self.sf_dir, self.mode, self.grain = spark, sf_dir, mode, grain
        self.folder = new_folder(spark, "layers") if stored else None
        if stored:
            write_table(silver.build_silver(*self._inputs(), mode, check_lookups=False), f"{self.folder}/silver")

    def _inputs(self) -> list[DataFrame]:
        # The lookups are the fixed tables: 15 and 11 rows with unique keys, so nothing to count.
        return [self.bronze(), zip_demographics(self.spark), state_goals(self.spark), self.applications()]

    def bronze(self) -> DataFrame:
        return bronze(self.spark, self.sf_dir)

    def applications(self) -> DataFrame:
        return applications(self.spark, self.sf_dir)

    def silver(self) -> DataFrame:
        if self.folder:
            return self.spark.read.parquet(f"{self.folder}/silver")
        return silver.build_silver(*self._inputs(), self.mode, check_lookups=False)

    def quarantine(self) -> DataFrame:
        return silver.build_quarantine(self.bronze(), self.mode)

    def dim_vehicle(self) -> DataFrame:
        return gold.dim_vehicle(self.silver(), unique=True)

    def dim_geography(self) -> DataFrame:
        return gold.dim_geography(self.silver(), self.grain)

    def fact(self) -> DataFrame:
        return gold.fact_registrations(self.silver())

    def agg_by_county(self) -> DataFrame:
        return gold.agg_by_county(self.silver())

    def agg_by_year(self) -> DataFrame:
        return gold.agg_by_year(self.silver())

    def tables(self, *names: str) -> dict[str, DataFrame]:
        build = {
            "bronze": self.bronze,
            "silver": self.silver,
            "quarantine": self.quarantine,
            "dim_vehicle": self.dim_vehicle,
            "dim_geography": self.dim_geography,
            "fact_registrations": self.fact,
            "agg_by_county": self.agg_by_county,
            "agg_by_year": self.agg_by_year,
            "incentive_applications": self.applications,
            "zip_demographics": lambda: zip_demographics(self.spark),
            "state_goals": lambda: state_goals(self.spark),
        }
        return {n: build[n]() for n in names}


def metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one measurement; those of user 7 have no value."""
    events = table(spark, sf_dir, "events")
    kind, value = F.col("event_type"), F.col("value").cast("decimal(18,2)")
    metric = (
        F.when(kind == "signup", F.lit(quality.COMPLETENESS)).when(kind == "click", F.lit(quality.DUPLICATES))
        .when(kind == "view", F.lit(quality.FRESHNESS)).when(kind == "purchase", F.lit(quality.RULES))
        .otherwise(F.lit(quality.RECONCILIATION))
    )
    measured = (
        F.when(kind == "signup", F.when(value > 30, F.lit(99.5)).otherwise(F.lit(100.0)))
        .when(kind == "view", value * 300).when(kind == "error", F.floor(value / 30) - 1)
        .otherwise(F.floor(value / 40))
    )
    return events.select(
        F.col("ts").alias("SCHEDULED_TIME"),
        F.col("ts").alias("MEASUREMENT_TIME"),
        F.lit(quality.DATABASE_NAME).alias("TABLE_DATABASE"),
        F.lit(quality.SCHEMA_NAME).alias("TABLE_SCHEMA"),
        F.when(F.col("user_id") < 50, F.lit(quality.SILVER_NAME)).otherwise(F.lit(quality.QUARANTINE_NAME)).alias("TABLE_NAME"),
        metric.alias("METRIC_NAME"),
        F.when(F.col("user_id") != 7, measured).cast("decimal(38,2)").alias("VALUE"),
    )


# Documents. Both are packed row by row: no grouping, so a document is as large as the row it comes from.

LINE_CONTRACT = [("line_no", "LINE_NO", "int"), ("line", "LINE", "string"), ("source", "SOURCE", "string")]
EVENT_CONTRACT = [
    ("event_id", "EVENT_ID", "bigint"), ("event_type", "EVENT_TYPE", "string"),
    ("value", "VALUE", "double"), ("note", "NOTE", "string"),
]


def _header(names: list[str]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("fieldName")) for n in names])


def _document(name: Column, header: Column, data: Column) -> Column:
    view = F.struct(name.alias("name"), header.alias("columns"))
    return F.to_json(F.struct(F.struct(view.alias("view")).alias("meta"), data.alias("data")), {"ignoreNullFields": "false"})


def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per text, one record per line; French texts use another column order."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    lines = F.split("text", "\n")
    # Spark reads the header per document, so the two orders must not be mixed up.
    usual = F.transform(lines, lambda line, i: F.array(F.lit("sys"), i.cast("string"), line, F.col("source")))
    other = F.transform(lines, lambda line, i: F.array(line, F.col("source"), F.lit("extra"), i.cast("string")))
    swapped = F.col("lang") == "fr"
    header = F.when(swapped, _header(["line", "source", ":x", "line_no"])).otherwise(
        _header([":sid", "line_no", "line", "source"])
    )
    return docs.select(
        _document(F.col("lang"), header, F.when(swapped, other).otherwise(usual)).alias("raw_data"),
        F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("loaded_at"),
        F.concat(F.lit("docs/"), _text("doc_id"), F.lit(".json")).alias("source_file"),
    )


def event_documents(spark: SparkSession, sf_dir: str, faulty: bool = False) -> DataFrame:
    """One document per event with its single record, numbers as text; sign-ups are a field short.

    ``faulty`` makes errors unreadable (cut off) and takes ``value`` out of the header of clicks.
    """
    events = spread(table(spark, sf_dir, "events"), "event_id")
    kind = F.col("event_type")
    value = F.when(kind == "purchase", F.lit("n/a")).otherwise(_text("value"))
    record = F.array(_text("event_id"), kind, value, F.concat(F.lit("props "), F.col("props")))
    short = F.slice(record, 1, 3)
    header = _header(["event_id", "event_type", "value", "note"])
    if faulty:
        header = F.when(kind == "click", _header(["event_id", "event_type", "note"])).otherwise(header)
    packed = _document(kind, header, F.array(F.when(kind == "signup", short).otherwise(record)))
    if faulty:
        packed = F.when(kind == "error", F.substring(packed, 1, 40)).otherwise(packed)
    return events.select(
        packed.alias("raw_data"),
        F.col("ts").alias("loaded_at"),
        F.concat(F.lit("events/"), _text("event_id"), F.lit(".json")).alias("source_file"),
    )
