"""Star schema, aggregates and the flat consumer view, all from silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platework.functions.numbers import guarded_ratio
from platework.functions.text import geo_key
from platework.functions.times import wall_clock
from platework.operators.grouped import running_total
from platework.operators.latest import dedup_latest
from platework.operators.lookups import dealt_left_join, left_lookup, spread_left_join

VEHICLE_COLUMNS = ["VIN", "MAKE", "MODEL", "MODEL_YEAR", "EV_TYPE", "ELECTRIC_RANGE", "BASE_MSRP"]
GEOGRAPHY_COLUMNS = [
    "COUNTY", "CITY", "STATE", "POSTAL_CODE", "LEGISLATIVE_DISTRICT", "LATITUDE", "LONGITUDE",
    "POPULATION", "MEDIAN_INCOME", "EV_CHARGING_STATIONS",
]
FACT_COLUMNS = [
    "VIN", "GEO_KEY", "MODEL_YEAR", "CAFV_ELIGIBILITY", "ELECTRIC_UTILITY", "CENSUS_TRACT",
    "TARGET_EV_COUNT", "POLICY_NAME", "INCENTIVE_AMOUNT", "APPLICATION_STATUS", "LOAD_TS",
]


def dim_vehicle(silver: DataFrame, unique: bool = False, *more: str) -> DataFrame:
    """Distinct vehicles. ``unique=True`` (silver holds one row per VIN) saves the shuffle of DISTINCT."""
    vehicles = silver.select(*VEHICLE_COLUMNS, *more)
    return vehicles if unique else vehicles.distinct()


def dim_geography(silver: DataFrame, grain: str = "reference") -> DataFrame:
    """Distinct locations under a hash key.

    The key covers county, city and postal code only, so in the "reference" grain a key has a row per
    district and coordinates; "key" keeps one row per key, the first in column order.
    """
    places = silver.select(geo_key().alias("GEO_KEY"), *GEOGRAPHY_COLUMNS).distinct()
    if grain == "reference":
        return places
    if grain != "key":
        raise ValueError(f"grain must be 'reference' or 'key', not {grain!r}")
    return dedup_latest(places, ["GEO_KEY"], [F.col(c).asc_nulls_last() for c in GEOGRAPHY_COLUMNS])


def fact_registrations(silver: DataFrame, *more: str) -> DataFrame:
    return silver.withColumns({"GEO_KEY": geo_key(), "LOAD_TS": wall_clock("LOAD_TS")}).select(*FACT_COLUMNS, *more)


def agg_by_county(silver: DataFrame) -> DataFrame:
    """Counts, mean range and registrations per head. Population is the largest of the zip codes'."""
    grouped = silver.groupBy("COUNTY", "EV_TYPE").agg(
        F.count(F.lit(1)).alias("REGISTRATION_COUNT"),
        F.avg("ELECTRIC_RANGE").alias("AVG_ELECTRIC_RANGE"),
        F.max("POPULATION").alias("POPULATION"),
    )
    return grouped.withColumn("REGISTRATIONS_PER_CAPITA", guarded_ratio("REGISTRATION_COUNT", "POPULATION"))


def agg_by_year(silver: DataFrame) -> DataFrame:
    """Counts, running count per type and the running count as a fraction of that year's goal."""
    grouped = silver.groupBy("MODEL_YEAR", "EV_TYPE").agg(
        F.count(F.lit(1)).alias("REGISTRATION_COUNT"), F.max("TARGET_EV_COUNT").alias("TARGET_EV_COUNT")
    )
    return _with_goal(grouped)


def _with_goal(grouped: DataFrame) -> DataFrame:
    totals = running_total(grouped, "REGISTRATION_COUNT", ["EV_TYPE"], "MODEL_YEAR", "CUMULATIVE_COUNT")
    return totals.withColumn("PCT_OF_GOAL", guarded_ratio("CUMULATIVE_COUNT", "TARGET_EV_COUNT")).select(
        "MODEL_YEAR", "EV_TYPE", "REGISTRATION_COUNT", "CUMULATIVE_COUNT", "TARGET_EV_COUNT", "PCT_OF_GOAL"
    )


#: What the aggregates and the geography are made of. Population and goal are among the columns that tell cells apart, so
#: that a maximum is taken over what is left when rows go: nothing has to be counted anew.
CELL_COLUMNS = [*GEOGRAPHY_COLUMNS, "EV_TYPE", "MODEL_YEAR", "TARGET_EV_COUNT"]
_SUMS = ("n", "range_sum", "range_n")


def signed_cells(came: DataFrame, went: DataFrame | None = None) -> DataFrame:
    """Registrations that came less those that went, summed by cell; what is in both is no row. One read of each, and
    one shuffle of a row per task and cell."""
    columns = [*CELL_COLUMNS, "ELECTRIC_RANGE"]
    rows = came.select(*columns, F.lit(1).alias("sign"))
    if went is not None:
        rows = rows.unionByName(went.select(*columns, F.lit(-1).alias("sign")))
    sums = rows.groupBy(*CELL_COLUMNS).agg(
        F.sum("sign").alias("n"), F.coalesce(F.sum(F.col("sign") * F.col("ELECTRIC_RANGE")), F.lit(0)).alias("range_sum"),
        F.coalesce(F.sum(F.when(F.col("ELECTRIC_RANGE").isNotNull(), F.col("sign"))), F.lit(0)).alias("range_n"))
    return sums.where("n <> 0 OR range_sum <> 0 OR range_n <> 0")


def merged_cells(deltas: DataFrame) -> DataFrame:
    """All signed cells added up: a row for each cell that holds registrations."""
    return deltas.groupBy(*CELL_COLUMNS).agg(*[F.sum(c).alias(c) for c in _SUMS]).where("n <> 0")


def agg_by_county_of(cells: DataFrame) -> DataFrame:
    """``agg_by_county`` from merged cells."""
    grouped = cells.groupBy("COUNTY", "EV_TYPE").agg(
        F.sum("n").alias("REGISTRATION_COUNT"),
        guarded_ratio(F.sum("range_sum"), F.sum("range_n")).alias("AVG_ELECTRIC_RANGE"),
        F.max("POPULATION").alias("POPULATION"),
    )
    return grouped.withColumn("REGISTRATIONS_PER_CAPITA", guarded_ratio("REGISTRATION_COUNT", "POPULATION"))


def agg_by_year_of(cells: DataFrame) -> DataFrame:
    """``agg_by_year`` from merged cells."""
    return _with_goal(cells.groupBy("MODEL_YEAR", "EV_TYPE").agg(
        F.sum("n").alias("REGISTRATION_COUNT"), F.max("TARGET_EV_COUNT").alias("TARGET_EV_COUNT")))


def shared_registrations(
    fact: DataFrame, vehicles: DataFrame, geography: DataFrame, spread: bool = False,
    hot: list[tuple[str, int]] | None = None,
) -> DataFrame:
    """The star as one flat table.

    VIN is unique on both sides, but a place may hold any share of the fact. By default the join is left
    to Spark, which broadcasts a geography of few bytes and else splits skewed places as it runs;
    ``spread`` counts the places first and deals those with many rows over many tasks; ``hot`` places that were observed
    while the fact was written (``hot_keys``) are dealt out without counting.
    """
    facts = fact.withColumnRenamed("MODEL_YEAR", "FACT_YEAR")
    vehicles = vehicles.drop("MODEL_YEAR").withColumnRenamed("VIN", "V_VIN")
    places = geography.withColumnRenamed("GEO_KEY", "G_KEY")
    # Geography first: finding the hot places then reads one column of the fact and nothing else.
    if hot is not None:
        flat = dealt_left_join(facts, places, "GEO_KEY", "G_KEY", hot)
    else:
        flat = (spread_left_join if spread else left_lookup)(facts, places, {"GEO_KEY": "G_KEY"})
    flat = left_lookup(flat, vehicles, {"VIN": "V_VIN"}).withColumnRenamed("FACT_YEAR", "MODEL_YEAR")
    own = [c for c in FACT_COLUMNS if c != "GEO_KEY"]
    return flat.select(*own, *[c for c in VEHICLE_COLUMNS if c not in own], *GEOGRAPHY_COLUMNS)


def restrict(
    df: DataFrame,
    consumer: str,
    policy: DataFrame,
    column: str = "COUNTY",
    mask: tuple[str, ...] = (),
) -> DataFrame:
    """Rows a consumer may see: the policy's values for it, or all rows if the policy does not name it.

    ``policy`` has columns (consumer, value). Masked columns are shown as NULL to named consumers.
    """
    allowed = policy.where(F.col("consumer") == consumer).select(F.col("value").alias("__value")).distinct()
    named = policy.agg(F.count_if(F.col("consumer") == consumer) > 0).scalar()
    seen = df.join(allowed, df[column] == F.col("__value"), "left").where(~named | F.col("__value").isNotNull())
    masked = {c: F.when(~named, F.col(c)) for c in mask}
    return seen.drop("__value").withColumns(masked) if masked else seen.drop("__value")
