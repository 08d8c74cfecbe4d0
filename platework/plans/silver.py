"""Silver and quarantine: latest row per vehicle, rules, standard text, enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platework._columns import latest_first
from platework.functions.text import bounded, latitude, longitude
from platework.operators.latest import dedup_latest
from platework.operators.lookups import left_lookup, unique_lookup
from platework.operators.rules import Rule, judge, rejected_rows, valid_rows
from platework.schemas import LINEAGE, QUARANTINE_COLUMNS, SILVER_COLUMNS, VALID_EV_TYPES

MODES = ("reference", "strict")


def registration_rules() -> list[Rule]:
    ev_type, ev_range = F.col("EV_TYPE"), F.col("ELECTRIC_RANGE")
    return [
        Rule("vin_present", F.col("VIN").isNull(), F.lit("VIN is NULL")),
        Rule(
            "ev_type_known",
            ~ev_type.isin(*VALID_EV_TYPES),
            F.concat(F.lit("Invalid ev_type: "), F.coalesce(ev_type, F.lit("NULL"))),
        ),
        Rule(
            "range_not_negative",
            F.coalesce(ev_range < 0, F.lit(False)),
            F.concat(F.lit("Negative electric_range: "), ev_range.cast("string")),
        ),
    ]


def bronze_order(bronze: DataFrame) -> list[Column]:
    """Newest load first; the lineage columns that bronze has settle ties."""
    return latest_first("LOAD_TS", *[c for c in LINEAGE if c in bronze.columns])


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def latest_registrations(bronze: DataFrame, mode: str = "reference", key: str = "VIN") -> DataFrame:
    """One row per vehicle. Reference mode keeps one row of all those without a VIN, strict keeps each."""
    _check_mode(mode)
    return dedup_latest(bronze, [key], bronze_order(bronze), "one" if mode == "reference" else "all")


def judged_registrations(bronze: DataFrame, mode: str = "reference") -> DataFrame:
    """Latest rows with their verdict. Strict mode judges the rows without a VIN apart, in
    ``unkeyed_rejects``: they can only be rejected, and without them the rows lie by VIN."""
    _check_mode(mode)
    strict = mode == "strict"
    rows = bronze.where(F.col("VIN").isNotNull()) if strict else bronze
    return judge(latest_registrations(rows), registration_rules(), strict)


def unkeyed_rejects(bronze: DataFrame) -> DataFrame:
    """Every row without a VIN, as strict quarantine rows."""
    return quarantine_from(judge(bronze.where(F.col("VIN").isNull()), registration_rules(), strict=True))


def standardize(valid: DataFrame) -> DataFrame:
    """Upper-case text, bounded codes and the location as two numbers."""
    upper = {c: F.upper(c) for c in ("COUNTY", "CITY", "MAKE", "MODEL")}
    return valid.withColumns({
        **upper,
        "POSTAL_CODE": bounded("POSTAL_CODE", 10),
        "LEGISLATIVE_DISTRICT": bounded("LEGISLATIVE_DISTRICT", 5),
        "LONGITUDE": longitude("VEHICLE_LOCATION"),
        "LATITUDE": latitude("VEHICLE_LOCATION"),
    })


def latest_applications(applications: DataFrame) -> DataFrame:
    """Newest application per VIN, as the columns silver takes from it."""
    order = latest_first("updated_at", "application_id")
    return dedup_latest(applications, ["vin"], order).select(
        F.col("vin").alias("INC_VIN"),
        F.col("incentive_amount").alias("INCENTIVE_AMOUNT"),
        F.col("status").alias("APPLICATION_STATUS"),
    )


def enrich(
    rows: DataFrame, zips: DataFrame, goals: DataFrame, applications: DataFrame, check_lookups: bool = True
) -> DataFrame:
    """Add demographics by zip code, the goal by state and model year, and the latest application.

    The lookups' keys are counted once: a repeated one raises. Spark's estimate of their bytes decides
    whether they are broadcast. The application join comes first and is by VIN, on which the rows
    already lie after the dedup.
    """
    return with_lookups(with_applications(rows, applications), zips, goals, check_lookups)


def with_applications(rows: DataFrame, applications: DataFrame) -> DataFrame:
    return left_lookup(rows, latest_applications(applications), {"VIN": "INC_VIN"})


def with_lookups(rows: DataFrame, zips: DataFrame, goals: DataFrame, check_lookups: bool = True) -> DataFrame:
    zips = zips.select(
        "zip_code",
        F.col("population").alias("POPULATION"),
        F.col("median_income").alias("MEDIAN_INCOME"),
        F.col("ev_charging_stations").alias("EV_CHARGING_STATIONS"),
    )
    goals = goals.select(
        F.col("state").alias("goal_state"),
        F.col("year").alias("goal_year"),
        F.col("target_ev_count").alias("TARGET_EV_COUNT"),
        F.col("policy_name").alias("POLICY_NAME"),
    )
    join = unique_lookup if check_lookups else left_lookup
    rows = join(rows, zips, {"POSTAL_CODE": "zip_code"})
    return join(rows, goals, {"STATE": "goal_state", "MODEL_YEAR": "goal_year"})


def silver_from(
    judged: DataFrame, zips: DataFrame, goals: DataFrame, applications: DataFrame, check_lookups: bool = True
) -> DataFrame:
    rows = enrich(standardize(valid_rows(judged)), zips, goals, applications, check_lookups)
    return rows.select(*SILVER_COLUMNS)


def quarantine_from(judged: DataFrame) -> DataFrame:
    return rejected_rows(judged).select(*QUARANTINE_COLUMNS)


def latest_state(rows: DataFrame, applications: DataFrame, mode: str = "reference") -> DataFrame:
    """The latest row per vehicle with its verdict and its latest application: all of silver and quarantine follows from
    it row by row. One shuffle of the rows by VIN, which the application join reuses. Rows without a VIN are as in
    ``judged_registrations``."""
    return with_applications(judged_registrations(rows, mode), applications)


def silver_of(state: DataFrame, zips: DataFrame, goals: DataFrame, check_lookups: bool = True, *more: str) -> DataFrame:
    """Silver rows of a ``latest_state``, with the columns ``more``."""
    return with_lookups(standardize(valid_rows(state)), zips, goals, check_lookups).select(*SILVER_COLUMNS, *more)


def quarantine_of(state: DataFrame, *more: str) -> DataFrame:
    return rejected_rows(state).select(*QUARANTINE_COLUMNS, *more)


def build_silver(
    bronze: DataFrame,
    zips: DataFrame,
    goals: DataFrame,
    applications: DataFrame,
    mode: str = "reference",
    check_lookups: bool = True,
) -> DataFrame:
    return silver_from(judged_registrations(bronze, mode), zips, goals, applications, check_lookups)


def build_quarantine(bronze: DataFrame, mode: str = "reference") -> DataFrame:
    rejected = quarantine_from(judged_registrations(bronze, mode))
    return rejected.unionByName(unkeyed_rejects(bronze)) if mode == "strict" else rejected
