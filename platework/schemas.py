"""Column contracts, table schemas and the fixed values of the registration model."""

from __future__ import annotations

from pyspark.sql import types as T

# Source field -> bronze column, and the type it is read as.
CONTRACT = [
    ("vin_1_10", "VIN", "string"),
    ("county", "COUNTY", "string"),
    ("city", "CITY", "string"),
    ("state", "STATE", "string"),
    ("zip_code", "POSTAL_CODE", "string"),
    ("model_year", "MODEL_YEAR", "int"),
    ("make", "MAKE", "string"),
    ("model", "MODEL", "string"),
    ("ev_type", "EV_TYPE", "string"),
    ("cafv_type", "CAFV_ELIGIBILITY", "string"),
    ("electric_range", "ELECTRIC_RANGE", "int"),
    ("base_msrp", "BASE_MSRP", "int"),
    ("legislative_district", "LEGISLATIVE_DISTRICT", "string"),
    ("geocoded_column", "VEHICLE_LOCATION", "string"),
    ("electric_utility", "ELECTRIC_UTILITY", "string"),
    ("_2020_census_tract", "CENSUS_TRACT", "string"),
]

# The two accepted vehicle types.
BEV = "Battery Electric Vehicle (BEV)"
PHEV = "Plug-in Hybrid Electric Vehicle (PHEV)"
VALID_EV_TYPES = [BEV, PHEV]

# Lineage columns carried through bronze so that "latest" is never arbitrary.
LINEAGE = ["LOADED_AT", "SOURCE_FILE", "RECORD_POSITION"]

ZIP_DEMOGRAPHICS = T.StructType([
    T.StructField("zip_code", T.StringType()),
    T.StructField("population", T.IntegerType()),
    T.StructField("median_income", T.IntegerType()),
    T.StructField("ev_charging_stations", T.IntegerType()),
])

# Demographics by zip code.
ZIP_DEMOGRAPHICS_ROWS = [
    ("98101", 35000, 95000, 42),
    ("98103", 45000, 88000, 38),
    ("98105", 28000, 92000, 25),
    ("98115", 40000, 85000, 31),
    ("98122", 32000, 78000, 28),
    ("98004", 38000, 145000, 55),
    ("98005", 33000, 120000, 48),
    ("98052", 62000, 135000, 62),
    ("98033", 48000, 125000, 44),
    ("98109", 25000, 98000, 35),
    ("98271", 22000, 72000, 12),
    ("98501", 42000, 68000, 18),
    ("98225", 55000, 62000, 15),
    ("98902", 35000, 58000, 8),
    ("99201", 48000, 52000, 22),
]

STATE_GOALS = T.StructType([
    T.StructField("state", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("target_ev_count", T.IntegerType()),
    T.StructField("policy_name", T.StringType()),
])

# State targets by year.
STATE_GOALS_ROWS = [
    ("WA", 2025, 500000, "Clean Cars 2030"),
    ("WA", 2026, 600000, "Clean Cars 2030"),
    ("WA", 2027, 720000, "Clean Cars 2030"),
    ("WA", 2028, 860000, "Clean Cars 2030"),
    ("WA", 2029, 1020000, "Clean Cars 2030"),
    ("WA", 2030, 1200000, "Clean Cars 2030"),
    ("WA", 2031, 1350000, "Clean Cars 2030 Extension"),
    ("WA", 2032, 1500000, "Clean Cars 2030 Extension"),
    ("WA", 2033, 1650000, "Clean Cars 2030 Extension"),
    ("WA", 2034, 1800000, "Clean Cars 2030 Extension"),
    ("WA", 2035, 2000000, "Clean Cars 2030 Extension"),
]

INCENTIVE_APPLICATIONS = T.StructType([
    T.StructField("application_id", T.LongType()),
    T.StructField("vin", T.StringType()),
    T.StructField("submitted_date", T.DateType()),
    T.StructField("applicant_zip", T.StringType()),
    T.StructField("vehicle_type", T.StringType()),
    T.StructField("make", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("model_year", T.IntegerType()),
    T.StructField("incentive_amount", T.DecimalType(10, 2)),
    T.StructField("status", T.StringType()),
    T.StructField("reviewed_date", T.DateType()),
    T.StructField("denial_reason", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

SILVER_COLUMNS = [
    "VIN", "COUNTY", "CITY", "STATE", "POSTAL_CODE", "MODEL_YEAR", "MAKE", "MODEL", "EV_TYPE",
    "CAFV_ELIGIBILITY", "ELECTRIC_RANGE", "BASE_MSRP", "LEGISLATIVE_DISTRICT", "ELECTRIC_UTILITY",
    "CENSUS_TRACT", "LONGITUDE", "LATITUDE", "POPULATION", "MEDIAN_INCOME", "EV_CHARGING_STATIONS",
    "TARGET_EV_COUNT", "POLICY_NAME", "INCENTIVE_AMOUNT", "APPLICATION_STATUS", "LOAD_TS",
]

QUARANTINE_COLUMNS = [
    "VIN", "COUNTY", "CITY", "STATE", "POSTAL_CODE", "MODEL_YEAR", "MAKE", "MODEL", "EV_TYPE",
    "ELECTRIC_RANGE", "LOAD_TS", "REJECTION_REASON",
]

METRIC_HISTORY = T.StructType([
    T.StructField("SCHEDULED_TIME", T.TimestampType()),
    T.StructField("MEASUREMENT_TIME", T.TimestampType()),
    T.StructField("TABLE_DATABASE", T.StringType()),
    T.StructField("TABLE_SCHEMA", T.StringType()),
    T.StructField("TABLE_NAME", T.StringType()),
    T.StructField("METRIC_NAME", T.StringType()),
    T.StructField("VALUE", T.DecimalType(38, 2)),
])

RUN_LOG = T.StructType([
    T.StructField("TASK_NAME", T.StringType()),
    T.StructField("RUN_STATUS", T.StringType()),
    T.StructField("ROW_COUNT", T.LongType()),
    T.StructField("ERROR_MESSAGE", T.StringType()),
    T.StructField("RUN_TIMESTAMP", T.TimestampType()),
])
