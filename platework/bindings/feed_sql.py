"""The derived registrations and their layers as SQL, to compare the Spark layers with."""

from __future__ import annotations

from platework.schemas import BEV, PHEV, STATE_GOALS_ROWS, ZIP_DEMOGRAPHICS_ROWS


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


_TYPES = f"('{BEV}', '{PHEV}')"
_RANK = "row_number() OVER (PARTITION BY VIN ORDER BY LOAD_TS DESC NULLS LAST, SOURCE_FILE DESC NULLS LAST, RECORD_POSITION DESC NULLS LAST)"

BRONZE = f"""
zips(zip_code, population, median_income, ev_charging_stations) AS (VALUES {_values(ZIP_DEMOGRAPHICS_ROWS)}),
goals(state, year, target_ev_count, policy_name) AS (VALUES {_values(STATE_GOALS_ROWS)}),
bronze AS (
  SELECT CASE WHEN p_size <> 13 THEN 'V' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0') END AS VIN,
    lower(n_name) AS COUNTY, 'city ' || l_suppkey AS CITY, CASE WHEN n_regionkey <= 2 THEN 'WA' ELSE 'OR' END AS STATE,
    CAST(s_nationkey + 98101 AS VARCHAR) AS POSTAL_CODE,
    CASE WHEN p_size <> 20 THEN CAST(year(l_shipdate) + 28 AS INTEGER) END AS MODEL_YEAR,
    lower(p_brand) AS MAKE, lower(p_name) AS MODEL,
    CASE WHEN p_size <= 30 THEN '{BEV}' WHEN p_size <= 46 THEN '{PHEV}' WHEN p_size = 47 THEN 'Hydrogen Fuel Cell'
      WHEN p_size = 48 THEN 'Gasoline Vehicle' END AS EV_TYPE,
    CASE l_returnflag WHEN 'A' THEN 'Clean Alternative Fuel Vehicle Eligible'
      WHEN 'N' THEN 'Eligibility unknown as battery range has not been researched'
      ELSE 'Not eligible due to low battery range' END AS CAFV_ELIGIBILITY,
    CASE WHEN l_discount > 0.095 THEN NULL WHEN l_tax > 0.075 AND l_discount < 0.005 THEN -CAST(l_quantity AS INTEGER)
      ELSE CAST(l_quantity AS INTEGER) * 6 END AS ELECTRIC_RANGE,
    CAST(floor(p_retailprice) AS INTEGER) AS BASE_MSRP, CAST(l_linenumber AS VARCHAR) AS LEGISLATIVE_DISTRICT,
    CASE WHEN p_size = 21 THEN 'unknown' ELSE 'POINT (-' || (s_nationkey + 100) || '.5 ' || (n_regionkey + 30) || '.25)' END AS VEHICLE_LOCATION,
    'utility ' || n_regionkey AS ELECTRIC_UTILITY, lpad(CAST(l_suppkey AS VARCHAR), 11, '0') AS CENSUS_TRACT,
    l_shipdate AS LOAD_TS, 'feed/' || l_partkey || '.json' AS SOURCE_FILE, l_orderkey * 10 + l_linenumber AS RECORD_POSITION
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
apps AS (
  SELECT *, CASE WHEN status <> 'PENDING' THEN submitted_date + CAST(application_id % 20 AS INTEGER) END AS reviewed_date,
    CASE WHEN status = 'DENIED' THEN CASE WHEN vehicle_type = 'BEV' THEN 'Income exceeds threshold' ELSE 'MSRP exceeds cap' END END AS denial_reason
  FROM (
    SELECT o_orderkey AS application_id, 'V' || lpad(CAST(o_orderkey - o_orderkey % 3 AS VARCHAR), 9, '0') AS vin,
      CAST(o_orderdate AS DATE) AS submitted_date, CAST(o_custkey % 25 + 98101 AS VARCHAR) AS applicant_zip,
      CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'BEV' ELSE 'PHEV' END AS vehicle_type,
      'BRAND#' || (o_custkey % 25 + 1) AS make, 'MODEL ' || (o_custkey % 7) AS model, CAST(year(o_orderdate) + 28 AS INTEGER) AS model_year,
      CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 7500 ELSE 4000 END AS DECIMAL(10,2)) AS incentive_amount,
      CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'PENDING' ELSE 'DENIED' END AS status, o_orderdate AS updated_at
    FROM orders)),
"""


def _layers(strict: bool) -> str:
    dedup = "WHERE rn = 1 OR VIN IS NULL" if strict else "WHERE rn = 1"
    unknown = " OR EV_TYPE IS NULL" if strict else ""
    return f"""
dedup AS (SELECT * FROM (SELECT *, {_RANK} AS rn FROM bronze) {dedup}),
located AS (SELECT *, replace(replace(VEHICLE_LOCATION, 'POINT (', ''), ')', '') AS inside FROM dedup),
latest_apps AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY updated_at DESC, application_id DESC) AS app_rank FROM apps) WHERE app_rank = 1),
silver AS (
  SELECT v.VIN, upper(v.COUNTY) AS COUNTY, upper(v.CITY) AS CITY, v.STATE, substring(v.POSTAL_CODE, 1, 10) AS POSTAL_CODE, v.MODEL_YEAR,
    upper(v.MAKE) AS MAKE, upper(v.MODEL) AS MODEL, v.EV_TYPE, v.CAFV_ELIGIBILITY, v.ELECTRIC_RANGE, v.BASE_MSRP,
    substring(v.LEGISLATIVE_DISTRICT, 1, 5) AS LEGISLATIVE_DISTRICT, v.ELECTRIC_UTILITY, v.CENSUS_TRACT,
    TRY_CAST(split_part(v.inside, ' ', 1) AS DOUBLE) AS LONGITUDE, TRY_CAST(split_part(v.inside, ' ', 2) AS DOUBLE) AS LATITUDE,
    z.population AS POPULATION, z.median_income AS MEDIAN_INCOME, z.ev_charging_stations AS EV_CHARGING_STATIONS,
    g.target_ev_count AS TARGET_EV_COUNT, g.policy_name AS POLICY_NAME, i.incentive_amount AS INCENTIVE_AMOUNT,
    i.status AS APPLICATION_STATUS, v.LOAD_TS
  FROM located v LEFT JOIN zips z ON v.POSTAL_CODE = z.zip_code LEFT JOIN goals g ON v.STATE = g.state AND v.MODEL_YEAR = g.year
    LEFT JOIN latest_apps i ON v.VIN = i.vin
  WHERE v.VIN IS NOT NULL AND v.EV_TYPE IN {_TYPES} AND (v.ELECTRIC_RANGE >= 0 OR v.ELECTRIC_RANGE IS NULL)),
quarantine AS (
  SELECT VIN, COUNTY, CITY, STATE, POSTAL_CODE, MODEL_YEAR, MAKE, MODEL, EV_TYPE, ELECTRIC_RANGE, LOAD_TS,
    CASE WHEN VIN IS NULL THEN 'VIN is NULL' WHEN EV_TYPE NOT IN {_TYPES}{unknown} THEN 'Invalid ev_type: ' || coalesce(EV_TYPE, 'NULL')
      ELSE 'Negative electric_range: ' || ELECTRIC_RANGE END AS REJECTION_REASON
  FROM dedup WHERE VIN IS NULL OR EV_TYPE NOT IN {_TYPES}{unknown} OR ELECTRIC_RANGE < 0),
dim_vehicle AS (SELECT DISTINCT VIN, MAKE, MODEL, MODEL_YEAR, EV_TYPE, ELECTRIC_RANGE, BASE_MSRP FROM silver),
keyed AS (SELECT *, sha256(coalesce(COUNTY, '') || '|' || coalesce(CITY, '') || '|' || coalesce(POSTAL_CODE, '')) AS GEO_KEY FROM silver),
dim_geography AS (SELECT DISTINCT GEO_KEY, COUNTY, CITY, STATE, POSTAL_CODE, LEGISLATIVE_DISTRICT, LATITUDE, LONGITUDE, POPULATION, MEDIAN_INCOME, EV_CHARGING_STATIONS FROM keyed),
geo_by_key AS (
  SELECT * EXCLUDE (gn) FROM (SELECT *, row_number() OVER (PARTITION BY GEO_KEY ORDER BY COUNTY, CITY, STATE, POSTAL_CODE,
    LEGISLATIVE_DISTRICT, LATITUDE NULLS LAST, LONGITUDE NULLS LAST, POPULATION NULLS LAST) AS gn FROM dim_geography) WHERE gn = 1),
fact AS (SELECT VIN, GEO_KEY, MODEL_YEAR, CAFV_ELIGIBILITY, ELECTRIC_UTILITY, CENSUS_TRACT, TARGET_EV_COUNT, POLICY_NAME,
    INCENTIVE_AMOUNT, APPLICATION_STATUS, CAST(LOAD_TS AS TIMESTAMP) AS LOAD_TS FROM keyed),
by_county AS (
  SELECT COUNTY, EV_TYPE, count(*) AS REGISTRATION_COUNT, avg(ELECTRIC_RANGE) AS AVG_ELECTRIC_RANGE, max(POPULATION) AS POPULATION,
    CASE WHEN max(POPULATION) > 0 THEN count(*) / CAST(max(POPULATION) AS DOUBLE) END AS REGISTRATIONS_PER_CAPITA
  FROM silver GROUP BY COUNTY, EV_TYPE),
by_year AS (
  SELECT *, CASE WHEN TARGET_EV_COUNT > 0 THEN CUMULATIVE_COUNT / CAST(TARGET_EV_COUNT AS DOUBLE) END AS PCT_OF_GOAL FROM (
    SELECT MODEL_YEAR, EV_TYPE, count(*) AS REGISTRATION_COUNT,
      CAST(sum(count(*)) OVER (PARTITION BY EV_TYPE ORDER BY MODEL_YEAR NULLS LAST) AS BIGINT) AS CUMULATIVE_COUNT,
      max(TARGET_EV_COUNT) AS TARGET_EV_COUNT FROM silver GROUP BY MODEL_YEAR, EV_TYPE))
"""


def over_feed(select: str, strict: bool = False) -> str:
    """The select over the layers, as one statement."""
    return f"WITH {BRONZE}{_layers(strict)}{select}"
