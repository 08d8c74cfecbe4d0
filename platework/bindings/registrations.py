"""Layers, quality and questions over the registrations derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platework.bindings.feed import EVENT_CONTRACT, LINE_CONTRACT, Layers, event_documents, metric_history, text_documents
from platework.bindings.feed_sql import over_feed
from platework.bindings.registry import percent_sql, query
from platework.plans import gold, health, quality, questions
from platework.plans.semantic import measures_over_time, semantic_query
from platework.schemas import SILVER_COLUMNS
from platework.sources import documents
from platework.sources.tables import literal_table

NOW_TEXT = "2002-01-01 00:00:30"
NOW_SQL = "TIMESTAMP '2002-01-01 00:00:30'"


def _moment(text: str = NOW_TEXT):
    return F.lit(text).cast("timestamp_ntz")


def _amounts(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so that both sides name the same type."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    plain = {n: "double" if k.startswith("decimal") else "string" for n, k in kinds.items() if k.startswith(("decimal", "date"))}
    return df.withColumns({n: F.col(n).cast(k) for n, k in plain.items()})


# Documents

_LINES = "SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents"


@query(f"""SELECT CAST(i AS INTEGER) AS LINE_NO, line AS LINE, source AS SOURCE, 'docs/' || doc_id || '.json' AS SOURCE_FILE,
  CAST(i AS BIGINT) AS RECORD_POSITION, TIMESTAMP '2024-02-01' AS LOADED_AT FROM ({_LINES})""")
def parsed_lines(spark, sf):
    """Whole texts, many records per document, two column orders."""
    return documents.parse_documents(text_documents(spark, sf), LINE_CONTRACT).drop("LOAD_TS")


@query("""SELECT 'meta,data' AS top_level_keys, CAST(len(string_split(text, chr(10))) AS INTEGER) AS record_count, lang AS dataset_name,
  TIMESTAMP '2024-02-01' AS loaded_at, 'docs/' || doc_id || '.json' AS source_file FROM documents""")
def document_profiles(spark, sf):
    profiles = documents.profile_documents(text_documents(spark, sf))
    return profiles.withColumn("top_level_keys", F.array_join("top_level_keys", ","))


@query("""SELECT event_id AS EVENT_ID, event_type AS EVENT_TYPE, CASE WHEN event_type <> 'purchase' THEN value END AS VALUE,
  CASE WHEN event_type <> 'signup' THEN 'props ' || props END AS NOTE, ts AS LOADED_AT FROM events""")
def parsed_events(spark, sf):
    """Typed cells; unreadable numbers and rows shorter than the header give NULL."""
    parsed = documents.parse_documents(event_documents(spark, sf), EVENT_CONTRACT)
    return parsed.select("EVENT_ID", "EVENT_TYPE", "VALUE", "NOTE", "LOADED_AT")


@query("""SELECT 'events/' || event_id || '.json' AS source_file,
  CASE event_type WHEN 'click' THEN 'value' ELSE 'event_id,event_type,value,note' END AS missing
FROM events WHERE event_type IN ('click', 'error')""")
def header_violations(spark, sf):
    found = documents.contract_violations(event_documents(spark, sf, faulty=True), EVENT_CONTRACT)
    return found.withColumn("missing", F.array_join("missing", ","))


@query("SELECT 'events/' || event_id || '.json' AS source_file, ts AS loaded_at FROM events WHERE event_type = 'error'")
def unreadable_documents(spark, sf):
    return documents.rejected_documents(event_documents(spark, sf, faulty=True))


@query("""SELECT event_id AS EVENT_ID, event_type AS EVENT_TYPE, CASE WHEN event_type NOT IN ('purchase', 'click') THEN value END AS VALUE,
  CASE event_type WHEN 'click' THEN CAST(value AS VARCHAR) WHEN 'signup' THEN NULL ELSE 'props ' || props END AS NOTE
FROM events WHERE event_type <> 'error'""")
def parsed_past_faults(spark, sf):
    """Unreadable documents are skipped, fields the header lacks are NULL."""
    readable = documents.accept_documents(event_documents(spark, sf, faulty=True), "continue")
    parsed = documents.parse_documents(readable, EVENT_CONTRACT, on_missing="null")
    return parsed.select("EVENT_ID", "EVENT_TYPE", "VALUE", "NOTE")


@query("SELECT 'events/' || event_id || '.json' AS source_file, ts AS loaded_at FROM events ORDER BY loaded_at DESC")
def ingested_file_list(spark, sf):
    return health.ingested_files(event_documents(spark, sf))


# Layers

_SILVER = ", ".join(c if c != "INCENTIVE_AMOUNT" else "CAST(INCENTIVE_AMOUNT AS DOUBLE) AS INCENTIVE_AMOUNT" for c in SILVER_COLUMNS)


@query(over_feed(f"SELECT {_SILVER} FROM silver"))
def silver_registrations(spark, sf):
    return _amounts(Layers(spark, sf).silver())


@query(over_feed(f"SELECT {_SILVER} FROM silver", strict=True))
def silver_registrations_strict(spark, sf):
    return _amounts(Layers(spark, sf, mode="strict").silver())


@query(over_feed("SELECT * FROM quarantine"))
def quarantined_registrations(spark, sf):
    return Layers(spark, sf).quarantine()


@query(over_feed("SELECT * FROM quarantine", strict=True))
def quarantined_registrations_strict(spark, sf):
    return Layers(spark, sf, mode="strict").quarantine()


@query(over_feed("SELECT * FROM dim_vehicle"))
def vehicle_dimension(spark, sf):
    return gold.dim_vehicle(Layers(spark, sf).silver())


@query(over_feed("SELECT * FROM dim_geography"))
def geography_dimension(spark, sf):
    return Layers(spark, sf).dim_geography()


@query(over_feed("SELECT * FROM geo_by_key"))
def geography_dimension_by_key(spark, sf):
    return Layers(spark, sf, grain="key").dim_geography()


@query(over_feed("SELECT * REPLACE (CAST(INCENTIVE_AMOUNT AS DOUBLE) AS INCENTIVE_AMOUNT) FROM fact"))
def registration_fact(spark, sf):
    return _amounts(Layers(spark, sf).fact())


@query(over_feed("SELECT * FROM by_county"))
def registrations_by_county(spark, sf):
    return Layers(spark, sf).agg_by_county()


@query(over_feed("SELECT * FROM by_year"))
def registrations_by_year(spark, sf):
    return Layers(spark, sf).agg_by_year()


_SHARED = """SELECT f.* EXCLUDE (GEO_KEY) REPLACE (CAST(f.INCENTIVE_AMOUNT AS DOUBLE) AS INCENTIVE_AMOUNT),
  v.MAKE, v.MODEL, v.EV_TYPE, v.ELECTRIC_RANGE, v.BASE_MSRP, g.* EXCLUDE (GEO_KEY)
FROM fact f LEFT JOIN dim_vehicle v ON f.VIN = v.VIN LEFT JOIN {geo} g ON f.GEO_KEY = g.GEO_KEY"""


@query(over_feed(_SHARED.format(geo="dim_geography")))
def shared_view(spark, sf):
    """Flat consumer view; places with several rows per key fan out, as in the reference grain."""
    layers = Layers(spark, sf, stored=True)
    return _amounts(gold.shared_registrations(layers.fact(), layers.dim_vehicle(), layers.dim_geography(), spread=False))


@query(over_feed(_SHARED.format(geo="geo_by_key")))
def shared_view_by_key(spark, sf):
    """One row per vehicle, with the geography joined by the strategy for large dimensions."""
    layers = Layers(spark, sf, grain="key", stored=True)
    flat = gold.shared_registrations(layers.fact(), layers.dim_vehicle(), layers.dim_geography(), spread=True)
    return _amounts(flat)


def _policy(spark):
    rows = [("AGENCY_THREE", "NATION_3"), ("AGENCY_TWO", "NATION_5"), ("AGENCY_TWO", "NATION_7")]
    return literal_table(spark, rows, "consumer string, value string")


@query(over_feed("SELECT VIN, COUNTY, CAST(NULL AS INTEGER) AS BASE_MSRP FROM silver WHERE COUNTY IN ('NATION_5', 'NATION_7')"))
def restricted_rows(spark, sf):
    rows = Layers(spark, sf).silver().select("VIN", "COUNTY", "BASE_MSRP")
    return gold.restrict(rows, "AGENCY_TWO", _policy(spark), mask=("BASE_MSRP",))


@query(over_feed("SELECT VIN, COUNTY, BASE_MSRP FROM silver"))
def unrestricted_rows(spark, sf):
    """A consumer that the policy does not name sees all."""
    rows = Layers(spark, sf).silver().select("VIN", "COUNTY", "BASE_MSRP")
    return gold.restrict(rows, "PROVIDER", _policy(spark), mask=("BASE_MSRP",))


# Health and quality

_COUNTED = ["bronze", "silver", "quarantine", "dim_vehicle", "dim_geography", "fact_registrations", "agg_by_county", "agg_by_year"]
_SQL_NAMES = {"fact_registrations": "fact", "agg_by_county": "by_county", "agg_by_year": "by_year"}


@query(over_feed(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {_SQL_NAMES.get(t, t)}" for t in _COUNTED)))
def layer_row_counts(spark, sf):
    return health.row_counts(Layers(spark, sf, stored=True).tables(*_COUNTED))


@query(over_feed(f"""SELECT *, CASE WHEN bronze_distinct_vins = silver_plus_quarantine THEN '{health.PASS_TEXT}' ELSE '{health.INVESTIGATE_TEXT}' END AS reconciliation_status
FROM (SELECT (SELECT count(*) FROM events) AS raw_variant, (SELECT count(*) FROM bronze) AS bronze_parsed, (SELECT count(DISTINCT VIN) FROM bronze) AS bronze_distinct_vins,
  (SELECT count(*) FROM silver) AS silver, (SELECT count(*) FROM quarantine) AS quarantine,
  (SELECT count(*) FROM silver) + (SELECT count(*) FROM quarantine) AS silver_plus_quarantine, (SELECT count(*) FROM fact) AS gold_fact)"""))
def layer_health(spark, sf):
    return health.bronze_health(event_documents(spark, sf), Layers(spark, sf).bronze())


@query(over_feed(f"""SELECT count(*) AS row_count, max(LOAD_TS) AS most_recent_record,
  date_diff('minute', max(LOAD_TS), {NOW_SQL}) AS minutes_since_latest FROM silver"""))
def freshness_line(spark, sf):
    return health.freshness_summary(Layers(spark, sf).silver(), _moment())


def _metrics_sql(expected: str) -> str:
    return f"""SELECT {NOW_SQL} AS SCHEDULED_TIME, {NOW_SQL} AS MEASUREMENT_TIME, '{quality.DATABASE_NAME}' AS TABLE_DATABASE, '{quality.SCHEMA_NAME}' AS TABLE_SCHEMA,
  TABLE_NAME, METRIC_NAME, CAST(VALUE AS DOUBLE) AS VALUE FROM (
  SELECT '{quality.SILVER_NAME}' AS TABLE_NAME, '{quality.COMPLETENESS}' AS METRIC_NAME, {percent_sql('count(VIN)', 'count(*)')} AS VALUE FROM silver
  UNION ALL SELECT '{quality.SILVER_NAME}', '{quality.DUPLICATES}', (SELECT count(*) FROM (SELECT VIN FROM silver GROUP BY VIN HAVING count(*) > 1))
  UNION ALL SELECT '{quality.SILVER_NAME}', '{quality.RULES}', (SELECT count(*) FROM silver WHERE EV_TYPE NOT LIKE '%EV)' OR ELECTRIC_RANGE < 0)
  UNION ALL SELECT '{quality.SILVER_NAME}', '{quality.RECONCILIATION}', {expected} - (SELECT count(*) FROM silver) - (SELECT count(*) FROM quarantine)
  UNION ALL SELECT '{quality.SILVER_NAME}', '{quality.FRESHNESS}', date_diff('second', max(LOAD_TS), {NOW_SQL}) FROM silver
  UNION ALL SELECT '{quality.QUARANTINE_NAME}', '{quality.COMPLETENESS}', {percent_sql('count(VIN)', 'count(*)')} FROM quarantine)"""


def _evaluated(layers: Layers) -> DataFrame:
    return _amounts(quality.evaluate_bronze(layers.bronze(), _moment(), layers.mode))


@query(over_feed(_metrics_sql("(SELECT count(DISTINCT VIN) FROM bronze)")))
def evaluated_metrics(spark, sf):
    return _evaluated(Layers(spark, sf))


@query(over_feed(_metrics_sql("(SELECT count(DISTINCT VIN) + count(*) FILTER (VIN IS NULL) FROM bronze)"), strict=True))
def evaluated_metrics_strict(spark, sf):
    return _evaluated(Layers(spark, sf, mode="strict"))


_METRIC = ("SELECT {} AS VALUE FROM bronze").format


@query(over_feed(_METRIC(percent_sql("count(VIN)", "count(*)"))))
def completeness_metric(spark, sf):
    return _amounts(quality.completeness_metric(Layers(spark, sf).bronze()))


@query(over_feed("SELECT count(*) AS VALUE FROM (SELECT VIN FROM bronze GROUP BY VIN HAVING count(*) > 1)"))
def duplicate_metric(spark, sf):
    return quality.duplicate_metric(Layers(spark, sf).bronze())


@query(over_feed(_METRIC("count(*) FILTER (EV_TYPE NOT LIKE '%EV)' OR ELECTRIC_RANGE < 0)")))
def rule_metric(spark, sf):
    return quality.rule_metric(Layers(spark, sf).bronze())


@query(over_feed(_METRIC(f"date_diff('second', max(LOAD_TS), {NOW_SQL})")))
def freshness_metric(spark, sf):
    return quality.freshness_metric(Layers(spark, sf).bronze(), _moment())


@query(over_feed("SELECT (SELECT count(DISTINCT VIN) FROM bronze) - (SELECT count(*) FROM silver) - (SELECT count(*) FROM quarantine) AS VALUE"))
def reconciliation_metric(spark, sf):
    profile = quality.judged_profile(Layers(spark, sf).bronze())
    return profile.select((F.col("distinct_keys") - F.col("silver_rows") - F.col("quarantine_rows")).alias("VALUE"))


@query(over_feed("SELECT REJECTION_REASON, count(*) AS rejected_count FROM quarantine GROUP BY 1"))
def quarantine_breakdown(spark, sf):
    return quality.quarantine_breakdown(Layers(spark, sf).quarantine())


_HISTORY = f"""history AS (SELECT ts AS SCHEDULED_TIME, ts AS MEASUREMENT_TIME, '{quality.SCHEMA_NAME}' AS TABLE_SCHEMA,
  CASE WHEN user_id < 50 THEN '{quality.SILVER_NAME}' ELSE '{quality.QUARANTINE_NAME}' END AS TABLE_NAME,
  CASE event_type WHEN 'signup' THEN '{quality.COMPLETENESS}' WHEN 'click' THEN '{quality.DUPLICATES}' WHEN 'view' THEN '{quality.FRESHNESS}'
    WHEN 'purchase' THEN '{quality.RULES}' ELSE '{quality.RECONCILIATION}' END AS METRIC_NAME,
  CASE WHEN user_id <> 7 THEN CASE event_type WHEN 'signup' THEN CASE WHEN value > 30 THEN 99.5 ELSE 100.0 END
    WHEN 'view' THEN CAST(CAST(value AS DECIMAL(18,2)) * 300 AS DOUBLE) WHEN 'error' THEN floor(value / 30) - 1 ELSE floor(value / 40) END END AS VALUE
  FROM events)"""
_STATUS = f"""CASE WHEN METRIC_NAME = '{quality.COMPLETENESS}' AND VALUE < 100 THEN 'WARN — incomplete VINs'
  WHEN METRIC_NAME = '{quality.DUPLICATES}' AND VALUE > 0 THEN 'FAIL — duplicate VINs detected'
  WHEN METRIC_NAME = '{quality.FRESHNESS}' AND VALUE > 10800 THEN 'WARN — data stale (>3 hours)'
  WHEN METRIC_NAME = '{quality.RULES}' AND VALUE > 0 THEN 'FAIL — invalid rows in Silver'
  WHEN METRIC_NAME = '{quality.RECONCILIATION}' AND VALUE <> 0 THEN 'FAIL — row count mismatch' ELSE 'PASS' END"""
_FAILURES = f"(METRIC_NAME IN ('{quality.DUPLICATES}', '{quality.RULES}') AND VALUE > 0 OR METRIC_NAME = '{quality.RECONCILIATION}' AND VALUE <> 0)"


@query(f"WITH {_HISTORY} SELECT *, {_STATUS} AS QUALITY_STATUS FROM history ORDER BY MEASUREMENT_TIME DESC")
def quality_dashboard(spark, sf):
    return _amounts(quality.quality_dashboard(metric_history(spark, sf)))


@query(f"WITH {_HISTORY} SELECT *, CASE WHEN VALUE IS NULL THEN 'NO DATA' ELSE {_STATUS} END AS QUALITY_STATUS FROM history")
def quality_dashboard_strict(spark, sf):
    return _amounts(quality.quality_dashboard(metric_history(spark, sf), strict=True))


@query(f"""WITH {_HISTORY} SELECT failures, CASE WHEN failures > 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS run_status,
  CASE WHEN failures > 0 THEN 'metric threshold breached' END AS error_message
FROM (SELECT count(*) AS failures FROM history WHERE MEASUREMENT_TIME > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 2 HOUR AND {_FAILURES})""")
def breach_check(spark, sf):
    return quality.check_breaches(metric_history(spark, sf), _moment("2024-01-30 12:00:00"))


@query(f"""WITH {_HISTORY} SELECT MEASUREMENT_TIME, TABLE_NAME, METRIC_NAME, VALUE FROM history
WHERE MEASUREMENT_TIME > TIMESTAMP '2024-01-25' AND ({_FAILURES} OR METRIC_NAME = '{quality.FRESHNESS}' AND VALUE > 21600)""")
def alert_breaches(spark, sf):
    found = quality.alert_breaches(metric_history(spark, sf), _moment("2024-01-25 00:00:00"))
    return _amounts(found.select("MEASUREMENT_TIME", "TABLE_NAME", "METRIC_NAME", "VALUE"))


@query(f"""WITH {_HISTORY} SELECT TABLE_NAME, METRIC_NAME, VALUE, split_part({_STATUS}, ' ', 1) AS STATUS, MEASUREMENT_TIME FROM (
  SELECT *, row_number() OVER (PARTITION BY TABLE_NAME, METRIC_NAME ORDER BY MEASUREMENT_TIME DESC, VALUE DESC) AS rn FROM history WHERE VALUE IS NOT NULL) WHERE rn = 1""")
def current_metric_status(spark, sf):
    return _amounts(quality.current_status(metric_history(spark, sf)))


@query(f"WITH {_HISTORY} SELECT MEASUREMENT_TIME, METRIC_NAME, VALUE FROM history WHERE VALUE IS NOT NULL")
def metric_series(spark, sf):
    return _amounts(quality.metric_series(metric_history(spark, sf)))


# Measures by dimensions

def _star(spark, sf, *names):
    return Layers(spark, sf, grain="key", stored=True).tables("fact_registrations", "dim_vehicle", "dim_geography", *names)


@query(over_feed("SELECT MAKE, count(VIN) AS registration_count, avg(ELECTRIC_RANGE) AS avg_electric_range FROM silver GROUP BY MAKE"))
def measures_by_make(spark, sf):
    return semantic_query(_star(spark, sf), ["registration_count", "avg_electric_range"], ["MAKE"])


@query(over_feed("""SELECT g.COUNTY, f.MODEL_YEAR, count(*) AS registration_count FROM fact f JOIN geo_by_key g ON f.GEO_KEY = g.GEO_KEY
WHERE g.STATE = 'WA' GROUP BY 1, 2"""))
def measures_by_county_and_year(spark, sf):
    return semantic_query(
        _star(spark, sf), ["registration_count"], ["COUNTY", "MODEL_YEAR"], {"STATE": F.col("STATE") == "WA"}
    )


_APPS = """count(application_id) AS total_applications, CAST(count(*) FILTER (status = 'APPROVED') * 100 AS DOUBLE) / count(application_id) AS approval_rate,
  CAST(sum(CASE WHEN status = 'APPROVED' THEN incentive_amount ELSE 0 END) AS DOUBLE) AS total_incentive_amount,
  count(*) FILTER (status = 'PENDING') AS pending_count, count(*) FILTER (status = 'DENIED') AS denied_count"""
_APP_MEASURES = ["total_applications", "approval_rate", "total_incentive_amount", "pending_count", "denied_count"]


@query(over_feed(f"SELECT applicant_zip, {_APPS} FROM apps GROUP BY 1"))
def application_measures_by_zip(spark, sf):
    tables = Layers(spark, sf).tables("incentive_applications")
    return _amounts(semantic_query(tables, _APP_MEASURES, ["applicant_zip"]))


@query(over_feed(f"SELECT CAST(submitted_date AS VARCHAR) AS submitted_date, {_APPS} FROM apps GROUP BY 1"))
def application_measures_by_date(spark, sf):
    tables = Layers(spark, sf).tables("incentive_applications")
    return _amounts(semantic_query(tables, _APP_MEASURES, ["submitted_date"]))


@query(over_feed("SELECT MODEL_YEAR, EV_TYPE, count(VIN) AS registration_count FROM silver GROUP BY ALL"))
def registrations_over_time(spark, sf):
    """By the fact's time dimension and another one."""
    tables = Layers(spark, sf, stored=True).tables("fact_registrations", "dim_vehicle")
    return measures_over_time(tables, ["registration_count"], ["EV_TYPE"])


@query(over_feed("SELECT COUNTY, count(VIN) AS registration_count FROM silver GROUP BY COUNTY"))
def measures_over_reference_grain(spark, sf):
    """A geography with several rows per key counts every registration once all the same."""
    tables = Layers(spark, sf, stored=True).tables("fact_registrations", "dim_geography")
    return semantic_query(tables, ["registration_count"], ["COUNTY"])


@query(over_feed("""SELECT status, count(DISTINCT s.VIN) AS registration_count FROM silver s LEFT JOIN apps a ON s.VIN = a.vin GROUP BY 1"""))
def registrations_by_application_status(spark, sf):
    """A registration counts in every status that it has an application in."""
    tables = Layers(spark, sf, stored=True).tables("fact_registrations", "incentive_applications")
    return semantic_query(tables, ["registration_count"], ["status"])


@query(over_feed("""SELECT s.MAKE, count(a.application_id) AS total_applications FROM silver s JOIN apps a ON s.VIN = a.vin
WHERE a.status = 'APPROVED' GROUP BY 1"""))
def approved_applications_by_make(spark, sf):
    """Applications by a vehicle's dimension, filtered on their own column."""
    tables = Layers(spark, sf, stored=True).tables("fact_registrations", "dim_vehicle", "incentive_applications")
    return semantic_query(tables, ["total_applications"], ["MAKE"], {"status": F.col("status") == "APPROVED"})


@query(over_feed(f"""SELECT r.EV_TYPE, registration_count, a.* EXCLUDE (EV_TYPE) FROM
  (SELECT EV_TYPE, count(*) AS registration_count FROM silver GROUP BY 1) r JOIN
  (SELECT EV_TYPE, {_APPS} FROM (SELECT VIN, EV_TYPE FROM silver) s JOIN apps a ON s.VIN = a.vin GROUP BY 1) a ON r.EV_TYPE = a.EV_TYPE"""))
def registrations_and_applications(spark, sf):
    """A vehicle with several applications counts as one registration."""
    tables = _star(spark, sf, "incentive_applications")
    return _amounts(semantic_query(tables, ["registration_count", *_APP_MEASURES], ["EV_TYPE"]))


@query(over_feed("""SELECT EV_TYPE, CAST(sum(REGISTRATION_COUNT) AS BIGINT) AS total_registrations, max(CUMULATIVE_COUNT) AS latest_cumulative,
  max(PCT_OF_GOAL) * 100 AS goal_progress_pct FROM by_year GROUP BY 1"""))
def year_measures(spark, sf):
    tables = Layers(spark, sf).tables("agg_by_year")
    return semantic_query(
        tables, ["agg_by_year.total_registrations", "latest_cumulative", "goal_progress_pct"], ["EV_TYPE"]
    )


@query(over_feed("""SELECT CAST(sum(REGISTRATION_COUNT) AS BIGINT) AS total_registrations, round(avg(REGISTRATIONS_PER_CAPITA), 9) AS avg_per_capita FROM by_county"""))
def county_measures(spark, sf):
    tables = Layers(spark, sf).tables("agg_by_county")
    found = semantic_query(tables, ["agg_by_county.total_registrations", "avg_per_capita"])
    return found.withColumn("avg_per_capita", F.round("avg_per_capita", 9))


# Questions

def _ask(question, *names, **options):
    """The question over those tables of the derived registrations."""

    # Two tables that both come from silver: write it once.
    stored = {"fact_registrations", "dim_geography"} <= set(names)

    def build(spark, sf):
        return _amounts(question(Layers(spark, sf, stored=stored).tables(*names), **options))

    build.__name__ = question.__name__
    return build


def _question(sql: str | None, question, *names, **options) -> None:
    query(over_feed(sql) if sql else None)(_ask(question, *names, **options))


_question("""SELECT MODEL_YEAR, EV_TYPE, REGISTRATION_COUNT, CUMULATIVE_COUNT, TARGET_EV_COUNT, round(PCT_OF_GOAL * 100, 2) AS pct_of_goal
FROM by_year WHERE MODEL_YEAR >= 2020""", questions.goal_progress, "agg_by_year")

_GROWN = """(SELECT *, lag(total) OVER (ORDER BY MODEL_YEAR NULLS LAST) AS prev_year FROM (
  SELECT MODEL_YEAR, CAST(sum(REGISTRATION_COUNT) AS BIGINT) AS total FROM by_year GROUP BY 1))"""
_question(f"SELECT MODEL_YEAR, total, prev_year, {percent_sql('(total - prev_year)', 'prev_year')} AS yoy_growth_pct FROM {_GROWN}",
          questions.yearly_growth, "agg_by_year")
_question(f"SELECT *, total - prev_year AS jump FROM {_GROWN} WHERE prev_year IS NOT NULL ORDER BY jump DESC, MODEL_YEAR NULLS LAST LIMIT 1",
          questions.biggest_jump, "agg_by_year")
_question("SELECT MODEL_YEAR, EV_TYPE, CUMULATIVE_COUNT, TARGET_EV_COUNT FROM by_year", questions.adoption_trend, "agg_by_year")
_question("SELECT MODEL_YEAR, max(TARGET_EV_COUNT) AS TARGET_EV_COUNT FROM by_year WHERE TARGET_EV_COUNT IS NOT NULL GROUP BY 1",
          questions.target_line, "agg_by_year")
_question(f"""SELECT *, {percent_sql('cumulative', 'target')} AS pct_of_target FROM (SELECT CAST(2026 AS INTEGER) AS MODEL_YEAR,
  (SELECT count(*) FROM silver WHERE MODEL_YEAR <= 2026) AS cumulative,
  (SELECT max(TARGET_EV_COUNT) FROM silver WHERE MODEL_YEAR = 2026) AS target) WHERE (SELECT count(*) FROM silver WHERE MODEL_YEAR = 2026) > 0""", questions.goal_share_of_year, "agg_by_year", year=2026)
_question("""SELECT CAST(2030 AS INTEGER) AS target_year, round(projected, 2) AS projected, CAST(1200000 AS BIGINT) AS target, projected >= 1200000 AS on_track
FROM (SELECT regr_slope(c, MODEL_YEAR) * 2030 + regr_intercept(c, MODEL_YEAR) AS projected FROM (
  SELECT y.MODEL_YEAR, count(*) AS c FROM (SELECT DISTINCT MODEL_YEAR FROM silver) y JOIN silver s ON s.MODEL_YEAR <= y.MODEL_YEAR GROUP BY 1))""",
          questions.goal_projection, "agg_by_year", "state_goals")
_question("""SELECT COUNTY, CAST(sum(REGISTRATION_COUNT) AS BIGINT) AS total_registrations, max(POPULATION) AS population, max(REGISTRATIONS_PER_CAPITA) AS per_capita
FROM by_county GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""", questions.top_counties, "agg_by_county")
_question("""SELECT COUNTY, CAST(sum(REGISTRATION_COUNT) AS BIGINT) AS total, max(REGISTRATIONS_PER_CAPITA) AS per_capita
FROM by_county GROUP BY 1 ORDER BY 3 DESC NULLS LAST, 1 LIMIT 10""", questions.top_counties_per_capita, "agg_by_county")
_question("""SELECT *, round(registrations / stations, 4) AS per_station FROM (
  SELECT COUNTY, CAST(sum(n) AS BIGINT) AS registrations, CAST(sum(stations) AS BIGINT) AS stations FROM (
    SELECT COUNTY, POSTAL_CODE, count(*) AS n, max(EV_CHARGING_STATIONS) AS stations FROM silver GROUP BY 1, 2) GROUP BY 1) WHERE stations > 0""",
          questions.registrations_per_station, "silver")
_question("""SELECT *, target - registrations AS shortfall FROM (SELECT LEGISLATIVE_DISTRICT, MODEL_YEAR, count(*) AS registrations,
  max(TARGET_EV_COUNT) AS target FROM silver WHERE TARGET_EV_COUNT IS NOT NULL GROUP BY 1, 2)""", questions.districts_behind_goal, "silver")
_question(f"""SELECT COUNTY, this_year, last_year, change, {percent_sql('change', 'total')} AS contribution_pct FROM (
  SELECT *, this_year - last_year AS change, CAST(sum(this_year - last_year) OVER () AS BIGINT) AS total FROM (
    SELECT COUNTY, count(*) FILTER (MODEL_YEAR = 2028) AS this_year, count(*) FILTER (MODEL_YEAR = 2027) AS last_year
    FROM silver WHERE MODEL_YEAR IN (2027, 2028) GROUP BY 1))""", questions.growth_contribution, "silver", year=2028)


def _shares(source: str, key: str, count: str, out: str) -> str:
    return f"""SELECT {key}, {count}, {percent_sql(count, 'total')} AS {out} FROM (
  SELECT {key}, count(*) AS {count}, (SELECT count(*) FROM {source}) AS total FROM {source} GROUP BY 1)"""


_question(_shares("dim_vehicle", "EV_TYPE", "registrations", "market_share_pct"), questions.market_share, "dim_vehicle")
_question(_shares("fact", "CAFV_ELIGIBILITY", "vehicles", "pct"), questions.eligibility_split, "fact_registrations")
_question("SELECT MAKE, count(*) AS registrations, avg(ELECTRIC_RANGE) AS avg_range FROM dim_vehicle GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
          questions.top_makes, "dim_vehicle")
_question("SELECT MAKE, MODEL, count(*) AS registrations, avg(ELECTRIC_RANGE) AS avg_range FROM dim_vehicle GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10",
          questions.top_models, "dim_vehicle")
_question("SELECT MAKE, avg(ELECTRIC_RANGE) AS avg_range FROM dim_vehicle GROUP BY 1", questions.range_by_make, "dim_vehicle")
_question(f"""SELECT COUNTY, MAKE, registrations, {percent_sql('registrations', 'total')} AS share_pct FROM (
  SELECT *, CAST(sum(registrations) OVER (PARTITION BY COUNTY) AS BIGINT) AS total FROM (
    SELECT COUNTY, MAKE, count(*) AS registrations FROM silver GROUP BY 1, 2))""", questions.make_share_by_region, "silver")
_question("""SELECT *, this_year - last_year AS growth FROM (SELECT MAKE, MODEL, count(*) FILTER (MODEL_YEAR = 2026) AS this_year,
  count(*) FILTER (MODEL_YEAR = 2025) AS last_year FROM silver WHERE MEDIAN_INCOME > 90000 AND MODEL_YEAR IN (2025, 2026) GROUP BY 1, 2)
  ORDER BY this_year - last_year DESC, this_year DESC, MAKE, MODEL LIMIT 10""", questions.models_in_rich_zips, "silver", min_income=90_000, year=2026)
_question("SELECT MAKE, MODEL, count(*) AS registrations FROM silver WHERE COUNTY = 'NATION_3' AND MODEL_YEAR = 2026 GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 5",
          questions.top_models_in_county, "silver", county="NATION_3", year=2026)
_question(f"""SELECT MAKE, in_county, overall, {percent_sql('in_county', 'county_total')} AS county_pct, {percent_sql('overall', 'total')} AS state_pct FROM (
  SELECT MAKE, count(*) FILTER (COUNTY = 'NATION_3') AS in_county, count(*) AS overall, (SELECT count(*) FROM silver) AS total,
    (SELECT count(*) FROM silver WHERE COUNTY = 'NATION_3') AS county_total FROM silver GROUP BY 1)""",
          questions.county_mix_against_state, "silver", county="NATION_3")


def _approval(key: str) -> str:
    return f"""SELECT *, {percent_sql('approved', 'total_applications')} AS approval_rate_pct FROM (
  SELECT {key}, count(*) AS total_applications, count(*) FILTER (status = 'APPROVED') AS approved FROM apps GROUP BY 1)"""


_question(_approval("applicant_zip"), questions.approval_by_zip, "incentive_applications")
_question(_approval("vehicle_type"), questions.approval_by_vehicle_type, "incentive_applications")
_question("SELECT status, count(*) AS application_count, CAST(sum(incentive_amount) AS DOUBLE) AS total_amount FROM apps GROUP BY 1",
          questions.backlog_by_status, "incentive_applications")
_question(f"""SELECT g.POSTAL_CODE, g.COUNTY, g.POPULATION, count(DISTINCT f.VIN) AS registrations, ia.total_applications AS total_apps, ia.approval_rate_pct
FROM fact f JOIN dim_geography g ON f.GEO_KEY = g.GEO_KEY LEFT JOIN ({_approval('applicant_zip')}) ia ON g.POSTAL_CODE = ia.applicant_zip
WHERE ia.total_applications > 0 GROUP BY ALL HAVING count(DISTINCT f.VIN) > 50""",
          questions.busy_zips_low_approval, "fact_registrations", "dim_geography", "incentive_applications")
_question(f"""SELECT *, {percent_sql('approved', 'total_applications', 1)} AS approval_rate_pct FROM (
  SELECT count(*) AS total_applications, count(*) FILTER (APPLICATION_STATUS = 'APPROVED') AS approved, count(*) FILTER (APPLICATION_STATUS = 'PENDING') AS pending,
    count(*) FILTER (APPLICATION_STATUS = 'DENIED') AS denied, CAST(coalesce(sum(INCENTIVE_AMOUNT), 0) AS DOUBLE) AS total_requested,
    CAST(coalesce(sum(CASE WHEN APPLICATION_STATUS = 'APPROVED' THEN INCENTIVE_AMOUNT ELSE 0 END), 0) AS DOUBLE) AS total_approved
  FROM fact WHERE APPLICATION_STATUS IS NOT NULL)""", questions.incentive_cards, "fact_registrations")
_question("""SELECT application_id, vin, CAST(submitted_date AS VARCHAR) AS submitted_date, make, model, applicant_zip, CAST(incentive_amount AS DOUBLE) AS incentive_amount, status,
  CAST(reviewed_date AS VARCHAR) AS reviewed_date FROM apps a ORDER BY a.submitted_date DESC, application_id DESC LIMIT 5""", questions.newest_applications, "incentive_applications")
_question("SELECT denial_reason, count(*) AS denials FROM apps WHERE status = 'DENIED' GROUP BY 1", questions.denial_reasons, "incentive_applications")
_question("""SELECT * REPLACE (CAST(incentive_amount AS DOUBLE) AS incentive_amount, CAST(submitted_date AS VARCHAR) AS submitted_date,
  CAST(reviewed_date AS VARCHAR) AS reviewed_date) FROM apps WHERE denial_reason = 'MSRP exceeds cap'""",
          questions.denied_for, "incentive_applications", reason="MSRP exceeds cap")
_question("SELECT round(avg(reviewed_date - submitted_date), 4) AS avg_days FROM apps", questions.review_days, "incentive_applications")
_question("SELECT CAST(sum(incentive_amount) FILTER (status = 'APPROVED') AS DOUBLE) AS total_disbursed FROM apps",
          questions.total_disbursed, "incentive_applications")
_question("""SELECT applicant_zip, count(*) AS pending FROM apps WHERE status = 'PENDING'
  AND applicant_zip NOT IN (SELECT zip_code FROM zips WHERE ev_charging_stations > 0) GROUP BY 1""",
          questions.pending_without_stations, "incentive_applications", "zip_demographics")
_question(f"""SELECT EV_TYPE, registrations, applications, approved, {percent_sql('registrations', 'total')} AS share_pct,
  {percent_sql('approved', 'applications')} AS approval_rate_pct FROM (
  SELECT *, CAST(sum(registrations) OVER () AS BIGINT) AS total FROM (
    SELECT EV_TYPE, count(*) AS registrations, count(APPLICATION_STATUS) AS applications, count(*) FILTER (APPLICATION_STATUS = 'APPROVED') AS approved
    FROM silver WHERE MEDIAN_INCOME > 90000 GROUP BY 1))""", questions.rich_zip_split, "silver", min_income=90_000)
_question("SELECT make, model, count(*) AS approved FROM apps WHERE status = 'APPROVED' GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10",
          questions.approved_models, "incentive_applications")
_question("""SELECT VIN, MAKE, MODEL, COUNTY, POSTAL_CODE, POPULATION, MEDIAN_INCOME, EV_CHARGING_STATIONS, TARGET_EV_COUNT, POLICY_NAME,
  CAST(INCENTIVE_AMOUNT AS DOUBLE) AS INCENTIVE_AMOUNT, APPLICATION_STATUS FROM silver WHERE POPULATION IS NOT NULL ORDER BY VIN LIMIT 5""",
          questions.enriched_sample, "silver")
_question("""SELECT VIN, MAKE, MODEL, MODEL_YEAR, EV_TYPE, COUNTY, POSTAL_CODE, ELECTRIC_RANGE FROM bronze
  ORDER BY SOURCE_FILE, RECORD_POSITION LIMIT 5""", questions.parsed_sample, "bronze")


@query("SELECT min('docs/' || doc_id || '.json') AS source_file, TIMESTAMP '2024-02-01' AS loaded_at FROM documents")
def raw_sample(spark, sf):
    """The first landed document, by source file."""
    return questions.raw_sample({"raw": text_documents(spark, sf)}).select("source_file", "loaded_at")


@query(over_feed("""SELECT state, year, target_ev_count, policy_name, count(VIN) AS registrations FROM goals
LEFT JOIN (SELECT VIN, STATE AS s, MODEL_YEAR FROM silver) ON state = s AND year = MODEL_YEAR GROUP BY 1, 2, 3, 4"""))
def goals_listing(spark, sf):
    """Goals by year, next to the registrations they are about."""
    tables = Layers(spark, sf).tables("silver", "state_goals")
    met = tables["silver"].groupBy("STATE", "MODEL_YEAR").agg(F.count("VIN").alias("registrations"))
    met = met.withColumnsRenamed({"STATE": "s", "MODEL_YEAR": "y"})
    goals = tables["state_goals"]
    joined = goals.join(met, (F.col("state") == F.col("s")) & (F.col("year") == F.col("y")), "left").select(
        *goals.columns, F.coalesce("registrations", F.lit(0)).alias("registrations")
    )
    return questions.goals_listing({"state_goals": joined})
