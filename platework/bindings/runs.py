"""Runs over the driver's tables: layers kept up to date in buckets and by deltas, runs that break off, and health of what
was written. Each run writes to a new folder under the session's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platework.bindings.feed import LINE_CONTRACT, Layers, applications, bronze, table, text_documents
from platework.bindings.feed_sql import over_feed
from platework.bindings.registrations import _SHARED, _SILVER, _amounts, _metrics_sql, _moment
from platework.bindings.registry import query
from platework.bindings.streams import _supplier_documents, _write_files
from platework.operators.grouped import top_k
from platework.operators.lookups import hot_keys
from platework.plans import distinct, gold, health, quality, run, store
from platework.plans.semantic import drill_across
from platework.schemas import CONTRACT
from platework.sources import documents
from platework.session import new_folder
from platework.sources.tables import small_result, write_table


def _config(spark, sf, label: str, mode: str = "reference", **more) -> run.Config:
    root = new_folder(spark, label)
    write_table(applications(spark, sf), f"{root}/applications")
    return run.Config(in_dir=f"{root}/in", root=root, applications=f"{root}/applications", mode=mode, **more)


def _in_waves(spark, sf, label: str, mode: str = "reference") -> run.Config:
    """The first lines of all orders, a run, their later lines, and a run: the second replaces most vehicles' rows."""
    cfg, rows = _config(spark, sf, label, mode), bronze(spark, sf)
    line = F.col("RECORD_POSITION") % 10
    for wave in (line <= 2, line > 2):
        run.append_bronze(spark, cfg, rows.where(wave))
        run.refresh(spark, cfg, only=["silver", "gold"])
    return cfg


@query(over_feed(f"SELECT {_SILVER} FROM silver"))
def silver_by_buckets(spark, sf):
    """Silver after two waves, of which the second has rewritten the buckets that it touched."""
    return _amounts(run.load(spark, _in_waves(spark, sf, "bucketed-silver"), "silver"))


@query(over_feed("SELECT * FROM by_county"))
def county_by_deltas(spark, sf):
    """Counts, means and maxima after rows were taken back."""
    return run.load(spark, _in_waves(spark, sf, "county-deltas"), "agg_by_county")


@query(over_feed("SELECT * FROM by_year"))
def year_by_deltas(spark, sf):
    return run.load(spark, _in_waves(spark, sf, "year-deltas"), "agg_by_year")


@query(over_feed("SELECT 'dim_geography' AS layer, count(*) AS n FROM geo_by_key UNION ALL SELECT 'fact', count(*) FROM fact UNION ALL SELECT 'dim_vehicle', count(*) FROM dim_vehicle"))
def star_by_deltas(spark, sf):
    """Places that nothing refers to any more are gone, vehicles are there once."""
    loaded = run.load_all(spark, _in_waves(spark, sf, "star-deltas"), ["dim_geography", "fact_registrations", "dim_vehicle"])
    counts = health.row_counts({"fact" if n == "fact_registrations" else n: df for n, df in loaded.items()})
    return counts.withColumnsRenamed({"table_name": "layer", "row_count": "n"})


@query(over_feed("""SELECT name AS table_name, CASE WHEN (SELECT count(*) FROM bronze) > 0 THEN 1 ELSE 0 END AS buckets_written,
  (SELECT count(*) FROM silver) - CASE WHEN (SELECT count(*) FROM silver WHERE VIN = (SELECT max(VIN) FROM bronze)) > 0 THEN 0 ELSE -1 END AS silver_rows
FROM (VALUES ('latest'), ('silver'), ('quarantine'), ('dim_vehicle'), ('fact_registrations')) AS t(name)"""))
def buckets_rewritten(spark, sf):
    """All rows, a run, a new row of one vehicle, a run: each table gets one bucket written."""
    cfg, rows = _config(spark, sf, "one-bucket"), bronze(spark, sf)
    run.append_bronze(spark, cfg, rows)
    run.refresh(spark, cfg, only=["silver", "gold"])
    newest = run.load(spark, cfg, "bronze").where("VIN IS NOT NULL").orderBy(F.col("VIN").desc()).limit(1)
    good = run.load(spark, cfg, "silver").select("EV_TYPE").limit(1)
    again = newest.drop("EV_TYPE", "ELECTRIC_RANGE").join(good).select(
        "*", F.lit(100).alias("ELECTRIC_RANGE")).withColumn("LOAD_TS", F.lit("2099-01-01 00:00:00").cast("timestamp_ntz"))
    run.append_bronze(spark, cfg, again.select(*newest.columns))
    run.refresh(spark, cfg, only=["silver", "gold"])
    at = store.published(spark, cfg.root)
    names = ["latest", "silver", "quarantine", "dim_vehicle", "fact_registrations"]
    return spark.createDataFrame(
        [(n, len(at[n].last.buckets), at["silver"].rows) for n in names], "table_name string, buckets_written int, silver_rows long")


class _Stopped(Exception):
    pass


def _stop_at(step: str):
    def stop(now: str) -> None:
        if now == step:
            raise _Stopped(step)
    return stop


@query("""SELECT 'S' || s_suppkey AS VIN, 'bronze' AS layer FROM supplier UNION ALL
SELECT 'S' || s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN 'quarantine' ELSE 'fact' END FROM supplier""")
def run_after_crash(spark, sf):
    """Runs that end before bronze, silver and gold become visible, each with new files before the next try: nothing is
    lost, nothing comes twice."""
    root = new_folder(spark, "crashes")
    waves = [("bronze", F.col("s_nationkey") < 8), ("silver", F.col("s_nationkey").between(8, 15)), ("gold", F.col("s_nationkey") > 15)]
    for step, rows in waves:
        _write_files(_supplier_documents(spark, sf, step, rows), f"{root}/in")
        try:
            run.refresh(spark, run.Config(in_dir=f"{root}/in", root=root, before_publish=_stop_at(step)))
        except _Stopped:
            pass
    cfg = run.Config(in_dir=f"{root}/in", root=root)
    run.refresh(spark, cfg)
    loaded = run.load_all(spark, cfg, ["bronze", "quarantine", "fact_registrations"])
    named = [df.select("VIN", F.lit(n.removesuffix("_registrations")).alias("layer")) for n, df in loaded.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("""SELECT CASE WHEN count(*) FILTER (s_nationkey = 3) > 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS check_status,
  CAST(count(*) FILTER (s_nationkey = 3) AS DOUBLE) AS lost, count(*) FILTER (s_nationkey <> 3) AS bronze_rows FROM supplier""")
def rejected_document_fails_check(spark, sf):
    """One nation's document lacks a field: its records are left out, counted, and the check of the run fails."""
    root = new_folder(spark, "rejected")
    fields = [f for f, _, _ in CONTRACT]
    short = f'{{"fieldName":"{fields[0]}"}},'
    docs = _supplier_documents(spark, sf, "one", F.col("s_nationkey") != 3).unionByName(
        _supplier_documents(spark, sf, "short", F.col("s_nationkey") == 3).select(
            F.replace("raw_data", F.lit(short), F.lit("")).alias("raw_data")))
    _write_files(docs, f"{root}/in")
    cfg = run.Config(in_dir=f"{root}/in", root=root)
    outcome = run.refresh(spark, cfg)
    lost = run.load(spark, cfg, "metric_history").where(F.col("METRIC_NAME") == quality.LANDING).agg(
        F.sum("VALUE").cast("double").alias("lost"))
    return lost.select(F.lit(outcome["check"]).alias("check_status"), "lost", F.lit(run.load(spark, cfg, "bronze").count()).cast("long").alias("bronze_rows"))


_HEALTH = f"""SELECT CAST(0 AS BIGINT) AS raw_variant, b AS bronze_parsed, v AS bronze_distinct_vins, s AS silver, q AS quarantine, f AS gold_fact,
  s + q AS silver_plus_quarantine, CASE WHEN v + u = s + q AND s = f THEN '{health.PASS_TEXT}' ELSE '{health.INVESTIGATE_TEXT}' END AS reconciliation_status
FROM (SELECT (SELECT count(*) FROM bronze) AS b, (SELECT count(DISTINCT VIN) FROM bronze) AS v, (SELECT count(*) FROM bronze WHERE VIN IS NULL) AS u,
  (SELECT count(*) FROM silver){{silver}} AS s, (SELECT count(*) FROM quarantine) AS q, (SELECT count(*) FROM fact){{fact}} AS f)"""


@query(over_feed(_HEALTH.format(silver="", fact=""), strict=True))
def written_layer_health(spark, sf):
    """Counts per layer as observed by the jobs that wrote them, after two waves."""
    return run.written_health(spark, _in_waves(spark, sf, "written-health", "strict"))


@query(over_feed(_HEALTH.format(silver=" - 1", fact=" - 1"), strict=True))
def row_lost_from_silver(spark, sf):
    """A bucket of silver is written without one of its rows, gold follows: health says so."""
    cfg = _in_waves(spark, sf, "lost-row", "strict")
    at = store.published(spark, cfg.root)["silver"]
    bucket = next(b for b, e in sorted(at.by_bucket.items()) if e.counts.get(b))
    rows = store.load(spark, cfg.root, "silver", at, buckets=[bucket], keep_bucket=True)
    least = rows.agg(F.min("VIN")).first()[0]
    now = run.utc_now()
    batch = store.begin(spark, cfg.root, "silver", ["silver"], now)
    entry = store.write(rows.where(F.col("VIN") != least), cfg.root, "silver", batch, buckets=[bucket], whole=False)
    run.publish(spark, cfg, "silver", [entry], now)
    run.refresh(spark, cfg, only=["gold"])
    return run.written_health(spark, cfg)


def _written_metrics(spark, sf, mode: str = "reference") -> DataFrame:
    cfg = _in_waves(spark, sf, "written-metrics", mode)
    layers = run.load_all(spark, cfg, ["bronze", "silver", "quarantine"]).values()
    return _amounts(quality.evaluate_metrics(*layers, _moment(), strict=mode == "strict"))


@query(over_feed(_metrics_sql("(SELECT count(DISTINCT VIN) FROM bronze)")))
def written_metrics(spark, sf):
    """The six measurements over written layers, one pass over each."""
    return _written_metrics(spark, sf)


@query(over_feed(_metrics_sql("(SELECT count(DISTINCT VIN) + count(*) FILTER (VIN IS NULL) FROM bronze)"), strict=True))
def written_metrics_strict(spark, sf):
    return _written_metrics(spark, sf, "strict")


@query(over_feed("SELECT (SELECT count(DISTINCT VIN) FROM bronze) - (SELECT count(*) FROM silver) - (SELECT count(*) FROM quarantine) AS VALUE"))
def written_reconciliation(spark, sf):
    layers = run.load_all(spark, _in_waves(spark, sf, "written-reconciliation"), ["bronze", "silver", "quarantine"])
    return quality.reconciliation_metric(*layers.values())


@query("SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS ordered FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def small_top_rows(spark, sf):
    """A top-k brought to the driver for display, by way of the sink that refuses more than it is told to take."""
    top = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("ordered"))
    shown = small_result(top_k(top, 20, F.col("o_totalprice").desc(), F.col("o_orderkey").asc()), max_rows=20)
    return spark.createDataFrame(shown, top.schema)


# Distinct counts, hot places, drill-across and drift

def _bitmaps(spark, sf, label: str, by: list[str]) -> str:
    """Three runs, each with a part of the rows; most vehicles are in several."""
    root, rows = new_folder(spark, label), bronze(spark, sf)
    for wave in range(3):
        mine = rows.where(F.col("RECORD_POSITION") % 10 % 3 == wave)
        distinct.add_distinct(spark, root, mine, "VIN", by, run.utc_now())
    return root


@query(over_feed("SELECT MAKE, STATE, count(DISTINCT VIN) AS vehicles FROM bronze WHERE VIN IS NOT NULL GROUP BY 1, 2"))
def distinct_vins_by_make(spark, sf):
    """Exact distinct vehicles per make and state, merged from the bitmaps of three runs."""
    return distinct.distinct_kept(spark, _bitmaps(spark, sf, "bitmaps", ["MAKE", "STATE"]), ["MAKE", "STATE"], "vehicles")


@query(over_feed("SELECT count(DISTINCT VIN) AS vehicles FROM bronze"))
def distinct_vins_over_runs(spark, sf):
    """The same bitmaps rolled up: vehicles are not counted twice for having changed their make."""
    return distinct.distinct_in_all(spark, _bitmaps(spark, sf, "rolled-up", ["MAKE"]), "vehicles")


@query(over_feed(_SHARED.format(geo="geo_by_key")))
def shared_view_hot_places(spark, sf):
    """The flat view where frequent places were observed as the fact was written: the fact is read once."""
    layers, root = Layers(spark, sf, grain="key", stored=True), new_folder(spark, "hot-places")
    batch = store.begin(spark, root, "gold", ["fact"], run.utc_now())
    entry = store.write(layers.fact(), root, "fact", batch, measures={"hot": hot_keys("GEO_KEY")})
    fact = store.load(spark, root, "fact", store.Table([entry], [entry]))
    return _amounts(gold.shared_registrations(fact, layers.dim_vehicle(), layers.dim_geography(), hot=entry.facts["hot"]))


@query(over_feed("""SELECT EV_TYPE, CAST(y.n AS BIGINT) AS agg_by_year_total_registrations, latest_cumulative, CAST(c.n AS BIGINT) AS agg_by_county_total_registrations,
  registration_count, total_applications
FROM (SELECT EV_TYPE, sum(REGISTRATION_COUNT) AS n, max(CUMULATIVE_COUNT) AS latest_cumulative FROM by_year GROUP BY 1) y
FULL JOIN (SELECT EV_TYPE, sum(REGISTRATION_COUNT) AS n FROM by_county GROUP BY 1) c USING (EV_TYPE)
FULL JOIN (SELECT EV_TYPE, count(*) AS registration_count FROM silver GROUP BY 1) f USING (EV_TYPE)
FULL JOIN (SELECT EV_TYPE, count(*) AS total_applications FROM silver JOIN apps ON silver.VIN = apps.vin GROUP BY 1) a USING (EV_TYPE)"""))
def measures_across_grains(spark, sf):
    """Year, county, registration and application measures in one answer, each table at its own grain."""
    tables = Layers(spark, sf, grain="key", stored=True).tables(
        "agg_by_year", "agg_by_county", "fact_registrations", "dim_vehicle", "dim_geography", "incentive_applications")
    return drill_across(tables, [
        "agg_by_year.total_registrations", "latest_cumulative", "agg_by_county.total_registrations", "registration_count"], ["EV_TYPE"]).join(
        drill_across(tables, ["registration_count", "total_applications"], ["EV_TYPE"]).select("EV_TYPE", "total_applications"), "EV_TYPE", "left")


@query(over_feed("""SELECT coalesce(y.d, m.d, s.d) AS MODEL_YEAR, CAST(y.n AS BIGINT) AS agg_by_year_total_registrations, registration_count, avg_electric_range
FROM (SELECT MODEL_YEAR AS d, sum(REGISTRATION_COUNT) AS n FROM by_year GROUP BY 1) y
FULL JOIN (SELECT MODEL_YEAR AS d, count(*) AS registration_count, avg(ELECTRIC_RANGE) AS avg_electric_range FROM silver GROUP BY 1) s ON y.d IS NOT DISTINCT FROM s.d
LEFT JOIN (SELECT NULL::INTEGER AS d) m ON false"""))
def year_measures_across_grains(spark, sf):
    """By a dimension with a null: its group is matched like any other."""
    tables = Layers(spark, sf, grain="key", stored=True).tables("agg_by_year", "fact_registrations", "dim_vehicle", "dim_geography")
    found = drill_across(tables, ["agg_by_year.total_registrations", "registration_count", "avg_electric_range"], ["MODEL_YEAR"])
    return found.withColumnRenamed("total_registrations", "agg_by_year_total_registrations")


_LINES = """SELECT '{0}' AS field, {1} AS in_contract, (SELECT count(*) FROM documents WHERE text IS NOT NULL) - {2} AS documents, {2} AS lacking,
  (SELECT coalesce(sum(len(string_split(text, chr(10)))), 0)::BIGINT FROM documents WHERE {3}) AS cells,
  (SELECT coalesce(sum(len(string_split(text, chr(10)))), 0)::BIGINT FROM documents WHERE {3}{4}) AS filled, 'STRING' AS cell_type"""
_NOT_FR, _FR = "(SELECT count(*) FROM documents WHERE lang = 'fr')", "(SELECT count(*) FROM documents WHERE lang <> 'fr')"


@query(" UNION ALL ".join(_LINES.format(*row) for row in (
    ("line_no", True, "0::BIGINT", "true", ""), ("line", True, "0::BIGINT", "true", ""), ("source", True, "0::BIGINT", "true", ""),
    (":sid", False, _NOT_FR, "lang <> 'fr'", ""), (":x", False, _FR, "lang = 'fr'", ""))))
def header_drift(spark, sf):
    """Per field: documents that have it and lack it, cells and their type; two headers in different order."""
    return documents.field_report(text_documents(spark, sf), LINE_CONTRACT)
