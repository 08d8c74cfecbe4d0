"""A full run: ingest, parse, silver and quarantine, gold, metrics, check. Each step is logged.

Every step does the work of what has changed. Bronze parses the documents that no run has parsed. The latest rows per
vehicle, silver, quarantine, the fact and the vehicles lie in buckets by VIN, and only buckets with new rows or changed
applications are written anew; changed lookups write all. Aggregates and geography follow from signed cells: what came to
silver less what went. A step publishes its tables together when all are whole (``store``), so a run that breaks off leaves
the tables of the one before, and the next run takes up what it left undone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from math import gcd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platework.plans import gold, health, quality, silver, store
from platework.schemas import INCENTIVE_APPLICATIONS, STATE_GOALS, ZIP_DEMOGRAPHICS
from platework.session import stored_bytes
from platework.sources import documents, tables
from platework.streaming.ingest import ingest_new, landed, landed_with_rejects

STEPS = ["ingest", "bronze", "silver", "gold", "metrics", "check"]
LOGS = ["metric_history", "run_log"]
GOLD = ["dim_vehicle", "dim_geography", "fact_registrations", "agg_by_county", "agg_by_year"]
#: Folders of signed cells after which they are added up and written together.
COMPACT_EVERY = 50
#: Buckets that a task writes at most as it has them after the shuffle by VIN.
FEW_BUCKETS = 8
#: Bytes of a table for each partition of its shuffle, under which the partitions count as small.
SMALL_PARTITION = 1 << 20


@dataclass(frozen=True)
class Config:
    """Folders of a run. Tables lie under ``root``; without paths the built-in lookups are used.

    ``on_error`` is for files that are no JSON, ``on_missing`` for headers that lack a field ("reject"
    leaves such documents out and on record, "abort" fails until they are gone, "null" fills in);
    With a lag, a layer that was written less than so many minutes ago is left as it is.
    ``bronze_partitions`` spreads the records of a few large files, each of which is read by one task. ``buckets`` is the
    number of parts by VIN that silver is rewritten in: at least one per few GB. It should divide, or be divided by, the
    number of shuffle partitions, or for large tables have an eighth of it or more as common divisor with it, else rows are
    shuffled once more. ``before_publish`` is called with a step's name when its tables are whole and not yet visible; an
    exception leaves them so.
    """

    in_dir: str
    root: str
    applications: str | None = None
    zips_csv: str | None = None
    goals_csv: str | None = None
    mode: str = "reference"
    geography_grain: str = "key"
    on_error: str = "continue"
    on_missing: str = "reject"
    gold_format: str = "parquet"
    bronze_partitions: int | None = None
    silver_lag_minutes: int | None = None
    gold_lag_minutes: int | None = None
    buckets: int = 32
    before_publish: Callable[[str], None] | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def publish(spark: SparkSession, cfg: Config, step: str, entries: list[store.Entry], now: datetime) -> None:
    if cfg.before_publish is not None:
        cfg.before_publish(step)
    store.publish(spark, cfg.root, entries, now)


def load(spark: SparkSession, cfg: Config, name: str, at: dict[str, store.Table] | None = None) -> DataFrame:
    """A table as it is now, or as of ``at``; one that no run has written lies under its name."""
    if name == "raw":
        return landed(spark, cfg.path("raw"))
    if name == "zip_demographics":
        if cfg.zips_csv:
            return tables.load_reference(spark, cfg.zips_csv, ZIP_DEMOGRAPHICS)
        return tables.zip_demographics(spark)
    if name == "state_goals":
        if cfg.goals_csv:
            return tables.load_reference(spark, cfg.goals_csv, STATE_GOALS)
        return tables.state_goals(spark)
    if name == "incentive_applications":
        if cfg.applications:
            return tables.read_table(spark, cfg.applications)
        return spark.createDataFrame([], INCENTIVE_APPLICATIONS)
    fmt = cfg.gold_format if name in GOLD else "parquet"
    if name in LOGS:
        return tables.read_table(spark, cfg.path(name), fmt)
    at = store.published(spark, cfg.root) if at is None else at
    if name not in at:
        return tables.read_table(spark, cfg.path(name), fmt)
    return store.load(spark, cfg.root, name, at[name], fmt)


def load_all(spark: SparkSession, cfg: Config, names: list[str] | None = None) -> dict[str, DataFrame]:
    """All tables, or those named, as of one moment."""
    at = store.published(spark, cfg.root)
    names = names or ["raw", "bronze", "silver", "quarantine", *GOLD, "incentive_applications", "zip_demographics", "state_goals"]
    return {name: load(spark, cfg, name, at) for name in names}


def _ingest(spark: SparkSession, cfg: Config, now: datetime) -> None:
    ingest_new(spark, cfg.in_dir, cfg.path("raw"), cfg.path("raw_checkpoint"), cfg.on_error)


def _bronze_marks(cfg: Config) -> dict:
    """What silver needs to know of rows that are added to bronze: which buckets they touch, and rows without a VIN."""
    return {"touches": store.per_bucket(store.bucket_of("VIN", cfg.buckets), cfg.buckets),
            "unkeyed": F.count_if(F.col("VIN").isNull())}


def append_bronze(spark: SparkSession, cfg: Config, rows: DataFrame, now: datetime | None = None) -> None:
    """Add rows that come from elsewhere than documents."""
    now = now or utc_now()
    batch = store.begin(spark, cfg.root, "bronze", ["bronze"], now)
    entry = store.write(rows, cfg.root, "bronze", batch, adds=True, measures=_bronze_marks(cfg), facts={"buckets": cfg.buckets})
    publish(spark, cfg, "bronze", [entry], now)


def _bronze(spark: SparkSession, cfg: Config, now: datetime) -> None:
    """Parse the documents that no earlier run has parsed, and add their rows to bronze. Documents are decoded once; how
    many records they hold, and how many of them cannot be parsed, is counted on the way."""
    at, raw = store.published(spark, cfg.root), landed_with_rejects(spark, cfg.path("raw"))
    if "parsed_documents" in at:
        raw = raw.join(load(spark, cfg, "parsed_documents", at), "source_file", "left_anti")
        if raw.isEmpty():
            return
    names = ["parsed_documents", "bronze", "document_faults", "rejected_records"]
    batch = store.begin(spark, cfg.root, "bronze", names, now)
    # A document that is left out costs its records; one whose records cannot be counted costs one.
    left_out = ~F.col("accepted") | F.col("data").isNull()
    held = F.when(F.col("data").isNotNull(), F.size("data")).otherwise(F.lit(0))
    decoded = store.write(documents.decoded_documents(raw), cfg.root, "decoded", batch, measures={
        "records": F.coalesce(F.sum(held.cast("long")), F.lit(0)),
        "uncounted": F.count_if(left_out)})
    docs = store.load(spark, cfg.root, "decoded", store.Table([decoded], [decoded]))

    def write(name: str, rows: DataFrame, **more) -> store.Entry:
        return store.write(rows, cfg.root, name, batch, adds=True, **more)

    rows = documents.document_rows(
        docs.where("accepted"), on_missing=cfg.on_missing, load_ts=F.lit(now), partitions=cfg.bronze_partitions)
    bronze = write("bronze", rows, measures=_bronze_marks(cfg), facts={"buckets": cfg.buckets})
    written = [
        write("parsed_documents", docs.select("source_file")), bronze,
        write("document_faults", docs.where("fault is not null").select("source_file", "loaded_at", F.col("fault").alias("reason"))),
        write("rejected_records", documents.records_without_cells(docs.where("accepted"))),
    ]
    lost = decoded.facts["records"] - bronze.rows + decoded.facts["uncounted"]
    publish(spark, cfg, "bronze", written, now)
    tables.append_table(quality.landing_entry(spark, lost, F.lit(now)), cfg.path("metric_history"))


def _marks(df: DataFrame, bucket=None) -> dict[str, str]:
    """A sum of row hashes, by bucket: equal as long as the rows are. At most a row per bucket."""
    bucket = F.lit(0) if bucket is None else bucket
    sums = df.groupBy(bucket.alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")).alias("h"))
    return {str(r["b"]): f"{r['n']}:{r['h']}" for r in sums.collect()}


def _silver(spark: SparkSession, cfg: Config, now: datetime) -> None:
    """Bring the latest rows, silver and quarantine up to date, in the buckets that have changed."""
    at = store.published(spark, cfg.root)
    inputs = {n: load(spark, cfg, n, at) for n in ("zip_demographics", "state_goals", "incentive_applications")}
    applications = inputs["incentive_applications"]
    strict = cfg.mode == "strict"
    bronze = at.get("bronze")  # else bronze was written by other means
    facts = {
        "mode": cfg.mode, "buckets": cfg.buckets, "lookups": [_marks(inputs[n]) for n in ("zip_demographics", "state_goals")],
        "applications": _marks(applications, store.bucket_of("vin", cfg.buckets)),
        "bronze_batch": bronze.batch if bronze else None}
    before = at["latest"].last.facts if "latest" in at else None
    fresh = bronze is None or before is None or any(
        before[k] != facts[k] for k in ("mode", "buckets", "lookups")) or before["bronze_batch"] is None
    if fresh:
        new, touched, unkeyed = load(spark, cfg, "bronze", at), list(range(cfg.buckets)), strict
    else:
        came = [e for e in bronze.plain if e.batch > before["bronze_batch"]]
        known, now_known = before["applications"], facts["applications"]
        touched = {int(b) for b in known.keys() | now_known.keys() if known.get(b) != now_known.get(b)}
        touched |= {b for e in came for b in e.facts["touches"]} if all(
            e.facts["buckets"] == cfg.buckets for e in came) else set(range(cfg.buckets))
        if not touched:
            return
        touched, unkeyed = sorted(touched), strict and any(e.facts["unkeyed"] for e in came)
        new = store.load(spark, cfg.root, "bronze", bronze, since=before["bronze_batch"])
    batch = store.begin(spark, cfg.root, "silver", ["latest", "silver", "quarantine"], now)

    def write(name: str, rows: DataFrame, **more) -> store.Entry:
        return store.write(rows, cfg.root, name, batch, buckets=touched, whole=fresh, **more)

    rows = new
    if not fresh:
        rows = store.load(spark, cfg.root, "latest", at["latest"], buckets=touched).select(*new.columns).unionByName(new)
    state = silver.latest_state(rows, applications, cfg.mode).withColumn(store.BUCKET, store.bucket_of("VIN", cfg.buckets))
    latest = write("latest", _by_bucket(spark, state, cfg.buckets, stored_bytes(spark, cfg.path("bronze"))), facts=facts, measures={
        "unkeyed": F.count_if(F.col("VIN").isNull())})
    state = store.load(spark, cfg.root, "latest", _only(latest), keep_bucket=True)
    written = [
        latest,
        write("silver", silver.silver_of(state, inputs["zip_demographics"], inputs["state_goals"], True, store.BUCKET)),
        write("quarantine", silver.quarantine_of(state, store.BUCKET)),
    ]
    if unkeyed:
        rejects = silver.unkeyed_rejects(new).withColumn(store.BUCKET, F.lit(store.UNKEYED))
        written.append(store.write(rejects, cfg.root, "quarantine", batch, adds=True, buckets=[store.UNKEYED]))
    publish(spark, cfg, "silver", written, now)


def _only(entry: store.Entry) -> store.Table:
    """What one entry holds, published or not."""
    found = store.Table()
    found.apply(entry)
    return found


def _by_bucket(spark: SparkSession, df: DataFrame, buckets: int, size: int) -> DataFrame:
    """Rows that lie by VIN after a shuffle, so that each task has few buckets. A partition of that shuffle has one bucket
    in every gcd(partitions, buckets), so that rows made of a table of many bytes (``size``) are not shuffled again unless
    that leaves it too many; small partitions are put together in execution, and would write many small files."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    apart = gcd(parts, buckets)
    few = apart == min(parts, buckets) or (buckets // apart <= FEW_BUCKETS and size >= parts * SMALL_PARTITION)
    return df if few else df.repartition(store.BUCKET)


def _gold(spark: SparkSession, cfg: Config, now: datetime) -> None:
    """Bring the star and the aggregates up to date from what came to silver, and went from it, since the last time."""
    at = store.published(spark, cfg.root)
    clean = at.get("silver")  # else silver was written by other means
    cells = at.get("cells")
    through = cells.last.facts["silver_batch"] if cells else None
    fresh = clean is None or through is None or cells.last.facts["grain"] != cfg.geography_grain or any(
        e.whole for e in clean.entries if e.batch > through)
    if clean is None:
        came = load(spark, cfg, "silver", at).withColumn(store.BUCKET, store.bucket_of("VIN", cfg.buckets))
        went, touched = None, list(range(cfg.buckets))
    elif fresh:
        touched = sorted(clean.by_bucket)
        came, went = store.load(spark, cfg.root, "silver", clean, keep_bucket=True), None
    else:
        touched = sorted({b for e in clean.entries if e.batch > through for b in e.buckets})
        if not touched:
            return
        came = store.load(spark, cfg.root, "silver", clean, buckets=touched, keep_bucket=True)
        went = store.load(spark, cfg.root, "silver", store.published(spark, cfg.root, through)["silver"], buckets=touched)
    batch = store.begin(spark, cfg.root, "gold", ["cells", *GOLD], now)

    def write(name: str, rows: DataFrame, **more) -> store.Entry:
        return store.write(rows, cfg.root, name, batch, fmt=cfg.gold_format, **more)

    def in_buckets(name: str, rows: DataFrame) -> store.Entry:
        return write(name, rows, buckets=touched, whole=fresh)

    facts = {"silver_batch": clean.batch if clean else None, "grain": cfg.geography_grain}
    delta = gold.signed_cells(came, went)
    if not fresh and len(cells.plain) >= COMPACT_EVERY:
        delta, known = gold.merged_cells(store.load(spark, cfg.root, "cells", cells).unionByName(delta)), None
    else:
        known = None if fresh else cells
    new = store.write(delta, cfg.root, "cells", batch, adds=known is not None, facts=facts)
    merged = _only(new)
    if known is not None:
        # Added up once for the three tables that are made of them; what is written here is not published.
        merged.plain = [*known.plain, new]
        merged = _only(store.write(
            gold.merged_cells(store.load(spark, cfg.root, "cells", merged)), cfg.root, "merged_cells", batch))
        all_cells = store.load(spark, cfg.root, "merged_cells", merged)
    else:
        all_cells = store.load(spark, cfg.root, "cells", merged)
    written = [
        new, in_buckets("dim_vehicle", gold.dim_vehicle(came, True, store.BUCKET)),
        in_buckets("fact_registrations", gold.fact_registrations(came, store.BUCKET)),
        write("dim_geography", gold.dim_geography(all_cells, cfg.geography_grain)),
        write("agg_by_county", gold.agg_by_county_of(all_cells)),
        write("agg_by_year", gold.agg_by_year_of(all_cells)),
    ]
    publish(spark, cfg, "gold", written, now)


def written_health(spark: SparkSession, cfg: Config) -> DataFrame:
    """``health.layer_health`` of the layers as they were written: by the counts that were observed in the jobs that wrote
    them, each layer by its own. No table is read."""
    at = store.published(spark, cfg.root)
    rows = {n: at[n].rows if n in at else 0 for n in ("parsed_documents", "bronze", "silver", "quarantine", "fact_registrations")}
    # a null VIN has one bucket
    latest, keyless = at["latest"], 42 % cfg.buckets
    unkeyed = latest.by_bucket[keyless].facts["unkeyed"] if keyless in latest.by_bucket else 0
    lost = at["bronze"].fact("unkeyed") if "bronze" in at and cfg.mode == "strict" else 0
    return health.written_health(
        spark, rows["parsed_documents"], rows["bronze"], latest.rows - unkeyed, rows["silver"], rows["quarantine"],
        rows["fact_registrations"], lost)


def _metrics(spark: SparkSession, cfg: Config, now: datetime) -> None:
    layers = load_all(spark, cfg, ["bronze", "silver", "quarantine"]).values()
    measured = quality.evaluate_metrics(*layers, F.lit(now), strict=cfg.mode == "strict")
    tables.append_table(measured, cfg.path("metric_history"))


def _check(spark: SparkSession, cfg: Config, now: datetime) -> tuple[str, int, str | None]:
    history = tables.read_table(spark, cfg.path("metric_history"))
    # A measurement of this very run counts as recent, whatever the clock's resolution.
    found = quality.check_breaches(history, F.lit(now)).first()
    return found["run_status"], found["failures"], found["error_message"]


_WORK: dict[str, Callable] = {
    "ingest": _ingest, "bronze": _bronze, "silver": _silver, "gold": _gold, "metrics": _metrics, "check": _check,
}
_WRITES = {"ingest": "raw", "bronze": "bronze", "silver": "silver", "gold": "fact_registrations"}


def _rows(spark: SparkSession, cfg: Config, name: str) -> int:
    known = store.published(spark, cfg.root).get(name)
    return load(spark, cfg, name).count() if known is None else known.rows


def refresh(spark: SparkSession, cfg: Config, only: list[str] | None = None) -> dict[str, str]:
    """Run the steps, or those named in ``only``, in dependency order; returns each step's status.

    A step that fails is logged and raised. The check never stops a run: its finding is its status. A layer within
    its lag is FRESH and left alone.
    """
    unknown = set(only or []) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown step(s) {sorted(unknown)}; known are {STEPS}")
    log = cfg.path("run_log")
    outcome = {}
    for step in [s for s in STEPS if only is None or s in only]:
        now = utc_now()
        lag = {"silver": cfg.silver_lag_minutes, "gold": cfg.gold_lag_minutes}.get(step)
        if lag is not None:
            mine = store.published(spark, cfg.root).get(_WRITES[step])
            if mine is not None and not health.is_stale(
                    spark.createDataFrame([(mine.last.written_at,)], "written_at timestamp"), "written_at", F.lit(now), lag):
                outcome[step] = "FRESH"
                continue
        try:
            result = _WORK[step](spark, cfg, now)
        except Exception as error:
            quality.log_run(spark, log, step, "FAILURE", None, f"{type(error).__name__}: {error}", utc_now())
            raise
        if result is None:
            rows = _rows(spark, cfg, _WRITES[step]) if step in _WRITES else None
            result = ("SUCCESS", rows, None)
        quality.log_run(spark, log, step, *result, utc_now())
        outcome[step] = result[0]
    return outcome
