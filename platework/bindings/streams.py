"""File ingest, change feeds and full refreshes on the driver's tables.

These write to a new folder under the session's shared folder and return what they leave there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platework.bindings.feed import SCHEMAS, _document, _header, applications, bronze, table
from platework.bindings.feed_sql import over_feed
from platework.bindings.registrations import _COUNTED, _SILVER, _SQL_NAMES, _amounts
from platework.bindings.registry import query
from platework.plans import health, quality, run
from platework.plans.silver import build_silver
from platework.schemas import BEV, CONTRACT
from platework.session import new_folder
from platework.sources import documents, ranges
from platework.sources.tables import state_goals, write_table, zip_demographics
from platework.streaming.ingest import ingest_new, landed, landing_rejects
from platework.streaming.upserts import Keyed, append_changes, compact, current_state, follow_changes


def _stream(spark, sf, name: str) -> DataFrame:
    # A pattern, since the table may be one file and a stream's plain path must be a folder.
    return spark.readStream.schema(SCHEMAS[name]).parquet(f"{sf}/{{{name}}}.parquet")


def _write_files(texts: DataFrame, folder: str) -> None:
    """One file per row."""
    texts.select("raw_data").write.mode("append").option("maxRecordsPerFile", 1).text(folder)


def _item_documents(spark, sf) -> DataFrame:
    """A document per benchmark passage, a record per line."""
    lines = F.transform(F.split("text", "\n"), lambda line, i: F.array(i.cast("string"), line))
    name = F.concat(F.lit("item "), F.col("item_id").cast("string"))
    return table(spark, sf, "benchmark").select(_document(name, _header(["line_no", "line"]), lines).alias("raw_data"))


def _nation_documents(spark, sf) -> DataFrame:
    record = F.array(F.array(F.col("n_nationkey").cast("string"), F.col("n_name")))
    return table(spark, sf, "nation").select(_document(F.col("n_name"), _header(["key", "name"]), record).alias("raw_data"))


_ITEMS = "SELECT 'item ' || item_id AS dataset_name, CAST(len(string_split(text, chr(10))) AS INTEGER) AS record_count FROM benchmark"


@query(_ITEMS)
def landed_files(spark, sf):
    """Whole files, one landed row each."""
    folder = new_folder(spark, "files")
    _write_files(_item_documents(spark, sf), folder)
    profiles = documents.profile_documents(documents.land_documents(spark, folder))
    return profiles.where(F.col("source_file").contains(folder.rsplit("/", 1)[-1])).select("dataset_name", "record_count")


@query(_ITEMS + " UNION ALL SELECT n_name, 1 FROM nation")
def files_loaded_once(spark, sf):
    """Two waves of files and a run after each: a file that was loaded is not loaded again."""
    root = new_folder(spark, "load-once")
    inbox, out, checkpoint = f"{root}/in", f"{root}/raw", f"{root}/checkpoint"
    _write_files(_item_documents(spark, sf), inbox)
    ingest_new(spark, inbox, out, checkpoint)
    ingest_new(spark, inbox, out, checkpoint)
    _write_files(_nation_documents(spark, sf), inbox)
    ingest_new(spark, inbox, out, checkpoint)
    return documents.profile_documents(landed(spark, out)).select("dataset_name", "record_count")


def _made_days_ago(spark, folder: str, days: int, names: DataFrame) -> None:
    """Give the files of the folder that are not among ``names`` an earlier time, as a copy that keeps times does."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    known = {r[0].rsplit("/", 1)[-1] for r in names.collect()}
    for status in system.listStatus(path):
        if status.getPath().getName() not in known:
            system.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


@query(_ITEMS + " UNION ALL SELECT n_name, 1 FROM nation")
def files_with_old_times(spark, sf):
    """The second wave's files are older than the first's by a month; they are loaded all the same."""
    root = new_folder(spark, "old-times")
    inbox, out, checkpoint = f"{root}/in", f"{root}/raw", f"{root}/checkpoint"
    _write_files(_item_documents(spark, sf), inbox)
    ingest_new(spark, inbox, out, checkpoint)
    first = spark.read.text(inbox, wholetext=True).select(F.col("_metadata.file_path")).distinct()
    _write_files(_nation_documents(spark, sf), inbox)
    _made_days_ago(spark, inbox, 30, first)
    ingest_new(spark, inbox, out, checkpoint)
    return documents.profile_documents(landed(spark, out)).select("dataset_name", "record_count")


def _events_with_bad_records(spark, sf) -> DataFrame:
    """Clicks hold three records that are no arrays; errors have text after the root, sign-ups no array of records."""
    kind, key = F.col("event_type"), F.col("event_id").cast("string")
    record = F.concat(F.lit('["'), key, F.lit('","'), kind, F.lit('"]'))
    records = F.when(kind == "click", F.concat(record, F.lit(',"oops",{"a":[1]},null'))).otherwise(record)
    data = F.when(kind == "signup", F.lit('{"a":1}')).otherwise(F.concat(F.lit("["), records, F.lit("]")))
    head = '{"meta":{"view":{"name":"e","columns":[{"fieldName":"event_id"},{"fieldName":"event_type"}]}},"data":'
    text = F.concat(F.lit(head), data, F.when(kind == "error", F.lit("} {}")).otherwise(F.lit("}")))
    return table(spark, sf, "events").select(
        text.alias("raw_data"), F.col("ts").alias("loaded_at"), F.concat(F.lit("e"), key).alias("source_file"))


@query("""SELECT 'rows' AS outcome, count(*) AS n FROM events WHERE event_type NOT IN ('signup', 'error')
UNION ALL SELECT 'rows without values', 3 * count(*) FROM events WHERE event_type = 'click'
UNION ALL SELECT 'rejected records', 3 * count(*) FROM events WHERE event_type = 'click'
UNION ALL SELECT 'has no array of records', count(*) FROM events WHERE event_type = 'signup'
UNION ALL SELECT 'not a JSON document', count(*) FROM events WHERE event_type = 'error'""")
def parsed_past_bad_records(spark, sf):
    """A record that is no array costs only itself, a faulty document only itself; all are on record."""
    raw = _events_with_bad_records(spark, sf)
    contract = [("event_id", "EVENT_ID", "bigint"), ("event_type", "EVENT_TYPE", "string")]
    rows = documents.parse_documents(documents.accept_documents(raw, "continue"), contract, on_missing="reject")
    outcome = F.when(F.col("EVENT_ID").isNull(), F.lit("rows without values")).otherwise(F.lit("rows"))
    counted = rows.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    faults = documents.document_faults(raw, contract).groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    bad = documents.rejected_records(documents.accept_documents(raw, "continue"))
    return counted.unionByName(faults).unionByName(
        bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rejected records").alias("outcome"), "n"))


def _documents_of_lines(spark, sf, folder: str) -> None:
    """A file per 5,000 order keys, which is one document with a record per line item."""
    items = table(spark, sf, "lineitem").select(
        F.floor(F.col("l_orderkey") / 5000).alias("part"), F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("line"),
        F.concat(F.lit("]["), F.col("l_returnflag"), F.lit('"')).alias("flag"))
    order = Window.partitionBy("part").orderBy("key", "line", "flag")
    record = F.to_json(F.array(*[F.col(c).cast("string") for c in ("key", "line", "flag")]))
    comma = F.when(F.row_number().over(order) == 1, F.lit("")).otherwise(F.lit(","))
    text = F.concat(comma, record)
    names = F.to_json(_header(["key", "line", "flag"]))
    head = F.concat(F.lit('{"meta":{"view":{"name":"lines","columns":'), names, F.lit('}},"data":['))
    parts = items.select("part").distinct()
    rows = items.select("part", F.lit(1).alias("at"), "key", "line", "flag", text.alias("value")).unionByName(
        parts.select("part", F.lit(0).alias("at"), head.alias("value")), allowMissingColumns=True).unionByName(
        parts.select("part", F.lit(2).alias("at"), F.lit("]}").alias("value")), allowMissingColumns=True)
    rows = rows.repartition("part").sortWithinPartitions("part", "at", "key", "line", "flag")
    rows.select("part", "value").write.partitionBy("part").text(folder)


_LINES_SQL = """SELECT l_orderkey AS ORDERKEY, l_linenumber AS LINE, '][' || l_returnflag || '"' AS FLAG, row_number() OVER (
PARTITION BY l_orderkey // 5000 ORDER BY l_orderkey, l_linenumber, l_returnflag) - 1 AS POSITION FROM lineitem"""
_LINES = [("key", "ORDERKEY", "bigint"), ("line", "LINE", "int"), ("flag", "FLAG", "string")]


@query(_LINES_SQL)
def records_by_ranges(spark, sf):
    """Files of many records, each read by several tasks and cut at the ends of records."""
    folder = new_folder(spark, "documents-of-lines")
    _documents_of_lines(spark, sf, folder)
    docs, records = ranges.split_documents(spark, folder, _LINES, range_bytes=1 << 17)
    rows = ranges.parse_split(docs, records, _LINES)
    return rows.select("ORDERKEY", "LINE", "FLAG", F.col("RECORD_POSITION").alias("POSITION"))


@query("SELECT '[\"key\",\"line\",\"flag\"]' AS names, count(*) AS records FROM lineitem GROUP BY l_orderkey // 5000")
def documents_by_ranges(spark, sf):
    """Header and number of records of each file, cut in many ranges."""
    folder = new_folder(spark, "documents-of-lines")
    _documents_of_lines(spark, sf, folder)
    docs, _ = ranges.split_documents(spark, folder, _LINES, range_bytes=1 << 17)
    return docs.where("fault IS NULL").select(F.to_json("names").alias("names"), "records")


@query("""SELECT 'accepted' AS outcome, count(*) AS files FROM nation WHERE n_regionkey <> 2
UNION ALL SELECT 'rejected', count(*) FROM nation WHERE n_regionkey = 2""")
def files_loaded_past_errors(spark, sf):
    """Unreadable files are put on record and the rest is loaded."""
    root = new_folder(spark, "load-past-errors")
    cut = F.when(F.col("n_regionkey") == 2, F.lit("{cut off")).otherwise(F.col("raw_data")).alias("raw_data")
    nations = table(spark, sf, "nation")
    record = F.array(F.array(F.col("n_nationkey").cast("string"), F.col("n_name")))
    packed = nations.select("n_regionkey", _document(F.col("n_name"), _header(["key", "name"]), record).alias("raw_data"))
    _write_files(packed.select(cut), f"{root}/in")
    ingest_new(spark, f"{root}/in", f"{root}/raw", f"{root}/checkpoint", on_error="continue")
    return health.row_counts({
        "accepted": landed(spark, f"{root}/raw"), "rejected": landing_rejects(spark, f"{root}/raw"),
    }).withColumnsRenamed({"table_name": "outcome", "row_count": "files"})


@query("""SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1 AND o_orderstatus <> 'P'""")
def change_feed_followed(spark, sf):
    """Orders as a stream of changes by customer, with a compaction between two runs; 'P' deletes."""
    root = new_folder(spark, "changes")
    changes = _stream(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    followed = Keyed(f"{root}/table", ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "P")
    follow_changes(changes, followed, f"{root}/checkpoint")
    compact(spark, followed)
    follow_changes(changes, followed, f"{root}/checkpoint")
    return current_state(spark, followed)


@query("""SELECT o_custkey, b, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY b DESC) AS rn FROM (
    SELECT o_custkey, o_orderkey % 3 AS b, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2)) WHERE rn = 1""")
def tied_changes_in_batches(spark, sf):
    """Three batches of changes with one and the same sequence: that of the last batch wins."""
    followed = Keyed(f"{new_folder(spark, 'ties')}/table", ["o_custkey"], ["s"])
    orders = table(spark, sf, "orders").groupBy("o_custkey", (F.col("o_orderkey") % 3).alias("b")).agg(
        F.min("o_orderkey").alias("o_orderkey"), F.lit(1).alias("s"))
    for batch in range(3):
        append_changes(orders.where(F.col("b") == batch), batch, followed)
        if batch == 1:
            compact(spark, followed)
    return current_state(spark, followed).drop("s")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 1")
def late_change_after_compaction(spark, sf):
    """A change older than a delete comes in after the compaction: the row stays away."""
    followed = Keyed(f"{new_folder(spark, 'late')}/table", ["c_custkey"], ["s"], F.col("gone"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    known = customers.select("*", F.lit(1).alias("s"), F.lit(False).alias("gone"))
    append_changes(known, 0, followed)
    append_changes(customers.where("c_custkey % 2 = 0").select("*", F.lit(2).alias("s"), F.lit(True).alias("gone")), 1, followed)
    compact(spark, followed)
    append_changes(known, 2, followed)
    return current_state(spark, followed).select("c_custkey", "c_name")


@query(over_feed(f"SELECT {_SILVER} FROM silver"))
def silver_kept_current(spark, sf):
    """Bronze rows as a stream, the latest per vehicle kept from batch to batch, silver built from it."""
    root = new_folder(spark, "current-silver")
    lines = _stream(spark, sf, "lineitem")
    latest = Keyed(f"{root}/latest", ["VIN"], ["LOAD_TS", "SOURCE_FILE", "RECORD_POSITION"])
    follow_changes(bronze(spark, sf, lines), latest, f"{root}/checkpoint")
    return _amounts(build_silver(
        current_state(spark, latest), zip_demographics(spark), state_goals(spark), applications(spark, sf),
        check_lookups=False,
    ))


# A run's geography has one row per key.
_BY_KEY = _SQL_NAMES | {"dim_geography": "geo_by_key"}


@query(over_feed(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {_BY_KEY.get(t, t)}" for t in _COUNTED)
                 + " UNION ALL SELECT 'metric_history', 6"))
def refreshed_layers(spark, sf):
    """Bronze and applications as written tables, then every later step of a run."""
    root = new_folder(spark, "run")
    cfg = run.Config(in_dir=f"{root}/in", root=root, applications=f"{root}/applications")
    write_table(bronze(spark, sf), cfg.path("bronze"))
    write_table(applications(spark, sf), f"{root}/applications")
    run.refresh(spark, cfg, only=["silver", "gold", "metrics", "check"])
    tables = run.load_all(spark, cfg, [*_COUNTED, "metric_history"])
    return health.row_counts(tables)


def _supplier_documents(spark, sf, wave: str, rows) -> DataFrame:
    """A document per nation whose records are its suppliers, as registrations."""
    fields = [field for field, _, _ in CONTRACT]
    cells = {"vin_1_10": F.concat(F.lit("S"), F.col("s_suppkey").cast("string")), "city": F.lit(wave), "state": F.lit("WA"),
             "county": F.col("s_nationkey").cast("string"), "zip_code": F.lit("98101"), "model_year": F.lit("2026"),
             "ev_type": F.when(F.col("s_suppkey") % 7 == 0, F.lit("Steam")).otherwise(F.lit(BEV)), "electric_range": F.lit("100")}
    record = F.array(*[cells.get(f, F.lit("x")).cast("string") for f in fields])
    packed = table(spark, sf, "supplier").where(rows).groupBy("s_nationkey").agg(F.collect_list(record).alias("data"))
    return packed.select(_document(F.lit(wave), _header(fields), F.col("data")).alias("raw_data"))


@query("""SELECT 'S' || s_suppkey AS VIN, CASE WHEN s_nationkey >= 10 THEN 'TWO' ELSE 'ONE' END AS CITY, 'fact' AS layer FROM supplier WHERE s_suppkey % 7 <> 0
UNION ALL SELECT 'S' || s_suppkey, CASE WHEN s_nationkey >= 10 THEN 'two' ELSE 'one' END, 'quarantine' FROM supplier WHERE s_suppkey % 7 = 0""")
def run_in_two_waves(spark, sf):
    """From files to gold twice: the second run parses only what is new, and the layers are those of a full rebuild."""
    root = new_folder(spark, "two-waves")
    cfg = run.Config(in_dir=f"{root}/in", root=root)
    for wave, rows in (("one", F.col("s_nationkey") < 15), ("two", F.col("s_nationkey") >= 10)):
        _write_files(_supplier_documents(spark, sf, wave, rows), f"{root}/in")
        run.refresh(spark, cfg)
    tables = run.load_all(spark, cfg)
    fact = tables["fact_registrations"].select("VIN", "GEO_KEY")
    places = tables["dim_geography"].select(F.col("GEO_KEY").alias("k"), "CITY")
    kept = fact.join(places, F.col("GEO_KEY") == F.col("k")).select("VIN", "CITY", F.lit("fact").alias("layer"))
    return kept.unionByName(tables["quarantine"].select("VIN", "CITY", F.lit("quarantine").alias("layer")))


@query("""SELECT 'orders' AS TASK_NAME, 'SUCCESS' AS RUN_STATUS, count(*) AS ROW_COUNT, CAST(NULL AS VARCHAR) AS ERROR_MESSAGE FROM orders
UNION ALL SELECT 'customer', 'FAILURE', count(*), 'stopped' FROM customer""")
def run_log(spark, sf):
    folder = f"{new_folder(spark, 'log')}/run_log"
    for name, status, error in (("orders", "SUCCESS", None), ("customer", "FAILURE", "stopped")):
        quality.log_run(spark, folder, name, status, table(spark, sf, name).count(), error, run.utc_now())
    return spark.read.parquet(folder).drop("RUN_TIMESTAMP")
