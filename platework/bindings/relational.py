"""Operators one by one on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from platework._columns import latest_first
from platework.bindings.feed import table
from platework.bindings.registry import percent_sql, query
from platework.functions import documents as d
from platework.functions.numbers import guarded_ratio, percent_double, sum_where
from platework.functions.text import bounded, latitude, longitude, surrogate_key, to_double, to_int
from platework.functions.times import days_between, hours_before, minutes_between, seconds_between, wall_clock
from platework.operators.changes import apply_changes
from platework.operators.grouped import count_by, repeated_keys, running_total, top_k, with_growth, with_share
from platework.operators.latest import dedup_latest
from platework.operators.lookups import left_lookup, spread_left_join
from platework.operators.rules import Rule, judge, rejected_rows, valid_rows
from platework.operators.scalars import labelled_counts, one_row
from platework.plans.health import is_stale
from platework.schemas import ZIP_DEMOGRAPHICS
from platework.session import new_folder
from platework.sources.tables import append_table, literal_table, load_reference, read_table, register_views, write_table

MONEY = "decimal(18,2)"


def _sum(column: str):
    """Sum in decimals, so that the order of summing does not show in the last digits."""
    return F.sum(F.col(column).cast(MONEY)).cast("double")


def _moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


# Scans and sinks

@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def table_scan(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderdate") >= _moment("2000-01-01 00:00:00")).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query("SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment")
def table_reload(spark, sf):
    folder = new_folder(spark, "reload")
    segments = count_by(table(spark, sf, "customer"), ["c_mktsegment"], "customers")
    write_table(segments.limit(0), folder)
    write_table(segments, folder)
    return read_table(spark, folder)


@query("""SELECT o_orderstatus AS status, count(*) AS orders FROM orders GROUP BY 1
UNION ALL SELECT c_mktsegment, count(*) FROM customer GROUP BY 1""")
def table_append(spark, sf):
    folder = new_folder(spark, "append")
    append_table(count_by(table(spark, sf, "orders"), ["o_orderstatus"], "orders").withColumnRenamed("o_orderstatus", "status"), folder)
    append_table(count_by(table(spark, sf, "customer"), ["c_mktsegment"], "orders").withColumnRenamed("c_mktsegment", "status"), folder)
    return read_table(spark, folder)


@query("SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def named_views(spark, sf):
    register_views({n: table(spark, sf, n) for n in ("customer", "nation")}, prefix="pw_")
    return spark.sql(
        "SELECT n_name, count(*) AS customers FROM pw_customer JOIN pw_nation ON c_nationkey = n_nationkey "
        "GROUP BY n_name"
    )


@query("""WITH target AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01') WHERE rn = 1),
feed AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, false AS gone, 0 AS src FROM target
  UNION ALL
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderstatus = 'P', 1 FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, src DESC) AS rn FROM feed)
WHERE rn = 1 AND NOT gone""")
def change_feed_apply(spark, sf):
    """Newest order per customer as the table, later orders as its changes; a 'P' order deletes."""
    orders, cut = table(spark, sf, "orders"), _moment("1998-01-01 00:00:00")
    columns = ["o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"]
    older = dedup_latest(orders.where(F.col("o_orderdate") < cut), ["o_custkey"], latest_first("o_orderdate", "o_orderkey"))
    return apply_changes(
        older.select(*columns),
        orders.where(F.col("o_orderdate") >= cut).select(*columns, "o_orderstatus"),
        ["o_custkey"], ["o_orderdate", "o_orderkey"], delete_when=F.col("o_orderstatus") == "P",
    )


# JSON text

@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_path(spark, sf):
    return table(spark, sf, "events").select("event_id", to_int(d.json_path("props", "$.k")).alias("k"))


@query("SELECT array_to_string(json_keys(props), ',') AS keys, count(*) AS n FROM events GROUP BY 1")
def json_object_keys(spark, sf):
    keys = F.array_join(d.object_keys("props"), ",").alias("keys")
    return table(spark, sf, "events").groupBy(keys).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_id, CAST(event_id AS VARCHAR) AS id_text, CAST(-value AS VARCHAR) AS value_text,
  CAST(NULL AS VARCHAR) AS null_text, CAST(json(props) AS VARCHAR) AS nested_text, 4 AS cells FROM events""")
def json_scalar_texts(spark, sf):
    """Numbers, null and nested objects in a positional array, read as text."""
    cells = F.concat(
        F.lit('{"data":[['), F.col("event_id").cast("string"), F.lit(","), (-F.col("value")).cast("string"),
        F.lit(",null,"), F.col("props"), F.lit("]]}"),
    )
    row = d.record_cells(F.col("doc.data")[0])
    return table(spark, sf, "events").select("event_id", d.decode(cells).alias("doc")).select(
        "event_id", row[0].alias("id_text"), row[1].alias("value_text"), row[2].alias("null_text"),
        row[3].alias("nested_text"), F.size(row).alias("cells"),
    )


# Scalar expressions

@query("""SELECT p_partkey, upper(p_name) AS upper_name, replace(p_name, ' ', '_') AS joined_name,
  split_part(p_name, ' ', 2) AS second_word, split_part(p_name, ' ', 9) AS ninth_word FROM part""")
def text_functions(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        F.upper("p_name").alias("upper_name"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("_")).alias("joined_name"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)).alias("second_word"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(9)).alias("ninth_word"),
    )


@query("""SELECT o_orderkey, TRY_CAST(token AS INTEGER) AS as_int, TRY_CAST(token AS DOUBLE) AS as_double FROM (
  SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN ' 12 ' WHEN '2-HIGH' THEN 'abc' WHEN '3-MEDIUM' THEN ''
    WHEN '5-LOW' THEN CAST(-o_orderkey AS VARCHAR) END AS token FROM orders)""")
def lenient_casts(spark, sf):
    priority = F.col("o_orderpriority")
    token = (
        F.when(priority == "1-URGENT", F.lit(" 12 ")).when(priority == "2-HIGH", F.lit("abc"))
        .when(priority == "3-MEDIUM", F.lit("")).when(priority == "5-LOW", (-F.col("o_orderkey")).cast("string"))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", to_int(token).alias("as_int"), to_double(token).alias("as_double")
    )


@query("""SELECT o_orderkey, substring(CAST(o_orderkey AS VARCHAR), 1, 2) AS code, CAST(o_orderkey AS DOUBLE) AS as_double,
  CAST(o_custkey AS VARCHAR) AS as_text FROM orders""")
def bounded_text(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", bounded("o_orderkey", 2).alias("code"), F.col("o_orderkey").cast("double").alias("as_double"),
        F.col("o_custkey").cast("string").alias("as_text"),
    )


@query("""SELECT event_id, ts AS at, date_diff('minute', ts, TIMESTAMP '2024-02-01 00:00:30') AS minutes,
  ts - INTERVAL 2 HOUR AS two_hours_before, date_sub('second', ts, TIMESTAMP '2024-02-01 00:00:30') AS seconds,
  CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS INTEGER) AS days FROM events""")
def time_functions(spark, sf):
    end = _moment("2024-02-01 00:00:30")
    return table(spark, sf, "events").select(
        "event_id",
        wall_clock("ts").alias("at"),
        minutes_between("ts", end).alias("minutes"),
        hours_before("ts", 2).alias("two_hours_before"),
        seconds_between("ts", end).alias("seconds"),
        days_between("ts", end).alias("days"),
    )


@query("""SELECT c_custkey, TRY_CAST(split_part(inside, ' ', 1) AS DOUBLE) AS lng, TRY_CAST(split_part(inside, ' ', 2) AS DOUBLE) AS lat
FROM (SELECT c_custkey, replace(replace(CASE WHEN c_mktsegment = 'MACHINERY' THEN 'unknown'
    WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL
    ELSE 'POINT (-' || c_nationkey || '.25 ' || c_custkey || '.5)' END, 'POINT (', ''), ')', '') AS inside FROM customer)""")
def point_parser(spark, sf):
    segment = F.col("c_mktsegment")
    point = F.when(segment == "MACHINERY", F.lit("unknown")).when(segment == "HOUSEHOLD", F.lit(None)).otherwise(
        F.concat(
            F.lit("POINT (-"), F.col("c_nationkey").cast("string"), F.lit(".25 "), F.col("c_custkey").cast("string"),
            F.lit(".5)"),
        )
    )
    return table(spark, sf, "customer").select(
        "c_custkey", longitude(point).alias("lng"), latitude(point).alias("lat")
    )


@query("""SELECT c_custkey, c_name || '/' || nullif(c_mktsegment, 'MACHINERY') AS joined,
  coalesce(nullif(c_mktsegment, 'MACHINERY'), '') AS filled FROM customer""")
def null_text(spark, sf):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))
    return table(spark, sf, "customer").select(
        "c_custkey", F.concat("c_name", F.lit("/"), segment).alias("joined"),
        F.coalesce(segment, F.lit("")).alias("filled"),
    )


@query("""SELECT c_custkey, sha256(coalesce(nullif(c_mktsegment, 'MACHINERY'), '') || '|' || coalesce(n_name, '') || '|' || CAST(c_nationkey AS VARCHAR)) AS geo_key
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 3""")
def hashed_key(spark, sf):
    nations = table(spark, sf, "nation").where(F.col("n_regionkey") < 3).select("n_nationkey", "n_name")
    rows = left_lookup(table(spark, sf, "customer"), nations, {"c_nationkey": "n_nationkey"})
    segment = F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))
    return rows.select(
        "c_custkey", surrogate_key(segment, "n_name", F.col("c_nationkey").cast("string")).alias("geo_key")
    )


@query("""SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 40 THEN 'medium' ELSE 'large' END AS size_label,
  'line' AS kind FROM lineitem""")
def case_labels(spark, sf):
    quantity = F.col("l_quantity")
    label = F.when(quantity < 10, F.lit("small")).when(quantity < 40, F.lit("medium")).otherwise(F.lit("large"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", label.alias("size_label"), F.lit("line").alias("kind")
    )


# Filters

@query("""SELECT count(*) FILTER (kind IN ('click', 'view')) AS listed, count(*) FILTER (kind NOT IN ('click', 'view')) AS unlisted,
  count(*) FILTER (kind IS NULL) AS unset FROM (SELECT nullif(event_type, 'error') AS kind FROM events)""")
def value_lists(spark, sf):
    """A NULL is neither in the list nor outside of it."""
    kind = F.nullif(F.col("event_type"), F.lit("error"))
    listed = kind.isin("click", "view")
    return table(spark, sf, "events").agg(
        F.count_if(listed).alias("listed"), F.count_if(~listed).alias("unlisted"),
        F.count_if(kind.isNull()).alias("unset"),
    )


@query("""SELECT c_custkey FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000) ON c_custkey = o_custkey
WHERE o_custkey IS NULL""")
def unmatched_rows(spark, sf):
    buyers = table(spark, sf, "orders").where(F.col("o_totalprice") > 400000).select(
        F.col("o_custkey").alias("buyer"), F.col("o_custkey").alias("matched")
    ).distinct()
    joined = left_lookup(table(spark, sf, "customer").select("c_custkey"), buyers, {"c_custkey": "buyer"})
    return joined.where(F.col("matched").isNull()).select("c_custkey")


def _event_rules():
    kind = F.nullif(F.col("event_type"), F.lit("signup"))
    return [
        Rule("user", F.nullif(F.col("user_id"), F.lit(7)).isNull(), F.lit("user is NULL")),
        Rule("kind", ~kind.isin("click", "view", "purchase"), F.concat(F.lit("Invalid kind: "), F.coalesce(kind, F.lit("NULL")))),
        Rule("value", F.coalesce(F.col("value") > 60, F.lit(False)), F.concat(F.lit("Large value: "), F.floor("value").cast("string"))),
    ]


_JUDGED = """SELECT event_id, user_id, kind, value FROM (
  SELECT event_id, nullif(user_id, 7) AS user_id, nullif(event_type, 'signup') AS kind, value FROM events)"""


@query(f"""SELECT event_id FROM ({_JUDGED})
WHERE user_id IS NOT NULL AND kind IN ('click', 'view', 'purchase') AND (value <= 60 OR value IS NULL)""")
def rows_passing_rules(spark, sf):
    return valid_rows(judge(table(spark, sf, "events"), _event_rules())).select("event_id")


_REJECTED = """SELECT event_id, CASE WHEN user_id IS NULL THEN 'user is NULL' WHEN kind NOT IN ('click', 'view', 'purchase'){0} THEN 'Invalid kind: ' || coalesce(kind, 'NULL')
  WHEN value > 60 THEN 'Large value: ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS REJECTION_REASON
FROM ({1}) WHERE user_id IS NULL OR kind NOT IN ('click', 'view', 'purchase'){0} OR value > 60"""


@query(_REJECTED.format("", _JUDGED))
def rows_breaking_rules(spark, sf):
    return rejected_rows(judge(table(spark, sf, "events"), _event_rules())).select("event_id", "REJECTION_REASON")


@query(_REJECTED.format(" OR kind IS NULL", _JUDGED))
def rows_breaking_rules_strict(spark, sf):
    judged = judge(table(spark, sf, "events"), _event_rules(), strict=True)
    return rejected_rows(judged).select("event_id", "REJECTION_REASON")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12")
def groups_above(spark, sf):
    return count_by(table(spark, sf, "orders"), ["o_custkey"]).where(F.col("n") > 12)


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 2 HOUR")
def recent_rows(spark, sf):
    since = hours_before(_moment("2024-01-30 12:00:00"), 2)
    return table(spark, sf, "events").where(F.col("ts") > since).select("event_id", "ts")


@query("""SELECT r_name, EXISTS (SELECT 1 FROM orders WHERE o_totalprice > 499000) AS large_order,
  EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0) AS negative_order FROM region""")
def existence_tests(spark, sf):
    price = F.col("o_totalprice")
    orders = table(spark, sf, "orders")
    return table(spark, sf, "region").select(
        "r_name",
        orders.where(price > 499000).exists().alias("large_order"),
        orders.where(price < 0).exists().alias("negative_order"),
    )


@query("""SELECT c_custkey, total FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
  ON c_custkey = o_custkey WHERE total > 3""")
def outer_join_filtered(spark, sf):
    totals = count_by(table(spark, sf, "orders").where(F.col("o_orderstatus") == "F"), ["o_custkey"], "total")
    return left_lookup(table(spark, sf, "customer").select("c_custkey"), totals, {"c_custkey": "o_custkey"}).where(
        F.col("total") > 3
    )


# Joins

@query("""SELECT c_custkey, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 1) ON c_nationkey = n_nationkey""")
def lookup_join(spark, sf):
    nations = table(spark, sf, "nation").where(F.col("n_regionkey") != 1).select("n_nationkey", "n_name")
    return left_lookup(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), nations, {"c_nationkey": "n_nationkey"}).drop("c_nationkey")


_TARGETS = [(1996, "1-URGENT", 500), (1997, "1-URGENT", 900), (1998, "2-HIGH", 700), (1999, "5-LOW", 1200)]
_TARGETS_SQL = "(VALUES " + ", ".join(str(t) for t in _TARGETS) + ") AS goals(goal_year, goal_priority, target)"


def _targets(spark):
    return literal_table(spark, _TARGETS, "goal_year int, goal_priority string, target int")


@query(f"""SELECT o_orderkey, target FROM orders LEFT JOIN {_TARGETS_SQL} ON year(o_orderdate) = goal_year AND o_orderpriority = goal_priority""")
def lookup_join_two_keys(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("y"))
    joined = left_lookup(rows, _targets(spark), {"y": "goal_year", "o_orderpriority": "goal_priority"})
    return joined.select("o_orderkey", "target")


@query("""SELECT c_custkey, o_orderkey, o_orderstatus FROM customer LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders WHERE o_orderpriority = '1-URGENT') x
  ON c_custkey = o_custkey AND rn = 1""")
def latest_row_join(spark, sf):
    urgent = table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    latest = dedup_latest(urgent, ["o_custkey"], latest_first("o_orderdate", "o_orderkey"))
    return left_lookup(
        table(spark, sf, "customer").select("c_custkey"), latest.select("o_custkey", "o_orderkey", "o_orderstatus"),
        {"c_custkey": "o_custkey"},
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand, s_name FROM lineitem
  LEFT JOIN (SELECT * FROM part WHERE p_size < 40) ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def star_join(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts = table(spark, sf, "part").where(F.col("p_size") < 40).select("p_partkey", "p_brand")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return left_lookup(left_lookup(rows, parts, {"l_partkey": "p_partkey"}), suppliers, {"l_suppkey": "s_suppkey"})


@query("""SELECT event_id, kind, users FROM (SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'browse' ELSE CAST(user_id AS VARCHAR) END AS kind FROM events) e
  LEFT JOIN (SELECT CAST(user_id AS VARCHAR) AS k, count(*) AS users FROM events GROUP BY 1 UNION ALL SELECT 'browse', 0) u ON e.kind = u.k""")
def spread_join(spark, sf):
    """Two fifths of all rows share one key; they are dealt over many tasks."""
    events = table(spark, sf, "events")
    kind = F.when(F.col("event_type").isin("click", "view"), F.lit("browse")).otherwise(F.col("user_id").cast("string"))
    per_user = count_by(events, ["user_id"], "users").select(F.col("user_id").cast("string").alias("k"), "users")
    browse = literal_table(spark, [("browse", 0)], "k string, users bigint")
    rows = events.select("event_id", kind.alias("kind"))
    return spread_left_join(rows, per_user.unionByName(browse), {"kind": "k"})


@query("""SELECT o_orderkey, status, n FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderstatus END AS status FROM orders) o
  LEFT JOIN (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1) s ON o.status = s.o_orderstatus""")
def spread_join_by_shuffle(spark, sf):
    """The same without a broadcast: three keys hold all rows, a tenth has none; each key is dealt over many parts."""
    orders = table(spark, sf, "orders")
    rows = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderstatus")).alias("status"))
    return spread_left_join(rows, count_by(orders, ["o_orderstatus"]), {"status": "o_orderstatus"}, rows_per_task=500, hint="merge")


@query("SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < 0")
def inner_join(spark, sf):
    debtors = table(spark, sf, "customer").where(F.col("c_acctbal") < 0).select("c_custkey", "c_mktsegment")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return orders.join(debtors, orders["o_custkey"] == debtors["c_custkey"]).select("o_orderkey", "c_mktsegment")


@query("""SELECT c_custkey, orders, spent FROM customer JOIN (
  SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def aggregate_join(spark, sf):
    spending = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), _sum("o_totalprice").alias("spent")
    )
    customers = table(spark, sf, "customer").select("c_custkey")
    return customers.join(spending, customers["c_custkey"] == spending["o_custkey"]).drop("o_custkey")


@query("""SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(DISTINCT o_custkey) FROM orders) AS buyers,
  (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM lineitem) AS lines""")
def combined_scalars(spark, sf):
    per_buyer = count_by(table(spark, sf, "orders"), ["o_custkey"])
    return one_row([
        per_buyer.agg(F.sum("n").alias("orders"), F.count("o_custkey").alias("buyers")),
        table(spark, sf, "customer").agg(F.count(F.lit(1)).alias("customers")),
        table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("lines")),
    ])


# Aggregates

@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l_quantity) AS avg_quantity, max(l_shipdate) AS last_ship,
  CAST(sum(CASE WHEN l_discount > 0.05 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS discounted
FROM lineitem GROUP BY 1, 2""")
def grouped_aggregates(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        _sum("l_quantity").alias("quantity"),
        (_sum("l_quantity") / F.count("l_quantity")).alias("avg_quantity"),
        F.max("l_shipdate").alias("last_ship"),
        sum_where(F.col("l_discount") > 0.05, F.col("l_extendedprice").cast(MONEY)).cast("double").alias("discounted"),
    )


@query("""SELECT count(*) AS n, count(nullif(event_type, 'error')) AS with_kind, count(DISTINCT user_id) AS users,
  count(DISTINCT nullif(event_type, 'error')) AS kinds FROM events""")
def counts(spark, sf):
    kind = F.nullif(F.col("event_type"), F.lit("error"))
    return table(spark, sf, "events").agg(
        F.count(F.lit(1)).alias("n"), F.count(kind).alias("with_kind"), F.countDistinct("user_id").alias("users"),
        F.countDistinct(kind).alias("kinds"),
    )


@query("""SELECT o_orderpriority, count(*) FILTER (nullif(o_orderstatus, 'O') = 'F') AS filled, count(*) AS n,
  """ + percent_sql("count(*) FILTER (o_orderstatus = 'F')", "count(*)") + """ AS filled_pct FROM orders GROUP BY 1""")
def conditional_counts(spark, sf):
    """A NULL condition counts as false."""
    filled = F.nullif(F.col("o_orderstatus"), F.lit("O")) == "F"
    grouped = table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.count_if(filled).alias("filled"), F.count(F.lit(1)).alias("n")
    )
    return grouped.withColumn("filled_pct", percent_double("filled", "n"))


@query("""SELECT n_name, c_mktsegment, count(*) AS n, avg(c_custkey) AS mean_key FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def grouped_by_two(spark, sf):
    joined = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return count_by(joined, ["n_name", "c_mktsegment"], mean_key=F.avg("c_custkey"))


@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct_rows(spark, sf):
    return table(spark, sf, "part").select("p_brand", "p_type").distinct()


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_key_rows(spark, sf):
    return repeated_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT o_custkey, CASE WHEN max(big) > 0 THEN count(*) / CAST(max(big) AS DOUBLE) END AS per_big FROM (
  SELECT o_custkey, CASE WHEN o_totalprice > 400000 THEN 3 ELSE 0 END AS big FROM orders) GROUP BY 1""")
def guarded_ratios(spark, sf):
    big = F.when(F.col("o_totalprice") > 400000, 3).otherwise(0)
    grouped = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.max(big).alias("big")
    )
    return grouped.select("o_custkey", guarded_ratio("n", "big").alias("per_big"))


# Windows

@query("""SELECT event_id, user_id, event_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_per_key(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return dedup_latest(rows, ["user_id"], latest_first("ts", "event_id"))


_NULLABLE_USERS = "SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS uid, ts FROM events"


@query(f"""SELECT event_id, uid, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS rn FROM ({_NULLABLE_USERS})) WHERE rn = 1 OR uid IS NULL""")
def latest_per_key_strict(spark, sf):
    """Rows without a key bypass the dedup."""
    uid = F.when(F.col("event_type") != "error", F.col("user_id")).alias("uid")
    rows = table(spark, sf, "events").select("event_id", uid, "ts")
    return dedup_latest(rows, ["uid"], latest_first("ts", "event_id"), null_keys="all")


@query("""SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_order(spark, sf):
    """Orders of one customer can share a date: the key settles it."""
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return dedup_latest(rows, ["o_custkey"], latest_first("o_orderdate", "o_orderkey"))


@query("""SELECT y, o_orderpriority, n, CAST(sum(n) OVER (PARTITION BY o_orderpriority ORDER BY y) AS BIGINT) AS running FROM (
  SELECT year(o_orderdate)::INTEGER AS y, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)""")
def running_totals(spark, sf):
    rows = table(spark, sf, "orders").select(F.year("o_orderdate").alias("y"), "o_orderpriority")
    return running_total(count_by(rows, ["y", "o_orderpriority"]), "n", ["o_orderpriority"], "y", "running")


@query("SELECT event_type, n, " + percent_sql("n", "total") + """ AS pct FROM (
  SELECT event_type, count(*) AS n, CAST((SELECT count(*) FROM events) AS BIGINT) AS total FROM events GROUP BY 1)""")
def share_of_total(spark, sf):
    return with_share(count_by(table(spark, sf, "events"), ["event_type"]), "n", "pct")


@query("SELECT y, total, prev, " + percent_sql("(total - prev)", "prev") + """ AS growth_pct FROM (
  SELECT *, lag(total) OVER (ORDER BY y) AS prev FROM (
    SELECT year(o_orderdate)::INTEGER AS y, count(*) AS total FROM orders GROUP BY 1))""")
def growth_over_previous(spark, sf):
    rows = table(spark, sf, "orders").select(F.year("o_orderdate").alias("y"))
    return with_growth(count_by(rows, ["y"], "total"), "total", "y", "prev", "growth_pct")


# Order, top-k and unions

@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS FIRST, c_custkey")
def ordered_rows(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_acctbal").orderBy(
        F.col("c_acctbal").desc_nulls_first(), F.col("c_custkey").asc_nulls_last()
    )


@query("SELECT p_brand, count(*) AS n, max(p_retailprice) AS top_price FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10")
def top_brands(spark, sf):
    grouped = count_by(table(spark, sf, "part"), ["p_brand"], top_price=F.max("p_retailprice"))
    return top_k(grouped, 10, F.col("n").desc(), F.col("p_brand").asc())


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def sampled_rows(spark, sf):
    """Five rows, by their key, so that it is always the same ones."""
    return top_k(table(spark, sf, "orders"), 5, F.col("o_orderkey").asc())


@query("SELECT CAST(n_nationkey AS VARCHAR) AS zip_code, n_regionkey AS population, NULLIF(n_nationkey, 7) AS median_income, 1 AS ev_charging_stations FROM nation")
def csv_load(spark, sf):
    """A typed load of a CSV with a header, one cell of it empty."""
    key = F.col("n_nationkey")
    rows = table(spark, sf, "nation").select(
        key.cast("string").alias("zip_code"), F.col("n_regionkey").alias("population"),
        F.when(key != 7, key).alias("median_income"), F.lit(1).alias("ev_charging_stations"))
    folder = new_folder(spark, "csv")
    rows.write.option("header", True).csv(folder)
    return load_reference(spark, folder, ZIP_DEMOGRAPHICS)


@query("""SELECT lag, newest IS NULL OR date_diff('minute', newest, TIMESTAMP '2024-02-01') > lag AS stale
FROM (SELECT max(ts) AS newest FROM events), (VALUES (0), (1000), (100000000)) AS lags(lag)""")
def stale_events(spark, sf):
    """Whether the newest event is older than some lags allow."""
    events, now = table(spark, sf, "events"), _moment("2024-02-01 00:00:00")
    found = [(lag, is_stale(events, "ts", now, lag)) for lag in (0, 1_000, 100_000_000)]
    return spark.createDataFrame(found, "lag int, stale boolean")


_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _TABLES))
def table_row_counts(spark, sf):
    return labelled_counts({t: table(spark, sf, t) for t in _TABLES})


# The smallest query that goes through every stage

@query(f"""WITH latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1),
grouped AS (
  SELECT year(o_orderdate)::INTEGER AS y, o_orderpriority, count(*) AS n, max(target) AS target
  FROM latest LEFT JOIN {_TARGETS_SQL} ON year(o_orderdate) = goal_year AND o_orderpriority = goal_priority GROUP BY 1, 2),
totals AS (SELECT *, CAST(sum(n) OVER (PARTITION BY o_orderpriority ORDER BY y) AS BIGINT) AS running FROM grouped)
SELECT y, o_orderpriority, n, target, running, CASE WHEN target > 0 THEN running / CAST(target AS DOUBLE) END AS goal_share FROM totals""")
def yearly_goal_progress(spark, sf):
    latest = dedup_latest(
        table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"], latest_first("o_orderdate", "o_orderkey")
    ).select(F.year("o_orderdate").alias("y"), "o_orderpriority")
    joined = left_lookup(latest, _targets(spark), {"y": "goal_year", "o_orderpriority": "goal_priority"})
    grouped = count_by(joined, ["y", "o_orderpriority"], target=F.max("target"))
    totals = running_total(grouped, "n", ["o_orderpriority"], "y", "running")
    return totals.withColumn("goal_share", guarded_ratio("running", "target"))
