import random

import pytest
from pyspark.sql import functions as F

from platework.operators import changes, grouped, lookups, rules, scalars
from platework.operators.latest import dedup_latest


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share a key and a sixth have none."""
    draw = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 6 == 1 else f"k{draw.randrange(200)}"
        data.append((key, draw.randrange(50), i))
    return data, spark.createDataFrame(data, "k string, t int, i int").cache()


def test_dedup_against_brute_force(skewed):
    data, df = skewed
    best = {}
    for key, t, i in data:
        best[key] = max(best.get(key, (-1, -1)), (t, i))
    expected = sorted([(k, t, i) for k, (t, i) in best.items()], key=repr)
    order = [F.col("t").desc(), F.col("i").desc()]
    assert rows(dedup_latest(df, ["k"], order)) == expected

    strict = sorted([r for r in expected if r[0]] + [r for r in data if r[0] is None], key=repr)
    assert rows(dedup_latest(df, ["k"], order, null_keys="all")) == strict


def test_dedup_cuts_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    text = plan(dedup_latest(df, ["k"], [F.col("t").desc()]))
    assert text.index("Exchange") < text.rindex("WindowGroupLimit") and "Partial" in text


def test_dedup_rejects_unknown_null_handling(spark):
    with pytest.raises(ValueError, match="null_keys"):
        dedup_latest(spark.range(1), ["id"], [F.col("id")], null_keys="some")


def test_split_follows_sql_and_strict_loses_nothing(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (None, "x"), (None, None)], "k int, v string")
    checks = [
        rules.Rule("k", F.col("k").isNull(), F.lit("no k")),
        rules.Rule("v", F.col("v") != "x", F.concat(F.lit("bad v "), F.coalesce("v", F.lit("NULL")))),
    ]
    valid, rejected = rules.split_valid(df, checks)
    assert rows(valid) == [(1, "x")]
    assert rows(rejected) == [(2, "y", "bad v y"), (None, "x", "no k"), (None, None, "no k")]
    valid, rejected = rules.split_valid(df, checks, strict=True)
    assert valid.count() + rejected.count() == df.count()
    assert (3, None, "bad v NULL") in rows(rejected)


def test_spread_join_equals_plain_join(skewed, spark):
    data, df = skewed
    dim = spark.createDataFrame(
        [("hot", "h1"), ("hot", "h2"), ("k1", "a"), ("k5", "b"), ("zz", "c"), (None, "d")], "name string, label string"
    )
    expected = rows(df.join(dim, df["k"] == dim["name"], "left").drop("name"))
    found = lookups.spread_left_join(df, dim, {"k": "name"}, rows_per_task=90)
    assert found.columns == ["k", "t", "i", "label"]
    assert rows(found) == expected
    assert len(expected) == 3000 + 1000


def test_spread_join_on_two_keys(spark):
    df = spark.createDataFrame([("a", 1, i) for i in range(50)] + [("a", None, 50), (None, 1, 51), ("b", 2, 52), ("a", 2, 53)],
                               "g string, n int, i int")
    dim = spark.createDataFrame([("a", 1, "hot"), ("b", 2, "cold"), ("a", 3, "none")], "dg string, dn int, label string")
    found = lookups.spread_left_join(df, dim, {"g": "dg", "n": "dn"}, rows_per_task=7)
    expected = [("a", 1, i, "hot") for i in range(50)] + [("a", None, 50, None), (None, 1, 51, None), ("b", 2, 52, "cold"), ("a", 2, 53, None)]
    assert rows(found) == sorted(expected, key=repr)


def test_spread_join_deals_hot_and_missing_keys_over_tasks(skewed, spark):
    """No task gets more than a small part of the third that shares a key."""
    _, df = skewed
    dim = spark.createDataFrame([("hot", "h1")], "name string, label string")
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        found = lookups.spread_left_join(df, dim, {"k": "name"}, rows_per_task=20).where("k = 'hot' OR k IS NULL")
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 1500 and max(sizes) < 500


def test_repeated_lookup_key_raises(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert lookups.measure_lookup(twice, ["k"]) == lookups.LookupSize(3, 1)
    assert lookups.measure_lookup(twice.limit(0), ["k"]) == lookups.LookupSize(0, 0)
    with pytest.raises(ValueError, match="repeated"):
        lookups.unique_lookup(spark.range(2), twice, {"id": "k"})
    assert lookups.left_lookup(spark.range(2), twice, {"id": "k"}).count() == 3


def test_changes_newest_wins_and_replay_changes_nothing(spark):
    target = spark.createDataFrame([(1, 10, "a"), (2, 10, "b"), (3, 10, "c"), (4, 10, "d")], "k int, s int, v string")
    feed = spark.createDataFrame(
        [(1, 11, "a2", "u"), (1, 12, "a3", "u"), (2, 9, "late", "u"), (3, 11, None, "d"), (4, 10, "tie", "u"),
         (5, 1, "new", "u"), (6, 1, "gone", "u"), (6, 2, None, "d"), (7, 2, None, "d"), (7, 3, "back", "u")],
        "k int, s int, v string, op string",
    )
    gone = F.col("op") == "d"
    once = changes.apply_changes(target, feed, ["k"], ["s"], gone)
    expected = [(1, 12, "a3"), (2, 10, "b"), (4, 10, "tie"), (5, 1, "new"), (7, 3, "back")]
    assert rows(once) == expected
    assert rows(changes.apply_changes(once, feed, ["k"], ["s"], gone)) == expected


def test_changes_without_target_and_with_unknown_delete_flag(spark):
    feed = spark.createDataFrame([(1, 1, None), (1, 2, None), (2, 1, "d")], "k int, s int, op string")
    assert rows(changes.apply_changes(None, feed, ["k"], ["s"], F.col("op") == "d")) == [(1, 2, None)]


def test_share_totals_a_hundred_and_survives_no_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "g string")
    shared = grouped.with_share(grouped.count_by(df, ["g"]), "n", "pct")
    assert rows(shared) == [("a", 2, 50.0), ("b", 1, 25.0), (None, 1, 25.0)]
    assert rows(grouped.with_share(grouped.count_by(df.limit(0), ["g"]), "n", "pct")) == []


def test_running_total_puts_null_last(spark):
    df = spark.createDataFrame([("x", None, 1), ("x", 2, 10), ("x", 1, 100), ("y", 5, 7)], "g string, o int, n int")
    assert rows(grouped.running_total(df, "n", ["g"], "o", "sum")) == [
        ("x", 1, 100, 100), ("x", 2, 10, 110), ("x", None, 1, 111), ("y", 5, 7, 7),
    ]


def test_growth_guards_zero(spark):
    df = spark.createDataFrame([(1, 0), (2, 5), (3, 4)], "y int, n int")
    assert rows(grouped.with_growth(df, "n", "y", "prev", "pct")) == [(1, 0, None, None), (2, 5, 0, None), (3, 4, 5, -20.0)]


def test_one_row_keeps_zero_and_null(spark):
    df = spark.range(3)
    combined = scalars.one_row([
        df.agg(F.count(F.lit(1)).alias("a")), df.limit(0).agg(F.count(F.lit(1)).alias("b")),
        df.limit(0).agg(F.max("id").alias("c")),
    ])
    assert [tuple(r) for r in combined.collect()] == [(3, 0, None)]


def test_repeated_keys_count_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert rows(grouped.repeated_keys(df, ["k"])) == [("a", 2), (None, 2)]


def test_target_is_read_and_shuffled_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("s")).write.parquet(path)
    spark.createDataFrame([(5, 2), (2000, 1), (None, 3)], "k long, s int").write.parquet(f"{path}-feed")
    feed = spark.read.parquet(f"{path}-feed")
    merged = changes.apply_changes(spark.read.parquet(path), feed, ["k"], ["s"])
    assert plan(merged).count("FileScan") == 2 and plan(merged).count("Exchange") == 1
    found = rows(merged)
    assert len(found) == 1002 and (5, 2) in found and (2000, 1) in found and (None, 3) in found
    once_more = changes.apply_changes(merged, feed, ["k"], ["s"])
    assert rows(once_more) == found
