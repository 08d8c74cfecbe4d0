"""The manifest of runs: what counts, what was counted, and states of before."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from platework.plans import store

NOW = datetime(2026, 1, 1, tzinfo=timezone.utc)


def rows(spark, *pairs):
    return spark.createDataFrame(pairs, "k string, v int").withColumn(store.BUCKET, store.bucket_of("k", 8))


def content(spark, root, name, table, **more):
    return sorted(tuple(r) for r in store.load(spark, root, name, table, **more).collect())


def test_only_published_folders_count(spark, tmp_path):
    root = str(tmp_path)
    assert store.published(spark, root) == {}
    one = store.begin(spark, root, "a", ["t"], NOW)
    entry = store.write(spark.range(3), root, "t", one)
    assert store.published(spark, root) == {} and entry.rows == 3
    two = store.begin(spark, root, "a", ["t"], NOW)
    assert two.number == one.number + 1  # a number is not used again, published or not
    store.publish(spark, root, [store.write(spark.range(5), root, "t", two)], NOW)
    table = store.published(spark, root)["t"]
    assert table.rows == 5 == store.load(spark, root, "t", table).count() and table.batch == two.number


def test_added_and_whole_tables(spark, tmp_path):
    root = str(tmp_path)
    for n, adds in ((2, True), (3, True), (4, False), (5, True)):
        batch = store.begin(spark, root, "a", ["t"], NOW)
        measures = {"top": F.max("id")}
        store.publish(spark, root, [store.write(spark.range(n), root, "t", batch, adds=adds, measures=measures)], NOW)
    table = store.published(spark, root)["t"]
    assert table.rows == 9 == store.load(spark, root, "t", table).count() and table.fact("top") == 3 + 4
    assert store.load(spark, root, "t", table, since=table.entries[2].batch).count() == 5
    assert store.published(spark, root, table.entries[1].batch)["t"].rows == 5


def test_buckets_are_replaced_one_by_one(spark, tmp_path):
    root = str(tmp_path)
    every = rows(spark, *[(f"k{i}", i) for i in range(100)], (None, -1))
    one = store.begin(spark, root, "a", ["t"], NOW)
    first = store.write(every.repartition(5), root, "t", one, buckets=range(8))
    store.publish(spark, root, [first], NOW)
    counted = {r[0]: r[1] for r in every.groupBy(store.BUCKET).count().collect()}
    assert first.counts == counted  # observed on the way, exactly
    bucket = next(iter(counted))
    two = store.begin(spark, root, "a", ["t"], NOW)
    new = every.where(F.col(store.BUCKET) == bucket).withColumn("v", F.lit(1000)).limit(1)
    empty = next(b for b in counted if b != bucket)
    second = store.write(new, root, "t", two, buckets=[bucket, empty], whole=False)
    unkeyed = spark.createDataFrame([("x", 7)], "k string, v int").withColumn(store.BUCKET, F.lit(store.UNKEYED))
    store.publish(spark, root, [second, store.write(unkeyed, root, "t", two, adds=True, buckets=[store.UNKEYED])], NOW)
    table = store.published(spark, root)["t"]
    expected = 101 - counted[bucket] - counted[empty] + 1 + 1
    assert table.rows == expected == store.load(spark, root, "t", table).count()
    assert content(spark, root, "t", table, buckets=[empty]) == []
    assert [v for _, v in content(spark, root, "t", table, buckets=[bucket])] == [1000]
    before = store.published(spark, root, one.number)["t"]
    assert before.rows == 101 == store.load(spark, root, "t", before).count()
    plan = store.load(spark, root, "t", table, buckets=[bucket])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and plan.count("FileScan") == 1


@pytest.mark.parametrize("buckets", [1, 2, 300])
def test_counts_by_bucket_are_exact_for_any_number(spark, tmp_path, buckets):
    df = spark.range(5_000).withColumn(store.BUCKET, store.bucket_of("id", buckets))
    batch = store.begin(spark, str(tmp_path), "a", ["t"], NOW)
    found = store.write(df, str(tmp_path), "t", batch, buckets=range(buckets))
    assert found.counts == {r[0]: r[1] for r in df.groupBy(store.BUCKET).count().collect()}


def test_a_table_without_rows_has_its_columns(spark, tmp_path):
    batch = store.begin(spark, str(tmp_path), "a", ["t"], NOW)
    entry = store.write(rows(spark).limit(0), str(tmp_path), "t", batch, buckets=range(8))
    store.publish(spark, str(tmp_path), [entry], NOW)
    found = store.load(spark, str(tmp_path), "t", store.published(spark, str(tmp_path))["t"])
    assert found.columns == ["k", "v"] and found.count() == 0
