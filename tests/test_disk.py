"""What queries and runs leave on disk: shuffles that are needed, once each, and gone with the job; narrow rows in them."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from samples import bronze, registration

from platework.bindings import feed
from platework.plans import gold, run, store
from platework.session import split_bytes, stored_bytes, writing
from platework.sources import tables as tables_module
from platework.sources.tables import write_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def joins(df) -> list[str]:
    """The joins of a plan, the first that is done first, each with its keys."""
    lines = [line.split("Join", 1) for line in plan(df).splitlines() if "Join [" in line]
    return [f"{kind.split(' ')[-1]} {keys.split('[', 1)[1].split('#')[0]}" for kind, keys in reversed(lines)]


@pytest.fixture()
def settings(spark):
    """Settings of the session for one test."""
    before = {}

    def put(**values):
        for k, v in values.items():
            k = "spark.sql." + k.replace("__", ".")
            before.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield put
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Lines of ten orders, five parts and four suppliers, one of them of no known nation; keys repeat and are null."""
    folder = str(tmp_path_factory.mktemp("tables with a space"))
    lines = [(o, o % 5 if o else None, o % 4 if o != 3 else None, n) for o in range(10) for n in (1, 2, 2)]
    rows = {
        "lineitem": [(o, p, s, n, 10.0, 1.0, 0.05, 0.01, "A", "F") for o, p, s, n in lines],
        "part": [(p, f"part {p}", "Brand", "T", 10, 9.5) for p in (0, 1, 2, 3, 4, 4, None)],
        "supplier": [(s, f"s {s}", s if s != 2 else 99, 1.0) for s in (0, 1, 2, 3, None)],
        "nation": [(n, f"N{n}", n % 2) for n in range(4)],
    }
    for name, found in rows.items():
        schema = feed.SCHEMAS[name].replace(", l_shipdate timestamp_ntz", "")
        df = spark.createDataFrame(found, schema)
        if name == "lineitem":
            df = df.withColumn("l_shipdate", F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"))
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def content(df) -> list:
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_table_that_is_split_anyway_is_not_dealt_out(spark, tables, settings):
    small = feed.bronze(spark, tables)
    expected = content(small)
    assert "REPARTITION_BY_COL" in plan(small) and len(expected) > 20
    settings(files__maxPartitionBytes="100b")
    large = feed.bronze(spark, tables)
    assert "REPARTITION_BY_COL" not in plan(large)
    assert content(large) == expected


def test_lines_meet_suppliers_without_a_shuffle_and_texts_last(spark, tables, settings, monkeypatch):
    expected = content(feed.bronze(spark, tables))
    settings(autoBroadcastJoinThreshold="-1", files__maxPartitionBytes="100b")
    df = feed.bronze(spark, tables)
    assert joins(df) == ["BroadcastHash l_suppkey", "SortMerge l_partkey", "SortMerge s_nationkey"]
    assert content(df) == expected
    monkeypatch.setattr(feed, "FEW_SUPPLIERS", 3)
    df = feed.bronze(spark, tables)
    assert joins(df)[0] == "SortMerge l_suppkey"
    assert content(df) == expected


def shuffles(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b for b in blocks.mkString(" ").split() if b.startswith("shuffle_")}


def test_shuffles_go_with_the_job_that_wrote_the_table(spark, tmp_path):
    before = shuffles(spark)
    rows = spark.range(10_000).repartition(7, "id").withColumn(store.BUCKET, store.bucket_of("id", 4))
    write_table(rows, f"{tmp_path}/plain")
    batch = store.begin(spark, str(tmp_path), "a", ["t"], run.utc_now())
    entry = store.write(rows, str(tmp_path), "t", batch, buckets=range(4))
    assert shuffles(spark) <= before
    assert entry.rows == 10_000 == spark.read.parquet(f"{tmp_path}/plain").count()
    for folder in ("plain", "t"):
        files = [f for f in (tmp_path / folder).rglob("*.parquet")]
        assert files and all(f.name.endswith(".zstd.parquet") for f in files)


def test_row_groups_are_bounded_by_the_option(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(tables_module.OPTIONS["parquet"], "parquet.block.size", str(1 << 16))
    write_table(spark.range(200_000, numPartitions=1).select(F.rand(1).alias("x")), f"{tmp_path}/t")
    file, = (tmp_path / "t").glob("*.parquet")
    assert pq.ParquetFile(file).num_row_groups > 5


def test_settings_for_a_write_are_put_back(spark, settings):
    settings(files__maxPartitionBytes="1m")
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    known = spark.conf.get(key, None)
    with pytest.raises(ZeroDivisionError):
        with writing(spark, 1000):
            assert split_bytes(spark) == 1000 and spark.conf.get(key) == "true"
            raise ZeroDivisionError
    with writing(spark, 1 << 30):
        assert split_bytes(spark) == 1 << 20  # never more than the session allows
    assert split_bytes(spark) == 1 << 20 and spark.conf.get(key, None) == known


def test_tasks_that_sort_by_bucket_read_small_splits(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(store, "writing", lambda s, splits=None: seen.append(splits) or writing(s, splits))
    root = str(tmp_path)
    rows = spark.range(100).withColumn(store.BUCKET, store.bucket_of("id", 4))
    batch = store.begin(spark, root, "a", ["t"], run.utc_now())
    store.write(rows, root, "t", batch, buckets=range(4))
    store.write(rows.drop(store.BUCKET), root, "plain", batch)
    monkeypatch.setattr(store, "SORTED_SPLIT", 1)
    monkeypatch.setattr(store, "MOST_SPLITS", 2)
    size = stored_bytes(spark, root)
    store.write(rows, root, "u", batch, buckets=range(4))
    assert seen == [8 << 20, None, size // 2]


@pytest.mark.parametrize("partitions, size, again", [
    (200, 200 << 20, False), (200, 1 << 20, True), (64, 0, False), (16, 0, False), (201, 1 << 40, True)])
def test_large_latest_rows_are_shuffled_once(spark, settings, partitions, size, again):
    settings(shuffle__partitions=str(partitions))
    rows = spark.range(10).withColumn(store.BUCKET, store.bucket_of("id", 32))
    assert ("Exchange" in plan(run._by_bucket(spark, rows, 32, size))) == again


def test_cells_are_added_up_once_for_the_tables_made_of_them(spark, tmp_path, monkeypatch):
    cfg = run.Config(str(tmp_path / "in"), str(tmp_path / "root"))
    used, made = [], gold.agg_by_county_of
    monkeypatch.setattr(gold, "agg_by_county_of", lambda cells: used.append(cells) or made(cells))
    waves = [[registration("A1"), registration("A2", CITY="Tacoma")], [registration("A1", CITY="Yakima", RECORD_POSITION=9)]]
    for wave in waves:
        run.append_bronze(spark, cfg, bronze(spark, wave))
        run.refresh(spark, cfg, only=["silver", "gold"])
    assert len(used) == 2 and all("Exchange" not in plan(cells) for cells in used)
    assert [sorted(r["CITY"] for r in cells.collect()) for cells in used] == [["SEATTLE", "TACOMA"], ["TACOMA", "YAKIMA"]]
    assert run.load(spark, cfg, "agg_by_county").first()["REGISTRATION_COUNT"] == 2
