import pytest
from pyspark.sql import functions as F
from samples import T0, T1, bronze, document, registration

from platework.plans.silver import latest_registrations
from platework.schemas import LINEAGE
from platework.sources.documents import parse_documents
from platework.streaming.ingest import ingest_new, landed, landing_rejects
from platework.streaming.upserts import Keyed, append_changes, compact, current_state, follow_changes, last_version


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_files_are_loaded_once(spark, tmp_path):
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("in", "raw", "checkpoint"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.json").write_text(document([registration("A1"), registration("A2")]))
    ingest_new(spark, inbox, out, checkpoint)
    assert landed(spark, out).count() == 1
    ingest_new(spark, inbox, out, checkpoint)
    assert landed(spark, out).count() == 1
    (tmp_path / "in" / "two.json").write_text(document([registration("A3")]))
    (tmp_path / "in" / "bad.json").write_text("{")
    ingest_new(spark, inbox, out, checkpoint)
    raw = landed(spark, out)
    assert raw.count() == 2 and raw.columns == ["raw_data", "loaded_at", "source_file"]
    assert sorted(r["VIN"] for r in parse_documents(raw).collect()) == ["A1", "A2", "A3"]
    assert [r["source_file"].rsplit("/", 1)[-1] for r in landing_rejects(spark, out).collect()] == ["bad.json"]


def test_abort_leaves_the_bad_file_for_the_next_try(spark, tmp_path):
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("in", "raw", "checkpoint"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "bad.json").write_text("{")
    with pytest.raises(Exception, match="not a JSON document"):
        ingest_new(spark, inbox, out, checkpoint, on_error="abort")
    (tmp_path / "in" / "bad.json").write_text(document([registration("A1")]))
    ingest_new(spark, inbox, out, checkpoint, on_error="abort")
    assert landed(spark, out).count() == 1


SCHEMA = "k int, s int, v string, op string"


def test_followed_changes(spark, tmp_path):
    inbox, table = str(tmp_path / "in"), Keyed(str(tmp_path / "t"), ["k"], ["s"], F.col("op") == "d")
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(SCHEMA).parquet(inbox)

    def arrive(*changes):
        spark.createDataFrame(list(changes), SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        follow_changes(stream, table, str(tmp_path / "checkpoint"))

    arrive((1, 1, "a", "u"), (1, 2, "a2", "u"), (2, 1, "b", "u"))
    assert rows(current_state(spark, table)) == [(1, 2, "a2", "u"), (2, 1, "b", "u")]
    assert last_version(spark, table) is None
    assert compact(spark, table) == 0 == last_version(spark, table)
    arrive((2, 2, None, "d"), (3, 1, "c", "u"))
    arrive((1, 1, "late", "u"))
    expected = [(1, 2, "a2", "u"), (3, 1, "c", "u")]
    assert rows(current_state(spark, table)) == expected
    follow_changes(stream, table, str(tmp_path / "checkpoint"))
    assert rows(current_state(spark, table)) == expected
    assert compact(spark, table) == 2 == compact(spark, table)
    assert rows(current_state(spark, table)) == expected


def test_replayed_batch_replaces_itself(spark, tmp_path):
    table = Keyed(str(tmp_path / "t"), ["k"], ["s"])
    batch = spark.createDataFrame([(1, 1, "a", "u"), (1, 3, "b", "u")], SCHEMA)
    append_changes(batch, 0, table)
    append_changes(batch, 0, table)
    assert spark.read.parquet(table.changes).count() == 1
    assert rows(current_state(spark, table)) == [(1, 3, "b", "u")]


def test_silver_input_kept_current_equals_the_full_dedup(spark, tmp_path):
    table = Keyed(str(tmp_path / "t"), ["VIN"], ["LOAD_TS", *LINEAGE])
    first = [registration("A1", MODEL="old"), registration("A2"), registration(None)]
    second = [registration("A1", MODEL="new", LOAD_TS=T1), registration("A3"), registration(None, LOAD_TS=T1)]
    for i, batch in enumerate((first, second)):
        append_changes(bronze(spark, batch), i, table)
    whole = latest_registrations(bronze(spark, first + second))
    assert rows(current_state(spark, table)) == rows(whole)
