import dataclasses
import json
from datetime import date
from decimal import Decimal

import pytest
from samples import FIELDS, T0, document, faulty_registrations, mixed_registrations, registration

from platework.plans import quality, run, store
from platework.schemas import INCENTIVE_APPLICATIONS
from platework.session import new_folder, shared_folder


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(document(rows))


def test_full_run(spark, tmp_path):
    put(tmp_path / "in", "good.json", [r for r in mixed_registrations() if r["VIN"] not in ("A4", None)])
    applications = str(tmp_path / "applications")
    spark.createDataFrame(
        [(1, "A1", date(2026, 1, 1), "98101", "BEV", "T", "3", 2026, Decimal(7500), "APPROVED", None, None, T0)],
        INCENTIVE_APPLICATIONS,
    ).write.parquet(applications)
    cfg = run.Config(str(tmp_path / "in"), str(tmp_path / "root"), applications)
    outcome = run.refresh(spark, cfg)
    assert outcome == dict.fromkeys(run.STEPS, "SUCCESS")
    tables = run.load_all(spark, cfg)
    assert tables["bronze"].count() == 8 and tables["silver"].count() == tables["fact_registrations"].count() == 4
    assert tables["quarantine"].count() == 3
    assert tables["silver"].where("APPLICATION_STATUS = 'APPROVED'").first()["VIN"] == "A1"
    history = run.load(spark, cfg, "metric_history")
    assert history.count() == 7 and history.columns[-1] == "VALUE"
    log = {r["TASK_NAME"]: (r["RUN_STATUS"], r["ROW_COUNT"]) for r in run.load(spark, cfg, "run_log").collect()}
    assert log == {"ingest": ("SUCCESS", 1), "bronze": ("SUCCESS", 8), "silver": ("SUCCESS", 4), "gold": ("SUCCESS", 4),
                   "metrics": ("SUCCESS", None), "check": ("SUCCESS", 0)}

    put(tmp_path / "in", "faulty.json", faulty_registrations())
    outcome = run.refresh(spark, cfg)
    assert outcome["check"] == "FAILURE"  # the rows without VIN upset the reconciliation
    assert run.load(spark, cfg, "bronze").count() == 16 and run.load(spark, cfg, "raw").count() == 2
    assert run.load(spark, cfg, "metric_history").count() == 14
    status = {(r["TABLE_NAME"], r["METRIC_NAME"]): r["STATUS"] for r in quality.current_status(run.load(spark, cfg, "metric_history")).collect()}
    assert status[(quality.SILVER_NAME, quality.RECONCILIATION)] == "FAIL"
    assert status[(quality.QUARANTINE_NAME, quality.COMPLETENESS)] == "WARN"


def test_one_bad_record_costs_one_record(spark, tmp_path):
    body = json.loads(document([registration(f"A{k}") for k in range(1000)]))
    body["data"][500] = "oops"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(body))
    cfg = run.Config(str(tmp_path / "in"), str(tmp_path / "root"))
    outcome = run.refresh(spark, cfg)
    assert outcome["check"] == "FAILURE"  # one row without VIN upsets the reconciliation
    assert run.load(spark, cfg, "silver").count() == 999
    assert [r["record"] for r in run.load(spark, cfg, "rejected_records").collect()] == ["oops"]


def test_broken_step_leaves_the_tables_before(spark, tmp_path, monkeypatch):
    put(tmp_path / "in", "one.json", [registration("A1")])
    cfg = run.Config(str(tmp_path / "in"), str(tmp_path / "root"))
    run.refresh(spark, cfg)
    put(tmp_path / "in", "two.json", [registration("A2")])
    monkeypatch.setattr(run, "publish", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run.refresh(spark, cfg)
    monkeypatch.undo()
    assert run.load(spark, cfg, "bronze").count() == run.load(spark, cfg, "silver").count() == 1
    run.refresh(spark, cfg)
    assert run.load(spark, cfg, "bronze").count() == run.load(spark, cfg, "fact_registrations").count() == 2


class Stopped(Exception):
    pass


def stopping(cfg, at):
    def stop(step):
        if step == at:
            raise Stopped
    return dataclasses.replace(cfg, before_publish=stop)


@pytest.mark.parametrize("step", ["bronze", "silver", "gold"])
def test_a_run_that_ends_before_it_publishes_loses_nothing(spark, tmp_path, step):
    cfg = run.Config(str(tmp_path / "in"), str(tmp_path / "root"), buckets=4)
    put(tmp_path / "in", "one.json", [registration("A1"), registration("A2", COUNTY="Pierce")])
    run.refresh(spark, cfg)
    put(tmp_path / "in", "two.json", [registration("B1"), registration("A2", COUNTY="Kitsap")])
    with pytest.raises(Stopped):
        run.refresh(spark, stopping(cfg, step))
    assert {r["VIN"] for r in run.load(spark, cfg, "fact_registrations").collect()} == {"A1", "A2"}
    put(tmp_path / "in", "three.json", [registration("C1")])
    run.refresh(spark, cfg)
    found = run.load_all(spark, cfg)
    assert found["bronze"].count() == 5
    for name in ("silver", "fact_registrations", "dim_vehicle"):
        assert sorted(r["VIN"] for r in found[name].collect()) == ["A1", "A2", "B1", "C1"]
    assert {(r["COUNTY"], r["REGISTRATION_COUNT"]) for r in found["agg_by_county"].collect()} == {("KING", 3), ("KITSAP", 1)}
    assert {r["COUNTY"] for r in found["dim_geography"].collect()} == {"KING", "KITSAP"}


def test_rejected_documents_fail_the_check(spark, tmp_path):
    cfg = run.Config(str(tmp_path / "in"), str(tmp_path / "root"))
    put(tmp_path / "in", "good.json", [registration("A1")])
    short = document([registration(f"B{k}") for k in range(5)], [f for f in FIELDS if f != "make"])
    (tmp_path / "in" / "short.json").write_text(short)
    (tmp_path / "in" / "none.json").write_text("{cut off")
    assert run.refresh(spark, cfg)["check"] == "FAILURE"
    lost = run.load(spark, cfg, "metric_history").where("METRIC_NAME = 'RECORDS_LANDED_NOT_PARSED'").first()
    assert lost["VALUE"] == 6  # five records, and a document whose records cannot be counted
    assert {r["reason"] for r in run.load(spark, cfg, "document_faults").collect()} == {"lacks make", "not a JSON document"}
    put(tmp_path / "in", "more.json", [registration("A2")])
    run.refresh(spark, cfg)
    assert run.load(spark, cfg, "document_faults").count() == 2 and run.load(spark, cfg, "bronze").count() == 2


def test_only_touched_buckets_are_written(spark, tmp_path):
    applications = str(tmp_path / "applications")
    app = lambda k, vin: (k, vin, date(2026, 1, 1), "98101", "BEV", "T", "3", 2026, Decimal(7500), "APPROVED", None, None, T0)
    spark.createDataFrame([app(1, "V1")], INCENTIVE_APPLICATIONS).write.parquet(applications)
    cfg = run.Config(str(tmp_path / "in"), str(tmp_path / "root"), applications, buckets=16)
    put(tmp_path / "in", "one.json", [registration(f"V{k}") for k in range(64)])
    run.refresh(spark, cfg)
    put(tmp_path / "in", "two.json", [registration("V5", COUNTY="Pierce")])
    run.refresh(spark, cfg)
    at = store.published(spark, cfg.root)
    assert all(len(at[n].last.buckets) == 1 for n in ("latest", "silver", "quarantine", "dim_vehicle", "fact_registrations"))
    assert at["silver"].rows == 64 and run.load(spark, cfg, "silver").where("COUNTY = 'PIERCE'").count() == 1
    # a changed application touches its vehicle's bucket, without new bronze rows
    spark.createDataFrame([app(2, "V9")], INCENTIVE_APPLICATIONS).write.mode("append").parquet(applications)
    spark.catalog.refreshByPath(applications)
    run.refresh(spark, cfg)
    again = store.published(spark, cfg.root)
    assert len(again["silver"].last.buckets) == 1 and again["silver"].batch > at["silver"].batch
    assert {r["VIN"] for r in run.load(spark, cfg, "silver").where("APPLICATION_STATUS = 'APPROVED'").collect()} == {"V1", "V9"}
    # nothing new, nothing written
    run.refresh(spark, cfg)
    assert store.published(spark, cfg.root)["silver"].batch == again["silver"].batch
    health = run.written_health(spark, cfg).first()
    assert (health["bronze_parsed"], health["bronze_distinct_vins"], health["silver"], health["gold_fact"]) == (65, 64, 64, 64)
    assert health["reconciliation_status"].startswith("PASS") and health["raw_variant"] == 2


def test_cells_are_added_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(run, "COMPACT_EVERY", 2)
    cfg = run.Config(str(tmp_path / "in"), str(tmp_path / "root"), buckets=4)
    for k in range(5):
        put(tmp_path / "in", f"{k}.json", [registration("A1", COUNTY=f"C{k}"), registration(f"B{k}")])
        run.refresh(spark, cfg)
    assert len(store.published(spark, cfg.root)["cells"].plain) <= 2
    found = {(r["COUNTY"], r["REGISTRATION_COUNT"]) for r in run.load(spark, cfg, "agg_by_county").collect()}
    assert found == {("KING", 5), ("C4", 1)}


def test_fresh_layers_are_left_alone(spark, tmp_path):
    put(tmp_path / "in", "one.json", [registration("A1")])
    cfg = run.Config(str(tmp_path / "in"), str(tmp_path / "root"), silver_lag_minutes=60, gold_lag_minutes=0)
    assert run.refresh(spark, cfg)["silver"] == "SUCCESS"
    assert run.refresh(spark, cfg)["silver"] == "FRESH"


def test_strict_run_reconciles(spark, tmp_path):
    put(tmp_path / "in", "all.json", mixed_registrations() + faulty_registrations())
    cfg = run.Config(str(tmp_path / "in"), str(tmp_path / "root"), mode="strict", geography_grain="key")
    assert run.refresh(spark, cfg)["check"] == "SUCCESS"
    silver, quarantine = run.load(spark, cfg, "silver").count(), run.load(spark, cfg, "quarantine").count()
    assert (silver, quarantine) == (4, 4 + 2 + 8)


def test_failed_step_is_logged_and_raised(spark, tmp_path):
    cfg = run.Config(str(tmp_path / "in"), str(tmp_path / "root"))
    with pytest.raises(Exception):
        run.refresh(spark, cfg, only=["silver"])
    entry = run.load(spark, cfg, "run_log").first()
    assert (entry["TASK_NAME"], entry["RUN_STATUS"]) == ("silver", "FAILURE") and entry["ERROR_MESSAGE"]
    with pytest.raises(ValueError, match="unknown step"):
        run.refresh(spark, cfg, only=["platinum"])


def test_csv_lookups(spark, tmp_path):
    (tmp_path / "zips.csv").write_text("zip_code,population,median_income,ev_charging_stations\n98101,7,8,9\n")
    (tmp_path / "goals.csv").write_text("state,year,target_ev_count,policy_name\nWA,2026,11,Own Goal\n")
    put(tmp_path / "in", "one.json", [registration("A1")])
    cfg = run.Config(str(tmp_path / "in"), str(tmp_path / "root"), zips_csv=str(tmp_path / "zips.csv"), goals_csv=str(tmp_path / "goals.csv"))
    run.refresh(spark, cfg, only=["ingest", "bronze", "silver"])
    found = run.load(spark, cfg, "silver").first()
    assert (found["POPULATION"], found["TARGET_EV_COUNT"], found["POLICY_NAME"]) == (7, 11, "Own Goal")


def test_shared_folder_is_the_sessions(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named and new_folder(spark, "x").startswith(named)
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_missing_field_policy(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "short.json").write_text(document([registration("A1")], [f for f in FIELDS if f != "make"]))
    stop = run.Config(str(folder), str(tmp_path / "a"), on_missing="abort")
    with pytest.raises(Exception, match="lacks make"):
        run.refresh(spark, stop, only=["ingest", "bronze"])
    left_out = run.Config(str(folder), str(tmp_path / "c"))
    (folder / "good.json").write_text(document([registration("A2")]))
    run.refresh(spark, left_out, only=["ingest", "bronze"])
    assert [r["VIN"] for r in run.load(spark, left_out, "bronze").collect()] == ["A2"]
    assert [r["reason"] for r in run.load(spark, left_out, "document_faults").collect()] == ["lacks make"]
    (folder / "good.json").unlink()
    go_on = run.Config(str(folder), str(tmp_path / "b"), on_missing="null")
    run.refresh(spark, go_on, only=["ingest", "bronze"])
    assert run.load(spark, go_on, "bronze").first()["MAKE"] is None
