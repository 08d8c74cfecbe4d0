"""Documents cut by byte ranges against the same documents read whole."""

import json
import random

import pytest
from pyspark.sql import functions as F
from samples import document, registration

from platework.sources import documents, ranges

CONTRACT = [("a", "A", "string"), ("b", "B", "string")]
HEAD = {"view": {"name": "n", "columns": [{"fieldName": "a"}, {"fieldName": "b"}]}}
RECORDS = [["a]b\"[", "x\\"], [1, [2, {"k": "]"}], None], "oops", {"a": [1], "data": [3]}, None, ["é日\U0001f600"] * 9, [], [["data", [1]]]]
FAULTY = {
    "cut": '{"meta": ', "no-array": '{"meta":1,"data":{"a":[1]}}', "two-commas": '{"data":[[1],,[2]]}', "after": '{"data":[[1],[2]]} {}',
    "bad-record": '{"data":[[1],[x]]}', "lacks": '{"data":[[1]],"meta":{"view":{"columns":[{"fieldName":"b"}]}}}',
    "last-comma": '{"data":[[1],]}', "open": '{"data":[[1]', "open-string": '{"data":[["]]}',
}


def _file(column):
    return F.element_at(F.split(column, "/"), -1)


def _rows(df):
    return sorted(map(repr, df.select("A", "B", _file("SOURCE_FILE").alias("file"), "RECORD_POSITION").collect()))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path, rng = tmp_path_factory.mktemp("json"), random.Random(1)
    for i in range(9):
        data = rng.choices(RECORDS, k=[0, 1, 40][i // 3])
        doc = {"meta": HEAD, "x": {"data": [[1, 2]]}, "data": data, "y]": "]", "z": [[1]]}
        if i % 3 == 1:
            doc = {"d]ata": "]", "data": data, "meta": HEAD}
        (path / f"{i}.json").write_text(json.dumps(doc, ensure_ascii=i % 2 == 0, indent=None if i % 2 else 1))
    escaped = json.dumps({"meta": HEAD, "data": [["1", "2"]]}).replace('"data"', '"d\\u0061ta" ')
    (path / "escaped.json").write_text(escaped)
    for name, text in FAULTY.items():
        (path / f"{name}.json").write_text(text)
    (path / "empty.json").write_text("")
    return str(path)


@pytest.mark.parametrize("size", [64, 300, 1 << 20])
def test_ranges_give_the_rows_of_whole_files(spark, folder, size):
    raw = documents.with_lineage(spark.read.text(folder, wholetext=True))
    docs, records = ranges.split_documents(spark, folder, CONTRACT, range_bytes=size)
    whole = documents.parse_documents(documents.accept_documents(raw, "continue"), CONTRACT, on_missing="reject")
    assert _rows(ranges.parse_split(docs, records, CONTRACT, "reject")) == _rows(whole)
    faults = {tuple(r) for r in docs.where("fault IS NOT NULL").select(_file("source_file"), "fault").collect()}
    assert faults == {tuple(r) for r in documents.document_faults(raw, CONTRACT).select(_file("source_file"), "reason").collect()}
    assert {f.removesuffix(".json") for f, _ in faults} == set(FAULTY)


def test_ranges_are_many_and_settings_come_back(spark, folder):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    pieces = ranges.cut_documents(spark, folder, 300)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert pieces.where(F.col("source_file").endswith("/7.json")).select("at").distinct().count() > 3


def test_many_ranges_are_joined_by_shuffle(spark, folder, monkeypatch):
    docs, records = ranges.split_documents(spark, folder, CONTRACT, range_bytes=300)
    sent = _rows(ranges.parse_split(docs, records, CONTRACT, "reject"))
    monkeypatch.setattr(ranges, "FEW_RANGES", 0)
    docs, records = ranges.split_documents(spark, folder, CONTRACT, range_bytes=300)
    assert _rows(ranges.parse_split(docs, records, CONTRACT, "reject")) == sent


def test_stretches_within_a_range(spark, folder, monkeypatch):
    """The lexer's state is carried over, byte for byte."""
    text = json.dumps({"meta": HEAD, "data": RECORDS * 5}).encode()
    pieces = text.split(b"]")

    def cut(step):
        monkeypatch.setattr(ranges, "STEP_BYTES", step)
        cutter, out, held = ranges.Cutter(False, 0, False), [], b""
        for i, piece in enumerate(pieces):
            held += (b"]" if i else b"") + piece
            if len(held) > step:
                out += cutter.cut(held)
                held = b""
        return [r["part"] for r in [*out, *cutter.cut(held), *cutter.end()]]

    assert cut(0) == cut(50) == cut(1 << 20)
    assert [json.loads(p) for p in cut(0)[1:-1]] == RECORDS * 5


def test_faults_abort_and_data_named_twice(spark, tmp_path):
    (tmp_path / "twice.json").write_text(json.dumps({"meta": HEAD, "data": [["1", "2"]]})[:-1] + ',"data":[["3","4"]]}')
    docs, records = ranges.split_documents(spark, str(tmp_path), CONTRACT)
    assert docs.select("fault").first()[0] == "names data twice"
    with pytest.raises(Exception, match="names data twice"):
        ranges.parse_split(docs, records, CONTRACT).collect()
    with pytest.raises(ValueError, match="on_missing"):
        ranges.parse_split(docs, records, CONTRACT, "null")


def test_registrations(spark, tmp_path):
    (tmp_path / "r.json").write_text(document([registration(f"V{i}", CITY="Sea]ttle[") for i in range(50)]))
    docs, records = ranges.split_documents(spark, str(tmp_path), range_bytes=512)
    rows = ranges.parse_split(docs, records)
    whole = documents.parse_documents(documents.land_documents(spark, str(tmp_path)))
    columns = [c for c in whole.columns if c not in ("LOAD_TS", "LOADED_AT")]
    assert sorted(map(repr, rows.select(columns).collect())) == sorted(map(repr, whole.select(columns).collect()))
    assert docs.first()["records"] == 50
