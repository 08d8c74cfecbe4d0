import json

import pytest
from pyspark.sql import functions as F
from samples import FIELDS, document, faulty_registrations, registration

from platework.schemas import CONTRACT
from platework.sources import documents
from platework.sources.tables import literal_table, load_reference, small_result, state_goals, zip_demographics
from platework.schemas import STATE_GOALS, ZIP_DEMOGRAPHICS

COLUMNS = [column for _, column, _ in CONTRACT]


def landed(spark, texts):
    return spark.createDataFrame([(t, f"f{i}.json") for i, t in enumerate(texts)], "raw_data string, source_file string").withColumn(
        "loaded_at", F.current_timestamp()
    )


def test_round_trip(spark):
    sent = faulty_registrations()
    found = documents.parse_documents(landed(spark, [document(sent)])).orderBy("RECORD_POSITION").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in found] == [tuple(s[c] for c in COLUMNS) for s in sent]
    assert [r["RECORD_POSITION"] for r in found] == list(range(8))
    assert len({r["LOAD_TS"] for r in found}) == 1


def test_each_document_is_read_by_its_own_header(spark):
    texts = [document([registration("A1")]), document([registration("A2", CITY="Yakima")], list(reversed(FIELDS)))]
    found = {r["VIN"]: r for r in documents.parse_documents(landed(spark, texts)).collect()}
    assert found["A1"]["CITY"] == "Seattle" and found["A2"]["CITY"] == "Yakima"
    assert found["A2"]["MODEL_YEAR"] == 2026 and found["A2"]["SOURCE_FILE"] == "f1.json"


def test_new_fields_are_ignored(spark):
    text = document([registration()], ["brand_new", *FIELDS])
    assert documents.parse_documents(landed(spark, [text])).first()["VIN"] == "A1"


def test_missing_field_raises_or_gives_null(spark):
    raw = landed(spark, [document([registration()]), document([registration("A2")], [f for f in FIELDS if f != "make"])])
    with pytest.raises(Exception, match="lacks make"):
        documents.parse_documents(raw).collect()
    found = documents.parse_documents(raw, on_missing="null").where("VIN = 'A2'").first()
    assert found["MAKE"] is None and found["MODEL"] == "Model 3"
    assert [tuple(r) for r in documents.contract_violations(raw).collect()] == [("f1.json", ["make"])]


def test_missing_field_raises_even_without_records(spark):
    raw = landed(spark, [document([], ["vin_1_10"])])
    with pytest.raises(Exception, match="lacks county"):
        documents.parse_documents(raw).collect()


def test_short_rows_and_unreadable_numbers(spark):
    body = json.loads(document([registration(), registration("A2")]))
    body["data"][0] = body["data"][0][:5]
    at = FIELDS.index("electric_range")
    for token, expected in (("12.7", None), ("abc", None), ("", None), (" 30 ", 30), (31, 31), (None, None)):
        body["data"][1][at] = token
        first, second = documents.parse_documents(landed(spark, [json.dumps(body)])).orderBy("RECORD_POSITION").collect()
        assert first["COUNTY"] == "King" and first["CITY"] == "Seattle" and first["STATE"] is None
        assert second["ELECTRIC_RANGE"] == expected


def test_nested_cells_are_json_text(spark):
    body = json.loads(document([registration()]))
    body["data"][0][FIELDS.index("geocoded_column")] = {"lat": 1, "note": [1, None]}
    found = documents.parse_documents(landed(spark, [json.dumps(body)])).first()
    assert found["VEHICLE_LOCATION"] == '{"lat":1,"note":[1,null]}'


def test_empty_document_gives_no_rows_and_a_profile(spark):
    raw = landed(spark, [document([], name="None yet")])
    assert documents.parse_documents(raw).count() == 0
    profile = documents.profile_documents(raw).first()
    assert (profile["top_level_keys"], profile["record_count"], profile["dataset_name"]) == (["meta", "data"], 0, "None yet")


def test_parsing_decodes_a_document_once(spark):
    raw = landed(spark, [document([registration()])]).repartition(2)
    plan = documents.parse_documents(raw)._jdf.queryExecution().executedPlan().toString()
    # One for the document, and one for the cells of a record.
    assert plan.count("from_json(StructField(meta") == 1 and plan.count("from_json(ArrayType(StringType") == 1


def test_landing_policies(spark, tmp_path):
    (tmp_path / "good.json").write_text(document([registration()]))
    (tmp_path / "bad.json").write_text('{"meta": ')
    raw = documents.land_documents(spark, str(tmp_path), on_error="continue")
    assert [r["source_file"].rsplit("/", 1)[-1] for r in raw.collect()] == ["good.json"]
    with pytest.raises(Exception, match="not a JSON document.*bad.json"):
        documents.land_documents(spark, str(tmp_path)).collect()
    everything = documents.with_lineage(spark.read.text(str(tmp_path), wholetext=True))
    assert documents.rejected_documents(everything).count() == 1
    with pytest.raises(ValueError, match="on_error"):
        documents.accept_documents(everything, "skip")


def test_reference_csv_is_typed(spark, tmp_path):
    path = tmp_path / "zips.csv"
    path.write_text("zip_code,population,median_income,ev_charging_stations\n01234,10,20,\n98101,35000,95000,42\n")
    found = load_reference(spark, str(path), ZIP_DEMOGRAPHICS)
    assert [tuple(r) for r in found.collect()] == [("01234", 10, 20, None), ("98101", 35000, 95000, 42)]
    path.write_text("zip_code,population,median_income,ev_charging_stations\n98101,many,95000,42\n")
    with pytest.raises(Exception):
        load_reference(spark, str(path), ZIP_DEMOGRAPHICS).collect()


def test_built_in_lookups(spark):
    for table, schema in ((zip_demographics(spark), ZIP_DEMOGRAPHICS), (state_goals(spark), STATE_GOALS)):
        assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in schema]
    assert (zip_demographics(spark).count(), state_goals(spark).count()) == (15, 11)


@pytest.mark.parametrize("text, good", [
    ('{"a": [1, {"b": null}]}', True), ("[1, 2]", True), ("[]", True), ("{}", True), ("", False), ("abc", False),
    ('{"a": ', False), ('{"a": [1, }]}', False), ('{"a": {"b": [1, 2}', False), ("[1, 2", False), (None, False),
])
def test_is_json(spark, text, good):
    raw = spark.createDataFrame([(text,)], "raw_data string")
    assert raw.where(documents.is_json()).count() == int(good)


def test_a_document_beyond_the_size_of_a_variant_is_accepted(spark):
    long = F.concat(F.lit('{"data": ["'), F.repeat(F.lit("x"), 140 * 1024 * 1024), F.lit('"]}'))
    raw = spark.range(1).select(long.alias("raw_data"), F.lit("f").alias("source_file"))
    assert documents.accept_documents(raw, "continue").select(F.length("raw_data")).first()[0] > 140 * 1024 * 1024


def test_small_result(spark):
    assert len(small_result(spark.range(3), max_rows=3)) == 3
    with pytest.raises(ValueError, match="more than 3"):
        small_result(spark.range(4), max_rows=3)


def test_literal_table_quotes_text(spark):
    rows = [("it's", 1), ("back\\slash", None), (None, 2)]
    assert [tuple(r) for r in literal_table(spark, rows, "t string, n int").collect()] == rows
