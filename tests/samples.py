"""Small registrations and documents for the tests, made up here."""

from __future__ import annotations

import json
from datetime import datetime

from platework.schemas import BEV, CONTRACT, PHEV

BRONZE = (
    "VIN string, COUNTY string, CITY string, STATE string, POSTAL_CODE string, MODEL_YEAR int, MAKE string, "
    "MODEL string, EV_TYPE string, CAFV_ELIGIBILITY string, ELECTRIC_RANGE int, BASE_MSRP int, "
    "LEGISLATIVE_DISTRICT string, VEHICLE_LOCATION string, ELECTRIC_UTILITY string, CENSUS_TRACT string, "
    "LOAD_TS timestamp, LOADED_AT timestamp, SOURCE_FILE string, RECORD_POSITION long"
)
T0, T1 = datetime(2026, 1, 1), datetime(2026, 1, 2)


def registration(vin="A1", **over) -> dict:
    row = {
        "VIN": vin, "COUNTY": "King", "CITY": "Seattle", "STATE": "WA", "POSTAL_CODE": "98101", "MODEL_YEAR": 2026,
        "MAKE": "Tesla", "MODEL": "Model 3", "EV_TYPE": BEV, "CAFV_ELIGIBILITY": "Eligible", "ELECTRIC_RANGE": 270,
        "BASE_MSRP": 40000, "LEGISLATIVE_DISTRICT": "43", "VEHICLE_LOCATION": "POINT (-122.5 47.25)",
        "ELECTRIC_UTILITY": "CITY LIGHT", "CENSUS_TRACT": "53033000101", "LOAD_TS": T0, "LOADED_AT": T0,
        "SOURCE_FILE": "a.json", "RECORD_POSITION": 0,
    }
    unknown = set(over) - set(row)
    assert not unknown, unknown
    return {**row, **over}


def bronze(spark, rows: list[dict]):
    names = [c.strip().split(" ")[0] for c in BRONZE.split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], BRONZE)


def faulty_registrations() -> list[dict]:
    """Eight rows without one that is valid: four without VIN, two of unknown type, two with negative range."""
    return [
        registration(None, RECORD_POSITION=0), registration(None, RECORD_POSITION=1, CITY="Tacoma"),
        registration(None, RECORD_POSITION=2, CITY="Everett"),
        registration("B4", EV_TYPE="Gasoline Vehicle (INVALID TYPE)"), registration("B5", ELECTRIC_RANGE=-50),
        registration("B6", EV_TYPE="Hydrogen Fuel Cell (INVALID)"), registration(None, RECORD_POSITION=6, CITY="Yakima"),
        registration("B8", ELECTRIC_RANGE=-999),
    ]


FIELDS = [":sid", ":id", *[source for source, _, _ in CONTRACT[:13]], "dol_vehicle_id", *[source for source, _, _ in CONTRACT[13:]]]


def document(rows: list[dict], fields: list[str] | None = None, name: str = "Vehicles") -> str:
    """Registrations as a self-describing document; numbers travel as text."""
    fields = fields or FIELDS
    column = {source: target for source, target, _ in CONTRACT}
    extra = {":sid": "row-1", ":id": 7, "dol_vehicle_id": "999"}
    data = []
    for row in rows:
        cells = [row[column[f]] if f in column else extra.get(f) for f in fields]
        data.append([str(c) if isinstance(c, int) and f in column else c for f, c in zip(fields, cells)])
    view = {"id": "x", "name": name, "columns": [{"id": -1, "fieldName": f, "position": 1} for f in fields]}
    return json.dumps({"meta": {"view": view}, "data": data})


def mixed_registrations() -> list[dict]:
    """Every case the layers have a rule for."""
    return [
        registration("A1", LOAD_TS=T0, MODEL="Old"), registration("A1", LOAD_TS=T1, MODEL="New"),
        registration("A2", EV_TYPE=PHEV, POSTAL_CODE="98999", MODEL_YEAR=None),
        registration("A3", ELECTRIC_RANGE=None, VEHICLE_LOCATION="unknown", LEGISLATIVE_DISTRICT="44"),
        registration("A4", EV_TYPE=None), registration("A5", EV_TYPE=None, ELECTRIC_RANGE=-5),
        registration("A6", COUNTY=None, CITY=None, POSTAL_CODE=None, STATE="OR"),
        registration(None), registration(None, RECORD_POSITION=1),
        registration("A7", EV_TYPE="Gasoline"), registration("A8", ELECTRIC_RANGE=-1),
    ]
