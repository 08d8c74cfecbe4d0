"""Compare queries with their SQL on the driver's tables: ``python tests/parity.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value.isoformat() if hasattr(value, "isoformat") else value


def _kind(name: str) -> str:
    same = {"string": "varchar", "bigint": "bigint", "int": "integer", "double": "double", "boolean": "boolean",
            "timestamp_ntz": "timestamp", "timestamp": "timestamp", "date": "date"}
    return same.get(name, name)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a DataFrame and the SQL's result, or None."""
    result = con.execute(sql)
    theirs_types = {c[0]: str(c[1]).lower() for c in result.description}
    ours_types = {f.name: _kind(f.dataType.simpleString()) for f in df.schema}
    if ours_types != theirs_types:
        changed = {k: (ours_types.get(k), theirs_types.get(k)) for k in {*ours_types, *theirs_types}
                   if ours_types.get(k) != theirs_types.get(k)}
        return f"columns differ (ours, theirs): {changed}"
    names = sorted(ours_types)
    order = [[c[0] for c in result.description].index(n) for n in names]
    theirs = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    ours = Counter(tuple(_plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    if ours == theirs:
        return None
    only_ours, only_theirs = list((ours - theirs).elements()), list((theirs - ours).elements())
    return (f"{sum(ours.values())} rows against {sum(theirs.values())}; only ours {len(only_ours)}: "
            f"{sorted(only_ours, key=repr)[:2]}; only theirs {len(only_theirs)}: {sorted(only_theirs, key=repr)[:2]} of {names}")


def main(sf_dir: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from platework.session import get_session

    spark = get_session("parity", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            found = difference(df, con, sqls[name]) if name in sqls else f"no SQL, {df.count()} rows"
        except Exception as error:  # the run goes on, the query is reported
            found = f"{type(error).__name__}: {str(error)[:600]}"
        mark = "ok  " if found is None else ("rows" if found.startswith("no SQL") else "BAD ")
        bad += mark == "BAD "
        print(f"{mark} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    arguments = sys.argv[1:]
    directory = arguments.pop(0) if arguments and "/" in arguments[0] else "/root/testdata/sf0.01"
    sys.exit(1 if main(directory, arguments) else 0)
