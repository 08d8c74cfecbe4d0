"""Measures by dimensions over the star: ``semantic_query(tables, measures, dims, filters)``.

A measure is kept as partial aggregates and an expression over them; those of the fact and of
applications can be summed again. That is what lets applications be grouped by VIN before they meet the
fact (a vehicle with three applications stays one registration) and the fact by place before it meets
the geography.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """``partials`` are aggregates by name and ``final`` an expression over them, as SQL text."""

    partials: dict[str, str]
    final: str
    needs: tuple[str, ...] = ()


@dataclass(frozen=True)
class Link:
    """A left, many-to-one relationship. ``shared`` says that many rows have the same key."""

    table: str
    key: str
    shared: bool = False


@dataclass(frozen=True)
class Table:
    """Measures by name, and relationships by the column that holds the other table's key."""

    measures: dict[str, Measure]
    time_dimensions: tuple[str, ...] = ()
    links: dict[str, Link] = field(default_factory=dict)


# The named measures and relationships of the model.
MODEL = {
    "fact_registrations": Table(
        measures={
            "registration_count": Measure({"regs": "count(VIN)"}, "regs"),
            "avg_electric_range": Measure(
                {"range_sum": "sum(ELECTRIC_RANGE)", "range_n": "count(ELECTRIC_RANGE)"},
                "try_divide(cast(range_sum as double), range_n)",
                needs=("ELECTRIC_RANGE",),
            ),
        },
        time_dimensions=("MODEL_YEAR",),
        links={"VIN": Link("dim_vehicle", "VIN"), "GEO_KEY": Link("dim_geography", "GEO_KEY", shared=True)},
    ),
    "dim_vehicle": Table(measures={}),
    "dim_geography": Table(measures={}),
    "agg_by_year": Table(
        measures={
            "total_registrations": Measure({"total": "sum(REGISTRATION_COUNT)"}, "total"),
            "latest_cumulative": Measure({"cumulative": "max(CUMULATIVE_COUNT)"}, "cumulative"),
            "goal_progress_pct": Measure({"progress": "max(PCT_OF_GOAL)"}, "progress * 100"),
        },
        time_dimensions=("MODEL_YEAR",),
    ),
    "agg_by_county": Table(
        measures={
            "total_registrations": Measure({"total": "sum(REGISTRATION_COUNT)"}, "total"),
            "avg_per_capita": Measure({"per_capita": "avg(REGISTRATIONS_PER_CAPITA)"}, "per_capita"),
        },
    ),
    "incentive_applications": Table(
        measures={
            "total_applications": Measure({"apps": "count(application_id)"}, "coalesce(apps, 0)"),
            "approval_rate": Measure(
                {"apps": "count(application_id)", "approved": "count_if(status = 'APPROVED')"},
                "try_divide(approved * 100.0D, apps)",
            ),
            "total_incentive_amount": Measure(
                {"amount": "sum(CASE WHEN status = 'APPROVED' THEN incentive_amount ELSE 0 END)"}, "amount"
            ),
            "pending_count": Measure({"pending": "count_if(status = 'PENDING')"}, "coalesce(pending, 0)"),
            "denied_count": Measure({"denied": "count_if(status = 'DENIED')"}, "coalesce(denied, 0)"),
        },
        time_dimensions=("submitted_date",),
    ),
}

FACT = "fact_registrations"
APPLICATIONS = "incentive_applications"


def resolve_measure(name: str) -> tuple[str, str]:
    """(table, measure) of a plain or ``table.measure`` name."""
    if "." in name:
        table, measure = name.split(".", 1)
        owners = [table] if measure in MODEL.get(table, Table({})).measures else []
    else:
        measure = name
        owners = [t for t, entry in MODEL.items() if name in entry.measures]
    if len(owners) != 1:
        raise ValueError(f"measure {name!r} is {'ambiguous between ' + str(owners) if owners else 'unknown'}")
    return owners[0], measure


def _partials(measures: list[Measure]) -> dict[str, str]:
    merged: dict[str, str] = {}
    for m in measures:
        merged.update(m.partials)
    return merged


def _linked_columns(tables: dict[str, DataFrame], base: str, wanted: set[str]) -> dict[str, list[str]]:
    """Which wanted columns come through which link to a table at hand; those of the base itself and of earlier links
    first."""
    missing = wanted - set(tables[base].columns)
    found = {}
    for column, link in MODEL[base].links.items():
        if link.table not in tables:
            continue
        found[column] = sorted(missing & set(tables[link.table].columns))
        missing -= set(found[column])
    if missing:
        raise ValueError(f"{base} does not reach column(s) {sorted(missing)}")
    return found


def _join_link(df: DataFrame, tables: dict[str, DataFrame], column: str, link: Link, extra: list[str]) -> DataFrame:
    """Many-to-one whatever the linked table's grain: of several rows of a key the smallest is taken, in the order of
    its columns as text, so that no row of ``df`` is multiplied."""
    table = tables[link.table]
    order = F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(table.columns)])
    side = table.where(F.col(link.key).isNotNull()).groupBy(F.col(link.key).alias("__link")).agg(
        F.min_by(F.struct(*extra), order).alias("__row")
    ).select("__link", *[F.col(f"__row.{c}").alias(c) for c in extra])
    return df.join(side, df[column] == side["__link"], "left").drop("__link")


def measures_over_time(
    tables: dict[str, DataFrame], measures: list[str], dims: list[str] = (), filters: dict[str, Column] | None = None
) -> DataFrame:
    """``semantic_query`` by the time dimension of the first measure's table, and by ``dims``, in time order."""
    table, _ = resolve_measure(measures[0])
    times = list(MODEL[table].time_dimensions)
    if not times:
        raise ValueError(f"{table} has no time dimension")
    return semantic_query(tables, measures, [*times, *dims], filters).orderBy(*times, *dims)


def semantic_query(
    tables: dict[str, DataFrame],
    measures: list[str],
    dims: list[str] = (),
    filters: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per combination of dimensions, with the measures as columns.

    ``filters`` maps a column to a condition on it. Measures of the fact and of applications may be
    asked for together or by the other's dimensions; those of an aggregate table stand alone. By a
    dimension of applications a registration counts once in each group that it has an application in,
    and in that of NULL if it has none; a filter on applications leaves the registrations that have one
    that passes.
    """
    filters = filters or {}
    dims = list(dims)
    wanted: dict[str, dict[str, Measure]] = {}
    for name in measures:
        table, measure = resolve_measure(name)
        wanted.setdefault(table, {})[measure] = MODEL[table].measures[measure]
    bases = set(wanted)
    used = set(dims) | set(filters)
    if bases == {APPLICATIONS} and used <= set(tables[APPLICATIONS].columns):
        base, nested = APPLICATIONS, {}
    elif bases <= {FACT, APPLICATIONS}:
        base, nested = FACT, wanted.get(APPLICATIONS, {})
    elif len(bases) == 1:
        base, nested = next(iter(bases)), {}
    else:
        raise ValueError(f"no relationship joins {sorted(bases)}")

    own = wanted.get(base, {})
    of_apps: set[str] = set()
    if base == FACT and APPLICATIONS in tables:
        reached = {c for t in [FACT, *[link.table for link in MODEL[FACT].links.values()]] if t in tables for c in tables[t].columns}
        of_apps = {c for c in used - reached if c in tables[APPLICATIONS].columns}
    columns = _linked_columns(tables, base, (used - of_apps) | {n for m in own.values() for n in m.needs})
    links = MODEL[base].links
    late = [c for c, extra in columns.items() if extra and links[c].shared]
    late_columns = {e for c in late for e in columns[c]}

    df = tables[base]
    for column, extra in columns.items():
        if extra and column not in late:
            df = _join_link(df, tables, column, links[column], extra)
    for name, condition in filters.items():
        if name not in late_columns | of_apps:
            df = df.where(condition)

    aggregates = {f"__{p}": F.expr(c) for p, c in _partials(list(own.values())).items()}
    if nested or of_apps:
        partials = _partials(list(nested.values()))
        passing, app_dims = tables[APPLICATIONS], [c for c in dims if c in of_apps]
        for name in sorted(of_apps & set(filters)):
            passing = passing.where(filters[name])
        per_vin = passing.groupBy(F.col("vin").alias("__app_vin"), *app_dims).agg(
            F.count(F.lit(1)).alias("__apps"), *[F.expr(c).alias(f"__app_{p}") for p, c in partials.items()]
        )
        how = "inner" if of_apps & set(filters) else "left"
        df = df.join(per_vin, df["VIN"] == per_vin["__app_vin"], how).drop("__app_vin", "__apps")
        aggregates |= {f"__{p}": F.sum(f"__app_{p}") for p in partials}

    if late:
        # Group by the shared key first: a place with a third of all vehicles joins as a few rows.
        early = sorted(set(late) | (set(dims) - late_columns))
        df = df.groupBy(*early).agg(*[c.alias(name) for name, c in aggregates.items()])
        aggregates = {name: F.sum(name) for name in aggregates}
        for column in late:
            df = _join_link(df, tables, column, links[column], columns[column])
        for name in late_columns & set(filters):
            df = df.where(filters[name])

    grouped = df.groupBy(*dims).agg(*[c.alias(name) for name, c in aggregates.items()])
    everything = {**own, **nested}
    merged = grouped.withColumnsRenamed({f"__{p}": p for m in everything.values() for p in m.partials})
    return merged.select(*dims, *[F.expr(everything[resolve_measure(n)[1]].final).alias(n.split(".")[-1]) for n in measures])


def drill_across(
    tables: dict[str, DataFrame],
    measures: list[str],
    dims: list[str] = (),
    filters: dict[str, Column] | None = None,
) -> DataFrame:
    """Measures of tables of different grain in one answer: each table is grouped by itself, by the dimensions that all of
    them reach, and the groups are put side by side. No table's rows are multiplied by another's, so totals are those of
    each table alone; a group that one table lacks has NULL in its measures. Filters must be on columns that all reach.
    Measures of one name come as ``table_measure``.
    """
    short = [n.split(".")[-1] for n in measures]
    names = {n: n.replace(".", "_") if short.count(s) > 1 else s for n, s in zip(measures, short, strict=True)}
    by_table: dict[str, list[str]] = {}
    for name in measures:
        by_table.setdefault(resolve_measure(name)[0], []).append(name)
    merged = None
    for own in by_table.values():
        one = semantic_query(tables, own, dims, filters).withColumnsRenamed({n.split(".")[-1]: names[n] for n in own})
        merged = one if merged is None else _side_by_side(merged, one, list(dims))
    return merged.select(*dims, *names.values())


def _side_by_side(left: DataFrame, right: DataFrame, dims: list[str]) -> DataFrame:
    """Full outer join of grouped rows; nulls are dimensions like any other, so that the side decides whose are taken."""
    keys = {d: f"__{d}" for d in dims}
    right = right.withColumnsRenamed(keys).withColumn("__right", F.lit(1))
    left = left.withColumn("__left", F.lit(1))
    same = left["__left"] == right["__right"]
    for d, k in keys.items():
        same = same & left[d].eqNullSafe(right[k])
    measured = [c for c in [*left.columns, *right.columns] if c not in {*dims, *keys.values(), "__left", "__right"}]
    return left.join(right, same, "full").select(
        *[F.when(F.col("__left").isNotNull(), F.col(d)).otherwise(F.col(k)).alias(d) for d, k in keys.items()], *measured)
