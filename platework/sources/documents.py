"""Landing and decoding of self-describing JSON documents, one row per file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platework.functions import documents as d
from platework.functions.text import to_int
from platework.schemas import CONTRACT

LANDED = ["raw_data", "loaded_at", "source_file"]


def is_json(raw: str = "raw_data") -> Column:
    """Whether the text is a whole JSON object or array, of any length (a variant has a size limit)."""
    return d.is_whole_json(raw)


def with_lineage(files: DataFrame, now: Column | None = None) -> DataFrame:
    """Whole-file text rows as landed documents; a file is one row, so keep files to a few hundred MB."""
    return files.select(
        F.col("value").alias("raw_data"),
        (F.current_timestamp() if now is None else now).alias("loaded_at"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def accept_documents(raw: DataFrame, on_error: str = "abort") -> DataFrame:
    """Landed rows whose text is JSON. "abort" fails the load at the first bad file; "continue" skips it."""
    if on_error == "continue":
        return raw.where(is_json())
    if on_error != "abort":
        raise ValueError(f"on_error must be 'abort' or 'continue', not {on_error!r}")
    return only_good(raw, is_json(), F.concat(F.lit("not a JSON document: "), F.col("source_file")))


def only_good(rows: DataFrame, good: Column, message: Column) -> DataFrame:
    """All rows; one that is not good fails the job, whichever columns are asked for: the test is a filter."""
    return rows.where(F.when(good, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def land_documents(
    spark: SparkSession, path: str | list[str], on_error: str = "abort", now: Column | None = None
) -> DataFrame:
    """Read whole JSON files with load time and source file."""
    return accept_documents(with_lineage(spark.read.text(path, wholetext=True), now), on_error)


def rejected_documents(raw: DataFrame) -> DataFrame:
    """Source files that "continue" skips."""
    return raw.where(~is_json()).select("source_file", "loaded_at")


def profile_documents(raw: DataFrame) -> DataFrame:
    """Top-level keys, number of records and dataset name per landed document."""
    outline = raw.select("raw_data", "loaded_at", "source_file", d.outline("raw_data").alias("doc"))
    return outline.select(
        d.object_keys("raw_data").alias("top_level_keys"),
        d.array_size(F.col("doc.data")).alias("record_count"),
        F.col("doc.meta.view.name").alias("dataset_name"),
        "loaded_at",
        "source_file",
    )


def contract_violations(raw: DataFrame, contract=CONTRACT) -> DataFrame:
    """Documents whose header lacks required fields, with the fields they lack."""
    names = d.field_names(d.decode("raw_data"))
    missing = d.missing_fields(names, [field for field, _, _ in contract])
    return raw.select("source_file", missing.alias("missing")).where(F.size("missing") > 0)


def document_faults(raw: DataFrame, contract=CONTRACT) -> DataFrame:
    """Documents that cannot be parsed by the contract, with the reason: no JSON, no array of records, or fields that
    the header lacks."""
    return _decoded(raw, "source_file", "loaded_at", good=is_json()).select("source_file", "loaded_at", fault_of(contract).alias("reason")).where("reason is not null")


def _decoded(raw: DataFrame, *columns: str, good: Column | None = None) -> DataFrame:
    """``columns`` and the decoded document as ``doc``.

    It comes out of a generator: tests on it then stay above, instead of being pushed down to the text, which would
    be decoded again for each of them.
    """
    doc = d.decode("raw_data") if good is None else F.when(good, d.decode("raw_data"))
    return raw.select(*columns, F.inline_outer(F.array(F.struct(doc.alias("doc")))))


def decoded_documents(raw: DataFrame, contract=CONTRACT) -> DataFrame:
    """Landed documents, decoded: load time, file, ``accepted``, the header's ``names``, the texts of the records (``data``)
    and the ``fault``. To be stored where several tables are made of it. Rows of ``raw`` may be marked ``accepted``; the
    text of others is not looked at."""
    raw = raw if "accepted" in raw.columns else raw.withColumn("accepted", F.lit(True))
    docs = _decoded(raw, "loaded_at", "source_file", "accepted", good=F.col("accepted"))
    return docs.select(
        "loaded_at", "source_file", "accepted", d.field_names(F.col("doc")).alias("names"), F.col("doc.data").alias("data"),
        fault_of(contract).alias("fault"))


def fault_of(contract) -> Column:
    """Why the decoded document ``doc`` cannot be parsed by the contract; NULL if it can."""
    missing = d.missing_fields(d.field_names(F.col("doc")), [field for field, _, _ in contract])
    return (
        F.when(F.col("doc").isNull(), F.lit("not a JSON document"))
        .when(F.col("doc.data").isNull(), F.lit("has no array of records"))
        .when(F.size(missing) > 0, F.concat(F.lit("lacks "), F.array_join(missing, ", ")))
    )


def landed_records(raw: DataFrame, contract=CONTRACT) -> DataFrame:
    """One row: how many records the documents hold, and of them those in documents without a fault."""
    rows = _decoded(raw).select(
        F.coalesce(d.array_size(F.col("doc.data")), F.lit(0)).cast("long").alias("n"), fault_of(contract).alias("fault"))
    return rows.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.coalesce(F.sum(F.when(F.col("fault").isNull(), F.col("n"))), F.lit(0)).alias("parsable"),
        F.count("fault").alias("rejected_documents"))


def rejected_records(raw: DataFrame) -> DataFrame:
    """Records that are no arrays: their text, document and place. Bronze has a row without values for each."""
    return records_without_cells(_decoded(raw, "source_file", "loaded_at").withColumn("data", F.col("doc.data")))


def records_without_cells(docs: DataFrame) -> DataFrame:
    """``rejected_records`` of decoded documents."""
    rows = docs.select("source_file", "loaded_at", F.posexplode_outer("data").alias("position", "record"))
    return rows.where(F.col("position").isNotNull() & d.record_cells("record").isNull()).select(
        "source_file", "loaded_at", F.col("position").cast("long").alias("RECORD_POSITION"), "record")


def typed_cell(cell: Column, kind: str, int_cast: Callable[[Column], Column] = to_int) -> Column:
    if kind == "string":
        return cell
    return int_cast(cell) if kind == "int" else cell.try_cast(kind)


def parse_documents(
    raw: DataFrame,
    contract=CONTRACT,
    on_missing: str = "abort",
    load_ts: Column | None = None,
    partitions: int | None = None,
    int_cast: Callable[[Column], Column] = to_int,
) -> DataFrame:
    """Explode landed documents into rows of the contract's columns, load time and lineage.

    Every document is read by its own header: extra fields are ignored, reordered ones followed. A
    document whose header lacks a required field, or whose records are no array, raises; with
    ``on_missing="reject"`` it is left out (``document_faults`` names it), with "null" a missing field
    is NULL. A record that is no array gives a row of NULLs (``rejected_records`` has its text), one
    shorter than its header NULLs at the end. ``int_cast`` reads integers: by default a fraction is none,
    ``to_rounded_int`` rounds it. ``partitions`` spreads the rows when a few large files
    make few tasks.
    """
    docs = _decoded(raw, "loaded_at", "source_file").select(
        "loaded_at", "source_file", d.field_names(F.col("doc")).alias("names"), F.col("doc.data").alias("data"),
        *([] if on_missing == "null" else [fault_of(contract).alias("fault")]))
    return document_rows(docs, contract, on_missing, load_ts, partitions, int_cast)


def document_rows(
    docs: DataFrame,
    contract=CONTRACT,
    on_missing: str = "abort",
    load_ts: Column | None = None,
    partitions: int | None = None,
    int_cast: Callable[[Column], Column] = to_int,
) -> DataFrame:
    """``parse_documents`` of decoded documents."""
    if on_missing not in ("abort", "reject", "null"):
        raise ValueError(f"on_missing must be 'abort', 'reject' or 'null', not {on_missing!r}")
    fields = [field for field, _, _ in contract]
    if on_missing != "null":
        message = F.concat(F.col("source_file"), F.lit(" "), F.col("fault"))
        docs = docs.where("fault is null") if on_missing == "reject" else only_good(docs, F.col("fault").isNull(), message)
    positions = F.struct(*[d.field_position(F.col("names"), f).alias(f"p{i}") for i, f in enumerate(fields)])
    rows = (
        docs.select("loaded_at", "source_file", positions.alias("at"), "data")
        # The outer form, then a filter: the plain one makes Spark test the array below the decoding,
        # which decodes every document twice.
        .select("loaded_at", "source_file", "at", F.posexplode_outer("data").alias("position", "record"))
        .where(F.col("position").isNotNull())
    )
    if partitions:
        rows = rows.repartition(partitions)
    return contract_rows(rows, contract, load_ts, int_cast)


def contract_rows(
    rows: DataFrame, contract=CONTRACT, load_ts: Column | None = None, int_cast: Callable[[Column], Column] = to_int
) -> DataFrame:
    """The contract's columns of records, ``at`` holding each field's position in the record's header."""
    rows = rows.select("loaded_at", "source_file", "at", "position", d.record_cells("record").alias("row"))
    cells = [
        typed_cell(F.get(F.col("row"), F.col(f"at.p{i}")), kind, int_cast).alias(column)
        for i, (_, column, kind) in enumerate(contract)
    ]
    return rows.select(
        *cells,
        (F.current_timestamp() if load_ts is None else load_ts).alias("LOAD_TS"),
        F.col("loaded_at").alias("LOADED_AT"),
        F.col("source_file").alias("SOURCE_FILE"),
        F.col("position").cast("long").alias("RECORD_POSITION"),
    )


def field_report(raw: DataFrame, contract=CONTRACT) -> DataFrame:
    """Drift of headers and cells against the contract, a row per field: ``in_contract``, ``documents`` whose header has it,
    ``lacking`` (documents with a header that have not), ``cells`` (records that reach it), ``filled`` and ``cell_type``, the
    type that all its cells fit.

    Each text is parsed once, into a variant; header and records are read from that. Texts that are no JSON or have no
    header are not counted. Of fields that a header names twice the last counts, as in parsing.
    """
    contract_names = [field for field, _, _ in contract]
    parsed = raw.select("source_file", F.inline_outer(F.array(F.struct(F.try_parse_json("raw_data").alias("doc")))))
    heads = parsed.select(
        "source_file", "doc", F.transform(
            F.try_variant_get("doc", "$.meta.view.columns", "array<struct<fieldName string>>"), lambda c: c["fieldName"]).alias("names"),
    ).where("names IS NOT NULL")
    spark = raw.sparkSession
    records = heads.lateralJoin(
        spark.tvf.variant_explode(F.try_variant_get(F.col("doc"), "$.data", "variant").outer()).toDF("record_pos", "record_key", "record"))
    cells = records.select("names", "record").lateralJoin(
        spark.tvf.variant_explode(F.col("record").outer()).toDF("cell_pos", "cell_key", "cell"))
    name = F.get("names", F.col("cell_pos"))
    last = F.size("names") - F.array_position(F.reverse("names"), name)
    by_field = cells.where((F.col("cell_pos") == last) & F.col("cell_key").isNull()).groupBy(name.alias("field")).agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(~F.is_variant_null("cell")).alias("filled"),
        F.schema_of_variant_agg("cell").alias("cell_type"))
    # a document is one row here; its fields and those that it lacks are counted together
    wanted = F.array(*[F.lit(c) for c in contract_names])
    seen = heads.select(F.explode(F.concat(
        F.transform(F.array_distinct("names"), lambda n: F.struct(n.alias("field"), F.lit(True).alias("has"))),
        F.transform(F.array_except(wanted, "names"), lambda n: F.struct(n.alias("field"), F.lit(False).alias("has"))))).alias("f"))
    counted = seen.groupBy("f.field").agg(F.count_if("f.has").alias("documents"))
    total = heads.agg(F.count(F.lit(1)).alias("n"))
    return counted.join(by_field, "field", "left").select(
        "field", F.col("field").isin(contract_names).alias("in_contract"), "documents",
        (total.scalar() - F.col("documents")).alias("lacking"), F.coalesce("cells", F.lit(0)).cast("long").alias("cells"),
        F.coalesce("filled", F.lit(0)).cast("long").alias("filled"), "cell_type")
