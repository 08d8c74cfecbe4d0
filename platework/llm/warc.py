"""Legacy web archives to WARC: ARC files of version 1 and 2 are parsed by their header lines and declared lengths, and
their records get WARC identifiers, timestamps, types and digests.

Archives are written and read through Spark's own file formats, so they may lie in any store it reaches and are
committed as any other output: the text writer ends a record with the separator that the format asks for, and
``binaryFile`` reads an archive as one row, which is decompressed and parsed as a stream. An archive holds the rows of
one input partition, so its size is bounded by that of the partitions (``spark.sql.files.maxPartitionBytes``).
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platework.llm.common import BATCH_BYTES, bound_batches, schemas, sent_if_small, stored

#: Payloads of at least so many bytes are written once; equal ones are revisits.
MIN_REVISIT_BYTES = 100

#: The header lines that the versions declare.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_END, WARC_END = "\n", "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) if isinstance(x, (bytes, str)) else 8 for x in row)
        if size >= BATCH_BYTES // 2:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _written(df: DataFrame, begin: Callable[[], bytes], record: Callable[[dict], bytes], end: str, path: str) -> None:
    """An archive per partition: what ``begin`` gives, then a record per row."""
    schema = pa.schema([("record", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            yield (begin(),)
            for batch in batches:
                for row in batch.to_pylist():
                    yield (record(row),)

        yield from _batches(records(), schema)

    bound_batches(df.sparkSession)
    out = df.mapInArrow(run, "record binary").select(F.col("record").cast("string"))
    out.write.option("lineSep", end).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def _read(spark: SparkSession, path: str, parse: Callable[[io.BufferedIOBase, str], Iterator[tuple]], schema: str) -> DataFrame:
    bound_batches(spark)
    kinds, arrow = schemas(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                packed = io.BytesIO(memoryview(content.as_buffer()))
                with gzip.GzipFile(fileobj=packed) as stream:
                    yield from _batches(parse(io.BufferedReader(stream, 1 << 20), name.rsplit("/", 1)[-1]), arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(run, kinds)


# --- ARC

def write_arc(pages: DataFrame, path: str, id_column="page_id", url_column="url", text_column="html") -> None:
    """A captured HTTP response per row, in archives of version 1 and 2 by turns.

    A null text is an empty payload, a null url ``-``; a null id is left out of the response's header.
    """
    def version() -> int:
        return 1 + TaskContext.get().partitionId() % 2

    def header(v: int, url: str, date: str, kind: str, length: int, code: str = "200") -> str:
        if v == 1:
            return f"{url} 0.0.0.0 {date} {kind} {length}\n"
        return f"{url} 0.0.0.0 {date} {kind} {code} - - 0 - {length}\n"

    def begin() -> bytes:
        v = version()
        content = f"{v} 0 pages\n{ARC_FIELDS[v]}\n"
        return (header(v, "filedesc://pages.arc", "19960101000000", "text/plain", len(content)) + content).encode()

    def record(row: dict) -> bytes:
        payload = (row["text"] or "").encode()
        url = re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", row["url"] or "") or "-"
        named = "" if row["id"] is None else f"X-Page-Id: {row['id']}\r\n"
        content = (
            f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{named}Content-Length: {len(payload)}\r\n\r\n"
        ).encode() + payload
        second = (row["id"] or 0) % 86_400
        date = f"19960101{second // 3600:02d}{second // 60 % 60:02d}{second % 60:02d}"
        return header(version(), url, date, "text/html", len(content)).encode() + content

    rows = pages.select(
        F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"), F.col(text_column).alias("text"))
    _written(rows, begin, record, ARC_END, path)


def parse_arc(stream: io.BufferedIOBase, name: str) -> Iterator[tuple]:
    """(name, offset, version, url, ip, date, kind, content) of each document record, by the declared lengths."""
    version, offset = 0, 0
    while line := stream.readline():
        at, offset = offset, offset + len(line)
        if not line.strip():
            continue
        text = line.decode(errors="surrogateescape").rstrip("\r\n")
        fields = text.rsplit(" ", 4 if version < 2 else 9)
        length = int(fields[-1])
        content = stream.read(length)
        if len(content) < length:
            raise ValueError(f"{name}: record at {at} ends after {len(content)} of {length} bytes")
        offset += length
        if text.startswith("filedesc://"):
            version = int(content.split(b" ", 1)[0])
            if version not in ARC_FIELDS or ARC_FIELDS[version].encode() not in content:
                raise ValueError(f"{name}: unknown version or header line")
            continue
        if version not in ARC_FIELDS:
            raise ValueError(f"{name}: a record before the version block")
        yield name, at, version, fields[0], fields[1], fields[2], fields[3], content


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives under ``path``, with HTTP header and payload taken apart."""
    def parse(stream, name):
        for archive, at, version, url, ip, date, kind, content in parse_arc(stream, name):
            head, payload = split_http(content)
            digest = hashlib.sha256(payload).hexdigest()
            made = hashlib.sha256(f"{archive}|{at}|{url}|{date}".encode(errors="surrogateescape")).hexdigest()
            uuid = f"urn:uuid:{made[:8]}-{made[8:12]}-8{made[13:16]}-8{made[17:20]}-{made[20:32]}"
            yield uuid, version, url, ip, date, kind, head, payload, len(payload), digest

    return _read(
        spark, path, parse,
        "record_id string, version int, url string, ip string, date string, kind string, http binary, payload binary, "
        "payload_bytes long, payload_digest string")


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP header with its closing empty line (none if it isn't HTTP), and payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    head, end, payload = content.partition(b"\r\n\r\n")
    return head + end, payload


# --- conversion

def with_types(records: DataFrame, order) -> DataFrame:
    """Adds ``record_type`` and what a revisit refers to. Of the records with equal payloads of MIN_REVISIT_BYTES or
    more, those smallest by ``order`` are responses (all of them, if they tie), the others revisit the first of them.
    """
    rows = records.withColumn("order", order)
    first = rows.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES).groupBy("payload_digest").agg(
        F.count("*").alias("n"), F.min(F.struct("order", "record_id", "url", "date")).alias("first"),
    ).where("n > 1").select(F.col("payload_digest").alias("digest"), "first")
    # Only digests that occur twice are looked up; while they are few, no payload is shuffled.
    first = sent_if_small(stored(first, "first-captures"), text="first.url")
    found = rows.join(first, rows["payload_digest"] == first["digest"], "left")
    again = F.col("first").isNotNull() & ~F.col("order").eqNullSafe(F.col("first.order"))
    plain = F.when(F.length("http") > 0, "response").otherwise("resource")
    return found.withColumns({
        "record_type": F.when(again, "revisit").otherwise(plain), "first": F.when(again, F.col("first"))})


def write_warc(records: DataFrame, path: str) -> None:
    """A WARC record per row of ``with_types``; a revisit holds the HTTP header only."""
    def iso(date: str) -> str:
        d = date.ljust(14, "0")
        return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"

    def lines(fields: list[tuple[str, object]]) -> bytes:
        text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v not in (None, "-")) + "\r\n"
        return text.encode(errors="surrogateescape")

    def begin() -> bytes:
        content = b"software: converter of legacy archives\r\nformat: WARC File Format 1.1\r\n"
        made = hashlib.sha256(f"warcinfo|{TaskContext.get().partitionId()}".encode()).hexdigest()
        return lines([
            ("WARC-Type", "warcinfo"), ("WARC-Date", "1996-01-01T00:00:00Z"),
            ("WARC-Record-ID", f"<urn:uuid:{made[:8]}-{made[8:12]}-8{made[13:16]}-8{made[17:20]}-{made[20:32]}>"),
            ("Content-Type", "application/warc-fields"), ("Content-Length", len(content))]) + content

    def record(row: dict) -> bytes:
        revisit = row["record_type"] == "revisit"
        block = row["http"] if revisit else row["http"] + row["payload"]
        fields = [
            ("WARC-Type", row["record_type"]), ("WARC-Target-URI", row["url"]), ("WARC-Date", iso(row["date"])),
            ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-IP-Address", row["ip"]),
            ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
            ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")]
        if revisit:
            first = row["first"]
            fields += [
                ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{first['record_id']}>"),
                ("WARC-Refers-To-Target-URI", first["url"]), ("WARC-Refers-To-Date", iso(first["date"])),
                ("WARC-Truncated", "length")]
        http = "application/http; msgtype=response"
        fields += [("Content-Type", http if row["http"] else row["kind"]), ("Content-Length", len(block))]
        return lines(fields) + block

    rows = records.select(
        "record_id", "record_type", "url", "ip", "date", "kind", "http", "payload", "payload_digest",
        F.col("first").dropFields("order").alias("first"))
    _written(rows.withColumn("payload", F.when(F.col("record_type") != "revisit", F.col("payload"))),
             begin, record, WARC_END, path)


def parse_warc(stream: io.BufferedIOBase, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: no record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode(errors="surrogateescape").partition(":")
            fields[key.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if len(block) < int(fields["content-length"]):
            raise ValueError(f"{name}: a record ends early")
        yield fields, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row per record (warcinfo left out): payload digests and lengths are checked against what is stored."""
    def parse(stream, name):
        for fields, block in parse_warc(stream, name):
            if fields["warc-type"] == "warcinfo":
                continue
            if "sha256:" + hashlib.sha256(block).hexdigest() != fields["warc-block-digest"]:
                raise ValueError(f"{name}: {fields['warc-record-id']} does not match its block digest")
            head, payload = split_http(block)
            digest = fields["warc-payload-digest"].removeprefix("sha256:")
            named = dict(
                (k.strip().lower(), v.strip()) for k, _, v in
                (x.partition(":") for x in head.decode(errors="surrogateescape").split("\r\n")[1:]) if k)
            if fields["warc-type"] == "revisit":
                size = int(named["content-length"])
            else:
                size = len(payload)
                if hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"{name}: {fields['warc-record-id']} does not match its payload digest")
            number = named.get("x-page-id")
            yield (
                fields["warc-record-id"].strip("<>"), fields["warc-type"], fields.get("warc-target-uri"), fields["warc-date"],
                None if number is None else int(number), size, digest, fields.get("warc-refers-to", "").strip("<>") or None)

    return _read(
        spark, path, parse,
        "record_id string, record_type string, url string, date string, page_id long, payload_bytes long, "
        "payload_digest string, refers_to_id string")


def convert(spark: SparkSession, arc_path: str, warc_path: str, order=None) -> None:
    """Archives under ``arc_path`` as WARC archives under ``warc_path``. ``order`` tells which of equal payloads comes
    first: by default the oldest, then by url."""
    records = read_arc(spark, arc_path)
    write_warc(with_types(records, F.struct("date", "url", "record_id") if order is None else order), warc_path)


def page_number():
    """The number that ``write_arc`` puts in the response's header."""
    return F.regexp_extract(F.col("http").cast("string"), r"\r\nX-Page-Id: (-?[0-9]+)\r\n", 1).try_cast("long")


def round_trip(pages: DataFrame, arc_path: str, warc_path: str) -> DataFrame:
    """Pages written as legacy archives, converted, and read back: a row per page.

    Pages with equal ids and payloads are responses alike; a page without an id counts as the smallest. Other columns
    are not read; no pages give no rows.
    """
    spark = pages.sparkSession
    write_arc(pages, arc_path)
    convert(spark, arc_path, warc_path, page_number())
    back = read_warc(spark, warc_path)
    wanted = back.where("refers_to_id is not null").select(F.col("refers_to_id").alias("wanted")).distinct()
    known = back.select(F.col("record_id").alias("known_id"), F.col("page_id").alias("known_page"))
    known = known.join(wanted, known["known_id"] == wanted["wanted"], "left_semi")
    return back.join(known, back["refers_to_id"] == known["known_id"], "left").select(
        back["page_id"], "payload_bytes", "payload_digest", "record_type", F.col("known_page").alias("refers_to"),
        back["record_id"], back["date"])
