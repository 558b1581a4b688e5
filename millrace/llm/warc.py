"""WARC archives: write captures of pages, read archives back, assemble transactions.

Writing. Every page becomes three records: a request, a response and a metadata record; the
request and the metadata name the response in ``WARC-Concurrent-To``. Of pages with equal
payloads of at least ``min_bytes`` bytes, the one with the largest page id is a response, the
others are revisits of it. Spark's text sink writes the records, with the two line ends that
close a record as its line separator, so the files are compressed WARC/1.1 and land in shared
storage whatever store that is. Files have at most ``FILE_RECORDS`` records.

Reading. Archives are read as binary files, each parsed record by record by its
``Content-Length``; nothing in a payload can be taken for a record.

Assembling. A capture is a response or revisit record. Records are joined to it through
``WARC-Concurrent-To``, in either direction and over one record between, and each capture
becomes one nested row.

Null html counts as empty, a null url as an empty one. Equal payloads are told by SHA-256 and
length. Rows that repeat a page id and a payload are captures of their own; if that id is the
largest, all of them are responses, since none has a smaller id. A null page id is smaller
than any other. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shared import STEP_BYTES, Batches, map_batches, out_batch, ship, staged, utf8
from millrace.operators.joins import join_splittable
from millrace.session import workspace

FILE_RECORDS = 3_000
_LINE_END = "\r\n"
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

RECORD = """type string, record_id string, concurrent_to array<string>, refers_to string,
            target_uri string, payload_digest string, payload_bytes long,
            fields map<string, array<string>>, payload binary"""


def payload_digest(payload: bytes) -> str:
    """Base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
) -> None:
    """Write the captures of ``pages`` into ``folder``."""
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")).alias("url"),
        utf8(html_col).alias("payload"),
    ).withColumn("same", F.concat_ws(":", F.sha2("payload", 256), F.length("payload")))
    # Only payloads that occur more than once need a join.
    groups = (
        rows.filter(F.length("payload") >= min_bytes)
        .groupBy("same")
        .agg(F.max("id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    decided = join_splittable(rows, groups, "same").drop("same")
    map_batches(decided, _records, "record string").write.option("lineSep", _LINE_END * 2).option(
        "maxRecordsPerFile", FILE_RECORDS
    ).option("compression", "gzip").text(folder)


def _record(kind: str, record_id: str, block: str, media: str, **headers: str) -> str:
    size = len(block.encode("utf-8"))
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id}",
        f"WARC-Date: {_DATE}",
        *(f"{name.replace('_', '-')}: {value}" for name, value in headers.items()),
        f"Content-Type: {media}",
        f"Content-Length: {size}",
    ]
    return _LINE_END.join(lines) + _LINE_END * 2 + block


def _capture_id(page: int | None, digest: str) -> str:
    """The id of the response that revisits of its payload refer to."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'response {page} {digest}')}>"


def _records(batches: Batches) -> Batches:
    part, row = TaskContext.get().partitionId(), 0
    schema = pa.schema([("record", pa.string())])
    held, out = 0, []
    for batch in batches:
        for page in batch.to_pylist():
            payload, url = page["payload"].decode("utf-8", "replace"), _uri(page["url"])
            digest = payload_digest(page["payload"])
            revisit = page["first"] is not None and page["first"] != page["id"]
            unique = f"{part} {row} {page['id']}"
            main_id = (
                f"<urn:uuid:{uuid.uuid5(_SPACE, f'revisit {unique}')}>"
                if revisit
                else _capture_id(page["id"], digest)
            )
            head = (
                f"HTTP/1.1 200 OK{_LINE_END}Content-Type: text/html; charset=utf-8{_LINE_END}"
                f"Content-Length: {len(page['payload'])}{_LINE_END * 2}"
            )
            common = {"WARC_Target_URI": url}
            digests = {"WARC_Payload_Digest": f"sha1:{digest}"}
            http = "application/http; msgtype="
            if revisit:
                refers = {
                    "WARC_Profile": _PROFILE,
                    "WARC_Refers_To": _capture_id(page["first"], digest),
                }
                main = _record(
                    "revisit", main_id, head, http + "response", **common, **digests, **refers
                )
            else:
                main = _record(
                    "response", main_id, head + payload, http + "response", **common, **digests
                )
            joined = common | {"WARC_Concurrent_To": main_id}
            request = _record(
                "request",
                f"<urn:uuid:{uuid.uuid5(_SPACE, f'request {unique}')}>",
                f"GET {url} HTTP/1.1{_LINE_END * 2}",
                http + "request",
                **joined,
            )
            named = "" if page["id"] is None else f"page-id: {page['id']}{_LINE_END}"
            metadata = _record(
                "metadata",
                f"<urn:uuid:{uuid.uuid5(_SPACE, f'metadata {unique}')}>",
                named + f"fetched-via: table{_LINE_END}",
                "application/warc-fields",
                **joined,
            )
            row += 1
            out += [request, main, metadata]
            held += len(payload)
            if held > STEP_BYTES or len(out) > 3_000:
                yield out_batch(schema, out)
                held, out = 0, []
    if out:
        yield out_batch(schema, out)


def _uri(url: str) -> str:
    """The url on one line, as a header needs it."""
    return "".join(c for c in url if c.isprintable()).strip()


def read_archives(
    spark: SparkSession, folder: str, with_payload: bool = True, suffix: str = ""
) -> DataFrame:
    """One row per record of the archives in ``folder``.

    ``fields`` holds warc-fields blocks: every name with all its values in their order.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    return files.select("content").mapInArrow(partial(_parse, with_payload), RECORD)


def _parse(with_payload: bool, batches: Batches) -> Batches:
    schema = pa.schema(
        [
            ("type", pa.string()),
            ("record_id", pa.string()),
            ("concurrent_to", pa.list_(pa.string())),
            ("refers_to", pa.string()),
            ("target_uri", pa.string()),
            ("payload_digest", pa.string()),
            ("payload_bytes", pa.int64()),
            ("fields", pa.map_(pa.string(), pa.list_(pa.string()))),
            ("payload", pa.binary()),
        ]
    )
    for batch in batches:
        for content in batch.column("content"):
            held, rows = 0, []
            data = content.as_py()
            if data[:2] == b"\x1f\x8b":
                data = gzip.decompress(data)
            for headers, block in records_of(data):
                rows.append(_row(headers, block, with_payload))
                held += len(block) if with_payload else 500
                if held > 8_000_000 or len(rows) >= 2_000:
                    yield out_batch(schema, *map(list, zip(*rows)))
                    held, rows = 0, []
            if rows:
                yield out_batch(schema, *map(list, zip(*rows)))


def records_of(data: bytes):
    """Headers (lower-case name to values) and block of each record."""
    at = 0
    while True:
        while data[at : at + 1] in (b"\r", b"\n"):
            at += 1
        if at >= len(data):
            return
        if data[at : at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        headers: dict[str, list[str]] = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            headers.setdefault(name.strip().lower().decode(), []).append(
                value.strip().decode("utf-8", "replace")
            )
        start = end + 4
        at = start + int(headers["content-length"][0])
        if at > len(data):
            raise ValueError("a record is cut off")
        yield headers, data[start:at]


def _row(headers: dict[str, list[str]], block: bytes, with_payload: bool) -> tuple:
    def one(name: str) -> str | None:
        return headers.get(name, [None])[0]

    kind, media = one("warc-type"), one("content-type") or ""
    payload, fields, size, digest = None, None, None, None
    if media.startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if kind == "revisit":  # its block holds the headers of the full response
            lengths = [
                line.partition(b":")[2].strip()
                for line in head.split(b"\r\n")
                if line.lower().startswith(b"content-length:")
            ]
            size = int(lengths[0]) if lengths else None
            digest = (one("warc-payload-digest") or "").removeprefix("sha1:") or None
        elif kind == "response":
            digest = payload_digest(payload)
            if (stated := one("warc-payload-digest")) not in (None, f"sha1:{digest}"):
                raise ValueError(f"payload of {one('warc-record-id')} is not that of {stated}")
    elif media.startswith("application/warc-fields"):
        fields = {}
        for line in block.decode("utf-8", "replace").splitlines():
            name, _, value = line.partition(":")
            if name.strip():
                fields.setdefault(name.strip(), []).append(value.strip())
    return (
        kind,
        one("warc-record-id"),
        headers.get("warc-concurrent-to", []),
        one("warc-refers-to"),
        one("warc-target-uri"),
        digest,
        size,
        list(fields.items()) if fields is not None else None,
        payload if with_payload and kind == "response" else None,
    )


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture``, ``requests``, ``metadata`` and ``others``.

    A capture's requests, metadata and other concurrent records (conversions, resources) stand
    in its row, as its transaction has them. Records that belong to no capture are left out.
    Captures that repeat an id share their records. ``records`` is read several times, so
    pass a written table.
    """
    spark = records.sparkSession
    main = F.col("type").isin("response", "revisit")
    captures, others = records.filter(main), records.filter(~main)
    # What each record names, and whether that is a capture.
    ids = captures.select(F.col("record_id").alias("to"), F.lit(True).alias("found")).distinct()
    links = staged(
        others.select("record_id", F.explode("concurrent_to").alias("to")).join(ids, "to", "left"),
        workspace(spark, "warc-links"),
    )
    # Where a capture names another record, that one belongs to the capture.
    named_by_capture = captures.select(
        F.explode("concurrent_to").alias("record_id"), F.col("record_id").alias("capture_id")
    )
    belongs = (
        links.filter("found")
        .select("record_id", F.col("to").alias("capture_id"))
        .unionByName(named_by_capture)
        .distinct()
    )
    # Over one record between: a record that names a record which belongs to a capture.
    far = links.filter("found is null").drop("found")
    if not far.isEmpty():
        direct = staged(belongs, workspace(spark, "warc-direct"))
        between = (
            far.join(direct.withColumnRenamed("record_id", "to"), "to")
            .select("record_id", "capture_id")
            .distinct()
            .join(direct, "record_id", "left_anti")
        )
        belongs = direct.unionByName(between)
    body = [c for c in records.columns if c not in ("concurrent_to", "payload")]
    attached = others.join(belongs, "record_id").select("capture_id", F.struct(*body, "payload").alias("record"))

    def those(condition: Column) -> Column:
        return F.collect_list(F.when(condition, F.col("record")))

    request, metadata = (F.col("record.type") == kind for kind in ("request", "metadata"))
    grouped = attached.groupBy("capture_id").agg(
        those(request).alias("requests"),
        those(metadata).alias("metadata"),
        those(~request & ~metadata).alias("others"),
    )
    # An id that many captures repeat can be split.
    main_rows = captures.select(
        F.col("record_id").alias("capture_id"), F.struct(*body, "payload").alias("capture")
    )
    together = join_splittable(main_rows, grouped, "capture_id")
    none = F.array().cast(grouped.schema["requests"].dataType)
    return together.select(
        "capture_id",
        "capture",
        *[F.coalesce(c, none).alias(c) for c in ("requests", "metadata", "others")],
    )


def archived_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives, read them back, and describe every capture.

    Digests and lengths come from the payloads read back; the rows that are assembled for
    this description leave the payloads themselves out. Ids are cast to long.
    """
    spark = pages.sparkSession
    folder = workspace(spark, "warc")
    write_archives(pages, folder, min_bytes=min_bytes)
    records = staged(
        read_archives(spark, folder, with_payload=False), workspace(spark, "warc-records")
    )
    captures = staged(
        assemble(records).select(
            "capture_id",
            "capture",
            F.col("metadata")[0]["fields"]["page-id"][0].cast("long").alias("page_id"),
        ),
        workspace(spark, "warc-captures"),
    )
    responses = captures.filter("capture.type = 'response'").groupBy("capture_id").agg(
        F.max("page_id").alias("refers_to")
    )
    revisits = captures.filter("capture.type = 'revisit'").withColumn(
        "capture_id", F.col("capture.refers_to")
    )
    told = captures.filter("capture.type = 'response'").withColumn(
        "refers_to", F.lit(None).cast("long")
    )
    every = told.unionByName(join_splittable(revisits, responses, "capture_id"))
    return every.select(
        "page_id",
        F.col("capture.payload_bytes").alias("payload_bytes"),
        F.col("capture.payload_digest").alias("payload_digest"),
        F.col("capture.type").alias("record_type"),
        "refers_to",
    )
