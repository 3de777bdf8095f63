"""WARC archives: written with revisits, segments and chunked framing, and put together again."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.session import materialise, ship_package

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
#: Payloads below this size are never replaced by a revisit.
LEAST_REVISIT = 1000
#: Longest block of one record, and longest chunk of the transfer framing.
SEGMENT_BYTES = 8192
CHUNK_BYTES = 4096
DATE = "2024-01-01T00:00:00Z"

_HTTP = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    b"Transfer-Encoding: chunked\r\n\r\n"
)
_HEAD = "record_type string, record_id string, refers_to string, digest string"
_READ = f"{_HEAD}, origin string, segment int, total bigint, body binary, complete boolean"
_PAYLOAD = f"{_HEAD}, payload binary, complete boolean"


def plan_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html"
) -> DataFrame:
    """``(id, url, payload binary, digest, refers_to)`` of the records to write.

    Of rows with equal payloads of at least ``LEAST_REVISIT`` bytes the one with the largest id is
    a response (``refers_to`` null), the others refer to its id. A null payload is an empty one.
    Rows with the same id and payload are one record, with the least URL. Rows with a null id are
    responses. Payloads are shuffled once; which rows are equal is decided on ids and digests.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    large = rows.filter((F.octet_length("payload") >= LEAST_REVISIT) & F.col("id").isNotNull())
    lean = large.select("id", "digest").distinct()
    latest = lean.groupBy("digest").agg(F.max("id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    latest = latest.filter("n > 1").select("digest", "refers_to")
    revisits = lean.join(latest, "digest").filter("id < refers_to")
    once = rows.groupBy("id", "digest").agg(F.min("url").alias("url"), F.first("payload").alias("payload"))
    return once.join(revisits, ["id", "digest"], "left").select(
        "id", "url", "payload", "digest", "refers_to"
    )


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page is None else page}:{digest}>"


def _chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing; a chunk ends inside each version of the payload.

    So the line that starts a record never stands in a block, also where the line end would be
    that of a chunk or a record.
    """
    marker = VERSION.rstrip().encode()
    cuts = {m.start() + 4 for m in re.finditer(re.escape(marker), payload)}
    cuts.update(range(0, len(payload), size))
    ends = sorted(cuts | {len(payload)})
    out = []
    for start, end in zip(ends, ends[1:]):
        out += [b"%X\r\n" % (end - start), payload[start:end], b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def _head(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{name}: {value}\r\n" for name, value in fields]
    return (VERSION + "".join(lines) + f"Content-Length: {len(block)}\r\n\r\n").encode() + block


def _safe(url: str) -> str:
    """A URL as a header value: white space and control characters are escaped.

    So is the slash of a version at its end, which with the line end would start a record.
    """
    escaped = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    return re.sub(r"(?<=WARC)/(?=1\.1\Z)", "%2F", escaped)


def _records(row: dict, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    own = record_id(row["id"], row["digest"])
    fields = [
        ("WARC-Type", "response" if row["refers_to"] is None else "revisit"),
        ("WARC-Record-ID", own),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _safe(row["url"] or "")),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
    ]
    if row["refers_to"] is not None:
        refers = record_id(row["refers_to"], row["digest"])
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield _head([*fields, ("WARC-Profile", profile), ("WARC-Refers-To", refers)], _HTTP)
        return
    block = _HTTP + _chunked(row["payload"], chunk_bytes)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        yield _head(fields, block)
        return
    yield _head([*fields, ("WARC-Segment-Number", "1")], parts[0])
    for number, part in enumerate(parts[1:], 2):
        more = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"{own[:-1]}:{number}>"),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", _safe(row["url"] or "")),
            ("WARC-Segment-Origin-ID", own),
            ("WARC-Segment-Number", str(number)),
        ]
        if number == len(parts):
            more.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _head(more, part)


def _writer(segment_bytes: int, chunk_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            out = [
                record
                for row in batch.to_pylist()
                for record in _records(row, segment_bytes, chunk_bytes)
            ]
            yield pa.record_batch([pa.array(out, pa.binary())], ["record"])

    return run


def write_archives(
    records: DataFrame,
    path: str,
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    compression: str = "none",
) -> None:
    """Write planned records as WARC files below ``path``, one file per task."""
    ship_package(records.sparkSession)
    written = records.select("id", "url", "payload", "digest", "refers_to").mapInArrow(
        _writer(segment_bytes, chunk_bytes), "record binary"
    )
    # The text writer puts out bytes as they are; every record ends in two line ends.
    written.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END).option(
        "compression", compression
    ).text(path)


def _number(value: str | None) -> int | None:
    return int(value) if value and value.isdigit() else None


def _parse(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        fields.setdefault(name.strip().lower(), value.strip())
    length = _number(fields.get("content-length"))
    whole = length is not None and len(rest) >= length
    segment = _number(fields.get("warc-segment-number"))
    own = fields.get("warc-record-id")
    return (
        fields.get("warc-type"),
        own,
        fields.get("warc-refers-to"),
        (fields.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
        fields.get("warc-segment-origin-id") or (own if segment is not None else None),
        segment,
        _number(fields.get("warc-segment-total-length")),
        rest[:length] if length is not None else rest,
        whole,
    )


def dechunk(body: bytes) -> tuple[bytes, bool]:
    """Payload of chunked framing, and whether the framing was whole."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = re.match(rb"[0-9A-Fa-f]+", body[at : at + 16]) if end >= 0 else None
        if not size:
            return b"".join(out), False
        length = int(size[0], 16)
        if not length:
            return b"".join(out), True
        start = end + 2
        out.append(body[start : start + length])
        at = start + length + 2
        if body[at - 2 : at] != b"\r\n":
            return b"".join(out), False


def _payload(kind: str | None, block: bytes) -> tuple[bytes | None, bool]:
    """Payload of a whole block: no header, no framing; a revisit has none."""
    if kind == "revisit":
        return None, True
    head, _, body = block.partition(b"\r\n\r\n")
    if re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head):
        return dechunk(body)
    return body, True


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["record_type", "record_id", "refers_to", "digest", "origin", "segment", "total", "body", "complete"]
    kinds = [pa.string()] * 5 + [pa.int32(), pa.int64(), pa.binary(), pa.bool_()]
    for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
        rows = []
        for record in batch.column(0).to_pylist():
            *head, segment, total, body, complete = _parse(record)
            if segment is None:
                body, whole = _payload(head[0], body)
                complete = complete and whole
            rows.append((*head, segment, total, body, complete))
        columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)]
        yield pa.record_batch(columns, names)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record below ``path``: its type and ids, segment fields, and ``body``.

    ``body`` is the payload, with the transfer framing undone, or the bare block of a segment.
    Files are split between tasks at the line that starts a record. A block that is shorter than
    its ``Content-Length`` (a torn file, or a block that holds such a line) or whose framing breaks
    off has ``complete`` false.
    """
    ship_package(spark)
    raw = spark.read.option("lineSep", VERSION).text(path)
    raw = raw.select(F.col("value").cast("binary").alias("value"))
    return raw.filter(F.octet_length("value") > 0).mapInArrow(_reader, _READ)


def _join_segments(table: pa.Table) -> pa.Table:
    """One record from its segments: in order of their numbers, none missing, total as stated."""
    parts, first = {}, {}
    for row in table.to_pylist():
        parts.setdefault(row["segment"], row)
        if row["record_id"] == row["origin"]:
            first = row
    numbers = sorted(n for n in parts if n is not None)
    block = b"".join(parts[n]["body"] for n in numbers)
    totals = {parts[n]["total"] for n in numbers} - {None}
    payload, whole = _payload(first.get("record_type"), block)
    complete = (
        whole
        and numbers == list(range(1, len(numbers) + 1))
        and totals == {len(block)}
        and all(parts[n]["complete"] for n in numbers)
    )
    head = [first.get("record_type"), table.column("origin")[0].as_py(), first.get("refers_to"), first.get("digest")]
    return pa.table(
        [*(pa.array([x], pa.string()) for x in head), pa.array([payload], pa.binary()), pa.array([complete])],
        ["record_type", "record_id", "refers_to", "digest", "payload", "complete"],
    )


def reassemble(records: DataFrame) -> DataFrame:
    """``(record_type, record_id, refers_to, digest, payload, complete)``, segments joined.

    Continuations are grouped by the record they continue and ordered by number, then their
    framing is undone; ``complete`` is false when a number is missing, the joined length is not
    the stated total or the framing breaks off. Segments that were read twice count once. Only
    segmented records are shuffled; a group is one payload. Revisits have a null payload: theirs
    is that of the record they refer to.
    """
    whole = records.filter("origin IS NULL").select(
        "record_type", "record_id", "refers_to", "digest", F.col("body").alias("payload"), "complete"
    )
    segments = records.filter("origin IS NOT NULL")
    return whole.unionByName(segments.groupBy("origin").applyInArrow(_join_segments, _PAYLOAD))


def resolve(found: DataFrame) -> DataFrame:
    """One row per record with size and digest of its full payload.

    Revisits take them from the record they refer to; only its id, size and digest are joined.
    A record whose payload does not have the digest its header states is not ``complete``.

    Sizes and digests are written once, and that lean table is joined with itself: the archives
    behind ``found`` are read and parsed for it alone.
    """
    read = found.select(
        "record_type",
        "record_id",
        "refers_to",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        "digest",
        "complete",
    )
    read = read.withColumn(
        "complete", F.expr("complete AND (payload_digest IS NULL OR digest IS NULL OR digest = payload_digest)")
    )
    read = materialise(read, "warc-digests")
    plain = read.filter("record_type <> 'revisit'").drop("digest")
    sources = plain.select(
        F.col("record_id").alias("refers_to"),
        F.col("payload_bytes").alias("source_bytes"),
        F.col("payload_digest").alias("source_digest"),
        F.col("complete").alias("source_complete"),
    )
    revisits = (
        read.filter("record_type = 'revisit'")
        .join(sources, "refers_to", "left")
        .select(
            "record_type",
            "record_id",
            "refers_to",
            F.col("source_bytes").alias("payload_bytes"),
            F.col("source_digest").alias("payload_digest"),
            F.coalesce(F.expr("complete AND source_complete AND source_digest = digest"), F.lit(False)).alias("complete"),
        )
    )
    return plain.select(*revisits.columns).unionByName(revisits)
