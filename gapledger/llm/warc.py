"""WARC archives of pages, and a reader that salvages damaged ones.

The writer makes plain WARC/1.0 files with Spark's own text writer; equal payloads are
stored once, the others as revisits. Files hold at most ``records_per_file`` records,
so that the reader, which takes one file per row, works in bounded memory.

The reader also takes files of gzip members. Where a record fails its checks, it looks
for the next version line or member that begins a valid record, goes on there, and
reports the bytes between as quarantined.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapledger.llm.staging import staged

RECORDS_PER_FILE = 1000
MIN_REVISIT_BYTES = 1000
_VERSION, _MEMBER, _END = b"WARC/1.", b"\x1f\x8b\x08", b"\r\n\r\n"


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines of the fields that are not null; line breaks in a value become blanks."""
    return F.array_join(F.array(F.lit("WARC/1.0"), *[
        F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\r\n]+", " ")) for name, value in fields
    ]), "\r\n")


def page_records(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES, date: str = "2022-12-01T00:00:00Z",
) -> DataFrame:
    """``record``: the text of a WARC record for each row of ``pages``.

    Of rows with equal payloads of at least ``min_revisit_bytes``, that with the largest
    id is the response, with all rows that repeat this id; the others revisit it. A null
    payload is empty; a null url has no target field; a null id never is the largest.
    """
    rows = pages.select(
        F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(payload_column).cast("string"), F.lit("")).alias("payload"),
    ).withColumns({"digest": F.sha1(F.col("payload").cast("binary")), "bytes": F.octet_length("payload")})
    large = rows.filter(F.col("bytes") >= min_revisit_bytes)
    first = large.groupBy(F.col("digest").alias("of"), F.col("bytes").alias("of_bytes")).agg(
        F.max("id").alias("first"), F.count(F.lit(1)).alias("rows")
    )
    # Written first, so that its size is known before payloads move: Spark broadcasts it if small.
    first = staged(first.filter("rows > 1").drop("rows"))
    # Payloads too small for revisits, and null ones, keep no key and so meet no other row.
    key = F.when(F.col("bytes") >= min_revisit_bytes, F.col("digest"))
    rows = rows.join(first, (key == F.col("of")) & (F.col("bytes") == F.col("of_bytes")), "left")
    revisit = F.col("of").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit("\r\n\r\n"),
    )
    rows = rows.withColumn("revisit", revisit).withColumn(
        "block", F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("payload")))
    )
    profile = F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")
    header = _lines(
        ("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", _record_id(F.col("id"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Refers-To", F.when(F.col("revisit"), _record_id(F.col("first")))),
        ("WARC-Profile", F.when(F.col("revisit"), profile)),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(F.col("block").cast("binary")))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length("block").cast("string")),
    )
    return rows.select(F.concat(header, F.lit("\r\n\r\n"), F.col("block")).alias("record"))


def write_archives(records: DataFrame, folder: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``record`` texts as WARC files below ``folder``, which must be new."""
    writer = records.select(F.col("record").alias("value")).write.option("lineSep", "\r\n\r\n")
    writer.option("maxRecordsPerFile", records_per_file).text(folder)


@dataclass
class Record:
    start: int
    end: int
    fields: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    reason: str | None = None  # why these bytes are quarantined


class _Damaged(Exception):
    pass


def _parse(data: bytes, start: int) -> Record:
    """The plain record at ``start``, checked."""
    head = data.find(_END, start) if data.startswith(_VERSION, start) else -1
    if head < 0:
        raise _Damaged("no header")
    fields = {}
    for line in data[start:head].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise _Damaged("bad header line")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()) or "warc-type" not in fields or "warc-record-id" not in fields:
        raise _Damaged("missing field")
    begin = head + len(_END)
    end = begin + int(length)
    if data[end : end + len(_END)] != _END:
        raise _Damaged("length does not meet the record's end")
    block = data[begin:end]
    digest = fields.get("warc-block-digest", "").lower()
    if digest.startswith("sha1:") and len(digest) == 45 and hashlib.sha1(block).hexdigest() != digest[5:]:
        raise _Damaged("block digest differs")
    return Record(start, end + len(_END), fields, block)


#: Bytes of a member given to the inflater at a time, and what it may make of a whole one.
_PIECE, _MOST_INFLATED = 1 << 16, (1 << 31) - 1


def _member(data: bytes, start: int) -> list[Record]:
    """The records of the gzip member at ``start``; all carry the member's place.

    A member takes time by its own length, whatever follows it; one that inflates to more
    than a file may hold is damaged.
    """
    inflate, view, fed = zlib.decompressobj(31), memoryview(data), start
    parts, size = [], 0
    try:
        while not inflate.eof and fed < len(data):
            piece = view[fed : fed + _PIECE]
            parts.append(inflate.decompress(piece, _MOST_INFLATED - size + 1))
            fed += len(piece)
            size += len(parts[-1])
            if size > _MOST_INFLATED:
                raise _Damaged("gzip member inflates to too much")
    except zlib.error as error:
        raise _Damaged("gzip member fails its check") from error
    if not inflate.eof:
        raise _Damaged("gzip member is cut off")
    plain = b"".join(parts)
    end, records, at = fed - len(inflate.unused_data), [], 0
    while at < len(plain):
        record = _parse(plain, at)
        at = record.end
        records.append(Record(start, end, record.fields, record.block))
    if not records:
        raise _Damaged("empty gzip member")
    return records


def _at(data: bytes, start: int) -> list[Record]:
    return _member(data, start) if data.startswith(_MEMBER, start) else [_parse(data, start)]


def salvage(data: bytes) -> Iterator[Record]:
    """All records of an archive in order, and what lies between them with a reason."""
    at = 0
    while at < len(data):
        try:
            records = _at(data, at)
        except _Damaged as damage:
            reason, next_ = str(damage), at
            while True:
                found = [p for p in (data.find(_VERSION, next_ + 1), data.find(_MEMBER, next_ + 1)) if p >= 0]
                if not found:
                    yield Record(at, len(data), reason=reason)
                    return
                next_ = min(found)
                try:
                    records = _at(data, next_)
                    break
                except _Damaged:
                    continue
            yield Record(at, next_, reason=reason)
        yield from records
        at = records[-1].end


_FIELDS = (
    "path string, start long, end long, quarantined string, record_id string, record_type string, refers_to string, "
    "target_uri string, payload_bytes long, payload_digest string, payload binary"
)


def _row(path: str, r: Record, with_payload: bool) -> dict:
    row = {"path": path, "start": r.start, "end": r.end, "quarantined": r.reason}
    if r.reason is not None:
        return row
    http, _, payload = r.block.partition(_END)
    declared = [x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    stored = r.fields["warc-type"] != "revisit"
    length = declared[0].split(b":")[1].strip() if declared else b"0"
    if not stored and not length.isdigit():
        return row | {"quarantined": "revisit declares no length"}
    digest = r.fields.get("warc-payload-digest", "").lower().removeprefix("sha1:")
    return row | {
        "record_id": r.fields["warc-record-id"], "record_type": r.fields["warc-type"],
        "refers_to": r.fields.get("warc-refers-to"), "target_uri": r.fields.get("warc-target-uri"),
        # A revisit has no payload of its own; its HTTP header and digest tell of the full one.
        "payload_bytes": len(payload) if stored else int(length) if declared else None,
        "payload_digest": hashlib.sha1(payload).hexdigest() if stored else digest,
        "payload": payload if stored and with_payload else None,
    }


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Records and quarantined gaps (``quarantined`` tells why, else null) of all archives below ``folder``.

    Every file is read in one piece, so files should be of some megabytes, as
    ``write_archives`` makes them.
    """
    schema = pa.schema([
        (n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t])
        for n, t in (x.split() for x in _FIELDS.split(", "))
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows = [_row(path.as_py(), r, with_payload) for r in salvage(content.as_py())]
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(read, _FIELDS)
