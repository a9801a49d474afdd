"""Web archives: records written with an index first, read back by sorted byte ranges."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from seqprep.sources.spool import shared_folder, spool

REVISIT_BYTES = 100  # payloads below this many bytes are always written in full
ARCHIVE_BYTES = 1 << 30  # a task begins another archive after this many bytes
GAP_BYTES = 64 << 10  # unselected bytes that a read may pass over
READ_BYTES = 8 << 20  # most bytes of one read, unless a single record is longer
TASK_BYTES = 16 << 20  # of records read by a task, about
RECORD_DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX_SCHEMA = (
    "page_id long, url string, payload_digest string, payload_bytes long, record_type string, "
    "refers_to long, file string, offset long, length long"
)
RECORD_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, "
    "payload_bytes long, payload binary"
)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(","))])


def _one_line(text: str | None) -> str:
    return " ".join((text or "").split())


def record_bytes(row: dict, date: str = RECORD_DATE) -> bytes:
    """One gzip member holding one record; a revisit has the header of its payload only."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <urn:page:{_number(row['page_id'])}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_one_line(row['url'])}",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        f"WARC-Payload-Length: {row['payload_bytes']}",
        "Content-Type: application/http; msgtype=response",
    ]
    if row["record_type"] == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{_number(row['refers_to'])}>"]
    else:
        block += row["payload"]
    head.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _number(value: int | None) -> str:
    return "" if value is None else str(value)


def parse_record(member: bytes) -> dict:
    """The record in a gzip member; fails if its payload does not have the digest that it states."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    identity, refers = (fields.get(name, "")[len("<urn:page:") : -1] for name in ("WARC-Record-ID", "WARC-Refers-To"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    payload = None
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"record {identity}: the payload does not have its digest")
    return {
        "page_id": int(identity) if identity else None,
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "refers_to": int(refers) if refers else None,
        "payload_digest": digest,
        "payload_bytes": int(fields["WARC-Payload-Length"]) if payload is None else len(payload),
        "payload": payload,
    }


def plan_records(pages: DataFrame, identity: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Payload, digest and record type of every page.

    Only (digest, smallest id, count) of payloads that occur more than once are joined back; where one
    payload has a large share of the rows Spark splits that join.
    """
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8")
    rows = pages.select(F.col(identity).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256)).withColumn(
        "payload_bytes", F.octet_length("payload").cast("bigint")
    )
    shared = (
        rows.filter(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .filter("copies > 1 AND first_id IS NOT NULL")
        .drop("copies")
    )
    revisits = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(shared, "payload_digest", "left").select(
        "page_id",
        "url",
        "payload",
        "payload_digest",
        "payload_bytes",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("first_id")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str, date: str = RECORD_DATE) -> DataFrame:
    """Write ``plan_records`` rows to archives in ``folder`` and return the stored index.

    Every task writes files of its own under unique names; only files of tasks that Spark counted as done are
    in the index, so a task that is repeated leaves a file that nothing points to, and no double records.
    """
    names = [field.split()[0] for field in INDEX_SCHEMA.split(",")]
    schema = _arrow(INDEX_SCHEMA)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        sink, name, offset = None, "", 0
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if sink is None or offset >= ARCHIVE_BYTES:
                        if sink is not None:
                            sink.close()
                        store.create_dir(root, recursive=True)
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        sink = store.open_output_stream(f"{root}/{name}", compression=None)
                    member = record_bytes(row, date)
                    sink.write(member)
                    row |= {"file": name, "offset": offset, "length": len(member)}
                    offset += len(member)
                    rows.append({key: row[key] for key in names})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        finally:
            if sink is not None:
                sink.close()

    return spool(records.mapInArrow(write, INDEX_SCHEMA), "warc-index")


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` rows point to; neighbouring ranges of a file are read at once."""
    schema = _arrow(RECORD_SCHEMA)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            rows = batch.select(["file", "offset", "length"]).to_pylist()
            at = 0
            while at < len(rows):
                if rows[at]["file"] != name:
                    if source is not None:
                        source.close()
                    name = rows[at]["file"]
                    source = store.open_input_file(f"{root}/{name}")
                begin, end, stop = rows[at]["offset"], rows[at]["offset"] + rows[at]["length"], at + 1
                while (
                    stop < len(rows)
                    and rows[stop]["file"] == name
                    and rows[stop]["offset"] - end <= GAP_BYTES
                    and rows[stop]["offset"] + rows[stop]["length"] - begin <= READ_BYTES
                ):
                    end = max(end, rows[stop]["offset"] + rows[stop]["length"])
                    stop += 1
                data = source.read_at(end - begin, begin)
                found = []
                for row in rows[at:stop]:
                    start = row["offset"] - begin
                    found.append(parse_record(data[start : start + row["length"]]))
                yield pa.RecordBatch.from_pylist(found, schema=schema)
                at = stop
        if source is not None:
            source.close()

    ranges = index.select("file", "offset", "length")
    # Index rows are small whatever they point to, so tasks are counted by the bytes to be read.
    size = ranges.agg(F.sum("length")).first()[0] or 0
    ranges = ranges.repartitionByRange(1 + size // TASK_BYTES, "file", "offset").sortWithinPartitions("file", "offset")
    return ranges.mapInArrow(read, RECORD_SCHEMA)


def archive_pages(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, str]:
    """Write every page to archives under ``folder`` (default: the shared folder); returns (index, folder).

    Null html is an empty payload; a null url is written as an empty one, and white space in a url as one
    space. Of equal payloads of at least 100 bytes the one with the smallest id is the response; pages
    repeated with that same id are responses too, and a null id only refers to others, never the reverse.
    An empty table gives an empty index and no archive. Other columns are ignored.
    """
    spark = pages.sparkSession
    if folder is None:
        folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    return write_archives(plan_records(pages), folder), folder
