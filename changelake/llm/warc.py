"""Web archive records: written once, indexed, and read back by byte ranges.

Writing goes through the tasks that hold the rows: each makes archive files of its
own below a shared folder, one gzip member per record, and returns an index row per
record (file, offset, length, URL, digest).  The index is written as Parquet by
Spark, so only files of successful attempts are ever named in it; a lost executor's
files stay unread.

Reading starts from the index: choose records there, sort them by file and offset,
join neighbouring ranges into one read, and cut the records out of it.

Payloads of at least ``REVISIT_BYTES`` that recur are stored once, under the row with
the largest id; the others become revisit records that name it.

Defined results: a null payload is empty; ids that occur twice with the same payload
are both responses if theirs is the largest id; null ids are smaller than all others;
an empty table gives an empty index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs

from changelake.llm.common import join_counted, stored
from changelake.llm.shipping import ship
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REVISIT_BYTES = 1000
FILE_BYTES = 256 << 20  # a task's archive file is closed beyond this
READ_BYTES = 4 << 20  # most bytes joined into one read, unless one record is longer
GAP_BYTES = 64 << 10  # unread bytes that a joined read may pass over
INDEX = "file string, offset long, length long, key long, url string, digest string, payload_bytes long, record_type string, refers_to long"


def _record(key: int | None, url: str, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit keeps the response's headers and leaves its payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    encoded = base64.b32encode(bytes.fromhex(digest)).decode()
    url = "".join(c for c in url if c.isprintable())
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{key}>",
        f"WARC-Target-URI: {url}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{encoded}",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields and the payload of one record's bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    number = lambda name: None if (v := fields.get(name, "<urn:page:None>")[10:-1]) == "None" else int(v)
    return {
        "key": number("WARC-Record-ID"),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "digest": digest,
        "refers_to": number("WARC-Refers-To"),
        "payload_bytes": size,
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    return pafs.FileSystem.from_uri(folder)


def with_revisits(rows: DataFrame) -> DataFrame:
    """``rows`` (key, url, payload, digest, payload_bytes) with ``record_type`` and ``refers_to``."""
    last = stored(
        rows.filter(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("key").alias("__last"), F.count("*").alias("__rows"))
        .filter("__rows > 1"),
        "payloads",
    )
    found = join_counted(rows, last, ["digest"], "__rows", ["key"])
    again = (F.col("payload_bytes") >= REVISIT_BYTES) & F.col("__last").isNotNull() & ~F.col("key").eqNullSafe(F.col("__last"))
    return found.select(
        "key", "url", "payload", "digest", "payload_bytes",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("__last")).alias("refers_to"),
    )


def write(df: DataFrame, folder: str, key: str, url: str, payload: str) -> DataFrame:
    """Write one record per row below ``folder``; returns the stored index."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(url), F.lit("")).alias("url"), body.alias("payload"))
    rows = with_revisits(rows.withColumns({"digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")}))
    names = [c.split()[0] for c in INDEX.split(", ")]
    schema = pa.schema([(n, pa.int64() if " long" in c else pa.string()) for n, c in zip(names, INDEX.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        out, name, offset = None, "", 0
        for batch in batches:
            index = {n: [] for n in names}
            for row in batch.to_pylist():
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                body = row.pop("payload")
                data = gzip.compress(_record(row["key"], row["url"], body, row["digest"], row["record_type"], row["refers_to"]), 3, mtime=0)
                out.write(data)
                for n in names:
                    index[n].append(row.get(n))
                index["file"][-1], index["offset"][-1], index["length"][-1] = name, offset, len(data)
                offset += len(data)
                if offset > FILE_BYTES:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_pydict(index, schema=schema)
        if out is not None:
            out.close()

    ship(df.sparkSession)
    return stored(rows.mapInArrow(run, INDEX), "warc-index")


def fetch(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` names, read by joined byte ranges and parsed.

    Returns ``key, url, record_type, digest, refers_to, payload_bytes, payload``; a
    payload that does not match its digest fails the read.
    """
    schema = "key long, url string, record_type string, digest string, refers_to long, payload_bytes long, payload binary"

    def joined(batch: pa.RecordBatch) -> Iterator[list[tuple[str, int, int]]]:
        group: list[tuple[str, int, int]] = []
        for place in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if group:
                file, first = group[0][:2]
                end = group[-1][1] + group[-1][2]
                if place[0] != file or place[1] - end > GAP_BYTES or place[1] + place[2] - first > READ_BYTES:
                    yield group
                    group = []
            group.append(place)
        if group:
            yield group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        opened, source = None, None
        for batch in batches:
            for group in joined(batch):
                file, first = group[0][:2]
                if file != opened:
                    opened, source = file, fs.open_input_file(f"{root}/{file}")
                data = source.read_at(group[-1][1] + group[-1][2] - first, first)
                records = []
                for _, offset, length in group:
                    record = parse(gzip.decompress(data[offset - first : offset - first + length]))
                    if record["payload"] is not None and hashlib.sha1(record["payload"]).hexdigest() != record["digest"]:
                        raise ValueError(f"damaged record at {file}:{offset}")
                    records.append(record)
                yield pa.RecordBatch.from_pylist(records, schema=_FETCHED)

    ship(index.sparkSession)
    places = index.select("file", "offset", "length")
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = places.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(run, schema)


_FETCHED = pa.schema(
    [("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("digest", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload", pa.binary())]
)
