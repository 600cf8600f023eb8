"""WARC archives: writing, normalising monolithic gzip files, reading by offset index.

Writers put a whole file into one gzip stream. The normaliser inflates such a stream once, writes
every record as a gzip member of its own, and leaves a sidecar index of offsets, so that any record
can be read without what lies before it. Files go to a folder that all executors see, under a
temporary name first, so a repeated task replaces nothing that is complete.
"""

from __future__ import annotations

import base64
import json
import math
import zlib
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwh.llm.common import pick
from labwh.llm.graph import FILE_ROWS

GZIP = 31  # zlib's window bits for gzip framing
CRLF = b"\r\n"
INDEX_SCHEMA = "file string, offset long, length long, type string, record_id string"


def quote(value: str) -> str:
    """Header values hold no control characters; they and ``%`` are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in "%\x7f" else c for c in value)


def record(kind: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One WARC/1.1 record; headers without a value are left out."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}"]
    lines += [f"{k}: {v}" for k, v in headers if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + CRLF * 2 + block + CRLF * 2


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:] if line)}


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Plain bytes of a gzip file of one or more members. Raises if the file ends inside one."""
    inflater, begun = zlib.decompressobj(GZIP), False
    for chunk in chunks:
        while chunk:
            begun = True
            # At most a few MB at once, however well the data was compressed.
            yield inflater.decompress(chunk, 1 << 22)
            chunk = inflater.unconsumed_tail
            if inflater.eof:
                chunk, inflater, begun = inflater.unused_data, zlib.decompressobj(GZIP), False
    if begun:
        raise ValueError("the gzip stream ends early")


def records(chunks: Iterator[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(head, block) of each record of an inflated stream; memory is that of one record."""
    held = bytearray()
    ended = False

    def more() -> bool:
        nonlocal ended
        for chunk in chunks:
            if chunk:
                held.extend(chunk)
                return True
        ended = True
        return False

    while True:
        while (at := held.find(CRLF * 2)) < 0:
            if not more():
                if held.strip():
                    raise ValueError("the file ends inside a record's head")
                return
        head = bytes(held[:at])
        size = int(parse_head(head)["content-length"])
        while len(held) < at + 4 + size + 4:
            if not more():
                raise ValueError("the file ends inside a record")
        yield head, bytes(held[at + 4 : at + 4 + size])
        del held[: at + 4 + size + 4]


class SharedFile:
    """A file in the shared folder, written under a temporary name and renamed when complete."""

    def __init__(self, uri: str):
        from pyarrow import fs

        self.uri = uri
        self.fs, self.path = fs.FileSystem.from_uri(uri)
        self.temporary = f"{self.path}.{TaskContext.get().taskAttemptId()}.part"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.temporary, compression=None)
        self.written = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)

    def close(self) -> None:
        from pyarrow import fs

        self.out.close()
        if self.fs.get_file_info(self.path).type != fs.FileType.NotFound:
            self.fs.delete_file(self.path)  # of an earlier attempt; the same bytes
        self.fs.move(self.temporary, self.path)


def open_shared(uri: str):
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(uri)
    return where.open_input_file(path)


def resolve(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest (hex SHA-1) and refers_to.

    Of rows with equal payloads of at least ``least_bytes``, the largest page_id is kept and the
    others refer to it. NULL html is an empty payload. Rows with the kept page_id itself, with NULL
    page_id, or alone refer to nothing. Keepers are found by an aggregation that reduces before the
    shuffle; the join's hot digests can be split, as only its other side is aggregated.
    """
    t = pick(pages, "page_id", "url", "html").select(
        "page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    t = t.withColumns({"payload_bytes": F.length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    keepers = (
        t.where(F.col("payload_bytes") >= least_bytes)
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
        .where("n > 1").drop("n")
    )
    return t.join(keepers, (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") >= least_bytes), "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(F.col("keeper") > F.col("page_id"), F.col("keeper")).alias("refers_to"))


def page_record(page_id, url, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    """A response record (HTTP head and payload), or a revisit record with the head alone."""
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    headers = [
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Target-URI", None if url is None else quote(url)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("WARC-Payload-Length", str(size)),
    ]
    if kind == "revisit":
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return record(kind, headers, http + payload if kind == "response" else http)


def write_monolithic(rows: DataFrame, folder: str, max_bytes: int = 1 << 30, level: int = 1) -> DataFrame:
    """Writes the rows of ``resolve`` as files of one gzip stream each, at most about ``max_bytes``
    of records per file. Returns the files (file, records), one row each."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        out = press = None
        n, plain, number, done = 0, 0, 0, []

        def finish():
            nonlocal out
            if out is not None:
                out.write(press.flush())
                out.close()
                done.append((out.uri, n))
                out = None

        for batch in batches:
            # One row at a time: payloads stay in the batch's buffers.
            for row in zip(*batch.columns):
                if out is None:
                    out = SharedFile(f"{folder}/{TaskContext.get().partitionId():06d}-{number:04d}.warc.gz")
                    press, n, plain, number = zlib.compressobj(level, zlib.DEFLATED, GZIP), 0, 0, number + 1
                    info = record("warcinfo", [("WARC-Record-ID", "<urn:info>"), ("WARC-Date", "1970-01-01T00:00:00Z"),
                                               ("Content-Type", "application/warc-fields")], b"format: WARC/1.1\r\n")
                    out.write(press.compress(info))
                data = page_record(*(v.as_py() for v in row))
                out.write(press.compress(data))
                n, plain = n + 1, plain + len(data)
                if plain >= max_bytes:
                    finish()
        finish()
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in done], pa.string()),
                                          pa.array([k for _, k in done], pa.int64())], names=["file", "records"])

    columns = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to"]
    return rows.select(*columns).mapInArrow(run, "file string, records long")


def normalise(files: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrites each file (column ``file``) with one gzip member per record, into ``folder``, and a
    sidecar ``.idx`` of JSON lines. Returns the written files (file, index, records).

    The stream is inflated once; a file is the unit of work, as one gzip stream can only be read
    from its start.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = []
            for uri in batch.column(0).to_pylist():
                name = f"{folder}/{uri.rpartition('/')[2]}"
                out, index, n = SharedFile(name), SharedFile(f"{name}.idx"), 0
                with open_shared(uri) as source:
                    chunks = inflate(iter(lambda: source.read(1 << 20), b""))
                    for head, block in records(chunks):
                        press = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                        at, fields = out.written, parse_head(head)
                        out.write(press.compress(head + CRLF * 2 + block + CRLF * 2) + press.flush())
                        index.write(json.dumps({"file": name, "offset": at, "length": out.written - at,
                                                "type": fields.get("warc-type"),
                                                "record_id": fields.get("warc-record-id")}).encode() + b"\n")
                        n += 1
                out.close()
                index.close()
                made.append((name, f"{name}.idx", n))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
                zip(*made) if made else ((), (), ()), (pa.string(), pa.string(), pa.int64()))], names=["file", "index", "records"])

    return files.select("file").mapInArrow(run, "file string, index string, records long")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """All sidecar rows of a folder of normalised archives."""
    return spark.read.schema(INDEX_SCHEMA).json(f"{folder}/*.idx")


def read_records(index: DataFrame) -> DataFrame:
    """Reads the indexed records, each by its own member: record_id, type, uri, refers_to, digest and
    length as the head states them, and the payload of responses."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        name, source = None, None
        for batch in batches:
            rows, held = [], 0
            for file, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, open_shared(file)
                source.seek(offset)
                data = zlib.decompress(source.read(length), GZIP)
                head, _, rest = data.partition(CRLF * 2)
                fields = parse_head(head)
                block = rest[: int(fields["content-length"])]
                kind = fields["warc-type"]
                payload = block.partition(CRLF * 2)[2] if kind == "response" else None
                digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                rows.append((fields.get("warc-record-id"), kind, fields.get("warc-target-uri"), fields.get("warc-refers-to"),
                             base64.b32decode(digest).hex(), int(fields.get("warc-payload-length", "0")), payload))
                held += len(block)
                if held > 1 << 24:
                    yield pack(pa, rows)
                    rows, held = [], 0
            yield pack(pa, rows)
        if source is not None:
            source.close()

    names = ["record_id", "type", "uri", "refers_to", "stated_digest", "stated_length", "payload"]

    def pack(pa, rows):
        kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    return index.select("file", "offset", "length").mapInArrow(
        run, "record_id string, type string, uri string, refers_to string, stated_digest string, stated_length long, payload binary")


def archive(pages: DataFrame, folder: str, max_bytes: int = 1 << 30) -> DataFrame:
    """Writes ``pages`` as monolithic archives, normalises them and returns the records read back by
    index: page_id, url (percent-encoded), record_type, refers_to, payload (responses only),
    payload_bytes and payload_digest. Those two are computed from what was read for responses, and are
    what the record states for revisits.

    NULL html is an empty payload; a page of any length is one record, held in memory while it is written or read. An
    empty table gives no files and no rows. Repeated rows give repeated records; extra columns are
    dropped.
    """
    spark = pages.sparkSession
    made = write_monolithic(resolve(pages), f"{folder}/monolithic", max_bytes)
    # A row per archive: they are gathered into one part file, not one for each task that wrote archives.
    made.repartition(1).write.parquet(f"{folder}/written")
    files = spark.read.schema(made.schema).parquet(f"{folder}/written")
    n = files.count()
    # One file per task: a stream cannot be shared, and tasks should not wait for each other. Dealt in
    # turn from the one part file, no task gets two.
    done = normalise(files.repartition(max(1, n)), f"{folder}/normalised")
    done.repartition(max(1, math.ceil(n / FILE_ROWS))).write.parquet(f"{folder}/manifest")
    schema = "record_id string, type string, uri string, refers_to string, stated_digest string, stated_length long, payload binary"
    if n:
        found = read_records(read_index(spark, f"{folder}/normalised").where(F.col("type").isin("response", "revisit")))
    else:
        found = spark.createDataFrame([], schema)
    kind = pages.schema["page_id"].dataType
    number = lambda c: F.expr(f"try_cast(nullif(regexp_extract({c}, '^<urn:page:(.*)>$', 1), '') AS {kind.simpleString()})")
    response = F.col("type") == "response"
    return found.select(
        number("record_id").alias("page_id"),
        F.col("uri").alias("url"),
        F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"),
        "payload",
        F.when(response, F.length("payload")).otherwise(F.col("stated_length")).cast("long").alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.col("stated_digest")).alias("payload_digest"),
    )
