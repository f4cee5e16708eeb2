"""WARC archives as a PySpark data source, read and written by tasks.

``spark.read.format("warc").load(folder)`` gives one row per record. Files are planned into partitions by size.
A record's WARC headers are parsed first; filters on ``record_type``, ``target_uri``, ``record_id``, ``refers_to``
and ``payload_digest`` that Spark pushes down, or that the options name, are decided on them, and of a record that
fails one, nothing more is parsed: its block is passed over by seeking (in a compressed file by inflating to
nowhere). With the option ``payload`` set to ``false`` no payload is read at all. Otherwise payloads are checked
against their digests.

``df.write.format("warc").save(folder)`` writes such rows. Each task writes files of at most ``fileBytes``, every
record a gzip member of its own unless ``compression`` is ``none``. A file name holds the attempt; the commit writes
a manifest with the files of the attempts that succeeded, and readers trust it where there is one, so that files
which a lost executor left behind are never read. Folders are opened through pyarrow's file systems.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage
from pyspark.sql.types import StructType

from trialmill.llm.store import shared_folder

FORMAT = "warc"
SCHEMA = (
    "record_type string, record_id string, target_uri string, warc_date string, refers_to string, "
    "payload_digest string, payload_bytes long, headers map<string,string>, payload binary"
)
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
MANIFEST = "_manifest.json"
#: Bytes of files that one task reads, bytes after which a writer begins a new file, and bytes per Arrow batch.
PLAN_BYTES, FILE_BYTES, BATCH_BYTES = 64 << 20, 64 << 20, 8 << 20
CHUNK = 1 << 18
#: Column and the WARC header that a filter on it is decided by.
HEADER_OF = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The folder's file system and the path there; a path without a scheme is local or mounted."""
    if "://" in folder or folder.startswith("file:"):
        plain = folder if "://" in folder else "file://" + folder[5:]
        return fs.FileSystem.from_uri(plain)
    return fs.LocalFileSystem(), folder


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class _Inflated(io.RawIOBase):
    """The bytes of all members of a gzip file, one after the other."""

    def __init__(self, raw):
        self.raw, self.member, self.rest = raw, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while True:
            if self.member.eof:
                self.rest, self.member = self.member.unused_data, zlib.decompressobj(31)
            data = self.rest or self.raw.read(CHUNK)
            if not data:
                return 0
            out = self.member.decompress(data, len(into))
            self.rest = b"" if self.member.eof else self.member.unconsumed_tail
            if out:
                into[: len(out)] = out
                return len(out)


class Records:
    """The records of an open file: headers by lower-case name first, then, if wanted, the block."""

    def __init__(self, raw, compressed: bool):
        self.seekable = not compressed
        self.file = io.BufferedReader(_Inflated(raw), CHUNK) if compressed else raw
        self.buffer, self.at = b"", 0
        self.skipped = 0

    def _fill(self) -> bool:
        more = self.file.read(CHUNK)
        self.buffer, self.at = self.buffer[self.at :] + more, 0
        return bool(more)

    def line(self) -> bytes | None:
        """The next line without its end; null at the end of the file."""
        start = 0
        while (end := self.buffer.find(b"\n", self.at + start)) < 0:
            start = len(self.buffer) - self.at
            if not self._fill():
                if self.at == len(self.buffer):
                    return None
                end = len(self.buffer)
                break
        out, self.at = self.buffer[self.at : end], min(end + 1, len(self.buffer))
        return out.rstrip(b"\r")

    def take(self, size: int) -> bytes:
        held = self.buffer[self.at : self.at + size]
        self.at += len(held)
        if len(held) == size:
            return held
        parts, left = [held], size - len(held)
        while left and (more := self.file.read(left)):
            parts.append(more)
            left -= len(more)
        if left:
            raise ValueError(f"a WARC block ends {left} bytes early")
        return b"".join(parts)

    def skip(self, size: int) -> None:
        """Passes over bytes, without reading them where the file can be sought."""
        self.skipped += size
        held = min(size, len(self.buffer) - self.at)
        self.at += held
        left = size - held
        if left and self.seekable:
            self.file.seek(left, 1)
            return
        while left:
            got = len(self.file.read(min(left, CHUNK)))
            if not got:
                raise ValueError(f"a WARC block ends {left} bytes early")
            left -= got

    def headers(self) -> dict[str, str] | None:
        """The next record's headers; null at the end of the file."""
        while (line := self.line()) is not None and not line:
            pass
        if line is None:
            return None
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        return self.fields()

    def fields(self) -> dict[str, str]:
        out: dict[str, str] = {}
        last = None
        while line := self.line():
            if line[:1] in b" \t" and last:  # a folded line goes on
                out[last] += " " + line.strip().decode("utf-8", "replace")
                continue
            name, _, value = line.decode("utf-8", "replace").partition(":")
            last = name.strip().lower()
            out[last] = value.strip()
        return out


def http_parts(head: bytes) -> tuple[dict[str, str], int]:
    """Headers by lower-case name and the length of an HTTP message's head; none where it has no end."""
    end = head.find(b"\r\n\r\n")
    if not head.startswith(b"HTTP/") or end < 0:
        return {}, 0
    pairs = (line.partition(b":") for line in head[:end].split(b"\r\n")[1:])
    return {k.decode("latin-1").strip().lower(): v.decode("latin-1").strip() for k, _, v in pairs}, end + 4


@dataclass
class WarcFiles(InputPartition):
    files: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.value = self.files


class WarcReader(DataSourceReader):
    """Plans files into partitions and reads records, headers first."""

    def __init__(self, schema: StructType, options: dict):
        self.names = schema.names
        self.folder = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.plan_bytes = int(options.get("planBytes", PLAN_BYTES))
        self.wanted: list[tuple[str, frozenset | None]] = []
        for column in HEADER_OF:
            if value := options.get(column):
                self.wanted.append((column, frozenset(value.split("|"))))

    def decided(self, found: Filter) -> bool:
        """Takes a filter that headers decide; others stay with Spark."""
        column = found.attribute[0] if getattr(found, "attribute", None) else None
        if column not in HEADER_OF:
            return False
        if isinstance(found, EqualTo):
            self.wanted.append((column, frozenset([found.value])))
        elif isinstance(found, In):
            self.wanted.append((column, frozenset(found.value)))
        elif isinstance(found, IsNotNull):
            self.wanted.append((column, None))
        else:
            return False
        return True

    def partitions(self) -> list[InputPartition]:
        """Files of about ``planBytes`` together; the largest first, so that no task ends much later than the others."""
        system, top = file_system(self.folder)
        if system.get_file_info(f"{top}/{MANIFEST}").type == fs.FileType.File:
            with system.open_input_stream(f"{top}/{MANIFEST}") as f:
                files = [(size, f"{top}/{name}") for name, size in json.loads(f.read())["files"]]
        else:
            found = system.get_file_info(fs.FileSelector(top, recursive=True)) if system.get_file_info(top).type == fs.FileType.Directory else [system.get_file_info(top)]
            if found and found[0].type == fs.FileType.NotFound:
                raise FileNotFoundError(self.folder)
            files = [(f.size, f.path) for f in found if f.type == fs.FileType.File and f.base_name.endswith((".warc", ".warc.gz"))]
        out, held = [], 0
        for size, path in sorted(files, key=lambda x: (-x[0], x[1])):
            if not out or held + size > self.plan_bytes:
                out.append(WarcFiles([]))
                held = 0
            out[-1].files.append(path)
            held += size
        return out or [WarcFiles([])]

    def keeps(self, headers: dict[str, str]) -> bool:
        for column, values in self.wanted:
            value = headers.get(HEADER_OF[column])
            if value is None or (values is not None and shown(column, value) not in values):
                return False
        return True

    def read(self, partition: WarcFiles) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.folder)
        rows, held = [], 0
        for path in partition.files:
            with system.open_input_file(path) as raw:
                records = Records(raw, path.endswith(".gz"))
                while (headers := records.headers()) is not None:
                    size = int(headers.get("content-length", 0))
                    if not self.keeps(headers):
                        records.skip(size)
                        continue
                    rows.append(self.row(records, headers, size))
                    held += len(rows[-1][8] or b"") + 500
                    if held > BATCH_BYTES:
                        yield self.batch(rows)
                        rows, held = [], 0
        if rows:
            yield self.batch(rows)

    def row(self, records: Records, headers: dict[str, str], size: int) -> tuple:
        value = {column: (shown(column, headers[name]) if name in headers else None) for column, name in HEADER_OF.items()}
        payload, length = None, size
        http = headers.get("content-type", "").startswith("application/http")
        if self.payload or size <= CHUNK:
            block = records.take(size)
            inner, start = http_parts(block) if http else ({}, 0)
        else:  # the head of the block is enough
            block = records.take(CHUNK)
            inner, start = http_parts(block) if http else ({}, 0)
            records.skip(size - CHUNK)
        length = size - start
        if value["record_type"] == "revisit":  # the block stops after the head of the message it stands for
            length = int(inner["content-length"]) if inner.get("content-length", "").isdigit() else None
        elif self.payload:
            payload = block[start:]
            said = headers.get("warc-payload-digest", "")
            if said.lower().startswith("sha1:") and said[5:] != digest(payload):
                raise ValueError(f"payload of {value['record_id']} has not the digest {said}")
        merged = headers | {f"http:{k}": v for k, v in inner.items()}
        return (*(value[c] for c in ("record_type", "record_id", "target_uri")), headers.get("warc-date"), value["refers_to"],
                value["payload_digest"], length, merged, payload)

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(),) * 6 + (pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary())
        columns = [
            pa.array([list(v.items()) for v in c] if pa.types.is_map(k) else list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)
        ]
        return pa.RecordBatch.from_arrays(columns, names=self.names)


class PushingWarcReader(WarcReader):
    """The reader of sessions in which Spark hands filters to Python data sources."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for found in filters:
            if not self.decided(found):
                yield found


def shown(column: str, value: str) -> str:
    """A header as its column has it: digests without the name of the algorithm."""
    return value.partition(":")[2] if column == "payload_digest" and value[:5].lower() == "sha1:" else value


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


def record_bytes(row: dict) -> bytes:
    """One WARC record of a row: its headers in a fixed order and the block; a revisit's block is the head only."""
    payload = row.get("payload") or b""
    length = row["payload_bytes"] if row.get("payload_bytes") is not None else len(payload)
    revisit = row["record_type"] == "revisit"
    inner = dict(row.get("headers") or {})
    content = inner.pop("http:content-type", "text/html; charset=utf-8")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: {clean(content)}\r\nContent-Length: {length}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row.get("warc_date") or "1970-01-01T00:00:00Z")]
    fields += [("WARC-Target-URI", row.get("target_uri")), ("WARC-Payload-Digest", f"sha1:{row.get('payload_digest') or digest(payload)}")]
    fields += [("WARC-Refers-To", row.get("refers_to")), ("WARC-Profile", REVISIT if revisit else None)]
    fields += [(k, v) for k, v in sorted(inner.items()) if not k.startswith(("warc-", "http:", "content-"))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    top = "WARC/1.1\r\n" + "".join(f"{k}: {clean(v)}\r\n" for k, v in fields if v is not None)
    return top.encode() + b"\r\n" + block + b"\r\n\r\n"


def clean(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split()) if any(c in value for c in "\r\n") else value


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.folder = options["path"]
        self.compressed = options.get("compression", "gzip") != "none"
        self.file_bytes = int(options.get("fileBytes", FILE_BYTES))
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, top = file_system(self.folder)
        system.create_dir(top, recursive=True)
        files: list[tuple[str, int]] = []
        out, size = None, 0
        try:
            for batch in iterator:
                for i in range(batch.num_rows):  # one record at a time is in memory besides the batch
                    row = batch.slice(i, 1).to_pylist(maps_as_pydicts="lossy")[0]
                    data = record_bytes(row)
                    if self.compressed:
                        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                        data = packer.compress(data) + packer.flush()
                    if out is None or size + len(data) > self.file_bytes and size:
                        if out is not None:
                            out.close()
                            files[-1] = (files[-1][0], size)
                        files.append((f"part-{uuid.uuid4().hex}.warc{'.gz' if self.compressed else ''}", 0))
                        out, size = system.open_output_stream(f"{top}/{files[-1][0]}", compression=None), 0
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
                files[-1] = (files[-1][0], size)
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        """Publishes the files of the successful attempts; an append keeps those published before."""
        system, top = file_system(self.folder)
        system.create_dir(top, recursive=True)
        files = [list(f) for m in messages if m is not None for f in m.files]
        at = f"{top}/{MANIFEST}"
        if not self.overwrite and system.get_file_info(at).type == fs.FileType.File:
            with system.open_input_stream(at) as f:
                files = json.loads(f.read())["files"] + files
        new = f"{at}.{uuid.uuid4().hex}"
        with system.open_output_stream(new, compression=None) as f:
            f.write(json.dumps({"files": files}).encode())
        system.move(new, at)

    def abort(self, messages: list[Written | None]) -> None:
        """Deletes what the finished tasks wrote; the rest is in no manifest."""
        system, top = file_system(self.folder)
        for message in messages:
            for name, _ in message.files if message is not None else []:
                system.delete_file(f"{top}/{name}")


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        pushed = str(self.options.get("pushdown", "false")).lower() == "true"
        return (PushingWarcReader if pushed else WarcReader)(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        missing = {"record_type", "record_id", "payload"} - set(schema.names)
        if missing:
            raise ValueError(f"a WARC writer needs the columns {sorted(missing)}")
        return WarcWriter(self.options, overwrite)


def read_warc(spark: SparkSession, folder: str, payload: bool = True, **wanted: str | list[str]) -> DataFrame:
    """The records of a folder; ``wanted`` names the values of ``HEADER_OF`` columns that are asked for.

    Where the session sets ``spark.sql.python.filterPushdown.enabled``, ``where`` on these columns does the same.
    """
    spark.dataSource.register(WarcDataSource)
    options = {k: v if isinstance(v, str) else "|".join(v) for k, v in wanted.items()}
    unknown = set(options) - set(HEADER_OF)
    if unknown:
        raise ValueError(f"no header decides {sorted(unknown)}")
    pushed = spark.conf.get(PUSHDOWN, "false")
    return spark.read.format(FORMAT).options(payload=str(payload).lower(), pushdown=pushed, **options).load(folder)


def write_warc(records: DataFrame, folder: str, compression: str = "gzip", mode: str = "append") -> None:
    """Writes rows with (some of) the columns of ``SCHEMA``; headers of other names go along as they are."""
    records.sparkSession.dataSource.register(WarcDataSource)
    records.write.format(FORMAT).mode(mode).option("compression", compression).save(folder)


def page_records(pages: DataFrame, least: int = 0, pieces: int = 64) -> DataFrame:
    """One record per row of ``pages`` (page_id, url, html), as :func:`write_warc` takes it.

    The payload is the html in UTF-8, empty where it is null. Of records with equal payloads of at least ``least``
    bytes the one with the largest page_id is the response and the others revisit it; smaller ones are all
    responses. Rows that repeat this page_id are responses too, and so are all where no row of the group has an
    id. A null id sorts below all others, a null url stays null. Other columns are ignored.

    The largest id of each payload is found on (digest, piece) first, so that the many copies of one payload are
    combined in ``pieces`` groups per digest, and pages meet their group's result under the same key: no task
    gets all copies. Html moves only if the repeated payloads are too many to be broadcast.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    size = F.octet_length("payload").cast("long")
    rows = rows.withColumn("k", F.sha2("payload", 256)).withColumn("payload_bytes", size)
    rows = rows.withColumn("piece", F.pmod(F.xxhash64("page_id"), F.lit(pieces)))
    parts = rows.where(F.col("payload_bytes") >= least).groupBy("k", "piece").agg(F.max("page_id").alias("most"), F.count(F.lit(1)).alias("n"))
    whole = parts.groupBy("k").agg(F.max("most").alias("top"), F.sum("n").alias("n")).where("n > 1 and top is not null").select("k", "top")
    repeated = parts.select("k", "piece").join(whole, "k")
    found = rows.join(repeated, ["k", "piece"], "left")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return found.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        record_id(F.col("page_id"), F.col("k")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(revisit, record_id(F.col("top"), F.col("k"))).alias("refers_to"),
        "payload_bytes",
        F.create_map(F.lit("page-id"), F.col("page_id").cast("string"), F.lit("refers-to-page-id"), F.when(revisit, F.col("top")).cast("string")).alias("headers"),
        "payload",
    )


def record_id(page_id, key):
    """A record id that follows from page and payload, so that a task that runs again writes the same."""
    h = F.md5(F.concat_ws(":", F.coalesce(page_id.cast("string"), F.lit("")), key))
    parts = [F.substring(h, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def archived_pages(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Writes the pages as WARC files and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Responses are read with their payloads, which must have their digests; of revisits only the headers. See
    :func:`page_records` for nulls, empty payloads and repeated rows; an empty table gives no rows. A very long
    page is held once by the task that writes or reads it.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    write_warc(page_records(pages, least), folder)
    responses = read_warc(spark, folder, record_type="response").withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    revisits = read_warc(spark, folder, payload=False, record_type="revisit")
    header = lambda name: F.col("headers")[name].cast("long")
    return responses.unionByName(revisits).select(
        header("page-id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", header("refers-to-page-id").alias("refers_to")
    )
