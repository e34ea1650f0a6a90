"""WARC archives as a Python data source, read and written by Spark.

Reading: each partition is a group of whole files. A record's headers are parsed first; if its type or headers
fail the pushed predicates, or the wanted columns leave out the payload, the rest is skipped without decoding it.
Compressed archives hold one gzip member a record, whose ``sl`` extra field gives its compressed length, so that a
reader can step over it; members without that field are read through.

Writing: one file or more for each task, first in a temporary folder of the job's own; commit moves them in place and, if
the archive is to be overwritten, only then deletes what was there.

Columns: ``record_type, record_id, target_uri, refers_to, payload_digest, payload_length, payload, headers``.
``payload_length`` and ``payload_digest`` describe the full payload, also in a revisit record, which has none of its own.
Nulls: a null payload is written as an empty one, other null columns as missing headers, which read back as null. Empty
tables make an archive without files, which reads as no rows. A payload of any length is written and read whole. Repeated rows make a record
each. Columns of the input that the format doesn't name are left out.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage,
)

from cairn.llm.common import materialize, scratch_path, table

SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_length bigint, "
    "payload binary, headers map<string,string>"
)
#: Header of each column. Fixed values of the format.
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_HEAD = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x0c\0sl\x08\0"
HEAD_STEP = 4096


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def safe(value: object) -> str:
    """A header value on one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(value))


def render(record_type: str, record_id: str, payload: bytes, *, target_uri: str | None = None, refers_to: str | None = None, payload_digest: str | None = None, date: str = "2000-01-01T00:00:00Z", extra: Iterable[tuple[str, str]] = ()) -> bytes:
    """One record. A revisit keeps the HTTP headers, with the full payload's length, and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if record_type == "revisit" else http + payload
    fields = [
        ("WARC-Type", record_type), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Target-URI", target_uri), ("WARC-Refers-To", refers_to),
        ("WARC-Payload-Digest", payload_digest), ("WARC-Profile", REVISIT_PROFILE if record_type == "revisit" else None), *extra,
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block)),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {safe(v)}\r\n" for k, v in fields if v is not None) + "\r\n"
    return head.encode("utf-8", "replace") + block + b"\r\n\r\n"


def member(record: bytes, level: int = 1) -> bytes:
    """A gzip member whose extra field gives its own length and the record's; zeros where 32 bits can't."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(record) + squeeze.flush()
    size = len(GZIP_HEAD) + 8 + len(body) + 8
    lengths = struct.pack("<II", size, len(record)) if max(size, len(record)) < 2**32 else bytes(8)
    return GZIP_HEAD + lengths + body + struct.pack("<II", zlib.crc32(record), len(record) % 2**32)


class Member:
    """The gzip member that starts at the file's position; decodes no more than is asked for."""

    def __init__(self, file: pa.NativeFile, head: bytes) -> None:
        self.file, self.start = file, file.tell() - len(head)
        flags, self.size = head[3], None
        if flags & 4:
            extra = file.read(struct.unpack("<H", head[10:12])[0])
            at = 0
            while at + 4 <= len(extra):
                n = struct.unpack("<H", extra[at + 2 : at + 4])[0]
                if extra[at : at + 2] == b"sl" and n == 8:
                    self.size = struct.unpack("<I", extra[at + 4 : at + 8])[0] or None
                at += 4 + n
            file.seek(self.start)
        else:
            file.seek(self.start)
        self.inflate = zlib.decompressobj(31)
        self.waiting = b""

    def read(self, n: int) -> bytes:
        out = []
        while n > 0 and not self.inflate.eof:
            data = self.waiting or self.file.read(HEAD_STEP if n <= HEAD_STEP else 1 << 20)
            if not data:
                break
            got = self.inflate.decompress(data, n)
            self.waiting = self.inflate.unconsumed_tail
            out.append(got)
            n -= len(got)
        return b"".join(out)

    def close(self) -> None:
        """Go to the next member: by the known length, else by reading through."""
        if self.size:
            self.file.seek(self.start + self.size)
            return
        while not self.inflate.eof:
            if not self.read(1 << 20):
                break
        self.file.seek(self.file.tell() - len(self.inflate.unused_data))


class Plain:
    """A record of an uncompressed archive."""

    def __init__(self, file: pa.NativeFile, head: bytes) -> None:
        file.seek(file.tell() - len(head))
        self.file, self.end = file, None

    def read(self, n: int) -> bytes:
        return self.file.read(n)

    def close(self) -> None:
        self.file.seek(self.end)


@dataclass
class Record:
    headers: dict[str, str]
    http_length: int | None
    payload: bytes | None


def records(file: pa.NativeFile, wanted: dict[str, set[str]], payloads: bool) -> Iterator[Record]:
    """Records whose headers have one of the wanted values; payloads are decoded only for these, and only if asked for."""
    size = file.size()
    while file.tell() < size:
        head = file.read(12)
        if not head.strip():
            continue
        zipped = head[:2] == b"\x1f\x8b"
        if not zipped and (lead := len(head) - len(head.lstrip())):
            file.seek(file.tell() - len(head) + lead)
            head = file.read(12)
        source = Member(file, head) if zipped else Plain(file, head)
        begin = file.tell()
        data = b""
        while b"\r\n\r\n" not in data:
            more = source.read(HEAD_STEP)
            if not more:
                raise ValueError("a record's headers don't end")
            data += more
        top, _, rest = data.partition(b"\r\n\r\n")
        lines = top.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        length = int(headers["Content-Length"])
        if not zipped:
            source.end = begin + len(top) + 4 + length + 4
        if all(headers.get(k) in v for k, v in wanted.items()):
            http = headers.get("Content-Type", "").startswith("application/http")
            while http and b"\r\n\r\n" not in rest and len(rest) < length:
                rest += source.read(HEAD_STEP)
            http_head, _, body = rest[:length].partition(b"\r\n\r\n") if http else (b"", b"", rest[:length])
            full = next((int(x[15:]) for x in http_head.decode("latin-1").split("\r\n") if x.lower().startswith("content-length:")), None) if http else length
            own = length - len(http_head) - 4 if http else length
            if payloads and headers.get("WARC-Type") != "revisit":
                if own > len(body):
                    body += source.read(own - len(body))
                yield Record(headers, full, body[:own])
            else:
                yield Record(headers, full, None)
        source.close()


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, partition_bytes: int) -> None:
        self.path, self.schema, self.partition_bytes = path, schema, partition_bytes
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Equality and membership on the columns that headers hold, and on keys of ``headers``, are decided before decoding."""
        for f in filters:
            if isinstance(f, (EqualTo, In)):
                name = HEADERS.get(f.attribute[0]) if len(f.attribute) == 1 else f.attribute[1] if f.attribute[0] == "headers" and len(f.attribute) == 2 else None
                if name and name != "WARC-Payload-Digest" and name not in ("WARC-Record-ID", "WARC-Refers-To"):
                    values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                    self.wanted[name] = self.wanted.get(name, values) & values
                    continue
            if not (isinstance(f, IsNotNull) and f.attribute == ("record_type",)):
                yield f

    def partitions(self) -> list[Files]:
        fs, root = filesystem(self.path)
        info = fs.get_file_info(root)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(root, recursive=True))
        files = sorted((i.path, i.size) for i in found if i.type == pafs.FileType.File and i.base_name.endswith((".warc", ".warc.gz")) and "/_" not in i.path[len(root) :])
        groups: list[Files] = []
        room = 0
        for path, size in files:
            if not groups or size > room:
                groups.append(Files([]))
                room = self.partition_bytes
            groups[-1].paths.append(path)
            room -= size
        return groups or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        fs, _ = filesystem(self.path)
        schema = to_arrow_schema(self.schema)
        rows: list[dict] = []
        held = 0
        for path in partition.paths:
            with fs.open_input_file(path) as file:
                for r in records(file, self.wanted, "payload" in schema.names):
                    h = r.headers
                    row = {c: h.get(k) for c, k in HEADERS.items()} | {"payload_length": r.http_length, "payload": r.payload, "headers": list(h.items())}
                    for c in ("record_id", "refers_to"):
                        row[c] = row[c] and row[c].removeprefix("<").removesuffix(">")
                    row["payload_digest"] = row["payload_digest"] and row["payload_digest"].rpartition(":")[2]
                    rows.append({c: row.get(c) for c in schema.names})
                    held += len(r.payload or b"") + 200
                    if held > 8_000_000 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, compress: bool, file_bytes: int) -> None:
        self.path, self.overwrite, self.compress, self.file_bytes = path, overwrite, compress, file_bytes
        self.own = f"_temporary-{uuid.uuid4().hex}"
        fs, root = filesystem(path)
        fs.create_dir(f"{root}/{self.own}", recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = filesystem(self.path)
        names: list[str] = []
        out, size = None, 0
        try:
            for batch in iterator:
                own = {c: batch.column(c) if c in batch.schema.names else None for c in ("record_type", "record_id", "target_uri", "refers_to", "payload_digest", "payload", "headers")}
                for i in range(batch.num_rows):
                    row = {c: v[i].as_py() if v is not None else None for c, v in own.items()}
                    if out is None or size >= self.file_bytes:
                        if out:
                            out.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc{'.gz' * self.compress}")
                        out, size = fs.open_output_stream(f"{root}/{self.own}/{names[-1]}", compression=None), 0
                    bracketed = {c: row[c] and f"<{row[c]}>" for c in ("record_id", "refers_to")}
                    data = render(
                        row["record_type"] or "response", bracketed["record_id"] or f"<urn:uuid:{uuid.uuid4()}>", row["payload"] or b"", target_uri=row["target_uri"], refers_to=bracketed["refers_to"],
                        payload_digest=row["payload_digest"] and f"sha256:{row['payload_digest']}", extra=row["headers"] or (),
                    )
                    data = member(data) if self.compress else data
                    out.write(data)
                    size += len(data)
        finally:
            if out:
                out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = filesystem(self.path)
        before = [i for i in fs.get_file_info(pafs.FileSelector(root)) if not i.base_name.startswith("_temporary-")] if self.overwrite else []
        for m in messages:
            for name in m.names if m else ():
                fs.move(f"{root}/{self.own}/{name}", f"{root}/{name}")
        for i in before:
            fs.delete_dir(i.path) if i.type == pafs.FileType.Directory else fs.delete_file(i.path)
        fs.delete_dir(f"{root}/{self.own}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = filesystem(self.path)
        fs.delete_dir(f"{root}/{self.own}")


class WarcDataSource(DataSource):
    """Options: path; compress (true); partitionBytes to read, and fileBytes to write, at once (128 MB)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema, int(self.options.get("partitionbytes", 128 << 20)))

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite, self.options.get("compress", "true") == "true", int(self.options.get("filebytes", 128 << 20)))


def register(spark: SparkSession) -> None:
    """Make format("warc") known, and let it decide predicates itself."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The archive's records; a payload that ``columns`` leaves out is never decoded."""
    register(spark)
    every = T.StructType.fromDDL(SCHEMA)
    return spark.read.format("warc").schema(T.StructType([every[c] for c in columns]) if columns else every).load(path)


def write_warc(rows: DataFrame, path: str, compress: bool = True) -> None:
    register(rows.sparkSession)
    rows.write.format("warc").option("compress", str(compress).lower()).mode("append").save(path)


PAGE = "urn:x-page:"
NO_PAGE = "urn:x-no-page:"


def page_urn(page_id: Column) -> Column:
    """The id of a page's record; any text comes back from it, and a null too (``page_of``)."""
    return F.coalesce(F.concat(F.lit(PAGE), F.url_encode(page_id.cast("string"))), F.lit(NO_PAGE))


def page_of(urn: Column) -> Column:
    return F.when(urn.startswith(PAGE), F.url_decode(F.substr(urn, F.lit(len(PAGE) + 1))))


def with_revisits(pages: DataFrame, least_bytes: int = 100, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """WARC rows of pages: of equal payloads of ``least_bytes`` or more, that with the smallest id is the response, the others revisit it.

    Rows that share the smallest id are all responses; where no row of a group has an id, so are all of them. Short pages, which
    equal many, are dealt by their own row, and a payload that many pages share meets its one row of ``first`` in parts.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("target_uri"), payload.alias("payload"), F.sha2(payload, 256).alias("payload_digest"))
    long = own.where(F.octet_length("payload") >= least_bytes)
    first = long.groupBy("payload_digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & F.col("first").isNotNull())
    first = materialize(first.select(F.col("payload_digest").alias("met_by"), "first"), "first-pages")
    alone = F.concat(F.lit("-"), F.xxhash64("id", "target_uri").cast("string"))
    own = own.withColumn("met_by", F.when(F.octet_length("payload") >= least_bytes, F.col("payload_digest")).otherwise(alone))
    both = own.join(first, "met_by", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return both.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), page_urn(F.col("id")).alias("record_id"), "target_uri",
        F.when(again, page_urn(F.col("first"))).alias("refers_to"), "payload_digest", "payload",
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    write_warc(with_revisits(pages), path)
    own = lambda c: page_of(F.col(c)).cast(pages.schema["page_id"].dataType)
    digest = F.when(F.col("payload").isNotNull(), F.sha2("payload", 256)).otherwise(F.col("payload_digest"))
    length = F.coalesce(F.octet_length("payload").cast("long"), F.col("payload_length"))
    got = read_warc(spark, path, ["record_type", "record_id", "refers_to", "payload_digest", "payload_length", "payload"])
    return got.select(own("record_id").alias("page_id"), length.alias("payload_bytes"), digest.alias("payload_digest"), "record_type", own("refers_to").alias("refers_to"))


OP9_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS f FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN f IS NOT NULL AND page_id IS DISTINCT FROM f THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN f IS NOT NULL AND page_id IS DISTINCT FROM f THEN f END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""
