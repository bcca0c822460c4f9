"""WARC archives as a PySpark Python data source, for reading and writing.

Reading plans one partition per file, takes predicates on the record type and on headers before the scan, parses a
record's headers first and inflates its payload only if the record is wanted and its payload asked for. Compressed
archives hold one gzip member per record; those written here carry the member's length in an extra field of its header,
so that the reader passes over what it doesn't want without inflating it. Other archives, plain or compressed without
that field, are read through.

Writing goes by tasks to files of about `roll` bytes under temporary names, which the commit of the job moves into
place; what a lost or repeated task has written is never seen. Paths may be local or of any store that pyarrow.fs opens.

Defined results: a null payload is empty; null headers are left out; an empty table gives an archive folder without
files, which reads as no records; control characters in URIs are escaped; a truncated record raises an error.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, WriterCommitMessage

from termloom.operators.lineage import new_path

SCHEMA = "record_id string, record_type string, target_uri string, date string, payload_digest string, refers_to string, payload_bytes long, payload binary, file string, offset long"
#: Columns that are WARC headers, so that predicates on them can be decided before the payload.
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
UNKNOWN = 0xFFFFFFFF


def _store(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def record_bytes(kind: str, record_id: str, uri: str | None, digest: str, payload: bytes, refers_to: str | None = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC record; a revisit keeps the HTTP headers and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    clean = lambda s: re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", s)
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Target-URI", clean(uri) if uri else None), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Refers-To", f"<{refers_to}>" if refers_to else None), ("WARC-Profile", REVISIT if kind == "revisit" else None), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def member(record: bytes, level: int = 6) -> bytes:
    """A gzip member with its own and the record's length in the extra field `sl`."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(record) + z.flush()
    size = 24 + len(body) + 8
    lengths = struct.pack("<II", size if size < UNKNOWN else UNKNOWN, min(len(record), UNKNOWN))
    return b"\x1f\x8b\x08\x04" + b"\0" * 5 + b"\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<H", 8) + lengths + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


class _Plain:
    """A record's bytes from an archive without compression."""

    def __init__(self, f, at: int, chunk: int):
        self.f, self.at, self.end, self.chunk = f, at, None, chunk
        f.seek(at)
        self.buf = b""

    def need(self, n: int) -> bool:
        while len(self.buf) < n:
            more = self.f.read(max(self.chunk, n - len(self.buf)))
            if not more:
                return False
            self.buf += more
        return True

    def finish(self, length: int) -> int:
        """Where the next record starts, given the record's length up to its block's end."""
        at = self.at + length
        self.f.seek(at)
        tail = self.f.read(64)
        return at + len(tail) - len(tail.lstrip(b"\r\n"))


class _Member:
    """A record's bytes from a gzip member, inflated as far as needed."""

    def __init__(self, f, at: int, chunk: int):
        self.f, self.at, self.chunk, self.size = f, at, chunk, None
        f.seek(at)
        head = f.read(24)
        if len(head) >= 24 and head[3] == 4 and head[12:14] == b"sl":
            size = struct.unpack("<I", head[16:20])[0]
            self.size = size if size < UNKNOWN else None
        f.seek(at)
        self.z, self.buf, self.used = zlib.decompressobj(31), b"", 0

    def need(self, n: int) -> bool:
        parts, have = [self.buf], len(self.buf)
        while have < n and not self.z.eof:
            raw = self.z.unconsumed_tail or self.f.read(self.chunk)
            if not raw:
                break
            out = self.z.decompress(raw, max(4096, n - have))
            parts.append(out)
            have += len(out)
        self.buf = b"".join(parts)
        return have >= n

    def finish(self, length: int) -> int:
        if self.size is not None:
            return self.at + self.size
        while not self.z.eof:
            raw = self.z.unconsumed_tail or self.f.read(self.chunk)
            if not raw:
                raise ValueError(f"truncated record at {self.at}")
            self.z.decompress(raw, 1 << 20)
        return self.f.tell() - len(self.z.unused_data)


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        out[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
    return out


def _column(h: dict[str, str], name: str) -> str | None:
    v = h.get(HEADERS[name])
    if v is not None and name in ("record_id", "refers_to"):
        v = v.removeprefix("<").removesuffix(">")
    return v


def read_file(path: str, wanted, payload_of, chunk: int = 1 << 16) -> Iterator[tuple]:
    """Records of an archive as rows of SCHEMA. wanted(headers) decides before, payload_of(type) after the headers."""
    store, inner = _store(path)
    with store.open_input_file(inner) as f:
        total, at = f.size(), 0
        f.seek(0)
        compressed = f.read(2) == b"\x1f\x8b"
        while at < total:
            rec = (_Member if compressed else _Plain)(f, at, chunk)
            end = -1
            while end < 0:
                grown = rec.need(len(rec.buf) + 1)
                end = rec.buf.find(b"\r\n\r\n")
                if not grown and end < 0:
                    raise ValueError(f"{path}: no record header at {at}")
            h = _headers(rec.buf[:end])
            start, length = end + 4, int(h["content-length"])
            if wanted(h):
                kind, payload, size = h.get("warc-type"), None, length
                if "application/http" in h.get("content-type", ""):
                    cut = -1
                    while cut < 0:
                        cut = rec.buf.find(b"\r\n\r\n", start, start + length)
                        if cut < 0 and not rec.need(min(len(rec.buf) + 1024, start + length)):
                            raise ValueError(f"{path}: truncated record at {at}")
                        if cut < 0 and len(rec.buf) >= start + length and rec.buf.find(b"\r\n\r\n", start, start + length) < 0:
                            raise ValueError(f"{path}: no HTTP header at {at}")
                    http = _headers(rec.buf[start:cut])
                    body = cut + 4
                    size = int(http.get("content-length", start + length - body))
                else:
                    body = start
                if payload_of(kind):
                    if not rec.need(start + length):
                        raise ValueError(f"{path}: truncated record at {at}")
                    payload = rec.buf[body : start + length]
                yield (*(_column(h, n) for n in HEADERS), size, payload, path, at)
            at = rec.finish(start + length)


@dataclass
class _File(InputPartition):
    path: str


@dataclass
class _Written(WriterCommitMessage):
    files: list


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload, self.filters = options["path"], options.get("payload", "all"), []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") else None
            if len(getattr(f, "attribute", ())) == 1 and name in HEADERS and isinstance(f, (EqualTo, In, IsNotNull)):
                self.filters.append((name, None if isinstance(f, IsNotNull) else {f.value} if isinstance(f, EqualTo) else set(f.value)))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        store, inner = _store(self.path)
        info = store.get_file_info(inner)
        if info.type == fs.FileType.File:
            return [_File(self.path)]
        found = store.get_file_info(fs.FileSelector(inner, allow_not_found=True, recursive=False))
        names = sorted(x.base_name for x in found if x.type == fs.FileType.File and x.base_name.endswith((".warc", ".warc.gz")))
        return [_File(f"{self.path.rstrip('/')}/{n}") for n in names] or [_File("")]

    def read(self, partition):
        import pyarrow as pa

        kinds = [pa.string()] * 6 + [pa.int64(), pa.binary(), pa.string(), pa.int64()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        types = {"all": None, "none": set()}.get(self.payload, set(self.payload.split(",")))

        def wanted(h):
            return all((v := _column(h, n)) is not None and (s is None or v in s) for n, s in self.filters)

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=t) for i, t in enumerate(kinds)], names=names)

        rows, size = [], 0
        for r in read_file(partition.path, wanted, lambda k: types is None or k in types) if partition.path else ():
            rows.append(r)
            size += 200 + len(r[7] or b"")
            if size >= 4_000_000:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)


class WarcWriter(DataSourceArrowWriter):
    """Takes the columns record_type, record_id, target_uri, payload_digest, refers_to and payload."""

    def __init__(self, options: dict):
        self.path, self.roll, self.level = options["path"].rstrip("/"), int(options.get("roll", 64 << 20)), int(options.get("level", 6))
        self.temp = f"{self.path}/_temporary-{uuid.uuid4().hex}"

    def write(self, iterator):
        store, inner = _store(self.temp)
        store.create_dir(inner, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for r in batch.to_pylist():
                if out is None or size >= self.roll:
                    if out:
                        out.close()
                    files.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{inner}/{files[-1]}", compression=None), 0
                size += out.write(m := member(record_bytes(r["record_type"], r["record_id"], r["target_uri"], r["payload_digest"], r["payload"] or b"", r["refers_to"]), self.level)) or len(m)
        if out:
            out.close()
        return _Written(files)

    def commit(self, messages):
        store, temp = _store(self.temp)
        _, final = _store(self.path)
        store.create_dir(final, recursive=True)
        names = [n for m in messages if m for n in m.files]
        for i, n in enumerate(sorted(names)):
            store.move(f"{temp}/{n}", f"{final}/part-{i:06d}-{n}")
        self.abort(messages)

    def abort(self, messages):
        store, temp = _store(self.temp)
        from pyarrow import fs

        if store.get_file_info(temp).type == fs.FileType.Directory:
            store.delete_dir(temp)


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options))


def register(spark) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def archive_records(pages: DataFrame, least: int = 100) -> DataFrame:
    """Records of pages (page_id, url, html): the first of equal payloads is a response, the others revisit it.

    Of rows that tie for the smallest page_id of a payload, each is a response. A null page_id never leads its payload
    unless all of its rows have none.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    p = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("payload_digest"))
    small = F.octet_length("payload") < least
    lead = pages.select("page_id", payload.alias("payload")).where(~small).select("page_id", F.sha2("payload", 256).alias("payload_digest"))
    lead = lead.groupBy("payload_digest").agg(F.min("page_id").alias("lead"), F.count("*").alias("n")).where("n > 1").select("payload_digest", "lead")
    p = p.join(lead, "payload_digest", "left")
    again = ~small & F.col("lead").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") != F.col("lead")))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("null")))
    return p.select(F.when(again, "revisit").otherwise("response").alias("record_type"), urn(F.col("page_id")).alias("record_id"), F.col("url").alias("target_uri"), "payload_digest", F.when(again, urn(F.col("lead"))).alias("refers_to"), "payload")


def op10_warc(spark, sf_dir: str) -> DataFrame:
    register(spark)
    path = new_path(spark, "warc")
    archive_records(spark.read.parquet(f"{sf_dir}/pages.parquet")).write.format("warc").mode("append").save(path)
    r = spark.read.format("warc").option("payload", "response").load(path)
    page = lambda c: F.expr(f"try_cast(substring({c}, 10) as bigint)")
    # What a response holds is measured and hashed again; a revisit gives what its headers say.
    size = F.when(F.col("record_type") == "response", F.octet_length("payload")).otherwise(F.col("payload_bytes"))
    digest = F.when(F.col("record_type") == "response", F.sha2("payload", 256)).otherwise(F.expr("substring(payload_digest, 8)"))
    return r.select(page("record_id").alias("page_id"), size.cast("long").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"))


OP10_SQL = """
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
d as (select page_id, octet_length(b) as n, sha256(b) as h from p),
f as (select h, min(page_id) as lead from d where n >= 100 group by h)
select page_id, n::bigint as payload_bytes, d.h as payload_digest,
       case when lead is not null and page_id <> lead then 'revisit' else 'response' end as record_type,
       case when page_id <> lead then lead end as refers_to
from d left join f on d.h = f.h and d.n >= 100
"""
