"""WARC archives: a sharded writer whose files depend on the data alone, and a reader that checks every digest.

Pages are dealt to shards by ranges of (page_id, payload digest), whose bounds come from a sample chosen by hash, so the same pages
give the same files on any cluster. A task streams its sorted rows into gzip members, one per record, and starts a new file when
the next member would pass the size limit. Files are written under names of their own for each attempt; once all tasks are done they
get their final names, and last of all a manifest appears, which alone says what belongs to the archive. A lost executor or a
broken run leaves nothing a reader would take up.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import Stored, drop_all, join_by_weight

FILE_BYTES = 256 << 20  # compressed
SPLIT_BYTES = 32 << 20  # a reading task takes about so much of a file
SHARD_BYTES, MOST_SHARDS = 16 << 20, 20_000  # payload of a shard; beyond so many shards they grow instead
SAMPLE_A_SHARD = 50
LEAST_SHARED = 100  # bytes of payload below which equal payloads are stored again
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "manifest.jsonl"
# Fixed values of the WARC format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

RECORD = ("file string, offset long, record_id string, record_type string, target_uri string, date string, page_id long, "
          "refers_to long, payload_bytes long, payload_digest string, payload binary")


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system behind a path (local, file://, hdfs://, s3://, gs://) and the path in it."""
    return fs.FileSystem.from_uri(path if re.match(r"\w+://|file:", path) else f"file://{path}")


def record_id(page_id: int | None, digest: str, copy: int = 0) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}:{digest[:32]}:{copy}>"


def page_of(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+):.*>", name or "")
    return int(found[1]) if found else None


def header_uri(url: str) -> str:
    """A url that fits into one header line: white space and control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [*fields, ("WARC-Block-Digest", f"sha256:{_sha(block)}"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in lines).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # gzip without a time or a name
    return packer.compress(VERSION + head + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, copy: int, target: int | None, date: str) -> bytes:
    """A response, or a revisit of page ``target`` that has the HTTP header but no payload."""
    digest, http = _sha(payload), HTTP.format(len(payload)).encode()
    fields = [("WARC-Type", "response" if target is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest, copy)),
              ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", header_uri(url)))
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if target is None:
        return _member(fields, http + payload)
    return _member([*fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(target, digest))], http)


def info_record(name: str, date: str) -> bytes:
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{name}>"), ("WARC-Date", date), ("WARC-Filename", name),
              ("Content-Type", "application/warc-fields")]
    return _member(fields, b"format: WARC File Format 1.1\r\n")


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


class ArchiveWriter(DataSourceArrowWriter):
    """Writes the sorted rows of a partition (page_id, url, payload, digest, refers_to, kind) into files; the driver names and lists them.

    A row of kind 0 goes before the pages of its page_id and digest and says which page they revisit.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.limit, self.date = int(options["file_bytes"]), options["date"]
        self.staging = f"_staging-{options['job']}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        at, root = store(self.path)
        task = TaskContext.get()
        shard, attempt = task.partitionId(), task.taskAttemptId()
        at.create_dir(f"{root}/{self.staging}", recursive=True)
        files: list[dict] = []
        out, entry = None, None

        def finish() -> None:
            if out is not None:
                out.close()
                entry["sha256"] = entry["sha256"].hexdigest()
                files.append(entry)

        def put(data: bytes) -> None:
            out.write(data)
            entry["sha256"].update(data)
            entry["bytes"] += len(data)

        current, copies, target = None, 0, None
        for batch in batches:
            for page, url, payload, digest, refers, kind in zip(*(batch.column(i) for i in range(6))):
                key = (page.as_py(), digest.as_py())
                if key != current:
                    current, copies, target = key, 0, None
                if kind.as_py() == 0:
                    target = refers.as_py()
                    continue
                body, at_page = payload.as_py(), target
                if at_page is None and copies and key[0] is not None and len(body) >= LEAST_SHARED:
                    at_page = key[0]
                member = page_record(key[0], url.as_py(), body, copies, at_page, self.date)
                copies += 1
                if out is None or entry["bytes"] + len(member) > self.limit and entry["records"]:
                    finish()
                    name = f"part-{shard:05d}-{len(files):04d}.warc.gz"
                    entry = {"name": name, "temporary": f"{self.staging}/{attempt}-{name}", "bytes": 0, "records": 0, "splits": [],
                             "sha256": hashlib.sha256()}
                    out = at.open_output_stream(f"{root}/{entry['temporary']}", compression=None)
                    put(info_record(name, self.date))
                if entry["bytes"] - (entry["splits"][-1] if entry["splits"] else 0) >= SPLIT_BYTES:
                    entry["splits"].append(entry["bytes"])
                put(member)
                entry["records"] += 1
        finish()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        at, root = store(self.path)
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: f["name"])
        former = read_manifest(self.path) if self.overwrite else []
        if former:  # a broken overwrite leaves no archive rather than a mixed one
            at.delete_file(f"{root}/{MANIFEST}")
        at.create_dir(f"{root}/{self.staging}", recursive=True)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda f: at.move(f"{root}/{f['temporary']}", f"{root}/{f['name']}"), files))
        with at.open_output_stream(f"{root}/{self.staging}/{MANIFEST}") as out:
            for f in files:
                out.write((json.dumps({k: v for k, v in f.items() if k != "temporary"}, sort_keys=True) + "\n").encode())
        at.move(f"{root}/{self.staging}/{MANIFEST}", f"{root}/{MANIFEST}")
        for name in {f["name"] for f in former} - {f["name"] for f in files}:
            at.delete_file(f"{root}/{name}")
        at.delete_dir(f"{root}/{self.staging}")

    def abort(self, messages: list[Written | None]) -> None:
        at, root = store(self.path)
        if at.get_file_info(f"{root}/{self.staging}").type != fs.FileType.NotFound:
            at.delete_dir(f"{root}/{self.staging}")


def read_manifest(path: str) -> list[dict]:
    """One entry per file of a complete archive: name, bytes, records, sha256, splits; empty if there is none."""
    at, root = store(path)
    if at.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.NotFound:
        return []
    with at.open_input_stream(f"{root}/{MANIFEST}") as f:
        return [json.loads(line) for line in f.read().decode().splitlines()]


@dataclass
class Stretch(InputPartition):
    name: str
    start: int
    end: int


def members(stream, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of the gzip members that begin in [start, end)."""
    stream.seek(start)
    at, left = start, b""
    while at < end:
        unpack, parts, size = zlib.decompressobj(31), [], 0
        while not unpack.eof:
            data = left or stream.read(1 << 18)
            if not data:
                raise ValueError(f"an archive ends inside the record at {at}")
            parts.append(unpack.decompress(data))
            size += len(data) - len(unpack.unused_data)
            left = unpack.unused_data
        yield at, b"".join(parts)
        at += size


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; raises if its length or block digest is wrong."""
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if not head.startswith(b"WARC/") or rest[len(block):] != b"\r\n\r\n" or len(block) != int(fields["Content-Length"]):
        raise ValueError("not a whole WARC record")
    if fields.get("WARC-Block-Digest", f"sha256:{_sha(block)}") != f"sha256:{_sha(block)}":
        raise ValueError(f"wrong block digest of {fields.get('WARC-Record-ID')}")
    return fields, block


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path, self.payloads, self.schema = options["path"], options.get("payloads", "true") == "true", schema

    def partitions(self) -> list[Stretch]:
        out = []
        for f in read_manifest(self.path):
            cuts = [0, *f["splits"], f["bytes"]]
            out += [Stretch(f["name"], a, b) for a, b in zip(cuts, cuts[1:])]
        return out or [Stretch("", 0, 0)]

    def read(self, part: Stretch) -> Iterator[pa.RecordBatch]:
        if not part.name:
            return
        at, root = store(self.path)
        rows, held = [], 0
        with at.open_input_file(f"{root}/{part.name}") as stream:
            for offset, content in members(stream, part.start, part.end):
                fields, block = parse(content)
                if fields["WARC-Type"] == "warcinfo":
                    continue
                http, _, payload = block.partition(b"\r\n\r\n")
                n = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
                digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                if fields["WARC-Type"] == "response" and (len(payload) != n or _sha(payload) != digest):
                    raise ValueError(f"wrong payload of {fields['WARC-Record-ID']}")
                kept = payload if self.payloads and fields["WARC-Type"] == "response" else None
                rows.append((part.name, offset, fields["WARC-Record-ID"], fields["WARC-Type"], fields.get("WARC-Target-URI"),
                             fields["WARC-Date"], page_of(fields["WARC-Record-ID"]), page_of(fields.get("WARC-Refers-To")), n, digest, kept))
                held += len(kept or b"") + 200
                if held > 8 << 20:
                    yield self._batch(rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        fields = [f.split() for f in RECORD.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], [n for n, _ in fields])


class Archive(DataSource):
    """Spark source and sink ``warc_archive`` of a folder of WARC files with a manifest."""

    @classmethod
    def name(cls) -> str:
        return "warc_archive"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(dict(self.options), schema)

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        if not overwrite and read_manifest(self.options["path"]):
            raise ValueError("there is an archive in this folder already")
        return ArchiveWriter(dict(self.options), overwrite)


def _bounds(rows: DataFrame) -> list[tuple[int, str]]:
    """Upper ends of the shards but for the last, as (page_id, digest): about equal payload by a sample chosen by hash."""
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("payload")).alias("bytes")).first()
    shards = min(MOST_SHARDS, -(-(size["bytes"] or 0) // SHARD_BYTES))
    if shards < 2:
        return []
    share = min(1.0, SAMPLE_A_SHARD * shards / size["rows"])
    chosen = rows.where(F.pmod(F.xxhash64("page_id", "digest"), F.lit(1 << 32)) < int(share * (1 << 32)))
    sample = sorted(tuple(r) for r in chosen.select("place", "digest", (F.octet_length("payload") + 500).alias("bytes")).collect())
    whole, so_far, bounds = sum(r[2] for r in sample), 0, []
    for place, digest, bytes_ in sample:
        so_far += bytes_
        if so_far * shards >= whole * (len(bounds) + 1) and len(bounds) < shards - 1 and (place, digest) not in bounds[-1:]:
            bounds.append((place, digest))
    return bounds


def write_archive(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES, date: str = DATE, mode: str = "append") -> None:
    """Write one record per row of ``pages`` (page_id, url, html) into WARC files below ``path``.

    The payload is the html in UTF-8, null being empty. Of rows with equal payloads of at least 100 bytes the one with the smallest
    page_id is a response and the others revisit it; of rows equal in page_id too one is the response. Shorter payloads, and those of rows
    without page_id (which come first in the archive), are always responses. A null url gives no target header. A record larger
    than ``file_bytes`` gets a file of its own; an empty table gives an archive without files. Very long payloads are held one
    at a time besides Spark's own batch. Further columns are ignored. ``mode``: append (refused where an archive exists) or overwrite.
    """
    spark = pages.sparkSession
    spark.dataSource.register(Archive)
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("place", F.coalesce("page_id", F.lit(-(1 << 63))))
    long = rows.where(F.col("page_id").isNotNull() & (F.octet_length("payload") >= LEAST_SHARED))
    named = Stored(long.select("page_id", "digest").distinct(), "digests")
    first = named.df.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("page_id").alias("copies"))
    shared = Stored(first.where("copies > 1"), "shared")
    revisits = join_by_weight(named.df, shared.df, "digest", "copies").where("page_id <> refers_to")
    marks = revisits.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest",
                            "refers_to", F.lit(0).alias("kind"), F.col("page_id").alias("place"))
    bounds = _bounds(rows)
    shared_bounds = spark.sparkContext.broadcast(bounds)

    @F.arrow_udf("int")
    def shard(place: pa.Array, digest: pa.Array) -> pa.Array:
        ends = shared_bounds.value
        return pa.array([bisect_right(ends, key) for key in zip(place.to_pylist(), digest.to_pylist())], pa.int32())

    none = F.lit(None).cast("long").alias("refers_to")
    both = rows.select("page_id", "url", "payload", "digest", none, F.lit(1).alias("kind"), "place").unionByName(marks)
    dealt = both.withColumn("shard", shard("place", "digest")).repartitionById(len(bounds) + 1, "shard")
    ordered = dealt.sortWithinPartitions("page_id", "digest", "kind", "url")
    ordered = ordered.select("page_id", "url", "payload", "digest", "refers_to", "kind")
    ordered.write.format(Archive.name()).mode(mode).options(file_bytes=file_bytes, date=date, job=uuid.uuid4().hex).save(path)
    drop_all([named, shared])


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per response and revisit of an archive (``RECORD``), each checked against its digests.

    ``payload`` is null for revisits, and for all with ``payloads`` off; ``payload_bytes`` and ``payload_digest`` are those of the
    full payload either way. A record that is cut short or doesn't fit its digests raises an error.
    """
    spark.dataSource.register(Archive)
    return spark.read.format(Archive.name()).option("payloads", str(payloads).lower()).load(path)


def broken_revisits(records: DataFrame) -> DataFrame:
    """Revisits whose response the archive doesn't hold."""
    held = records.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest").distinct()
    return records.where("record_type = 'revisit'").join(held, ["refers_to", "payload_digest"], "left_anti")
