"""WARC archives with an index written first-class and coalesced range reads (operator 6).

Tasks write gzip-per-record archives and emit one index row per record: archive, offset, length, URL, digest.
Only the index, which Spark commits, says what exists, so files of failed attempts are never read. Reading
selects index rows, deals them out by archive and stretch, sorts them by offset and reads neighbours at once.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: An archive ends at the first record beyond this.
ARCHIVE_BYTES = 64_000_000
#: A read covers at most this, and skips at most GAP bytes between two records.
READ_BYTES, GAP = 4_000_000, 64_000
_DATE = "2024-01-01T00:00:00Z"


def _filesystem(uri: str):
    """File system and path of a folder that Spark names; any store that Arrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else "file://" + uri.removeprefix("file:"))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(text: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in text)


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record, gzipped on its own. A revisit has no payload and says whose it stands for, if that has an id."""
    body = b"" if revisit else payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {_DATE}", f"WARC-Target-URI: {_header(url)}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    lines += ["Content-Type: application/octet-stream", f"Content-Length: {len(body)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", 1, mtime=0)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of one gzipped record."""
    head, _, rest = gzip.decompress(raw).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    n = int(headers["Content-Length"])
    if len(rest) != n + 4:
        raise ValueError("the record's length is wrong")
    return headers, rest[:n]


def _id(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:page:").rstrip(">")
    return int(value) if value else None


def roles(pages: DataFrame, least: int = 0) -> DataFrame:
    """pages (page_id, url, html) with refers_to and revisit.

    Of equal payloads of at least `least` bytes the row of smallest page_id responds (a null id comes last, and
    of repeated rows one responds) and the others revisit it; if no row with that payload has an id, one of them responds
    and the others revisit it without naming it. Only digests are dealt by payload; the pages
    themselves are dealt by id and digest, so that a payload that a third of them share isn't gathered.
    """
    sha = F.unhex(F.sha1(F.col("html").cast("binary")))
    digests = pages.where(F.octet_length("html") >= least).select("page_id", sha.alias("digest"))
    first = digests.groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id")).alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = digests.join(first, "digest").select("digest", F.col("page_id").alias("id"), F.col("first.page_id").alias("refers_to")).distinct()
    # The join and the window use the same keys, so that the pages are dealt once; a null id is zero and marked.
    own = {"sha": sha, "id0": F.coalesce("page_id", F.lit(0)), "none": F.col("page_id").isNull()}
    theirs = {"digest": F.col("digest"), "key0": F.coalesce("id", F.lit(0)), "no_key": F.col("id").isNull(), "refers_to": F.col("refers_to")}
    shared = shared.select(*[c.alias(n) for n, c in theirs.items()])
    on = (F.col("sha") == F.col("digest")) & (F.col("id0") == F.col("key0")) & (F.col("none") == F.col("no_key"))
    joined = pages.withColumns(own).join(shared, on, "left")
    nth = F.row_number().over(Window.partitionBy(*own).orderBy("url"))
    again = F.col("digest").isNotNull() & ~(F.col("page_id").eqNullSafe(F.col("refers_to")) & (F.col("nth") == 1))
    return joined.withColumn("nth", nth).select("page_id", "url", "html", F.when(again, F.col("refers_to")).alias("refers_to"), again.alias("revisit"))


_INDEX = "archive string, offset long, length long, url string, digest string, page_id long, record_type string"


def write(pages: DataFrame, folder: str, least: int = 0, html: str = "html", url: str = "url", page_id: str = "page_id") -> DataFrame:
    """Write the pages' records to archives in folder, and their index to folder/index; return the index.

    A null html is an empty payload, a null url an empty one; empty tables give an empty index; repeated rows
    have a record each.
    """
    spark = pages.sparkSession
    rows = common.pick(pages, page_id=page_id, url=url, html=html).select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _filesystem(folder)
        out = name = None
        at, index = 0, []
        for batch in common.chunks(batches, "html"):
            cols = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to", "revisit")]
            for page, link, text, refers_to, revisit in zip(*cols):
                if out is None:
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{path}/{name}", compression=None)
                payload = text.encode()
                digest = base32_sha1(payload)
                raw = record(page, link, payload, digest, refers_to, revisit)
                out.write(raw)
                index.append((name, at, len(raw), link, digest, page, "revisit" if revisit else "response"))
                at += len(raw)
                if at > ARCHIVE_BYTES:
                    out.close()
                    out = None
            if out is None or len(index) > 5_000:
                yield _batch(index, _INDEX)
                index = []
        if out is not None:
            out.close()
        if index:
            yield _batch(index, _INDEX)

    files, path = _filesystem(folder)
    files.create_dir(path, recursive=True)
    roles(rows, least).mapInArrow(run, _INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(_INDEX).parquet(f"{folder}/index")


_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    cols = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(list(c), _TYPES[kind]) for c, (_, kind) in zip(cols, fields)], [n for n, _ in fields])


_READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(index: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records that the index rows select: page_id, url, payload_bytes, payload_digest, record_type, refers_to
    and, if asked for, payload (null for revisits).

    Raises if a record is damaged, or a response's payload isn't what its digest says.
    """
    stretch = F.floor(F.col("offset") / READ_BYTES)
    # A stated number of parts: the index is small, and its own size would say nothing about the reads behind it.
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.select("archive", "offset", "length", stretch.alias("stretch")).repartition(parts, "archive", "stretch").sortWithinPartitions("archive", "offset")
    schema = _READ + ", payload binary" * payload

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, int, int]]]:
        held: list[tuple[str, int, int]] = []
        for batch in batches:
            for name, at, n in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if held and (name != held[-1][0] or at - held[-1][1] - held[-1][2] > GAP or at + n - held[0][1] > READ_BYTES):
                    yield held
                    held = []
                held.append((name, at, n))
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _filesystem(folder)
        name = source = None
        for group in ranges(batches):
            if group[0][0] != name:
                if source is not None:
                    source.close()
                name = group[0][0]
                source = files.open_input_file(f"{path}/{name}")
            start = group[0][1]
            block = source.read_at(group[-1][1] + group[-1][2] - start, start)
            out = []
            for _, at, n in group:
                head, body = parse(block[at - start : at - start + n])
                digest, revisit = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"] == "revisit"
                if not revisit and base32_sha1(body) != digest:
                    raise ValueError(f"{name} at {at}: the payload doesn't have its digest")
                row = (_id(head["WARC-Record-ID"]), head["WARC-Target-URI"], int(head["X-Payload-Length"]), digest, head["WARC-Type"], _id(head.get("WARC-Refers-To")))
                out.append((*row, None if revisit else body) if payload else row)
            yield _batch(out, schema)
        if source is not None:
            source.close()

    return dealt.mapInArrow(run, schema)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    """Write all pages as WARC records and read them back."""
    folder = common.new_dir(spark, "warc")
    index = write(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read(index, folder, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
