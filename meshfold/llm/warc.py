"""Web archives: one gzip stream per file, normalised to one member per record.

``write`` stores pages as WARC records in whole-file gzip streams, which can be read only
from their start. ``normalise`` inflates each stream once, in bounded memory, writes every
record as a gzip member of its own and a sidecar index with the place of each. ``read``
takes the records back by that index. Pages of equal payloads of at least ``min_bytes``
are stored once: the others are revisits of it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfold.llm import files
from meshfold.llm.common import store

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"  # pages carry no time

MANIFEST = "file string, records long, complete boolean"
_MANIFEST = pa.schema([("file", pa.string()), ("records", pa.int64()), ("complete", pa.bool_())])


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           revisit: bool) -> bytes:
    """One record; ``digest`` is the payload's SHA-1 in hex. White space in a url is escaped."""
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else "about:blank"
    block = HTTP if revisit else HTTP + payload
    head = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": record_id(page_id, digest),
            "WARC-Target-URI": target, "WARC-Date": DATE,
            "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()}
    if page_id is not None:
        head["X-Page-ID"] = page_id
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, digest), "X-Refers-To-Page": refers_to}
    head |= {"X-Payload-Length": len(payload), "Content-Type": "application/http; msgtype=response",
             "Content-Length": len(block)}
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + END


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(headers by lower-case name, block, the whole record) of each record of an inflated stream.
    Raises EOFError where the stream ends inside a record."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):  # stray blank lines between records
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        whole, head = [line], {}
        while True:
            line = stream.readline()
            whole.append(line)
            if not line.endswith(b"\n"):
                raise EOFError("a record's headers end early")
            if not line.strip():
                break
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        size = int(head["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise EOFError("a record's block ends early")
        stream.read(len(END))
        yield head, block, b"".join([*whole, block, END])


def normalise(source: str, target: str, index: str, level: int = 6) -> tuple[int, bool]:
    """Rewrite one archive, whatever its members, record by record. Returns how many records
    there were, and False where the stream was cut or broken: the records before are kept. A
    fault of the store itself, in reading or writing, is raised, so that the task is run again."""
    count, place, complete = 0, 0, True
    with files.reader(source) as raw, files.writer(target) as out, files.writer(index) as places:
        stream = io.BufferedReader(gzip.GzipFile(fileobj=raw, mode="rb"), 1 << 16)
        found = records(stream)
        while True:
            try:
                head, _, whole = next(found)
            except StopIteration:
                break
            except (EOFError, ValueError, KeyError, gzip.BadGzipFile, zlib.error):
                complete = False
                break
            pack = zlib.compressobj(level, zlib.DEFLATED, 31)
            member = pack.compress(whole) + pack.flush()
            out.write(member)
            places.write(f"{place} {len(member)} {head.get('warc-type')} {head.get('warc-record-id')}\n".encode())
            place, count = place + len(member), count + 1
    return count, complete


def members(target: str, index: str, ahead: int = 8 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record, each inflated from its own place."""
    with files.reader(target) as f:
        data, start = b"", 0
        for line in io.BytesIO(files.read_all(index)):
            place, size = map(int, line.split()[:2])
            if place + size > start + len(data):
                start, data = place, f.read_at(max(size, ahead), place)
            member = zlib.decompress(data[place - start:place - start + size], 31)
            for head, block, _ in records(io.BytesIO(member)):
                yield head, block


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
          min_bytes: int = 1000, level: int = 6) -> None:
    """Store pages below ``folder``: one gzip stream per task and a manifest of committed files.

    A null or empty page has an empty payload. Of equal payloads of at least ``min_bytes``
    the largest page id keeps the payload (so do repeated rows of that id); a null id never
    does unless no row of the group has one. An empty table gives no files.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    copies = store(rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n"), "copies")
    rows = rows.join(copies, "digest", "left").select(
        "page_id", "url", "payload", "digest", "keeper",
        (F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))).alias("revisit"))

    def run(batches):
        name = f"{TaskContext.get().partitionId():08d}-{uuid.uuid4().hex}.warc.gz"
        count, out, pack = 0, None, zlib.compressobj(level, zlib.DEFLATED, 31)
        for batch in batches:
            out = out or files.writer(f"{folder}/{name}")
            for page, place, payload, digest, keeper, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                out.write(pack.compress(record(page, place, payload, digest, keeper, revisit)))
                count += 1
        if out:
            out.write(pack.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [count], "complete": [True]}, _MANIFEST)

    rows.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")


def _each_file(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a manifest, one row to a task."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return manifest.repartition(max(manifest.count(), 1))


def normalise_all(spark: SparkSession, source: str, folder: str, strict: bool = True) -> None:
    """Normalise every file of ``source`` into ``folder``: archives, indexes and a manifest. A
    broken stream is an error, or, without ``strict``, marked as not complete in the manifest."""
    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                new = f"{name.split('.')[0]}-{uuid.uuid4().hex[:8]}.warc.gz"
                count, complete = normalise(f"{source}/{name}", f"{folder}/{new}", f"{folder}/{new}.idx")
                if strict and not complete:
                    raise ValueError(f"{name} is cut or broken after {count} records")
                yield pa.RecordBatch.from_pydict({"file": [new], "records": [count], "complete": [complete]}, _MANIFEST)

    _each_file(spark, source).mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")


_READ = pa.schema([("page_id", pa.int64()), ("target", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                   ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, target, payload (null for revisits), payload_bytes, payload_digest (hex),
    record_type, refers_to of every record. A response whose payload does not have the stated
    digest is an error."""
    def rows(name):
        for head, block in members(f"{folder}/{name}", f"{folder}/{name}.idx"):
            digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
            payload, size = None, int(head["x-payload-length"])
            if head["warc-type"] == "response":
                payload = block.partition(END)[2]
                if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
                    raise ValueError(f"{name}: a payload differs from its digest")
            number = lambda key: int(head[key]) if key in head else None
            yield (number("x-page-id"), head["warc-target-uri"], payload, size, digest, head["warc-type"],
                   number("x-refers-to-page"))

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                held, size = [], 0
                for row in rows(name):
                    held.append(row)
                    size += len(row[2] or b"") + 100
                    if size > 8 << 20:
                        yield _batch(held)
                        held, size = [], 0
                if held:
                    yield _batch(held)

    return _each_file(spark, folder).mapInArrow(
        run, "page_id long, target string, payload binary, payload_bytes long, payload_digest string, "
             "record_type string, refers_to long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _READ.types)], schema=_READ)
