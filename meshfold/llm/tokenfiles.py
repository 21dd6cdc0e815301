"""Token-id files with a shared zstandard dictionary.

A folder holds ``dictionary-<sha256>.zdict``, one ``*.tok`` file per range of document ids
and a Parquet ``manifest`` naming the files of committed tasks. A file is

    header   magic, id width in bytes, sha256 of the dictionary
    frames   one zstandard frame per document, compressed alone with the dictionary
    index    one INDEX record per document: id, place and size of its frame, ids before it
    footer   place of the index, documents, ids, magic

so one short document is read with two small reads: its index record and its frame.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meshfold.llm import files, tokens
from meshfold.llm.common import unused

MAGIC = b"MFTOKEN1"
HEADER = np.dtype([("magic", "S8"), ("width", "<u4"), ("dictionary", "V32")])
INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("offset", "<u8"), ("size", "<u8"),
                  ("start", "<u8"), ("count", "<u8")])
FOOTER = np.dtype([("index", "<u8"), ("documents", "<u8"), ("ids", "<u8"), ("magic", "S8")])


def train(samples: list[bytes], size: int) -> bytes:
    """A dictionary of at most ``size`` bytes; too few samples for training are used raw."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _sample(docs: DataFrame, text: str, path: str, width: int, most: int, piece: int) -> list[bytes]:
    """Serialized ids of about ``most`` documents, chosen by a hash of their rows."""
    n = docs.count()
    if not n:
        return []
    chosen = docs.where(F.abs(F.xxhash64(F.monotonically_increasing_id(), text) % 1_000_003)
                        <= F.lit(int(1_000_003 * min(1.0, most / n))))
    rows = tokens.tokenise(chosen, [], text, path).select(F.substring("ids", 1, piece * 4).alias("ids"))
    return [np.frombuffer(r.ids, "<u4").astype(f"<u{width}").tobytes() for r in rows.limit(2 * most).collect()]


def write(docs: DataFrame, folder: str, path: str, doc_id: str = "doc_id", text: str = "text",
          dictionary_bytes: int = 64 << 10, sample_documents: int = 1024, sample_ids: int = 8192,
          level: int = 3) -> None:
    """Write the ids of every whole text, in ascending order of ``doc_id``, below ``folder``.

    The dictionary is fitted on about ``sample_documents`` documents, of each its first
    ``sample_ids`` ids; this bounds the driver's share and affects only the size of the
    files. Null texts are empty; null ids come first; repeated ids and rows are all kept;
    an empty table gives a folder without documents.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    width = 2 if tokens.encoder(path).tokenizer.get_vocab_size() <= 1 << 16 else 4
    dictionary = train(_sample(docs, "text", path, width, sample_documents, sample_ids), dictionary_bytes)
    digest = hashlib.sha256(dictionary).hexdigest()
    with files.writer(f"{folder}/dictionary-{digest}.zdict") as f:
        f.write(dictionary)

    # Equal ids are told apart by a row number, so that no id fills a range by itself.
    (row,) = unused(docs, "row")
    ordered = docs.withColumn(row, F.monotonically_increasing_id()).repartitionByRange("doc_id", row)
    ordered = ordered.sortWithinPartitions("doc_id", row).drop(row)

    def run(batches):
        shard = TaskContext.get().partitionId()
        name = f"{shard:08d}-{uuid.uuid4().hex}.tok"
        encode = tokens.encoder(path).encode
        pack = zstandard.ZstdCompressor(level=level, write_content_size=True,
                                        dict_data=_dictionary(dictionary)).compress
        index, place, before, out = [], 0, 0, None
        for batch in batches:
            if out is None:
                out = files.writer(f"{folder}/{name}")
                head = np.array([(MAGIC, width, np.void(bytes.fromhex(digest)))], HEADER).tobytes()
                out.write(head)
                place = len(head)
            for key, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                frame = pack(ids.astype(f"<u{width}").tobytes())
                out.write(frame)
                index.append((key or 0, key is not None, place, len(frame), before, len(ids)))
                place, before = place + len(frame), before + len(ids)
        if out is not None:
            out.write(np.array(index, INDEX).tobytes())
            out.write(np.array([(place, len(index), before, MAGIC)], FOOTER).tobytes())
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [name], "documents": [len(index)],
                                              "ids": [before]}, pa.schema(
                [("shard", pa.int32()), ("file", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())]))

    ordered.mapInArrow(run, "shard int, file string, documents long, ids long").write.parquet(f"{folder}/manifest")


def _dictionary(data: bytes):
    return zstandard.ZstdCompressionDict(data) if data else None


class TokenFile:
    """One file, open for access by position."""

    def __init__(self, folder: str, name: str):
        self.file = files.reader(f"{folder}/{name}")
        head = np.frombuffer(self.file.read_at(HEADER.itemsize, 0), HEADER)[0]
        digest = bytes(head["dictionary"]).hex()
        dictionary = files.read_all(f"{folder}/dictionary-{digest}.zdict")
        if hashlib.sha256(dictionary).hexdigest() != digest:
            raise ValueError(f"{name}: its dictionary does not have the hash {digest}")
        self.unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress
        self.type = f"<u{head['width']}"
        at = self.file.size() - FOOTER.itemsize
        foot = np.frombuffer(self.file.read_at(FOOTER.itemsize, at), FOOTER)[0]
        if head["magic"] != MAGIC or foot["magic"] != MAGIC:
            raise ValueError(f"{name} is not a whole token file")
        self.index_at, self.documents = int(foot["index"]), int(foot["documents"])

    def index(self) -> np.ndarray:
        return np.frombuffer(self.file.read_at(self.documents * INDEX.itemsize, self.index_at), INDEX)

    def ids(self, entry) -> np.ndarray:
        """The ids of one document, by a read of its frame alone."""
        return self._ids(self.file.read_at(int(entry["size"]), int(entry["offset"])))

    def _ids(self, frame: bytes) -> np.ndarray:
        return np.frombuffer(self.unpack(frame), self.type).astype("<u4")

    def documents_in_order(self, ahead: int = 8 << 20) -> Iterator[tuple]:
        """(index record, ids) of every document, read ``ahead`` bytes or one document at a time."""
        index = self.index()
        data, start = b"", 0
        for entry in index:
            place, size = int(entry["offset"]), int(entry["size"])
            if place + size > start + len(data):
                start, data = place, self.file.read_at(min(max(size, ahead), self.index_at - place), place)
            yield entry, self._ids(data[place - start:place - start + size])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), ids
    (little-endian uint32), n_tokens."""
    manifest = spark.read.schema("shard int, file string, documents long, ids long").parquet(f"{folder}/manifest")
    n = manifest.count()
    # One row per file: a running sum over them is small, and each file is a task's work.
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.select("file", F.coalesce(before, F.lit(0)).alias("base")).repartition(max(n, 1))

    def run(batches):
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, size = [], 0
                for entry, ids in TokenFile(folder, name).documents_in_order():
                    key = int(entry["doc_id"]) if entry["has_id"] else None
                    rows.append((key, base + int(entry["start"]), ids.tobytes(), len(ids)))
                    size += ids.nbytes
                    if size > 16 << 20:
                        yield _rows(rows)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows)

    return shards.mapInArrow(run, "doc_id long, start long, ids binary, n_tokens long")


_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("n_tokens", pa.int64())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _READ.types)], schema=_READ)
