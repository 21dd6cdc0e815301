"""Packing of documents into token sequences by lexical retrieval.

A document's whole windows become sequences of their own where they stand. What is left of
each document, always shorter than a window, is dealt by a hash to shards of about
``shard_tokens`` ids. Each shard builds a BM25 inverted index over its pieces, with document
frequencies and mean length counted over all documents. A seed piece opens a sequence; the
unused pieces that score highest against it, over all its terms, fill the window while they
fit, and the best one that doesn't fit is cut to close it. So only the last sequence of a shard has padding.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfold.llm import tokens
from meshfold.llm.common import store

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long")


@dataclass(frozen=True)
class Bm25:
    """Statistics of the corpus and the two constants of the formula. Terms are token ids,
    so ``frequency`` has one entry per id of the vocabulary, whatever the corpus."""

    frequency: np.ndarray
    documents: int
    mean_length: float
    k1: float = 1.2
    b: float = 0.75

    def idf(self) -> np.ndarray:
        return np.log1p((self.documents - self.frequency + 0.5) / (self.frequency + 0.5))

    def weight(self, term: np.ndarray, count: np.ndarray, length: np.ndarray) -> np.ndarray:
        norm = self.k1 * (1 - self.b + self.b * length / max(self.mean_length, 1.0))
        return self.idf()[term] * count * (self.k1 + 1) / (count + norm)


class Index:
    """Inverted index over the pieces of one shard."""

    def __init__(self, pieces: list[np.ndarray], model: Bm25):
        sizes = np.array([len(p) for p in pieces], np.int64)
        vocabulary = len(model.frequency)
        owner = np.repeat(np.arange(len(pieces)), sizes)
        keys, counts = np.unique(owner * vocabulary + np.concatenate(pieces), return_counts=True)
        doc, term = keys // vocabulary, keys % vocabulary
        weight = model.weight(term, counts, sizes[doc])
        self.bounds = np.searchsorted(doc, np.arange(len(pieces) + 1))
        self.terms = term
        order = np.argsort(term, kind="stable")
        self.docs, self.weights, self.owners = doc[order], weight[order], term[order]
        self.vocabulary, self.size = np.arange(vocabulary + 1), len(pieces)
        self.postings = np.searchsorted(self.owners, self.vocabulary)

    def keep(self, live: np.ndarray) -> None:
        """Leave out the postings of pieces that are no longer ``live``; the order stays."""
        kept = live[self.docs]
        self.docs, self.weights, self.owners = self.docs[kept], self.weights[kept], self.owners[kept]
        self.postings = np.searchsorted(self.owners, self.vocabulary)

    def scores(self, piece: int) -> np.ndarray:
        """BM25 of every piece against all terms of one."""
        term = self.terms[self.bounds[piece]:self.bounds[piece + 1]]
        first, last = self.postings[term], self.postings[term + 1]
        there = first < last
        at = [slice(a, b) for a, b in zip(first[there].tolist(), last[there].tolist())]
        if not at:
            return np.zeros(self.size)
        return np.bincount(np.concatenate([self.docs[x] for x in at]),
                           np.concatenate([self.weights[x] for x in at]), self.size)


def fill(pieces: list[np.ndarray], window: int, model: Bm25):
    """Sequences of (piece, first id, ids): every id of every piece once, each sequence
    but the last exactly ``window`` long. Ties go to the earlier piece."""
    if not pieces:
        return
    index = Index(pieces, model)
    indexed = len(pieces)
    left = np.array([len(p) for p in pieces], np.int64)
    used = np.zeros(len(pieces), np.int64)
    seed = 0

    def take(piece: int, most: int):
        count = min(most, int(left[piece]))
        part = (piece, int(used[piece]), count)
        used[piece] += count
        left[piece] -= count
        return part

    while True:
        while seed < len(pieces) and not left[seed]:
            seed += 1
        if seed == len(pieces):
            return
        parts = [take(seed, window)]
        space = window - parts[0][2]
        if space:
            live = left > 0
            if 4 * live.sum() < 3 * indexed:
                index.keep(live)
                indexed = int(live.sum())
            score = np.where(live, index.scores(seed), -1.0)
            near = np.argpartition(-score, min(64, len(score) - 1))[:64]
            near = near[np.lexsort((near, -score[near]))]
            for candidates in (near, None):  # the nearest, then on down the ranking; pieces without a score are last
                if candidates is None:
                    candidates = np.argsort(-score, kind="stable")
                cut = -1
                for piece in candidates:
                    if 0 < left[piece] <= space:
                        parts.append(take(piece, space))
                        space -= parts[-1][2]
                        if not space:
                            break
                    elif left[piece] and cut < 0:
                        cut = int(piece)
                    if cut >= 0 and candidates is not near:
                        break
                if space and cut >= 0:
                    parts.append(take(cut, space))
                    space = 0
                if not space:
                    break
        yield parts


def _statistics(counted: DataFrame, vocabulary: int) -> Bm25:
    """Document frequencies of token ids over all documents, from the counts of each task."""
    def terms(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                counts = np.frombuffer(data, "<i8")
                term = np.nonzero(counts)[0]
                yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(counts[term])], ["term", "n"])

    # At most one row per id of the vocabulary reaches the driver, and two with the totals.
    found = counted.mapInArrow(terms, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = np.zeros(vocabulary + 2)
    for r in found.collect():
        counts[r.term] = r.n
    documents, ids = counts[vocabulary:]
    return Bm25(counts[:vocabulary], int(documents), ids / max(documents, 1))


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", window: int = 2048,
         shard_tokens: int = 1 << 21) -> DataFrame:
    """Pieces of packed sequences: doc_id, start (the document's ids before the piece),
    length, ids (little-endian uint32), doc_tokens, sequence_id, offset in the sequence.

    Every document counts, with its end id, so a null or empty text is one id. Repeated
    rows and ids are packed as documents of their own; an empty table gives no pieces.
    Sequences are ``window`` long but for the last of each shard, which is to be padded.
    """
    vocabulary = tokens.encoder(path).tokenizer.get_vocab_size()
    numbered = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    def number(batches):  # encodes as well: a Python worker more for each core would hold the vocabulary twice
        encode = tokens.encoder(path).encode
        base = TaskContext.get().partitionId() << 32
        counts = np.zeros(vocabulary + 2, np.int64)  # documents of each id, then documents and ids
        for batch in batches:
            ids = encode(batch.column(1).to_pylist())
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            whole = sizes // window
            first = base + np.cumsum(whole) - whole
            base += int(whole.sum())
            for own in ids:
                counts[np.unique(own)] += 1
            counts[vocabulary:] += len(ids), int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(sizes), pa.array(first),
                 pa.nulls(len(ids), pa.binary())], names)
        if counts[vocabulary]:  # one more row a task: its part of the document frequencies
            yield pa.RecordBatch.from_arrays(
                [pa.array([None], t) for t in (pa.int64(), pa.binary(), pa.int64(), pa.int64())]
                + [pa.array([counts.tobytes()], pa.binary())], names)

    names = ["doc_id", "ids", "doc_tokens", "first", "counts"]
    written = store(numbered.mapInArrow(number, "doc_id long, ids binary, doc_tokens long, first long, counts binary"),
                    "packing-ids", compression="zstd")
    encoded = written.where("counts is null").drop("counts")
    size = 4 * window
    windows = F.expr(f"transform(sequence(0L, doc_tokens div {window} - 1), k -> named_struct("
                     f"'k', k, 'ids', substring(ids, int(k * {size}) + 1, {size})))")
    whole = encoded.where(F.col("doc_tokens") >= window).select(
        "doc_id", "doc_tokens", "first", F.inline(windows)).select(
        "doc_id", (F.col("k") * window).alias("start"), F.lit(window).cast("long").alias("length"), "ids",
        "doc_tokens", ((F.col("first") + F.col("k")) * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    start = F.expr(f"doc_tokens - doc_tokens % {window}")
    rest = encoded.where(F.col("doc_tokens") % window > 0)
    total = rest.agg(F.sum(F.col("doc_tokens") % window)).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    model = _statistics(written.where("counts is not null").select("counts"), vocabulary)
    rest = rest.select("doc_id", start.alias("start"), "doc_tokens",
                       F.expr(f"substring(ids, int(doc_tokens - doc_tokens % {window}) * 4 + 1)").alias("ids"),
                       F.pmod(F.xxhash64("doc_id", "ids", F.monotonically_increasing_id()), F.lit(shards))
                       .cast("long").alias("shard"))

    def fill_shard(key, data):
        data = data.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids", "ascending")])
        doc, begin, length = (data[c].to_pylist() for c in ("doc_id", "start", "doc_tokens"))
        pieces = [np.frombuffer(x.as_buffer(), "<u4") for x in data["ids"]]
        out = [[] for _ in range(7)]
        for k, parts in enumerate(fill(pieces, window, model)):
            offset = 0
            for piece, first, count in parts:
                for column, value in zip(out, (doc[piece], begin[piece] + first, count,
                                               pieces[piece][first:first + count].tobytes(), length[piece],
                                               (key[0].as_py() << 32 | k) * 2, offset)):
                    column.append(value)
                offset += count
        types = [pa.binary() if i == 3 else pa.int64() for i in range(7)]
        return pa.table([pa.array(c, t) for c, t in zip(out, types)], names=[x.split()[0] for x in PIECES.split(", ")])

    return whole.unionByName(rest.groupBy("shard").applyInArrow(fill_shard, PIECES))
