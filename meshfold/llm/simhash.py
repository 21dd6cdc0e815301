"""Near duplicates by 64-bit SimHash fingerprints and a binary trie joined with itself.

Two fingerprints within ``budget`` bits agree wholly on at least two of ``budget + 2``
blocks of bits. For each choice of two blocks the fingerprints are read with these blocks
first; those that agree on them form one subtree of a binary trie. A subtree is joined with
itself: pairs of nodes descend together, bit by bit, their differing bits add up, and a
pair beyond the budget is pruned. Copies share one fingerprint and are one leaf. A subtree
of more fingerprints than ``slice_size`` is dealt into slices and each two slices meet in a
unit of their own, so no unit grows with its subtree. A unit returns the links that span
its components, never all pairs.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold.llm.common import store, unused
from meshfold.llm.components import components, local_labels

BITS = 64


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Signed 64-bit fingerprint of a text in UTF-8; 0 where it has no word."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_digest
    hashes = [digest(joined[s:e], 42) for s, e in zip(starts, ends[shingle - 1:] or ends[-1:])]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        block = np.frombuffer(b"".join(hashes[at:at + (1 << 15)]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, text: str, name: str, shingle: int = 3) -> DataFrame:
    """All columns of ``docs`` and the fingerprint of each whole text as column ``name``."""
    place = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            found = pa.array([fingerprint(t, shingle) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.dtypes), f"`{name}` bigint"])
    return docs.mapInArrow(run, schema)


class Layout:
    """The ways to put two blocks of bits first."""

    def __init__(self, budget: int):
        edges = [BITS * i // (budget + 2) for i in range(budget + 3)]
        self.blocks = [(s, e - s) for s, e in zip(edges, edges[1:])]  # from the low end
        self.first = list(combinations(range(len(self.blocks)), 2))

    def read(self, x: np.ndarray, way: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(the two blocks, the other bits, how many these are) of unsigned fingerprints."""
        parts, bits = [np.zeros_like(x), np.zeros_like(x)], [0, 0]
        for i, (shift, width) in enumerate(self.blocks):
            k = 0 if i in self.first[way] else 1
            part = (x >> np.uint64(shift)) & np.uint64((1 << width) - 1)
            parts[k] |= part << np.uint64(bits[k])
            bits[k] += width
        return parts[0], parts[1], bits[1]


def trie_pairs(unit: np.ndarray, rest: np.ndarray, bits: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of one unit whose ``rest`` differ in at most ``budget`` bits.
    Rows have to be sorted by (unit, rest) and distinct; a trie node is a range of rows."""
    _, unit = np.unique(unit, return_inverse=True)
    x = unit.astype(np.uint64) << np.uint64(bits) | rest
    start = np.nonzero(np.diff(unit, prepend=-1))[0]
    end = np.append(start[1:], len(x))
    keep = end - start > 1
    # Node pairs: ranges a0:a1 and b0:b1, and the bits that differ above them.
    a0, a1 = start[keep], end[keep]
    b0, b1, diff = a0, a1, np.zeros(len(a0), np.int8)
    left, right = [], []
    for bit in range(bits - 1, -1, -1):
        if not len(a0):
            break
        here = np.uint64(1 << bit)
        middle = lambda low, high: np.clip(np.searchsorted(
            x, (x[low] >> np.uint64(bit + 1) << np.uint64(bit + 1)) | here), low, high)
        am, bm, same = middle(a0, a1), middle(b0, b1), a0 == b0
        rows = [np.concatenate(c) for c in zip(
            (a0, am, b0, bm, diff), (am, a1, bm, b1, diff), (a0, am, bm, b1, diff + 1),
            tuple(c[~same] for c in (am, a1, b0, bm, diff + 1)))]
        a0, a1, b0, b1, diff = rows
        alive = (a0 < a1) & (b0 < b1) & (diff <= budget) & ((a0 != b0) | (a1 - a0 > 1))
        a0, a1, b0, b1, diff = (c[alive] for c in rows)
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1)
        if leaf.any():  # the paths below single leaves have no more branches: count their bits at once
            a, b = a0[leaf], b0[leaf]
            below = np.uint64((1 << bit) - 1)
            near = diff[leaf] + np.bitwise_count((x[a] ^ x[b]) & below) <= budget
            left.append(a[near])
            right.append(b[near])
            a0, a1, b0, b1, diff = (c[~leaf] for c in (a0, a1, b0, b1, diff))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def links(prints: DataFrame, budget: int, slice_size: int = 1024) -> DataFrame:
    """(a, b): links that span the components of the distinct fingerprints ``prints(fp)``
    under "at most ``budget`` bits differ"."""
    layout = Layout(budget)
    ways = len(layout.first)

    def spread(batches):
        for batch in batches:
            x = batch.column(0).to_numpy().view(np.uint64)
            for way in range(ways):
                key, _, _ = layout.read(x, way)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), way, np.int32)), pa.array(key.view(np.int64)), batch.column(0)],
                    ["way", "key", "fp"])

    keyed = prints.select("fp").mapInArrow(spread, "way int, key long, fp long")
    # A slice holds at most about a quarter of an even share of the rows.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slice_size = max(slice_size, prints.count() * ways // (4 * parts))
    crowded = store(keyed.groupBy("way", "key").agg(F.count("*").alias("n")).where(F.col("n") > slice_size)
                    .select("way", "key", F.ceil(F.col("n") / slice_size).cast("int").alias("k")), "crowded")
    own = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
    others = F.expr("filter(sequence(0, k - 1), j -> j <> own)")
    units = keyed.join(crowded, ["way", "key"], "left").withColumn("own", own).withColumn(
        "j", F.explode(F.when(F.col("k").isNull(), F.array(F.lit(-1))).otherwise(others)))
    units = units.select("way", "key", F.coalesce(F.least("own", "j"), F.lit(0)).alias("i"),
                         F.coalesce(F.greatest("own", "j"), F.lit(0)).alias("j"), "fp")
    units = units.repartition("way", "key", "i", "j").sortWithinPartitions("way", "key", "i", "j")

    def join_units(batches):
        held = None
        for batch in batches:
            rows = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns])
            held = rows if held is None else np.concatenate([held, rows], axis=1)
            if held.shape[1] >= 8192:
                new = (held[:4, 1:] != held[:4, :-1]).any(axis=0)
                if new.any():
                    cut = int(np.nonzero(new)[0][-1]) + 1
                    yield from _unit_links(held[:, :cut], layout, budget)
                    held = held[:, cut:]
        if held is not None:
            yield from _unit_links(held, layout, budget)

    return units.mapInArrow(join_units, "a long, b long")


def _unit_links(rows: np.ndarray, layout: Layout, budget: int):
    """Links from each fingerprint to the smallest of its component within its unit."""
    new = np.concatenate(([True], (rows[:4, 1:] != rows[:4, :-1]).any(axis=0)))
    unit = np.cumsum(new)
    size = np.bincount(unit)[unit]
    rows, unit = rows[:, size > 1], unit[size > 1]
    for way in np.unique(rows[0]):
        here = rows[0] == way
        _, rest, bits = layout.read(rows[4, here].view(np.uint64), int(way))
        order = np.lexsort((rest, unit[here]))
        fp = rows[4, here][order]
        a, b = trie_pairs(unit[here][order], rest[order], bits, budget)
        if len(a):
            root = local_labels(len(fp), a, b)
            child = np.nonzero(root != np.arange(len(fp)))[0]
            yield pa.RecordBatch.from_arrays([pa.array(fp[child]), pa.array(fp[root[child]])], ["a", "b"])


def classes(prints: DataFrame, budget: int) -> DataFrame:
    """(fp, best): the smallest ``best`` over all fingerprints reachable from ``fp``, for
    distinct ``prints(fp, best)``."""
    found = components(links(prints, budget)).withColumnRenamed("node", "fp")
    member = store(prints.join(found, "fp"), "members")
    least = store(member.groupBy("root").agg(F.min("best").alias("least")), "least")
    linked = store(member.join(least, "root").select("fp", "least"), "linked")
    return store(prints.join(linked, "fp", "left").select("fp", F.coalesce("least", "best").alias("best")), "classes")


def _order(doc_id: str, row: str) -> Column:
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(row).alias("row"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    budget: int = 2) -> DataFrame:
    """doc_id, fp and component_id, the smallest id reachable by links of at most ``budget``
    bits, itself included. Null and empty texts have fingerprint 0 and are linked like any
    other; null ids rank behind all ids; every repeated row is returned; an empty table
    gives an empty one."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = store(with_fingerprint(rows, "text", "fp", shingle).select("doc_id", "fp"), "fingerprints")
    best = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"),
                                                   F.col("doc_id").alias("id"))).alias("best"))
    found = classes(store(best, "prints"), budget)
    return prints.join(found, "fp").select("doc_id", "fp", F.col("best.id").alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
             budget: int = 2) -> DataFrame:
    """``docs`` with one document of each class: the one of the smallest id, of repeated
    rows the first. Texts without a word are one class."""
    row, fp = unused(docs, "row", "fp")
    numbered = store(with_fingerprint(docs.withColumn(row, F.monotonically_increasing_id()), text, fp, shingle),
                     "fingerprints")
    best = numbered.groupBy(F.col(fp).alias("fp")).agg(F.min(_order(doc_id, row)).alias("best"))
    chosen = classes(store(best, "prints"), budget).select(F.col("best.row").alias(row)).distinct()
    return numbered.join(chosen, row, "left_semi").select(*docs.columns)
