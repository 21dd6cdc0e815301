"""One document of each group of near copies: SimHash fingerprints in binary tries, then all pairs by prefixes.

Near copies share at least ``similarity`` of their distinct ``shingle``-word shingles. The work is done in two rounds. First,
dense groups are joined by their 64-bit fingerprints, which differ in a few bits: each of a few
orders of the bits makes a binary trie; fingerprints that agree on the first ``k`` bits of an
order form a subtree, which is joined with itself under the bit budget. ``k`` grows with the logarithm
of the number of fingerprints, which keeps subtrees small. A crowded subtree is
read on to as many bits more as it is too large, and dealt into slices where it still is. A subtree
returns a shortest spanning forest, never all pairs; the shingles of both ends of a link are compared.

Then no pair is left out: of two texts that are alike and still in different groups, the first shingles in one order of
all shingles have one in common (prefix filter). Shingles that many texts share come last in that order. Lengths and
sketches, which bound the difference from below, take out most of the rest before shingles are compared.
"""

from __future__ import annotations

import os
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meshfold.llm.common import store, unused
from meshfold.llm.components import components, local_labels
from meshfold.llm.simhash import BITS, fingerprint, trie_pairs
from meshfold.session import new_folder


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; a text of fewer words is one run."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    runs = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):  # a polynomial of the words' hashes, then mixed, since prefixes go by this order
        runs = runs * np.uint64(0x9E3779B97F4A7C15) + each[i:i + len(runs)]
    runs = (runs ^ (runs >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(runs ^ (runs >> np.uint64(29)))


def same_bits(k: int, budget: int) -> float:
    """How likely ``k`` of 64 bits by chance are outside of ``budget`` differing ones."""
    return float(np.prod([(BITS - budget - i) / (BITS - i) for i in range(k)]))


def plan(prints: int, budget: int, recall: float, unit: int) -> tuple[int, int]:
    """Bits that a subtree of ``unit`` random fingerprints takes, and how many orders of the bits."""
    k = max(0, min(32, ceil(log2(max(prints, 1) / unit))))
    p = same_bits(k, budget)
    return k, 1 if p >= recall else ceil(log(1 - recall) / log(1 - p))


def read(x: np.ndarray, way: int) -> np.ndarray:
    """Fingerprints in the order ``way`` of their bits."""
    bits = np.unpackbits(x.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(bits.take(_order(way), axis=1), axis=1).view(">u8").ravel().astype(np.uint64)


def _order(way: int) -> np.ndarray:
    return np.random.default_rng(way).permutation(BITS)


def unread(y: np.ndarray, way: int) -> np.ndarray:
    bits = np.unpackbits(y.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(bits.take(np.argsort(_order(way)), axis=1), axis=1).view(">u8").ravel().astype(np.uint64)


def forest(n: int, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Positions of the links of the shortest spanning forest of ``n`` nodes."""
    order = np.lexsort((b, a, weight))
    a, b = a[order], b[order]
    label, chosen, rest = np.arange(n), [], np.arange(len(a))
    while len(rest):
        ca, cb = label[a[rest]], label[b[rest]]
        apart = ca != cb
        rest, ca, cb = rest[apart], ca[apart], cb[apart]
        best = np.full(n, len(a))
        np.minimum.at(best, ca, rest)
        np.minimum.at(best, cb, rest)
        pick = np.unique(best[best < len(a)])
        chosen.append(pick)
        label = local_labels(n, label[a[pick]], label[b[pick]])[label]
    return order[np.concatenate([np.zeros(0, np.int64), *chosen])]


EARLY = 8  # orders whose links are looked at first
SKETCH = 512  # classes of shingles, a power of two


def links(prints: DataFrame, budget: int, recall: float = 0.95, unit: int = 64, crowded: int = 1024,
          tested: int = 64) -> DataFrame:
    """(a, b, late), a < b: candidate links between the distinct fingerprints ``prints(fp)``; ``late`` where only
    the later orders or forests have it."""
    count = prints.count()
    k, ways = plan(count, budget, recall, unit)
    forests = ceil(tested / ways)

    def spread(batches):
        for batch in batches:
            x = batch.column(0).to_numpy().view(np.uint64)
            for way in range(ways):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), way, np.int32)),
                                                  pa.array(read(x, way).view(np.int64))], ["way", "y"])

    def key(bits):  # the first ``bits`` bits; a shift by all 64 would be none
        return F.expr(f"if({bits} = 0, 0L, shiftrightunsigned(y, {BITS} - {bits}))").alias("key")

    keyed = prints.select("fp").mapInArrow(spread, "way int, y long").select("way", "y", key(k))
    deep = store(keyed.groupBy("way", "key").agg(F.count("*").alias("n")).where(F.col("n") > crowded).select(
        "way", "key", F.ceil(F.log2(F.col("n") / (crowded / 4))).cast("int").alias("more")), "crowded")
    keyed = keyed.join(deep, ["way", "key"], "left").select("way", "y", F.expr(
        f"least({BITS - 1}, {k} + coalesce(more, 0))").alias("bits")).select("way", "y", "bits", key("bits"))
    still = store(keyed.where(f"bits > {k}").groupBy("way", "bits", "key").agg(F.count("*").alias("n")).where(
        F.col("n") > crowded).select("way", "bits", "key", F.ceil(F.col("n") / crowded).cast("int").alias("k")), "crowded")
    own = F.pmod(F.xxhash64("y"), F.col("k")).cast("int")
    units = keyed.join(still, ["way", "bits", "key"], "left").withColumn("own", own).withColumn("j", F.explode(
        F.when(F.col("k").isNull(), F.array(F.lit(-1))).otherwise(F.expr("filter(sequence(0, k - 1), j -> j <> own)"))))
    units = units.select("way", "bits", "key", F.coalesce(F.least("own", "j"), F.lit(0)).alias("i"),
                         F.coalesce(F.greatest("own", "j"), F.lit(0)).alias("j"), "y")
    unit_of = ["way", "bits", "key", "i", "j"]
    units = units.repartition(*unit_of).sortWithinPartitions(*unit_of)

    def join_units(batches):
        held = None
        for batch in batches:
            rows = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns])
            held = rows if held is None else np.concatenate([held, rows], axis=1)
            if held.shape[1] >= 8192:
                new = np.nonzero((held[:5, 1:] != held[:5, :-1]).any(axis=0))[0]
                if len(new):
                    yield from _unit_links(held[:, :new[-1] + 1], budget, forests)
                    held = held[:, new[-1] + 1:]
        if held is not None:
            yield from _unit_links(held, budget, forests)

    return units.mapInArrow(join_units, "a long, b long, late boolean").groupBy("a", "b").agg(F.min("late").alias("late"))


def _unit_links(rows: np.ndarray, budget: int, forests: int):
    """Shortest spanning forests of each unit's pairs, each of the pairs that the ones before left, as pairs of fingerprints."""
    unit = np.cumsum(np.concatenate(([True], (rows[:5, 1:] != rows[:5, :-1]).any(axis=0)))) - 1
    several = np.bincount(unit)[unit] > 1
    rows, unit = rows[:, several], unit[several]
    for way in np.unique(rows[0]):
        here = rows[0] == way
        y, own = rows[5, here].view(np.uint64), unit[here]
        order = np.lexsort((y, own))
        y, own = y[order], own[order]
        # The trie below the key, 48 bits at a time at most beside the number of the unit: the rest is counted at the pairs.
        _, dense = np.unique(own, return_inverse=True)
        low = BITS - max(16, int(dense[-1]).bit_length() + 1) if len(dense) else BITS
        a, b = _pairs(dense, y, low, budget)
        fps, weight = unread(y, int(way)).view(np.int64), np.bitwise_count(y[a] ^ y[b])
        for turn in range(forests):
            if not len(a):
                break
            keep = forest(len(y), a, b, weight)
            left, right = fps[a[keep]], fps[b[keep]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(left, right)), pa.array(np.maximum(left, right)),
                                              pa.array(np.full(len(keep), turn > 0 or way >= EARLY))], ["a", "b", "late"])
            a, b, weight = (np.delete(c, keep) for c in (a, b, weight))


def _pairs(unit: np.ndarray, y: np.ndarray, bits: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one unit within the budget; the trie is built over the last ``bits`` bits of the distinct values."""
    low = y & np.uint64((1 << bits) - 1)
    order = np.lexsort((low, unit))
    unit, low, y = unit[order], low[order], y[order]
    new = np.concatenate(([True], (np.diff(unit) != 0) | (np.diff(low) != 0)))
    heads = np.nonzero(new)[0]
    a, b = trie_pairs(unit[heads], low[heads], bits, budget)
    ends = np.append(heads[1:], len(y))
    size = ends - heads
    # Values that differ in the higher bits alone share a leaf: all of a leaf meet all of the other, few as they are.
    pairs = [(heads[a], heads[b])]
    if (size > 1).any():
        wide = (size[a] > 1) | (size[b] > 1)
        pairs = [(heads[a[~wide]], heads[b[~wide]])]
        for p, q in [*zip(a[wide], b[wide]), *((i, i) for i in np.nonzero(size > 1)[0])]:
            left, right = (g.ravel() for g in np.meshgrid(np.arange(heads[p], ends[p]), np.arange(heads[q], ends[q])))
            keep = left != right if p != q else left < right
            pairs.append((left[keep], right[keep]))
    a, b = (np.concatenate(c) for c in zip(*pairs))
    near = np.bitwise_count(y[a] ^ y[b]) <= budget
    return order[a[near]], order[b[near]]


def _read_texts(docs: DataFrame, text: str, fp: str, mark: str, size: int) -> DataFrame:
    """``docs`` with the fingerprint and a hash of the words of each whole text."""
    place = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            prints = pa.array([fingerprint(t, size) for t in texts], pa.int64())
            marks = pa.array([xxhash.xxh3_64_intdigest(b" ".join((t or b"").lower().split())) >> 1 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, prints, marks], [*batch.schema.names, fp, mark])

    return docs.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in docs.dtypes), f"`{fp}` bigint", f"`{mark}` bigint"]))


PLACE = 33  # a row's number is that of the task that made it, shifted by so many bits, and its place there


def _placed(df: DataFrame, row: str, part: str, label: str) -> DataFrame:
    """``df`` written where its rows are made and read back with ``part``, the task's number, as its bucket: a join by
    ``part`` and ``row`` sends the other side to the texts, which are never shuffled."""
    spark = df.sparkSession
    # Buckets by the first of the two keys are enough for a join by both.
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    folder = new_folder(spark, label)
    name = f"`{os.path.basename(folder).replace('-', '_')}`"
    df.withColumn(part, F.shiftright(row, PLACE)).write.bucketBy(
        int(spark.conf.get("spark.sql.shuffle.partitions")), part).options(
        path=folder, compression="zstd").saveAsTable(name)
    placed = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the entry only; the files stay
    return placed


def _at(rows: DataFrame, row: str = "row", part: str = "part") -> DataFrame:
    """``rows`` as the side of a join by ``part`` and ``row`` that is sent to the texts and held by hash."""
    return rows.withColumn(part, F.shiftright(row, PLACE)).hint("shuffle_hash")


def _rows(ends: DataFrame, texts: DataFrame, size: int, column: str, value) -> DataFrame:
    """row and ``value`` of the shingles of its text, as bytes, of the rows in ``ends(row)``; ``texts(part, row, text)``."""
    def cut(batches):
        for batch in batches:
            found = [value(shingles(t, size)) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["row", column])

    chosen = texts.join(_at(ends.distinct()), ["part", "row"], "left_semi").select("row", "text")
    return store(chosen.mapInArrow(cut, f"row long, {column} binary"), "shingles")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("row"))


def _held(pairs: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """The ``pairs(a, b)`` whose texts are alike. Long sketches, a small part of the shingles' size, go first: only
    pairs that they leave have their shingles sent."""
    pairs = store(pairs, "candidates")
    pairs = store(_compared(pairs, _rows(_ends(pairs), texts, size, "s", long_sketch), lambda s, t: may_be_alike(
        s, t, similarity)), "candidates")
    return store(_similar(pairs, _rows(_ends(pairs), texts, size, "s", np.ndarray.tobytes), similarity), "links")


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs(a, b)`` of rows whose shingles are alike."""
    def alike(left, right):
        s, t = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
        both = len(np.intersect1d(s, t, assume_unique=True))
        return both >= similarity * (len(s) + len(t) - both)

    return _compared(pairs, sets, alike)


def _compared(pairs: DataFrame, values: DataFrame, test) -> DataFrame:
    """The ``pairs(a, b)`` that pass ``test`` of both rows' ``values(row, s)``."""
    def compare(batches):
        for batch in batches:
            keep = [test(left, right) for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = values.select(F.col("row").alias("a"), F.col("s").alias("s"))
    two = values.select(F.col("row").alias("b"), F.col("s").alias("t"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "s", "t").mapInArrow(compare, "a long, b long")


def long_sketch(s: np.ndarray) -> bytes:
    """The number of shingles, then, as in ``sketch``, whether an odd number of them falls into each class. The
    classes, a power of two, are twice to four times as many as the shingles."""
    classes = 8 << max(0, len(s).bit_length() - 2)
    odd = np.bincount((s & np.uint64(classes - 1)).astype(np.int64), minlength=classes).astype(np.uint8) & 1
    return len(s).to_bytes(8, "little") + np.packbits(odd).tobytes()


def may_be_alike(left: bytes, right: bytes, similarity: float) -> bool:
    """False only where two ``long_sketch``es prove that their shingles' similarity is below ``similarity``."""
    n, m = (int.from_bytes(x[:8], "little") for x in (left, right))
    s, t = (np.frombuffer(x, np.uint8, offset=8) for x in (left, right))
    while len(s) != len(t):  # classes of the lower bits alone: the halves of the longer one, folded
        s, t = (x if len(x) == min(len(s), len(t)) else x[:len(x) // 2] ^ x[len(x) // 2:] for x in (s, t))
    apart = int(np.bitwise_count(s ^ t).sum())
    return min(n, m) >= similarity * max(n, m) - 1e-6 and apart <= (n + m) * ((1 - similarity) / (1 + similarity)) + 1e-6


def prefix(s: np.ndarray, common: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of ``s`` in the order "not in ``common``, then by hash". Two sets that are alike share at
    least ``similarity`` of the larger one, so their prefixes of all but that many and one more share a shingle."""
    if not len(s):
        return s
    late = common[np.searchsorted(common, s).clip(max=len(common) - 1)] == s if len(common) else np.zeros(len(s), bool)
    return np.concatenate([s[~late], s[late]])[:len(s) - ceil(similarity * len(s) - 1e-9) + 1]


def sketch(s: np.ndarray) -> bytes:
    """Whether an odd number of shingles falls into each of SKETCH classes: a shingle that only one of two
    sets has changes one bit, so sets differ in at least as many shingles as their sketches in bits."""
    return np.packbits(np.bincount((s & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH).astype(np.uint8) & 1).tobytes()


def _common(texts: DataFrame, size: int, similarity: float) -> np.ndarray:
    """Sorted shingles that very many texts begin with, counted on one text in eight. Only the order
    of shingles, and so the work, depends on them, never the result."""
    def run(batches):
        for batch in batches:
            for t in batch.column(0).cast(pa.binary()).to_pylist():
                found = prefix(shingles(t, size), np.zeros(0, np.uint64), similarity)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["x"])

    tokens = texts.where("pmod(xxhash64(row), 8) = 0").select("text").mapInArrow(run, "x long")
    often = tokens.groupBy("x").count().where("count >= 4").orderBy(F.desc("count"), "x").limit(100_000)
    return np.sort(np.array([r.x for r in often.collect()], np.int64).view(np.uint64))


def rest_pairs(texts: DataFrame, labels: DataFrame, size: int, similarity: float) -> DataFrame:
    """(a, b), a < b: a superset of all pairs of rows that are alike and have different labels; of
    ``texts(part, row, text)`` those in ``labels(row, label)``, one row of each distinct text."""
    common = _common(texts, size, similarity)

    def cut(batches):
        for batch in batches:
            sets = [shingles(t, size) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            bits = np.frombuffer(b"".join(map(sketch, sets)), np.int64).reshape(-1, len(words))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), *[pa.array(c) for c in bits.T.copy()],
                pa.array([prefix(s, common, similarity).view(np.int64) for s in sets], pa.list_(pa.int64()))],
                ["row", "label", "n", *words, "first"])

    words = [f"s{i}" for i in range(SKETCH // 64)]
    schema = ", ".join(f"{c} long" for c in ["row", "label", "n", *words])
    labelled = texts.join(_at(labels), ["part", "row"]).select("row", "label", "text")
    cuts = store(labelled.mapInArrow(cut, schema + ", first array<long>"), "prefixes")
    # The shingles of all prefixes are shuffled once, without sketches, which come to the few rows that are left.
    tokens, of = cuts.select(F.explode("first").alias("x"), "row", "label"), Window.partitionBy("x")
    shared = tokens.select("*", F.min("label").over(of).alias("low"), F.max("label").over(of).alias("high"))
    few = store(shared.where("low < high").select("x", "row", "label"), "shared")
    few = store(few.join(cuts.select("row", "n", *words), "row"), "members").repartition("x")  # one shuffle for both sides
    other = few.select("x", *[F.col(c).alias(f"{c}_") for c in ["row", "n", "label", *words]])
    apart = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_"))) for c in words), F.lit(0))
    return few.hint("merge").join(other, "x").where(
        (F.col("row") < F.col("row_")) & (F.col("label") != F.col("label_"))
        & (F.least("n", "n_") >= F.greatest("n", "n_") * (similarity - 1e-9))
        & (apart <= (F.col("n") + F.col("n_")) * ((1 - similarity) / (1 + similarity)) + 1e-6)).select(
            F.col("row").alias("a"), F.col("row_").alias("b")).distinct()


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8,
             budget: int = 14, recall: float = 0.2) -> DataFrame:
    """``docs`` with one document of each group of near copies: the one of the smallest id, of
    repeated rows the first; null ids rank behind all ids.

    Texts of equal words (A-Z lower-cased, between ASCII white space) are copies, so null, empty and blank
    texts are one group. Others are linked where their shingles' Jaccard similarity is ``similarity`` or more, every such
    pair; a chain of links is one group. Fingerprints of at most ``budget`` differing bits, found with probability
    ``recall``, only join dense groups early. An empty table gives an empty one.
    """
    row, fp, mark, part = unused(docs, "row", "fp", "mark", "part")
    numbered = _placed(_read_texts(docs.withColumn(row, F.monotonically_increasing_id()), text, fp, mark, shingle),
                       row, part, "fingerprints")  # the largest table by far
    order = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(row).alias("row"))
    nodes = store(numbered.groupBy(F.col(fp).alias("fp"), F.col(mark).alias("mark")).agg(F.min(order).alias("best")), "nodes")
    head = F.min(F.struct("mark", F.col("best.row").alias("row")))
    heads = store(nodes.groupBy("fp").agg(head.alias("head")).select("fp", F.col("head.row").alias("row")), "heads")
    across = links(heads, budget, recall, tested=1)
    one, two = heads.select(F.col("fp").alias("a"), F.col("row").alias("ra")), heads.select(F.col("fp").alias("b"), F.col("row").alias("rb"))
    pairs = across.join(one, "a").join(two, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    alike = nodes.select("fp", F.col("best.row").alias("a")).join(heads, "fp").where("a <> row").select("a", F.col("row").alias("b"))
    texts = numbered.select(F.col(part).alias("part"), F.col(row).alias("row"), F.col(text).alias("text"))
    held = _held(pairs.unionByName(alike), texts, shingle, similarity)
    grouped = store(components(held), "groups")
    labels = nodes.select(F.col("best.row").alias("row")).join(grouped.withColumnRenamed("node", "row"), "row", "left").select(
        "row", F.coalesce("root", "row").alias("label"))
    more = _held(rest_pairs(texts, store(labels, "labels"), shingle, similarity), texts, shingle, similarity)
    if not more.isEmpty():
        grouped = components(held.unionByName(more))
    member = nodes.select("best", F.col("best.row").alias("node")).join(grouped, "node", "left")
    member = store(member.select("best", F.coalesce("root", "node").alias("root")), "members")
    chosen = member.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias(row))
    return numbered.join(_at(chosen, row, part), [part, row], "left_semi").select(*docs.columns)
