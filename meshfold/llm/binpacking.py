"""Hierarchical residual best-fit packing of whole documents into windows.

Each task packs its own documents by best fit, largest first, a portion at a time. Nearly full
bins are emitted; underfull ones go into the next portion as items of their own. What a
task has left then climbs a tree: groups of tasks meet, their underfull bins are items that are
packed by best fit again, until one group is left. Only numbers of bins travel; the ids stay
in the rows their task has written, and a bin's place in its root is joined to them at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfold.llm import tokens
from meshfold.llm.common import store


def best_fit(sizes: np.ndarray, window: int) -> np.ndarray:
    """The number of the bin of each item, largest items first, each into the bin with the least room that
    holds it. Ties go to the earlier item and the earlier bin."""
    result = np.empty(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(window + 1)]  # by the room that is left
    rooms = bins = 0  # a bit for each room that some bin has
    order = np.argsort(-sizes, kind="stable")
    for item, size in zip(order.tolist(), sizes[order].tolist()):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            own = open_bins[room]
            number = own.pop()
            if not own:
                rooms ^= 1 << room
        else:
            room, number = window, bins
            bins += 1
        result[item] = number
        room -= size
        if room:
            open_bins[room].append(number)
            rooms |= 1 << room
    return result


class _Portion:
    """Pieces of one task that are not in an emitted bin. A bin is a list of pieces."""

    def __init__(self, window: int, slack: int):
        self.window, self.slack, self.bins, self.fills = window, slack, [], []

    def pack(self, pieces: list, sizes: list[int]) -> list[list]:
        """Packs the pieces with the underfull bins, and gives up the nearly full ones."""
        items = [*self.bins, *([p] for p in pieces)]
        fills = np.array([*self.fills, *sizes], np.int64)
        number = best_fit(fills, self.window)
        total = np.bincount(number, fills).astype(np.int64) if len(fills) else fills
        joined: list[list] = [[] for _ in total]
        for n, item in zip(number.tolist(), items):
            joined[n] += item
        done = total >= self.window - self.slack
        self.bins = [b for b, full in zip(joined, done) if not full]
        self.fills = total[~done].tolist()
        return [b for b, full in zip(joined, done) if full]

    def drain(self) -> list[list]:
        bins, self.bins, self.fills = self.bins, [], []
        return bins


def _merge(bins: DataFrame, groups: int, window: int, turn: int) -> DataFrame:
    """One round: in each group the roots are items; (bin, root, base, fill) of all bins."""
    if turn:  # what did not fit in this company meets other bins
        group = F.pmod(F.xxhash64("root", F.lit(turn)), F.lit(groups))
    else:  # neighbouring tasks: the number of a bin begins with its task
        group = F.pmod(F.shiftright("root", 32), F.lit(groups))

    def run(_, data):
        data = data.sort_by([("root", "ascending"), ("base", "ascending")])
        bin_, root, base, fill = (data[c].to_numpy() for c in ("bin", "root", "base", "fill"))
        first = np.nonzero(np.diff(root, prepend=-1))[0]
        own = np.cumsum(np.diff(root, prepend=-1) != 0) - 1
        number = best_fit(fill[first], window)
        order = np.argsort(number, kind="stable")  # the roots of each new bin, one behind the other
        new = np.diff(number[order], prepend=-1) != 0
        upto = np.cumsum(fill[first][order])
        before = upto - fill[first][order]
        shift = np.empty(len(first), np.int64)
        shift[order] = before - np.maximum.accumulate(np.where(new, before, 0))
        head = np.empty(len(first), np.int64)
        head[order] = first[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        total = np.bincount(number, fill[first]).astype(np.int64)[number]
        return pa.table([pa.array(bin_), pa.array(root[head[own]]), pa.array(base + shift[own]), pa.array(total[own])],
                        names=["bin", "root", "base", "fill"])

    return bins.groupBy(group.alias("group")).applyInArrow(run, "bin long, root long, base long, fill long")


def _climb(bins: DataFrame, window: int, slack: int, group_bins: int) -> DataFrame:
    """(bin, root, base): where each underfull bin ends up."""
    done, state, turn = [], bins, 0
    roots = state.where("base = 0").count()
    while roots:
        groups = -(-roots // group_bins)
        state = store(_merge(state, groups, window, turn), "packing-round")
        if groups == 1:
            done.append(state)
            break
        under = state.where(F.col("fill") < window - slack)
        left = under.where("base = 0").count()
        if left > 0.99 * roots and turn:  # two rounds that join next to nothing: no two bins fit
            done.append(state)
            break
        done.append(state.where(F.col("fill") >= window - slack))
        turn += left > 0.5 * roots
        state, roots = under, left
    result = bins.limit(0)
    for part in done:
        result = result.unionByName(part)
    return result.select("bin", "root", "base")


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", window: int = 4096, slack: int = 8,
         portion_ids: int = 1 << 22, group_bins: int = 1 << 17) -> DataFrame:
    """Pieces of packed sequences: doc_id, piece, start, length, ids (little-endian uint32), sequence_id, offset.

    A document's ids end with the end id. A document of at most ``window`` ids stays whole; a longer one is cut
    into pieces of ``window`` ids, the last may be shorter. Sequences have at most ``window`` ids; at most
    ``slack`` ids of room make a bin nearly full. A task holds about ``portion_ids`` ids at a
    time and a group of the tree about ``group_bins`` underfull bins, a few numbers each. The
    climb ends with one group, or where other company no longer lets a hundredth of the bins join.

    Null and empty texts are one id; repeated rows and ids are packed as documents of their own; an empty
    table gives no pieces. Ties of size go to the earlier row, so a table in the same files packs alike.
    """
    kind = dict(docs.dtypes)[doc_id]
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids", "bin", "offset", "fill", "full"]
    types = f"doc_id {kind}, piece int, start long, length long, ids binary, bin long, offset long, fill long, full boolean"

    def local(batches):
        encode = tokens.encoder(path).encode
        number = TaskContext.get().partitionId() << 32
        portion = _Portion(window, slack)
        pieces, sizes, held, id_type = [], [], 0, None

        def rows(bins, full):
            nonlocal number
            out: list[list] = [[] for _ in names]
            for own in bins:
                offset, fill = 0, sum(len(p[3]) // 4 for p in own)
                for doc, piece, start, ids in own:
                    for column, value in zip(out, (doc, piece, start, len(ids) // 4, ids, number, offset, fill, full)):
                        column.append(value)
                    offset += len(ids) // 4
                number += 1
            arrays = [pa.array(c, t) for c, t in zip(out, (id_type, pa.int32(), pa.int64(), pa.int64(), pa.binary(),
                                                           pa.int64(), pa.int64(), pa.int64(), pa.bool_()))]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                whole = []
                for doc, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    for piece, start in enumerate(range(0, len(ids), window)):
                        own = (doc, piece, start, ids[start:start + window].tobytes())
                        if len(own[3]) == 4 * window:
                            whole.append([own])
                        else:
                            pieces.append(own)
                            sizes.append(len(own[3]) // 4)
                            held += sizes[-1]
                if whole:
                    yield rows(whole, True)
                if held >= portion_ids:
                    yield rows(portion.pack(pieces, sizes), True)
                    pieces, sizes, held = [], [], sum(portion.fills)
                    if held > portion_ids // 2:  # they do not fit with each other: others may have room for them
                        yield rows(portion.drain(), False)
                        held = 0
        if id_type is not None:
            yield rows(portion.pack(pieces, sizes), True)
            yield rows(portion.drain(), False)

    packed = store(chosen.mapInArrow(local, types), "packing-local", compression="zstd")
    under = packed.where("not full and offset = 0").select(
        "bin", F.col("bin").alias("root"), F.lit(0).cast("long").alias("base"), "fill")
    roots = _climb(under, window, slack, group_bins)
    result = ["doc_id", "piece", "start", "length", "ids"]
    full = packed.where("full").select(*result, F.col("bin").alias("sequence_id"), "offset")
    rest = packed.where("not full").join(roots, "bin").select(
        *result, F.col("root").alias("sequence_id"), (F.col("base") + F.col("offset")).alias("offset"))
    return full.unionByName(rest)
