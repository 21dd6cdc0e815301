"""Whitening of embeddings by distributed block matrices.

Entries become whole numbers, so the count and the sums are exact and each centred entry is rounded once.
Centred rows are indexed into blocks of an MLlib ``BlockMatrix``: every task numbers blocks of its own rows, the last one
padded with zero rows, which change no product. The transposed matrix times the matrix gives the
scatter, with the long dimension split so that no task holds more than a few blocks; its
eigenvectors are found on the driver (``d`` x ``d`` numbers, whatever the rows). For the
projection the same blocks are laid out as a square of panels and multiplied by a block
diagonal of the whitening matrix, which lets a grid of partitions share the work evenly.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from meshfold.llm.common import store

LIMIT = 1 << 62  # 1024 times an entry stays below, so that every whole number is a long
_INDEX = StructType([StructField("i", LongType()), StructField("j", LongType())])
_BLOCK = StructType([StructField("block", _INDEX), StructField("matrix", MatrixUDT())])
_PLAIN = StructType([StructField("block", _INDEX), StructField("matrix", MatrixUDT.sqlType())])


@dataclass(frozen=True)
class Model:
    """Rows of the fit, sums of their whole numbers, and of each component, by falling variance, the
    eigenvalue, its share of the trace and the column that projects and scales."""

    n: int
    sums: list[int]
    values: np.ndarray
    explained: np.ndarray
    matrix: np.ndarray


def valid(vector: str) -> Column:
    """No null vector, and no entry that is null, not finite or beyond the long range."""
    bad = F.exists(vector, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double") * 1024.0) >= float(LIMIT)))
    return F.col(vector).isNotNull() & ~bad


def whole(rows: np.ndarray) -> np.ndarray:
    """floor(1024 c) + 100000 of double entries."""
    return np.floor(1024.0 * rows).astype(np.int64) + 100_000


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """(n x - S) / n as doubles; exact until the division, also where n x is beyond a long."""
    if _safe(x, n, sums):
        return (n * x - np.array(sums, np.int64)) / n
    return np.array([[(n * v - s) / n for v, s in zip(row, sums)] for row in x.tolist()], np.float64).reshape(x.shape)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the entries of (n x - S) squared; None where it is beyond a long."""
    if _safe(x, n, sums):
        d = n * x - np.array(sums, np.int64)
        if x.shape[1] * float(np.abs(d).max(initial=0)) ** 2 < 2 ** 62:
            return (d * d).sum(axis=1).tolist()
    exact = (sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist())
    return [v if v < 1 << 63 else None for v in exact]


def _safe(x: np.ndarray, n: int, sums: list[int]) -> bool:
    most = max((abs(s) for s in sums), default=0)
    return n * int(np.abs(x).max(initial=0)) + most < 1 << 62


def _blocks(rows: DataFrame, vec_id: str, vector: str, width: int, height: int) -> DataFrame:
    """task, local (the task's own number of the block), ids, x (long, row by row) of up to ``height`` rows."""
    kind = dict(rows.dtypes)[vec_id]
    chosen = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))

    def cut(batches):
        task, local, held = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            while held.num_rows >= height:
                yield block(task, local, held.slice(0, height))
                held, local = held.slice(height), local + 1
        if held is not None and held.num_rows:
            yield block(task, local, held)

    def block(task, local, part):
        x = whole(part.column(1).flatten().to_numpy().reshape(len(part), width))
        ids = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column(0))
        return pa.RecordBatch.from_arrays([pa.array([task]), pa.array([local]), ids, pa.array([x.tobytes()], pa.binary())],
                                          ["task", "local", "ids", "x"])

    return store(chosen.mapInArrow(cut, f"task long, local long, ids array<{kind}>, x binary"), "whitening-blocks")


def _sums(blocks: DataFrame, width: int) -> tuple[int, list[int]]:
    """Rows and the exact sums of their whole numbers; one row per entry of a vector reaches the driver."""
    def part(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                x = np.frombuffer(data, np.int64).reshape(-1, width)
                places = np.arange(-1, width)
                high, low = (x >> 31).sum(axis=0), (x & ((1 << 31) - 1)).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.insert(high, 0, 0)),
                                                  pa.array(np.insert(low, 0, len(x)))], ["place", "high", "low"])

    found = blocks.select("x").mapInArrow(part, "place long, high long, low long").groupBy("place").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low"))
    total = {r.place: (r.high << 31) + r.low for r in found.collect()}
    return total[-1], [total[i] for i in range(width)]


def _matrix_rows(indexed) -> pa.RecordBatch:
    """A record batch of (i, j, row-major values) as blocks."""
    rows = [{"block": {"i": i, "j": j}, "matrix": {
        "type": 1, "numRows": m.shape[0], "numCols": m.shape[1], "colPtrs": None, "rowIndices": None,
        "values": m.ravel(), "isTransposed": True}} for i, j, m in indexed]
    return pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(_PLAIN))


def _matrix(blocks: DataFrame, height: int, width: int, rows: int, columns: int) -> BlockMatrix:
    """The matrix of a table of blocks, without a way through Python."""
    return BlockMatrix(callMLlibFunc("createBlockMatrix", blocks, height, width, rows, columns), height, width)


def _times(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """a * b with the middle dimension dealt to ``splits`` tasks for each block of the result."""
    product = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def fit(scatter: np.ndarray, n: int, sums: list[int], components: int) -> Model:
    """Components by falling eigenvalue, without those that are zero to double precision. The entry of
    greatest size of each is positive."""
    covariance = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    there = values > max(values[0], 0) * len(values) * np.finfo(float).eps * 8
    values, vectors = values[there][:components], vectors[:, there][:, :components]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return Model(n, sums, values, values / np.trace(covariance), vectors / np.sqrt(values))


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = 8,
           most_rows: int = 1024) -> tuple[DataFrame, Model | None]:
    """(vec_id, deviation, whitened) of every valid row, and the model; ``whitened`` has an entry for each component.

    Rows go whose vector is null, holds a null or non-finite entry or one of 2**52 or more, or is of another
    length than most (ties: the longer). ``deviation`` is null where it is beyond a long. Components without
    variance to double precision are left out, so equal rows, a single row or none give no
    component, and the model is None without rows or entries. Repeated rows count each time. The driver holds the scatter,
    8 d**2 bytes, and a number for each task; blocks have at most ``most_rows`` rows and 8 MB.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[vec_id]
    rows = vectors.where(valid(vector)).select(vec_id, vector)
    usual = rows.groupBy(F.size(vector).alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if usual is None or not usual.width:
        return spark.createDataFrame([], f"vec_id {kind}, deviation long, whitened array<double>"), None
    width = usual.width
    rows = rows.where(F.size(vector) == width)
    tasks = max(1, rows.rdd.getNumPartitions())
    height = max(1, min(most_rows, (1 << 20) // width, max(16, usual["count"] // tasks)))
    blocks = _blocks(rows, vec_id, vector, width, height)
    n, sums = _sums(blocks, width)
    # One number for each task that has rows.
    offset, count = {}, 0
    for r in blocks.groupBy("task").count().orderBy("task").collect():
        offset[r.task], count = count, count + r["count"]

    def index(batches):
        for batch in batches:
            for task, local, data in zip(*(batch.column(c).to_pylist() for c in ("task", "local", "x"))):
                own = centred(np.frombuffer(data, np.int64).reshape(-1, width), n, sums)
                yield _matrix_rows([(offset[task] + local, 0, np.pad(own, ((0, height - len(own)), (0, 0))))])

    matrix = store(blocks.select("task", "local", "x").mapInArrow(index, _BLOCK), "whitening-matrix")
    a = _matrix(matrix, height, width, count * height, width)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    splits = min(count, max(partitions, -(-count * height * width >> 23)))  # at most 64 MB of blocks in each
    scatter = _times(a.transpose(), a, splits).toLocalMatrix().toArray()
    model = fit(scatter, n, sums, components)
    found = len(model.values)

    def number(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("task", "local", "x")]
            devs = [deviations(np.frombuffer(x, np.int64).reshape(-1, width), n, sums) for x in columns[2]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([offset[t] + i for t, i in zip(*columns[:2])], pa.int64()), batch.column(batch.schema.get_field_index("ids")),
                 pa.array(devs, pa.list_(pa.int64()))], ["number", "ids", "deviations"])

    named = blocks.mapInArrow(number, f"number long, ids array<{kind}>, deviations array<long>")
    if not found:
        alone = named.select(F.inline(F.arrays_zip("ids", "deviations"))).toDF("vec_id", "deviation")
        return alone.withColumn("whitened", F.array().cast("array<double>")), model

    side = int(np.ceil(np.sqrt(count)))  # panels: block i stands at (i div side, i mod side)
    square = matrix.select(F.struct(F.expr(f"block.i div {side}").alias("i"), F.expr(f"block.i % {side}").alias("j")).alias("block"), "matrix")
    own = model.matrix

    def diagonal(batches):
        for batch in batches:
            yield _matrix_rows([(c, c, own) for c in batch.column(0).to_pylist()])

    few = spark.range(0, side, 1, min(side, partitions)).mapInArrow(diagonal, _BLOCK)
    panels = _matrix(square, height, width, -(-count // side) * height, side * width)
    product = _times(panels, _matrix(few, width, found, side * width, side * found), 1)

    def back(batches):
        for batch in batches:
            for place, m in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.asarray(m["values"].values)
                shape = (m["numRows"].as_py(), m["numCols"].as_py())
                values = values.reshape(shape) if m["isTransposed"].as_py() else values.reshape(shape[::-1]).T
                yield pa.RecordBatch.from_arrays([pa.array([place["_1"] * side + place["_2"]], pa.int64()),
                                                  pa.array([np.ascontiguousarray(values).tobytes()], pa.binary())], ["number", "data"])

    projected = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model).mapInArrow(
        back, "number long, data binary")

    def rows_of(batches):
        for batch in batches:
            for ids, devs, data in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
                values = np.frombuffer(data, np.float64)[:len(ids) * found]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, found), pa.int32()), pa.array(values))
                yield pa.RecordBatch.from_arrays([ids.values, devs.values, lists], ["vec_id", "deviation", "whitened"])

    joined = named.join(projected, "number").select("ids", "deviations", "data")
    return joined.mapInArrow(rows_of, f"vec_id {kind}, deviation long, whitened array<double>"), model


def identity_error(whitened: DataFrame, components: int, column: str = "whitened") -> float:
    """Largest absolute entry of the rows' covariance (divisor n, centred) minus the identity."""
    pairs = list(combinations_with_replacement(range(components), 2))
    entry = lambda i: F.col(column)[i]
    found = whitened.agg(*[F.covar_pop(entry(i), entry(j)) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))
