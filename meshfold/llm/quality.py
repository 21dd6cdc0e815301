"""Quality classifier by positive-unlabelled learning.

A logistic model over bounded features of the text is fitted on trusted positives and on
unlabelled texts alone, by the non-negative unbiased risk

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])        l(z) = log(1 + exp(-z))

with an estimated class prior. The fit uses at most ``fit_rows`` texts of each kind,
chosen and ordered by a hash of the row, so the weights do not depend on how the table is
parted; every text is scored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfold.llm.common import fold, instead, unused

HASHED = 256
SHAPES = 10
WIDTH = SHAPES + HASHED
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_ODD = b"#*$%&|<>!"


def features(text: bytes | None) -> np.ndarray:
    """Shares of characters and words, and the signed hashed frequencies of word shapes."""
    text = text or b""
    words = text.split()
    n, size = max(len(words), 1), max(len(text), 1)
    counts = Counter(words)
    triples = Counter(zip(words, words[1:], words[2:]))
    lines = [line for line in text.split(b"\n") if line.strip()]
    letters = sum(map(len, (text.translate(None, bytes(set(range(128)) - set(range(65, 91)) - set(range(97, 123)))),)))
    upper = letters - len(text.translate(None, bytes(set(range(128)) - set(range(97, 123)))))
    odd = size - len(text.translate(None, _ODD)) if text else 0
    repeated = sum(c for c in triples.values() if c > 1)
    x = np.zeros(WIDTH, np.float32)
    x[:SHAPES] = (1.0, odd / n, (size - len(text.translate(None, _MARKS))) / n if text else 0, max(upper, 0) / max(letters, 1),
                  len(counts) / n, (max(counts.values()) if counts else 0) / n, repeated / n,
                  1 - len(set(lines)) / max(len(lines), 1), np.log1p(n) / 10, sum(map(len, words)) / n / 10)
    x[1:3] = np.minimum(x[1:3], 2)
    for word, c in counts.items():
        h = zlib.crc32(word.lower())
        x[SHAPES + (h >> 1) % HASHED] += (1 if h & 1 else -1) * c / n
    return x


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600, rate: float = 0.05,
        ridge: float = 1e-3) -> np.ndarray:
    """Weights of the least non-negative risk, by Adam over all the rows. Where the negative
    part of the risk falls below zero, a step raises it again instead."""
    weights, m, v = np.zeros(WIDTH), np.zeros(WIDTH), np.zeros(WIDTH)
    if not len(positive) or not len(unlabelled):
        return weights
    positive, unlabelled = positive.astype(np.float64), unlabelled.astype(np.float64)
    for step in range(1, steps + 1):
        p, u = (1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30))) for rows in (positive, unlabelled))
        up = -prior * ((1 - p) @ positive) / len(p)  # of prior * E_P[l(g)]
        down = (u @ unlabelled) / len(u) - prior * (p @ positive) / len(p)  # of the negative part
        risk = np.mean(-np.log1p(-np.minimum(u, 1 - 1e-13))) - prior * np.mean(-np.log1p(-np.minimum(p, 1 - 1e-13)))
        slope = (up + down if risk >= 0 else -down) + ridge * weights
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope ** 2
        weights -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return weights


def _features(rows: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The features of each text, and a hash of the row that orders them whatever the layout."""
    marked = rows.select(F.xxhash64(doc_id, text).alias("mark"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            found = [features(t).tobytes() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["mark", "x"])

    return marked.mapInArrow(run, "mark long, x binary")


def _chosen(rows: DataFrame, doc_id: str, text: str, most: int) -> np.ndarray:
    """Features of the ``most`` rows of smallest hash, in that order: the same rows however the
    table is parted. Rows equal in id and text hash alike, so a table of repeats gives repeats."""
    n = rows.count()
    if n > most:
        # Over all rows the hash is even; twice the share leaves enough for the exact cut below,
        # unless repeats take part: then the cut is over all rows.
        share = rows.where(F.pmod(F.xxhash64(doc_id, text), F.lit(1_000_003)) < int(2_000_006 * most / n))
        rows = share if share.count() >= most else rows
    place = F.pmod("mark", F.lit(1_000_003))
    found = _features(rows, doc_id, text).orderBy(place, "mark", "x").limit(most).collect()
    return np.frombuffer(b"".join(bytes(r.x) for r in found), np.float32).reshape(-1, WIDTH)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          folds: int = 5, held: int = 0, fit_rows: int = 6000) -> np.ndarray:
    """Weights learnt from the rows whose fold (crc32 of the id as text, modulo ``folds``) is not ``held``.

    Positives are the texts labelled 1; of the label 0 only the share is used, as the class
    prior of the labelled rows. Without positives or texts the weights are zero. An id with
    several labels counts as positive if any of them is 1.
    """
    learnt = labels.where((fold(F.col(doc_id), folds) != held) & F.col(label).isNotNull()).groupBy(doc_id).agg(
        F.max(label).alias("label"))
    total, good = learnt.agg(F.count("*"), F.sum(F.when(F.col("label") == 1, 1))).first()
    prior = (good or 0) / total if total else 0.5
    # As many ids as the fit takes, by a hash: a side of bounded size for the join.
    mark = F.xxhash64(doc_id, F.lit("fit"))
    trusted = learnt.where("label = 1").orderBy(mark, doc_id).limit(fit_rows).select(doc_id)
    own = docs.where(fold(F.col(doc_id), folds) != held).select(doc_id, text)
    positive = _chosen(own.join(F.broadcast(trusted), doc_id, "left_semi"), doc_id, text, fit_rows)
    return fit(positive, _chosen(own, doc_id, text, fit_rows), prior)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the probability of quality of each whole text, a function of
    the text alone, so repeated rows get equal scores; null counts as empty. A column of ``docs``
    called ``name`` gives way to it."""
    docs = instead(docs, text, name)
    place = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            g = [float(features(t) @ weights) for t in batch.column(place).cast(pa.binary()).to_pylist()]
            found = 1 / (1 + np.exp(-np.clip(np.array(g, np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, name])

    return docs.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in docs.dtypes), f"`{name}` double"]))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
              threshold: float = 0.3, **training) -> DataFrame:
    """``docs`` without the documents that score below ``threshold``."""
    (name,) = unused(docs, "score")
    weights = train(docs, labels, doc_id, text, **training)
    return score(docs, weights, text, name).where(F.col(name) >= threshold).select(*docs.columns)
