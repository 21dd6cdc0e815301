"""Quality rules by the log-likelihood ratio of hashed n-grams.

Words and word pairs are hashed into ``buckets``. Two multinomials, of the trusted target
texts and of the whole raw corpus, are counted over all documents; a document's score is the
mean over its n-grams of log(target / raw). One threshold holds for every document: the
``quantile`` of the trusted texts' own scores, less ``slack`` times its distance from their
median, read from a histogram of all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfold.llm.common import store

_SYMBOLS = b"#*$%&|<>"
_NOT_IN_WORDS = b" \t\n\v\f\r" + bytes(range(0x80, 0xC0))  # white space; all but the first octet of a code point
_PRIME = np.uint64(0x9E3779B97F4A7C15)


class Hasher:
    """Hashes of words, remembered up to a bound."""

    def __init__(self, most: int = 1 << 19):
        self.known: dict[bytes, int] = {}
        self.most = most

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        try:
            return np.array([known[w] for w in words], np.uint64)
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            return np.array([known[w] for w in words], np.uint64)


def ngrams(h: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of all words and word pairs of a text, given its words' hashes."""
    pairs = h[:-1] * np.uint64(3) + h[1:] * np.uint64(5) + np.uint64(1) if len(h) else h
    mixed = np.concatenate([h, pairs]) * _PRIME
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def repeated_words(h: np.ndarray) -> int:
    """Words inside any 3-word window that occurs twice or more in the text."""
    if len(h) < 4:
        return 0
    _, code = np.unique(h, return_inverse=True)
    base = int(code.max()) + 1
    if base < 1 << 21:
        window = (code[:-2] * base + code[1:-1]) * base + code[2:]
        _, where, count = np.unique(window, return_inverse=True, return_counts=True)
    else:
        _, where, count = np.unique(np.stack([code[:-2], code[1:-1], code[2:]]), axis=1, return_inverse=True, return_counts=True)
    twice = count[where.ravel()] > 1
    hit = np.zeros(len(h), bool)
    for i in range(3):
        hit[i:len(h) - 2 + i] |= twice
    return int(hit.sum())


def rules(text: bytes, words: list[bytes], h: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words. Equal words are told by 64-bit hashes."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), len(text.translate(None, _NOT_IN_WORDS)), len(text) - len(text.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(h))


def _counts(rows: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams per bucket of the trusted rows and of all rows of (text, trusted): summed within
    each task first, then by bucket, so at most ``buckets`` rows reach the driver."""
    def count(batches):
        total, hasher = np.zeros((2, buckets), np.int64), Hasher()
        for batch in batches:
            for text, trusted in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
                own = np.bincount(ngrams(hasher((text or b"").split()), buckets), minlength=buckets)
                total[1] += own
                if trusted:
                    total[0] += own
        used = np.nonzero(total[1])[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), *map(pa.array, total[:, used])], ["bucket", "target", "raw"])

    summed = rows.mapInArrow(count, "bucket long, target long, raw long").groupBy("bucket").agg(
        F.sum("target").alias("target"), F.sum("raw").alias("raw")).collect()
    target, raw = np.zeros(buckets), np.zeros(buckets)
    for r in summed:
        target[r.bucket], raw[r.bucket] = r.target, r.raw
    return target, raw


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          buckets: int = 1 << 14, quantile: float = 0.002, slack: float = 0.5, bins: int = 1000,
          broadcast_rows: int = 500_000, min_words: int = 50, max_repeat: float = 0.5) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio, kept
    for every document.

    Trusted texts are those labelled 1; without any, or without a text, every ratio is 0 and
    only the base rules count. A null text is empty: it has no words and fails. Repeated rows
    are judged alike; an empty table gives an empty one.
    """
    trusted = labels.where(F.col(label) == 1).select(F.col(doc_id).alias("trusted_id")).distinct()
    if trusted.count() <= broadcast_rows:  # ids only; beyond this, the texts are shuffled
        trusted = F.broadcast(trusted)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        trusted, F.col("doc_id") == F.col("trusted_id"), "left").select(
        "doc_id", "text", F.col("trusted_id").isNotNull().alias("trusted"))
    target, raw = _counts(rows.select("text", "trusted"), buckets)
    ratio = np.log((target + 0.5) / (target.sum() + 0.5 * buckets)) - np.log((raw + 0.5) / (raw.sum() + 0.5 * buckets))
    if not target.any():
        ratio[:] = 0

    def run(batches):
        hasher = Hasher()
        for batch in batches:
            found = []
            for data in batch.column(1).cast(pa.binary()).to_pylist():
                data = data or b""
                words = data.split()
                h = hasher(words)
                grams = ngrams(h, buckets)
                found.append((*rules(data, words, h), float(ratio[grams].mean()) if len(grams) else 0.0))
            columns = [pa.array(c, pa.float64() if i == 5 else pa.int64()) for i, c in enumerate(zip(*found))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], _SCORED)

    id_type = dict(rows.dtypes)["doc_id"]
    scored = store(rows.mapInArrow(run, f"doc_id {id_type}, trusted boolean, n_words long, word_chars long, "
                                        "n_symbols long, n_dup_lines long, n_repeat_words long, ratio double"), "scored")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 100 * max_repeat * F.col("n_words"))
    # One row per bin: the scores lie within the logarithms of the buckets' shares.
    hist = scored.where(F.col("trusted") & ~failed).groupBy(F.floor(F.col("ratio") * bins).alias("bin")).agg(
        F.count("*").alias("n")).orderBy("bin").collect()
    upto = np.cumsum([r.n for r in hist])
    threshold = float("-inf")
    if len(hist):
        low, middle = (hist[int(np.searchsorted(upto, q * upto[-1], "right"))].bin / bins for q in (quantile, 0.5))
        threshold = low - slack * (middle - low)
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), "ratio", (~failed & (F.col("ratio") >= threshold)).alias("kept"))


_SCORED = ["doc_id", "trusted", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio"]
