"""Benchmark decontamination with DataFrame functions only.

An item's windows are its runs of ``window`` words (an item of fewer words is one window).
Of a window of L words, every run of k = L - m + 1 words, with m = (L + 1) div 2, is hashed
into a set that is broadcast while its size is below a bound, and joined by a shuffle
beyond it. In a document only the runs of k words that start at a multiple of m are looked
up: wherever a window stands, it covers one of them whole. Each hit names the windows that
have the run and where they would start; there the words themselves are compared, so equal
hashes of other words count nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold.llm.common import instead, lower_ascii, store, unused

# What stands between words after A-Z are lower-cased, and before; a word before.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(lower_ascii(text), F.lit("")), BETWEEN), "")


def _step(length: int) -> int:
    return (length + 1) // 2


def item_windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct windows: number, length, words, items (the ids, as strings, of all items that
    have it). A null id is the string ''."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                             words(F.col(text)).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(window)))
    each = items.select("item", "length", F.explode(F.expr(
        "transform(sequence(1, size(words) - length + 1), i -> slice(words, i, length))")).alias("words"))
    windows = each.groupBy("length", "words").agg(F.collect_set("item").alias("items"))
    return windows.withColumn("number", F.monotonically_increasing_id())


def _runs(windows: DataFrame) -> DataFrame:
    """length, h, inside, number: the hashed runs of each window and where they start in it."""
    m = F.expr("(length + 1) div 2").cast("int")
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    return windows.select("number", "length", m.alias("m"), hashes.alias("w")).select(
        "number", "length", F.posexplode(F.expr(
            "transform(sequence(1, m), i -> xxhash64(slice(w, i, length - m + 1)))")).alias("inside", "h"))


def _found(docs: DataFrame, id_: Column, mark_: Column, text: Column, windows: DataFrame, lengths: list[int],
           broadcast_bytes: int) -> DataFrame:
    """(id, mark, found): the windows that may stand in each document, by start."""
    w = docs.select(id_.alias("id"), mark_.alias("mark"), F.transform(words(text), lambda x: F.xxhash64(x)).alias("w"))

    def runs(length: int) -> Column:
        m = _step(length)
        k = length - m + 1
        starts = F.when(F.size("w") >= k, F.sequence(F.lit(1), F.size("w") - (k - 1), F.lit(m))).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(
            F.lit(length).alias("length"), i.alias("place"), F.xxhash64(F.slice("w", i, k)).alias("h")))

    each = w.select("id", "mark", F.inline(reduce(F.concat, map(runs, lengths))))
    known = store(_runs(windows), "benchmark-runs")
    small = known.count() * 64 <= broadcast_bytes  # four numbers in a row
    hit = each.join(F.broadcast(known) if small else known, ["length", "h"])
    hit = hit.select("id", "mark", "number", (F.col("place") - F.col("inside")).alias("at")).where("at > 0").distinct()
    named = hit.join(windows, "number")
    return named.groupBy("id", "mark").agg(F.collect_set(F.struct("at", "length", "words", "items")).alias("found"))


def mark(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", window: int = 10,
         broadcast_bytes: int = 64 << 20, names: tuple[str, str, str] = ("n_words", "hits", "items")) -> DataFrame:
    """``docs`` and three columns (``names``): the number of words, the places (from 0) of the words
    inside any benchmark window, the ids (as strings, sorted) of the items whose windows occur.

    Null and empty texts have no words; items without a word have no window; items that
    share a window all count; repeated rows get the same answer; an empty table of items
    leaves all documents clean. A column of ``docs`` called like a result gives way to it.
    """
    docs = instead(docs, text, *names)
    windows = store(item_windows(benchmark, item_id, item_text, window), "benchmark-windows")
    lengths = [r.length for r in windows.select("length").distinct().collect()]  # at most ``window`` numbers
    ident, key, found = unused(docs, "ident", "key", "found")
    id_, mark_ = F.col(doc_id), F.xxhash64(F.col(text))
    none = "array<struct<at:int,length:int,words:array<string>,items:array<string>>>"
    if not lengths:
        joined = docs.withColumn(found, F.lit(None).cast(none))
    else:
        hits = _found(docs, id_, mark_, F.col(text), windows, sorted(lengths), broadcast_bytes)
        hits = store(hits.select(F.col("id").alias(ident), F.col("mark").alias(key), F.col("found").alias(found)), "hits")
        joined = docs.join(hits, id_.eqNullSafe(F.col(ident)) & (mark_ == F.col(key)), "left").drop(ident, key)
    n_words, places, items = names
    # Each step is used more than once by the next, so it stays a projection of its own and is computed once.
    own, true = unused(joined, "own", "true")
    cut = joined.withColumn(own, words(F.col(text)))
    same = F.filter(F.coalesce(F.col(found), F.array().cast(none)),
                    lambda x: F.slice(own, x["at"], x["length"]) == x["words"])
    checked = cut.select(*docs.columns, F.size(own).cast("long").alias(n_words), same.alias(true))
    hit = F.array_sort(F.array_distinct(F.flatten(F.transform(
        true, lambda x: F.sequence(x["at"] - 1, x["at"] + x["length"] - 2)))))
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform(true, lambda x: x["items"]))))
    return checked.select(*docs.columns, n_words, hit.alias(places), ids.alias(items))


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text", window: int = 10, drop_share: float = 0.5) -> DataFrame:
    """``docs`` without benchmark passages: the hit words go, with the gaps before them, and
    a document of which more than ``drop_share`` of the words are hit goes as a whole.
    A column ``n_chars``, where there is one, counts the characters that are left."""
    names = tuple(unused(docs, "n_words", "hits", "items"))
    marked = mark(docs, benchmark, doc_id, text, item_id, item_text, window, names=names)
    n_words, hits = F.col(names[0]), F.col(names[1])
    marked = marked.where(F.size(hits) <= drop_share * n_words)
    pieces = F.regexp_extract_all(F.col(text), F.lit(GAP + WORD_ANY_CASE), F.lit(0))
    kept = F.filter(pieces, lambda _, i: ~F.array_contains(hits, i))
    tail = F.regexp_extract(F.col(text), GAP + "$", 0)
    rest = F.when(F.size(hits) > 0, F.concat(F.array_join(kept, ""), tail)).otherwise(F.col(text))
    result = marked.withColumn(text, rest)
    if "n_chars" in docs.columns:
        result = result.withColumn("n_chars", F.when(F.size(hits) > 0, F.length(text).cast(
            dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return result.select(*docs.columns)
