"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions. For each decision (the bits of the byte so far) there is a
context tree over the ``depth`` bytes before it: a node holds how often a 0 and a 1 followed
its context, its Krichevsky-Trofimov estimate, and the weight

    Pw = 1/2 Pe + 1/2 product of Pw over the longer contexts        (Pw = Pe at full depth)

The counts come from all training texts. A bit is predicted by mixing the estimates of all
depths along its context, each with the share that 1/2 Pe has of Pw; a context is followed
as deep as training has met it. Each text starts after ``depth`` bytes 0xFF and ends with one,
which UTF-8 never uses, so the scores of all texts are one distribution.

The tree is a set of tables with every node. A gram (``depth`` bytes and the next) that only
texts outside the training have is a node of count 0: its estimate and weight are 1, so it
changes no other, and its probability is that of the longest context met. So each gram of any
text gets its score in the tables. Workers hold the scores of the most frequent grams; those
of the others are joined.

Beside it stands a base score by single words, with the same division into held and joined.
"""

from __future__ import annotations

import math
from itertools import count as counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold.llm.common import fold, store
from meshfold.llm.files import _place
from meshfold.session import new_folder

EDGE = 0xFF
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(context and next byte, packed) of every byte and the end of each text; where each text starts."""
    edge = bytes([EDGE]) * depth
    data = np.frombuffer(edge + edge.join(texts) + edge, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = depth + np.cumsum(sizes + depth) - sizes - depth
    packed = np.zeros(len(data) - depth, np.uint64)
    for i in range(depth + 1):
        packed = packed << np.uint64(8) | data[i:len(data) - depth + i]
    wanted = np.ones(len(packed), bool)  # packed[j] predicts data[j + depth]
    for i in range(1, depth):
        late = first + sizes + i - depth
        wanted[late[late < len(packed)]] = False
    return packed[wanted], np.cumsum(sizes + 1) - sizes - 1


def _portions(values: list, most: int = 1 << 20):
    """Runs of values of about ``most`` bytes together."""
    held, size = [], 0
    for value in values:
        held.append(value)
        size += len(value)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    first = np.nonzero(np.diff(keys, prepend=~keys[:1]))[0]
    return keys[first], np.add.reduceat(values, first) if len(first) else values


def gram_counts(texts: DataFrame, depth: int) -> DataFrame:
    """(gram, n, met) over all texts: summed within each task first. ``met`` counts every text, ``n``
    those learned from: all, or where a second column says so."""
    def run(batches):
        keys, values = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)
        for batch in batches:
            column = _texts(batch.column(0))
            learn = batch.column(1).to_pylist() if batch.num_columns > 1 else [True] * len(column)
            for own in (True, False):
                for portion in _portions([t for t, x in zip(column, learn) if x == own]):
                    k, n = np.unique(grams(portion, depth)[0], return_counts=True)
                    keys, values = _summed(np.concatenate([keys, k]), np.concatenate([values, np.stack([n * own, n], 1)]))
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(values[:, 0]), pa.array(values[:, 1])],
                                             ["gram", "n", "met"])

    return texts.mapInArrow(run, "gram long, n long, met long").groupBy("gram").agg(
        F.sum("n").alias("n"), F.sum("met").alias("met"))


def _log_gamma(x: Column) -> Column:
    """For x > 0: Stirling's series beyond 8, and the recurrence back."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    product = x
    for i in range(1, 8):
        product = product * (x + i)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def _log_kt(n0: Column, n1: Column) -> Column:
    """Natural logarithm of the Krichevsky-Trofimov block probability."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


def nodes(counts: DataFrame, depth: int) -> list[DataFrame]:
    """For each depth d (node, n0, n1, pe, below): node is d bytes of context and the bits so far;
    below is the logarithm of the product of Pw over the longer contexts, null at full depth."""
    bit = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("j")
    rows = counts.select("gram", "n", bit).select(
        F.expr("shiftleft(shiftright(gram, 8), 8) | shiftleft(1, j) | shiftright(gram & 255, 8 - j)").alias("node"),
        F.expr("shiftright(gram, 7 - j) & 1").alias("bit"), "n")
    level = rows.groupBy("node").agg(F.sum(F.col("n") * (1 - F.col("bit"))).alias("n0"),
                                     F.sum(F.col("n") * F.col("bit")).alias("n1"))
    level = level.withColumn("pe", _log_kt(F.col("n0"), F.col("n1"))).withColumn("below", F.lit(None).cast("double"))
    levels = [store(level, "nodes")]
    for d in range(depth - 1, -1, -1):
        high, low = F.greatest("pe", "below"), F.least("pe", "below")
        pw = F.coalesce(high + F.log1p(F.exp(low - high)) - math.log(2), F.col("pe"))
        level = levels[0].select((F.col("node").bitwiseAND((1 << 8 * (d + 1)) - 1)).alias("node"), "n0", "n1", pw.alias("pw"))
        level = level.groupBy("node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("pw").alias("below"))
        levels.insert(0, store(level.select("node", "n0", "n1", _log_kt(F.col("n0"), F.col("n1")).alias("pe"), "below"), "nodes"))
    return levels


def mixed(counts: DataFrame, depth: int) -> list[DataFrame]:
    """For each depth (node, n, q, a, b): n is how often the node was met, q the mixed probability of
    a 1 where the context ends at the node, and where n is 0 that of the longest context met."""
    levels = []
    for d, level in enumerate(nodes(counts, depth)):
        own = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1)
        if d == 0:
            level = level.withColumns({"a": F.lit(0.0), "b": F.lit(1.0), "shorter": F.lit(0.5)})
        else:
            above = levels[-1].select(F.col("node").alias("parent"), "a", "b", F.col("q").alias("shorter"))
            level = level.withColumn("parent", F.col("node").bitwiseAND((1 << 8 * d) - 1)).join(above, "parent")
        n = F.col("n0") + F.col("n1")
        q = F.when(n > 0, F.col("a") + F.col("b") * own).otherwise(F.col("shorter"))
        stay = 1 / (1 + F.exp(F.least(F.col("below") - F.col("pe"), F.lit(700.0))))
        levels.append(store(level.select("node", n.alias("n"), q.alias("q"), (F.col("a") + F.col("b") * stay * own).alias("a"),
                                         (F.col("b") * (1 - stay)).alias("b")), "mixed"))
    return levels


def gram_scores(leaves: DataFrame) -> DataFrame:
    """(gram, score): log10 of the probability of each gram's last byte, from (node, q) at full depth."""
    def paths(node, q):
        bits, total = node & 255, np.zeros(len(node))
        for j in range(1, 8):
            at = np.nonzero(bits >> j == 1)[0]
            parent = np.searchsorted(node, node[at] >> 8 << 8 | bits[at] >> 1)
            total[at] = total[parent] + np.log10(np.where(bits[at] & 1, q[parent], 1 - q[parent]))
        last = bits >> 7 == 1
        for bit in range(2):
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[last] >> 8 << 8 | (bits[last] & 127) << 1 | bit),
                 pa.array(total[last] + np.log10(q[last] if bit else 1 - q[last]))], ["gram", "score"])

    def run(batches):
        node, q = np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            node = np.concatenate([node, batch.column(0).to_numpy()])
            q = np.concatenate([q, batch.column(1).to_numpy()])
            cut = np.searchsorted(node, node[-1] >> 8 << 8) if len(node) else 0  # the last context may go on
            yield from paths(node[:cut], q[:cut])
            node, q = node[cut:], q[cut:]
        yield from paths(node, q)

    context = F.expr("shiftright(node, 8)")
    return leaves.select("node", "q").repartition(context).sortWithinPartitions("node").mapInArrow(run, "gram long, score double")


def model(counts: DataFrame, depth: int, max_nodes: int) -> DataFrame:
    """(depth, node, q): the tree as one table to hold in memory; ``score`` reads the whole tables instead.

    At most ``max_nodes`` nodes: beyond that, contexts met less than some power of two times
    are left to the shorter ones; each still counts there.
    """
    found = None
    for d, level in enumerate(mixed(counts, depth)):
        own_rows = level.where("n > 0").select(F.lit(d).alias("depth"), "node", "n", "q")
        found = own_rows if found is None else found.unionByName(own_rows)
    least, total = 0, 0
    sizes = found.where("depth > 0").groupBy(F.floor(F.log2("n")).alias("k")).agg(F.count("*").alias("c"))
    for r in sorted(sizes.collect(), key=lambda r: -r.k):  # one row per power of two
        total += r.c
        if total > max_nodes:
            least = 2 ** (r.k + 1)
            break
    return found.where((F.col("depth") == 0) | (F.col("n") >= least)).select("depth", "node", F.col("q").cast("float").alias("q"))


class Scorer:
    """The model in memory, with remembered scores of grams in two tables of fixed size."""

    def __init__(self, depth_of: np.ndarray, node: np.ndarray, q: np.ndarray, depth: int, slots: int = 21):
        self.depth = depth
        self.node, self.q = [], []
        for d in range(depth + 1):
            at = depth_of == d
            order = np.argsort(node[at])
            self.node.append(node[at][order])
            self.q.append(q[at][order])
        self._remember(slots)

    def _remember(self, slots: int):
        self.slots = slots
        self.keys = np.full((2, 1 << slots), ~np.uint64(0))
        self.values = np.zeros((2, 1 << slots))

    def exact(self, gram: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram's last byte after the others."""
        context, byte = (gram >> np.uint64(8)).astype(np.int64), (gram & np.uint64(255)).astype(np.int64)
        total = np.zeros(len(gram))
        for j in range(8):
            bits, bit = 1 << j | byte >> (8 - j), byte >> (7 - j) & 1
            p = np.full(len(gram), 0.5)
            rest = np.arange(len(gram))
            for d in range(self.depth, -1, -1):
                if not len(rest) or not len(self.node[d]):
                    continue
                key = (context[rest] & ((1 << 8 * d) - 1)) << 8 | bits[rest]
                at = np.minimum(np.searchsorted(self.node[d], key), len(self.node[d]) - 1)
                met = self.node[d][at] == key
                p[rest[met]] = self.q[d][at[met]]
                rest = rest[~met]
            total += np.log10(np.where(bit == 1, p, 1 - p))
        return total

    def _slot(self, gram: np.ndarray, table: int) -> np.ndarray:
        return (gram ^ gram >> np.uint64(17 * table + 40 * (1 - table))) * _PRIME >> np.uint64(64 - self.slots)

    def __call__(self, gram: np.ndarray) -> np.ndarray:
        slot = self._slot(gram, 0)
        result = self.values[0][slot]
        rest = np.nonzero(self.keys[0][slot] != gram)[0]
        if len(rest):
            own = gram[rest]
            slot = self._slot(own, 1)
            result[rest] = self.values[1][slot]
            rest = rest[self.keys[1][slot] != own]
        if len(rest):
            new, where = np.unique(gram[rest], return_inverse=True)
            value = self.exact(new)
            result[rest] = value[where]
            for table in range(2):
                slot = self._slot(new, table)
                free = self.keys[table][slot] == ~np.uint64(0)
                self.keys[table][slot[free]] = new[free]
                own = self.keys[table][slot] == new
                self.values[table][slot[own]] = value[own]
                new, value = new[~own], value[~own]
        return result


class Known(Scorer):
    """Given scores of grams, looked up by the remembered tables; NaN for grams without one."""

    def __init__(self, gram: np.ndarray, score: np.ndarray, slots: int = 21):
        order = np.argsort(gram)
        self.gram, self.score = gram[order], score[order]
        self._remember(slots)

    def exact(self, gram: np.ndarray) -> np.ndarray:
        if not len(self.gram):
            return np.full(len(gram), np.nan)
        at = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
        return np.where(self.gram[at] == gram, self.score[at], np.nan)


_LOADED: dict[str, object] = {}


def _loaded(folder: str, make):
    """What ``make`` builds from a stored table, once per worker; the last few folders are held."""
    if folder not in _LOADED:
        while len(_LOADED) > 1:
            _LOADED.pop(next(iter(_LOADED)))
        system, path = _place(folder)
        _LOADED[folder] = make(pq.read_table(path, filesystem=system))
    return _LOADED[folder]


def _words(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, the code of each word in order, the row of each word)."""
    texts = pa.array([t or "" for t in column.to_pylist()], pa.large_string())  # a copy: slices are not lowered rightly
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = lists.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(column)), np.diff(lists.offsets.to_numpy()))
    code = coded.indices.to_numpy()
    blank = pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    keep = ~blank[code] if len(code) else np.zeros(0, bool)
    return coded.dictionary, code[keep], row[keep]


def word_counts(texts: DataFrame, most: int = 400_000) -> DataFrame:
    """(word, n) over all texts; each task sums up to ``most`` distinct words at a time."""
    def run(batches):
        held: dict[str, int] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              ["word", "n"])

        for batch in batches:
            for at in range(0, len(batch), 1000):
                names, code, _ = _words(batch.column(0).slice(at, 1000))
                sums = np.bincount(code, minlength=len(names))
                for word, n in zip(names.to_pylist(), sums.tolist()):
                    if n:
                        held[word] = held.get(word, 0) + n
                if len(held) > most:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _lists(row: np.ndarray, code: np.ndarray, rows: int, values: pa.Array, name: str) -> pa.ListArray:
    """For each of ``rows`` rows the list of (its distinct values, how often)."""
    far, times = np.unique(row << 32 | code, return_counts=True)
    bounds = np.searchsorted(far >> 32, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(
        [values.take(pa.array(far & 0xFFFFFFFF)), pa.array(times, pa.int64())], [name, "times"]))


def _frequent(words: DataFrame, most: int) -> DataFrame:
    """The rows met at least some power of two times, so that there are at most ``most``."""
    total, least = 0, 1
    for r in sorted(words.groupBy(F.floor(F.log2("n")).alias("k")).agg(F.count("*").alias("c")).collect(), key=lambda r: -r.k):
        total += r.c
        if total > most:
            least = 2 ** (r.k + 1)
            break
    return words.where(F.col("n") >= least)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 5, held: int = 1, depth: int = 5,
          frequent_grams: int = 1 << 21, frequent_words: int = 1 << 18) -> DataFrame:
    """doc_id, held_out, n_bytes, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte
    of every whole text.

    Both models learn from the texts whose fold (crc32 of the id as text, modulo ``folds``) is
    not ``held``. A null text is empty: one end token, one end byte. Repeated rows are scored
    alike; without training texts every bit has probability 1/2; an empty table gives an
    empty one. Words beyond the ``frequent_words`` most frequent and grams beyond the
    ``frequent_grams`` most frequent are looked up by a join: these bounds change no score.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    train = rows.where(fold(F.col("doc_id"), folds) != held).select("text")
    near_grams, top = new_folder(spark, "frequent-grams"), new_folder(spark, "frequent-words")
    counts = store(gram_counts(rows.select("text", (fold(F.col("doc_id"), folds) != held).alias("learn")), depth), "grams")
    tree = store(counts.join(gram_scores(mixed(counts, depth)[-1]), "gram").select("gram", F.col("met").alias("n"), "score"),
                 "context-tree")
    _frequent(tree, frequent_grams).select("gram", "score").write.parquet(near_grams)
    words = store(word_counts(train), "words")
    _frequent(words, frequent_words).write.parquet(top)
    n_train = train.count()
    sums = words.agg(F.sum("n"), F.count("*")).first()
    total, distinct = (sums[0] or 0) + n_train, sums[1] + (n_train > 0)
    end = math.log10(n_train + 0.5)
    per_token = math.log10(total + 0.5 * (distinct + 1))

    def run(batches):
        scorer = _loaded(near_grams, lambda t: Known(t["gram"].to_numpy().view(np.uint64), t["score"].to_numpy()))
        names, logs = _loaded(top, lambda t: (t["word"].combine_chunks().cast(pa.large_string()),
                                              np.log10(t["n"].to_numpy() + 0.5)))
        base = TaskContext.get().partitionId() << 33
        number = counter(base)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                texts = _texts(part.column(1))
                values, far_grams, far_rows, done = [], [], [], 0
                for portion in _portions(texts):
                    gram, first = grams(portion, depth)
                    value = scorer(gram)
                    far = np.nonzero(np.isnan(value))[0]
                    value[far] = 0
                    values.append(np.add.reduceat(value, first))
                    far_grams.append(gram[far])
                    far_rows.append(np.searchsorted(first, far, "right") - 1 + done)
                    done += len(portion)
                own_grams, gram_code = np.unique(np.concatenate(far_grams), return_inverse=True)
                rare_grams = _lists(np.concatenate(far_rows), gram_code, len(part), pa.array(own_grams.view(np.int64)), "gram")
                distinct_words, code, row = _words(part.column(1))
                place = pc.index_in(distinct_words, value_set=names).fill_null(-1).to_numpy()[code]
                n = np.bincount(row, minlength=len(part))
                near = place >= 0
                known = np.bincount(row[near], minlength=len(part))
                log = np.bincount(row[near], logs[place[near]] if len(logs) else None, minlength=len(part))
                rare = _lists(row[~near], code[~near], len(part), distinct_words.cast(pa.string()), "word")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([next(number) for _ in texts]), part.column(0), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(log.astype(float)),
                     pa.array(np.concatenate(values)), rare, rare_grams],
                    ["row", "doc_id", "n_bytes", "n_words", "known", "log", "near_score", "rare", "rare_grams"])

    id_type = dict(rows.dtypes)["doc_id"]
    scored = store(rows.mapInArrow(run, f"row long, doc_id {id_type}, n_bytes long, n_words long, known long, log double, "
                                        "near_score double, rare array<struct<word:string,times:long>>, "
                                        "rare_grams array<struct<gram:long,times:long>>"), "scored")
    rare = scored.select("row", F.inline("rare")).join(words, "word", "left").select(
        "row", F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("known"),
        (F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("log"))
    rare = store(rare.groupBy("row").agg(F.sum("known").alias("rare_known"), F.sum("log").alias("rare_log")), "rare")
    far = scored.select("row", F.inline("rare_grams")).join(tree, "gram").groupBy("row").agg(
        F.sum(F.col("times") * F.col("score")).alias("far_score"))
    scored = scored.drop("rare", "rare_grams").join(rare, "row", "left").join(store(far, "rare-grams"), "row", "left").withColumn(
        "score", F.col("near_score") + F.coalesce("far_score", F.lit(0.0)))
    n_tokens = F.col("n_words") + 1
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "n_bytes", n_tokens.alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + (1 if n_train else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("log") + F.coalesce("rare_log", F.lit(0.0)) + end - n_tokens * per_token).alias("base_score"), "score",
        (-F.col("score") / math.log10(2) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
