"""Periodic runs of words by maximal pairs of the LCP-interval tree.

A maximal pair is two places of a text from which ``L`` words agree, but neither the words
before them nor the words after do. Two such places ``p`` apart mean that ``p + L`` words from the first
repeat with period ``p`` and that no neighbour goes on with it. So the maximal pairs with
``L >= (min_exponent - 1) * p`` and ``p + L >= min_length`` are the runs, without any extension;
of pairs that give one stretch, the nearest has its smallest period.

The suffixes of a document are sorted by doubling, their LCP intervals are met bottom-up,
and each interval holds its places in order, by class of the word on their left. Where two
intervals join, the places of the smaller are looked up in the larger one, at most
``L / (min_exponent - 1)`` words away. That near, all places but the first are steps of one
period and so are of one class: either the whole list of a class pairs with a place or none of it does.
The work is n log n and the pairs found, not all pairs.

Only documents in which some ``k`` words occur twice can have a run (``k`` = 16 for runs of 24
words and three periods); their words are hashed to tell, and only such documents are sorted.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meshfold.llm.common import instead

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def least_match(min_length: int, min_exponent: int) -> int:
    """Words that agree at the two places of any run's pair, at least."""
    return min(max(min_length - p, (min_exponent - 1) * p) for p in range(1, min_length + 1))


def repeated(codes: np.ndarray, doc: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
    """Marks the places whose ``k`` words occur again in their document (equal hashes of other words too)."""
    marked = np.zeros(len(codes), bool)
    m = len(codes) - k + 1
    if m < 2:
        return marked
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    h = (doc[:m].astype(np.uint64) + np.uint64(1)) * _STEP
    for j in range(k):
        h *= _STEP
        h += mixed[j:j + m]
    whole = np.nonzero(np.arange(k, m + k) <= end[:m])[0]
    h = h[whole]
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    marked[whole[order[1:][same]]] = True
    marked[whole[order[:-1][same]]] = True
    return marked


def suffix_order(codes: np.ndarray, doc: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Places in the order of their document and of the words from there to its end. Ranks
    are doubled; only places that are still tied are sorted again."""
    n = len(codes)
    key = doc.astype(np.int64) << 32 | codes
    sa = np.argsort(key, kind="stable")
    key = key[sa]
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(np.diff(key, prepend=-1) != 0, np.arange(n), 0))
    step = 1
    while True:
        own = rank[sa]
        tied = np.zeros(n, bool)
        tied[1:] = own[1:] == own[:-1]
        tied[:-1] |= tied[1:]
        slots = np.nonzero(tied)[0]
        if not len(slots):
            return sa
        x = sa[slots]
        then = x + step
        second = np.where(then < end[x], rank[np.minimum(then, n - 1)] + 1, 0)
        key = rank[x] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        x, key = x[order], key[order]
        sa[slots] = x
        rank[x] = slots[np.maximum.accumulate(np.where(np.diff(key, prepend=-1) != 0, np.arange(len(x)), 0))]
        step *= 2


def matches(codes: list[int], doc: np.ndarray, end: list[int], sa: np.ndarray, places: np.ndarray) -> list[int]:
    """For each of the ``places``, by number, how many words agree with the suffix before it in order. From a
    place to the next one word is lost at most."""
    before = np.full(len(sa), -1, np.int64)
    before[sa[1:]] = np.where(doc[sa[1:]] == doc[sa[:-1]], sa[:-1], -1)
    found, h, last = [], 0, -2
    for i, j in zip(places.tolist(), before[places].tolist()):
        h = h - 1 if i == last + 1 and h else 0
        last = i
        if j < 0:
            h = 0
        else:
            limit = end[i] - (i if i > j else j)
            while h < limit and codes[i + h] == codes[j + h]:
                h += 1
        found.append(h)
    return found


def _join(a: list[int], b: list[int], match: int, left: list[int], min_length: int, factor: int, found: dict) -> list[int]:
    """Places of two intervals in order; their pairs near enough, of different classes, go to ``found``."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    reach = match // factor
    for x in small:
        i = bisect_right(large, x)
        if i < len(large) and large[i] - x <= reach and left[large[i]] != left[x]:
            for y in large[i:bisect_right(large, x + reach, i)]:  # one class
                _pair(x, y, match, min_length, found)
        if i and x - large[i - 1] <= reach:
            y = large[bisect_left(large, x - reach, 0, i)]  # all after it are of the class of x
            if left[y] != left[x]:
                _pair(y, x, match, min_length, found)
    if len(small) < 8:
        for x in small:
            insort(large, x)
    else:
        large += small
        large.sort()
    return large


def _pair(x: int, y: int, match: int, min_length: int, found: dict) -> None:
    length = y - x + match
    if length >= min_length and found.get((x, length), length) > y - x:
        found[x, length] = y - x


def interval_pairs(places: list[int], match: list[int], left: list[int], min_length: int, factor: int, k: int,
                   found: dict) -> None:
    """Bottom-up over the intervals of suffixes in order: ``match[t]`` words agree between t - 1 and t."""
    stack: list[tuple[int, list[int]]] = []
    node = [places[0]]
    for place, here in zip([*places[1:], -1], [*match[1:], k - 1]):
        while stack and stack[-1][0] > here:
            depth, others = stack.pop()
            node = _join(others, node, depth, left, min_length, factor, found)
        if here < k:  # no run spans it
            stack.clear()
        elif stack and stack[-1][0] == here:
            stack.append((here, _join(stack.pop()[1], node, here, left, min_length, factor, found)))
        else:
            stack.append((here, node))
        node = [place]


def find(codes: np.ndarray, starts: np.ndarray, min_length: int = 24, min_exponent: int = 3) -> list[list[tuple[int, int, int]]]:
    """For each document (``codes[starts[d]:starts[d + 1]]``, numbers of words) its runs (start, length, period)
    by start and period."""
    if min_exponent < 3:
        raise ValueError("runs have three periods at least")
    k, sizes = least_match(min_length, min_exponent), np.diff(starts)
    result: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    again = repeated(codes, doc, starts[1:][doc], k)
    chosen = np.unique(doc[again])
    if not len(chosen):
        return result
    keep = np.isin(doc, chosen)
    codes, doc, again = codes[keep], doc[keep], again[keep]
    ends = np.cumsum(sizes[chosen])
    base = dict(zip(chosen.tolist(), (ends - sizes[chosen]).tolist()))
    end = np.repeat(ends, sizes[chosen])
    sa = suffix_order(codes, doc, end)
    places = np.nonzero(again)[0]
    match = np.zeros(len(codes), np.int64)
    words = codes.tolist()
    match[places] = matches(words, doc, end.tolist(), sa, places)
    left = [-1, *words[:-1]]
    for b in base.values():
        left[b] = -1
    ordered = sa[again[sa]]
    found: dict[tuple[int, int], int] = {}
    interval_pairs(ordered.tolist(), match[ordered].tolist(), left, min_length, min_exponent - 1, k, found)
    for (start, length), period in found.items():
        d = int(doc[start])
        result[d].append((start - base[d], length, period))
    for d in chosen.tolist():
        result[d].sort(key=lambda run: (run[0], run[2]))
    return result


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run contains after its first period, joined by one space."""
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        words = [w for w, n in zip(words, np.cumsum(change).tolist()) if not n]
    return b" ".join(words)


def mark(docs: DataFrame, text: str = "text", min_length: int = 24, min_exponent: int = 3,
         names: tuple[str, str, str] = ("n_words", "runs", "collapsed"), most_words: int = 400_000) -> DataFrame:
    """``docs`` and three columns (``names``): the number of words, the runs (start, length, period; by start, then
    period) of at least ``min_length`` words and ``min_exponent`` periods, the text with one period of each run.

    Words stand between ASCII white space. Null and empty texts have no words and collapse to the empty text;
    repeated rows get equal answers; an empty table gives an empty one; a column of ``docs``
    called like a result gives way to it. Documents are handled ``most_words`` words at a time, a
    longer one alone (about 200 bytes of memory a word where it repeats, 100 where it does not).
    """
    docs = instead(docs, text, *names)
    place = docs.columns.index(text)
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(lists: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
        starts = np.cumsum([0, *map(len, lists)])
        codes = pa.array([w for words in lists for w in words], pa.binary()).dictionary_encode().indices
        return find(codes.to_numpy().astype(np.int64), starts, min_length, min_exponent)

    def run(batches):
        for batch in batches:
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            sizes, runs, collapsed = [], [], []
            held: list[list[bytes]] = []
            size = 0
            for n, t in enumerate(texts, 1):
                held.append((t or b"").split())
                size += len(held[-1])
                if size >= most_words or n == len(texts):
                    long = [i for i, words in enumerate(held) if len(words) >= min_length]
                    found: list[list[tuple[int, int, int]]] = [[] for _ in held]
                    for i, own in zip(long, search([held[i] for i in long]) if long else []):
                        found[i] = own
                    sizes += map(len, held)
                    runs += [[dict(zip(("start", "length", "period"), r)) for r in own] for own in found]
                    collapsed += map(collapse, held, found)
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(struct)),
                 pa.array(collapsed, pa.binary()).view(pa.string())], [*batch.schema.names, *names])

    schema = [f"`{c}` {t}" for c, t in docs.dtypes]
    return docs.mapInArrow(run, ", ".join([*schema, f"`{names[0]}` bigint", f"`{names[1]}` {RUNS}", f"`{names[2]}` string"]))
