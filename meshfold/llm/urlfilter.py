"""URL filters: path rules, and exact membership by a cascade of Bloom filters.

The first level holds the listed keys; the second the keys of the universe that pass the
first without being listed; the third the listed keys that pass the second; and so on until
none passes wrongly. A key of the universe is listed exactly if the first level that rejects
it is an even one, or if there is none and the number of levels is odd.

Keys are dealt to shards by a hash, so that the filters of one shard stay below a bound however long the
list is. The bits of a level are put together in tasks, one file per shard in the shared work folder. Rows
are tested in the order of their shards, and a task holds the filters of one shard at a time; the driver
holds names of files only. Rows of a frequent key are spread over many tasks.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfold.llm import files
from meshfold.llm.common import LOWER, UPPER, store, unused
from meshfold.session import new_folder

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null and without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule ``host/path`` that fits a host or a subdomain of it, and its verdict; else null."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):  # the last that fits stands
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(rules[rule])).otherwise(verdict)
    return name, verdict


SALTS = 32  # tasks that rows of one shard are spread over


@dataclass(frozen=True)
class Level:
    size: int                                             # bits of each shard's filter
    hashes: int
    places: dict[int, str] = field(default_factory=dict)  # shard to file; none: no key, so all are rejected

    def bits(self, shard: int) -> np.ndarray:
        """One octet per eight bits, the lowest first."""
        if shard not in self.places:
            return np.zeros(self.size // 8, np.uint8)
        return np.frombuffer(files.read_all(self.places[shard]), np.uint8)


def _places(key: Column, level: int, size: int, hashes: int) -> Column:
    return F.array(*(F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(size)) for i in range(hashes)))


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(shards)).cast("int")


def _level(members: DataFrame, number: int, n: int, share: float, shards: int, folder: str) -> Level:
    """Filters that hold the keys ``members(key)``, at most ``n`` a shard, and pass about ``share`` of all others."""
    hashes = max(1, round(-math.log2(share)))
    size = max(64, -(-math.ceil(n * -math.log2(share) / math.log(2)) // 64) * 64)
    place = members.select(_shard(F.col("key"), shards).alias("shard"),
                           F.explode(_places(F.col("key"), number, size, hashes)).alias("at"))
    words = place.groupBy("shard", F.floor(F.col("at") / 64).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(at % 64))")).alias("bits"))

    def write(part: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros(size // 64, "<i8")
        table[part["word"].to_numpy()] = part["bits"].to_numpy()
        name = f"{folder}/{number}-{part['shard'].iat[0]}-{uuid.uuid4().hex}"
        with files.writer(name) as out:
            out.write(table.tobytes())
        return pd.DataFrame({"shard": part["shard"].iloc[:1], "file": [name]})

    # A task that is run again writes another file; the stored table names the one that counts.
    written = store(words.groupBy("shard").applyInPandas(write, "shard int, file string"), "bloom-files")
    return Level(size, hashes, {r.shard: r.file for r in written.collect()})


def _passes(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def _with_test(keys: DataFrame, key: Column, levels: list[Level], first: int, name: str, listed: bool,
               shards: int) -> DataFrame:
    """``keys`` with one more boolean: passed all the levels, or with ``listed`` the cascade's answer."""
    shard, salt, at = unused(keys, "shard", "salt", "places")
    rows = keys.withColumn(shard, _shard(key, shards))
    if shards > 1:  # one after another in each task
        rows = rows.withColumn(salt, F.spark_partition_id() % SALTS).repartition(shard, salt).sortWithinPartitions(
            shard).drop(salt)
    rows = rows.withColumn(at, F.concat(*(_places(key, first + i, x.size, x.hashes) for i, x in enumerate(levels))))
    width = sum(x.hashes for x in levels)

    def run(batches):
        held, filters = None, []
        for batch in batches:
            of = batch.column(batch.num_columns - 2).to_numpy()
            places = batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(-1, width)
            rejected = np.zeros(len(batch), np.int64)
            for number in np.unique(of):
                if number != held:
                    filters = []  # the former shard's go before the next ones come
                    held, filters = number, [x.bits(int(number)) for x in levels]
                mine, start = np.flatnonzero(of == number), 0
                for i, (level, bits) in enumerate(zip(levels, filters), 1):
                    passed = _passes(bits, places[mine, start:start + level.hashes])
                    rejected[mine[~passed & (rejected[mine] == 0)]] = i
                    start += level.hashes
            if listed:
                answer = np.where(rejected > 0, rejected % 2 == 0, len(levels) % 2 == 1)
            else:
                answer = rejected == 0
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(answer)], [*batch.schema.names[:-2], name])

    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in keys.dtypes), f"`{name}` boolean"]))


def cascade(universe: DataFrame, max_bytes: int = 16 << 20) -> tuple[list[Level], int]:
    """The levels for the distinct keys ``universe(key, listed)``, and the number of shards: as many as
    keep the filters of one near ``max_bytes`` (64 octets at least)."""
    counts = {r.listed: r.n for r in universe.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    members, others = counts.get(True, 0), counts.get(False, 0)
    if not members:
        return [], 1
    share = min(0.5, max(members * math.sqrt(0.5) / max(others, 1), 1e-9))
    shards = math.ceil(members * (-math.log2(share) + 3) / math.log(2) / 8 / max(max_bytes, 64))
    folder = new_folder(universe.sparkSession, "bloom")
    inside, outside = universe.where("listed").select("key"), universe.where("not listed").select("key")
    levels: list[Level] = []
    while True:
        most = inside.groupBy(_shard(F.col("key"), shards).alias("shard")).count().agg(F.max("count")).first()[0]
        if not most:
            return levels, shards
        levels.append(_level(inside, len(levels), most, 0.5 if levels else share, shards, folder))
        passed = store(_with_test(outside, F.col("key"), levels[-1:], len(levels) - 1, "passed", False, shards)
                       .where("passed").select("key"), "passed")
        inside, outside = passed, inside


def is_listed(rows: DataFrame, key: str, listed: DataFrame, name: str = "listed", max_bytes: int = 16 << 20) -> DataFrame:
    """``rows`` with a boolean: its ``key`` is among ``listed(key)``. The rows are the universe the
    cascade is built for, so the answer is exact. ``max_bytes`` bounds the filters of a shard, which one
    task holds; longer lists take more shards. A null key is never listed; an empty list lists nothing;
    repeated rows are all kept, repeated keys of the list count once."""
    keys = rows.select(F.col(key).alias("key")).where("key is not null").distinct()
    listed = listed.select("key").where("key is not null").distinct().withColumn("listed", F.lit(True))
    universe = store(keys.join(listed, "key", "left").select("key", F.coalesce("listed", F.lit(False)).alias("listed")),
                     "url-keys")
    levels, shards = cascade(universe, max_bytes)
    if not levels:
        return rows.withColumn(name, F.lit(False))
    tested = _with_test(rows, F.coalesce(F.col(key), F.lit("")), levels, 0, name, True, shards)
    return tested.withColumn(name, F.col(name) & F.col(key).isNotNull())
