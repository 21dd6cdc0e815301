"""Connected components of a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfold.llm.common import store


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node that each of ``n`` nodes reaches by the links (a[i], b[i])."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        for side in (a, b):
            np.minimum.at(label, label[side], low)
            np.minimum.at(label, side, low)
        label = label[label]
        if (label == before).all():
            return label
    return label


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; root is the component's smallest node.

    Alternates two contractions of stars, each a pre-aggregated minimum and a join of two
    written tables, which adaptive execution splits where a node has very many links.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = store(links.where("a <> b").select(high, low).distinct(), "links")
    state = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = store(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        stars = store(both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                      .where("a <> b").distinct(), "stars")
        least = store(stars.groupBy("a").agg(F.min("b").alias("m")), "least")
        moved = stars.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = store(moved.union(least).distinct(), "links")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select("b", "b").distinct())
