"""Connected components of links that are never collected anywhere."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtime.plans.lineage import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id, component (smallest id reachable) for every id with a link to another one.

    Alternates large-star and small-star steps: each re-hangs neighbours under the smallest one, until every component
    is a star around its smallest id. A hub's links are reduced before the shuffle; the join that re-hangs them is split
    by adaptive execution. Links with a null end, links to itself and repeated links change nothing. Each round is a
    written table.
    """
    edges = materialize(links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                        .select(F.greatest(a, b).alias("big"), F.least(a, b).alias("small")).distinct(), "links")
    last = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("big", "small").cast("decimal(38,0)"))).first()
        if mark == last or not mark[0]:
            return edges.select(F.col("big").alias("id"), F.col("small").alias("component")).union(
                edges.select(F.col("small").alias("id"), F.col("small").alias("component")).distinct())
        last = mark
        both = edges.select(F.col("big").alias("u"), F.col("small").alias("v")).union(edges.select(F.col("small").alias("u"), F.col("big").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("big"), F.col("m").alias("small")).distinct()
        least = large.groupBy("big").agg(F.min("small").alias("m"))
        small = large.join(least, "big").where("small <> m").select(F.col("small").alias("big"), F.col("m").alias("small"))
        edges = materialize(small.union(least.select("big", F.col("m").alias("small"))).distinct(), "links")


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of n nodes over the links a-b."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while (deeper := label[label] != label).any():
            label[deeper] = label[label[deeper]]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label
