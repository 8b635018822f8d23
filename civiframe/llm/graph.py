"""Connected components of an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiframe.session import Staged


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("child", "parent")).alias("x"),
        F.bit_xor(F.xxhash64("parent", "child")).alias("y"),
    ).first()
    return tuple(row)


def components(edges: DataFrame, work: Staged) -> DataFrame:
    """``(node, root)`` of every node that has an edge ``(a, b)``; root: the smallest node.

    Alternates large-star and small-star steps until the edges are stars, so a long chain
    takes a logarithmic number of rounds. Each round is written to the shared folder and
    the one before it is removed. Null ends and loops are no edges; an empty table gives an empty one.
    """
    stars = work.put(
        edges.where("a <> b").select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")).distinct(),
        "edges",
    )
    seen = _fingerprint(stars)
    while seen[0]:
        both = stars.selectExpr("child as u", "parent as v").unionAll(stars.selectExpr("parent as u", "child as v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").selectExpr("v as child", "m as parent").distinct()
        large = work.put(large, "large-star")
        low = large.groupBy("child").agg(F.min("parent").alias("m"))
        small = (
            large.join(low, "child")
            .select(F.explode(F.array(F.struct("child", F.col("m").alias("parent")),
                                      F.struct(F.col("parent").alias("child"), F.col("m").alias("parent")))).alias("e"))
            .where("e.child <> e.parent")
            .select("e.*")
            .distinct()
        )
        after = work.put(small, "small-star")
        now = _fingerprint(after)
        work.drop(large, stars)
        stars = after
        if now == seen:
            break
        seen = now
    roots = stars.select(F.col("parent").alias("node")).distinct()
    return stars.selectExpr("child as node", "parent as root").unionAll(roots.selectExpr("node", "node as root"))


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index that each of ``n`` items reaches by the links (i, j)."""
    label = np.arange(n)
    while len(i):
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
        if (label == before).all() and not open_.any():
            break
    return label


class Forest:
    """Trees over ``n`` items that grow row by row."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, row: int, others: np.ndarray) -> np.ndarray:
        """Links the row with the others; returns one of them for each tree that is new to it."""
        trees, first = np.unique(self.label[others], return_index=True)
        new = trees != self.label[row]
        if not new.any():
            return others[:0]
        self.label[np.isin(self.label, trees)] = self.label[row]
        return others[first[new]]
