"""Embedding near-duplicates by PCA-ordered tiled comparison.

Unit vectors are turned into their principal axes. Of a tile pair the products of the
leading dimensions are summed first; what the remaining ones can add is at most the
product of the suffix norms, and pairs that cannot reach the threshold that way stop.
The leading coordinate also orders the tiles: vectors within the threshold differ in it
by no more than the threshold's chord, so bands of that width meet only their neighbours.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiframe.llm.graph import Forest, components
from civiframe.llm.tables import read
from civiframe.session import Staged

THRESHOLD = 0.98
#: Distance of two unit vectors at the threshold.
CHORD = math.sqrt(2 - 2 * THRESHOLD) + 1e-9
TILE = 2048
#: Dimensions that are added between two looks at the bound.
STEP = 16
#: Rows of a tile that are compared with the other tile at once.
BLOCK = 64
SLACK = 1e-9
USABLE = (
    "(vec_id is not null and label is not null and embedding is not null"
    " and forall(embedding, x -> x is not null and not isnan(x) and abs(cast(x as double)) < double('Infinity'))"
    " and exists(embedding, x -> x <> 0))"
)


def usable(table: DataFrame) -> DataFrame:
    """Rows that can link: id, label and every component given, finite and not all zero."""
    return table.where(USABLE).select("vec_id", "label", F.expr("transform(embedding, x -> cast(x as double) + 0.0D)").alias("v"))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def principal_axes(distinct: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length the axes (columns) by falling spread. The driver gets one
    matrix for each length, summed from the products of all rows."""

    def products(batches):
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                u = unit(np.array(part.v.tolist()))
                yield pd.DataFrame({"dim": dim, "place": np.arange(dim * dim), "p": (u.T @ u).ravel()})

    sums = distinct.select("dim", "v").mapInPandas(products, "dim int, place int, p double").groupBy("dim", "place").agg(F.sum("p").alias("p"))
    axes = {}
    for dim, part in sums.toPandas().groupby("dim"):
        spread = part.sort_values("place").p.to_numpy().reshape(dim, dim)
        axes[int(dim)] = np.linalg.eigh(spread)[1][:, ::-1].copy()
    return axes


def compare_tiles(pair: pd.DataFrame, axes: dict[int, np.ndarray]) -> pd.DataFrame:
    """For each vector of two tiles (or one) the number of vectors it links with there, and
    links (node, other) that span the linked groups."""
    alone = bool((pair["side"] == 2).all())
    left = pair[pair["side"] != 1]
    right = left if alone else pair[pair["side"] == 1]
    counts = {name: np.zeros(len(part), np.int64) for name, part in (("l", left), ("r", right))}
    links: list[tuple[int, int]] = []
    if len(left) and len(right):
        vectors = [unit(np.array(part.v.tolist())) for part in (left, right)]
        turned = [u @ axes[u.shape[1]] for u in vectors]
        dim = vectors[0].shape[1]
        cuts = [*range(STEP, dim, STEP), dim]
        rest = [np.sqrt(np.maximum(0, np.cumsum((t * t)[:, ::-1], axis=1)[:, ::-1])) for t in turned]
        rest = [np.hstack([r, np.zeros((len(r), 1))]) for r in rest]
        nodes = np.concatenate([left.node.to_numpy(), right.node.to_numpy()])
        shift = 0 if alone else len(left)
        forest = Forest(len(left) + (0 if alone else len(right)))
        copies = [part.copies.to_numpy() for part in (left, right)]
        for at in range(0, len(left), BLOCK):
            rows = slice(at, at + BLOCK)
            partial = turned[0][rows, : cuts[0]] @ turned[1][:, : cuts[0]].T
            i, j = np.nonzero(partial + np.outer(rest[0][rows, cuts[0]], rest[1][:, cuts[0]]) >= THRESHOLD - SLACK)
            if alone:
                i, j = i[j > i + at], j[j > i + at]
            partial = partial[i, j]
            i = i + at
            for start, end in zip(cuts, cuts[1:]):
                partial = partial + np.einsum("nd,nd->n", turned[0][i, start:end], turned[1][j, start:end])
                alive = partial + rest[0][i, end] * rest[1][j, end] >= THRESHOLD - SLACK
                i, j, partial = i[alive], j[alive], partial[alive]
            exact = np.einsum("nd,nd->n", vectors[0][i], vectors[1][j]) >= THRESHOLD
            i, j = i[exact], j[exact]
            np.add.at(counts["l"], i, copies[1][j])
            np.add.at(counts["r"], j, copies[0][i])
            for row in np.unique(i).tolist():
                links += [(row, other) for other in forest.join(row, j[i == row] + shift).tolist()]
    if alone:
        counts = {"l": counts["l"] + counts["r"]}
    out = [pd.DataFrame({"node": part.node, "other": pd.NA, "n": counts[name]}) for name, part in (("l", left), ("r", right)) if name in counts]
    if links:
        a, b = np.array(links).T
        out.append(pd.DataFrame({"node": nodes[a], "other": nodes[b], "n": 0}))
    result = pd.concat(out, ignore_index=True)
    return result[(result.n > 0) | result.other.notna()].astype({"node": "int64", "other": "Int64", "n": "int64"})


def tile_pairs(distinct: DataFrame, axes: dict[int, np.ndarray]) -> DataFrame:
    """Every distinct vector in each tile pair it belongs to; side 2 marks a tile met by itself."""

    @F.pandas_udf("int")
    def band(vectors: pd.Series) -> pd.Series:
        out = [int(math.floor((unit(np.array([v])) @ axes[len(v)][:, :1])[0, 0] / CHORD)) for v in vectors]
        return pd.Series(out)

    rows = distinct.withColumn("band", band("v"))
    key = ["label", "dim", "band"]
    parts = rows.groupBy(*key).agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts"))
    after = parts.select("label", "dim", (F.col("band") - 1).alias("band"), F.col("parts").alias("parts_after"))
    before = parts.select("label", "dim", (F.col("band") + 1).alias("band"), F.col("parts").alias("parts_before"))
    shape = parts.join(after, key, "left").join(before, key, "left").na.fill(0)
    placed = rows.join(shape, key).withColumn("part", F.expr("cast(pmod(xxhash64(node), parts) as int)"))
    met = F.expr(
        "concat("
        "transform(sequence(0, parts - 1), o -> named_struct('lo', band, 't1', least(o, part), 'next', false, 't2', greatest(o, part),"
        " 'side', case when o = part then 2 when part < o then 0 else 1 end)),"
        "if(parts_after = 0, array(), transform(sequence(0, parts_after - 1), o -> named_struct('lo', band, 't1', part, 'next', true, 't2', o, 'side', 0))),"
        "if(parts_before = 0, array(), transform(sequence(0, parts_before - 1), o -> named_struct('lo', band - 1, 't1', o, 'next', true, 't2', part, 'side', 1))))"
    )
    return placed.select("label", "dim", "node", "copies", "v", F.explode(met).alias("m")).select(
        "label", "dim", "node", "copies", "v", "m.*"
    )


def embedding_near_dedup(table: DataFrame) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``table``.

    Vectors of one label and length link from a cosine of ``THRESHOLD``. Rows that cannot
    link (no id or label; a vector that is null, empty, zero or holds null or non-finite
    components) have 0 links and stay. Equal vectors of a label are compared once and count
    as often as they occur; different vectors with one id are one member of their groups.
    Extra columns are not read; an empty table gives an empty result.
    """
    work = Staged(table.sparkSession)
    table = table.select("vec_id", "embedding", "label")
    rows = usable(table)
    distinct = work.put(
        rows.groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")).withColumn("dim", F.size("v")),
        "distinct-vectors",
    )
    axes = principal_axes(distinct)
    found = work.put(
        tile_pairs(distinct, axes).groupBy("label", "dim", "lo", "t1", "next", "t2").applyInPandas(
            lambda pair: compare_tiles(pair, axes), "node long, other long, n long"
        ),
        "vector-links",
    )
    roots = components(found.where("other is not null").selectExpr("node as a", "other as b"), work)
    counted = found.groupBy("node").agg(F.sum("n").alias("n"))
    nodes = (
        distinct.join(counted, "node", "left")
        .join(roots, "node", "left")
        .select("label", "v", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    )
    linked = rows.join(nodes, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = table.where(f"not coalesce({USABLE}, false)")
    result = linked.unionAll(alone.select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op7_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_near_dedup(read(spark, folder, "embeddings"))


SQL = f"""
with recursive t as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs as (
  select a.vec_id as a, b.vec_id as b from t a join t b
  on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  and list_cosine_similarity(a.v, b.v) >= {THRESHOLD}
), reach as (
  select vec_id as node, vec_id as other from embeddings
  union select reach.node, pairs.b from reach join pairs on pairs.a = reach.other
), least as (
  select node, min(other) as component_id from reach group by node
), n as (
  select a, count(*) as n_links from pairs group by a
)
select e.vec_id, coalesce(n.n_links, 0)::bigint as n_links, least.component_id, e.vec_id = least.component_id as kept
from embeddings e join least on least.node = e.vec_id left join n on n.a = e.vec_id
"""
