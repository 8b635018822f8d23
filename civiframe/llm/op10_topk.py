"""Exact top-k inner products by MaxScore.

The dimensions are the query terms. Within a block of rows, a term's bound is the largest
contribution that any row can get from it. Terms in falling order of their bounds are
split: the longest tail whose bounds sum up to less than the k-th best score so far is
non-essential. Only rows in a posting of an essential term (a positive contribution) are
scored there; the other terms are probed while a row can still compete. Every shard of
rows returns its k best for each query, and the shards are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civiframe.llm.tables import read

K = 10
SCALE = 1024
#: Rows of a shard and queries of a block: what one task holds at a time.
SHARD_ROWS = 8192
BLOCK_QUERIES = 8192
#: Rows for which bounds and essential terms are chosen anew.
BLOCK_ROWS = 2048
#: Non-essential terms probed between two looks at the bound.
PROBE = 8


def quantised(table: DataFrame) -> DataFrame:
    """``(vec_id, v)``: floor(1024 * x) of each component; without unusable vectors."""
    return (
        table.where(
            "vec_id is not null and embedding is not null"
            " and forall(embedding, x -> x is not null and not isnan(x) and abs(cast(x as double)) < double('Infinity'))"
        )
        .select("vec_id", F.expr(f"transform(embedding, x -> cast(floor({SCALE} * cast(x as double)) as bigint))").alias("v"))
        .withColumn("dim", F.size("v"))
    )


class Best:
    """The k best (score, vec_id) of one query so far."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.vec = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def threshold(self) -> int | None:
        return int(self.score[-1]) if len(self.score) == self.k else None

    def add(self, score: np.ndarray, vec: np.ndarray) -> None:
        score, vec = np.concatenate([self.score, score]), np.concatenate([self.vec, vec])
        first = np.lexsort((vec, -score))[: self.k]
        self.score, self.vec = score[first], vec[first]


def search_block(x: np.ndarray, ids: np.ndarray, high: np.ndarray, low: np.ndarray, own: int, q: np.ndarray, best: Best) -> None:
    """Add what a block of rows has for the query; ``high`` and ``low`` bound its columns."""
    bounds = np.maximum(q * high, q * low)
    terms = np.argsort(-bounds, kind="stable")
    tail = np.append(np.cumsum(bounds[terms][::-1])[::-1], 0)  # tail[k]: most that terms k and later can give
    least = best.threshold
    rows = np.nonzero(ids != own)[0]
    if least is None:
        best.add(x[rows] @ q, ids[rows])
        return
    below = np.nonzero(tail < least)[0]
    split = int(below[0]) if len(below) else len(terms)
    if split == 0:
        return
    given = x[:, terms[:split]] * q[terms[:split]]
    rows = rows[(given[rows] > 0).any(axis=1)]
    score = given.sum(axis=1)[rows]
    while True:
        compete = score + tail[split] >= least
        rows, score = rows[compete], score[compete]
        if split == len(terms) or not len(rows):
            break
        probed = terms[split : split + PROBE]
        score = score + x[np.ix_(rows, probed)] @ q[probed]
        split += len(probed)
    if len(rows):
        best.add(score, ids[rows])


def search_shard(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    out = []
    if len(rows) and len(queries):
        x, ids = np.array(rows.v.tolist(), np.int64), rows.vec_id.to_numpy(np.int64)
        blocks = [slice(a, a + BLOCK_ROWS) for a in range(0, len(ids), BLOCK_ROWS)]
        ranges = [(x[b].max(axis=0), x[b].min(axis=0)) for b in blocks] if x.shape[1] else [(x[b].sum(axis=0),) * 2 for b in blocks]
        for own, v in zip(queries.vec_id.tolist(), queries.v.tolist()):
            best = Best(K)
            q = np.array(v, np.int64)
            for b, (high, low) in zip(blocks, ranges):
                search_block(x[b], ids[b], high, low, own, q, best)
            out.append(pd.DataFrame({"query_id": own, "vec_id": best.vec, "score": best.score}))
    empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    return pd.concat([empty, *out], ignore_index=True)


def top_k(table: DataFrame, queries: DataFrame) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``K`` highest inner products of each query.

    Null ids, null vectors and vectors with null or non-finite components take no part; a
    vector meets only vectors of its own length, and never one with its own id. Equal scores
    go to the smaller id. A repeated query counts once; a repeated candidate as often as it
    occurs. Fewer than ``K`` candidates give fewer rows; empty tables give none.

    Rows go to shards by a hash of id and vector. Queries are sent to every shard, in
    blocks; with many blocks each shard is sent once for every block.
    """
    rows, asked = quantised(table), quantised(queries).dropDuplicates(["vec_id", "v"])
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = rows.withColumn("shard", F.expr(f"cast(pmod(xxhash64(vec_id, v), {shards}) as int)")).withColumn("block", every(blocks))
    sent = asked.withColumn("block", F.expr(f"cast(pmod(xxhash64(vec_id), {blocks}) as int)")).withColumn("shard", every(shards))
    key = ["dim", "shard", "block"]
    found = dealt.groupBy(*key).cogroup(sent.groupBy(*key)).applyInPandas(
        search_shard, "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= K)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op10_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    table = read(spark, folder, "embeddings").select("vec_id", "embedding")
    return top_k(table, table.where("vec_id % 100 = 0"))


SQL = f"""
with t as (
  select vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
  from t q join t c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id and len(c.v) = len(q.v)
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as n from s
)
select query_id, n::integer as rank, vec_id, score from r where n <= {K}
"""
