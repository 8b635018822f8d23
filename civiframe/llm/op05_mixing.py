"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mixture is a number of equal blocks of words. Sources are cut into shards of bounded
size; every shard has its part of its source's target. Seats (blocks) go to the shards
with the highest quotients target / (2 * seats + 1), which is the same as rounding
target / divisor for the divisor at which the seats add up. Sources whose target is few
blocks would be rounded away, so blocks are smaller there: sources are apportioned in classes,
each with blocks of its own size, and each class gets what its targets add up to. Within a shard the documents
are laid end to end in a seeded order, cut into blocks, and its quota of blocks is drawn.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiframe.llm.tables import read
from civiframe.session import Staged

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mixture as a share of all words, and the most a source may give of its own.
SHARE = 1.5
CAP = 2.0
#: Words of a block, and the most that a block may be of its source's target.
BLOCKS = (64, 16, 4, 1)
BLOCK_SHARE = 1 / 64
SEED = 11
#: Words (and one for each document) of a shard; one task holds a shard's sizes or texts.
SHARD = 1 << 18
WORD = r"[^\x20\x09-\x0D]+"
#: Divisors tried in one pass over the shards.
TRIED = 64
_WORDS = re.compile(WORD)


def ranked_sources(sizes: DataFrame, work: Staged) -> DataFrame:
    """``(source, source_size, weight)``: sources by code point, null last. Ranks come from
    a range partitioning and the counts of its partitions, not from one sorted task."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") + 1).alias("bulk"))
    ordered = work.put(
        totals.repartitionByRange(F.asc_nulls_last("source"))
        .sortWithinPartitions(F.asc_nulls_last("source"))
        .withColumn("_id", F.monotonically_increasing_id()),
        "sources",
    )
    part = F.shiftright("_id", 33)
    counts = sorted(ordered.groupBy(part.alias("part")).count().collect())  # one row for each partition
    starts, n = {}, 0
    for p, k in counts:
        starts[p], n = n, n + k
    start = F.element_at(F.map_from_arrays(F.lit(list(starts)), F.lit(list(starts.values()))), part) if starts else F.lit(0)
    place = (start + F.col("_id").bitwiseAND((1 << 33) - 1)) % len(WEIGHTS)
    weight = F.element_at(F.lit(list(WEIGHTS)), (place + 1).cast("int"))
    return ordered.select("source", "source_size", "bulk", weight.cast("double").alias("weight"))


def with_targets(sources: DataFrame) -> DataFrame:
    """Adds ``target``: by weight, but no more than ``CAP`` times the source; the excess is
    shared again by weight among the others until none is above. One aggregate a round."""
    cap = F.col("source_size") * F.lit(CAP)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    wanted = float(total) * SHARE
    rate = None
    while True:
        above = F.lit(False) if rate is None else F.col("weight") * F.lit(rate) > cap
        row = sources.agg(
            F.sum(F.when(above, cap)).alias("fixed"),
            F.sum(F.when(~above, F.col("weight"))).alias("free"),
        ).first()
        if not row.free:
            break
        after = (wanted - (row.fixed or 0.0)) / row.free
        if rate is not None and after <= rate:
            break
        rate = after
    target = F.least(F.col("weight") * F.lit(rate or 0.0), cap) if row.free else cap
    return sources.withColumn("target", target)


def apportion(shards: DataFrame, seats: int, work: Staged) -> DataFrame:
    """Adds ``quota``: ``seats`` dealt over ``target`` by highest quotients.

    Each pass counts the seats at many divisors at once and keeps the two between which
    the wanted number lies. Shards that round up only below that gap share what is left,
    by quotient, then by the order of ``key``.
    """
    total = shards.agg(F.sum("target")).first()[0] or 0.0
    if seats <= 0 or total <= 0:
        return shards.withColumn("quota", F.lit(0).cast("long"))
    rounded = lambda d: F.floor(F.col("target") / F.lit(d) + 0.5)
    low, high = total / seats / 4, total / seats * 4 + 2 * total  # more, fewer seats than wanted
    short = seats
    for _ in range(40):
        tried = np.geomspace(low, high, TRIED + 2)[1:-1].tolist()
        counts = shards.agg(*[F.sum(rounded(d)).alias(f"d{k}") for k, d in enumerate(tried)]).first()
        for d, n in zip(tried, counts):
            if n >= seats:
                low = d
            else:
                high, short = d, seats - n
                break
        if high <= low * (1 + 1e-14):
            break
        exact = next((d for d, n in zip(tried, counts) if n == seats), None)
        if exact is not None:
            return shards.withColumn("quota", rounded(exact))
    base = shards.withColumn("quota", rounded(high)).withColumn("_next", rounded(low))
    # few: only shards whose quotients are equal to within the arithmetic
    tied = (
        base.where("_next > quota")
        .withColumn("_seat", F.explode(F.expr("sequence(quota, _next - 1)")))
        .orderBy(F.desc(F.expr("target / (2 * _seat + 1)")), "key", "_seat")
        .limit(int(short))
    )
    more = tied.groupBy("key").agg(F.count("*").alias("_more"))
    return base.join(more, "key", "left").withColumn("quota", F.expr("quota + coalesce(_more, 0L)")).drop("_next", "_more")


def apportion_classes(shards: DataFrame, work: Staged) -> DataFrame:
    """Adds ``quota`` to shards with ``key, target, block``: seats of each block size by themselves."""
    parts = []
    for block in BLOCKS:
        own = shards.where(F.col("block") == block)
        total = own.agg(F.sum("target")).first()[0]
        if total is not None:
            parts.append(apportion(own, round(total / block), work))
    if not parts:
        return shards.withColumn("quota", F.lit(0).cast("long"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def drawn_blocks(sizes: np.ndarray, quota: int, key: str, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block edges, how often each block is taken, and document ends of a shard laid end to end.

    Whole rounds over all blocks come first; the rest of the quota is drawn by a seed that
    depends on the shard's key alone.
    """
    ends = np.cumsum(sizes)
    words = int(ends[-1]) if len(ends) else 0
    blocks = -(-words // block)
    times = np.zeros(blocks, np.int64)
    if blocks:
        seed = hashlib.sha256(f"{SEED}:{key}".encode()).digest()[:8]
        rounds, rest = divmod(min(quota, int(CAP) * blocks), blocks)
        times += rounds
        times[np.random.default_rng(int.from_bytes(seed, "big")).permutation(blocks)[:rest]] += 1
    return np.minimum(np.arange(blocks + 1) * block, words), times, ends


def words_taken(edges: np.ndarray, times: np.ndarray, ends: np.ndarray, sizes: np.ndarray, block_size: int) -> np.ndarray:
    """Words that the drawn blocks take of each document."""
    if not len(times):
        return np.zeros(len(sizes), np.int64)
    before = np.concatenate([[0], np.cumsum(times * np.diff(edges))])

    def up_to(at: np.ndarray) -> np.ndarray:
        block = np.minimum(at // block_size, len(times) - 1)
        return before[block] + times[block] * (at - edges[block])

    return up_to(ends) - up_to(ends - sizes)


def _seeded(shard: pa.Table) -> pa.Table:
    return shard.sort_by([("_order", "ascending"), ("doc_id", "ascending"), ("_size", "ascending"), ("_content", "ascending")])


def _drawn(shard: pa.Table) -> tuple:
    sizes, block = shard["_size"].to_numpy(), shard["_block"][0].as_py()
    return sizes, block, *drawn_blocks(sizes, shard["_quota"][0].as_py(), shard["_key"][0].as_py(), block)


def draw_counts(shard: pa.Table) -> pa.Table:
    """``taken`` for the rows of a shard."""
    shard = _seeded(shard)
    sizes, block, edges, times, ends = _drawn(shard)
    return pa.table({
        "doc_id": shard["doc_id"], "source": shard["source"], "size": shard["_size"], "source_size": shard["_source_size"],
        "target": shard["_target"], "taken": pa.array(words_taken(edges, times, ends, sizes, block)),
    })


def draw_texts(shard: pa.Table) -> pa.Table:
    """The rows of a shard with the words that the mix takes of them: a row for what is taken
    at least once, and another for what is taken twice."""
    shard = _seeded(shard)
    sizes, size_of_block, edges, times, ends = _drawn(shard)
    docs = pa.Table.from_struct_array(shard["_row"])
    rows, texts = [], []
    for k, (text, size, end) in enumerate(zip(docs["text"].to_pylist(), sizes.tolist(), ends.tolist())):
        if not size:
            continue
        start = end - size
        first, last = start // size_of_block, (end - 1) // size_of_block
        own = times[first : last + 1]
        for copy in range(1, int(own.max()) + 1):
            rows.append(k)
            if (own >= copy).all():
                texts.append(text)
                continue
            words = [m.span() for m in _WORDS.finditer(text)]
            kept, previous = [], False
            for block, n in enumerate(own.tolist(), first):
                if n < copy:
                    previous = False
                    continue
                a, b = max(start, block * size_of_block) - start, min(end, (block + 1) * size_of_block) - start
                if previous:
                    kept[-1][1] = words[b - 1][1]
                else:
                    kept.append([words[a][0], words[b - 1][1]])
                previous = True
            texts.append("\n".join(text[a:b] for a, b in kept))
    out = docs.take(pa.array(rows, pa.int64()))
    return out.set_column(out.column_names.index("text"), "text", pa.array(texts, docs.schema.field("text").type))


def placed(docs: DataFrame, whole: bool, work: Staged) -> DataFrame:
    """``doc_id`` and ``source`` of ``docs``, if asked the whole ``_row``, and the size, target, shard and quota."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    row = [F.struct(*docs.columns).alias("_row")] if whole else []
    sized = docs.select(
        "doc_id", "source", *row, size.alias("_size"), F.xxhash64(F.lit(SEED), "doc_id").alias("_order"), F.xxhash64("text").alias("_content")
    )
    if not whole:
        sized = work.put(sized, "sizes")
    sources = with_targets(ranked_sources(sized.select("source", F.col("_size").alias("size")), work))
    sources = work.put(
        sources.select(
            F.col("source").alias("_source"),
            F.col("source_size").alias("_source_size"),
            F.col("target").alias("_target"),
            F.greatest(F.ceil(F.col("bulk") / SHARD), F.lit(1)).cast("long").alias("_parts"),
            F.coalesce(
                *[F.when(F.col("target") * BLOCK_SHARE >= b, b) for b in BLOCKS], F.lit(BLOCKS[-1])
            ).alias("_block"),
        ),
        "targets",
    )
    rows = sized.join(sources, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "_key", F.to_json(F.struct("source", F.expr("pmod(xxhash64(_order, _size, _content), _parts)").alias("shard")))
    )
    shards = rows.groupBy("_key").agg(
        (F.first("_target") * F.sum("_size") / F.greatest(F.first("_source_size"), F.lit(1))).alias("target"),
        F.first("_block").alias("block"),
    )
    shards = work.put(shards.withColumnRenamed("_key", "key"), "shards")
    quotas = work.put(apportion_classes(shards, work), "quotas")
    return rows.join(quotas.select(F.col("key").alias("_key"), F.col("quota").alias("_quota")), "_key")


def source_mixing(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` for every row of ``docs``.

    Null texts have size 0. A null source is a source and comes last; rows of one id, or without,
    are dealt and ordered by their texts, repeated rows are drawn one by one. A source's words come
    within a block of each of its shards of its target, 1/64 of it at most, or a word. Extra columns are not
    read. Empty tables give no rows. Reruns agree: order and draws depend on ids, sizes
    and the seed only.
    """
    work = Staged(docs.sparkSession)
    rows = placed(docs, False, work)
    schema = T.StructType([
        docs.schema["doc_id"], docs.schema["source"], T.StructField("size", T.LongType()), T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()), T.StructField("taken", T.LongType()),
    ])
    return rows.groupBy("_key").applyInArrow(draw_counts, schema)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents as the mix takes them, columns unchanged: the blocks drawn of a text in
    their order, and a second row for what is taken twice. Rows without words go."""
    work = Staged(docs.sparkSession)
    rows = placed(docs, True, work)
    return rows.groupBy("_key").applyInArrow(draw_texts, docs.schema)


def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return source_mixing(read(spark, folder, "documents"))
