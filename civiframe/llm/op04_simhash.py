"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are laid out in tiles and every tile pair is compared with numpy's
exclusive-or and bit counts; tile pairs whose population counts differ beyond the radius
are skipped. Two fingerprints within three bits agree in one of their four quarters, so a
tile holds the fingerprints of one quarter value. A quarter with more fingerprints than a
tile is cut by population count, and only tile pairs within the radius are formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiframe.llm.graph import Forest, components, local_roots
from civiframe.llm.tables import fresh, read
from civiframe.session import Staged

SEED = 42
SHINGLE = 3
RADIUS = 3
QUARTERS = RADIUS + 1
#: Fingerprints of one tile; two tiles and a block of their differences fit in memory.
TILE = 4096
#: Fingerprints that one task call compares at most, without hot tiles.
CELL = 20_000
#: Shingle hashes whose bits are counted at once.
CHUNK = 1 << 16
#: Groups up to this size are compared by shifting the sorted cell against itself.
SMALL = 48


def shingle_hashes(text: str) -> list[int]:
    """XXH64 of every run of three words (repeats included) of the text with A-Z lowered."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return [digest(joined, SEED)]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: 1 - SHINGLE].tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist())]


def fingerprints(texts: list[str | None]) -> np.ndarray:
    """64-bit fingerprints: a bit is 1 if it is set in over half of the hashes; 0 without words."""
    ones = np.zeros((len(texts), 64), np.int64)
    totals = np.zeros(len(texts), np.int64)
    waiting: list[np.ndarray] = []
    owners: list[int] = []
    held = 0

    def count() -> None:
        nonlocal held
        bits = np.unpackbits(np.concatenate(waiting).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.cumsum([0, *map(len, waiting)])[:-1]
        np.add.at(ones, owners, np.add.reduceat(bits, starts, axis=0, dtype=np.int32))
        waiting.clear()
        owners.clear()
        held = 0

    for k, text in enumerate(texts):
        if not text:
            continue
        hashes = np.array(shingle_hashes(text), np.uint64)
        totals[k] = len(hashes)
        for at in range(0, len(hashes), CHUNK):
            waiting.append(hashes[at : at + CHUNK])
            owners.append(k)
            held += len(waiting[-1])
            if held >= CHUNK:
                count()
    if waiting:
        count()
    return np.packbits(2 * ones > totals[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


@F.pandas_udf(T.LongType())
def simhash(texts: pd.Series) -> pd.Series:
    return pd.Series(fingerprints(texts.tolist()).view(np.int64))


def _links(prints: np.ndarray, pops: np.ndarray, bounds: np.ndarray, tiles: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions within the radius; groups lie between ``bounds``, sorted by population count."""
    sizes = np.diff(bounds)
    ends = np.repeat(bounds[1:], sizes)
    small = np.nonzero(np.repeat(sizes, sizes) <= SMALL)[0]
    shift = 1
    while len(small):
        small = small[small + shift < ends[small]]
        near = np.bitwise_count(prints[small] ^ prints[small + shift]) <= RADIUS
        yield small[near], small[near] + shift
        shift += 1
    for start, end in zip(bounds[:-1][sizes > SMALL].tolist(), bounds[1:][sizes > SMALL].tolist()):
        yield from _tile_links(prints, pops, start, end, tiles)


def _tile_links(prints: np.ndarray, pops: np.ndarray, start: int, end: int, tiles: np.ndarray):
    """Pairs that join different trees of one group; links inside a tree already built are left out."""
    group = np.arange(start, end)
    left = group[tiles[group] == tiles[group].min()]
    right = group[tiles[group] == tiles[group].max()]
    forest = Forest(end - start)
    for at in range(0, len(left), 256):
        rows = left[at : at + 256]
        lo = np.searchsorted(pops[right], pops[rows[0]] - RADIUS)
        hi = np.searchsorted(pops[right], pops[rows[-1]] + RADIUS, side="right")
        near = np.bitwise_count(prints[rows, None] ^ prints[None, right[lo:hi]]) <= RADIUS
        for row, hits in zip(rows.tolist(), near):
            others = right[lo:hi][hits]
            new = forest.join(row - start, others - start) + start
            if len(new):
                yield np.full(len(new), row), new


def compare_cell(cell: pd.DataFrame) -> pd.DataFrame:
    """Spanning links (a, b) of all tile pairs dealt to this cell."""
    prints = cell.fp.to_numpy().view(np.uint64)
    pops = np.bitwise_count(prints).astype(np.int16)
    order = np.lexsort((pops, cell.tile.to_numpy(), cell.t2.to_numpy(), cell.t1.to_numpy(), cell.bucket.to_numpy()))
    key = cell[["bucket", "t1", "t2"]].to_numpy()[order]
    prints, pops, tiles = prints[order], pops[order], cell.tile.to_numpy()[order]
    bounds = np.concatenate([[0], np.nonzero((key[1:] != key[:-1]).any(axis=1))[0] + 1, [len(key)]])
    found = [x for x in _links(prints, pops, bounds, tiles) if len(x[0])]
    if not found:
        return pd.DataFrame({"a": pd.Series([], dtype="int64"), "b": pd.Series([], dtype="int64")})
    # positions of equal fingerprints (one for each quarter) are one item
    distinct, item = np.unique(prints, return_inverse=True)
    i, j = item[np.concatenate([x[0] for x in found])], item[np.concatenate([x[1] for x in found])]
    root = local_roots(len(distinct), i, j)
    child = np.nonzero(root != np.arange(len(distinct)))[0]
    return pd.DataFrame({"a": distinct[child].view(np.int64), "b": distinct[root[child]].view(np.int64)})


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that connect all fingerprints ``fp`` of a table of distinct ones within the radius.

    Every bucket's counts by population count give the place of a fingerprint in the
    bucket's order, to within its count; a bucket beyond a tile is cut there. A fingerprint
    goes to every pair of its tile with a tile that the radius reaches.
    """
    n = distinct.count()
    quarter = F.explode(F.array(*[F.lit(k) for k in range(QUARTERS)]))
    rows = distinct.select("fp", quarter.alias("q")).selectExpr(
        "fp", "bit_count(fp) as pop", "cast(q * 65536 + (shiftrightunsigned(fp, q * 16) & 65535) as int) as bucket"
    )
    counts = rows.groupBy("bucket", "pop").agg(F.count("*").alias("n"))
    full = (
        counts.groupBy("bucket")
        .agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("pop", "n"))).alias("by_pop"))
        .where(F.col("total") > TILE)
        .selectExpr(
            "bucket",
            # before[p]: fingerprints of the bucket with a population count below p, 0 <= p <= 65
            "transform(sequence(0, 65), p -> aggregate(map_entries(by_pop), 0L, (s, e) -> s + if(e.key < p, e.value, 0L))) as before",
        )
    )
    rank = f"(before[pop] + cast((xxhash64(fp) & 1048575) / 1048576.0D * (before[pop + 1] - before[pop]) as bigint)) div {TILE}"
    placed = rows.join(full, "bucket", "left").selectExpr(
        "fp", "bucket",
        f"coalesce(cast({rank} as int), 0) as tile",
        f"coalesce(cast(before[greatest(pop - {RADIUS}, 0)] div {TILE} as int), 0) as lo",
        f"coalesce(cast((before[least(pop + {RADIUS} + 1, 65)] - 1) div {TILE} as int), 0) as hi",
    )
    pairs = placed.selectExpr("fp", "bucket", "tile", "explode(sequence(lo, greatest(lo, hi))) as other").selectExpr(
        "fp", "bucket", "tile", "least(tile, other) as t1", "greatest(tile, other) as t2"
    )
    cells = max(1, QUARTERS * n // CELL)
    dealt = pairs.withColumn("cell", F.expr(f"pmod(xxhash64(bucket, t1, t2), {cells})"))
    return dealt.groupBy("cell").applyInPandas(
        lambda cell: compare_cell(cell), "a long, b long"
    )


def simhash_groups(docs: DataFrame, work: Staged, *extra: Column) -> DataFrame:
    """``(doc_id, fp, component_id, root)`` and ``extra`` for every row: the smallest id of the group and
    its smallest fingerprint; staged tables belong to ``work``."""
    prints = work.put(docs.select("doc_id", simhash("text").alias("fp"), *extra), "fingerprints")
    distinct = work.put(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    links = work.put(fingerprint_links(distinct), "fingerprint-links")
    roots = components(links, work)
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(least, "root").select("fp", "component_id", "root")
    return prints.join(named, "fp").select(*prints.columns, "component_id", "root")


def simhash_near_dedup(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    Null, empty and blank texts have the fingerprint zero and are linked like any other.
    Rows without id belong to their group, whose id is the smallest id that is not null
    (null if none has one). Repeated rows and ids are kept; extra columns are not read.
    """
    work = Staged(docs.sparkSession)
    return simhash_groups(docs, work).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_group(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group, columns unchanged: of its smallest id (null last) the
    text with the smallest hash.

    A row goes by its id and text, so other texts with that id, or without one, stay or go with
    their own group. Of rows equal in both, one stays.
    """
    work = Staged(docs.sparkSession)
    doc, content, several = fresh("doc"), fresh("content"), fresh("several")
    groups = simhash_groups(docs, work, F.xxhash64("text").alias(content))
    rows = groups.groupBy("root", F.col("doc_id").alias(doc), content).agg(F.count("*").alias("n"))
    rows = work.put(rows, "group-rows")
    order = F.struct(F.col(doc).isNull().alias("no_id"), F.col(doc).alias("id"), F.col(content).alias("content"), F.col("n").alias("n"))
    best = rows.groupBy("root").agg(F.min(order).alias("best")).select("best.*")
    # few columns cross: ids and texts that stay, and how many rows have them
    kept = work.put(best.select(F.col("id").alias(doc), F.col("content").alias(content), (F.col("n") > 1).alias(several)), "kept-rows")
    same = docs["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(content))
    single = docs.join(kept.where(~F.col(several)), same, "left_semi")
    repeated = kept.where(several)
    if repeated.isEmpty():
        return single
    copies = docs.join(repeated, same).drop(several)
    return single.unionByName(copies.dropDuplicates([doc, content]).drop(doc, content))


def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_near_dedup(read(spark, folder, "documents"))
