"""Repeated substrings by external induced suffix sorting.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts elsewhere. Where such
a string has its smallest hash of ``GRAM`` bytes (its anchor) depends on its content alone,
so both places of a repeat have the same anchor and the same distance to it. That deals
the text to shards: around every anchor whose bytes occur again, the strings are taken in
ranges of distances; the bytes that all strings of a range share are its core, the bytes
that any of them covers its context. Contexts with one core meet in one shard, equal ones
once with their number. There the induced sort yields suffixes and common prefixes, and
neighbours that share ``LENGTH`` bytes are the repeats.

A core with very many different contexts is dealt again in narrower ranges, down to
single strings, so a shard stays bounded however hot a passage is. Nothing of the text is
shuffled but the contexts that are left to sort.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiframe.llm.induced import suffix_array
from civiframe.llm.tables import read
from civiframe.session import Staged

LENGTH = 400
GRAM = 32
#: Strings that have an anchor at all their distances: 0 .. REACH - 1.
REACH = LENGTH - GRAM + 1
#: Distances of a range, level by level; a core beyond ``HOT`` contexts (3 MB to sort) goes to the next.
WIDTHS = (93, 24, 6, 1)
HOT = 16_384
#: Bytes of text that are hashed at once, and that a shard holds on average.
CHUNK = 1 << 19
SHARD_BYTES = 2 << 20
#: Memory of a shard's queues; entries beyond it wait on disk.
QUEUE_BYTES = 64 << 20
#: Bits of the filters that tell tasks which hashes to go on with; their size is fixed.
FILTER_BITS = 1 << 25
_BASE = 0x9E3779B97F4A7C15 | 1
_MARGIN = 2 * LENGTH
#: Bytes that stand for a core in what is sorted.
TOKEN = 10
_SEVENS = np.arange(0, 7 * TOKEN, 7, dtype=np.uint64)


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D) ^ (x >> np.uint64(33))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, from the least up to and from block edges."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(onward[: n - width + 1], upto[width - 1 : n])


@dataclass
class Chunk:
    """Parts of documents laid end to end, with the anchors found in them."""

    data: np.ndarray
    sums: np.ndarray
    anchors: np.ndarray
    grams: np.ndarray
    row: np.ndarray  # of each anchor: its document's row in the batch
    base: np.ndarray  # of each anchor: place of its document's byte 0 in the chunk (may lie before it)
    size: np.ndarray  # of each anchor: bytes of its document

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * _powers(_reserve())[1][start] + (end - start).astype(np.uint64))


def _reserve() -> int:
    return CHUNK * 2 + 8 * LENGTH


def chunks(texts: pa.Array) -> Iterator[Chunk]:
    """The texts of a batch in chunks. A text longer than a chunk comes in overlapping parts;
    an anchor belongs to the part that it starts in."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_binary())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    valid = np.ones(len(texts), bool) if not texts.null_count else np.array(texts.is_valid())
    waiting: list[tuple[int, int, int, int, int, int]] = []
    held = 0
    for row in np.nonzero(valid & (np.diff(offsets) >= LENGTH))[0].tolist():
        begin, size = int(offsets[row]), int(offsets[row + 1] - offsets[row])
        for at in range(0, size, CHUNK):
            low, high = max(0, at - _MARGIN), min(size, at + CHUNK + _MARGIN)
            if held and held + high - low > CHUNK:
                yield _chunk(data, waiting)
                waiting, held = [], 0
            waiting.append((row, begin, size, low, high, at))
            held += high - low
    if waiting:
        yield _chunk(data, waiting)


def _chunk(data: np.ndarray, parts: list[tuple[int, int, int, int, int, int]]) -> Chunk:
    row, begin, size, low, high, at = (np.array(x, np.int64) for x in zip(*parts))
    joined = np.concatenate([data[b + lo : b + hi] for b, lo, hi in zip(begin.tolist(), low.tolist(), high.tolist())])
    powers, inverse = _powers(_reserve())
    n = len(joined)
    sums = np.zeros(n + 1, np.uint64)
    np.multiply(joined, powers[:n], out=sums[1:])
    sums[1:] += powers[:n]  # a byte counts one more, so that zeros count
    np.cumsum(sums[1:], out=sums[1:])
    ends = np.cumsum(high - low)
    starts = ends - (high - low)
    hashes = sums[GRAM:] - sums[:-GRAM]
    hashes *= inverse[: n - GRAM + 1]
    bits = np.uint64(max(1, (n - 1).bit_length()))
    keyed = hashes ^ (hashes >> np.uint64(29))  # in place, as most of a pass is spent here
    keyed *= np.uint64(0x7FB5D329728EA185)
    keyed >>= bits
    keyed <<= bits
    keyed |= np.arange(n - GRAM + 1, dtype=np.uint64)
    least = sliding_least(keyed, REACH)
    window = np.zeros(n + 1, np.int32)  # windows that lie within a part
    full = ends - starts >= LENGTH
    np.add.at(window, starts[full], 1)
    np.add.at(window, ends[full] - LENGTH + 1, -1)
    inside = np.cumsum(window[: len(least)]) > 0
    found = (least[inside] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    anchors = found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found
    part = np.searchsorted(ends, anchors, side="right")
    base = starts[part] - low[part]
    own = (anchors - base >= at[part]) & (anchors - base < at[part] + CHUNK)
    anchors, part = anchors[own], part[own]
    return Chunk(joined, sums, anchors, _mixed(hashes[anchors]), row[part], base[own], size[part])


class Filter:
    """A set of hashes as bits: may hold more than was put in, never less."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        bit = hashes & np.uint64(FILTER_BITS - 1)
        return (self.bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def hash_filter(hashes: DataFrame) -> Filter:
    """Of a column ``x``; the driver gets at most ``FILTER_BITS`` / 64 numbers."""
    bit = f"(x & {FILTER_BITS - 1}L)"
    words = hashes.groupBy(F.expr(f"cast({bit} div 64 as int)").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({bit} % 64 as int))")).alias("bits")
    ).toPandas()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[words.word.to_numpy(np.int64)] = words.bits.to_numpy(np.int64).view(np.uint64)
    return Filter(out)


def ranges(chunk: Chunk, keep: np.ndarray, level: int, filters: list[Filter]) -> dict[str, np.ndarray]:
    """All ranges of a level around the kept anchors whose cores on the levels before pass."""
    index = np.nonzero(keep)[0]
    low, high = np.zeros(len(index), np.int64), np.full(len(index), REACH - 1, np.int64)
    for depth in range(level + 1):
        width = WIDTHS[depth]
        each = -(-(high - low + 1) // width)
        index = np.repeat(index, each)
        step = np.arange(len(index)) - np.repeat(np.cumsum(each) - each, each)
        low_, high_ = np.repeat(low, each) + step * width, np.repeat(high, each)
        low, high = low_, np.minimum(low_ + width - 1, high_)
        place = chunk.anchors[index] - chunk.base[index]
        nearest, farthest = np.maximum(low, place + LENGTH - chunk.size[index]), np.minimum(high, place)
        exists = nearest <= farthest
        index, low, high, nearest, farthest = (x[exists] for x in (index, low, high, nearest, farthest))
        anchor = chunk.anchors[index]
        # with the distances, so that no place meets itself by way of another anchor
        core = _mixed(chunk.hash(anchor - low, anchor - high + LENGTH) + (low * REACH + high).astype(np.uint64))
        if depth < level:
            go = filters[depth].has(core)
            index, low, high = index[go], low[go], high[go]
    start, end = anchor - farthest, anchor - nearest + LENGTH
    return {
        "index": index, "core": core, "context": chunk.hash(start, end), "start": start, "end": end,
        "core_start": anchor - low, "core_end": anchor - high + LENGTH,
    }


def gram_hashes(docs: DataFrame) -> DataFrame:
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("body")):
                yield pa.RecordBatch.from_arrays([pa.array(chunk.grams.view(np.int64))], ["x"])

    return docs.select("body").mapInArrow(hashes, T.StructType([T.StructField("x", T.LongType())]))


_RANGE = "doc_id long, content long, start long, strings int, core long, context long"


def range_rows(docs: DataFrame, grams, level: int, hot: list) -> DataFrame:
    """``doc_id, content, start, strings, core, context`` of every range of a level."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("body")):
                found = ranges(chunk, grams.value.has(chunk.grams), level, [f.value for f in hot])
                at = pa.array(chunk.row[found["index"]])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(at), batch.column("content").take(at),
                        pa.array(found["start"] - chunk.base[found["index"]]),
                        pa.array((found["end"] - found["start"] - LENGTH + 1).astype(np.int32)),
                        pa.array(found["core"].view(np.int64)), pa.array(found["context"].view(np.int64)),
                    ],
                    ["doc_id", "content", "start", "strings", "core", "context"],
                )

    return docs.mapInArrow(rows, _RANGE)


def context_texts(docs: DataFrame, grams, levels: int, hot: list, wanted) -> DataFrame:
    """``core, context, ref, start, need, body`` of the contexts in the filter ``wanted``.

    All contexts of a core share its bytes, so ``body`` has the core's number in their place
    (in seven bits a byte), and a string of ``LENGTH`` bytes has ``need`` bytes there.
    """

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            refs = batch.column("ref").to_numpy()
            for chunk in chunks(batch.column("body")):
                keep = grams.value.has(chunk.grams)
                for level in range(levels):
                    found = ranges(chunk, keep, level, [f.value for f in hot])
                    some = wanted.value.has(found["context"])
                    core, context = found["core"][some].view(np.int64), found["context"][some].view(np.int64)
                    index, start, end, core_start, core_end = (
                        found[k][some] for k in ("index", "start", "end", "core_start", "core_end")
                    )
                    rows = []
                    for k, key in enumerate(zip(core.tolist(), context.tolist())):
                        if key not in seen:
                            if len(seen) >= 1 << 18:
                                seen.clear()
                            seen.add(key)
                            rows.append(k)
                    rows = np.array(rows, np.int64)
                    tokens = (core[rows].view(np.uint64)[:, None] >> _SEVENS & np.uint64(127)).astype(np.uint8)
                    places = zip(*(x[rows].tolist() for x in (start, core_start, core_end, end)))
                    bodies = [
                        chunk.data[a:b].tobytes() + token.tobytes() + chunk.data[c:d].tobytes()
                        for (a, b, c, d), token in zip(places, tokens)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(core[rows]), pa.array(context[rows]), pa.array(refs[chunk.row[index[rows]]]),
                            pa.array((start - chunk.base[index])[rows]),
                            pa.array((LENGTH - (core_end - core_start) + TOKEN)[rows].astype(np.int32)),
                            pa.array(bodies, pa.binary()),
                        ],
                        ["core", "context", "ref", "start", "need", "body"],
                    )

    return docs.mapInArrow(texts, "core long, context long, ref long, start long, need int, body binary")


def sort_shard(shard: pd.DataFrame) -> pd.DataFrame:
    """``core, context, first, last``: runs of strings of each context that start elsewhere too.
    All rows have one ``need``."""
    need = int(shard.need.iloc[0])
    sizes = shard.body.map(len).to_numpy(np.int64)
    text = np.frombuffer(b"".join(b + b"\xff" for b in shard.body), np.uint8) + np.uint8(1)  # 0 ends a context
    place, share = suffix_array(text, need, QUEUE_BYTES)
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    # suffixes in order fall into groups that share such a string; ends of contexts cut them off
    group = np.cumsum(share < need)
    counts = np.bincount(group)
    several = counts[group] > 1
    place, group = place[several].astype(np.int64), group[several]
    owner = np.searchsorted(ends, place, side="right")
    offset = place - begins[owner]
    fits = (offset >= 0) & (offset + need <= sizes[owner])  # the 0 before a context is none of it
    owner, offset, group = owner[fits], offset[fits], group[fits]
    # one place may stand in several contexts; it repeats if another place shares its bytes
    refs = np.unique(shard.ref.to_numpy(), return_inverse=True)[1].astype(np.int64)
    where = (refs[owner] << 40) + shard.start.to_numpy(np.int64)[owner] + offset
    repeated = np.zeros(len(group), bool)
    if len(group):
        edges = np.nonzero(np.concatenate([[True], group[1:] != group[:-1]]))[0]
        differs = np.minimum.reduceat(where, edges) != np.maximum.reduceat(where, edges)
        repeated = np.repeat(differs, np.diff(np.append(edges, len(group))))
    flat = np.unique(owner[repeated] * (LENGTH * 4) + offset[repeated])
    new = np.concatenate([[True], flat[1:] != flat[:-1] + 1]) if len(flat) else np.zeros(0, bool)
    first, last = flat[new], flat[np.append(new[1:], True)] if len(flat) else flat
    owner = first // (LENGTH * 4)
    return pd.DataFrame({
        "core": shard.core.to_numpy()[owner], "context": shard.context.to_numpy()[owner],
        "first": (first % (LENGTH * 4)).astype(np.int32), "last": (last % (LENGTH * 4)).astype(np.int32),
    })


def repeated_ranges(docs: DataFrame, work: Staged) -> DataFrame:
    """``doc_id, content, low, high``: byte ranges of ``docs`` (doc_id, content, ref, body) that go."""
    share = docs.sparkSession.sparkContext.broadcast
    again = gram_hashes(docs).groupBy("x").count().where("count > 1").select("x")
    grams = share(hash_filter(again))
    hot: list = []
    rows: list[DataFrame] = []
    whole: list[DataFrame] = []
    tosort: list[DataFrame] = []
    for level in range(len(WIDTHS)):
        found = work.put(range_rows(docs, grams, level, hot), f"ranges-{level}")
        kinds = work.put(
            found.groupBy("core", "context").agg(F.count("*").alias("n"), F.max("strings").alias("strings")), f"contexts-{level}"
        )
        cores = kinds.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1")
        rows.append(found)
        whole.append(kinds.where("n > 1").select("core", "context", F.lit(0).alias("first"), (F.col("strings") - 1).alias("last")))
        last = level == len(WIDTHS) - 1
        cold = cores if last else cores.where(F.col("kinds") <= HOT)
        tosort.append(kinds.join(cold, "core", "left_semi").select("core", "context"))
        crowded = None if last else work.put(cores.where(F.col("kinds") > HOT).select(F.col("core").alias("x")), f"hot-{level}")
        if last or crowded.isEmpty():
            break
        hot.append(share(hash_filter(crowded)))
    tosort_all = work.put(functools.reduce(DataFrame.unionAll, tosort), "to-sort")
    n = tosort_all.count()
    found_runs = functools.reduce(DataFrame.unionAll, whole)
    if n:
        wanted = share(hash_filter(tosort_all.select(F.col("context").alias("x"))))
        bodies = (
            context_texts(docs, grams, len(rows), hot, wanted)
            .join(tosort_all, ["core", "context"], "left_semi")
            .dropDuplicates(["core", "context"])
        )
        shards = max(1, n * (2 * WIDTHS[0] + TOKEN) // SHARD_BYTES)
        sorted_runs = (
            bodies.withColumn("shard", F.expr(f"pmod(xxhash64(core), {shards})"))
            .groupBy("need", "shard")
            .applyInPandas(sort_shard, "core long, context long, first int, last int")
        )
        found_runs = found_runs.unionAll(work.put(sorted_runs, "sorted-runs"))
    ranges_ = functools.reduce(DataFrame.unionAll, rows)
    return ranges_.join(found_runs, ["core", "context"]).select(
        "doc_id", "content", (F.col("start") + F.col("first")).alias("low"), (F.col("start") + F.col("last") + LENGTH).alias("high")
    )


def merged(ranges_: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for low, high in sorted(ranges_):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


_KEPT = T.StructType([
    T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
    T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType()),
])


def _cut(keep_bytes: bool):
    @F.pandas_udf(_KEPT)
    def cut(bodies: pd.Series, lows: pd.Series, highs: pd.Series) -> pd.DataFrame:
        out = []
        for body, low, high in zip(bodies, lows, highs):
            body = b"" if body is None else bytes(body)
            spans = merged(list(zip(low.tolist(), high.tolist()))) if low is not None else []
            edges = [0, *(x for s in spans for x in s), len(body)]
            kept = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2])) if spans else body
            out.append((len(body), len(body) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
        return pd.DataFrame(out, columns=[f.name for f in _KEPT])

    return cut


def suffix_dedup(docs: DataFrame, keep_bytes: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for every row of ``docs``.

    ``kept`` is the bytes that stay (null without ``keep_bytes``; bytes, as a repeat may
    start within a character). Null texts are empty. Rows repeated in full repeat each other.
    Null ids are documents as well; extra columns are not read. Hashes of 64 bits stand for
    cores and contexts of up to ``LENGTH`` + 92 bytes.
    """
    work = Staged(docs.sparkSession)
    docs = docs.select("doc_id", F.xxhash64("text").alias("content"), F.col("text").cast("binary").alias("body")).withColumn(
        "ref", F.xxhash64("doc_id", "content")
    )
    # copies of a row have the same ranges; they are listed once
    low_high = work.put(repeated_ranges(docs, work).distinct(), "repeated-ranges")
    spans = low_high.groupBy(F.col("doc_id").alias("_doc"), F.col("content").alias("_content")).agg(
        F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs")
    )
    joined = docs.join(spans, docs["doc_id"].eqNullSafe(F.col("_doc")) & (F.col("content") == F.col("_content")), "left")
    return joined.select("doc_id", _cut(keep_bytes)("body", "lows", "highs").alias("c")).select("doc_id", "c.*")


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Digests per document, and what stays of its ``text`` (a character cut in two reads as a sign for that)."""
    out = suffix_dedup(read(spark, folder, "documents"))
    return out.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")
