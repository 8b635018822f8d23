"""Ranked lexical search over classes of equal bags.

Items come in blocks of bounded text. For a block every document is restricted to the
terms of its items; what counts of a document is then its bag (the frequencies of these
terms) and m, the measure of its length. Documents are hashed on both, equal ones under a
hash are one class, and a class is scored once for all items. Members of equal score follow
each other by their id, so the ``K`` smallest ids of a class are all that can be ranked.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civiframe.llm.tables import read
from civiframe.session import Staged

K = 10
#: Items of a block, and bytes of their texts (one longer item is a block by itself).
ITEMS, ITEM_BYTES = 256, 1 << 17
#: Classes whose scores are compared at a time.
CLASSES = 1024
#: Weight of a term: floor(1000 * ln((2 N + 2) / (2 df + 1))); length: 25 + 75 n N div L.
SCALE, LENGTH_SHARE = 1000, 75
#: Contribution of a term to a score, before its weight: (GAIN * tf) div (1000 * tf + 8 * m).
GAIN, SATURATION = 10**9, 8
#: Terms are runs of these bytes of the UTF-8 text; only A-Z are lower-cased.
_SMALL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(_SMALL).split() if text else []


class Block:
    """Some items: their terms, and how often each item holds each of them."""

    def __init__(self, rows: list):
        self.ids = [r.item_id for r in rows]
        counts = [Counter(terms(r.text)) for r in rows]
        self.terms = {t: k for k, t in enumerate(sorted(set().union(*counts)))}
        self.times = np.zeros((len(self.terms), len(rows)), np.int64)
        for item, found in enumerate(counts):
            for t, n in found.items():
                self.times[self.terms[t], item] = n

    def weighted(self, docs: int, frequency: np.ndarray) -> np.ndarray:
        """What a term adds to the score of each item for one unit of its contribution."""
        weight = np.array([math.floor(SCALE * math.log((2 * docs + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)
        exact = self.times * weight[:, None]
        most = int(exact.sum(axis=0).max(initial=0)) * (GAIN // SCALE)
        # Sums of whole numbers below 2^53 are exact in doubles, in any order.
        return exact.astype(np.float64) if most < 2**53 else exact


def restricted(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, term, tf)``: length of each document, and its bag of known terms."""

    @F.pandas_udf("n long, term array<int>, tf array<int>")
    def bag(texts: pd.Series) -> pd.DataFrame:
        vocabulary = shared.value
        lengths, term, tf = [], [], []
        for text in texts:
            words = terms(text)
            found = sorted((vocabulary[t], n) for t, n in Counter(words).items() if t in vocabulary)
            lengths.append(len(words))
            term.append([t for t, _ in found])
            tf.append([n for _, n in found])
        return pd.DataFrame({"n": lengths, "term": term, "tf": tf})

    shared = docs.sparkSession.sparkContext.broadcast(known)
    return docs.select(F.col("doc_id").cast("long"), bag("text").alias("bag")).select("doc_id", "bag.*")


def classes(bags: DataFrame, docs: int, total: int) -> DataFrame:
    """``(m, term, tf, first, members)``: every distinct bag and m, with its ``K`` smallest ids.

    Rows of a class are thinned to ``K`` in each task before they meet, so a class that holds
    a third of all documents stays small; the hash decides where rows meet, the bag itself
    whether they are equal.
    """
    m = F.expr(f"{100 - LENGTH_SHARE}L + ({LENGTH_SHARE}L * n * {docs}L) div {max(total, 1)}L")
    hashed = bags.where(F.size("term") > 0).select("doc_id", m.alias("m"), "term", "tf").withColumn("h", F.xxhash64("m", "term", "tf"))
    key = ["h", "m", "term", "tf"]
    order = Window.partitionBy(*key).orderBy(F.col("doc_id").asc_nulls_last())
    few = hashed.withColumn("k", F.row_number().over(order)).where(F.col("k") <= K)
    return few.groupBy(*key).agg(F.coalesce(F.min("doc_id"), F.lit(2**63 - 1)).alias("first"), F.collect_list(F.struct("doc_id")).alias("members")).drop("h")


class Best:
    """The ``K`` best classes of every item so far."""

    def __init__(self, items: int):
        self.least = np.zeros(items, np.int64)  # K-th best score
        self.item = self.score = self.first = self.row = np.zeros(0, np.int64)
        self.members: dict[int, list] = {}

    def add(self, scores: np.ndarray, first: np.ndarray, members: list, start: int) -> None:
        """``scores``: a row for each class, a column for each item."""
        row, item = np.nonzero((scores >= self.least) & (scores > 0))
        item, score = np.append(self.item, item), np.append(self.score, scores[row, item])
        low, number = np.append(self.first, first[row]), np.append(self.row, start + row)
        order = np.lexsort((low, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[place < K]
        full = place == K - 1
        self.least[item[full]] = score[order][full]
        self.item, self.score, self.first, self.row = item[place < K], score[kept], low[kept], number[kept]
        self.members |= {start + r: members[r] for r in np.unique(row).tolist()}
        self.members = {r: self.members[r] for r in np.unique(self.row).tolist()}


def scored(found: DataFrame, block: Block, weights: np.ndarray) -> DataFrame:
    """``(item, score, members)``: what each task has to offer for the best of each item."""
    shared = found.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight = shared.value
        best, start = Best(weight.shape[1]), 0
        for batch in batches:
            for a in range(0, len(batch), CLASSES):
                part = batch.iloc[a : a + CLASSES]
                table = np.zeros((len(part), weight.shape[1]), np.int64)
                for row, (m, term, tf) in enumerate(zip(part["m"].tolist(), part["term"], part["tf"])):
                    tf = np.asarray(tf, np.int64)
                    gain = (GAIN * tf) // (SCALE * tf + SATURATION * m)
                    table[row] = gain.astype(weight.dtype) @ weight[np.asarray(term)]
                best.add(table, part["first"].to_numpy(np.int64), part["members"].tolist(), start)
                start += len(part)
        members = [[x["doc_id"] for x in best.members[r]] for r in best.row.tolist()]
        yield pd.DataFrame({"item": best.item, "score": best.score, "members": pd.Series(members, dtype=object)})

    return found.mapInPandas(score, "item long, score long, members array<long>")


def search_block(bags: DataFrame, block: Block) -> DataFrame:
    """``(item_id, rank, doc_id, score)`` of the items of a block."""
    spark = bags.sparkSession
    docs, total = bags.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = np.zeros(len(block.terms), np.int64)
    for term, n in bags.select(F.explode("term").alias("term")).groupBy("term").count().collect():
        frequency[term] = n
    offers = scored(classes(bags, docs, total), block, block.weighted(docs, frequency))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = (
        offers.select("item", "score", F.explode("members").alias("doc_id"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= K)
    )
    ids = spark.createDataFrame(list(enumerate(block.ids)), "item long, item_id long")
    return ranked.join(ids, "item").select("item_id", "rank", "doc_id", "score")


def blocks(items: DataFrame) -> list[DataFrame]:
    """Items dealt by a hash to blocks of about ``ITEMS`` rows and ``ITEM_BYTES`` bytes at most twice over."""
    asked = items.select(F.col("item_id").cast("long"), "text").where("text is not null").distinct()
    rows, size = asked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    count = max(1, -(-rows // ITEMS), -(-size // ITEM_BYTES))
    while True:
        place = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
        sizes = asked.groupBy(place.alias("b")).agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("s"))
        if not sizes.where(f"n > {2 * ITEMS} or (n > 1 and s > {2 * ITEM_BYTES})").count():
            return [asked.where(place == b) for b in range(count)]
        count *= 2


def lexical_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``K`` best documents of each item.

    Null texts have no terms; documents without terms do not count in N. A repeated item
    row counts once; two texts under one item id are ranked each by itself. Documents are
    rows: a repeated id may be ranked as often as it occurs, a null id comes after all
    others of its score. An item that no document shares a term with has no rows, nor has
    an empty table on either side. Extra columns are not read.

    Every block of items reads the documents once; one block is what a few hundred items take.
    """
    work = Staged(docs.sparkSession)
    found = []
    for part in blocks(items):
        block = Block(part.collect())
        bags = work.put(restricted(docs, block.terms), "bags")
        found.append(work.put(search_block(bags, block), "best"))
        work.drop(bags)
    out = found[0]
    for other in found[1:]:
        out = out.unionAll(other)
    return out


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""
SQL = f"""
with words as (select rowid as r, doc_id, {_TERMS} as term from (select row_number() over () as rowid, doc_id, text from documents)),
lengths as (select r, doc_id, count(*)::bigint as n from words group by r, doc_id),
totals as (select count(*)::bigint as docs, sum(n)::bigint as total from lengths),
asked as (
  select i, item_id, term, count(*)::bigint as q
  from (select i, item_id, {_TERMS} as term from (select row_number() over () as i, item_id, text from (select distinct item_id, text from benchmark)))
  group by i, item_id, term
),
postings as (select r, term, count(*)::bigint as tf from words where term in (select term from asked) group by r, term),
weights as (
  select term, floor({SCALE} * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w
  from postings, totals group by term, docs
),
scores as (
  select i, item_id, doc_id, r, sum(q * w * (({GAIN} * tf) // ({SCALE} * tf + {SATURATION} * ({100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * docs) // total))))::bigint as score
  from asked join postings using (term) join weights using (term) join lengths using (r), totals
  group by i, item_id, doc_id, r
),
ranked as (
  select *, row_number() over (partition by i order by score desc, doc_id nulls last) as k from scores where score > 0
)
select item_id, k::integer as rank, doc_id, score from ranked where k <= {K}
"""
