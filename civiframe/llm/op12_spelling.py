"""Groups of spelling variants by asymmetric q-chunks.

Of two words within one edit, the shorter (or the first of two equally long ones) gives two
disjoint chunks, its halves; one edit leaves one of them as it is, and the other word holds
it as a gram whose place differs by the difference of lengths, none or one. So only grams
within shift one of a chunk's place are formed, pairs meet by an equi-join on chunk and
length, and an edit distance decides. Where too many words share a chunk, the rest of the
word, which holds the edit, is cut into two chunks again, until groups are small: at last
all but one character are part of the key, and a group has no more words than the alphabet
allows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiframe.llm.tables import read
from civiframe.session import Staged

#: Words are runs of A-Z, a-z and U+00C0 to U+00FF of at least this length, seen at least this often.
LEAST_CHARS, LEAST_COUNT = 5, 3
#: One in so many runs of a document loses a character.
SLIPS = 97
#: A form is at least so many times as frequent as its variant.
FORM_TIMES = 2
#: A group whose pairs are more than this for each of its words is cut further.
PAIRS_PER_WORD = 64
#: Distinct words that a task gathers before it passes their counts on.
GATHERED = 1 << 19
#: In Latin-1, a character outside of words becomes a blank.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters in Latin-1, a byte for each character."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split() if text else []


def with_slips(found: Counter, doc_id: str) -> Counter:
    """The runs of a document after the seeded loss of characters."""
    start = zlib.crc32(f"{doc_id}:".encode())
    for run in list(found):
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % SLIPS == 0:
            at = h % len(run)
            found[run[:at] + run[at + 1 :] + b"*"] += found.pop(run)  # marked, as it may be another run of the document
    return found


def words(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of all words of the whole texts, slips included."""

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def counted() -> pd.DataFrame:
            kept = [(w.decode("latin-1"), n) for w, n in seen.items() if len(w) >= LEAST_CHARS]
            seen.clear()
            return pd.DataFrame({"word": pd.Series([w for w, _ in kept], dtype=object), "n": pd.Series([n for _, n in kept], dtype="int64")})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                for run, n in with_slips(Counter(runs(text)), doc_id).items():
                    seen[run.rstrip(b"*")] += n
            if len(seen) >= GATHERED:
                yield counted()
        yield counted()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    counted = rows.mapInPandas(gather, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def openings(table: DataFrame) -> DataFrame:
    """Every word once as giver of chunks and twice as giver of grams, for words as long and one shorter.

    ``key``: what is known to be equal; ``lo``, ``size``: the part of the word (from 0) that
    may hold the edit; ``rest``: the size of that part in the giver of chunks.
    """
    length = F.length("word")
    roles = F.array(
        *(F.struct(F.lit(gram).alias("gram"), (length - shorter).alias("rest")) for gram, shorter in ((False, 0), (True, 0), (True, 1)))
    )
    rows = table.select("word", "n", F.explode(roles).alias("r")).select("word", "n", "r.*")
    return rows.where(F.col("rest") >= LEAST_CHARS).select(
        "word", "n", "gram", F.xxhash64("rest").alias("key"), F.lit(0).alias("lo"), "rest", F.length("word").alias("size")
    )


def cut(rows: DataFrame) -> DataFrame:
    """Two rows for each: one keeps the first chunk of the open part, one the second."""
    head = F.expr("rest div 2")
    tail = F.expr("rest - rest div 2")

    def kept(which: int, start, chars, lo, rest, size):
        key = F.xxhash64("key", F.lit(which), "rest", F.substring("word", start + 1, chars))
        return F.struct(*(c.cast(t).alias(n) for c, t, n in ((key, "long", "key"), (lo, "int", "lo"), (rest, "int", "rest"), (size, "int", "size"))))

    lo, size = F.col("lo"), F.col("size")
    first = kept(1, lo, head, lo + head, tail, size - head)
    second = kept(2, lo + size - tail, tail, lo, head, size - tail)
    return rows.select("word", "n", "gram", F.explode(F.array(first, second)).alias("c")).select("word", "n", "gram", "c.*")


def near_pairs(table: DataFrame, work: Staged) -> DataFrame:
    """``(a, a_n, b, b_n)``, staged: the pairs of words at edit distance one, each once."""
    rows, found, before = openings(table), [], []
    while True:
        rows = cut(rows)
        counts = rows.groupBy("key").agg(
            F.count_if(~F.col("gram")).alias("chunks"), F.count_if("gram").alias("grams"),
            F.min(F.xxhash64("word")).alias("least"), F.max(F.xxhash64("word")).alias("most"),
        )
        # A word meets itself in every key, once in each role.
        met = counts.where("chunks > 0 and grams > 0 and least <> most").select(
            "key", F.expr(f"chunks * grams > {PAIRS_PER_WORD} * (chunks + grams)").alias("many")
        )
        level = work.put(rows.join(met, "key").withColumn("further", F.col("many") & (F.col("rest") > 1)), "chunks")
        if before:
            work.drop(*before)
        before = [level]
        small = level.where(~F.col("further")).select("key", "word", "n", "gram")
        a = small.where(~F.col("gram")).select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
        b = small.where(F.col("gram")).select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
        met_once = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
        pairs = a.join(b, "key").where(met_once & (F.levenshtein("a", "b", 1) == 1)).drop("key")
        found.append(work.put(pairs, "pairs"))
        rows = level.where("further").drop("many", "further")
        if rows.isEmpty():
            work.drop(level)
            break
    every = found[0]
    for other in found[1:]:
        every = every.unionAll(other)
    return every.distinct()


def last_forms(links: DataFrame, work: Staged) -> DataFrame:
    """``(word, root)`` for rows ``(word, form)``: each round doubles the steps followed.

    Forms are more frequent than their variants, so there are no circles.
    """
    now = work.put(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        beyond = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = work.put(now.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        work.drop(now)
        now = after
        if now.where("moved").isEmpty():
            return now.drop("moved")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row for each word.

    A null id counts as an empty one in the seed of the slips, so rows of equal id and text
    slip alike and count each. Null and empty texts have no words; neither has an empty
    table. Words are whole runs of any length. Equally frequent forms: the first in code-point
    order. Extra columns are not read.
    """
    work = Staged(docs.sparkSession)
    table = work.put(words(docs), "words")
    pairs = near_pairs(table, work)
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("m"), F.col("b").alias("w")).alias("other")),
                             F.struct(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("m"), F.col("a").alias("w")).alias("other"))))
    near = pairs.select(both.alias("p")).select("p.*").groupBy("word").agg(F.count("*").alias("n_near"), F.min("other").alias("first"))
    frequent = F.expr(f"-first.m >= {FORM_TIMES} * n")
    known = work.put(
        table.join(near, "word", "left").select(
            "word", F.when(frequent, F.col("first.w")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, -F.col("first.m")).alias("form_n"),
        ),
        "forms",
    )
    roots = last_forms(known.where("form is not null"), work)
    out = known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    result = work.put(out, "variants")
    work.drop(*(frame for frame, _ in list(work.paths.values()) if frame is not result))
    return result


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(read(spark, folder, "documents"))
