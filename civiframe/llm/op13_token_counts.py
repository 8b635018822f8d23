"""Token counts from the frequencies of pre-tokens.

A byte-pair merge joins two neighbouring symbols only if a piece of the vocabulary holds
both, so a text falls apart, without changing its pieces, wherever no piece reaches across
two neighbouring characters. The parts are the pre-tokens. Their pieces are counted once
for each distinct pre-token of the corpus, and a document's count is the sum of its
pre-token frequencies times these numbers; ids are never made for a document.

The join of frequencies and piece counts is split: the most frequent pre-tokens, a list of
bounded size, are summed where the document is read; only the rest is shuffled.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from civiframe.llm.tables import read
from civiframe.session import Staged

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: Pre-tokens that every task holds, and their greatest length.
HEAD, HEAD_CHARS = 1 << 17, 64
#: Distinct pre-tokens that a task gathers before it passes their frequencies on.
GATHERED = 1 << 19
#: How the model writes a blank.
BLANK = "▁"


class PreTokens:
    """Cuts texts for a byte-pair model of sentencepiece, and counts the pieces of a cut."""

    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        words = [p.piece.replace(BLANK, " ") for p in model.pieces if p.type == kinds.NORMAL]
        joins = {(a, b) for word in words for a, b in zip(word, word[1:])}
        plain = model.normalizer_spec
        if (
            model.trainer_spec.model_type != sentencepiece_model_pb2.TrainerSpec.BPE
            or not model.trainer_spec.byte_fallback
            or any(p.type == kinds.USER_DEFINED for p in model.pieces)
            or plain.precompiled_charsmap
            or plain.remove_extra_whitespaces
            or not plain.add_dummy_prefix
            or any(b == " " != a or "\n" in (a, b) for a, b in joins)
        ):
            raise ValueError(f"{path}: only byte-pair models with byte fallback that take texts as they are and pieces that start with their blanks")
        joined = {c for pair in joins for c in pair} - {" "}
        opening = {c for c in joined if not c.isalnum()}
        while late := {b for a, b in joins if b in opening and a not in opening and a != " "}:
            opening -= late
        some = lambda chars: "[" + "".join(map(re.escape, sorted(chars))) + "]" if chars else "(?!)"
        rest = some(joined - opening)
        self.cut = re.compile(f" *(?:{some(opening)}+{rest}*|{rest}+)| +|[^ {some(joined)[1:-1] if joined else ''}]").findall
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.before = len(self.model.encode("\n", num_threads=1))

    def frequencies(self, text: str | None) -> Counter:
        """How often each pre-token occurs; the model puts a blank before a text."""
        return Counter(self.cut(" " + text.replace(BLANK, " "))) if text else Counter()

    def pieces(self, tokens: list[str]) -> list[int]:
        """Pieces of each pre-token. The line break keeps the blank of the model away from it."""
        return [len(ids) - self.before for ids in self.model.encode(["\n" + t for t in tokens], num_threads=1)]


@functools.cache
def pre_tokens(path: str) -> PreTokens:
    return PreTokens(path)


def vocabulary(docs: DataFrame, path: str) -> DataFrame:
    """``(token, n, pieces)`` of every distinct pre-token of all texts."""

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, seen = pre_tokens(path), Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(known.frequencies(text))
                if len(seen) >= GATHERED:
                    yield pd.DataFrame({"token": list(seen), "n": list(seen.values())})
                    seen.clear()
        yield pd.DataFrame({"token": pd.Series(list(seen), dtype=object), "n": pd.Series(list(seen.values()), dtype="int64")})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(pieces=pre_tokens(path).pieces(batch["token"].tolist()))

    totals = docs.select("text").mapInPandas(gather, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return totals.mapInPandas(count, "token string, n long, pieces long")


def frequent(words: DataFrame) -> dict[str, int]:
    """Piece counts of the most frequent pre-tokens, ``HEAD`` at most.

    They are chosen by a threshold from the counts of classes of frequencies, so that no more
    than these rows leave the executors.
    """
    short = words.where(F.length("token") <= HEAD_CHARS).withColumn("class", F.floor(16 * F.log2("n")))
    room, least = HEAD, None
    for row in short.groupBy("class").count().orderBy(F.desc("class")).collect():
        room -= row["count"]
        if room < 0:
            break
        least = row["class"]
    return {} if least is None else {r.token: r.pieces for r in short.where(F.col("class") >= least).select("token", "pieces").collect()}


def token_counts(docs: DataFrame, model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row for each row of ``docs``.

    The count is that of the whole text as the library encodes it without begin and end
    tokens. Null and empty texts have no bytes and no tokens. Ids are carried only, so null
    and repeated ones are kept as they are; rows are told apart by a number of their own.
    Extra columns are not read. An empty table gives an empty one. ``model``: file of a
    byte-pair model that takes texts as they are.
    """
    path = model or public_tokenizers.path(MODEL)
    spark, work = docs.sparkSession, Staged(docs.sparkSession)
    words = work.put(vocabulary(docs, path), "pre-tokens")
    head = spark.sparkContext.broadcast(frequent(words))

    @F.pandas_udf("n_head long, tokens array<string>, times array<long>")
    def split(texts: pd.Series) -> pd.DataFrame:
        known, numbers = pre_tokens(path), head.value
        sums, tokens, times = [], [], []
        for text in texts:
            found = known.frequencies(text)
            left = [t for t in found if t not in numbers]
            tokens.append(left)
            times.append([found.pop(t) for t in left])
            sums.append(sum(n * numbers[t] for t, n in found.items()))
        return pd.DataFrame({"n_head": sums, "tokens": tokens, "times": times})

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), n_bytes, split("text").alias("found"))
    parts = work.put(rows.select("row", "doc_id", "n_bytes", "found.*"), "frequencies")
    rare = parts.select("row", F.explode(F.arrays_zip("tokens", "times")).alias("t")).select("row", F.col("t.tokens").alias("token"), "t.times")
    tail = rare.join(words.select("token", "pieces"), "token").groupBy("row").agg(F.sum(F.col("times") * F.col("pieces")).alias("n_tail"))
    n_tokens = F.col("n_head") + F.coalesce("n_tail", F.lit(0))
    out = parts.drop("tokens", "times").join(tail, "row", "left").select(
        "doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit")
    )
    result = work.put(out, "token-counts")
    work.drop(parts, words)
    head.unpersist()
    return result


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(read(spark, folder, "documents"))
