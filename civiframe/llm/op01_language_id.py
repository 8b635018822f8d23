"""Language identification by cross-parsing entropy.

A suffix automaton of sample text per language recognises every substring of the sample.
Reading a text greedily, each phrase is the longest match found in the sample; a text in
the language of the sample needs few phrases. With ``c`` phrases over ``n`` characters
and a sample of ``m`` characters the cross entropy is ``c * log2(m) / n``; the language
with the smallest one wins.

The automaton becomes a complete table (a missing transition restarts at the root and
counts a phrase), so numpy steps through thousands of segments at once.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from civiframe.llm.tables import fresh, read, remainder

#: Bounds of the training sample: rows for each language, and characters kept of them.
SAMPLE_ROWS = 48
SAMPLE_CHARS = 24_000
#: Characters that one step of the parse handles separately; a cut costs one phrase.
SEGMENT = 384
#: Segments parsed at once.
LANES = 8192
UNKNOWN = "und"
PREDICTION = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return moves


@functools.cache
def letter_codes() -> np.ndarray:
    """1 for every code point that is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def normalised(text: str) -> np.ndarray:
    """Lower-cased code points; each run of other characters is one 0."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(letter_codes()[points], points, 0)
    if len(points):
        keep = points != 0
        keep[1:] |= points[:-1] != 0
        points = points[keep]
    return points


class CrossParser:
    """Tables of all languages; ``samples`` maps a language to its sample text."""

    def __init__(self, samples: dict[str, str]):
        texts = {lang: normalised(text)[:SAMPLE_CHARS] for lang, text in sorted(samples.items())}
        self.langs = list(texts)
        seen = np.unique(np.concatenate([*texts.values(), np.zeros(1, np.uint32)]))
        self.seen = seen  # code 0 is "no letter"; letters that no sample has share the last code
        self.width = 1 << max(1, int(len(seen)).bit_length())
        self.other = len(seen)
        self.tables = []
        self.bits = []
        for points in texts.values():
            moves = suffix_automaton(np.searchsorted(seen, points).tolist())
            start = np.full(self.width, 1, np.int64)  # an unknown first character is a phrase by itself
            for c, to in moves[0].items():
                start[c] = to * self.width * 2 + 1
            table = np.tile(start, (len(moves), 1))
            for state, out in enumerate(moves):
                for c, to in out.items():
                    table[state, c] = to * self.width * 2
            table[0] = start
            self.tables.append(table.astype(np.int32).ravel())
            self.bits.append(math.log2(max(2, len(points))))
        wide = np.full(0x110000, self.other, np.uint16)
        wide[seen] = np.arange(len(seen))
        self.codes = wide

    def phrases(self, lanes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases per (segment, language); ``lanes`` is (step, segment), longest segment first."""
        out = np.zeros((len(lengths), len(self.tables)), np.int32)
        active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lanes.shape[0]), side="right")
        for k, table in enumerate(self.tables):
            state = np.zeros(len(lengths), np.int32)
            count = out[:, k]
            for step, n in enumerate(active.tolist()):
                now = table.take(state[:n] + lanes[step, :n])
                count[:n] += now & 1
                state[:n] = now >> 1
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        owners, parts, sizes = [], [], np.zeros(len(texts), np.int64)
        totals = np.zeros((len(texts), max(1, len(self.tables))))
        waiting = 0

        def parse() -> None:
            nonlocal waiting
            lengths = np.array([len(p) for p in parts])
            order = np.argsort(-lengths, kind="stable")
            lanes = np.zeros((int(lengths.max()), len(parts)), np.int32)
            for column, k in enumerate(order.tolist()):
                lanes[: lengths[k], column] = parts[k]
            np.add.at(totals, np.array(owners)[order], self.phrases(lanes, lengths[order]))
            owners.clear()
            parts.clear()
            waiting = 0

        for k, text in enumerate(texts):
            points = normalised(text) if text else np.zeros(0, np.uint32)
            if not points.any() or not self.tables:
                continue
            sizes[k] = len(points)
            codes = self.codes[points].astype(np.int32)
            for at in range(0, len(codes), SEGMENT):
                owners.append(k)
                parts.append(codes[at : at + SEGMENT])
                waiting += 1
                if waiting == LANES:
                    parse()
        if waiting:
            parse()
        if not self.tables:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        entropy = totals * np.array(self.bits) / np.maximum(sizes, 1)[:, None]
        best = entropy.argmin(axis=1)
        weight = np.exp2(-(entropy - entropy.min(axis=1, keepdims=True)) * np.minimum(np.maximum(sizes, 1), 256)[:, None] / 8)
        score = np.where(sizes > 0, 1 / weight.sum(axis=1), 0.0)
        return [self.langs[b] if n else UNKNOWN for b, n in zip(best, sizes)], score


@functools.lru_cache(maxsize=2)
def _parser(key: str, samples: tuple[tuple[str, str], ...]) -> CrossParser:
    return CrossParser(dict(samples))


def training_sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> dict[str, str]:
    """At most ``rows`` texts for each language, drawn by a hash of the id from the labelled
    rows whose crc32 remainder modulo 5 is not 0; at most ``SAMPLE_CHARS`` characters of them
    are learned. The rank is cut in every task before the shuffle and only ids are ranked."""
    labelled = docs.where(F.col("lang").isNotNull() & (remainder("doc_id", 5) != 0))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = labelled.select("doc_id", "lang").withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= rows)
    ids = sorted({r.doc_id for r in chosen.select("doc_id").collect()})
    samples: dict[str, list[str]] = {}
    texts = labelled.where(F.col("doc_id").isin(ids) & F.col("text").isNotNull()) if ids else labelled.limit(0)
    for r in sorted(texts.select("doc_id", "lang", F.substring("text", 1, SAMPLE_CHARS).alias("text")).collect()):
        samples.setdefault(r.lang, []).append(r.text)
    return {lang: "\n".join(_spread(parts)) for lang, parts in sorted(samples.items())}


def _spread(parts: list[str]) -> list[str]:
    """An equal share of the sample's characters from every text."""
    share = SAMPLE_CHARS // max(1, len(parts)) + 1
    spare = SAMPLE_CHARS - sum(min(share, len(p)) for p in parts)
    return [p[: share + max(0, spare)] for p in parts]


def language_of(samples: dict[str, str], text: Column) -> Column:
    """Struct (lang_pred, score) of a text column."""
    fixed = tuple(sorted(samples.items()))
    key = hashlib.sha256(repr(fixed).encode()).hexdigest()

    @F.pandas_udf(PREDICTION)
    def predicted(texts: pd.Series) -> pd.DataFrame:
        lang, score = _parser(key, fixed).predict(texts.tolist())
        return pd.DataFrame({"lang_pred": lang, "score": score})

    return predicted(text)


def language_id(docs: DataFrame, samples: dict[str, str] | None = None) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row of ``docs``.

    Null texts and texts without a letter get ``und`` and 0. A row without id is held out.
    Equal entropies go to the first language by code point; without any labelled row every
    text is ``und``. Repeated rows are predicted one by one, extra columns are not read.
    ``score`` is the share of the best language in the likelihoods over at most 256 characters.
    """
    samples = training_sample(docs) if samples is None else samples
    guess = fresh("guess")
    return docs.select("doc_id", language_of(samples, F.col("text")).alias(guess)).select(
        "doc_id",
        F.coalesce(remainder("doc_id", 5) == 0, F.lit(True)).alias("held_out"),
        F.col(f"{guess}.lang_pred").alias("lang_pred"),
        F.col(f"{guess}.score").alias("score"),
    )


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language can be told (``und`` goes), columns unchanged."""
    guess = fresh("guess")
    return (
        docs.withColumn(guess, language_of(training_sample(docs), F.col("text")))
        .where(F.col(f"{guess}.lang_pred") != UNKNOWN)
        .drop(guess)
    )


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id(read(spark, folder, "documents"))
