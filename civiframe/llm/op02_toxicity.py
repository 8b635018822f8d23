"""Toxicity by Levenshtein automata over a lexicon trie.

The lexicon is learned from labelled texts: word beginnings that occur in toxic texts and
hardly elsewhere. The Levenshtein automata of all terms are intersected with the trie of
the lexicon and made deterministic as words are read, so a word is followed through one
table for all terms and dropped as soon as none can match. A hit counts by the window of
words around it: further hits add to it, quotation marks and reporting words take from it.
A logistic curve over the sums, fitted to the labels, gives the score.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import re
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from civiframe.llm.tables import read, remainder
from civiframe.session import Staged

#: Bound of the training sample: labelled rows of each class.
SAMPLE_ROWS = 3000
#: Lengths of the word beginnings that can become terms.
SHORTEST, LONGEST = 3, 12
#: A term occurs in so many rows of the toxic sample, and this much more often there than in the clean one.
MIN_ROWS, MIN_RATIO = 5, 20.0
#: Terms from this length on may be misspelled by one edit, from the second on by two.
EDIT_LENGTHS = (5, 9)
#: Share of clean sample rows with misspellings of a term above which only the term itself counts.
MAX_CLEAN = 0.01
#: Words on each side of a hit that its score depends on.
WINDOW = 8
QUOTED, REPORTED, MISSPELLED, COMPANY = 0.5, 0.6, 0.7, 0.25
REPORTING = frozenset(
    "said says say wrote writes quote quoted quotes called reported accused"
    " dit dijo sagte schrieb escribió écrit citado zitiert".split()
)
QUOTES = re.compile("[\"“”„«»‹›]")
#: What training counts as words.
WORDS = re.compile(r"[^\W_]+")
THRESHOLD = 0.3
#: Words whose matches are remembered by a worker.
REMEMBERED = 400_000

HIT = T.StructType([T.StructField("word", T.StringType()), T.StructField("term", T.IntegerType()), T.StructField("edits", T.IntegerType())])


class LexiconAutomaton:
    """``terms``: word beginnings; ``edits``: how many edits each may have.

    A word matches a term that one of its beginnings spells with at most that many edits.
    """

    def __init__(self, terms: list[str], edits: list[int]):
        self.edits = edits
        self.most = max(edits, default=0)
        self.children: list[dict[str, int]] = [{}]
        self.term_at: list[int] = [-1]
        for index, term in enumerate(terms):
            node = 0
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term_at.append(-1)
                node = self.children[node][c]
            if self.term_at[node] < 0:
                self.term_at[node] = index
        self.states: dict[frozenset, int] = {}
        self.items: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.start = self._state({0: 0})

    def _state(self, least: dict[int, int]) -> int:
        """The state of trie nodes with the fewest edits each; skipping a letter of a term costs one."""
        queue = deque(least)
        while queue:
            node = queue.popleft()
            if least[node] < self.most:
                for child in self.children[node].values():
                    if least[node] + 1 < least.get(child, self.most + 1):
                        least[child] = least[node] + 1
                        queue.append(child)
        key = frozenset(least.items())
        if key not in self.states:
            self.states[key] = len(self.items)
            self.items.append(key)
            self.moves.append({})
            found = [(e, self.term_at[n]) for n, e in key if self.term_at[n] >= 0 and e <= self.edits[self.term_at[n]]]
            self.accepts.append(min(found) if found else None)
        return self.states[key]

    def step(self, state: int, c: str) -> int:
        least: dict[int, int] = {}
        for node, edits in self.items[state]:
            options = [(self.children[node].get(c), edits)]
            if edits < self.most:
                options += [(node, edits + 1), *((child, edits + 1) for child in self.children[node].values())]
            for to, cost in options:
                if to is not None and cost < least.get(to, self.most + 1):
                    least[to] = cost
        self.moves[state][c] = to = self._state(least) if least else -1
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """``(edits, term)`` of the best match, or None."""
        state, best, moves = self.start, None, self.moves
        for c in word:
            to = moves[state].get(c)
            state = self.step(state, c) if to is None else to
            if state < 0:
                break
            found = self.accepts[state]
            if found is not None and (best is None or found < best):
                best = found
                if not best[0]:
                    break
        return best


class Scorer:
    """What is learned: terms with their weights, misspellings that clean texts use, the curve."""

    def __init__(self, terms: list[str], weights: list[float], edits: list[int], innocent: frozenset[str], curve: tuple[float, ...]):
        self.terms, self.weights, self.edits = terms, weights, edits
        self.innocent, self.curve = innocent, curve
        self._prepare()

    def _prepare(self) -> None:
        self.automaton = LexiconAutomaton(self.terms, self.edits)
        #: Characters of a word that can matter.
        self.reach = max(map(len, self.terms), default=0) + max(self.edits, default=0)
        self.known: dict[str, tuple[tuple[int, int, str, bool], ...]] = {}

    def __getstate__(self) -> tuple:
        return self.terms, self.weights, self.edits, self.innocent, self.curve

    def __setstate__(self, state: tuple) -> None:
        self.terms, self.weights, self.edits, self.innocent, self.curve = state
        self._prepare()

    def _read(self, word: str) -> tuple[int, int, str] | None:
        found = self.automaton.match(word)
        return None if found is None or (found[0] and word in self.innocent) else (*found, word)

    def lookup(self, token: str) -> tuple[tuple[int, int, str, bool], ...]:
        """``(edits, term, word, reported)`` of every hit in a token, in order.

        The words are its runs of letters and digits, as in training. One that is no hit is
        read on through the signs behind it, up to the next hit: that finds ``id*ot``.
        ``reported``: a reporting word stands before it in the token.
        """
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        runs = [(m.start(), m.end()) for m in WORDS.finditer(token)]
        hits: list[tuple[int, tuple[int, int, str]]] = []
        stop = runs[-1][1] if runs else 0
        for start, end in reversed(runs):
            found = self._read(token[start:end])
            if found is None and end < stop:
                found = self._read(token[start : min(stop, start + self.reach)])
            if found is not None:
                hits.append((start, found))
                stop = start
        first = next((end for start, end in runs if token[start:end] in REPORTING), None) if hits else None
        out = self.known[token] = tuple((*found, first is not None and start >= first) for start, found in reversed(hits))
        return out

    def hits(self, text: str | None) -> tuple[list[str], list[tuple[int, tuple[int, int, str, bool]]]]:
        tokens = text.lower().split() if text else []
        known, lookup, out = self.known, self.lookup, []
        for place, token in enumerate(tokens):
            for found in known[token] if token in known else lookup(token):
                out.append((place, found))
        return tokens, out

    def features(self, text: str | None) -> tuple[float, float]:
        """The sum of the window scores of all hits, and the largest."""
        tokens, hits = self.hits(text)
        total = largest = 0.0
        places = [p for p, _ in hits]
        for k, (place, (edits, term, _, reported)) in enumerate(hits):
            before, after = tokens[max(0, place - WINDOW) : place], tokens[place + 1 : place + 1 + WINDOW]
            score = self.weights[term] * MISSPELLED**edits
            quoted = QUOTES.search(tokens[place]) or (
                any(QUOTES.search(w) for w in before) and any(QUOTES.search(w) for w in after)
            )
            if quoted:
                score *= QUOTED
            if reported or any(p in REPORTING for w in before for p in WORDS.findall(w)):
                score *= REPORTED
            near = sum(abs(p - place) <= WINDOW for p in places[max(0, k - WINDOW) : k + WINDOW + 1]) - 1
            score *= 1 + COMPANY * min(near, 2)
            total += score
            largest = max(largest, score)
        return total, largest

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-_inputs(features) @ np.array(self.curve)))


def _inputs(features: np.ndarray) -> np.ndarray:
    features = features.reshape(-1, 2)
    return np.column_stack([np.ones(len(features)), np.log1p(features[:, 0]), features[:, 1]])


def fit_curve(features: np.ndarray, labels: np.ndarray, stands_for: np.ndarray | float = 1.0) -> tuple[float, ...]:
    """Logistic regression by Newton steps, with a small penalty; row k counts as ``stands_for[k]`` rows."""
    x, w, n = _inputs(features), np.zeros(3), np.broadcast_to(stands_for, len(features))
    for _ in range(25):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (n * (p - labels)) + 0.05 * w
        w = w - np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3), gradient)
    return tuple(w.tolist())


_LOADED: dict[bytes, Scorer] = {}


def _loaded(state: bytes) -> Scorer:
    key = hashlib.sha256(state).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = pickle.loads(state)
    return _LOADED[key]


def choose_terms(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> list[tuple[str, int, int]]:
    """Of word beginnings with their toxic and clean row counts: those that tell toxic rows
    from clean ones, by rows times log ratio, the longest of equals; none of them begins
    another."""

    def evidence(t: int, c: int) -> float:
        return t * math.log((t + 0.5) / (toxic + 1) / ((c + 0.5) / (clean + 1)))

    chosen: list[tuple[str, int, int]] = []
    terms: set[str] = set()
    shorter: set[str] = set()
    for term, t, c in sorted(counts, key=lambda x: (-evidence(x[1], x[2]), -len(x[0]), x[0])):
        if t < MIN_ROWS or t / toxic < MIN_RATIO * c / clean or term in shorter:
            continue
        if any(term[:k] in terms for k in range(SHORTEST, len(term))):
            continue
        chosen.append((term, t, c))
        terms.add(term)
        shorter.update(term[:k] for k in range(SHORTEST, len(term)))
    return chosen


def training_sample(docs: DataFrame, labels: DataFrame, work: Staged) -> tuple[DataFrame, dict[int, float]]:
    """``(doc_id, text, toxic)``: at most ``SAMPLE_ROWS`` labelled rows of each class, drawn by a
    hash of the id, whose crc32 remainder modulo 4 is not 2; and how many rows of its class
    each stands for. Only ids and labels are ranked."""
    usable = labels.where("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where(remainder("doc_id", 4) != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # a share of each class that holds about twice the bound, so that the rank meets few rows at any size
    numbers = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {y: int(min(1.0, 2 * SAMPLE_ROWS / n) * (1 << 30)) for y, n in numbers.items()}
    usable = usable.where(
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.when(F.col("toxic") == 1, share.get(1, 0)).otherwise(share.get(0, 0))
    )
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = work.put(usable.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= SAMPLE_ROWS).drop("_n"), "toxicity-ids")
    stands_for = {r.toxic: numbers[r.toxic] / r.n for r in chosen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text is not null")
    return work.put(sample, "toxicity-sample"), stands_for


def train(docs: DataFrame, labels: DataFrame) -> Scorer:
    with Staged(docs.sparkSession) as work:
        sample, stands_for = training_sample(docs, labels, work)
        n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        toxic, clean = n.get(1, 0), n.get(0, 0)
        # the sample holds the classes in other shares than the table: its rows count as the rows they stand for
        all_toxic, all_clean = toxic * stands_for.get(1, 1.0), clean * stands_for.get(0, 1.0)
        rate = (all_toxic + 0.5) / (all_toxic + all_clean + 1) if toxic + clean else 0.0
        flat = (math.log(rate / (1 - rate)) if rate else -20.0, 0.0, 0.0)
        if not toxic or not clean:
            return Scorer([], [], [], frozenset(), flat)
        words = F.expr("array_distinct(split(lower(text), '[^\\\\p{L}\\\\p{N}]+'))")
        begins = F.expr(
            f"array_distinct(flatten(transform(words, w -> transform(filter(sequence({SHORTEST}, {LONGEST}), k -> k <= length(w)),"
            " k -> substring(w, 1, k)))))"
        )
        begin = sample.select("toxic", words.alias("words")).select("toxic", F.explode(begins).alias("begin"))
        counts = (
            begin.groupBy("begin")
            .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
            .where((F.col("t") >= MIN_ROWS) & (F.col("t") / toxic >= MIN_RATIO / clean * F.col("c")))
        )
        chosen = choose_terms([(r.begin, r.t, r.c) for r in counts.collect()], toxic, clean)
        terms = [t for t, _, _ in chosen]
        weights = [(t / toxic) / (t / toxic + c / clean) for _, t, c in chosen]
        edits = [sum(len(t) >= least for least in EDIT_LENGTHS) for t in terms]
        first = Scorer(terms, weights, edits, frozenset(), flat)
        edits, innocent = _check_misspellings(sample, first, toxic, clean)
        second = Scorer(terms, weights, edits, innocent, flat)
        rows = sample.select("toxic", _features(second)("text").alias("f")).select("toxic", "f.*").toPandas()
        each = rows.toxic.map(stands_for).to_numpy(float)
        curve = fit_curve(rows[["total", "largest"]].to_numpy(), rows.toxic.to_numpy(), each / each.mean())
        return Scorer(terms, weights, edits, innocent, curve)


def _check_misspellings(sample: DataFrame, scorer: Scorer, toxic: int, clean: int) -> tuple[list[int], frozenset[str]]:
    """Words within the edits of a term that clean texts use as often are no misspellings;
    a term that has too many of them is taken literally."""
    state = pickle.dumps(scorer)

    @F.pandas_udf(T.ArrayType(HIT))
    def misspelled(texts: pd.Series) -> pd.Series:
        own = _loaded(state)
        return pd.Series([[(w, t, e) for w, t, e in {(w, t, e) for _, (e, t, w, _) in own.hits(x)[1]} if e] for x in texts])

    hits = sample.select("toxic", F.explode(misspelled("text")).alias("h")).select("toxic", "h.*")
    found = hits.groupBy("word", "term").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    rows = found.where("c > 0").collect()  # bounded as the sample is
    used = [r for r in rows if r.c / clean >= 0.2 * r.t / toxic]
    edits = list(scorer.edits)
    for term in range(len(edits)):
        single = [r.c for r in used if r.term == term]
        if len(single) > 5 and sum(single) > MAX_CLEAN * clean:
            edits[term] = 0
    return edits, frozenset(r.word for r in used)


def _features(scorer: Scorer):
    state = pickle.dumps(scorer)

    @F.pandas_udf(T.StructType([T.StructField("total", T.DoubleType()), T.StructField("largest", T.DoubleType())]))
    def features(texts: pd.Series) -> pd.DataFrame:
        own = _loaded(state)
        return pd.DataFrame([own.features(x) for x in texts], columns=["total", "largest"], dtype=float)

    return features


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Null and empty texts have no hit and get the score of no hit. A row without id is held
    out. Labels other than 0 and 1 are left out, an id labelled twice is toxic if any of its
    labels is. Without labels of both classes every score is the share of toxic labels.
    Repeated rows are scored one by one; extra columns are not read.
    """
    scorer = train(docs, labels)
    state = pickle.dumps(scorer)

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        own = _loaded(state)
        return pd.Series(own.score(np.array([own.features(x) for x in texts], float)))

    return docs.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 4) == 2, F.lit(True)).alias("held_out"),
        score("text").alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))
