"""Hierarchical multi-length packing of token sequences.

Documents are routed to context-size tiers: what exceeds the longest window fills whole
windows, the rest goes to the smallest tier that holds it. Longer tiers are packed first;
the gap of each window is filled with whole documents of shorter tiers where they fit and
with a cut one at the end. What is left of a partition is cut into windows of falling
powers of two. Closed windows are dealt to step groups of equal token counts.

Every input partition is packed by itself, batch after batch, so nothing is shuffled and
only documents that wait for a window are held.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from civiframe.llm.tables import read

WINDOW = 2048
#: Context sizes of the tiers that documents are routed to.
TIERS = (2048, 1024, 512, 256)
#: Shortest window that the rest of a partition is cut to; what is below is padded.
LEAST = 16
#: Tokens of a step group.
STEP_TOKENS = 8 * WINDOW
#: Documents of the shorter tiers that wait between batches, to fill gaps with.
RESERVE = 64
END = 1
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = "<|endoftext|>"
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " tier int, step_group long"
)


@functools.cache
def _reference(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@functools.cache
def _ranks(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str | None, tokenizer: str, ranks: str | None = None) -> np.ndarray:
    """Ids of the text, then the end id. ``ranks`` names the same vocabulary in the form
    that is read faster; a text that holds the special token goes to the tokenizer itself."""
    if not text:
        ids = np.zeros(0, np.uint32)
    elif ranks and SPECIAL not in text:
        ids = _ranks(ranks).encode_to_numpy(text, disallowed_special=())
    else:
        ids = np.array(_reference(tokenizer).encode(text, add_special_tokens=False).ids, np.uint32)
    return np.append(ids.astype("<u4"), np.uint32(END)).astype("<u4")


@dataclass(slots=True)
class Piece:
    """Tokens of a document from ``start`` on that have no place yet."""

    doc_id: int | None
    ids: np.ndarray
    start: int
    doc_tokens: int

    def cut(self, length: int) -> Piece:
        head = Piece(self.doc_id, self.ids[:length], self.start, self.doc_tokens)
        self.ids, self.start = self.ids[length:], self.start + length
        return head


class Packer:
    """Packs one partition; ``rows`` gathers what is closed."""

    def __init__(self, first: int):
        self.pools: dict[int, deque[Piece]] = {tier: deque() for tier in TIERS}
        self.first = self.sequence = self.step = first
        self.open_steps: list[list[int]] = []  # [free tokens, step group]
        self.rows: list[tuple] = []

    def add(self, piece: Piece) -> None:
        while len(piece.ids) >= WINDOW:
            self.close([piece.cut(WINDOW)], WINDOW)
        self.route(piece)

    def route(self, piece: Piece) -> None:
        if len(piece.ids):
            self.pools[min(t for t in TIERS if t >= len(piece.ids))].append(piece)

    def close(self, pieces: list[Piece], tier: int) -> None:
        step, offset = self.step_group(tier), 0
        for p in pieces:
            self.rows.append(
                (p.doc_id, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.doc_tokens, self.sequence, offset, tier, step)
            )
            offset += len(p.ids)
        self.sequence += 1

    def step_group(self, tokens: int) -> int:
        """The fullest open step that has room, or a new one."""
        room = [s for s in self.open_steps if s[0] >= tokens]
        if not room:
            room = [[STEP_TOKENS, self.step]]
            self.open_steps += room
            self.step += 1
        chosen = min(room)
        chosen[0] -= tokens
        if not chosen[0]:
            self.open_steps.remove(chosen)
        return chosen[1]

    def filler(self, gap: int, tier: int) -> Piece | None:
        """For a gap of a window: a whole piece of the largest shorter tier that has one that
        fits, else one cut from the shortest pool that is not empty."""
        for t in TIERS:
            pool = self.pools[t]
            if t < tier and pool and len(pool[0].ids) <= gap:
                return pool.popleft()
        for t in reversed(TIERS):
            if t <= tier and self.pools[t]:
                piece = self.pools[t].popleft()
                if len(piece.ids) <= gap:
                    return piece
                head = piece.cut(gap)
                self.route(piece)
                return head
        return None

    def pack(self, last: bool) -> None:
        """Close windows, longest tier first; between batches a reserve of each tier waits."""
        rest: list[Piece] = []
        for tier in TIERS:
            pool = self.pools[tier]
            while len(pool) > (0 if last else RESERVE):
                pieces = [pool.popleft()]
                gap = tier - len(pieces[0].ids)
                while gap and (piece := self.filler(gap, tier)):
                    pieces.append(piece)
                    gap -= len(piece.ids)
                if gap:
                    rest += pieces
                else:
                    self.close(pieces, tier)
        if last:
            self.close_rest(rest)

    def close_rest(self, rest: list[Piece]) -> None:
        left = sum(len(p.ids) for p in rest)
        waiting = deque(rest)
        while left:
            tier = next((WINDOW >> k for k in range(12) if LEAST <= WINDOW >> k <= left), left)
            pieces, gap = [], tier
            while gap:
                pieces.append(waiting.popleft() if len(waiting[0].ids) <= gap else waiting[0].cut(gap))
                gap -= len(pieces[-1].ids)
            self.close(pieces, tier if tier >= LEAST else WINDOW)
            left -= tier

    def taken(self) -> pd.DataFrame:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        out = pd.DataFrame(self.rows, columns=names)
        out["doc_id"] = out["doc_id"].astype("Int64")
        self.rows = []
        return out


def packing(docs: DataFrame, tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """Pieces of all documents in sequences of at most ``WINDOW`` tokens.

    One row for each piece: where it lies in its document (``start``, ``length``; a document
    is its ids and the end id) and in its sequence (``offset``), the context size of the
    sequence and its step group. Null texts count as empty and give the end id alone. Ids
    of documents are carried only: null and repeated ones are packed like others, extra
    columns are not read. An empty table gives no rows. Sequences are numbered from the
    partition's number times 2^33. Only the last sequence of a partition may be padded.
    """
    if tokenizer is None:
        tokenizer, ranks = public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = Packer(TaskContext.get().partitionId() << 33)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                ids = encode(text, tokenizer, ranks)
                packer.add(Piece(None if pd.isna(doc_id) else int(doc_id), ids, 0, len(ids)))
            packer.pack(last=False)
            yield packer.taken()
        packer.pack(last=True)
        yield packer.taken()

    return docs.select("doc_id", "text").mapInPandas(pack, SCHEMA)


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing(read(spark, folder, "documents"))
