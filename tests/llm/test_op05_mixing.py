import re

import numpy as np
import pytest

from civiframe.llm import op05_mixing as op
from civiframe.session import Staged


def targets(sizes):
    """Targets by resharing, source by source."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    wanted, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = wanted - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > 2 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 2.0 * sizes[s] for s in above}


def highest_quotients(shares, seats):
    got = [0] * len(shares)
    for _ in range(seats):
        best = max(range(len(shares)), key=lambda k: (shares[k] / (2 * got[k] + 1), -k))
        got[best] += 1
    return got


@pytest.mark.parametrize("shares, seats", [([10.0, 7, 5, 3], 11), ([4.0, 4, 4], 7), ([1e6, 3, 3, 0], 100), ([0.0, 0], 5), ([5.0], 0)])
def test_apportionment(spark, shares, seats):
    rows = [(f"k{k:03}", float(s)) for k, s in enumerate(shares)]
    with Staged(spark) as work:
        found = sorted(op.apportion(spark.createDataFrame(rows, "key string, target double"), seats, work).collect())
    if sum(shares) and seats:
        assert [r.quota for r in found] == highest_quotients(shares, seats)
    else:
        assert all(r.quota == 0 for r in found)


def _docs():
    rows = [(k, " ".join(["w"] * (37 * (k % 11))) + " \t\n x", "en", f"s{k % 4}" if k % 4 else None) for k in range(160)]
    return rows + [(900, None, None, "s1"), (901, "", None, "zz"), (None, "a b c", None, "s1"), (3, "dup dup", None, "s3"), (3, "dup dup", None, "s3")]


def test_targets_and_words(frame):
    out = op.source_mixing(frame(_docs())).collect()
    assert len(out) == len(_docs())
    sizes, taken = {}, {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size
    wanted = targets(sizes)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
    for s, t in wanted.items():
        assert abs(taken[s] - t) <= 2 * op.BLOCKS[0] + 0.01 * t


def test_reruns_agree_and_shards_add_up(frame, monkeypatch):
    monkeypatch.setattr(op, "SHARD", 3000)
    docs = frame(_docs())
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken)
    first = sorted(map(key, op.source_mixing(docs).collect()))
    assert first == sorted(map(key, op.source_mixing(docs.repartition(7)).collect()))


def test_texts_hold_the_words_taken(frame):
    docs = frame([r for r in _docs() if r[0] != 3])
    mixed = op.mixed_documents(docs)
    assert mixed.schema == docs.schema
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(re.findall(op.WORD, r.text))
    assert words == {r.doc_id: r.taken for r in op.source_mixing(docs).collect() if r.taken}


def test_block_arithmetic():
    sizes = np.array([0, 100, 3, 64, 0, 200])
    edges, times, ends = op.drawn_blocks(sizes, 8, "k", 64)
    each = np.repeat(times, np.diff(edges))
    parts = np.split(each, ends[:-1])
    assert op.words_taken(edges, times, ends, sizes, 64).tolist() == [int(p.sum()) for p in parts] and times.sum() == 8


def test_empty(frame):
    assert op.source_mixing(frame([])).count() == 0 and op.mixed_documents(frame([])).count() == 0
    assert [r.taken for r in op.source_mixing(frame([(1, None), (2, "")])).collect()] == [0, 0]


def test_small_sources_come_near_their_targets(spark, frame):
    """300 sources of ten words beside one of 20,000: each within a word of its target or a hundredth."""
    docs = [(k, "w " * 10, None, f"s{k:03d}") for k in range(300)] + [(1000 + k, "w " * 500, None, "large") for k in range(40)]
    rows = op.source_mixing(frame(docs)).collect()
    taken, target = {}, {}
    for r in rows:
        taken[r.source], target[r.source] = taken.get(r.source, 0) + r.taken, r.target
        assert r.taken <= 2 * r.size
    assert len(taken) == 301 and all(abs(taken[s] - t) <= max(1, 0.01 * t) for s, t in target.items())
    assert min(taken.values()) >= 8


def test_rows_without_id_are_dealt_by_their_texts(frame, monkeypatch):
    monkeypatch.setattr(op, "SHARD", 64)
    docs = [(None, f"{k} b c d", None, "s") for k in range(100)]
    from civiframe.session import Staged

    table = frame(docs)
    shards = op.placed(table, False, Staged(table.sparkSession)).groupBy("_key").count().collect()
    assert len(shards) > 3 and max(r["count"] for r in shards) < 50
    assert sum(r.taken for r in op.source_mixing(table).collect()) == 600
