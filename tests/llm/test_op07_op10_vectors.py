import math

import numpy as np
import pytest

from civiframe.llm import op07_embeddings as near
from civiframe.llm import op10_topk as top

SCHEMA = "vec_id long, embedding array<float>, label int, n string, v string, dim string, node string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)


def fixture():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 40))
    rows = []
    for k in range(300):
        noise = rng.choice([0.0, 0.05, 0.15, 0.3])
        rows.append((k, (centres[k % 6] + noise * rng.normal(size=40)).astype(np.float32).tolist(), k % 3))
    rows += [(k + 300, rows[0][1], 0) for k in range(20)]
    odd = [None, [], [0.0] * 40, [None] * 40, [math.nan] * 40, [math.inf] * 40, [1.0, 2.0], [2.0, 4.0], [3e38] * 40]
    rows += [(400 + k, v, 1) for k, v in enumerate(odd)]
    return rows + [(500, rows[1][1], None), (501, [-x for x in rows[1][1]], 1), (None, rows[2][1], 2), (600, rows[2][1], 2)]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


@pytest.mark.parametrize("tile", [near.TILE, 16])
def test_near_vectors_against_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(near, "TILE", tile)
    rows = fixture()
    out = {r.vec_id: r for r in near.embedding_near_dedup(vectors(spark, rows)).collect()}
    assert len(out) == len(rows)
    able = [r for r in rows if r[0] is not None and r[2] is not None and usable(r[1]) and any(r[1])]
    links = {r[0]: set() for r in rows}
    for a in able:
        x = np.array(a[1], float) / max(map(abs, a[1]))
        for b in able:
            if a[0] != b[0] and a[2] == b[2] and len(a[1]) == len(b[1]):
                y = np.array(b[1], float) / max(map(abs, b[1]))
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= 0.98:
                    links[a[0]].add(b[0])
    for r in rows:
        reached, todo = {r[0]}, [r[0]]
        while todo:
            for other in links[todo.pop()] - reached:
                reached.add(other)
                todo.append(other)
        got = out[r[0]]
        assert got.n_links == len(links[r[0]]), r[0]
        if r[0] is not None:
            assert got.component_id == min(reached) and got.kept == (r[0] == min(reached))
    assert sum(map(len, links.values())) > 500


def brute_top(rows, k=10):
    able = [(i, [math.floor(1024 * x) for x in v]) for i, v, _ in rows if i is not None and usable(v) and max(map(abs, v), default=0) < 1e9]
    out = {}
    for i, q in able:
        if i % 100 == 0:
            scored = [(-sum(a * b for a, b in zip(q, v)), j) for j, v in able if j != i and len(v) == len(q)]
            out[i] = [(n, j, -s) for n, (s, j) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.mark.parametrize("sizes", [(8192, 8192, 2048), (60, 2, 16)])
def test_top_k_against_all_scores(spark, monkeypatch, sizes):
    monkeypatch.setattr(top, "SHARD_ROWS", sizes[0])
    monkeypatch.setattr(top, "BLOCK_QUERIES", sizes[1])
    rows = [r for r in fixture() if r[1] is None or not any(x is not None and math.isfinite(x) and abs(x) > 1e9 for x in r[1])]
    table = vectors(spark, rows).select("vec_id", "embedding")
    found = {}
    for r in top.top_k(table, table.where("vec_id % 100 = 0")).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: sorted(v) for q, v in found.items()} == {q: v for q, v in brute_top(rows).items() if v}


def test_blocks_with_thresholds():
    rng = np.random.default_rng(1)
    x = rng.integers(-50, 50, size=(4000, 24))
    ids = rng.permutation(4000)
    for _ in range(10):
        q = rng.integers(-50, 50, size=24) * (rng.random(24) < 0.4)
        best = top.Best(10)
        for a in range(0, 4000, 100):
            part = x[a : a + 100]
            top.search_block(part, ids[a : a + 100], part.max(axis=0), part.min(axis=0), 7, q, best)
        order = np.lexsort((ids, -(x @ q)))
        order = order[ids[order] != 7][:10]
        assert best.vec.tolist() == ids[order].tolist() and best.score.tolist() == (x @ q)[order].tolist()


def test_empty(spark):
    table = vectors(spark, [])
    assert near.embedding_near_dedup(table).count() == 0 and top.top_k(table, table).count() == 0
    one = vectors(spark, [(100, [1.0], 1)])
    assert near.embedding_near_dedup(one).first().kept and top.top_k(one, one).count() == 0
