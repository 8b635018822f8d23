import random

import numpy as np
import pandas as pd
import pytest
import xxhash

from civiframe.llm import op04_simhash as op
from civiframe.llm.graph import components, local_roots
from civiframe.session import Staged


def plain(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups(items, linked):
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(items))]


def test_fingerprints(monkeypatch):
    rng = random.Random(2)
    texts = [None, "", " \t\x0b\n", "One", "one TWO", "ÀB ab ÀB ab", "a b c d"] + [
        " ".join(rng.choice(["Tea", "cup", "ÉT", "x"]) for _ in range(n)) for n in (3, 4, 50, 400)
    ]
    wanted = [plain(t) for t in texts]
    assert op.fingerprints(texts).tolist() == wanted
    monkeypatch.setattr(op, "CHUNK", 16)
    assert op.fingerprints(texts).tolist() == wanted


@pytest.mark.parametrize("tile, small", [(op.TILE, op.SMALL), (op.TILE, 1), (24, 4)])
def test_links_join_all_near_fingerprints(spark, monkeypatch, tile, small):
    monkeypatch.setattr(op, "TILE", tile)  # the plan is cut on the driver
    monkeypatch.setattr(op, "SMALL", small)
    rng = random.Random(7)
    prints = {0}
    for _ in range(25):
        base = rng.getrandbits(64)
        for _ in range(8):
            value = base
            for _ in range(rng.randint(0, 4)):
                value ^= 1 << rng.randrange(64)
            prints.add(value)
    block = rng.getrandbits(16)  # one quarter that many different fingerprints share
    prints |= {rng.getrandbits(48) << 16 | block for _ in range(150)}
    prints = sorted(np.array(sorted(prints), np.uint64).view(np.int64).tolist())
    with Staged(spark) as work:
        table = spark.createDataFrame([(p,) for p in prints], "fp long")
        roots = {r.node: r.root for r in components(op.fingerprint_links(table), work).collect()}
    found = [roots.get(p, p) for p in prints]
    wanted = groups(prints, lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1") <= 3)
    assert len(set(zip(found, wanted))) == len(set(found)) == len(set(wanted))


def test_tile_pairs_of_a_cell(monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(op, "SMALL", 2)
    base = rng.getrandbits(64)
    prints = np.unique(np.array([base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(300)], np.uint64))
    cell = pd.DataFrame({"fp": prints.view(np.int64), "bucket": 1, "tile": np.arange(len(prints)) % 2, "t1": 0, "t2": 1})
    links = op.compare_cell(cell)
    assert (np.bitwise_count((links.a ^ links.b).to_numpy().view(np.uint64)) <= 12).all()
    assert len(links) < len(prints)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(60)] + [(200, k) for k in range(100, 200)] + [(7, 7), (None, 3), (300, 301)]
    rng.shuffle(edges)
    with Staged(spark) as work:
        found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), work).collect()}
        assert components(spark.createDataFrame([], "a long, b long"), work).count() == 0
    assert found == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 201)} | {300: 300, 301: 300}
    assert local_roots(5, np.array([4, 3]), np.array([3, 1])).tolist() == [0, 1, 2, 1, 1]


def test_edge_rows(frame):
    rows = [(5, None), (4, ""), (3, "a b c d e"), (9, "A B c d e"), (None, "a b c d e"), (9, "A B c d e"), (1, "quite another text here")]
    out = op.simhash_near_dedup(frame(rows)).collect()
    assert len(out) == 7 and {r.component_id for r in out if r.fingerprint == "0" * 16} == {4}
    assert {r.component_id for r in out if r.doc_id in (3, 9, None)} == {3}
    assert op.simhash_near_dedup(frame([])).count() == 0


def test_keep_one(frame):
    docs = frame([(5, None), (4, ""), (3, "a b c d e"), (9, "A B c d e"), (None, "a b c d e"), (1, "quite another text here")])
    kept = op.keep_one_of_group(docs)
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]


def test_keep_one_decides_by_row(frame):
    """Of two null ids only the near copy goes; an id on two texts goes only where its group has a smaller one."""
    rows = [(3, "a b c d e"), (None, "a b c d e"), (None, "wholly unlike words stand here"), (9, "A B c d e"), (9, "quite another text here"), (None, None)]
    kept = op.keep_one_of_group(frame(rows)).select("doc_id", "text").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [
        (0, ""), (0, "wholly unlike words stand here"), (3, "a b c d e"), (9, "quite another text here")
    ]


def test_keep_one_of_equal_rows(frame):
    """Of rows equal in id and text one stays, with an id and without one; so does one of a group without ids."""
    texts = {"a": "a b c d e", "b": "quite another text here", "c": "wholly unlike words stand here"}
    rows = [(1, texts["a"])] * 3 + [(None, texts["b"])] * 3 + [(None, texts["c"]), (None, texts["c"].upper()), (4, "one more text that is alone")]
    kept = op.keep_one_of_group(frame(rows)).select("doc_id", "text").collect()
    assert sorted(r.text.lower() for r in kept) == sorted([*texts.values(), "one more text that is alone"])
    assert op.keep_one_of_group(frame([])).count() == 0


def test_provided_table(spark, sf):
    rows = sorted(op.op4_simhash_near_dedup(spark, sf).collect())
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    assert all(int(r.fingerprint, 16) == plain(texts[r.doc_id]) for r in rows)
    prints = [int(r.fingerprint, 16) for r in rows]
    wanted = groups(prints, lambda a, b: bin(a ^ b).count("1") <= 3)
    least = {}
    for r, g in zip(rows, wanted):
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    assert [r.component_id for r in rows] == [least[g] for g in wanted]
