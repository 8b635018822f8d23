import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from civiframe.llm import op03_suffix_dedup as op
from civiframe.llm.induced import suffix_array


def brute(texts):
    """Removed bytes of each text by counting every string of the length."""
    n = op.LENGTH
    seen = Counter(t[k : k + n] for t in texts for k in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - n + 1):
            if seen[t[k : k + n]] > 1:
                gone[k : k + n] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("memory", [64, 1 << 20])
def test_suffix_array_against_sorting(memory):
    rng = random.Random(memory)
    for _ in range(150):
        letters, cap = rng.randint(1, 4), rng.choice([3, 8, 20, 400])
        base = [rng.randint(1, letters) for _ in range(rng.randint(1, 60))]
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts += rng.choice([base, base[:9] + base[:5], [1] * rng.randint(1, 50)]) + [0]
        text = np.array(parts, np.uint8)
        data = text.tobytes()
        place, share = suffix_array(text, cap, memory)
        assert sorted(place.tolist()) == list(range(len(data)))
        order = sorted(range(len(data)), key=lambda i: data[i : i + cap])
        assert [data[i : i + cap] for i in place] == [data[i : i + cap] for i in order]
        for a, b, k in zip(place, place[1:], share[1:]):
            same = 0
            while same < cap and max(a, b) + same < len(data) and data[a + same] == data[b + same]:
                same += 1
            assert k == same


def texts():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghé") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, other = prose(120), prose(70)
    out = [None, "", "short", "x" * 399, "y" * 400, "z" * 401, "ab" * 300, prose(200)]
    out += [prose(20) + passage + prose(20) for _ in range(6)] + [prose(9) + other[:k] + prose(9) for k in (380, 399, 400, 401, 430)]
    out += [out[-1], out[-1], passage + " " + passage, prose(30) + passage[:450] + "!" + passage[451:]]
    return out


@pytest.mark.parametrize("hot", [op.HOT, 1])
def test_against_brute_force(frame, monkeypatch, hot):
    monkeypatch.setattr(op, "HOT", hot)
    rows = [(k, t) for k, t in enumerate(texts())]
    got = {r.doc_id: r for r in op.suffix_dedup(frame(rows)).collect()}
    wanted = brute([(t or "").encode() for _, t in rows])
    for k, w in enumerate(wanted):
        r = got[k]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == w, k
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == w[3]


def test_parts_of_long_texts_have_the_same_anchors(monkeypatch):
    import pyarrow as pa

    rng = random.Random(9)
    data = pa.array([bytes(rng.choice(b"abcd ") for _ in range(n)) for n in (50_000, 300, 7_000)], pa.binary())

    def anchors():
        return sorted((int(r), int(a - b)) for c in op.chunks(data) for r, a, b in zip(c.row, c.anchors, c.base))

    whole = anchors()
    monkeypatch.setattr(op, "CHUNK", 4096)
    assert anchors() == whole and len(whole) > 200


def test_repeated_rows_and_null_ids(frame):
    text = " ".join(f"word{k}" for k in range(100))
    rows = [(1, text), (1, text), (None, text), (2, text + " tail")]
    out = op.suffix_dedup(frame(rows)).collect()
    assert len(out) == 4 and all(r.n_bytes - r.n_removed <= len(" tail") for r in out)
    assert op.suffix_dedup(frame([])).count() == 0
    assert op.suffix_dedup(frame([(1, text)])).first().n_removed == 0


def test_provided_table(spark, sf):
    rows = {r.doc_id: r for r in op.op3_suffix_dedup(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    for d, w in zip(docs, brute([(d.text or "").encode() for d in docs])):
        r = rows[d.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == w
