import math
import random
import re
from collections import Counter

import duckdb

from civiframe.llm import op11_lexical_search as op

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k=op.K):
    """Every document against every item, by the stated formulas."""
    split = lambda t: TERM.findall(t.translate(SMALL)) if t else []
    bags = [(d, split(t)) for d, t in docs]
    n_docs, total = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    df = Counter(t for _, words in bags for t in set(words))
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for d, words in bags:
            tf, score = Counter(words), 0
            if words:
                m = 100 - 75 + (75 * len(words) * n_docs) // total
                for t in split(text):
                    if tf[t]:
                        w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        score += w * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def result(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


def asked(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' as score", "'y' as doc_id")


def test_terms():
    text = "Été ABC-d_e 1,5 Ünï x\x00y …z"
    assert [t.decode() for t in op.terms(text)] == TERM.findall(text.translate(SMALL))
    assert op.terms(None) == op.terms("") == op.terms(" -,") == []


def random_docs(rng, n):
    words = "a b c d e f g the of Ab É".split()
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for k in range(n)]
    rows += [(1000 + k, "the same text of many") for k in range(n)] + [(2000 + k, "a b b") for k in range(15)]
    rows += [(3, "the other"), (3, "the other"), (None, "a b b"), (None, None), (5, None), (6, ""), (7, "., -"), (8, "z " * 5000 + "a")]
    rng.shuffle(rows)
    return rows


def test_brute_force(spark, frame):
    rng = random.Random(4)
    docs = random_docs(rng, 60)
    items = [(1, "the same text"), (2, "A b, a; É"), (3, "nothing-here"), (4, None), (5, ""), (None, "of of of g"), (1, "the same text"), (1, "c")]
    items += [(10 + k, " ".join(rng.choices("a b c d e f g of".split(), k=5))) for k in range(10)]
    assert result(op.lexical_search(frame(docs), asked(spark, items))) == brute(docs, items)


def test_many_small_blocks(spark, frame, monkeypatch):
    """More items than a block takes, scores in small parts: same result."""
    monkeypatch.setattr(op, "ITEMS", 3)
    monkeypatch.setattr(op, "ITEM_BYTES", 40)
    monkeypatch.setattr(op, "CLASSES", 4)
    rng = random.Random(5)
    docs = random_docs(rng, 25)
    items = [(k, " ".join(rng.choices("a b c d e f g the of".split(), k=4))) for k in range(4)] + [(99, "long " * 60 + "the")]
    assert result(op.lexical_search(frame(docs), asked(spark, items))) == brute(docs, items)


def test_copies_are_one_class(spark, frame):
    docs = [(k, "one text, one class") for k in range(300)] + [(k, "two words of it") for k in range(300, 310)]
    block = op.Block([type("Row", (), {"item_id": 1, "text": "one class of text"})])
    found = op.classes(op.restricted(frame(docs), block.terms), 310, 1000).collect()
    assert sorted(len(r.members) for r in found) == [10, 10] and sorted(r["first"] for r in found) == [0, 300]


def test_large_weights_stay_exact():
    block = op.Block([type("Row", (), {"item_id": 1, "text": "w " * 20_000_000})])
    assert block.weighted(10**6, op.np.array([1])).dtype == op.np.int64


def test_empty_tables(spark, frame):
    assert result(op.lexical_search(frame([]), asked(spark, [(1, "a")]))) == []
    assert result(op.lexical_search(frame([(1, "a")]), asked(spark, []))) == []


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    got = op.op11_lexical_search(spark, sf)
    assert result(got) == sorted(con.execute(op.SQL).fetchall(), key=str) and got.count() > 100
