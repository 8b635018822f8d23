import random
import re
import zlib
from collections import Counter

import pytest

from civiframe.llm import op12_spelling as op

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def counted(docs):
    """Occurrences of words, run by run, by the stated rule."""
    n = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(docs):
    n = counted(docs)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    best = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    form = {w: v for w, v in best.items() if n[v] >= 2 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w) or "", root(w), n[w], len(near[w]), n[form[w]] if w in form else 0) for w in n)


def result(df):
    assert df.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    rows = df.collect()
    assert all((r.form is None) == (r.form_n is None) for r in rows)
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in rows)


def random_docs(rng, letters, vocabulary, n):
    base = ["".join(rng.choices(letters, k=rng.randint(4, 9))) for _ in range(vocabulary)]
    base += ["lighthouse", "lighthouses", "ligthhouse", "lghthouse", "éclair", "eclair", "Éclair", "abcde", "abcdef", "aaaaa", "aaaaaa", "aaaaaaa"]
    weights = [1 / (k + 1) for k in range(len(base))]
    rng.shuffle(base)
    return [(k, "-".join(rng.choices(base, weights, k=rng.randint(0, 60)))) for k in range(n)]


def test_runs():
    text = "Ab_c1dÉ×é straße łodz \x00x 日本y"
    assert [r.decode("latin-1") for r in op.runs(text)] == [r.translate(SMALL) for r in RUN.findall(text)]
    assert op.runs(None) == op.runs("") == op.runs("1 2") == []


@pytest.mark.parametrize("letters, pairs, size", [("ab", 64, 3000), ("abc", 0, 30), ("abéz", 1, 3000)])
def test_brute_force(frame, monkeypatch, letters, pairs, size):
    """Also with groups that are cut until one character is left."""
    monkeypatch.setattr(op, "PAIRS_PER_WORD", pairs)
    monkeypatch.setattr(op, "GATHERED", 20)
    docs = random_docs(random.Random(len(letters)), letters, 150, 120)
    docs += [(None, "without an id lighthouse " * 3), (None, None), (7, None), (8, ""), (9, "1 2, 3")] + [(9, "twice the same row, lighthouse")] * 2
    docs += [(500 + k, "x" * size + " " + "x" * (size - 1 + k % 2) + " word") for k in range(6)]
    wanted = brute(docs)
    assert len(wanted) > 50 and any(r[1] for r in wanted)
    assert result(op.spelling_variants(frame(docs))) == wanted


def test_slips_come_from_id_and_run(frame):
    """A run that slips in one document does so at each of its places there, and stays in others."""
    slipping = next(k for k in range(10000) if zlib.crc32(f"{k}:harbour".encode()) % 97 == 0)
    docs = [(slipping, "Harbour harbour HARBOUR"), (slipping + 1, "harbour " * 3)]
    got = result(op.spelling_variants(frame(docs)))
    assert got == brute(docs) and len(got) == 2


def test_a_common_chunk_is_cut_further(spark, frame):
    """All words of one half: pairs that are compared grow with the words, not with their square."""
    rng, sizes = random.Random(3), []
    for n in (400, 1600):
        words = {"common" + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(n)}
        table = spark.createDataFrame([(w, 3) for w in sorted(words)], "word string, n long")
        rows, compared = op.cut(op.openings(table)), 0
        for _ in range(6):
            keys = rows.groupBy("key").agg(op.F.count_if(~op.F.col("gram")).alias("c"), op.F.count_if("gram").alias("g"))
            keys = keys.withColumn("many", op.F.expr(f"c * g > {op.PAIRS_PER_WORD} * (c + g)"))
            compared += keys.where("not many").agg(op.F.coalesce(op.F.sum(op.F.expr("c * g")), op.F.lit(0))).first()[0]
            rows = op.cut(rows.join(keys.where("many").select("key"), "key"))
        sizes.append(compared / n)
    assert sizes[1] < 2 * sizes[0]


def test_long_chain_of_forms(frame):
    """abcde <- abcdef <- abcdefg ..., each twice as frequent as the one before."""
    parts = ["abcdefghijkl"[: 5 + k] for k in range(8)]
    still = next(d for d in range(10000) if all(zlib.crc32(f"{d}:{w}".encode()) % 97 for w in parts))
    docs = [(still, " ".join([w] * (3 * 2**k))) for k, w in enumerate(parts)]
    got = result(op.spelling_variants(frame(docs)))
    assert got == brute(docs) and {r[2] for r in got} == {"abcdefghijkl"}


def test_empty_table(frame):
    assert op.spelling_variants(frame([])).collect() == []


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(op.op12_spelling_variants(spark, sf)) == brute(docs)
