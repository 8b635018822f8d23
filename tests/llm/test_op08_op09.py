import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from civiframe.llm import op08_licenses as lic
from civiframe.llm import op09_packing as pack


def test_increasing_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        places = rng.sample(range(12), rng.randint(0, 8))
        found = [places[k] for k in lic.increasing(places)]
        longest = max((n for n in range(len(places) + 1) for c in itertools.combinations(places, n) if list(c) == sorted(c)), default=0)
        assert found == sorted(found) and len(found) == longest


def test_alignment_is_increasing_and_equal():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randint(0, 15))] for _ in range(2))
        pairs = lic.align(a, b)
        assert all(a[x] == b[y] for x, y in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    words = "one two three four five".split()
    assert len(lic.align(words, words)) == 5 and len(lic.align(["x", *words[:3], "y", *words[3:]], words)) == 5


def test_notices():
    scan = lic.Scanner(lic.TEMPLATES).scan
    for name, text in lic.TEMPLATES.items():
        assert [(n, c) for n, c, _, _ in scan(f"Before it. {text} And after it.")] == [(name, 1.0)], name
        assert [n for n, *_ in scan(text.upper().replace(" ", " \n "))] == [name]
    changed = "This work is now licensed under the GNU General Public License, in version 3."
    assert [n for n, *_ in scan(changed)] == ["GPL-3.0"]
    assert [n for n, *_ in scan("Licensed under CC BY-NC 4.0. " * 3)] == ["CC-BY-NC-4.0"] * 3
    for clean in ("All the rights of man", "the general public at work", "license to the apache", "", None, "mit by " * 500):
        assert scan(clean) == []


def test_licences_are_told_apart():
    scan = lic.Scanner(lic.TEMPLATES, lic.REQUIRED).scan
    names = lambda text: [n for n, *_ in scan(text)]
    for name, text in lic.TEMPLATES.items():
        assert [(n, c) for n, c, _, _ in scan(f"Before it. {text} And after it.")] == [(name, 1.0)], name
    assert names("Licensed under CC BY-SA 4.0") == ["CC-BY-SA-4.0"] and names("Licensed under CC BY SA 4.0") == []
    assert names("Licensed under the Apache License, Version 1.1") == ["Apache-1.1-licensed"]
    assert names("Licensed under the Apache License, Version 1.0. See part 2.0") == [] == names("Released under the Foo License.")
    assert names("This work is licensed under the GNU Lesser General Public License, version 2") == []
    gpl = lic.TEMPLATES["GPL-3.0-notice"]
    assert names(gpl.replace("program", "file")) == ["GPL-3.0-notice"] and names(gpl.replace("version 3", "version 4")) == []


def test_whole_licences_with_changes():
    """Coverage is that of the whole text: a tenth of the words changed is found, half of the text is not."""
    scan, rng = lic.Scanner(lic.TEMPLATES, lic.REQUIRED).scan, random.Random(6)
    for name in ("MIT-whole", "BSD-2-Clause-text", "BSD-3-Clause-text", "ISC-text", "MPL-2.0-text", "GPL-3.0-text"):
        words = lic.TEMPLATES[name].split()
        kept = {w for p in lic.REQUIRED[name] for w in p.split()}
        changed = [w if rng.random() < 0.9 or w.lower().strip(",.") in kept else "other" for w in words]
        found = scan("x " * 300 + " ".join(changed) + " y" * 300)
        assert [n for n, *_ in found] == [name] and 0.85 < found[0][1] < 1, (name, [f[:2] for f in found])
        assert name not in [n for n, *_ in scan(" ".join(words[: len(words) // 2]))]


def test_license_rows(frame):
    notice = lic.TEMPLATES["MIT"]
    rows = [(1, f"a {notice} b"), (2, None), (3, ""), (None, notice), (1, f"a {notice} b"), (4, "word " * 5000 + notice)]
    out = lic.license_scan(frame(rows)).collect()
    assert len(out) == 6 and sum(r.license == "MIT" for r in out) == 4
    assert {r.start for r in out if r.doc_id == 1} == {2} and all(r.matched == notice[:-1] for r in out if r.license)
    assert {r.start for r in out if r.doc_id == 4} == {25_000} and lic.license_scan(frame([])).count() == 0


def test_license_query_finds_every_notice(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    wanted = {(d.doc_id, n): d.text.count(t) for d in docs for n, t in lic.TEMPLATES.items() if t in d.text}
    found = {}
    for r in lic.op8_license_scan(spark, sf).collect():
        if r.license:
            found[r.doc_id, r.license] = found.get((r.doc_id, r.license), 0) + 1
    assert found == wanted


def check_pieces(rows, texts):
    """Exact round trip: every id of every row of ``texts`` lies in one piece."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(pack.TOKENIZER))
    sequences, docs = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    assert set(docs) == {d for d, _ in texts}
    for doc, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(docs[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    filled = [sum(n for _, n in p) for p in sequences.values()]
    return sum(0 if n & (n - 1) == 0 else 2048 - n for n in filled), sum(filled)


def test_packing_round_trip(frame):
    rng = random.Random(3)
    texts = [(k, " ".join(rng.choice(["tea", "Ünder", "12", "<|endoftext|>", "  "]) for _ in range(n))) for k, n in enumerate(
        [0, 1, 5, 100, 255, 256, 257, 600, 1200, 2047, 2048, 5000, 9000] + [rng.randint(1, 900) for _ in range(60)]
    )]
    texts += [(500, None), (501, ""), (None, "a null id"), (502, " " * 3000), (503, "🎉" * 900)]
    padded, total = check_pieces(pack.packing(frame(texts).coalesce(1)).collect(), texts)
    assert padded <= 2048 and total > 20_000


def test_packing_repeats_and_empty(frame):
    assert pack.packing(frame([])).count() == 0
    rows = pack.packing(frame([(1, "same"), (1, "same")])).collect()
    assert [r.length for r in rows] == [rows[0].doc_tokens] * 2


def test_steps_are_balanced(spark):
    rows = pack.op9_packing(spark, "/root/testdata/sf0.01").collect()
    steps = {}
    for r in rows:
        steps[r.step_group] = steps.get(r.step_group, 0) + r.length
    assert sum(n == pack.STEP_TOKENS for n in steps.values()) >= len(steps) - 2
    texts = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    padded, total = check_pieces(rows, texts)
    assert padded / total < 0.01
