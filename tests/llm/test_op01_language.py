import zlib

import numpy as np
import pytest

from civiframe.llm import op01_language_id as op


def longest_phrases(text, sample):
    """Phrases by brute force: the longest prefix that occurs in the sample, at least one character."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        count, at = count + 1, end
    return count


def test_automaton_accepts_substrings_only():
    text = "abcbcabab"
    moves = op.suffix_automaton([ord(c) for c in text])

    def accepts(word):
        state = 0
        for c in word:
            if ord(c) not in moves[state]:
                return False
            state = moves[state][ord(c)]
        return True

    every = {text[a:b] for a in range(len(text)) for b in range(a + 1, len(text) + 1)}
    assert all(accepts(w) for w in every)
    assert not any(accepts(w) for w in ("ac", "bb", "abcc", "cbb", "x"))


def test_phrases_match_brute_force():
    samples = {"a": "the cat sat on the mat and that was that", "b": "der hund und die katze sind da"}
    parser = op.CrossParser(samples)
    for text in ("the hat and the cat", "die katze und der hund", "zzz", "a", "thatthatthat was"):
        points = op.normalised(text)
        lanes = parser.codes[points].astype(np.int32)[:, None]
        found = parser.phrases(lanes, np.array([len(points)]))[0]
        wanted = [longest_phrases([*points.tolist()], None) for _ in ()] or [
            longest_phrases("".join(map(chr, points)), "".join(map(chr, op.normalised(s)))) for _, s in sorted(samples.items())
        ]
        assert found.tolist() == wanted, text


def test_segments_and_batches_do_not_matter(monkeypatch):
    parser = op.CrossParser({"a": "the cat sat on the mat", "b": "der hund und die katze"})
    texts = ["the cat " * 400, None, "", "katze", "...", "der hund " * 100]
    before = parser.predict(texts)
    monkeypatch.setattr(op, "LANES", 2)
    after = parser.predict(texts)
    assert before[0] == after[0] == ["a", "und", "und", "b", "und", "b"]
    np.testing.assert_allclose(before[1], after[1])
    assert ((before[1] >= 0) & (before[1] <= 1)).all()


def test_edge_rows(frame):
    rows = [(1, "the cat", "en"), (2, None, "en"), (3, "", None), (None, "der hund", "de"), (6, "123 %%", "de"), (1, "the cat", "en")]
    out = op.language_id(frame(rows + [(k, "the cat sat on the mat", "en") for k in range(10, 20)])).collect()
    assert len(out) == 16
    by = {r.doc_id: r for r in out}
    assert by[2].lang_pred == by[3].lang_pred == by[6].lang_pred == "und" and by[2].score == 0
    assert by[None].held_out and by[1].lang_pred == "en"
    assert by[1].held_out == (zlib.crc32(b"1") % 5 == 0)


def test_empty_and_unlabelled(frame):
    assert op.language_id(frame([])).count() == 0
    assert [r.lang_pred for r in op.language_id(frame([(1, "abc")])).collect()] == ["und"]


def test_keep_identified_keeps_columns(frame):
    docs = frame([(k, "the cat sat", "en") for k in range(12)] + [(99, "---", "en")])
    kept = op.keep_identified(docs)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == set(range(12))


@pytest.mark.parametrize("scale", ["/root/testdata/sf0.01"])
def test_held_out_accuracy(spark, scale):
    rows = op.op1_language_id(spark, scale).join(spark.read.parquet(f"{scale}/documents.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95
