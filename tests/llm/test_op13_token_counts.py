import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from civiframe.llm import op13_token_counts as op

PATH = public_tokenizers.path(op.MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "   ", "\n", " \n ", "a\n b", "▁", "a▁▁b", "<s>a</s><unk>", "x\t\x00y", "日本語 テキスト", "ﬁ①é²", "’s “q”", "　a b",
       "12345 67.8", "a" * 3000, "ab" * 2000 + " ", "://www.x.com/?a=b&c", "{}();//--==", "\U0001f600\U0001f468‍\U0001f469", "é", "\r\n\r\n"]


def count(text):
    return len(LIBRARY.encode(text)) if text else 0


def summed(text):
    known = op.pre_tokens(PATH)
    found = known.frequencies(text)
    return sum(n * k for n, k in zip(found.values(), known.pieces(list(found))))


def test_odd_texts():
    for text in ODD:
        assert summed(text) == count(text), text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    assert summed(text) == count(text)


def test_pieces_beside_each_other():
    """Pieces of the vocabulary in random order hit every kind of border."""
    rng = random.Random(1)
    pieces = [LIBRARY.id_to_piece(i).replace(op.BLANK, " ") for i in range(259, LIBRARY.get_piece_size())]
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 12)))
        assert summed(text) == count(text), text


def test_table(spark, frame, monkeypatch):
    """Equal to the library row by row, with the list of frequent pre-tokens too small for most."""
    monkeypatch.setattr(op, "HEAD", 5)
    monkeypatch.setattr(op, "GATHERED", 7)
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "no id"), (None, None), (3, None), (3, "a b c"), (3, "a b c")] + [(100 + k, "one copy of many") for k in range(50)]
    got = op.token_counts(frame(rows), limit=3)
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    wanted = [(d, len((t or "").encode()), count(t), count(t) > 3) for d, t in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(wanted, key=str)


def test_empty_table(frame):
    assert op.token_counts(frame([])).collect() == []


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op.op13_token_counts(spark, sf).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {d: count(t) for d, t in texts.items()} and len(got) == len(texts)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.normalizer_spec.remove_extra_whitespaces = True
    other = tmp_path / "other.model"
    other.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        op.PreTokens(str(other))
