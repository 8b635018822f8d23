import duckdb
import pytest

import corpus_pipeline
from civiframe import llm
from civiframe.llm import op04_simhash, op09_packing
from civiframe.session import Staged
from tools.check_oracle import compare

from .test_op06_lines import brute, certain
from .test_op08_op09 import check_pieces


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    work = Staged(spark)
    states = [docs]
    for name, stage in corpus_pipeline.STAGES:
        states.append(work.put(stage(spark, states[-1], sf), name))
    before, identified, lines, single, mixed, packed = states
    for state in states[1:-1]:
        assert state.schema == before.schema
    letters = {r.doc_id for r in before.collect() if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in identified.collect()} == letters
    table = [(r.doc_id, r.text) for r in identified.collect()]
    # the lines that must go are gone and the others stay in order (test_op06_lines bounds what may go)
    gone = brute(table, certain)
    kept = {r.doc_id: r.text.split("\n") for r in lines.collect()}
    assert kept.keys() == dict(table).keys()
    for d, t in table:
        rest = iter(x for k, x in enumerate(t.split("\n")) if k not in gone.get(d, []))
        assert kept[d] == [""] or all(x in rest for x in kept[d]), d
    groups = {r.doc_id: r.component_id for r in op04_simhash.simhash_near_dedup(lines).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for c in groups.values()})
    words = lambda df: sum(len(r.text.split()) for r in df.collect())
    assert words(mixed) == pytest.approx(1.5 * words(single), rel=0.02)
    pieces, texts = packed.collect(), mixed.collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in texts}
    assert sum(p.length for p in pieces) == sum(len(op09_packing.encode(r.text, *paths())) for r in texts)
    work.drop()


def paths():
    import public_tokenizers

    return [public_tokenizers.path(p) for p in (op09_packing.TOKENIZER, op09_packing.RANKS)]


def test_run(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and max(r.offset + r.length for r in rows) <= 2048


def test_packing_of_the_first_stage(spark, sf):
    docs = corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    check_pieces(corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect(), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    message, fine = compare(spark, con, name, llm.QUERIES[name], llm.ORACLE[name], sf)
    assert fine, message
