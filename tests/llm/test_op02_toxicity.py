import random

from civiframe.llm import op02_toxicity as op


def distance_to_prefix(word, term):
    """Fewest edits that turn some beginning of the word into the term."""
    before = list(range(len(term) + 1))
    best = before[-1]
    for i, c in enumerate(word, 1):
        now = [i]
        for j, t in enumerate(term, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (c != t)))
        before = now
        best = min(best, before[-1])
    return best


def test_automaton_matches_brute_force():
    rng = random.Random(3)
    terms = ["abac", "bcabb", "caab", "abacab"]
    edits = [0, 2, 1, 1]
    automaton = op.LexiconAutomaton(terms, edits)
    for _ in range(3000):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 9)))
        found = [(d, k) for k, t in enumerate(terms) if (d := distance_to_prefix(word, t)) <= edits[k]]
        match = automaton.match(word)
        assert (match is None) == (not found), word
        if found:
            assert match[0] == min(found)[0], word


def scorer():
    return op.Scorer(["loser", "idiot"], [1.0, 1.0], [1, 1], frozenset({"closer"}), (-4.0, 8.0, 0.0))


def test_misspelling_and_quotation():
    s = scorer()
    plain, spelled, quoted, said = (s.features(t)[0] for t in ("you loser", "you l0ser!", 'the word " loser " here', "she said loser"))
    assert plain > spelled > 0 and plain > quoted > 0 and plain > said > 0
    assert s.features("closer and close") == (0.0, 0.0)
    assert s.features("you loser, you idiot")[0] > 2 * plain
    assert s.features(None) == s.features("") == (0.0, 0.0)


def test_words_behind_inner_marks_are_read():
    s = scorer()
    plain = s.features("idiot")
    for text in ("you,idiot", "fool/idiot", "so...idiot", "<b>idiot</b>", "那,idiot。", "_idiot_", "idiot's", "x-idiot-like"):
        assert s.features(text) == plain, text
    assert s.features("said—idiot") == s.features("said idiot") and s.features("said—idiot") < plain
    assert s.features("you,id*ot") == s.features("id*ot") == s.features("idi0t") > (0.0, 0.0)
    assert len(s.hits("idiot,loser/l0ser")[1]) == 3 and s.features("idiot,loser")[0] > 2 * plain[0]
    for clean in ("you,closer", "and/or", "...", "a,b;c" * 1000):
        assert s.features(clean) == (0.0, 0.0), clean


def test_terms_are_chosen_by_evidence():
    counts = [("los", 60, 40), ("lose", 50, 9), ("loser", 50, 0), ("losers", 20, 0), ("the", 90, 900), ("idi", 40, 0), ("idiot", 40, 0)]
    assert [t for t, _, _ in op.choose_terms(counts, 100, 1000)] == ["loser", "idiot"]


def _rows(frame, spark):
    docs, labels = [], []
    for k in range(200):
        toxic = k % 5 == 0
        docs.append((k, "some words here " * 5 + ("you are a loser and an idiot" if toxic else "and nothing else")))
        labels.append((k, 1, int(toxic)))
    return frame(docs + [(900, "what a l0ser, idi0t"), (901, None), (902, ""), (None, "fine"), (900, "what a l0ser, idi0t")]), (
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    )


def test_whole_operator(frame, spark):
    docs, labels = _rows(frame, spark)
    out = op.toxicity(docs, labels).collect()
    assert len(out) == 205
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None and r.doc_id < 200:
            assert r.predicted == (r.doc_id % 5 == 0)
    by = {r.doc_id: r for r in out}
    assert by[900].predicted == 1 and by[901].score == by[902].score and by[None].held_out


def test_without_labels(frame, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.predicted for r in op.toxicity(frame([(1, "loser")]), none).collect()] == [0]
    assert op.toxicity(frame([]), none).count() == 0


def test_scores_do_not_depend_on_the_sample_bound(frame, spark, monkeypatch):
    """A table and the same table repeated past the bound give the same scores, with terms and without."""
    monkeypatch.setattr(op, "SAMPLE_ROWS", 400)
    rng = random.Random(4)
    for term in ("idiot", "word"):  # the second tells nothing
        base = []
        for k in range(400):
            toxic = k % 10 == 0
            said = term if rng.random() < (0.7 if toxic else 0.03) else "word"
            base.append((int(toxic), f"some {said} and another {said if rng.random() < 0.5 else 'word'}"))
        texts = ["you idiot", "nothing at all"]
        found = []
        for times in (1, 20):
            rows = [(k, text) for k, (_, text) in enumerate(base * times)]
            labels = [(k, 1, toxic) for k, (toxic, _) in enumerate(base * times)]
            asked = frame(rows + [(-1 - k, t) for k, t in enumerate(texts)])
            out = op.toxicity(asked, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).where("doc_id < 0").collect()
            found.append([(r.score, r.predicted) for r in sorted(out, key=lambda r: -r.doc_id)])
        assert [p for _, p in found[0]] == [p for _, p in found[1]], found
        assert max(abs(a - b) for (a, _), (b, _) in zip(*found)) < 0.1, found


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = op.op2_toxicity(spark, folder).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted and r.toxic for r in rows)
    assert right / sum(r.toxic for r in rows) > 0.9 and right / sum(r.predicted for r in rows) > 0.8
