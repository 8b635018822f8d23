import random
import re
from collections import Counter
from functools import cache

import pytest
import xxhash

from civiframe.llm import op06_lines as op
from civiframe.session import Staged


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


@cache
def simhash(norm):
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in norm.split(" ")]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def normal(line):
    return re.sub(r"[\W_]+", " ", line.lower()).strip(" ")


def one_gap(a, b):
    """Whether two lines agree outside of one gap of at most a fifth of each (or one is the other without a word)."""
    a, b = sorted((a.split(" "), b.split(" ")), key=len)
    if len(b) - len(a) > 1:
        return False
    head = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    tail = next((k for k, (x, y) in enumerate(zip(a[::-1], b[::-1])) if x != y), len(a))
    size = max(len(b) - head - tail, 0)
    if len(a) < len(b):
        return size <= 1 and len(a) < op.SHORT and len(b[head]) + 1 <= 0.2 * len(" ".join(b)) + 1e-9
    fits = lambda x: len(" ".join(x[head : len(x) - tail])) <= 0.2 * len(" ".join(x)) + 1e-9
    return size <= 1 and fits(a) and fits(b)


def brute(rows, near):
    """Removed line numbers of each (doc_id, text); ``near`` tells which distinct lines to link."""
    seen = {}
    for doc, text in rows:
        for k, line in enumerate((text or "").split("\n") if text is not None else []):
            if normal(line):
                seen.setdefault(normal(line), set()).add((doc, k))
    lines = list(seen)
    fuzzy = [len(x.split(" ")) >= op.MIN_WORDS for x in lines]
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(lines)):
        for j in range(i):
            if fuzzy[i] and fuzzy[j] and find(i) != find(j) and near(lines[i], lines[j]):
                root[find(i)] = find(j)
    groups = {}
    for k, x in enumerate(lines):
        groups.setdefault(find(k), []).extend(seen[x])
    removed = {}
    for members in groups.values():
        for doc, k in sorted(members, key=lambda o: (o[0] is not None, o[0] or 0, o[1]))[1:]:
            removed.setdefault(doc, []).append(k)
    return {d: sorted(k) for d, k in removed.items()}


def similar(a, b):
    if min(len(a), len(b)) < op.SIMILARITY * max(len(a), len(b)):
        return False
    if sum((Counter(a) & Counter(b)).values()) < op.SIMILARITY * max(len(a), len(b)) - 1e-9:
        return False  # fewer letters in common than a similar line has
    return distance(a, b) <= (1 - op.SIMILARITY) * max(len(a), len(b)) + 1e-9


def certain(a, b):
    """Links that the operator must find: one word changed, or SimHashes close."""
    return one_gap(a, b) or (bin(simhash(a) ^ simhash(b)).count("1") <= op.RADIUS and similar(a, b))


def rows():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 6)))
    base = [[word() for _ in range(40)] for _ in range(4)]
    out = []
    for k in range(60):
        lines = []
        for b in base:
            own = list(b)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                own[rng.randrange(len(own))] = word()
            lines.append(" ".join(own).upper() if k % 7 == 0 else ", ".join(own))
        rng.shuffle(lines)
        out.append((k, "\n".join(lines[: rng.randint(1, 4)] + ["too short"] * (k % 3) + [" ".join(word() for _ in range(9))])))
    return out + [(100, None), (101, ""), (102, "\n\n"), (103, "one two three four"), (None, " ".join(base[0])), (104, out[0][1])]


def as_groups(removed):
    return {(doc, k) for doc, gone in removed.items() for k in gone}


def found(table, frame):
    return as_groups({r.doc_id: r.removed for r in op.line_dedup(frame(table)).collect()})


def test_against_brute_force(frame):
    """Between the links that must be found and all that are similar; texts follow the removed lines."""
    table = rows()
    out = {r.doc_id: r for r in op.line_dedup(frame(table)).collect()}
    got = as_groups({d: r.removed for d, r in out.items()})
    must, may = as_groups(brute(table, certain)), as_groups(brute(table, similar))
    assert len(must) > 60 and must <= got <= may
    for doc, text in table:
        gone = out[doc].removed
        if text is None:
            assert out[doc].text is None
        else:
            assert out[doc].text == "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)


def test_leader_links_are_not_needed(frame, monkeypatch):
    """The open search alone gives the same groups."""
    table = rows()
    with_leaders = found(table, frame)
    monkeypatch.setattr(op, "leader_candidates", lambda lines: lines.selectExpr("h as a", "h as b").limit(0))
    assert with_leaders == found(table, frame)


@pytest.mark.parametrize("change", ["replace", "insert", "delete"])
def test_recall_by_edit_similarity_alone(frame, spark, change):
    """Of lines of the provided table and the same with one word changed, similarity kept, 0.9 are found in each class of length."""
    rng = random.Random(5)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").where("text is not null").collect()
    lines = sorted({normal(x) for r in docs for x in r.text.split("\n")})
    rng.shuffle(lines)
    vocabulary = [w for x in lines[:2000] for w in x.split(" ")]
    table, classes = [], {}
    for low, high in ((6, 9), (10, 19), (20, 49), (50, 99)):
        taken = 0
        for line in lines:
            words = line.split(" ")
            if taken == 60 or not low <= len(words) <= high:
                continue
            at = rng.randrange(len(words))
            other = words[:at] + ([] if change == "delete" else [rng.choice(vocabulary)]) + words[at + (change != "insert") :]
            if other != words and similar(line, " ".join(other)):
                classes[len(table)] = low
                table.append((2 * len(table), line, " ".join(other)))
                taken += 1
    got = found([(d, a) for d, a, _ in table] + [(d + 1, b) for d, _, b in table], frame)
    for low in (6, 10, 20, 50):
        own = [k for k, c in classes.items() if c == low]
        assert sum((2 * k + 1, 0) in got for k in own) >= 0.9 * len(own), low


def test_a_family_of_single_lines_is_linear(frame):
    """Lines that differ in one number meet one line of their key, not each other."""
    words = " ".join(f"word{k}" for k in range(60))
    counts = []
    for size in (100, 400):
        docs = frame([(k, f"{words[:200]} {k * 7919} {words[200:]}") for k in range(size)])
        with Staged(docs.sparkSession) as work:
            lines = work.put(op.distinct_lines(docs), "lines")
            links, wide = op.gap_links(lines, work)
            opened = op.still_open(op.block_keys(op.with_components(op.simhashes(lines), links, work)), work)
            counts.append(links.count() + wide.count())
            assert opened.count() == 0
    assert counts[1] <= 4.2 * counts[0] and counts[1] < 400 * 24


def test_edges(frame):
    text = "a line of exactly six words\nb"
    out = op.line_dedup(frame([(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.removed) for r in out) == [(1, []), (1, []), (2, [0, 1])]
    assert op.line_dedup(frame([])).count() == 0
    docs = frame([(1, text, "en", "s", 30), (2, text, "en", "s", 30)])
    kept = op.dedup_lines(docs)
    assert kept.schema == docs.schema and {(r.doc_id, r.text, r.n_chars) for r in kept.collect()} == {(1, text, 30), (2, "", 0)}


def test_gaps_are_measured_without_decimals(spark):
    """A word of more than 35 % is no gap of 5 words; of 16 words no part above a fifth is left."""
    rows = [(1, "ab cd ef gh ijklmno", 5), (2, " ".join(["ab"] * 15 + ["abcdefghijklmnopqrstuvwxyz"]), 16)]
    lines = spark.createDataFrame(rows, "h long, norm string, words int").selectExpr("*", "length(norm) as len")
    keys = op.gap_keys(lines)
    assert "decimal" not in keys._jdf.queryExecution().optimizedPlan().toString()
    found = Counter((r.h, r.narrow) for r in keys.collect())
    assert found[1, True] == 4 and found[2, False] == 0 and found[2, True] > 0
    assert found[1, False] == 0


def test_costly_steps_are_computed_once(spark):
    """Neither the pattern nor a key stands in a filter as well; texts that keep all lines are not shuffled."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    docs = spark.createDataFrame([(1, "one line\nanother")], "doc_id long, text string")
    assert plan(op.lines_of(docs)).count("regexp_replace") == 1
    lines = spark.createDataFrame([(1, "ab cd ef gh ij", 14, 5)], "h long, norm string, len int, words int")
    keyed = op.passing(op.gap_keys(lines), "key", spark.range(3).selectExpr("id as key"))
    assert plan(keyed).count("xxhash64") == 1
    assert "Union" in plan(op.line_dedup(docs))


def test_marks_become_single_blanks(spark):
    rng = random.Random(3)
    letters = "abAΣσİıßÉé  \t\n\n\r.,-!٣²Ⅷ中文ั่😀\u0345\x0b\x00"
    rows = [(k, "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    each = docs.selectExpr("doc_id", r"posexplode(split(text, '\n')) as (line_no, line)")
    wanted = each.selectExpr("doc_id", "line_no", r"trim(regexp_replace(lower(line), r'[^\p{L}\p{N}]+', ' ')) as norm").where("norm <> ''")
    got = op.lines_of(docs).select("doc_id", "line_no", "norm")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))


def test_simhashes_of_short_and_very_long_lines(spark):
    rng = random.Random(2)
    norms = [" ".join(f"w{rng.randrange(900)}" for _ in range(n)) for n in (5, 6, 40, 41, op.COUNTED, op.COUNTED + 1)] + [" ".join(["same"] * op.COUNTED)]
    docs = spark.createDataFrame(list(enumerate(norms)), "doc_id long, text string")
    got = sorted(r.sim % (1 << 64) for r in op.simhashes(op.distinct_lines(docs)).collect())
    assert got == sorted(map(simhash, norms))


def test_short_lines_repeat_exactly(frame):
    """Equal lines go whatever their length; blank lines stay."""
    han, thai = "这是一行没有空格的很长的文字它在两个文件里都出现", "นี่คือบรรทัดยาวที่ไม่มีช่องว่าง"
    rows = [(1, f"Share this\n\n{han}\nb\n{thai}"), (2, f"share  THIS!\n\n{han}。\nshare that"), (3, f"share this\nb\nB\n{thai}"), (None, "---\n---")]
    out = {r.doc_id: r.text for r in op.dedup_lines(frame(rows)).collect()}
    assert out == dict(rows) | {2: "\nshare that", 3: ""}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_provided_table(spark, folder):
    table = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    must = brute(table, certain)
    for r in op.op6_line_dedup(spark, folder).collect():
        assert r.n_removed >= len(must.get(r.doc_id, []))


def test_only_shared_halves_give_gap_keys(spark):
    """Of 400 lines without a common half no key is left; keys that lines share are those of all keys, at every length."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7)))
    apart = [" ".join(word() for _ in range(rng.randint(16, 40))) for _ in range(400)]
    near = []
    for size in [*range(op.MIN_WORDS, 40), 64, 65, 130]:
        base = [word() for _ in range(size)]
        for at in range(size):
            near.append(" ".join(base[:at] + [word()] + base[at + 1 :]))
            near.append(" ".join(base[:at] + [word()] + base[at:]))

    def lines(norms):
        return op.distinct_lines(spark.createDataFrame(list(enumerate(norms)), "doc_id long, text string")).cache()

    def shared(keyed):
        members = {}
        for r in keyed.collect():
            members.setdefault(r.key, set()).add((r.h, r.narrow))
        return {k: m for k, m in members.items() if len({h for h, _ in m}) > 1}

    with Staged(spark) as work:
        assert op.keys_beside(op.shared_halves(lines(apart), work)).count() == 0
        assert shared(op.keys_beside(op.shared_halves(lines(near), work))) == shared(op.gap_keys(lines(near))) != {}


def test_word_edits_bound_the_distance(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 4)))
    rows = []
    for _ in range(400):
        a = [word() for _ in range(rng.randint(1, 12))]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = [word()] * rng.randint(0, 1) or b[at + 1 : at + 2]
        rows.append((" ".join(a), " ".join(b) or "a"))
    long = "x" * (op.WORD + 1)
    rows += [(f"{long} a", f"{long}y a"), ("a", "b c d"), ("a b c", "c"), ("one two three four", "one three four")]
    got = spark.createDataFrame(rows, "x string, y string").selectExpr("x", "y", f"{op.word_edits('x', 'y')} as edits").collect()
    assert all(r.edits >= distance(r.x, r.y) for r in got) and all(r.edits == 0 for r in got if r.x == r.y)
    assert sum(r.edits == distance(r.x, r.y) for r in got) > 200
    assert {r.x: r.edits for r in got}["one two three four"] == 4


def test_frequent_lines_keep_their_simhash(frame):
    """Copies of a line neither overflow the counts nor change the links."""
    text = " ".join(f"word{k}" for k in range(100))
    docs = frame([(k, text) for k in range(700)] + [(1000, text.replace("word50", "other"))])
    with Staged(docs.sparkSession) as work:
        every = work.put(op.occurrences(docs), "lines")
        prints = {(r.h, r.sim) for r in op.simhashes(every.selectExpr("*", "1 as n")).collect()}
        assert sorted(s % (1 << 64) for _, s in prints) == sorted({simhash(text), simhash(text.replace("word50", "other"))})
    out = {r.doc_id: r.removed for r in op.line_dedup(docs).collect()}
    assert out.pop(0) == [] and all(r == [0] for r in out.values())


def test_texts_are_read_by_size_and_halves_without_them(spark):
    """Who needs short lines reads no long ones; which halves are shared is told from hashes alone."""
    rng = random.Random(7)
    norms = [" ".join(f"w{rng.randrange(300)}" for _ in range(n)) for n in (1, 4, 5, op.SHORT, op.SHORT + 1, op.FEW_COUNTED, op.FEW_COUNTED + 1, 300) for _ in range(3)]
    docs = spark.createDataFrame(list(enumerate(norms)), "doc_id long, text string")
    with Staged(spark) as work:
        every = work.put(op.by_size(op.occurrences(docs)), "lines")
        assert sorted(r.norm for r in op.sized(every, 1, op.ANY).collect()) == sorted(norms)
        got = {r.h: r.sim % (1 << 64) for r in op.simhashes(every.selectExpr("*", "1 as n")).collect()}
        assert sorted(got.values()) == sorted(map(simhash, norms))
        read = lambda df: set(re.findall(r"norm\d", df._jdf.queryExecution().executedPlan().toString()))
        assert read(op.dropped_words(every)) == {"norm0"}
        assert read(op.sized(every, op.FEW_COUNTED + 1, op.COUNTED).select("norm")) == {"norm2"}
        plans = []
        put = work.put
        work.put = lambda df, name: plans.append(df) or put(df, name)
        op.shared_halves(every, work)
        assert not read(plans[0]) and "substring_index" not in plans[0]._jdf.queryExecution().optimizedPlan().toString()


def test_beginnings_are_no_farther_apart_than_texts(spark):
    """Texts within the edits pass, at every length and difference of lengths; unrelated ones do not."""
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    rows = []
    for k in range(600):
        a = text(rng.randint(5, 90))
        b = list(a)
        for _ in range(rng.randint(0, max(1, len(a) // 4))):  # many at one end, so that all else moves
            at = rng.randrange(len(b) + 1) if k % 3 else rng.choice([0, len(b)])
            b[at : at + rng.randint(0, 1)] = [text(1)] * rng.randint(0, 1)
        rows.append((a, "".join(b) or "a"))
    rows += [(text(n), text(n)) for n in range(60, 160)]
    most = "cast(floor(0.2 * greatest(length(x), length(y)) + 1e-9) as int)"
    got = spark.createDataFrame(rows, "x string, y string").selectExpr("x", "y", f"{most} as most", f"{op.near_beginnings('x', 'y', most)} as near").collect()
    similar_ones = [r.near for r in got if distance(r.x, r.y) <= r.most]
    assert len(similar_ones) > 200 and all(similar_ones)
    assert sum(not r.near for r in got[600:]) > 90


def test_unlike_pairs_are_told_apart_before_their_distance(spark):
    """Verified pairs are the similar ones, whether they begin alike or not."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 6)))
    norms = []
    for k in range(60):
        base = [word() for _ in range(40)]
        other = [word() for _ in range(40)] if k % 3 == 0 else [word() for _ in range(8)] + base[8:] if k % 3 == 1 else base[:30] + [word() for _ in range(rng.randint(4, 14))]
        norms += [" ".join(base), " ".join(other)]
    lines = spark.createDataFrame(list(enumerate(norms)), "h long, norm string").selectExpr("*", "40 as words")
    with Staged(spark) as work:
        got = {r.a // 2 for r in op.verified(spark.range(60).selectExpr("2 * id as a", "2 * id + 1 as b"), lines, work).collect()}
    wanted = {k for k in range(60) if similar(norms[2 * k], norms[2 * k + 1])}
    assert got == wanted and 20 < len(wanted) < 40
    begin = lambda k: distance(norms[2 * k][: op.BEGIN], norms[2 * k + 1][: op.BEGIN]) > op.BEGIN * 2 // 5
    assert any(begin(k) for k in wanted)
