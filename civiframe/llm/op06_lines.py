"""Fuzzy line deduplication with DataFrame and SQL functions only.

Lines are normalised (lower case, runs of other characters than letters and digits are
one blank). Equal lines form one group, whatever their length; blank ones stay. Distinct
lines of at least ``MIN_WORDS`` words are linked, at an edit similarity of at least
``SIMILARITY``, in two ways:

* They agree outside of one gap. Leaving out one part of a line (a word of a short line, else one of
  ``PARTS`` runs of words) gives a key of the words before and after it. If the part is short enough that any
  two lines of the key are similar, these are linked without comparison; short lines with a longer
  part are compared with one line of the key. Lines take part at their own number of words and at one less, so
  that an added word keeps a key; short ones are also looked up without each of their words.
* Their 64-bit SimHashes differ in at most ``RADIUS`` bits. Of four 16-bit blocks, two bits
  leave two untouched, so candidates agree in one of six pairs of blocks; edit distance decides.
  Only lines that the gaps leave apart are held against each other, first with the most
  frequent line of their key, so that a group does not become all of its pairs.

Of each connected group the occurrence with the smallest (doc_id, line) stays.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiframe.llm.graph import components
from civiframe.llm.tables import fresh, read
from civiframe.session import Staged

MIN_WORDS = 5
RADIUS = 2
BLOCKS = 4
SIMILARITY = 0.8
#: Lines of fewer words have a gap for every word, longer ones ``PARTS`` gaps.
SHORT = 16
PARTS = 12
#: Share of a short line up to which a gap is tried with the edit distance.
WIDE = 0.35
#: Edits that are tried first.
FEW_EDITS = 12
#: Characters by which pairs are told that are hardly similar.
BEGIN = 40
#: Bits of the filter that lets rows pass whose key may be needed; its size is fixed.
FILTER_BITS = 1 << 24
#: Most words of a line whose bits are counted in 16 bits; the two highest stay free.
COUNTED = (1 << 14) - 1
#: Most words of a line whose bits are counted in 8 bits.
FEW_COUNTED = (1 << 7) - 1
#: More words than a line can have.
ANY = (1 << 31) - 1
#: Words of the lines whose texts are staged together.
SIZES = ((1, SHORT), (SHORT + 1, FEW_COUNTED), (FEW_COUNTED + 1, ANY))
#: Columns of the hashes of a line's halves, by ``2 * (one word less) + side``.
HALVES = ("half0", "half1", "half2", "half3")
#: Words up to this length are compared with each other; longer ones count as changed in full.
WORD = 32


def once(rows: DataFrame, *columns: Column) -> DataFrame:
    """``rows`` with further columns that later filters cannot pull apart and compute again."""
    return rows.select("*", F.inline(F.array(F.struct(*columns))))


def normalised(text: Column) -> Column:
    """Lower-cased runs of letters and digits with a blank between them, line by line.

    Single blanks are left alone, so that only other marks cost a replacement; a line may begin or end with a blank.
    """
    mark = r"[^\p{L}\p{N}\n]"
    return F.regexp_replace(F.lower(text), rf"{mark}(?:(?<! ){mark}*+|{mark}++)", " ")


def lines_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, content, line_no, norm)``: the lines of every text that are not blank once
    normalised; ``content`` is a hash of the text."""
    texts = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("content"), "text")
    texts = once(texts, F.split(normalised(F.col("text")), "\n").alias("lines"))
    each = texts.select("doc_id", "content", F.posexplode("lines").alias("line_no", "line"))
    # a filter on what is trimmed would trim it twice
    return each.where("line not in ('', ' ')").select("doc_id", "content", "line_no", F.trim("line").alias("norm"))


def occurrences(docs: DataFrame) -> DataFrame:
    """``(doc_id, content, line_no, h, norm, len, words)`` and the ``half_hashes`` of every line that is not blank."""
    words = F.expr("octet_length(norm) - octet_length(replace(norm, ' ', '')) + 1").alias("words")
    lines = once(lines_of(docs).select("*", F.xxhash64("norm").alias("h")), F.length("norm").alias("len"), words)
    return with_cells(lines).select("doc_id", "content", "line_no", "h", "norm", "len", "words", *half_hashes())


def distinct_lines(docs: DataFrame) -> DataFrame:
    """``(h, norm, n, len, words)`` and the ``half_hashes`` of every distinct line; ``n``: occurrences."""
    return occurrences(docs).groupBy("h", "norm", "len", "words", *HALVES).agg(F.count("*").alias("n"))


def by_size(lines: DataFrame) -> DataFrame:
    """``lines`` with a column of texts for each of ``SIZES``, so that who needs lines of one size reads no others."""
    texts = [F.when(F.col("words").between(low, high), F.col("norm")).alias(f"norm{k}") for k, (low, high) in enumerate(SIZES)]
    return lines.select(*[c for c in lines.columns if c != "norm"], *texts)


def sized(lines: DataFrame, least: int, most: int) -> DataFrame:
    """The lines of ``least`` to ``most`` words, with ``norm`` if they went through ``by_size``."""
    some = lines.where(F.col("words").between(least, most))
    if "norm" in lines.columns:
        return some
    texts = [f"norm{k}" for k, (low, high) in enumerate(SIZES) if low <= most and least <= high]
    return some.withColumn("norm", F.coalesce(*texts))


def simhashes(lines: DataFrame) -> DataFrame:
    """``(h, n, len, sim)`` of every row of ``lines``.

    Every sum holds the counts of 64 / width bits in fields of ``width`` bits; a number added to all fields
    lifts those above half the words to the field's last bit (the last field is taken by itself, as sums are signed).
    """
    parts = []
    for width, least, most in ((8, 1, FEW_COUNTED), (16, FEW_COUNTED + 1, COUNTED), (32, COUNTED + 1, ANY)):
        fields, top = 64 // width, 64 - width
        unit = sum(1 << (width * f) for f in range(fields))
        rows = sized(lines, least, most).select("h", "n", "len", "words", "norm", F.monotonically_increasing_id().alias("row"))
        each = rows.select("h", "n", "len", "words", "row", F.explode(F.split("norm", " ")).alias("w")).withColumn("x", F.xxhash64("w"))
        sums = [F.sum(F.expr(f"shiftrightunsigned(x, {k}) & {unit}L")).alias(f"s{k}") for k in range(width)]
        # copies of a line stay apart, so that no field overflows
        counted = each.groupBy("row", "h", "n", "len", "words").agg(*sums)
        counted = counted.withColumn("lift", F.expr(f"{(1 << (width - 1)) - 1} - words div 2"))
        lower, low_unit = (1 << top) - 1, unit - (1 << top)
        bits = [f"shiftleft(shiftrightunsigned((s{k} & {lower}L) + lift * {low_unit}L, {width - 1}) & {low_unit}L, {k})" for k in range(width)]
        bits += [f"shiftleft(shiftrightunsigned(shiftrightunsigned(s{k}, {top}) + lift, {width - 1}) & 1L, {top + k})" for k in range(width)]
        parts.append(counted.select("h", "n", "len", F.expr(" | ".join(bits)).alias("sim")))
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def _cell(words: str) -> str:
    """SQL for a number of words with its four leading bits only."""
    shift = f"greatest(0, length(bin({words})) - 4)"
    return f"shiftleft(shiftright({words}, {shift}), {shift})"


def _parts() -> list[Column]:
    """``p0`` and ``p1``: the parts of a line at its own number of words ``g0`` and at one less ``g1`` (0: it takes no part there)."""
    return [F.expr(f"if(g0 < {SHORT}, g0, {PARTS})").alias("p0"), F.expr(f"if(g1 <> g0 and g1 >= {SHORT}, {PARTS}, 0)").alias("p1")]


def with_cells(lines: DataFrame) -> DataFrame:
    """``lines`` with the numbers of words ``g0`` and ``g1`` and their ``_parts``."""
    cells = once(lines, F.expr(_cell("words")).alias("g0"), F.expr(_cell("(words - 1)")).alias("g1"))
    return cells.select("*", *_parts())


def halves(lines: DataFrame) -> DataFrame:
    """``(h, norm, len, words, g, p, side)``: each half of a line of at least ``MIN_WORDS`` words, at each number of
    words ``g`` that it takes part at with ``p`` parts. Half 0 is its first words, half 1 its last."""
    return _sides(with_cells(lines).select("*", F.explode(F.expr("sequence(0, if(p1 > 0, 3, 1))")).alias("k")))


def _sides(cells: DataFrame) -> DataFrame:
    first = "if(k < 2, {}, {})".format
    return cells.selectExpr("h", "norm", "len", "words", first("g0", "g1") + " as g", first("p0", "p1") + " as p", "k % 2 as side")


def half_hashes() -> list[Column]:
    """``HALVES`` of lines ``with_cells``; null where a line takes no part."""
    columns = []
    for k, name in enumerate(HALVES):
        g, p, takes = ("g0", "p0", f"words >= {MIN_WORDS}") if k < 2 else ("g1", PARTS, f"words >= {MIN_WORDS} and p1 > 0")
        ahead = f"cast({p} div 2 * {g} div {p} as int)"
        columns.append(F.expr(f"if({takes}, xxhash64(substring_index(norm, ' ', {ahead if k % 2 == 0 else f'{ahead} - {g}'}), {k % 2}, {g}), null)").alias(name))
    return columns


def shared_halves(lines: DataFrame, work: Staged) -> DataFrame:
    """The halves that occur in several lines. A gap lies in one half, so lines of one key have the other one in common."""
    each = lines.select("h", F.explode(F.array(*HALVES)).alias("half")).where("half is not null")
    shared = each.groupBy("half").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("half")
    shared = work.put(shared, "shared-halves")
    texts = sized(lines, MIN_WORDS, ANY).select("h", "norm", "len", "words", F.posexplode(F.array(*HALVES)).alias("k", "half"))
    return _sides(with_cells(passing(texts.where("half is not null"), "half", shared)))


def gap_keys(lines: DataFrame) -> DataFrame:
    """``(h, key, narrow)``: for each part of a line a hash of the words before and after it.

    Parts are the words of lines of fewer than ``SHORT`` words, else ``PARTS`` runs of words.
    Lines of one key differ in the gap only. It is narrow if its characters are at most 1 - ``SIMILARITY``
    of the line: any two lines for which the key is narrow are similar.
    """
    return keys_beside(halves(lines))


def keys_beside(some: DataFrame) -> DataFrame:
    """The ``gap_keys`` whose gap lies in the other half than the one given."""
    parts = "sequence(if(side = 0, cast(p div 2 as int), 0), if(side = 0, p, cast(p div 2 as int)) - 1)"
    gaps = some.select("h", "norm", "len", "words", "g", "p", F.explode(F.expr(parts)).alias("i"))
    gaps = gaps.selectExpr("*", "cast(i * g div p as int) as before", "cast(g - (i + 1) * g div p as int) as after")
    gaps = once(gaps, *around("before", "after"))
    narrow = f"gap <= {round(1 - SIMILARITY, 6)}D * len"  # a double: decimals cost more than the rest of the test
    gaps = gaps.withColumn("gap", F.expr("len - length(head) - length(tail) - if(before > 0, 1, 0) - if(after > 0, 1, 0) - 1e-9D"))
    gaps = gaps.where(f"gap <= if(words < {SHORT}, {WIDE}D, {round(1 - SIMILARITY, 6)}D) * len")
    # of longer lines only narrow gaps are left
    return once(gaps, F.expr("xxhash64(head, tail, g, i)").alias("key"), F.expr(f"words >= {SHORT} or {narrow}").alias("narrow")).select("h", "key", "narrow")


def around(before: str, after: str) -> tuple[Column, Column]:
    """``head`` and ``tail``: the first and last words of a line, ``before`` and ``after`` many."""
    return F.expr(f"substring_index(norm, ' ', {before})").alias("head"), F.expr(f"substring_index(norm, ' ', -({after}))").alias("tail")


def dropped_words(lines: DataFrame) -> DataFrame:
    """``(h, key)``: hashes of lines of at most ``SHORT`` words without one of their words, where the rest is similar."""
    some = sized(lines, MIN_WORDS + 1, SHORT).select("h", "len", "norm", "words")
    each = once(some.select("*", F.explode(F.expr("sequence(0, words - 1)")).alias("at")), *around("at", "words - 1 - at"))
    rest = once(each, F.expr("concat(head, if(at > 0 and at < words - 1, ' ', ''), tail)").alias("rest"))
    near = rest.where(f"len - length(rest) <= {round(1 - SIMILARITY, 6)}D * len + 1e-9D")
    return once(near, F.expr("xxhash64(rest)").alias("key")).select("h", "key")


def marked(rows: DataFrame, column: str, wanted: DataFrame, mark: str) -> DataFrame:
    """``rows`` with ``mark``: false if the 64-bit ``column`` does not occur in that of ``wanted``, by a
    filter of fixed size with a bit for each value that occurs."""
    word, bits = fresh("word"), fresh("bits")
    bit = f"pmod({column}, {FILTER_BITS})"
    at = F.expr(f"cast({bit} div 64 as int)")
    # at most FILTER_BITS / 64 rows
    bitmap = wanted.groupBy(at.alias(word)).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({bit} % 64 as int))")).alias(bits))
    joined = rows.withColumn(word, at).join(F.broadcast(bitmap), word, "left")
    return joined.withColumn(mark, F.expr(f"coalesce((shiftrightunsigned({bits}, cast({bit} % 64 as int)) & 1L) = 1, false)")).drop(word, bits)


def passing(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose 64-bit ``column`` may occur in that of ``wanted``; most others are kept from a shuffle."""
    mark = fresh("mark")
    return marked(rows, column, wanted, mark).where(mark).drop(mark)


def gap_links(lines: DataFrame, work: Staged) -> tuple[DataFrame, DataFrame]:
    """Links ``(a, b)`` of lines with one line of each of their narrow gap keys and with what
    stays without a word; and candidates ``(a, b)`` by keys that are not narrow."""
    keyed = work.put(keys_beside(shared_halves(lines, work)).distinct(), "gap-keys")
    least = F.coalesce(F.min(F.when(F.col("narrow"), F.col("h"))), F.min("h"))
    shared = keyed.groupBy("key").agg(least.alias("b"), F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("key", "b")
    shared = work.put(shared, "shared-gaps")
    met = work.put(passing(keyed, "key", shared).join(shared, "key").where("h <> b").select(F.col("h").alias("a"), "b", "narrow").distinct(), "met-in-gaps")
    rest = lines.where(f"words < {SHORT}").select(F.col("h").alias("b"))
    dropped = passing(dropped_words(lines), "key", rest.select(F.col("b").alias("key"))).distinct().join(rest.distinct(), F.col("key") == F.col("b"))
    links = met.where("narrow").select("a", "b").unionAll(dropped.select(F.col("h").alias("a"), "b"))
    return work.put(links.distinct(), "gap-links"), met.where("not narrow").select("a", "b")


def block_keys(lines: DataFrame) -> DataFrame:
    """``lines`` once for each pair of SimHash blocks."""
    block = [f"(shiftrightunsigned(sim, {16 * k}) & 65535L)" for k in range(BLOCKS)]
    keys = [f"{i}L * 4294967296L + {block[a]} * 65536L + {block[b]}" for i, (a, b) in enumerate(combinations(range(BLOCKS), 2))]
    # hashed, as bits of blocks are uneven and the filter takes the last ones
    return lines.withColumn("key", F.explode(F.expr(f"array({', '.join(keys)})"))).withColumn("key", F.xxhash64("key"))


def still_open(keyed: DataFrame, work: Staged) -> DataFrame:
    """The rows of keys whose lines are not all in one component."""
    apart = keyed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    apart = work.put(apart, "open-keys")
    # keys alone are small, and there is one row of each: no side needs sorting
    return work.put(passing(keyed, "key", apart).join(apart.hint("shuffle_hash"), "key"), "open-lines")


def with_components(lines: DataFrame, links: DataFrame, work: Staged) -> DataFrame:
    """``lines`` with ``comp``, the smallest line that each reaches by the links."""
    comp = components(links, work).selectExpr("node as h", "root")
    return lines.drop("comp").join(comp, "h", "left").withColumn("comp", F.coalesce("root", "h")).drop("root")


def _near(a: str, b: str) -> Column:
    return F.expr(
        f"{a}.comp <> {b}.comp and bit_count({a}.sim ^ {b}.sim) <= {RADIUS}"
        f" and least({a}.len, {b}.len) >= {SIMILARITY} * greatest({a}.len, {b}.len)"
    )


def leader_candidates(opened: DataFrame) -> DataFrame:
    """Every line with the most frequent line of its key, if near."""
    leaders = opened.groupBy("key").agg(F.max(F.struct("n", "h", "sim", "len", "comp")).alias("b"))
    return opened.alias("a").join(leaders, "key").where(_near("a", "b")).selectExpr("a.h as a", "b.h as b").distinct()


def open_candidates(opened: DataFrame) -> DataFrame:
    """Near lines of one key that are in different components."""
    a, b = opened.alias("a"), opened.alias("b")
    return a.join(b, (F.col("a.key") == F.col("b.key")) & F.expr("a.h < b.h") & _near("a", "b")).selectExpr("a.h as a", "b.h as b").distinct()


def shared_start(a: str, b: str) -> str:
    """SQL for the length of the common beginning of two texts, by halving steps."""
    steps = ", ".join(str(1 << k) for k in range(30, -1, -1))
    return (
        f"aggregate(filter(array({steps}), s -> s <= least(length({a}), length({b}))), 0,"
        f" (k, s) -> if(k + s <= least(length({a}), length({b})) and substring({a}, k + 1, s) = substring({b}, k + 1, s), k + s, k))"
    )


def _let(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name`` in ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def word_edits(x: str, y: str) -> str:
    """SQL for a number of edits that turns one line into the other, word by word, so at least the edit distance.
    It costs far less: a word that differs is left out if the next one fits, else it is replaced."""
    size, step = "named_struct('j', {}, 'c', {})".format, []
    step.append(f"when get(ys, s.j) is null then {size('s.j', 's.c + length(xs[i]) + 1')}")
    step.append(f"when xs[i] = ys[s.j] then {size('s.j + 1', 's.c')}")
    step.append(f"when xs[i] = get(ys, s.j + 1) then {size('s.j + 2', 's.c + length(ys[s.j]) + 1')}")
    step.append(f"when get(xs, i + 1) = ys[s.j] then {size('s.j', 's.c + length(xs[i]) + 1')}")
    step.append(f"when greatest(length(xs[i]), length(ys[s.j])) <= {WORD} then {size('s.j + 1', 's.c + levenshtein(xs[i], ys[s.j])')}")
    step.append(f"else {size('s.j + 1', 's.c + greatest(length(xs[i]), length(ys[s.j]))')}")
    left = "aggregate(slice(ys, s.j + 1, greatest(size(ys) - s.j, 0)), s.c, (c, w) -> c + length(w) + 1)"
    edits = f"aggregate(sequence(0, size(xs) - 1), {size(0, 0)}, (s, i) -> case {' '.join(step)} end, s -> {left})"
    return _let("xs", f"split({x}, ' ')", _let("ys", f"split({y}, ' ')", edits))


def near_beginnings(x: str, y: str, most: str) -> str:
    """SQL that holds for any two texts within ``most`` edits and fails for most others, at less cost than their distance.

    If as much is left of y as of x, the beginnings are no farther apart than the texts: where the edits match the beginning of x
    to some characters more or less of y, the rests differ by as many in length and need at least as many edits.
    """
    size = f"cast(9 * {most} div 5 as int)"
    return f"levenshtein(substring({x}, 1, {size}), substring({y}, 1, {size} + length({y}) - length({x})), {most}) >= 0"


def verified(candidates: DataFrame, lines: DataFrame, work: Staged) -> DataFrame:
    """The candidates ``(a, b)`` whose edit similarity is enough. The distance is that of
    what lies between the common beginning and the common end."""
    ends = work.put(candidates.selectExpr("a as h").unionAll(candidates.selectExpr("b as h")).distinct(), "candidate-ends")
    texts = work.put(passing(sized(lines, MIN_WORDS, ANY).select("h", "norm"), "h", ends).distinct().join(ends, "h"), "candidate-lines")
    pairs = candidates.join(texts.selectExpr("h as a", "norm as x"), "a").join(texts.selectExpr("h as b", "norm as y"), "b")
    most = f"cast(floor({round(1 - SIMILARITY, 6)} * greatest(length(x), length(y)) + 1e-9) as int)"
    rest = "struct(reverse(substring(x, p + 1)) as x, reverse(substring(y, p + 1)) as y)"
    # the cost grows with the distance allowed: most links need a small one
    within = lambda k: f"levenshtein(e.x, e.y, {k}) >= 0"
    ends = "struct(substring(r.x, q + 1) as x, substring(r.y, q + 1) as y)"
    near = _let("e", ends, f"{within(f'least({FEW_EDITS}, {most})')} or ({most} > {FEW_EDITS} and {within(most)})")
    near = _let("p", shared_start("x", "y"), _let("r", rest, _let("q", shared_start("r.x", "r.y"), near)))
    # most pairs that are not similar begin unlike, and are told apart by their beginnings
    begin = "levenshtein(substring({0}, 1, {2}), substring({1}, 1, {2}), {3}) >= 0".format("x", "y", BEGIN, BEGIN * 2 // 5)
    likely = f"({begin} or {near_beginnings('x', 'y', most)})"
    return pairs.where(f"{likely} and ({word_edits('x', 'y')} <= {most} or {near})").select("a", "b")


def line_links(every: DataFrame, work: Staged) -> tuple[DataFrame, DataFrame]:
    """``(a, b)``: links of distinct lines whose components are the groups of near copies; and ``(h, n)`` of the lines that may be
    linked. ``every``: their occurrences; ``n``: how many."""
    lines = every.where(F.col("words") >= MIN_WORDS)
    links, wide = gap_links(lines, work)
    prints = simhashes(lines.withColumn("n", F.lit(1))).groupBy("h").agg(F.max("len").alias("len"), F.max("sim").alias("sim"), F.sum("n").alias("n"))
    prints = work.put(with_components(prints, links, work), "simhashes")
    opened = still_open(block_keys(prints), work)
    led = work.put(verified(work.put(leader_candidates(opened).union(wide).distinct(), "leader-candidates"), lines, work), "leader-links")
    links = links.unionAll(led)
    rest = still_open(with_components(opened, links, work), work)
    links = links.unionAll(work.put(verified(work.put(open_candidates(rest), "open-candidates"), lines, work), "open-links"))
    return links, prints.select("h", "n")


def removed_lines(docs: DataFrame, work: Staged) -> DataFrame:
    """``(doc_id, content, line_no)`` of every occurrence that goes."""
    every = work.put(by_size(occurrences(docs)), "lines")  # texts are normalised once; no line is shuffled with its text
    links, counts = line_links(every, work)
    # a line of a component has others beside it, any other is repeated if it occurs again
    joined = components(links, work).selectExpr("node as h", "root as group")
    short = every.where(F.col("words") < MIN_WORDS).groupBy("h").agg(F.count("*").alias("n"))
    again = counts.unionAll(short).where("n > 1").selectExpr("h", "h as group")
    repeated = work.put(joined.unionAll(again).groupBy("h").agg(F.min("group").alias("group")), "repeated-lines")
    seen = every.select("doc_id", "content", "line_no", "h")
    placed = work.put(passing(seen, "h", repeated).join(repeated, "h").drop("h"), "repeated-occurrences")
    key = ["doc_id", "content", "line_no"]
    # joined by place, as a group may be large
    kept = placed.groupBy("group").agg(F.min(F.struct(*key)).alias("kept")).select("kept.*")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key]
    return placed.select(*key).alias("a").join(kept.alias("b"), same, "left_anti")


def without_repeated_lines(docs: DataFrame, removed: str) -> DataFrame:
    """``docs`` with the new ``text``, and in the column ``removed`` the line numbers that went (null if none)."""
    doc, content = fresh("doc"), fresh("content")
    with Staged(docs.sparkSession) as work:
        gone = removed_lines(docs.select("doc_id", "text"), work).groupBy(F.col("doc_id").alias(doc), F.col("content").alias(content)).agg(
            F.array_sort(F.collect_set("line_no")).alias(removed)
        )
        gone = Staged(docs.sparkSession).put(gone, "removed-lines")  # read by the plan returned
    # only texts that may lose lines are shuffled
    own, mark = fresh("own"), fresh("mark")
    texts = marked(docs.withColumn(own, F.xxhash64("text")), own, gone.select(F.col(content).alias(own)), mark)
    some = texts.where(mark).join(gone.hint("merge"), F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(content)), "left")
    others = texts.where(~F.col(mark)).withColumn(removed, F.lit(None).cast("array<int>"))
    joined = some.select(*docs.columns, removed).unionAll(others.select(*docs.columns, removed))
    lines = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col(removed), i))
    return joined.withColumn("text", F.when(F.col(removed).isNull(), F.col("text")).otherwise(F.array_join(lines, "\n")))


def line_dedup(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, removed)`` for every row of ``docs``: the text without the lines
    that go and their numbers, from 0.

    Null texts stay null, empty ones empty; lines without a letter or digit stay, lines of fewer than
    ``MIN_WORDS`` words go only if equal to another once normalised. Null ids come first. Rows repeated
    in full count as one occurrence and stay alike. Extra columns are not read; an empty table gives no rows.
    """
    out = without_repeated_lines(docs.select("doc_id", "text"), "removed")
    return out.select("doc_id", "text", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without repeated lines, columns unchanged; ``n_chars`` follows the text."""
    removed = fresh("removed")
    out = without_repeated_lines(docs, removed)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(removed).isNull(), F.col("n_chars")).otherwise(length))
    return out.select(*docs.columns)


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: lines kept and removed, and a digest of the text that stays."""
    out = line_dedup(read(spark, folder, "documents"))
    return out.select(
        "doc_id",
        (F.coalesce(F.size(F.split("text", "\n")), F.lit(0)) + F.size("removed")).alias("n_lines"),
        F.size("removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )
