"""Line dedup by a join on the parts that a few edits leave alone, in DataFrame operations only."""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import attach, attach_lists, cut, unused

#: Lines with a key in common that are compared with each other; more are keyed again by finer parts.
LONG_LIST = 64

#: The same for keys of finer parts, whose lines are compared by few numbers; what more lines have open is keyed in turn.
LONG_FINE_LIST = 1024

#: Letters whose numbers tell lines apart before their edit distance is measured: one edit changes two of these numbers by one at most.
LETTERS = ["e ", "t,", "a.", "oz", "nk", "iv", "sj", "rx", "hbq", "lpy", "dgw", "ucmf"]


def _has_word(line: Column) -> Column:
    """Something is left without leading ASCII white space; cheaper than a pattern, which would decode the line."""
    return F.ltrim(line, F.lit(" \t\n\x0b\x0c\r")) != ""


def _lines(docs: DataFrame) -> DataFrame:
    """Lines that have a word, by document, a hash of its text (rows may share a doc_id), and number."""
    split = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("_copy"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return split.where(_has_word(F.col("line")))


def _with_key(lines: DataFrame) -> DataFrame:
    """A line's identity: two independent hashes and its length."""
    return lines.withColumns({"_k1": F.xxhash64("line"), "_k2": F.crc32("line"), "_len": F.length("line")})


def _shifts(edits: int, gap: int) -> list[tuple[int, ...]]:
    """Shifts behind each of ``edits`` edited parts, the last being the two lines' difference in length, that so many edits can make."""
    steps = itertools.product(range(-edits, edits + 1), repeat=edits)
    return [tuple(itertools.accumulate(s)) for s in steps if sum(s) == gap and sum(map(abs, s)) <= edits]


def _part_runs(max_edits: int, n_parts: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """What a pair within ``max_edits`` may agree on: difference in length, and runs of parts (first, end, shift) left alone.

    The shorter line, of m characters, is cut into ``n_parts`` parts. Each edit falls into one of them, so the pair agrees
    outside some ``max_edits`` parts; behind an edited part the longer line's text is shifted.
    """
    found = {}
    for gap in range(max_edits + 1):
        for edited in itertools.combinations(range(n_parts), max_edits):
            bounds = [-1, *edited, n_parts]
            for shifts in _shifts(max_edits, gap):
                runs = [(b + 1, e, s) for b, e, s in zip(bounds, bounds[1:], (0, *shifts)) if b + 1 < e]
                # With one part left alone, of those that agree there is one with no more edits than parts on either side.
                if n_parts > max_edits + 1 or (abs(runs[0][2]) <= runs[0][0] and abs(gap - runs[0][2]) <= max_edits - runs[0][0]):
                    found[gap, tuple(runs)] = gap, runs
    return list(found.values())


def _part_keys(wide: str, length: str, max_edits: int) -> list[Column]:
    """Hashes of each of a line's ``max_edits`` + 1 parts, as the shorter and as the longer of a pair.

    ``wide`` is the line in four bytes a character, so that a part is a slice of bytes and no characters are counted.
    """
    n = max_edits + 1
    return [
        F.expr(f"xxhash64({part}, {length} - {gap}, substring({wide}, int(4 * (({length} - {gap}) * {part} div {n} + {shift}) + 1), int(4 * (({length} - {gap}) * {part + 1} div {n} - ({length} - {gap}) * {part} div {n}))))")
        for gap, [(part, _, shift)] in _part_runs(max_edits, n)
    ]


#: Columns of a line's letter counts.
COUNTS = [f"_c{k}" for k in range(len(LETTERS))]

#: Columns of its parities.
SKETCHES = ["_s1", "_s2"]


def _letter_counts(line: str) -> dict[str, Column]:
    """How often each group of ``LETTERS`` occurs in a line."""
    return {name: (F.length(line) - F.length(F.translate(line, letters, ""))).cast("int") for name, letters in zip(COUNTS, LETTERS)}


def _sketches(wide: str) -> dict[str, Column]:
    """Parities of a line's characters, and of its pairs of neighbours, by hash: one edit turns two bits of the first and four of the second at most."""
    bits = "aggregate(transform(sequence(0, int(length({0}) div 4) - 1), i -> shiftleft(1L, int(pmod(xxhash64(substring({0}, 4 * i + 1, {1})), 64L)))), 0L, (all, bit) -> all ^ bit)"
    return {name: F.expr(bits.format(wide, 4 * n)) for n, name in enumerate(SKETCHES, 1)}


#: Four bytes that are no character in UTF-32: what stands between the open pieces of a text (with the round), and for an edited character.
SEPARATOR, EDITED = "X'7F{:06X}'", "X'7FFFFFFF'"


def _fine_keys(max_edits: int, n_parts: int) -> tuple[str, str]:
    """SQL for the list of ways (gap, runs) in which an item (_group, _wide) may agree with another outside ``max_edits`` of its parts, and for
    the hash of a way ``k``; one expression over a list, as there are many."""
    ways = ", ".join(f"named_struct('gap', {gap}, 'runs', array({', '.join(f'array({b}, {e}, {s})' for b, e, s in runs)}))" for gap, runs in _part_runs(max_edits, n_parts))
    shorter = "(length(_wide) div 4 - k.gap)"
    start, end = f"{shorter} * r[0] div {n_parts}", f"{shorter} * r[1] div {n_parts}"
    piece = f"xxhash64(r[0], r[1], substring(_wide, int(4 * ({start} + r[2]) + 1), int(4 * ({end} - {start}))))"
    return f"array({ways})", f"xxhash64(_group, {shorter}, transform(k.runs, r -> {piece}))"


def _keyed(items: DataFrame, max_edits: int, n_parts: int) -> DataFrame:
    """Lines (_id) with the keys of their items."""
    ways, key = _fine_keys(max_edits, n_parts)
    return items.select("_id", F.explode(F.expr(f"array_distinct(transform({ways}, k -> {key}))")).alias("_key"))


def _open_items(items: DataFrame, long: DataFrame, max_edits: int, n_parts: int, level: int) -> DataFrame:
    """What the lists (_id, _key) leave open of the items in them: the pieces around the runs that the key fixes.

    Two lines that agree by a key are as far apart as what it leaves open of them, for one of the keys that a near pair shares. A key
    may fix the same text by several ways; each gives an item. No alignment has pieces of less than no characters.
    """
    ways, key = _fine_keys(max_edits, n_parts)
    shorter = "(length(_wide) div 4 - k.gap)"
    begins = f"concat(array(0L), transform(k.runs, r -> {shorter} * r[1] div {n_parts} + r[2]))"
    ends = f"concat(transform(k.runs, r -> {shorter} * r[0] div {n_parts} + r[2]), array(length(_wide) div 4))"
    pieces = f"zip_with({begins}, {ends}, (x, y) -> substring(_wide, int(4 * x + 1), int(4 * (y - x))))"
    whole = f"forall(zip_with({begins}, {ends}, (x, y) -> y >= x), ok -> ok)"
    found = f"filter({ways}, k -> array_contains(_keys, {key}) and {whole})"
    opened = f"transform({found}, k -> named_struct('_group', {key}, '_wide', aggregate({pieces}, X'', (all, piece) -> concat(all, piece, {SEPARATOR.format(level)}))))"
    lists = long.groupBy("_id").agg(F.collect_set("_key").alias("_keys"))
    return items.join(lists, "_id").select("_id", F.explode(F.expr(f"array_distinct({opened})")).alias("_open")).select("_id", "_open.*").distinct()


def _edited_alike(items: DataFrame, max_edits: int) -> DataFrame:
    """Lines with earlier ones whose items are within ``max_edits``, of each kind the earliest; no line is compared with another.

    An item is given with every choice of characters marked as changed or left out. Two items that become equal with c marks, and x and y
    characters left out, are within c + x + y edits; so the earliest with any y speaks for all of them. Separators stay, so pieces
    meet their like.
    """
    size, head, tail = "int(length(v.w) div 4)", "substring(v.w, 1, 4 * i)", "substring(v.w, 4 * i + 5)"
    made = "array(named_struct('w', _wide, 'c', 0, 'x', 0, 'p', 0))"
    for _ in range(max_edits):
        marked = f"named_struct('w', concat({head}, {EDITED}, {tail}), 'c', v.c + 1, 'x', v.x, 'p', i + 1)"
        without = f"named_struct('w', concat({head}, {tail}), 'c', v.c, 'x', v.x + 1, 'p', i)"
        places = f"filter(sequence(0, {size}), i -> i >= v.p and i < {size} and substring(v.w, 4 * i + 1, 1) <> X'7F')"
        made = f"flatten(transform({made}, v -> concat(array(v), flatten(transform({places}, i -> array({marked}, {without}))))))"
    keys = f"array_distinct(transform({made}, v -> named_struct('_key', xxhash64(_group, v.w), '_c', v.c, '_x', v.x)))"
    variants = items.select("_id", F.explode(F.expr(keys)).alias("_v")).select("_id", "_v.*").distinct()
    firsts = [F.min(F.when(F.col("_x") == x, F.col("_id"))).alias(f"_first{x}") for x in range(max_edits + 1)]
    shared = variants.groupBy("_key").agg(F.count("*").alias("_n"), *firsts).where("_n > 1").drop("_n")
    others = F.array(*[F.when(F.col("_c") + F.col("_x") + x <= max_edits, F.col(f"_first{x}")) for x in range(max_edits + 1)])
    return variants.join(shared, "_key").select("_id", F.explode(others).alias("_other")).where("_other._at < _id._at").distinct()


def _key_names(max_edits: int) -> list[str]:
    return [f"_p{k}" for k in range(len(_part_runs(max_edits, max_edits + 1)))]


def _lists(keyed: DataFrame, longest: int | None = None) -> DataFrame:
    """Lines (_id, _key) whose key another line has too, with the number of lines; of keys with the same lines (``longest`` at most), one."""
    one, two = F.bit_xor(F.xxhash64("_id")).alias("_x"), F.bit_xor(F.xxhash64(F.lit(1), "_id")).alias("_y")
    shared = keyed.groupBy("_key").agg(F.count("*").alias("_n"), one, two).where("_n > 1")
    own = [] if longest is None else [F.when(F.col("_n") > longest, F.col("_key"))]
    shared = cut(shared.groupBy("_n", "_x", "_y", *own).agg(F.min("_key").alias("_key")).select("_key", "_n"))
    return cut(attach(keyed, shared, "_key", shared.count(), "inner"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _within(a: Column, b: Column, max_edits: int) -> Column:
    """Whether two lines are within so many character edits.

    What they have in common at both ends is found by halving and put aside. Of what is left, both first and both last characters
    differ, so one edit is at the front and one at the back: for up to two edits, the rest must be equal. So long lines cost little more
    than reading them; with more edits, the distance of what is left is computed.
    """
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])

    def common(end: Callable, most: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda n, step: F.when((n + step <= most) & (end(a, n + step) == end(b, n + step)), n + step).otherwise(n))

    def left_over(prefix: Column, suffix: Column) -> Column:
        m, n = F.length(a) - prefix - suffix, F.length(b) - prefix - suffix
        near = F.greatest(m, n) <= max_edits
        if max_edits == 2:
            for (a1, b1), (a2, b2) in itertools.product([(1, 1), (1, 0), (0, 1)], repeat=2):
                rest = m - a1 - a2
                near |= (rest == n - b1 - b2) & (rest >= 0) & (F.substring(a, prefix + a1 + 1, rest) == F.substring(b, prefix + b1 + 1, rest))
        elif max_edits > 2:
            near |= F.levenshtein(F.substring(a, prefix + 1, m), F.substring(b, prefix + 1, n), max_edits) >= 0
        return near

    shorter = F.least(F.length(a), F.length(b))
    return _bound(common(F.left, shorter), lambda prefix: _bound(common(F.right, shorter - prefix), lambda suffix: left_over(prefix, suffix)))


def _alike(later: DataFrame, members: DataFrame, max_edits: int) -> DataFrame:
    """Lines of ``later`` with the earlier ones of ``members`` that have the same key and nearly the same letters (and parities, if given), once each."""
    sketches = [c for c in SKETCHES if c in members.columns]
    other = members.select("_key", F.col("_id").alias("_other"), *[F.col(c).alias(c + "_") for c in COUNTS + sketches])
    alike = sum((F.abs(F.col(c) - F.col(c + "_")) for c in COUNTS), F.lit(0)) <= 2 * max_edits
    for n, c in enumerate(sketches, 1):
        alike &= F.bit_count(F.col(c).bitwiseXOR(F.col(c + "_"))) <= 2 * n * max_edits
    return later.join(other, (later["_key"] == other["_key"]) & alike & (F.col("_other._at") < F.col("_id._at"))).select("_id", "_other").distinct()


def _firsts(members: DataFrame) -> DataFrame:
    """Lines (_id, _key) with the earliest that has the same key, if it is not the line's own."""
    firsts = members.groupBy("_key").agg(F.min("_id").alias("_other"))
    return attach(members, firsts, "_key", firsts.count()).where("_other._at < _id._at").select("_id", "_key", "_other")


def _verified(pairs: DataFrame, texts: DataFrame, max_edits: int) -> DataFrame:
    """Lines of the pairs that are within ``max_edits`` of the other."""
    other = texts.select(F.col("_id").alias("_other"), F.col("line").alias("_earlier"))
    return pairs.join(texts, "_id").join(other, "_other").where(_within(F.col("line"), F.col("_earlier"), max_edits)).select("_id").distinct()


def _near_lines(distinct: DataFrame, docs: DataFrame, max_edits: int, near_chars: int) -> DataFrame:
    """Keys of distinct lines that are within ``max_edits`` of a line which comes earlier.

    Lists of up to ``LONG_LIST`` lines are compared inside the join. The lines of longer ones are held against the earliest; those that it
    does not settle get keys of more parts, which leave less of a line open. Where more than ``LONG_FINE_LIST`` have such a key, the same is
    done with what it leaves open, until that is so short that its variants settle it. So a round takes time by lines and keys, not by pairs.
    """
    identity = F.struct("_at", "_k1", "_k2").alias("_id")
    keyed = distinct.where(F.col("_len") >= near_chars).select(identity, F.explode(F.array_distinct(F.array(*_key_names(max_edits)))).alias("_key"))
    members = _lists(keyed)
    chosen = cut(members.select("_id").distinct().select("_id", F.col("_id._at.doc_id").alias("doc_id"), F.col("_id._at.line_no").alias("line_no"), F.col("_id._k1").alias("_k1")))
    lines = _lines(docs).withColumn("_k1", F.xxhash64("line"))
    texts = attach(lines, chosen, ["doc_id", "line_no", "_k1"], chosen.count(), "inner").select("_id", "line").dropDuplicates(["_id"])
    texts = cut(texts.withColumns(_letter_counts("line")))

    # Both sides of a comparison read these rows, so they are made once.
    short, long = cut(members.where(F.col("_n") <= LONG_LIST).join(texts.select("_id", *COUNTS), "_id")), members.where(F.col("_n") > LONG_LIST)
    near = cut(_verified(_alike(short, short, max_edits).union(_firsts(long).select("_id", "_other")).distinct(), texts, max_edits))
    if not long.limit(1).count():
        return near.select("_id._k1", "_id._k2").distinct().withColumn("_is_near", F.lit(True))
    crowded = texts.join(long.select("_id").distinct(), "_id", "left_semi").withColumn("_wide", F.encode("line", "UTF-32"))
    crowded = cut(crowded.select("_id", "_wide", *COUNTS).withColumns(_sketches("_wide")))
    items = crowded.select("_id", F.lit(0).cast("long").alias("_group"), "_wide")
    n_parts = (4 if max_edits <= 2 else 2) * (max_edits + 1)
    for level in itertools.count():
        # A crowded line that has a witness looks for no other, but may be one.
        members = _lists(_keyed(items, max_edits, n_parts).distinct(), LONG_FINE_LIST)
        short, long = cut(members.where(F.col("_n") <= LONG_FINE_LIST).join(crowded.drop("_wide"), "_id")), members.where(F.col("_n") > LONG_FINE_LIST)
        pairs = _alike(short.join(near, "_id", "left_anti"), short, max_edits).union(_firsts(long).join(near, "_id", "left_anti").select("_id", "_other"))
        near = cut(_verified(pairs.distinct(), texts, max_edits).union(near))
        unsettled = cut(_firsts(long).join(near, "_id", "left_anti").select("_key").distinct())
        if not (n_unsettled := unsettled.count()):
            break
        items = cut(_open_items(items, attach(long, unsettled, "_key", n_unsettled, "left_semi"), max_edits, n_parts, level))
        tiny = F.length("_wide") <= 4 * (8 + 4 * max_edits)
        near = cut(_verified(_edited_alike(items.where(tiny), max_edits).join(near, "_id", "left_anti"), texts, max_edits).union(near))
        items = items.where(~tiny)
        if not items.limit(1).count():
            break
    return near.select("_id._k1", "_id._k2").distinct().withColumn("_is_near", F.lit(True))


def dedup_lines(docs: DataFrame, max_edits: int = 1, near_chars: int = 0) -> DataFrame:
    """Remove lines that equal an earlier line of the corpus, or are within ``max_edits`` character edits of one; earlier by (doc_id, line).

    Adds n_lines (lines with a word), n_removed and ``kept``, the text without the removed lines; other columns stay, but for input
    columns of these three names, which are replaced. Lines end at a line feed. Lines without a word stay and are not counted; lines under
    ``near_chars`` characters (none unless it is given) are removed only where they are equal. The verdict is on the input, not on what is
    left: a line goes if any earlier line is near, removed or not. A null text has no lines and stays null; rows without doc_id stay as
    they are. Rows that share a doc_id are one document for the order, with lines of their own: the same line at the same number of both
    stays in both. An empty table gives no rows; the cost of a line grows with its length, not its square.

    Variants are lines without some of their parts: of ``max_edits`` + 1 parts of a line, all but one are deleted, and lines are compared if
    what is left of both is equal. Deleting every choice of single characters would make some 54,000 variants of a line of 330 characters.
    Up to ``LONG_LIST`` lines of one variant are compared with each other. Of more, each is held against the earliest and then, if that is
    not near, against those with which it shares all but ``max_edits`` of four times as many parts (twice, for more than 2 edits). Where
    more than ``LONG_FINE_LIST`` do, the parts that differ are cut in turn, and what is left of a few characters gets every variant.
    """
    if not 1 <= max_edits <= 4:
        raise ValueError("max_edits must be from 1 to 4")
    docs = docs.drop("n_lines", "n_removed", "kept")
    copy, gone = unused("_copy", docs), unused("_removed", docs)
    keyed = _with_key(_lines(docs))
    names = _key_names(max_edits)
    wide = keyed.withColumn("_wide", F.encode("line", "UTF-32"))
    marked = wide.select("_k1", "_k2", "_len", F.struct("doc_id", "line_no").alias("_at"), *[key.alias(name) for name, key in zip(names, _part_keys("_wide", "_len", max_edits))])
    distinct = cut(marked.groupBy("_k1", "_k2", "_len").agg(F.min("_at").alias("_at"), F.count("*").alias("_n"), *[F.min(c).alias(c) for c in names]))
    near_keys = cut(_near_lines(distinct, docs, max_edits, near_chars))
    flagged = attach(distinct, near_keys, ["_k1", "_k2"], near_keys.count()).where("_n > 1 or _is_near")
    flagged = cut(flagged.select("_k1", "_k2", "_len", F.col("_at").alias("_kept_at"), F.coalesce("_is_near", F.lit(False)).alias("_near")))
    removed = (
        attach(keyed.drop("line"), flagged, ["_k1", "_k2", "_len"], flagged.count(), "inner")
        .where(F.col("_near") | (F.struct("doc_id", "line_no") != F.col("_kept_at")))
        .groupBy("doc_id", F.col("_copy").alias(copy))
        .agg(F.collect_set("line_no").alias(gone))
    )
    removed = cut(removed)
    lines = F.split("text", "\n")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone)), lambda i: F.get(lines, i))
    return (
        attach_lists(docs.withColumn(copy, F.xxhash64("text")), removed, ["doc_id", copy], gone)
        .select(
            *docs.columns,
            F.coalesce(F.size(F.filter(lines, _has_word)), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_removed"),
            F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("kept"),
        )
    )
