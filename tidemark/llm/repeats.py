"""Substring dedup: suffix automata of reference shards, matching statistics, and removal of maximal repeated spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, freed, map_rows, python_rows, release
from tidemark.llm.shingles import hashed_words, rolling, split_words

#: Words of the anchors by which equal windows find each other.
ANCHOR = 8

#: Passages of a reference shard, about; its automaton is held in memory.
SHARD_PASSAGES = 4_000

#: Passages of one anchor from which they are dealt to shards window by window.
HOT_PASSAGES = 1_000

#: Passages that a task remembers, to send copies once.
MOST_MET = 150_000

#: Later than every position.
NEVER = 1 << 62


class SuffixAutomaton:
    """A generalised suffix automaton over sequences of integers: a state stands for substrings that end at the same places.

    Each state knows the earliest place where its substrings end, once ``settle`` has passed places on along the links.
    """

    def __init__(self):
        self.follow: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first = [NEVER]

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.follow.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.first.append(NEVER)
        return len(self.length) - 1

    def _split(self, above: int, symbol: int, state: int) -> int:
        """The part of ``state`` that ``above`` leads to, as a state of its own."""
        copy = self._state(self.length[above] + 1, self.link[state], dict(self.follow[state]))
        self.link[state] = copy
        while above >= 0 and self.follow[above].get(symbol) == state:
            self.follow[above][symbol] = copy
            above = self.link[above]
        return copy

    def add(self, sequence: list[int], place: int) -> None:
        """A reference sequence whose first symbol is at ``place``."""
        follow, link, length, first = self.follow, self.link, self.length, self.first
        last = 0
        for end, symbol in enumerate(sequence, place):
            there = follow[last].get(symbol)
            if there is not None:
                last = there if length[there] == length[last] + 1 else self._split(last, symbol, there)
            else:
                state, above = len(length), last
                follow.append({})
                link.append(0)
                length.append(length[last] + 1)
                first.append(NEVER)
                while above >= 0 and symbol not in follow[above]:
                    follow[above][symbol] = state
                    above = link[above]
                if above >= 0:
                    there = follow[above][symbol]
                    link[state] = there if length[there] == length[above] + 1 else self._split(above, symbol, there)
                last = state
            if end < first[last]:
                first[last] = end

    def settle(self) -> None:
        """Longer substrings end where their suffixes do: pass each state's earliest place on to the state it links to."""
        first, link = self.first, self.link
        for state in np.argsort(np.array(self.length), kind="stable")[:0:-1].tolist():
            if first[state] < first[link[state]]:
                first[link[state]] = first[state]

    def matching_statistics(self, sequence: list[int], window: int) -> list[tuple[int, int]]:
        """For each position: the length of the longest known substring that ends there, up to one state above ``window``, and the earliest
        place where the last ``window`` symbols end (NEVER if they are not known)."""
        follow, link, length, first = self.follow, self.link, self.length, self.first
        out, state, matched = [], 0, 0
        for symbol in sequence:
            following = follow[state].get(symbol)
            while following is None and state:
                state = link[state]
                matched = length[state]
                following = follow[state].get(symbol)
            if following is not None:
                state = following
                matched += 1
                while length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
            out.append((matched, first[state] if matched >= window else NEVER))
        return out


def passages(hashes: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group the windows of several texts by their anchor, the run of ``ANCHOR`` words of least hash, the leftmost if equal.

    Equal windows have equal anchors at equal places. ``ends`` are the texts' ends in ``hashes``. Returns, per passage: the
    anchor's hash, the text's number, the first window's start in the text, and the number of windows that follow each other.
    """
    none = (np.zeros(0, dtype=np.uint64), *(np.zeros(0, dtype=np.int64),) * 3)
    if len(hashes) < window:
        return none
    anchors = rolling(hashes, ANCHOR)
    wide = window - ANCHOR + 1
    at = np.lib.stride_tricks.sliding_window_view(anchors, wide).argmin(axis=1)
    starts = np.arange(len(at), dtype=np.int64)
    text = np.searchsorted(ends, starts, "right")
    whole = starts + window <= ends[np.minimum(text, len(ends) - 1)]
    starts, text, at = starts[whole], text[whole], (at + np.arange(len(at)))[whole]
    if not len(starts):
        return none
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
    sizes = np.diff(np.append(first, len(starts)))
    begin = np.concatenate([[0], ends[:-1]])
    return anchors[at[first]], text[first], starts[first] - begin[text[first]], sizes


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """The anchors of every row: anchor, doc_id, copy, start. Rows are told apart by doc_id and a hash of the text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, ends in hashed_words(batch.column("text").cast(pa.string())):
                anchor, text, start, _ = passages(hashes, ends, window)
                at = pa.array(first + text)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), batch.column("doc_id").take(at), batch.column("copy").take(at), pa.array(start.astype(np.int32))], names=["anchor", "doc_id", "copy", "start"])

    kind = dict(docs.dtypes)["doc_id"]
    return python_rows(docs).mapInArrow(freed(rows), f"anchor long, doc_id {kind}, copy long, start int")


def merged_runs(runs: list[tuple[int, int]]) -> list[int]:
    """Runs of windows (first, number) in order of their starts, joined where they meet; each as one number, its first above its length."""
    out: list[list[int]] = []
    for start, n in runs:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], start + n)
        else:
            out.append([start, start + n])
    return [start << 32 | end - start for start, end in out]


def _routed(marked: DataFrame, window: int) -> DataFrame:
    """Passages that other rows may share: anchor, words, doc_id, copy, start, windows; and, without words, runs.

    ``marked`` has the starts of such passages, doubled, plus one where the anchor is hot. A passage that its task has met at an
    earlier place is a repeat as a whole, so it is reported at once and not sent: a shard gets a passage once a task at most.
    Passages of a hot anchor are sent window by window, with a hash of the window's words for an anchor.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[bytes, tuple] = {}

        def is_repeat(content: bytes, place: tuple) -> tuple[bool, bytes]:
            """Whether the task has met the content at an earlier place, and the content's key."""
            key = xxhash.xxh3_128_digest(content)
            before = met.get(key, place)
            if before >= place:
                met[key] = place
            return before < place, key

        for batch in batches:
            ids, copies, marks, texts = (batch.column(c).to_pylist() if c != "starts" else batch.column(c) for c in ("doc_id", "copy", "starts", "text"))
            for first, hashes, ends in hashed_words(batch.column("text").cast(pa.string())):
                split = [split_words(t, False) for t in texts[first : first + len(ends)]]
                anchor, text, start, size = passages(hashes, ends, window)
                anchor = anchor.view(np.int64)
                sent, repeats = [], []
                bounds = np.searchsorted(text, np.arange(len(split) + 1)).tolist()
                if len(met) > MOST_MET:
                    met.clear()
                for k, words in enumerate(split):
                    part = slice(bounds[k], bounds[k + 1])
                    asked = np.sort(marks[first + k].values.to_numpy())
                    at = np.minimum(np.searchsorted(asked >> 1, start[part]), len(asked) - 1)
                    wanted = np.flatnonzero(asked[at] >> 1 == start[part])
                    doc_id, copy, runs = ids[first + k], copies[first + k], []
                    for i, hot in zip((bounds[k] + wanted).tolist(), (asked[at[wanted]] & 1).tolist()):
                        begin, n = int(start[i]), int(size[i])
                        content = b" ".join(words[begin : begin + n + window - 1])
                        repeated, key = is_repeat(content, (doc_id, begin))
                        if repeated:
                            runs.append((begin, n))
                        elif not hot:
                            sent.append((int(anchor[i]), content, doc_id, copy, begin, n, None))
                        else:
                            for w in range(begin, begin + n):
                                content = b" ".join(words[w : w + window])
                                repeated, key = is_repeat(content, (doc_id, w)) if n > 1 else (False, key)
                                if repeated:
                                    runs.append((w, 1))
                                else:
                                    sent.append((int.from_bytes(key[:8], "little", signed=True), content, doc_id, copy, w, 1, None))
                    if runs:
                        repeats.append((copy, None, doc_id, copy, 0, 0, merged_runs(runs)))
                columns = list(zip(*sent, *repeats)) or [()] * 7
                kinds = [pa.int64(), pa.binary(), batch.column("doc_id").type, pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(columns, kinds)], names=["anchor", "words", "doc_id", "copy", "start", "windows", "runs"])

    kind = dict(marked.dtypes)["doc_id"]
    return python_rows(marked).mapInArrow(freed(rows), f"anchor long, words binary, doc_id {kind}, copy long, start int, windows int, runs array<long>")


def seen_runs(anchors: list[int], contents: list[bytes], places: list[tuple], windows: list[int], window: int) -> list[list[tuple[int, int]]]:
    """For the passages of a shard, at places (doc_id, start): the runs of windows of each that also start at an earlier place.

    The automaton holds every passage, each distinct one at its earliest place; then the passages stream through it. It does without
    a passage that is alone with its anchor: no other has a window of it, and no window comes twice in one passage.
    """
    rank = {doc_id: r << 32 for r, doc_id in enumerate(sorted({doc_id for doc_id, _ in places}))}
    earliest: dict[bytes, int] = {}
    for content, (doc_id, start) in zip(contents, places):
        place = rank[doc_id] + start
        earliest[content] = min(place, earliest.get(content, place))
    with_anchor: dict[int, set[bytes]] = {}
    for anchor, content in zip(anchors, contents):
        with_anchor.setdefault(anchor, set()).add(content)
    automaton, numbers, sequences, first = SuffixAutomaton(), {}, {}, {}
    for anchor, content in zip(anchors, contents):
        place = earliest[content]
        if content in sequences or content in first:
            continue
        if len(with_anchor[anchor]) == 1:
            first[content] = range(place + window - 1, NEVER)
            continue
        sequences[content] = [numbers.setdefault(word, len(numbers)) for word in content.split(b" ")]
        automaton.add(sequences[content], place)
    automaton.settle()
    for content, sequence in sequences.items():
        first[content] = [end for _, end in automaton.matching_statistics(sequence, window)[window - 1 :]]
    out = []
    for content, (doc_id, start), n in zip(contents, places, windows):
        place = rank[doc_id] + start
        if earliest[content] < place:
            out.append([(start, n)])
        else:
            out.append([(start + k, 1) for k, known in zip(range(n), first[content]) if known < place + window - 1 + k])
    return out


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """Remove every word that lies in a run of ``window`` words which also starts earlier: in a smaller doc_id, or earlier in the document.

    Returns doc_id, n_words, n_removed, spans (maximal removed runs of words, start and end) and ``kept``, the words left joined
    by one space. Words are runs of other than ASCII white space, unchanged. Windows are judged on the input.

    Windows are grouped into passages by anchor, so equal windows are in passages of equal anchors; anchors that occur once
    are done with. Passages of equal anchors meet in one reference shard. A shard's suffix automaton holds the distinct passages
    that are routed to it with the earliest place of each, and those passages stream through it: where a matching statistic
    reaches ``window``, the state tells whether these words also end at an earlier place. An anchor of over ``HOT_PASSAGES``
    passages is dealt over all shards window by window, by the windows' words, so a shard's size does not follow an anchor's.
    A shard's automaton goes to the task that streams the passages for it and no other: every shard's to every document would
    cost the square of the corpus.

    A null or empty text has no words; very long texts are ordinary. Rows that share a doc_id are one document for the order, with
    verdicts of their own: a window at the same start of both is in neither earlier. Rows without doc_id keep everything and
    are nobody's reference. An empty table gives no rows. Columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    ours = docs.select("doc_id", F.xxhash64("text").alias("copy"), "text")
    named = ours.where("doc_id is not null and text is not null")
    counts = _anchors(named, window).groupBy("anchor").count().where("count > 1")
    shared = cut(counts.select("anchor", "count"))
    shards = max(1, -(-(shared.agg(F.sum("count")).first()[0] or 0) // SHARD_PASSAGES))
    release(spark)
    mark = F.col("start") * 2 + (F.col("count") > HOT_PASSAGES).cast("int")
    marked = cut(_anchors(named, window).join(shared, "anchor").groupBy("doc_id", "copy").agg(F.collect_set(mark).alias("starts")))
    release(spark)

    def judge(shard: pa.Table) -> pa.Table:
        sent = shard.filter(pc.is_valid(shard["words"]))
        anchors, contents, docs, starts, windows = (sent[c].to_pylist() for c in ("anchor", "words", "doc_id", "start", "windows"))
        runs = seen_runs(anchors, contents, list(zip(docs, starts)), windows, window)
        found = sent.select(["doc_id", "copy"]).append_column("runs", pa.array([merged_runs(r) for r in runs], pa.list_(pa.int64())))
        whole = shard.filter(pc.is_null(shard["words"])).select(["doc_id", "copy", "runs"])
        return pa.concat_tables([found.filter(pc.greater(pc.list_value_length(found["runs"]), 0)), whole], promote_options="permissive")

    kind = dict(docs.dtypes)["doc_id"]
    verdicts = _routed(named.join(marked, ["doc_id", "copy"]), window).groupBy(F.pmod("anchor", F.lit(shards))).applyInArrow(judge, f"doc_id {kind}, copy long, runs array<long>")
    repeats = cut(verdicts.groupBy("doc_id", "copy").agg(F.array_distinct(F.flatten(F.collect_list("runs"))).alias("runs")))
    del shared, marked, verdicts
    release(spark)

    def strip(texts: list[str | None], all_runs: list[list[int] | None]) -> list[tuple]:
        rows = []
        for text, runs in zip(texts, all_runs):
            words = split_words(text, False)
            if not runs:
                rows.append((len(words), 0, [], b" ".join(words).decode()))
                continue
            ordered = np.sort(np.array(runs, dtype=np.int64))
            starts = ordered >> 32
            ends = np.maximum.accumulate(starts + (ordered & 0xFFFFFFFF) - 1 + window)
            breaks = np.flatnonzero(starts[1:] > ends[:-1])
            begin, end = starts[np.append(0, breaks + 1)].tolist(), ends[np.append(breaks, len(ends) - 1)].tolist()
            kept, at = [], 0
            for b, e in zip(begin, end):
                kept += words[at:b]
                at = e
            kept += words[at:]
            rows.append((len(words), len(words) - len(kept), [{"start": b, "end": e} for b, e in zip(begin, end)], b" ".join(kept).decode()))
        return rows

    added = {"n_words": "long", "n_removed": "long", "spans": "array<struct<start: int, end: int>>", "kept": "string"}
    return map_rows(ours.join(repeats, ["doc_id", "copy"], "left"), ["doc_id"], ["text", "runs"], added, strip)
