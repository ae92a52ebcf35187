"""Packing token sequences: non-negative least squares over length combinations, and exact cuts for what is left."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidemark.llm.shared import cut, freed, number_rows, python_rows

#: Bytes of text that are split into words at once, and words and pieces whose ids a worker remembers.
CHUNK_BYTES, MOST_WORDS, MOST_PIECES = 3_000_000, 100_000, 200_000

#: Pieces that are merged at once, and words that the tokenizer gets at once; both need many times their own bytes meanwhile.
MERGE_PIECES, TOKENIZER_WORDS = 20_000, 4_000

#: A rank that no merge has.
NO_RANK = np.int64(1 << 40)


class PieceMerger:
    """Byte-level BPE with word ends over many pieces at once, from the vocabulary and merges of a tokenizer file.

    In each round every piece that still can merges its pair of least rank, the leftmost if there are several. A token comes into
    being by one merge, so a merge that uses it has a greater rank, and this order is the usual one.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256
        hidden = [b for b in range(256) if b not in set(shown)]
        char = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.inner = np.array([vocab[char[b]] for b in range(256)], dtype=np.int64)
        self.final = np.array([vocab[char[b] + end] for b in range(256)], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[x] << 20 | vocab[y] for x, y in pairs], dtype=np.int64)
        self.merged = np.array([vocab[x + y] for x, y in pairs], dtype=np.int64)
        self.bits = max(12, int(len(pairs) * 8).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, NO_RANK, dtype=np.int64)
        slots, self.longest = self._slot(keys).tolist(), 1
        for rank, (key, slot) in enumerate(zip(keys.tolist(), slots)):
            steps = 1
            while self.keys[slot] >= 0:
                slot, steps = (slot + 1) & ((1 << self.bits) - 1), steps + 1
            self.keys[slot], self.ranks[slot] = key, rank
            self.longest = max(self.longest, steps)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _rank(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slot(keys)
        there = self.keys[slots]
        ranks = np.where(there == keys, self.ranks[slots], NO_RANK)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        for _ in range(self.longest - 1):
            if not len(open_):
                break
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slots[open_]]
            hit = there == keys[open_]
            ranks[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return ranks

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after the other, and each piece's number of ids; no piece is empty."""
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(sizes)
        symbols[ends - 1] = self.final[raw[ends - 1]]
        number = np.arange(len(pieces))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(number):
            starts = ends - sizes
            ranks = np.full(len(symbols), NO_RANK)
            ranks[:-1] = self._rank(symbols[:-1] << 20 | symbols[1:])
            ranks[ends - 1] = NO_RANK
            least = np.minimum.reduceat(ranks, starts)
            going = least < NO_RANK
            if not going.all():
                inside = np.repeat(going, sizes)
                done.append((number[~going], symbols[~inside], sizes[~going]))
                symbols, ranks, sizes, number, least = symbols[inside], ranks[inside], sizes[going], number[going], least[going]
                if not len(number):
                    break
                ends = np.cumsum(sizes)
                starts = ends - sizes
            hits = np.flatnonzero(ranks == np.repeat(least, sizes))
            first = hits[np.searchsorted(hits, starts)]
            symbols[first] = self.merged[least]
            stays = np.ones(len(symbols), dtype=bool)
            stays[first + 1] = False
            symbols = symbols[stays]
            sizes = sizes - 1
            ends = np.cumsum(sizes)
        order = np.concatenate([d[0] for d in done])
        lengths = np.concatenate([d[2] for d in done])
        flat = np.concatenate([d[1] for d in done])
        begins = np.cumsum(lengths) - lengths
        back = np.argsort(order)
        return flat[gathered(begins[back], lengths[back])], lengths[back]


def gathered(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices begin, begin + 1, ... of every range, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(begins - before, lengths) + np.arange(int(lengths.sum()))


class PieceMemory:
    """Ids of pieces as Arrow and NumPy arrays: each entry costs its characters and ids, and whole arrays are looked up at once."""

    def __init__(self, merger: PieceMerger, kind: np.dtype):
        self.merger, self.kind = merger, kind
        self.clear()

    def clear(self) -> None:
        self.pieces = pa.array([], pa.string())
        self.ids = np.zeros(0, dtype=self.kind)
        self.begins = np.zeros(0, dtype=np.int64)
        self.lengths = np.zeros(0, dtype=np.int64)

    def find(self, pieces: pa.Array) -> np.ndarray:
        """The entry of each of several pieces; those not yet known are merged and added."""
        if len(self.pieces) > MOST_PIECES:
            self.clear()
        distinct = pieces.dictionary_encode()
        at = pc.index_in(distinct.dictionary, value_set=self.pieces)
        if at.null_count:
            missing = distinct.dictionary.filter(pc.is_null(at))
            ids, lengths = [self.ids], [self.lengths]
            for first in range(0, len(missing), MERGE_PIECES):
                some_ids, some_lengths = self.merger.encode(missing[first : first + MERGE_PIECES].cast(pa.binary()).to_pylist())
                ids.append(some_ids.astype(self.kind))
                lengths.append(some_lengths)
            self.ids, self.lengths = np.concatenate(ids), np.concatenate(lengths)
            self.begins = np.cumsum(self.lengths) - self.lengths
            number = len(self.pieces) + np.cumsum(pc.is_null(at).to_numpy(zero_copy_only=False)) - 1
            found = np.where(pc.is_null(at).to_numpy(zero_copy_only=False), number, pc.fill_null(at, 0).to_numpy(zero_copy_only=False))
            self.pieces = pa.concat_arrays([self.pieces, missing])
        else:
            found = at.to_numpy(zero_copy_only=False)
        return found[distinct.indices.to_numpy(zero_copy_only=False)]


class WordEncoder:
    """Ids of texts by a word-end BPE tokenizer.

    The tokenizer drops white space and never joins across it, so a text's ids are its words' ids in turn; a word of letters,
    with full stops or commas behind, is in turn its lower-case letters and those. Such pieces are merged many at once and
    remembered; all else goes through the tokenizer itself.
    """

    #: Letters that are composed and have one lower-case letter, with full stops or commas behind.
    LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
    PLAIN = f"^[{LETTERS}]+[.,]*$"
    LOWER = "".join(map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4")
        self.memory = PieceMemory(PieceMerger(path), self.kind)
        self.words: dict[str, bytes] = {}

    def _through_tokenizer(self, texts: list[str]) -> list[bytes]:
        """Ids of each of several texts without white space, in one call; a token's place tells its text."""
        found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(found.ids, dtype=self.kind)
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        at = np.fromiter((o[0] for o in found.offsets), dtype=np.int64, count=len(ids))
        data, marks = ids.tobytes(), (np.searchsorted(at, starts) * self.kind.itemsize).tolist()
        return [data[a:b] for a, b in zip(marks[:-1], marks[1:])]

    def _odd(self, words: list[str]) -> list[bytes]:
        """Ids of words that are not plain, remembered."""
        new = [w for w in words if w and w not in self.words]
        if len(self.words) + len(new) > MOST_WORDS:
            self.words = {}
            new = [w for w in words if w]
        for first in range(0, len(new), TOKENIZER_WORDS):
            some = new[first : first + TOKENIZER_WORDS]
            self.words.update(zip(some, self._through_tokenizer(some)))
        return [self.words.get(w, b"") for w in words]

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, one after the other, and each word's number of ids."""
        plain = pc.match_substring_regex(words, self.PLAIN)
        lower = pc.utf8_lower(words.filter(plain))
        cores, stops = pc.utf8_rtrim(lower, ".,"), pc.utf8_ltrim(lower, self.LOWER)
        stopped = pc.greater(pc.binary_length(stops), 0)
        entries = self.memory.find(pa.concat_arrays([cores, stops.filter(stopped)]))
        is_plain, has_stop = plain.to_numpy(zero_copy_only=False), stopped.to_numpy(zero_copy_only=False)
        odd = self._odd(words.filter(pc.invert(plain)).to_pylist())
        odd_lengths = np.fromiter(map(len, odd), dtype=np.int64, count=len(odd)) // self.kind.itemsize
        # Each word is up to two ranges of this pool: its letters or all of it, and its stops.
        pool = np.concatenate([self.memory.ids, np.frombuffer(b"".join(odd), dtype=self.kind)])
        begins, lengths = np.zeros((len(words), 2), dtype=np.int64), np.zeros((len(words), 2), dtype=np.int64)
        core, stop = entries[: len(cores)], entries[len(cores) :]
        begins[is_plain, 0], lengths[is_plain, 0] = self.memory.begins[core], self.memory.lengths[core]
        tails = np.flatnonzero(is_plain)[has_stop]
        begins[tails, 1], lengths[tails, 1] = self.memory.begins[stop], self.memory.lengths[stop]
        begins[~is_plain, 0], lengths[~is_plain, 0] = len(self.memory.ids) + np.cumsum(odd_lengths) - odd_lengths, odd_lengths
        return pool[gathered(begins.ravel(), lengths.ravel())], lengths.sum(axis=1)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; null is empty. Words are told apart by Arrow, and only distinct ones looked up."""
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(texts):
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, "right")))
            split = pc.ascii_split_whitespace(texts[first:last])
            words = split.flatten().dictionary_encode()
            ids, lengths = self._word_ids(words.dictionary)
            begins = np.cumsum(lengths) - lengths
            index = words.indices.to_numpy(zero_copy_only=False)
            out = ids[gathered(begins[index], lengths[index])]
            bounds = np.concatenate([[0], np.cumsum(lengths[index])])[np.cumsum(np.concatenate([[0], pc.list_value_length(split).to_numpy(zero_copy_only=False)]))]
            del split, words, index
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                yield out[a:b]
            first = last


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def checksum(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def token_pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """Each document's ids, ``end_id`` last, in whole windows and a shorter rest: doc_id, start, length, crc, ids, doc_tokens.

    A whole window carries its checksum only, a rest its ids as well, because it may be cut again.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            at, starts, lengths, crcs, rests, totals = [], [], [], [], [], []
            for k, ids in enumerate(encode.encode(batch.column("text").cast(pa.string()))):
                wide = np.empty(len(ids) + 1, dtype="<u4")
                wide[:-1], wide[-1] = ids, end_id
                data = wide.tobytes()
                for start in range(0, len(wide), window):
                    piece = data[4 * start : 4 * (start + window)]
                    at.append(k)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    crcs.append(zlib.crc32(piece))
                    rests.append(None if len(piece) == 4 * window else wide[start:].astype(encode.kind).tobytes())
                    totals.append(len(wide))
            ids = batch.column("doc_id").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()), pa.array(rests, pa.binary()), pa.array(totals, pa.int64())],
                names=["doc_id", "start", "length", "crc", "ids", "doc_tokens"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return python_rows(docs.select("doc_id", "text")).mapInArrow(freed(split), f"doc_id {kind}, start long, length long, crc long, ids binary, doc_tokens long")


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Pairs and triples of the given lengths that fill the window exactly, longest first; a pair's third is 0."""
    there = np.zeros(window + 1, dtype=bool)
    there[lengths] = True
    found = []
    longer = lengths[(lengths * 2 >= window) & (lengths < window)]
    pairs = longer[there[window - longer]]
    found.append(np.stack([pairs, window - pairs, np.zeros_like(pairs)], axis=1))
    for a in lengths[lengths * 3 >= window]:
        b = lengths[(lengths <= a) & (2 * lengths >= window - a) & (lengths < window - a)]
        b = b[there[window - a - b]]
        found.append(np.stack([np.full_like(b, a), b, window - a - b], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)


def solve_counts(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Repeats x >= 0 of the patterns that least squares fits to the histogram, by accelerated projected gradients.

    Every pattern uses at most three lengths, so the matrix is kept as indices; row 0 stands for a pair's missing third.
    """
    size = len(histogram)
    target = histogram.astype(float)
    target[0] = 0.0

    def uses(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(patterns[:, k], weights=x, minlength=size) for k in range(3))
        out[0] = 0.0
        return out

    def back(r: np.ndarray) -> np.ndarray:
        return r[patterns[:, 0]] + r[patterns[:, 1]] + r[patterns[:, 2]]

    probe = np.ones(len(patterns))
    for _ in range(12):
        probe = back(uses(probe))
        probe /= np.linalg.norm(probe) or 1.0
    bound = 1.05 * np.linalg.norm(back(uses(probe))) or 1.0
    x = np.zeros(len(patterns))
    y, t = x, 1.0
    for _ in range(rounds):
        following = np.maximum(0.0, y - back(uses(y) - target) / bound)
        s = (1 + (1 + 4 * t * t) ** 0.5) / 2
        if ((y - following) * (following - x)).sum() > 0:  # the momentum points uphill
            s, y = 1.0, following
        else:
            y = following + (t - 1) / s * (following - x)
        x, t = following, s
    return x


def pack_greedily(counts: dict[int, int], window: int) -> list[tuple[tuple[int, ...], int, int]]:
    """Best fit decreasing by length classes: (lengths, repeats, gap). What does not fit an open gap opens sequences."""
    open_gaps: dict[int, list[tuple[tuple[int, ...], int]]] = {window: [((), 1 << 62)]}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            gap = min(g for g in open_gaps if g >= length)
            lengths, repeats = open_gaps[gap].pop()
            if not open_gaps[gap]:
                del open_gaps[gap]
            each = min(gap // length, left)
            used = min(repeats, left // each)
            if repeats > used:
                open_gaps.setdefault(gap, []).append((lengths, repeats - used))
            open_gaps.setdefault(gap - each * length, []).append((lengths + (length,) * each, used))
            left -= each * used
    return [(lengths, repeats, gap) for gap, found in sorted(open_gaps.items()) for lengths, repeats in sorted(found) if lengths]


class PackingPlan:
    """Where the pieces of each length go, by their number within the length: drawn up from the histogram alone.

    ``ranges`` has, by length, rows (first number, sequence of that number, offset); each following number goes to the
    following sequence. A negative sequence marks pieces that are laid end to end from position ``offset`` and cut.
    """

    def __init__(self, histogram: dict[int, int], window: int):
        self.window = window
        left = np.zeros(window + 1, dtype=np.int64)
        for length, n in histogram.items():
            left[length] = n
        self.ranges: dict[int, list[tuple[int, int, int]]] = {length: [] for length in histogram}
        self._taken = np.zeros(window + 1, dtype=np.int64)
        self.sequences = 0
        if left[window]:
            self._place((window,), int(left[window]))
            left[window] = 0
        patterns = combinations(np.flatnonzero(left), window)
        if len(patterns):
            wanted = solve_counts(patterns, left)
            for k in np.argsort(-wanted, kind="stable"):
                if wanted[k] < 0.5:
                    break
                lengths = [int(v) for v in patterns[k] if v]
                repeats = min([int(wanted[k] + 0.5)] + [int(left[v]) // lengths.count(v) for v in set(lengths)])
                if repeats > 0:
                    self._place(tuple(lengths), repeats)
                    for v in lengths:
                        left[v] -= repeats
        rest: dict[int, int] = {}
        for lengths, repeats, gap in pack_greedily({int(v): int(left[v]) for v in np.flatnonzero(left)}, window):
            if gap == 0:
                self._place(lengths, repeats)
            else:
                for v in lengths:
                    rest[v] = rest.get(v, 0) + repeats
        position = 0
        for length, n in sorted(rest.items(), reverse=True):
            self.ranges[length].append((int(self._taken[length]), -1, position))
            position += n * length
        # Laid end to end and cut at every window; the last, shorter part is cut into powers of two, which need no padding.
        self.stream, self.stream_first = position, self.sequences
        full, last = divmod(position, window)
        parts = [1 << b for b in range(window.bit_length(), -1, -1) if last >> b & 1]
        self.tail_edges = np.cumsum([full * window, *parts])
        self.stream_full = full
        self.sequences += full + len(parts)

    def _place(self, lengths: tuple[int, ...], repeats: int) -> None:
        offset = 0
        at = 0
        while at < len(lengths):
            length = lengths[at]
            self.ranges[length].append((int(self._taken[length]), self.sequences, offset))
            self._taken[length] += repeats
            offset += length
            at += 1
        self.sequences += repeats

    def stream_parts(self, position: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """(start in the piece, length, sequence, offset) of each part of a piece laid at ``position``."""
        done = 0
        while done < length:
            at = position + done
            if at < self.stream_full * self.window:
                sequence, begin, end = at // self.window, at // self.window * self.window, (at // self.window + 1) * self.window
            else:
                k = int(np.searchsorted(self.tail_edges, at, "right")) - 1
                sequence, begin, end = self.stream_full + k, int(self.tail_edges[k]), int(self.tail_edges[k + 1])
            part = min(length - done, end - at)
            yield done, part, self.stream_first + sequence, at - begin
            done += part


def pack_sequences(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """Pack whole texts (null: empty) into sequences of at most ``window`` tokens; one row per piece.

    Documents are cut into whole windows and a rest. The histogram of rests, at most ``window`` numbers, goes to the driver:
    combinations of two or three lengths that fill a window are repeated as least squares over non-negative counts says,
    rounded; residuals are packed greedily; what would leave a gap is laid end to end and cut, in the end into powers of two.
    So nothing is padded. The plan is a table of ranges over (length, number among the pieces of that length), of a size
    that the window bounds; numbering is distributed. Repeated rows are separate documents; an empty text is the end id alone.
    """
    pieces = cut(token_pieces(docs, tokenizer, window, end_id))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = PackingPlan(histogram, window)
    ranked = number_rows(pieces, ["length"], ["doc_id", "start"], "_number", sum(histogram.values()))

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All ranges in one sorted table, by length and first number; each piece finds its own by one look-up.
        table = np.array([(length << 44 | first, first, sequence, offset) for length, rows in sorted(plan.ranges.items()) for first, sequence, offset in rows], dtype=np.int64).reshape(-1, 4)
        for batch in batches:
            start, length, crc, total, number = (batch.column(c).to_numpy() for c in ("start", "length", "crc", "doc_tokens", "_number"))
            found = table[np.searchsorted(table[:, 0], length << 44 | number, "right") - 1] if len(table) else np.zeros((0, 4), dtype=np.int64)
            placed = np.flatnonzero(found[:, 2] >= 0)
            whole = [start, length, crc, total, found[:, 2] + number - found[:, 1], found[:, 3]]
            parts = []
            ids = batch.column("ids")
            for k in np.flatnonzero(found[:, 2] < 0).tolist():
                n, values = int(length[k]), ids[k].as_py()
                values = np.frombuffer(values, dtype="<u2" if len(values) == 2 * n else "<u4")
                for begin, part, sequence, inside in plan.stream_parts(int(found[k, 3]) + int(number[k] - found[k, 1]) * n, n):
                    parts.append((k, int(start[k]) + begin, part, checksum(values[begin : begin + part]), int(total[k]), sequence, inside))
            cut_up = np.array(parts, dtype=np.int64).reshape(-1, 7)
            rows = batch.column("doc_id").take(pa.array(np.concatenate([placed, cut_up[:, 0]])))
            yield pa.RecordBatch.from_arrays([rows, *[pa.array(np.concatenate([values[placed], cut_up[:, 1 + c]])) for c, values in enumerate(whole)]], names=columns)

    kind = dict(docs.dtypes)["doc_id"]
    return python_rows(ranked).mapInArrow(freed(place), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
