"""Word shingle sets as arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Fixed odd multipliers that spread the words of a shingle and the bits of its hash.
SPREAD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)

#: Words hashed at once.
CHUNK_CHARS = 2_000_000


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Finalise, so that the order of hashes is unrelated to what they are made of."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(MIX[0])
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(MIX[1])
    return values ^ (values >> np.uint64(32))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; one per position from which a whole run follows."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            total = (total ^ hashes[k : k + n]) * np.uint64(SPREAD[k % len(SPREAD)] + 2 * (k // len(SPREAD)))
            total ^= total >> np.uint64(31)
    return mixed(total)


def split_words(text: str | None, lower: bool) -> list[bytes]:
    """Words between ASCII white space; ``lower`` turns A to Z, and no other letters, to lower case."""
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def hashed_words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Word hashes of whole texts, about ``CHUNK_CHARS`` bytes at once: the first text's number, the hashes, and the texts' ends in them.

    Words are unchanged and as in ``split_words``. Arrow tells them apart, so each distinct word of a chunk is hashed once.
    """
    texts = pc.fill_null(texts, "")
    bytes_upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(texts):
        before = bytes_upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(bytes_upto, before + CHUNK_CHARS, "right")))
        split = pc.ascii_split_whitespace(texts[first:last])
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.cast(pa.binary()).to_pylist()
        index = words.indices.to_numpy(zero_copy_only=False)
        there = np.fromiter(map(len, distinct), dtype=np.int64, count=len(distinct))[index] > 0
        upto = np.concatenate([[0], np.cumsum(there)])
        ends = upto[np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]
        yield first, word_hashes(distinct)[index[there]], ends
        first = last


def text_chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK_CHARS`` characters."""
    first = chars = 0
    for k, text in enumerate(texts):
        chars += len(text or "")
        if chars >= CHUNK_CHARS:
            yield first, k + 1
            first, chars = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text. Fewer words than ``width`` are one shingle; no words, none."""
    for first, last in text_chunks(texts):
        split = [split_words(text, True) for text in texts[first:last]]
        hashes = word_hashes([w for words in split for w in words])
        runs = rolling(hashes, width)
        at = 0
        for words in split:
            n = len(words)
            if n >= width:
                yield np.unique(runs[at : at + n - width + 1])
            elif n:
                yield mixed(rolling(hashes[at : at + n], n) + np.uint64(n))
            else:
                yield np.zeros(0, dtype=np.uint64)
            at += n
