"""TIFF media columns: pages of 8- or 16-bit samples, written and read without an imaging library."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.shared import freed, map_rows, python_rows

# Fixed values of the TIFF 6.0 format: tags, compression schemes, and bytes per field type.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, FILL_ORDER = 256, 257, 258, 259, 262, 266
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PLANAR, PREDICTOR = 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES = 322, 323, 324, 325
SCHEMES = {"none": 1, "lzw": 5, "deflate": 8, "packbits": 32773}
OLD_DEFLATE = 32946
FIELD_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
LZW_CLEAR, LZW_END = 256, 257

#: Bytes that a stored byte can become at most, by scheme: the longest run, word or match that a format's shortest code stands for.
EXPANDS = {SCHEMES["none"]: 1, SCHEMES["packbits"]: 128, SCHEMES["lzw"]: 4096, SCHEMES["deflate"]: 1040, OLD_DEFLATE: 1040}


class TiffError(ValueError):
    """The bytes are not a TIFF file that this module reads."""


#: What reading a file that is broken, or made to break readers, can raise.
UNREADABLE = (TiffError, struct.error, ValueError, IndexError, OverflowError, MemoryError)


def pack_bits(data: bytes) -> bytes:
    """PackBits: runs of 2 to 128 equal bytes as (257 - n, byte), others as (n - 1, bytes)."""
    out, literal, at = bytearray(), bytearray(), 0

    def flush() -> None:
        for k in range(0, len(literal), 128):
            piece = literal[k : k + 128]
            out.append(len(piece) - 1)
            out.extend(piece)
        literal.clear()

    while at < len(data):
        run = 1
        while run < 128 and at + run < len(data) and data[at + run] == data[at]:
            run += 1
        if run >= 3:
            flush()
            out += bytes((257 - run, data[at]))
        else:
            literal += data[at : at + run]
        at += run
    flush()
    return bytes(out)


def unpack_bits(data: bytes, size: int) -> bytes:
    out, at = bytearray(), 0
    while at < len(data) and len(out) < size:
        head = data[at]
        if head < 128:
            out += data[at + 1 : at + 2 + head]
            at += 2 + head
        elif head > 128:
            out += data[at + 1 : at + 2] * (257 - head)
            at += 2
        else:
            at += 1
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    """LZW as in TIFF: most significant bit first, codes of 9 to 12 bits, widened one code early."""
    bits, held, out = 0, 0, bytearray()

    def put(code: int, width: int) -> None:
        nonlocal bits, held
        bits, held = (bits << width) | code, held + width
        while held >= 8:
            held -= 8
            out.append(bits >> held & 255)
        bits &= (1 << held) - 1

    codes = {bytes((i,)): i for i in range(256)}
    width, following, word = 9, 258, b""
    put(LZW_CLEAR, width)
    for value in data:
        longer = word + bytes((value,))
        if longer in codes:
            word = longer
            continue
        put(codes[word], width)
        codes[longer] = following
        following += 1
        if following == (1 << width) and width < 12:
            width += 1
        if following >= 4094:
            put(LZW_CLEAR, width)
            codes = {bytes((i,)): i for i in range(256)}
            width, following = 9, 258
        word = longer[-1:]
    if word:
        put(codes[word], width)
        following += 1
        if following == (1 << width) and width < 12:
            width += 1
    put(LZW_END, width)
    if held:
        put(0, 8 - held)
    return bytes(out)


def lzw_decode(data: bytes, size: int) -> bytes:
    out = bytearray()
    words: list[bytes] = []
    bits = held = at = 0
    width, previous = 9, b""
    while len(out) < size:
        while held < width:
            if at >= len(data):
                return bytes(out)
            bits, held, at = (bits << 8) | data[at], held + 8, at + 1
        held -= width
        code, bits = bits >> held, bits & ((1 << held) - 1)
        if code == LZW_END:
            break
        if code == LZW_CLEAR:
            words = [bytes((i,)) for i in range(256)] + [b"", b""]
            width, previous = 9, b""
            continue
        if not words:
            raise TiffError("LZW data begins without a clear code")
        if code < len(words):
            word = words[code]
        elif code == len(words) and previous:
            word = previous + previous[:1]
        else:
            raise TiffError("LZW code out of range")
        out += word
        if previous:
            words.append(previous + word[:1])
        previous = word
        if len(words) + 1 >= (1 << width) and width < 12:
            width += 1
    return bytes(out)


def compress(data: bytes, scheme: str) -> bytes:
    if scheme == "deflate":
        return zlib.compress(data, 6)
    return {"none": bytes, "packbits": pack_bits, "lzw": lzw_encode}[scheme](data)


def decompress(data: bytes, scheme: int, size: int) -> bytes:
    if scheme == SCHEMES["none"]:
        return data[:size]
    if scheme in (SCHEMES["deflate"], OLD_DEFLATE):
        try:
            return zlib.decompressobj().decompress(data, size)
        except zlib.error as error:
            raise TiffError(f"deflate: {error}") from error
    if scheme == SCHEMES["packbits"]:
        return unpack_bits(data, size)
    if scheme == SCHEMES["lzw"]:
        return lzw_decode(data, size)
    raise TiffError(f"compression {scheme} is not supported")


def encode_tiff(pages: list[np.ndarray], scheme: str = "deflate", predictor: int = 1, rows_per_strip: int = 64, tile: tuple[int, int] | None = None, order: str = "<") -> bytes:
    """A TIFF file of pages shaped (height, width, samples), uint8 or uint16; strips, or tiles of (height, width)."""
    out = bytearray(struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, 0))
    link = 4
    for page in pages:
        height, width, samples = page.shape
        kind = page.dtype.newbyteorder(order)
        if tile:
            blocks = []
            for top in range(0, height, tile[0]):
                for left in range(0, width, tile[1]):
                    block = np.zeros((*tile, samples), dtype=page.dtype)
                    part = page[top : top + tile[0], left : left + tile[1]]
                    block[: part.shape[0], : part.shape[1]] = part
                    blocks.append(block)
        else:
            blocks = [page[top : top + rows_per_strip] for top in range(0, height, rows_per_strip)]
        offsets, counts = [], []
        for block in blocks:
            if predictor == 2:
                block = np.concatenate([block[:, :1], np.diff(block, axis=1)], axis=1)
            packed = compress(block.astype(kind).tobytes(), scheme)
            offsets.append(len(out))
            counts.append(len(packed))
            out += packed
        entries = [
            (WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [page.dtype.itemsize * 8] * samples), (COMPRESSION, 3, [SCHEMES[scheme]]),
            (PHOTOMETRIC, 3, [2 if samples >= 3 else 1]), (SAMPLES, 3, [samples]), (PLANAR, 3, [1]), (PREDICTOR, 3, [predictor]),
        ]
        if tile:
            entries += [(TILE_WIDTH, 4, [tile[1]]), (TILE_HEIGHT, 4, [tile[0]]), (TILE_OFFSETS, 4, offsets), (TILE_BYTES, 4, counts)]
        else:
            entries += [(STRIP_OFFSETS, 4, offsets), (ROWS_PER_STRIP, 4, [rows_per_strip]), (STRIP_BYTES, 4, counts)]
        fields = []
        for tag, field_type, values in sorted(entries):
            packed = struct.pack(f"{order}{len(values)}{'H' if field_type == 3 else 'I'}", *values)
            if len(packed) > 4:
                out += b"\0" * (len(out) % 2)
                where, packed = len(out), packed
                out += packed
                packed = struct.pack(order + "I", where)
            fields.append(struct.pack(order + "HHI", tag, field_type, len(values)) + packed.ljust(4, b"\0"))
        out += b"\0" * (len(out) % 2)
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(fields)) + b"".join(fields)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


@dataclass
class Page:
    number: int
    width: int
    height: int
    samples: int
    bits: int
    data: bytes
    error: str | None = None


def _directory(data: bytes, at: int, order: str) -> tuple[dict[int, tuple], int]:
    (n,) = struct.unpack_from(order + "H", data, at)
    fields: dict[int, tuple] = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
        if kind not in FIELD_BYTES:
            continue
        where = at + 10 + 12 * k
        if FIELD_BYTES[kind] * count > 4:
            (where,) = struct.unpack_from(order + "I", data, where)
        if where + FIELD_BYTES[kind] * count > len(data):
            raise TiffError(f"field {tag} lies outside the file")
        if kind in (1, 3, 4):
            fields[tag] = struct.unpack_from(f"{order}{count}{ {1: 'B', 3: 'H', 4: 'I'}[kind] }", data, where)
    return fields, struct.unpack_from(order + "I", data, at + 2 + 12 * n)[0]


def _decode(data: bytes, fields: dict[int, tuple], order: str, number: int) -> Page:
    one = lambda tag, other: (fields.get(tag) or (other,))[0]
    if WIDTH not in fields or HEIGHT not in fields:
        raise TiffError("no width or height")
    width, height, samples, bits = one(WIDTH, 0), one(HEIGHT, 0), one(SAMPLES, 1), one(BITS, 1)
    if bits not in (8, 16) or len(set(fields.get(BITS, (8,)))) > 1:
        raise TiffError(f"{bits} bits a sample are not supported")
    if one(FILL_ORDER, 1) != 1 or one(PREDICTOR, 1) not in (1, 2) or (one(PLANAR, 1) != 1 and samples > 1):
        raise TiffError("fill order, predictor or plane layout is not supported")
    kind = np.dtype(f"{order}u{bits // 8}")
    if TILE_OFFSETS in fields:
        tall, wide = one(TILE_HEIGHT, 0), one(TILE_WIDTH, 0)
        offsets, counts = fields[TILE_OFFSETS], fields.get(TILE_BYTES, ())
    else:
        tall, wide = min(one(ROWS_PER_STRIP, height), max(height, 1)), width
        offsets, counts = fields.get(STRIP_OFFSETS, ()), fields.get(STRIP_BYTES, ())
    if not tall or not wide:
        raise TiffError("empty strips or tiles")
    across = -(-width // wide)
    if len(offsets) != across * -(-height // tall) or len(offsets) != len(counts):
        raise TiffError("the number of strips or tiles doesn't fit the size")
    if sum(counts) > len(data):
        raise TiffError("strips or tiles overlap")
    if height * width * samples * kind.itemsize > EXPANDS.get(one(COMPRESSION, 1), 1) * sum(counts):
        raise TiffError("a strip or tile is cut short")
    page = np.zeros((height, width, samples), dtype=kind.newbyteorder("="))
    for k, (offset, count) in enumerate(zip(offsets, counts)):
        top, left = k // across * tall, k % across * wide
        rows = tall if TILE_OFFSETS in fields else min(tall, height - top)
        size = rows * wide * samples * kind.itemsize
        raw = decompress(data[offset : offset + count], one(COMPRESSION, 1), size)
        if len(raw) < size:
            raise TiffError("a strip or tile is cut short")
        block = np.frombuffer(raw, dtype=kind).astype(page.dtype).reshape(rows, wide, samples)
        if one(PREDICTOR, 1) == 2:
            block = np.cumsum(block, axis=1, dtype=page.dtype)
        page[top : top + rows, left : left + wide] = block[: height - top, : width - left]
    return Page(number, width, height, samples, bits, page.tobytes())


def walk_pages(data: bytes | None) -> Iterator[Page]:
    """The pages in the order of their directories. What can't be read ends as a page with an error instead of samples.

    A null or empty value has no pages. A directory that comes a second time ends the walk. Samples of other than 8 or 16 bits,
    separate planes, other predictors and other schemes are errors, as are strips that can't hold the samples they should:
    a page takes no more memory than its file's strips can expand to, whatever its directory says.
    """
    if not data:
        return
    number, seen = 0, set()
    try:
        order = {b"II": "<", b"MM": ">"}.get(bytes(data[:2]))
        if order is None or len(data) < 8 or struct.unpack_from(order + "H", data, 2)[0] != 42:
            raise TiffError("no TIFF header")
        (at,) = struct.unpack_from(order + "I", data, 4)
        while at and at not in seen:
            seen.add(at)
            fields, following = _directory(data, at, order)
            try:
                yield _decode(data, fields, order, number)
            except UNREADABLE as error:
                yield Page(number, 0, 0, 0, 0, b"", str(error) or type(error).__name__)
            number, at = number + 1, following
    except UNREADABLE as error:
        yield Page(number, 0, 0, 0, 0, b"", str(error) or type(error).__name__)


def decode_tiff(media: DataFrame, key: str, content: str) -> DataFrame:
    """One row per page of a binary column: key, page, width, height, samples, bits, data, error."""

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32()] * 5 + [pa.binary(), pa.string()]
        for batch in batches:
            for k, value in enumerate(batch.column(content)):
                for p in walk_pages(value.as_py()):
                    made = [pa.array([v], kind) for v, kind in zip((p.number, p.width, p.height, p.samples, p.bits, p.data, p.error), kinds)]
                    yield pa.RecordBatch.from_arrays([batch.column(key).slice(k, 1), *made], names=[key, "page", "width", "height", "samples", "bits", "data", "error"])

    kind = dict(media.dtypes)[key]
    return python_rows(media.select(key, content)).mapInArrow(freed(pages), f"`{key}` {kind}, page int, width int, height int, samples int, bits int, data binary, error string")


#: Payload unit and image width: one row of samples a unit.
UNIT = 576

#: Rows of a page at most, so that a page's samples are bounded whatever the text's length.
PAGE_ROWS = 64

#: Ways to store a payload, dealt by its checksum: (scheme, predictor, rows a strip or (height, width) of a tile, byte order). Deflate comes
#: most often, because the others are coded byte by byte in Python.
LAYOUTS = [("lzw", 1, 16, "<"), ("lzw", 2, (32, 96), ">"), ("packbits", 1, (16, 192), "<"), ("packbits", 2, 16, ">"), ("none", 2, 16, "<"), ("none", 1, (64, 64), ">")]
LAYOUTS += [("deflate", 1 + k % 2, [64, 16, (64, 192), (16, 576)][k % 4], "<>"[k % 3 == 0]) for k in range(58)]


def store_payload(text: str | None) -> tuple[int, str, bytes]:
    """The text's UTF-8 bytes with 255s up to a positive multiple of 576, as the samples of a TIFF file: the bytes' number, layout and file."""
    raw = (text or "").encode()
    payload = raw + b"\xff" * (-len(raw) % UNIT if raw else UNIT)
    scheme, predictor, block, order = LAYOUTS[zlib.crc32(payload) % len(LAYOUTS)]
    samples = np.frombuffer(payload, dtype=np.uint8).reshape(-1, UNIT, 1)
    pages = [samples[k : k + PAGE_ROWS] for k in range(0, len(samples), PAGE_ROWS)]
    shape = {"tile": block} if isinstance(block, tuple) else {"rows_per_strip": block}
    layout = f"{scheme}, predictor {predictor}, {'tiles' if isinstance(block, tuple) else 'strips'}"
    return len(raw), layout, encode_tiff(pages, scheme, predictor, order=order, **shape)


def describe(pages: list[Page], payload: bytes) -> str:
    """Number of pages, mean, standard deviation, entropy in bits and mean step between neighbours of the samples read back."""
    samples = np.frombuffer(payload, dtype=np.uint8)
    counts = np.bincount(samples, minlength=256)
    n, values = len(samples), np.arange(256)
    mean = float((counts * values).sum()) / n
    deviation = max(0.0, float((counts * values * values).sum()) / n - mean * mean) ** 0.5
    shares = counts[counts > 0] / n
    entropy = float(-(shares * np.log2(shares)).sum())
    step = float(np.abs(np.diff(samples.astype(np.int16))).sum()) / max(1, n - 1)
    return f"pages={len(pages)};mean={mean:.3f};dev={deviation:.3f};entropy={abs(entropy):.4f};step={step:.3f}"


def text_media(docs: DataFrame) -> DataFrame:
    """Every text stored as a TIFF file, read back, and described; null is the empty text. See the query's columns.

    Rows don't depend on each other: equal texts have equal values, and repeated rows, ties and empty tables are ordinary. Long texts
    have several pages, each of ``PAGE_ROWS`` rows at most. Columns other than doc_id and text are not read.
    """

    def convert(texts: list[str | None]) -> list[tuple]:
        rows = []
        for text in texts:
            n_bytes, layout, media = store_payload(text)
            pages = list(walk_pages(media))
            for page in pages:
                if page.error:
                    raise TiffError(page.error)
            payload = b"".join(p.data for p in pages)
            rows.append((n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), describe(pages, payload), layout, len(pages)))
        return rows

    added = {"n_bytes": "long", "payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string", "layout": "string", "n_pages": "int"}
    return map_rows(docs, ["doc_id"], ["text"], added, convert)
