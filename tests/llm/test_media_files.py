"""TIFF files that are broken on purpose, and every way in which the query stores a text."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from tidemark.llm import tiff


def directory(entries, data=b"\0" * 64, order="<"):
    """A file of one directory: 16-bit or 32-bit fields of one value."""
    body = struct.pack(order + "H", len(entries)) + b"".join(struct.pack(order + "HHI", tag, 4, 1) + struct.pack(order + "I", value) for tag, value in entries) + b"\0\0\0\0"
    return (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(order + "I", 8 + len(data)) + data + body


HUGE = 2**32 - 1


@pytest.mark.parametrize("scheme", [1, 5, 8, 32773, 32946, 7])
@pytest.mark.parametrize("size", [(HUGE, HUGE), (HUGE, 1), (1, HUGE), (0, 0), (70_000, 70_000)])
def test_a_header_that_claims_too_much_is_an_error_row(scheme, size):
    for predictor in (1, 2):
        for further in ([(tiff.ROWS_PER_STRIP, HUGE), (tiff.STRIP_OFFSETS, 8), (tiff.STRIP_BYTES, 64)], [(tiff.TILE_WIDTH, HUGE), (tiff.TILE_HEIGHT, HUGE), (tiff.TILE_OFFSETS, 8), (tiff.TILE_BYTES, HUGE)]):
            entries = [(tiff.WIDTH, size[0]), (tiff.HEIGHT, size[1]), (tiff.BITS, 8), (tiff.COMPRESSION, scheme), (tiff.PREDICTOR, predictor), *further]
            found = list(tiff.walk_pages(directory(entries)))
            assert len(found) == 1 and found[0].error and not found[0].data


def test_damaged_files_never_raise():
    rng = random.Random(8)
    pages = [np.arange(40 * 30, dtype=np.uint8).reshape(40, 30, 1), np.zeros((5, 600, 3), dtype=np.uint16)]
    files = [tiff.encode_tiff(pages, scheme, predictor, 7, tile, order) for scheme in tiff.SCHEMES for predictor in (1, 2) for tile in (None, (16, 32)) for order in "<>"]
    for k in range(3000):
        data = bytearray(files[k % len(files)])
        for _ in range(rng.randint(1, 6)):
            data[rng.randrange(len(data))] = rng.choice([0, 1, 127, 128, 255, rng.randrange(256)])
        if rng.random() < 0.3:
            del data[rng.randrange(len(data)) :]
        for page in tiff.walk_pages(bytes(data)):
            assert page.error or len(page.data) == page.width * page.height * page.samples * page.bits // 8


def test_decode_gives_one_row_a_page_whatever_the_layout(spark):
    rng = np.random.default_rng(2)
    rows, expected = [], {}
    for k, (scheme, predictor, block, order) in enumerate(tiff.LAYOUTS[:14]):
        pages = [rng.integers(0, 200, size=(rng.integers(1, 40), rng.integers(1, 70), 1)).astype(np.uint8) for _ in range(1 + k % 3)]
        shape = {"tile": block} if isinstance(block, tuple) else {"rows_per_strip": block}
        rows.append((k, bytearray(tiff.encode_tiff(pages, scheme, predictor, order=order, **shape)), "w"))
        expected |= {(k, n): (p.shape[1], p.shape[0], p.tobytes()) for n, p in enumerate(pages)}
    out = tiff.decode_tiff(spark.createDataFrame(rows, "id long, content binary, width string"), "id", "content").collect()
    assert {(r["id"], r["page"]): (r["width"], r["height"], bytes(r["data"])) for r in out} == expected


def features(raw):
    """The description of a payload, number by number."""
    mean = sum(raw) / len(raw)
    deviation = max(0.0, sum(v * v for v in raw) / len(raw) - mean * mean) ** 0.5
    entropy = -sum(n / len(raw) * np.log2(n / len(raw)) for n in (raw.count(v) for v in set(raw)))
    step = sum(abs(a - b) for a, b in zip(raw, raw[1:])) / (len(raw) - 1)
    return f"pages={-(-len(raw) // (576 * tiff.PAGE_ROWS))};mean={mean:.3f};dev={deviation:.3f};entropy={abs(entropy):.4f};step={step:.3f}"


def test_the_query_stores_in_every_layout_and_on_several_pages(spark, tmp_path):
    from tidemark.llm import queries

    rng = random.Random(6)
    texts = [None, "", "x" * 576, "é" * 700, "\n", *["".join(rng.choice("abc é\n") for _ in range(rng.randint(1, 3000))) for _ in range(400)], "word " * 160_000]
    spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, layout string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: r for r in queries.op9_text_media(spark, str(tmp_path)).collect()}
    assert len(out) == len(texts) and {r["layout"] for r in out.values()} >= {f"{s}, predictor {p}, {'tiles' if isinstance(b, tuple) else 'strips'}" for s, p, b, _ in tiff.LAYOUTS}
    for doc_id, text in enumerate(texts):
        raw = (text or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        row = out[doc_id]
        media = tiff.store_payload(text)[2]
        assert b"".join(p.data for p in tiff.walk_pages(media)) == payload
        assert (row["media_bytes"], row["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())
        assert (row["n_bytes"], row["payload_bytes"], row["payload_sha256"], row["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert row["n_pages"] == -(-len(payload) // (576 * tiff.PAGE_ROWS))
        if len(payload) < 5000:
            assert row["feature"] == features(payload)
    assert out[len(texts) - 1]["n_pages"] > 20
