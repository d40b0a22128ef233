"""Sniffing takes time in proportion to the blob, whatever it is made of."""

import time

import pytest

from urbanflow.llm import media

UNITS = {
    "zip": b"PK\x03\x04", "zip ends": b"PK\x03\x04PK\x05\x06" + bytes(18), "gif": b"GIF89a" + bytes(7) + b"!\xff\x01x", "jpeg": b"\xff\xd8\xff\xe0\x00\x02", "jpeg scans": b"\xff\xd8\xff\xda\x00\x02\xff\x00",
    "flac": b"fLaC\x00\x00\x00\x22" + bytes(34), "png": b"\x89PNG\r\n\x1a\n", "pdf": b"%PDF-1 %%EOF", "riff": b"RIFF\xff\x00\x00\x00WAVE",
}


@pytest.mark.parametrize("name", UNITS)
def test_time_is_linear(name):
    def seconds(n):
        blob = (UNITS[name] * (n // len(UNITS[name]) + 1))[:n]
        began = time.process_time()
        media.sniff_bytes(blob)
        return time.process_time() - began

    seconds(1000)
    small, large = min(seconds(200_000) for _ in range(3)), min(seconds(1_600_000) for _ in range(2))
    assert large < 16 * small + 0.2, (small, large)


def test_stops_change_no_result():
    """Walks that meet the failed ones of others give what they give alone."""
    import random

    rng = random.Random(1)
    png, gif = media.THUMBNAIL, b"GIF89a" + bytes(7) + b";"
    parts = [*UNITS.values(), png, png[:-3], gif, media.store_wav(b"abcd"), b"\xff\xd9", b"\xff\x00", b"!", b";", b"\x00", b"x"]
    for _ in range(400):
        blob = b"".join(rng.choices(parts, k=rng.randint(1, 12)))
        found, free = [], 0
        for last, (n, kind) in media.automaton().iter(blob.decode("latin-1")):
            start = last + 1 - n
            if start >= free and (end := media.Ends(blob)(kind, start)):
                found.append((kind, start, end - start))
                free = end
        assert media.sniff_bytes(blob) == found


def test_null_and_empty_blobs(spark):
    df = spark.createDataFrame([(1, None, None), (2, bytearray(), "image/png"), (3, bytearray(media.THUMBNAIL), None)], "k int, blob binary, declared_type string")
    got = {r.k: (r.media_type, len(r.media), r.payload) for r in media.sniff(df).collect()}
    assert got == {1: (media.OTHER, 0, None), 2: (media.OTHER, 0, None), 3: ("image/png", 1, None)}
