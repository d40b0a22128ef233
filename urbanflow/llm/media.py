"""Media columns: signature sniffing.

An Aho-Corasick automaton finds the magic bytes of known formats anywhere in a blob; a validator for each format
then confirms its structure and finds where the media ends.  Every confirmed media that doesn't lie inside another
one is carved out, and the longest of them (ties: the first) gives the corrected type.

`store` keeps a text as WAV samples, as uploads look: a quarter of them bare, the others behind a part header, before a
PNG thumbnail, or between both, all with a wrong declared type; what is read back has to be carved first.

Defined cases: null blobs count as empty; a blob without confirmed media keeps its declared type only if that
isn't a type that could have been confirmed, else it is application/octet-stream; magic bytes inside confirmed
media are part of it; columns called like the new ones are replaced, all others keep their values.  All work is by row,
without a shuffle.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.common import extended, pieces

#: Magic bytes and the media type each announces.
MAGIC = {
    b"RIFF": "audio/wav",
    b"\x89PNG\r\n\x1a\n": "image/png",
    b"GIF87a": "image/gif",
    b"GIF89a": "image/gif",
    b"\xff\xd8\xff": "image/jpeg",
    b"%PDF-": "application/pdf",
    b"PK\x03\x04": "application/zip",
    b"fLaC": "audio/flac",
}
OTHER = "application/octet-stream"
BATCH_BYTES = 2_000_000
FOUND = "array<struct<type:string,start:bigint,length:bigint>>"


def wav_end(b: bytes, at: int) -> int | None:
    """RIFF/WAVE: the chunks fill the stated length exactly, fmt before data."""
    if len(b) < at + 12 or b[at + 8 : at + 12] != b"WAVE":
        return None
    end, pos, seen = at + 8 + int.from_bytes(b[at + 4 : at + 8], "little"), at + 12, []
    if end > len(b):
        return None
    while pos + 8 <= end:
        seen.append(b[pos : pos + 4])
        if seen[0] != b"fmt ":
            return None
        n = int.from_bytes(b[pos + 4 : pos + 8], "little")
        pos += 8 + n + n % 2
    return end if pos == end and b"data" in seen else None


# The next four are walks: they yield where they are, and what follows depends on that alone.


def png_walk(b: bytes, at: int):
    """Chunks with right checksums from IHDR to IEND."""
    pos, first = at + 8, True
    while pos + 12 <= len(b):
        yield pos, first
        n = int.from_bytes(b[pos : pos + 4], "big")
        kind, stop = b[pos + 4 : pos + 8], pos + 12 + n
        if stop > len(b) or not kind.isalpha() or first and (kind, n) != (b"IHDR", 13) or zlib.crc32(memoryview(b)[pos + 4 : pos + 8 + n]) != int.from_bytes(b[stop - 4 : stop], "big"):
            return None
        pos, first = stop, False
        if kind == b"IEND":
            return pos
    return None


def gif_walk(b: bytes, at: int):
    """Screen descriptor, then blocks of sub-blocks, then the trailer."""
    if len(b) < at + 13:
        return None
    table = lambda flags: 3 << ((flags & 7) + 1) if flags & 0x80 else 0
    pos = at + 13 + table(b[at + 10])
    while pos < len(b):
        yield pos, "block"
        kind = b[pos]
        if kind == 0x3B:
            return pos + 1
        if kind == 0x21:
            pos += 2
        elif kind == 0x2C and pos + 10 <= len(b):
            pos += 11 + table(b[pos + 9])
        else:
            return None
        while pos < len(b) and b[pos]:
            yield pos, "part"
            pos += 1 + b[pos]
        pos += 1
    return None


def jpeg_walk(b: bytes, at: int):
    """Marker segments of stated length; entropy-coded data up to the end marker."""
    pos, scanned = at + 2, False
    while pos + 2 <= len(b) and b[pos] == 0xFF:
        yield pos, scanned
        kind = b[pos + 1]
        if kind == 0xD9:
            return pos + 2 if scanned else None
        if pos + 4 > len(b):
            return None
        pos += 2 + int.from_bytes(b[pos + 2 : pos + 4], "big")
        if kind == 0xDA:  # a scan goes on to the next marker that is neither a stuffed byte nor a restart
            scanned = True
            while (pos := b.find(b"\xff", pos)) >= 0 and pos + 1 < len(b) and (b[pos + 1] == 0 or 0xD0 <= b[pos + 1] <= 0xD7):
                yield pos, "scan"
                pos += 2
            if pos < 0:
                return None
    return None


def flac_walk(b: bytes, at: int):
    """Metadata blocks from STREAMINFO to the last one; frames carry no length, so they reach to the end."""
    pos, first = at + 4, True
    while pos + 4 <= len(b):
        yield pos, first
        head, n = b[pos], int.from_bytes(b[pos + 1 : pos + 4], "big")
        if first and (head & 0x7F or n != 34):
            return None
        first, pos = False, pos + 4 + n
        if head & 0x80:  # a frame follows: 14 bits of sync
            return len(b) if pos + 2 <= len(b) and b[pos] == 0xFF and b[pos + 1] & 0xFC == 0xF8 else None
    return None


def pdf_end(b: bytes, at: int) -> int | None:
    """Up to the last end mark (updates append further ones) before another header; each follows a startxref."""
    stop = b.find(b"%PDF-", at + 5)
    stop = stop if stop >= 0 else len(b)
    end = b.rfind(b"%%EOF", at, stop)
    return end + 5 if end >= 0 and b[at + 5 : at + 6].isdigit() and b.rfind(b"startxref", at, end) >= 0 else None


def zip_ends(b: bytes) -> dict[int, int]:
    """Where archives begin -> where they end: each end record tells where its archive's central directory lies, and so its start."""
    out, pos = {}, b.find(b"PK\x05\x06")
    while pos >= 0 and pos + 22 <= len(b):
        size, start, note = struct.unpack("<IIH", b[pos + 12 : pos + 22])
        if pos + 22 + note <= len(b):
            out.setdefault(pos - size - start, pos + 22 + note)
        pos = b.find(b"PK\x05\x06", pos + 4)
    return out


class Ends:
    """Of one blob: where the media that begins at a place ends, if it is one.

    End records are searched for once, and a walk that comes to a place from which another has failed stops there, so
    magic bytes repeated over a whole blob don't cost its square.
    """

    def __init__(self, blob: bytes):
        self.blob, self.failed, self.zips = blob, set(), None

    def __call__(self, kind: str, at: int) -> int | None:
        if kind in PLAIN:
            return PLAIN[kind](self.blob, at)
        if kind == "application/zip":
            self.zips = zip_ends(self.blob) if self.zips is None else self.zips
            return self.zips.get(at)
        walk, been = WALKS[kind](self.blob, at), []
        while True:
            try:
                place = (kind, *next(walk))
            except StopIteration as stop:
                if stop.value is None:
                    self.failed.update(been)
                return stop.value
            if place in self.failed:
                self.failed.update(been)
                return None
            been.append(place)


PLAIN = {"audio/wav": wav_end, "application/pdf": pdf_end}
WALKS = {"image/png": png_walk, "image/gif": gif_walk, "image/jpeg": jpeg_walk, "audio/flac": flac_walk}


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for magic, kind in MAGIC.items():
        a.add_word(magic.decode("latin-1"), (len(magic), kind))
    a.make_automaton()
    return a


def sniff_bytes(blob: bytes) -> list[tuple[str, int, int]]:
    """(type, start, length) of each confirmed media outside others, from left to right."""
    found, free, ends = [], 0, Ends(blob)
    for last, (n, kind) in automaton().iter(blob.decode("latin-1")):
        start = last + 1 - n
        if start >= free and (end := ends(kind, start)):
            found.append((kind, start, end - start))
            free = end
    return found


def store_wav(payload: bytes, rate: int = 8000) -> bytes:
    """Unsigned 8-bit mono samples; the payload's bytes are the samples."""
    pad = b"\0" * (len(payload) % 2)
    body = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", len(payload)) + payload + pad
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wav(media: bytes) -> bytes:
    pos = 12
    while media[pos : pos + 4] != b"data":
        n = int.from_bytes(media[pos + 4 : pos + 8], "little")
        pos += 8 + n + n % 2
    return media[pos + 8 : pos + 8 + int.from_bytes(media[pos + 4 : pos + 8], "little")]


def padded(raw: bytes, block: int = 192) -> bytes:
    """With spaces up to a positive multiple of `block`."""
    return raw + b" " * (-len(raw) % block if raw else block)


def feature(samples: bytes) -> str:
    """Mean, deviation and share of non-ASCII samples, in thousandths; equal samples, equal string."""
    x = np.frombuffer(samples, np.uint8)
    n, total, squares = len(x), int(x.sum(dtype=np.int64)), int((np.bincount(x, minlength=256) * np.arange(256, dtype=np.int64) ** 2).sum())
    return f"mean={total * 1000 // n};var={(squares * n - total * total) * 1000 // (n * n)};high={int((x > 127).sum()) * 1000 // n}"


def by_row(df: DataFrame, source: str, new: list[tuple[str, str, pa.DataType]], f) -> DataFrame:
    """df with the columns `new` that f makes of each value of `source`, in batches of bounded size."""
    names = [n for n, _, _ in new]
    kept = [c for c in df.columns if c not in names]
    df = df.select(*(f"`{c}`" for c in kept))
    at, schema = kept.index(source), extended(df, ", ".join(f"{n} {kind}" for n, kind, _ in new))

    def run(batches):
        for batch in batches:
            values = batch.column(at)
            lengths = [x or 0 for x in pc.binary_length(values).to_pylist()]
            for a, b in pieces([n + 500 for n in lengths], BATCH_BYTES):
                part = batch.slice(a, b - a)
                rows = [f(v) for v in part.column(at).to_pylist()]
                cols = [pa.array([r[i] for r in rows], t) for i, (_, _, t) in enumerate(new)]
                yield pa.RecordBatch.from_arrays([*part.columns, *cols], names=[*kept, *names])

    return df.mapInArrow(run, schema)


FOUND_ARROW = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))


def chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


#: A PNG of one grey pixel.
THUMBNAIL = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\x80")) + chunk(b"IEND", b"")
#: What stands before and after the WAV, by checksum of the payload.
LAYOUTS = [(b"", b""), (b"--part\r\nname=RIFF\r\n\r\n", b""), (b"", THUMBNAIL), (b"--part\r\n\r\n" + THUMBNAIL, b"\r\n--part--")]


def store(df: DataFrame, text: str = "text", out: str = "blob", declared: str = "declared_type", says: str = "image/png") -> DataFrame:
    """Whole text -> padded payload -> WAV, somewhere in `out`; `declared` is what an uploader might have claimed."""

    def one(t):
        raw = (t or "").encode()
        payload = padded(raw)
        before, after = LAYOUTS[zlib.crc32(payload) % len(LAYOUTS)]
        return len(raw), before + store_wav(payload) + after, says

    return by_row(df, text, [("n_bytes", "bigint", pa.int64()), (out, "binary", pa.binary()), (declared, "string", pa.string())], one)


def sniff(df: DataFrame, blob: str = "blob", declared: str = "declared_type") -> DataFrame:
    """Adds media (all confirmed), media_type (corrected), carved (bytes of each) and, of the first WAV, payload and feature."""

    def one(b):
        found = sniff_bytes(b or b"")
        carved = [b[s : s + n] for _, s, n in found]
        samples = next((read_wav(x) for (k, _, _), x in zip(found, carved, strict=True) if k == "audio/wav"), None)
        return [{"type": k, "start": s, "length": n} for k, s, n in found], carved, samples, feature(samples) if samples else None

    new = [("media", FOUND, FOUND_ARROW), ("carved", "array<binary>", pa.list_(pa.binary())), ("payload", "binary", pa.binary()), ("feature", "string", pa.string())]
    out = by_row(df, blob, new, one)
    known = F.col(declared).isin(*PLAIN, *WALKS, "application/zip")
    longest = F.array_max(F.transform("media", lambda m: F.struct(m["length"], -m["start"], m["type"].alias("type"))))
    return out.withColumn("media_type", F.when(F.size("media") > 0, longest["type"]).when(known | F.col(declared).isNull(), OTHER).otherwise(F.col(declared)))
