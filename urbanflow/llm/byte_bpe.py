"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file (base64 token and rank on each line) gives the vocabulary.  Bytes become printable characters by the
usual byte table, every way of joining two tokens to a third becomes a merge of that third token's rank, and the
library's model applies the merges to each match of the split pattern separately.  Decoding maps ids to the printable
characters of their tokens and reverses the byte table; an incremental decoder makes text of the bytes, so a character
that two tokens share is whole again, and only what the ids leave unfinished at either end becomes U+FFFD.

Defined cases: null text is empty; an empty text has no tokens; tokens may begin or end inside a character, and
then their offsets cover that character, so neighbours overlap; columns named like the new ones are replaced.
Nothing is shuffled: a lost executor costs its tasks only.  A worker remembers the ids of about CACHE pieces, from
task to task.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from urbanflow.llm.common import extended, others, pieces, quoted, tidy

#: About so many pieces of text a worker remembers, the first that it meets, and the longest of them in characters.
CACHE, CACHED_CHARS = 250_000, 64
#: Bytes of text that are worked on at a time.
BATCH_BYTES = 1_000_000
#: Ids that become bytes at a time.
DECODED_IDS = 100_000
#: Ids that become text at a time.
SLICE = 100_000
NEW = ["token_ids", "token_starts", "token_ends"]
ARRAYS = ", ".join(f"{name} array<int>" for name in NEW)


def byte_table() -> list[str]:
    """Byte -> printable character: printable Latin-1 bytes stand for themselves, others follow from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in (line.split() for line in f if line.strip())}


def model(path: str):
    """The library's BPE model over printable characters."""
    from tokenizers import models

    ranks, chars = vocabulary(path), byte_table()
    shown = {tok: "".join(chars[b] for b in tok) for tok in ranks}
    by_rank = sorted(ranks, key=ranks.get)
    merges = [(shown[t[:i]], shown[t[i:]]) for t in by_rank for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    return models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)


class Encoder:
    """Of one worker: splits texts and keeps the ids of pieces it has seen."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.split, self.apply, self.known = regex.compile(pattern).findall, model(path).tokenize, {}
        size = max(vocabulary(path).values()) + 1
        self.length = np.zeros(size, np.int64)
        for tok, rank in vocabulary(path).items():
            self.length[rank] = len(tok)
        self.chars = np.array([ord(c) for c in byte_table()], np.uint32)
        self.chars[0xFF] = ord("\n")  # no UTF-8 has this byte, and no printable character is the line feed

    def shown(self, parts: list[str]) -> list[str]:
        """Each part's bytes as printable characters."""
        raw = np.frombuffer(b"\xff".join([p.encode() for p in parts]), np.uint8)
        return self.chars[raw].tobytes().decode("utf-32-le").split("\n") if parts else []

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        parts = [self.split(t) for t in texts]
        known = self.known
        new = [p for p in set().union(*parts) if p not in known]
        found = {p: array("i", [t.id for t in self.apply(s)]).tobytes() for p, s in zip(new, self.shown(new), strict=True)}
        if len(known) < CACHE:
            known.update((p, ids) for p, ids in found.items() if len(p) <= CACHED_CHARS)
        rest = found.__getitem__
        return [np.frombuffer(b"".join([known[p] if p in known else rest(p) for p in ps]), np.int32) for ps in parts]


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def char_offsets(texts: list[str], ids: list[np.ndarray], length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and the one after the last of each token, by the bytes that the tokens cover."""
    starts, ends = [], []
    for text, own in zip(texts, ids, strict=True):
        raw = np.frombuffer(text.encode(), np.uint8)
        lead = np.cumsum((raw & 0xC0) != 0x80)  # characters begun up to each byte
        stop = np.cumsum(length[own])
        starts.append(lead[stop - length[own]] - 1)
        ends.append(lead[stop - 1])
    cat = lambda parts: np.concatenate(parts).astype(np.int32) if parts else np.empty(0, np.int32)
    return cat(starts), cat(ends)


def encoding(kept: list[str], text: str, path: str, pattern: str, offsets: bool):
    """batches with columns `kept` -> batches with token_ids (and offsets) added"""
    at, new = kept.index(text), NEW if offsets else NEW[:1]

    def run(batches):
        enc = encoder(path, pattern)
        for batch in batches:
            for a, b in pieces([(n or 0) + 200 for n in pc.binary_length(batch.column(at)).to_pylist()], BATCH_BYTES):
                part = batch.slice(a, b - a)
                own = [t or "" for t in part.column(at).to_pylist()]
                ids = enc(own)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = [np.concatenate(ids), *(char_offsets(own, ids, enc.length) if offsets else ())]
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in flat)], names=[*kept, *new])

    return run


class Decoder:
    """Printable characters of all tokens in one array, and the byte that each stands for."""

    def __init__(self, path: str):
        ranks, chars = vocabulary(path), byte_table()
        size = max(ranks.values()) + 1
        self.length, shown = np.zeros(size, np.int64), [""] * size
        for tok, rank in ranks.items():
            shown[rank] = "".join(chars[b] for b in tok)
            self.length[rank] = len(tok)
        self.start = np.cumsum(self.length) - self.length
        self.shown = np.frombuffer("".join(shown).encode("utf-32-le"), np.uint32)
        self.byte = np.zeros(512, np.uint8)
        for b, c in enumerate(chars):
            self.byte[ord(c)] = b

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, one after the other."""
        n = self.length[ids]
        begin = np.cumsum(n) - n
        at = np.repeat((self.start[ids] - begin).astype(np.int32), n)
        at += np.arange(len(at), dtype=np.int32)
        return self.byte[self.shown[at]]


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def decoding(kept: list[str], ids: str, path: str, out: str):
    """batches with columns `kept` -> batches with `out` added"""
    at = kept.index(ids)

    def run(batches):
        dec = decoder(path)
        for batch in batches:
            for a, b in pieces([(n or 0) + 50 for n in pc.list_value_length(batch.column(at)).to_pylist()], DECODED_IDS):
                part = batch.slice(a, b - a)
                lists = part.column(at)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.concatenate([[0], np.cumsum([n or 0 for n in pc.list_value_length(lists).to_pylist()])])
                stops = np.concatenate([[0], np.cumsum(dec.length[flat])])[ends].astype(np.int32)
                raw = pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(stops.tobytes()), pa.py_buffer(dec(flat).tobytes())])
                yield pa.RecordBatch.from_arrays([*part.columns, raw], names=[*kept, out])

    return run


def stream_text(path: str, slices) -> Iterator[str]:
    """Text of slices of ids, one after the other: each gives the characters that are whole by its end."""
    import codecs

    dec, partly = decoder(path), codecs.getincrementaldecoder("utf-8")("replace")
    for ids in slices:
        yield partly.decode(dec(np.asarray(ids, np.int64)).tobytes())
    yield partly.decode(b"", final=True)


def decode_text(df: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded_text") -> DataFrame:
    """Adds `out`, the text of the ids; ids that begin or end inside a character leave U+FFFD there."""
    df = without(df, out)
    kept, at = df.columns, df.columns.index(ids)

    def run(batches):
        for batch in batches:
            texts = ["".join(stream_text(path, (x[i : i + SLICE] for i in range(0, len(x), SLICE)))) for x in (x or [] for x in batch.column(at).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, out])

    return df.mapInArrow(tidy(run), extended(df, f"{out} string"))


def without(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*(quoted(c) for c in others(df, *names)))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = True) -> DataFrame:
    """Adds token_ids array<int> and, with offsets, token_starts and token_ends (characters)."""
    new = NEW if offsets else NEW[:1]
    df = without(df, *new)
    return df.mapInArrow(tidy(encoding(df.columns, text, path, pattern, offsets)), extended(df, ARRAYS if offsets else f"{NEW[0]} array<int>"))


def decode(df: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Adds `out`, the bytes that the ids stand for.  Bytes, since a slice of ids may cut a character in two."""
    df = without(df, out)
    return df.mapInArrow(tidy(decoding(df.columns, ids, path, out)), extended(df, f"{out} binary"))


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "decoded") -> DataFrame:
    """encode, with offsets, then decode, by one worker: the ids aren't sent to a second one."""
    df = without(df, *NEW, out)
    there, back = encoding(df.columns, text, path, pattern, True), decoding([*df.columns, *NEW], NEW[0], path, out)
    return df.mapInArrow(tidy(lambda batches: back(there(batches))), extended(df, f"{ARRAYS}, {out} binary"))


