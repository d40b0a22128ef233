"""Alignment of two tokenizers over the exact distinct texts of a corpus.

Texts are shuffled whole: rows of one text meet after a partial count in each task, so a text with a million copies
costs one row of each task.  Each distinct text is tokenised and aligned once, by Arrow batches.  A links B where both
lie in one group, the bytes between two offsets at which tokens of both end.  The number of documents that hold an id
pair linked is the sum of the multiplicities of the distinct texts that do.  Each text then sums the counts of its own
pairs, and its measures go to all documents of that text.

Texts are cut at single spaces between two characters that aren't white space.  Neither tokenizer has a token across
such a place: the split pattern of A begins a match at the space, and no piece of B holds a space behind another
character (`Aligner` makes sure of it, and cuts nothing else).  So a worker remembers the ids of parts it has met, and
the libraries get the new ones only, at most LONG characters of them in a row; a part is never cut.

Pairs with more than 1 / HOT of all counts are at most HOT in number: only those are broadcast, and no other pair has
more rows than that share.  Where all pairs fit that bound, all are broadcast.

Defined cases: null and empty texts have no tokens, nor has a text whose joined token bytes (of A or B) aren't those of
a space and the text: all measures 0, the digest ''.  Documents keep their rows, repeated ids too; columns called like
the new ones are replaced, all others keep their values, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.byte_bpe import byte_table
from urbanflow.llm.common import extended, fresh, others, pieces, quoted, tidy, written

#: Bytes of text that are worked on at a time, characters that the libraries get in one piece.
BATCH_BYTES, LONG = 1_000_000, 200_000
#: Parts that a worker remembers, the first that it meets, and the longest of them in characters.
CACHE, CACHED_CHARS = 200_000, 40
#: A group with more links goes by its distinct ids, each with its number.
CROWDED = 1024
#: Rows of pair counts that may be broadcast.
HOT = 400_000
#: A pair of ids is one long: id of A times SHIFT plus id of B.
SHIFT = 1 << 20
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
NEW = (*MEASURES, "n_best", "count_sum", "groups_sha256")
CUT = re.compile(r"(?<=\S) (?=\S)")


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, each with the sum of its weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[first], np.add.reduceat(weights[order], first) if len(first) else weights


def links(a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """text * SHIFT ** 2 + pair and how often it is linked, and the links of each group.  text: of each group."""
    p, q = np.diff(a_cuts, prepend=0), np.diff(b_cuts, prepend=0)
    n = p * q
    few = np.flatnonzero(n <= CROWDED)
    of = np.repeat(few, n[few])
    k = np.arange(len(of)) - np.repeat(np.cumsum(n[few]) - n[few], n[few])
    keys = [(text[of] * SHIFT + a[a_cuts[of] - p[of] + k // q[of]]) * SHIFT + b[b_cuts[of] - q[of] + k % q[of]]]
    weights = [np.ones(len(of), np.int64)]
    for g in np.flatnonzero(n > CROWDED):
        (ua, na), (ub, nb) = (np.unique(ids[cuts[g] - size[g] : cuts[g]], return_counts=True) for ids, cuts, size in ((a, a_cuts, p), (b, b_cuts, q)))
        keys.append(((text[g] * SHIFT + ua)[:, None] * SHIFT + ub).ravel())
        weights.append((na[:, None] * nb).ravel())
    return *summed(np.concatenate(keys), np.concatenate(weights)), n


class Aligner:
    """Of one worker: both tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = {c: i for i, c in enumerate(byte_table())}
        vocab = self.a.get_vocab()
        bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            bytes_a[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        own = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(own)]
        self.bytes = bytes_a, bytes_b
        self.size = tuple(np.array([len(x) for x in v], np.int64) for v in self.bytes)
        self.shown = tuple(np.array([str(i) for i in range(len(v))], object) for v in self.bytes)
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.cuts = not any("▁" in p.lstrip("▁") for p in own)
        if max(map(len, self.bytes)) > SHIFT:
            raise ValueError(f"vocabularies of more than {SHIFT} ids")

    def rows(self, parts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """ids of A and B of each part; None where the tokens' bytes aren't those of a space and the part.

        Parts without white space at their ends stand in a row, and the ids are cut where the bytes of a part end.
        """
        out: list = [None] * len(parts)
        plain = [i for i, p in enumerate(parts) if self.cuts and p and not p[0].isspace() and not p[-1].isspace()]
        runs = [plain[x:y] for x, y in pieces([len(parts[i]) + 1 for i in plain], LONG)]
        runs += [[i] for i in sorted(set(range(len(parts))) - set(plain)) if parts[i]]
        texts = [" ".join([parts[i] for i in run]) for run in runs]
        both = zip(self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False), self.b.encode(texts, num_threads=1), strict=True)
        for run, (a, b) in zip(runs, both, strict=True):
            raw = [b" " + parts[i].encode() for i in run]
            stops = np.cumsum([len(r) for r in raw])
            sides = []
            for k, ids in enumerate((a.ids, b)):
                ids = np.array(ids, np.int32)
                if b"".join([self.bytes[k][i] for i in ids.tolist()]) == b"".join(raw):
                    sides.append((ids, np.searchsorted(np.cumsum(self.size[k][ids]), stops, "right").tolist()))
            if len(sides) == 2:
                (a, to_a), (b, to_b) = sides
                for i, p, q, r, s in zip(run, [0, *to_a], to_a, [0, *to_b], to_b, strict=False):
                    out[i] = a[p:q].tobytes(), b[r:s].tobytes()
            elif len(run) > 1:  # one of them is at fault
                half = len(run) // 2
                for own in (run[:half], run[half:]):
                    for i, ids in zip(own, self.rows([parts[i] for i in own]), strict=True):
                        out[i] = ids
        return out

    def encoded(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """ids of A and B of each text (none where its bytes differ), 4 bytes each."""
        known = self.known
        split = [CUT.split(t) if self.cuts else [t] for t in texts]
        new = sorted(set().union(*split) - known.keys())
        found = dict(zip(new, self.rows(new), strict=True))
        if len(known) < CACHE:
            known.update((p, ids) for p, ids in found.items() if len(p) <= CACHED_CHARS)
        out = []
        for parts in split:
            own = [known[p] if p in known else found[p] for p in parts]
            out.append((b"", b"") if None in own else (b"".join([x[0] for x in own]), b"".join([x[1] for x in own])))
        return out

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: its measures (a row each), the digest of its groups, where its pairs end; all pairs and their links."""
        ids = self.encoded(texts)
        counts = np.array([[len(x[k]) // 4 for x in ids] for k in (0, 1)], np.int64).reshape(2, -1)
        a, b = (np.frombuffer(b"".join([x[k] for x in ids]), np.int32).astype(np.int64) for k in (0, 1))
        # All texts in a row: tokens of both end where a text ends, so no group reaches over it.
        ends = tuple(np.cumsum(size[x]) for size, x in zip(self.size, (a, b), strict=True))
        shared = ends[0][np.isin(*ends, assume_unique=True, kind="sort")]
        a_cuts, b_cuts = (np.searchsorted(x, shared) + 1 for x in ends)
        groups = np.searchsorted(a_cuts, np.cumsum(counts[0]), "right")  # groups up to the end of each text
        groups[counts[0].cumsum() == 0] = 0
        text = np.repeat(np.arange(len(texts)), np.diff(groups, prepend=0))
        keys, times, n = links(a, b, a_cuts, b_cuts, text)
        n_links = np.bincount(text, n, len(texts)).astype(np.int64)
        shown = self.lines(a, b, a_cuts, b_cuts)
        digests, at = [], 0
        for end, size in zip(np.cumsum(counts.sum(axis=0)).tolist(), counts[0].tolist(), strict=True):
            digests.append(hashlib.sha256("".join(shown[at:end])[:-1].encode()).hexdigest() if size else "")
            at = end
        stops = np.searchsorted(keys, np.arange(1, len(texts) + 1) * SHIFT * SHIFT)
        return np.column_stack([*counts, np.diff(groups, prepend=0), n_links]), digests, stops, keys % (SHIFT * SHIFT), times

    def lines(self, a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> list[str]:
        """The ids of all groups in their order, each with the sign behind it: , within a side, | between sides, ; at the end."""
        of_a, of_b = (np.searchsorted(cuts, np.arange(len(x)), "right") for cuts, x in ((a_cuts, a), (b_cuts, b)))  # the group of each token
        at_a, at_b = np.arange(len(a)) + np.r_[0, b_cuts][of_a], np.arange(len(b)) + a_cuts[of_b]
        out = np.empty(len(a) + len(b), object)
        sign = np.full(len(out), ",", object)
        sign[at_a[a_cuts - 1]], sign[at_b[b_cuts - 1]] = "|", ";"
        out[at_a], out[at_b] = self.shown[0][a], self.shown[1][b]
        return (out + sign).tolist()


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def alignment(texts: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """texts without `text`, but with measures, groups_sha256, codes (pairs, rising) and links (how often each is linked)."""
    at, kept = texts.columns.index(text), others(texts, text)

    def run(batches):
        own = aligner(path_a, path_b)
        for batch in batches:
            sizes = [(n or 0) + 100 for n in pc.binary_length(batch.column(at)).to_pylist()]
            for x, y in pieces(sizes, BATCH_BYTES):
                part = batch.slice(x, y - x)
                measures, digests, stops, codes, times = own([t or "" for t in part.column(at).to_pylist()])
                ends = pa.array(np.r_[0, stops].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), *(pa.array(np.ascontiguousarray(m)) for m in measures.T), pa.array(digests, pa.string()), *(pa.ListArray.from_arrays(ends, pa.array(v)) for v in (codes, times))],
                    names=[*kept, *MEASURES, "groups_sha256", "codes", "links"])

    schema = extended(texts.select(*(quoted(c) for c in kept)), ", ".join(f"{m} bigint" for m in MEASURES) + ", groups_sha256 string, codes array<bigint>, links array<bigint>")
    return texts.mapInArrow(tidy(run), schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """code, documents (that hold the pair linked) and best (whether no pair of the same id of A has more)."""
    counts = aligned.select("copies", F.explode("codes").alias("code")).groupBy("code").agg(F.sum("copies").alias("documents"))
    counts = written(counts, "counts")
    top = counts.groupBy(F.expr(f"code div {SHIFT}").alias("a")).agg(F.max("documents").alias("most"))  # no more rows than ids of A
    return counts.join(top, F.expr(f"code div {SHIFT}") == F.col("a")).select("code", "documents", (F.col("documents") == F.col("most")).alias("best"))


def scores(aligned: DataFrame, counts: DataFrame, hot: int = HOT) -> DataFrame:
    """h1, h2 of each text with links, n_best and count_sum."""
    rows = aligned.select("h1", "h2", F.explode(F.arrays_zip("codes", "links")).alias("e")).select("h1", "h2", F.col("e.codes").alias("own"), "e.links")
    n, total = counts.agg(F.count("*"), F.sum("documents")).first()
    often = F.col("documents") > (total or 0) / hot  # no more than `hot` pairs
    sides = [(rows, F.broadcast(counts))]
    if n > hot:  # rows of frequent pairs aren't shuffled to the others
        top = F.broadcast(counts.where(often))
        sides = [(rows, top), (rows.join(top, F.col("own") == F.col("code"), "left_anti"), counts.where(~often))]
    out = None
    for part_rows, side in sides:
        met = part_rows.join(side, F.col("own") == F.col("code"))
        part = met.groupBy("h1", "h2").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("documents")).alias("count_sum"))
        out = part if out is None else out.unionByName(part)
    return out if len(sides) == 1 else out.groupBy("h1", "h2").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def text_hash(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def align_corpus(docs: DataFrame, path_a: str, path_b: str, text: str = "text", hot: int = HOT) -> DataFrame:
    """All rows of docs with their measures (NEW)."""
    texts = docs.select(quoted(text).alias("text")).where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    h1, h2 = text_hash(F.col("text"))
    aligned = written(alignment(texts.select(h1.alias("h1"), h2.alias("h2"), "copies", "text"), path_a, path_b), "aligned")
    linked = aligned.where("n_links > 0")
    own = scores(linked, written(pair_counts(linked), "pairs"), hot)
    measures = aligned.select("h1", "h2", *MEASURES, "groups_sha256").join(own, ["h1", "h2"], "left")

    mine = fresh(docs, "text_h1", "text_h2", *NEW)
    measures = written(measures.select("h1", "h2", *NEW).toDF(*mine), "measures")
    keyed = docs.withColumns(dict(zip(mine[:2], text_hash(quoted(text)), strict=True)))  # texts aren't shuffled where the caller drops them
    rows = keyed.join(measures, mine[:2], "left")
    kept = others(docs, *NEW)
    return rows.select(*(quoted(c) for c in kept), *(F.coalesce(F.col(c), F.lit("" if n == "groups_sha256" else 0)).alias(n) for n, c in zip(NEW, mine[2:], strict=True)))
