"""Quality classifier: supervised subword embeddings.

Words and the character n-grams of a text hash to rows of an embedding table; their average goes through a softmax
over two classes.  Embeddings and softmax are learned together by stochastic gradient descent in numpy.  Because
the average comes before the softmax, a text's score needs one number for each hashed feature only: its embedding
times the difference of the two output vectors.

Learning takes at most PER_CLASS rows of each label (the smallest salted hashes of their ids), each as counts of
hashed features made on the executors, and no more of them than MAX_PAIRS features in all (again by the smallest hashes),
so what reaches the driver is bounded by 8 * MAX_PAIRS bytes, however long the labelled texts are.
Scoring covers whole texts of all rows, by row, without a shuffle.

Defined cases: an empty or null text has no features and gets the share of label 1 among the learning rows; null
labels aren't learned from; ids with both labels count as each of them once; without learning rows every score is 0.5;
columns called score, held_out or predicted are replaced, all others keep their values.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.common import extended, quoted, text_parts, tidy, written

BITS, DIM, EPOCHS, RATE = 16, 8, 8, 0.5
#: Character n-grams of these lengths (bytes of UTF-8), besides whole words.
NGRAMS = (3, 4)
PER_CLASS, MAX_PAIRS = 1200, 8_000_000
BATCH_BYTES = 250_000

MIX = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def features(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the texts raw[bounds[i]:bounds[i + 1]] and the text that each belongs to.

    An n-gram crosses no border of texts; white space takes part, so n-grams tell word starts and ends apart.
    """
    n = len(raw)
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)  # bytes from each place to its text's end
    shift = np.uint32(32 - BITS)
    wide = raw.astype(np.uint32)
    out, whose = [], []
    gram = wide.copy()
    for k in range(1, max(NGRAMS)):
        if n <= k:
            break
        gram = (gram[:-1] << np.uint32(8)) | wide[k:]
        if k + 1 in NGRAMS:
            ok = left[: n - k] > k
            out.append((((gram ^ np.uint32(k * 0x3C6EF372)) * np.uint32(0x9E3779B1)) >> shift)[ok])
            whose.append(owner[: n - k][ok])
    space = SPACE[raw]
    start = ~space
    start[1:] &= space[:-1] | (owner[1:] != owner[:-1])
    at = np.flatnonzero(start)
    if len(at):
        code = raw.astype(np.uint64) + np.uint64(1)
        code[space] = 0
        begun = np.concatenate([np.zeros(at[0], np.int64), np.repeat(at, np.diff([*at, n]))])
        words = np.add.reduceat(code * POWERS[(np.arange(n) - begun) & 63], at)
        out.append((((words ^ (words >> np.uint64(31))) * MIX) >> np.uint64(64 - BITS)).astype(np.uint32))
        whose.append(owner[at])
    if not out:
        return np.empty(0, np.uint32), np.empty(0, np.int32)
    return np.concatenate(out), np.concatenate(whose)


POWERS = np.array([pow(0xD6E8FEB86659FD93, k, 2**64) for k in range(64)], np.uint64)


def chunks(column: pa.Array):
    """(first row, features, owners, rows) for runs of rows of about BATCH_BYTES."""
    for a, raws in text_parts(column, BATCH_BYTES):
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
        yield a, *features(np.frombuffer(b"".join(raws), np.uint8), bounds), len(raws)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> tuple[np.ndarray, float]:
    """(weight of each hashed feature, prior logit) from (features, counts, label) rows."""
    labels = np.array([y for _, _, y in rows])
    if not len(rows) or labels.min() == labels.max():
        return np.zeros(1 << BITS, np.float32), 0.0 if not len(rows) else (4.0 if labels[0] else -4.0)
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    top = np.zeros((2, DIM), np.float32)
    weight = len(rows) / (2 * np.bincount(labels, minlength=2))
    for epoch in range(EPOCHS):
        for k, i in enumerate(rng.permutation(len(rows))):
            ids, counts, y = rows[i]
            rate = RATE * (1 - (epoch + k / len(rows)) / EPOCHS)
            share = (counts / counts.sum()).astype(np.float32)
            mean = share @ table[ids]
            z = top @ mean
            p = np.exp(z - z.max())
            p /= p.sum()
            err = p
            err[y] -= 1
            err *= weight[y] * rate
            back = err @ top
            top -= np.outer(err, mean).astype(np.float32)
            # A feature's share of a text falls with the text's length; the root of the number of features makes up for it, so
            # long texts teach their embeddings as fast as short ones.
            table[ids] -= np.outer(share * len(ids) ** 0.5, back).astype(np.float32)
    return (table @ (top[1] - top[0])).astype(np.float32), float(np.log(labels.mean() / (1 - labels.mean())))


def learning_rows(docs: DataFrame, labels: DataFrame, allowed: Column, per_class: int = PER_CLASS, text: str = "text", key: str = "doc_id", label: str = "quality") -> list:
    """At most per_class rows of each label among those where `allowed` (an expression on `key`) holds."""
    rank = F.xxhash64(F.lit("learn"), F.col(key))
    ids = labels.where(allowed & F.col(label).isin(0, 1)).select(key, F.col(label).cast("int").alias("y")).distinct()
    picked = None
    for y in (0, 1):
        own = ids.where(F.col("y") == y).orderBy(rank, key).limit(per_class)
        picked = own if picked is None else picked.union(own)
    texts = docs.select(key, text).join(F.broadcast(picked), key).select("y", text, rank.alias("rank"))

    def count(batches):
        for batch in batches:
            ys, ranks = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            out = []
            for a, found, owner, n in chunks(batch.column(1)):
                for i in range(n):
                    ids, counts = np.unique(found[owner == i], return_counts=True)
                    if len(ids):
                        out.append({"y": ys[a + i], "rank": ranks[a + i], "n": len(ids), "ids": ids.astype(np.int32), "counts": counts.astype(np.int32)})
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema([("y", pa.int32()), ("rank", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))]))

    counted = written(texts.mapInArrow(tidy(count), "y int, rank bigint, n bigint, ids array<int>, counts array<int>"))
    last, left = None, MAX_PAIRS
    for r in counted.select("rank", "n").orderBy("rank").collect():  # 2 * PER_CLASS rows at the most
        left -= r["n"]
        if left < 0:
            break
        last = r["rank"]
    if last is None:
        return []
    got = counted.where(F.col("rank") <= last).select("y", "ids", "counts").toArrow()
    y, ids, counts = (got.column(k).combine_chunks() for k in ("y", "ids", "counts"))
    rows = [(ids[i].values.to_numpy(), counts[i].values.to_numpy(), y[i].as_py()) for i in range(len(y))]
    return sorted(rows, key=lambda r: (r[2], len(r[0]), r[0].tobytes()))


def score(df: DataFrame, weights: np.ndarray, prior: float, text: str = "text", out: str = "score") -> DataFrame:
    """Adds the probability of label 1."""
    kept = [c for c in df.columns if c != out]
    df = df.select(*(quoted(c) for c in kept))
    at = kept.index(text)
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        table = shared.value
        for batch in batches:
            for a, found, owner, n in chunks(batch.column(at)):
                total = np.bincount(owner, weights=table[found], minlength=n)
                count = np.bincount(owner, minlength=n)
                z = np.where(count > 0, total / np.maximum(count, 1), prior)
                part = batch.slice(a, n)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=[*kept, out])

    return df.mapInArrow(tidy(run), extended(df, f"{out} double"))


def held_out(key: str = "doc_id") -> Column:
    """Ids with crc32(id as text) mod 3 = 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", per_class: int = PER_CLASS) -> DataFrame:
    """All rows of docs with held_out, score and predicted."""
    weights, prior = fit(learning_rows(docs, labels, ~held_out(key), per_class, text, key))
    return score(docs, weights, prior, text).withColumns({"held_out": held_out(key), "predicted": (F.col("score") >= 0.5).cast("int")})
