"""N-gram Jaccard join: classes of documents whose sets of 5-word shingles link at a similarity of 0.8 or more.

A grouped prefix join.  Shingles have one order, rarest first; two sets that link share a shingle among the first
n - ceil(0.8 n) + 1 of each.

1. `sets`: size and digest of each document's set; documents of equal sets are one class from here on (copies, linked).
2. `able`: classes of whose shingles other documents have at least 0.8 n; the rest can't link and leave.  Tasks sort
   about a million shingles at a time (a flush), send each once, packed in a blob for each bucket of the hash, and get
   one answer from each bucket.  The number of buckets is in proportion to all shingles.
3. `prefixes`: counts again, among classes that are left, order each one's shared shingles; shingles that are frequent
   within a task count as equally frequent everywhere and aren't sent by class, so a shingle that a third of all
   documents have costs a row per task.
4. Classes with the same prefix and size form a group; groups are the rows of the posting lists (`postings`).
5. `stars`: in each list and size band the group with the fewest lone shingles (the text that others were made from)
   is the head.  Each class is verified against one head, and heads against those of the next band: a set is sent
   once.  What links is connected.
6. `open_members`: lists whose groups all have one component are done.  Only groups with a list that still holds two
   components are expanded into members, with the clusters that they form through such lists.
7. `units`: the members of a cluster are dealt to blocks by size band, the band's largest component ("main") apart
   from the rest; pairs of blocks that may hold links between components are units of work.  Two blocks of one main
   component are no unit, so a set is sent once per block of the rest.  `unit_links` compares groups by an index of
   prefix shingles and verifies whole sets of members.
8. `components` of all links give the smallest key.

`similar_pairs` leaves out 5 and the components and returns every link between classes.

Shingles are 64-bit hashes of five word hashes (words by a polynomial over bytes), so two different shingles are
taken for one with a chance of about 1e-19 a pair; equal sets are told by 128 bits.  Intermediate tables go to the
shared checkpoint folder.  Cost: a cluster of m sets that share prefixes but mostly don't link has units in proportion
to (m / BLOCK) ** 2; that is the price of exactness, since any of its pairs may be the one that links.

Defined cases: null and empty texts have an empty set and link with nothing; fewer than five words are one shingle;
rows that share a key or have none are documents by themselves; component_id is the smallest key of the component,
null only if all its rows have none.  Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.common import quoted, same, text_parts, tidy, tidy_group, written

WORDS = 5
NUM, DEN = 80, 100
BATCH_BYTES, FLUSH, BUCKET = 500_000, 1_000_000, 1_500_000
#: A block has at most so many members, and about so many bytes of sets.
BLOCK, BLOCK_BYTES = 256, 8_000_000
#: A shingle that so many documents of one flush have is "frequent": last in the order.
FREQUENT = 64
HOT = np.uint32(0xFFFFFFFF)
BROADCAST_ROWS = 1_000_000

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
BASE = 0x9E3779B97F4A7C15
POWERS = np.array([pow(BASE, k, 2**64) for k in range(4096)], np.uint64)
STEPS = np.array([pow(0xD1342543DE82EF95, k, 2**64) for k in range(WORDS)], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def power(k: np.ndarray) -> np.ndarray:
    """BASE ** k modulo 2 ** 64."""
    out = POWERS[k & 4095]
    if len(k) and k.max() > 4095:
        far = np.array([pow(BASE, int(x) << 12, 2**64) for x in range(int(k.max() >> 12) + 1)], np.uint64)
        out = out * far[k >> 12]
    return out


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of the bytes."""
    space = SPACE[raw]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    begun = np.concatenate([np.zeros(starts[0], np.int64), np.repeat(starts, np.diff([*starts, len(raw)]))])
    place = np.arange(len(raw)) - begun
    code = FOLD[raw].astype(np.uint64) + np.uint64(1)
    code[space] = 0
    return mixed(np.add.reduceat(code * power(place), starts) + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    for _, own in text_parts(texts, BATCH_BYTES):
        joined = np.frombuffer(b"\n".join(own), np.uint8)
        words, starts = word_hashes(joined)
        bounds = np.searchsorted(starts, np.cumsum([0, *(len(r) + 1 for r in own)]))
        for i in range(len(own)):
            w = words[bounds[i] : bounds[i + 1]]
            if len(w) >= WORDS:
                h = mixed(sum(w[k : len(w) - WORDS + 1 + k] * STEPS[k] for k in range(WORDS)))
                h.sort()
                out.append(h[np.concatenate([[True], h[1:] != h[:-1]])])
            else:
                out.append(mixed(np.array([(w * STEPS[: len(w)]).sum() + np.uint64(len(w))], np.uint64)) if len(w) else np.empty(0, np.uint64))
    return out


def least(n):
    """ceil(0.8 n)"""
    return -(-n * NUM // DEN)


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sets(docs: DataFrame) -> DataFrame:
    """key, version (hash of the text), n and digest of each row's set.  docs: key, version, text."""

    def run(batches):
        for batch in batches:
            found = shingle_sets(batch.column(2))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([len(s) for s in found], pa.int64()), pa.array([digest(s) for s in found], pa.binary())], names=["key", "version", "n", "digest"])

    return docs.mapInArrow(tidy(run), "key bigint, version bigint, n bigint, digest binary")


def flushes(batches, named_sets):
    """Runs of (names, sets) with about FLUSH shingles; equal names once for a run."""
    names, own, total, seen = [], [], 0, set()
    for batch in batches:
        for name, s in named_sets(batch):
            if len(s) and name not in seen:
                seen.add(name)
                names.append(name)
                own.append(s)
                total += len(s)
            if total >= FLUSH or len(names) == 65_000:
                yield names, own
                names, own, total, seen = [], [], 0, set()
    if names:
        yield names, own


def pack(keys: np.ndarray) -> bytes:
    """48-bit numbers in six bytes each."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view("<u8")


#: A flush sends itself (names and sizes, and the shingles that it knows to be shared) and asks each bucket about the
#: others; a bucket answers each flush.  A name is 16 bytes; keys: six bytes a shingle; owner: its set's place in the flush.
BLOBS = {"bucket": pa.int32(), "flush": pa.int64(), "names": pa.binary(), "sizes": pa.binary(), "keys": pa.binary(), "owner": pa.binary(), "df": pa.binary()}
BLOBS_DDL = "bucket int, flush bigint, names binary, sizes binary, keys binary, owner binary, df binary"
NO_ONE = np.uint16(0xFFFF)


def sent(batches, named_sets, buckets: int, locally: int):
    """Rows of BLOBS: each shingle key with its document, or once for nobody if `locally` documents of a flush have it.

    A flush is named by its task's partition and its number there, which a repeated task finds again.
    """
    base = TaskContext.get().partitionId() << 32
    for number, (names, own) in enumerate(flushes(batches, named_sets)):
        sizes = np.array([len(s) for s in own], np.uint32)
        keys = np.concatenate(own) >> np.uint64(16)
        owner = np.repeat(np.arange(len(own), dtype=np.uint16), sizes)
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        times = np.diff([*first, len(keys)])
        many = np.repeat(times >= locally, times)
        marks = first[times >= locally]
        at = np.concatenate([np.flatnonzero(~many), marks])
        who = owner[at].copy()
        who[len(at) - len(marks) :] = NO_ONE
        place = (keys[at] % np.uint64(buckets)).astype(np.int32)
        sort = np.argsort(place, kind="stable")
        at, who, place = at[sort], who[sort], place[sort]
        edges = np.searchsorted(place, np.arange(buckets + 1))
        flush = base + number
        rows = [(flush % buckets, flush, b"".join(names), sizes.tobytes(), pack(keys[many]), owner[many].tobytes(), None)]
        rows += [(b, flush, None, None, pack(keys[at[a:z]]), who[a:z].tobytes(), None) for b, (a, z) in enumerate(zip(edges, edges[1:], strict=False)) if a < z]
        yield blobs(rows)


def blobs(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), BLOBS.values(), strict=True)], names=list(BLOBS))


def answered(table: pa.Table) -> pa.Table:
    """A bucket's answers: of each flush's shingles those that other documents have, with their count; HOT at a mark."""
    rows = [r for r in table.to_pylist() if r["names"] is None]
    out = [tuple(r.values()) for r in table.to_pylist() if r["names"] is not None]
    if rows:
        keys, owner = np.concatenate([unpack(r["keys"]) for r in rows]), np.concatenate([np.frombuffer(r["owner"], np.uint16) for r in rows])
        flush = np.repeat(np.arange(len(rows)), [len(r["owner"]) // 2 for r in rows])
        order = np.argsort(keys, kind="stable")
        keys, owner, flush = keys[order], owner[order], flush[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        times = np.diff([*first, len(keys)])
        df = np.where(np.maximum.reduceat(owner == NO_ONE, first), HOT, times.astype(np.uint32))
        df = np.repeat(df, times)
        some = np.flatnonzero((df > 1) & (owner != NO_ONE))
        some = some[np.argsort(flush[some], kind="stable")]
        edges = np.searchsorted(flush[some], np.arange(len(rows) + 1))
        out += [(rows[0]["bucket"], r["flush"], None, None, pack(keys[p]), owner[p].tobytes(), df[p].tobytes()) for r, p in zip(rows, (some[a:z] for a, z in zip(edges, edges[1:], strict=False)), strict=True) if len(p)]
    return pa.Table.from_batches([blobs(out)]) if out else pa.schema(list(BLOBS.items())).empty_table()


def asked(df: DataFrame, named_sets, buckets: int, locally: int) -> DataFrame:
    rows = df.mapInArrow(tidy(lambda batches: sent(batches, named_sets, buckets, locally)), BLOBS_DDL)
    return rows.groupBy("bucket").applyInArrow(tidy_group(answered), BLOBS_DDL).groupBy("flush")


def of_flush(table: pa.Table):
    """names and sizes of a flush's sets, and (owner, keys, df) of its shared shingles by owner."""
    rows = table.to_pylist()
    own = next(r for r in rows if r["names"] is not None)
    owner = np.concatenate([np.frombuffer(r["owner"], np.uint16) for r in rows])
    keys = np.concatenate([unpack(r["keys"]) for r in rows])
    df = np.concatenate([np.frombuffer(r["df"], np.uint32) if r["df"] is not None else np.full(len(r["owner"]) // 2, HOT) for r in rows])
    names = [own["names"][i : i + 16] for i in range(0, len(own["names"]), 16)]
    return names, np.frombuffer(own["sizes"], np.uint32).astype(np.int64), owner, keys, df


def text_sets(batch):
    return ((digest(s), s) for s in shingle_sets(batch.column(0)))


def stored_sets(batch):
    return ((int(c).to_bytes(16, "little"), np.frombuffer(x, np.uint64)) for c, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))


def able(docs: DataFrame, buckets: int) -> DataFrame:
    """digest of sets that share enough of their shingles with others to link.  docs: text."""

    def enough(table: pa.Table) -> pa.Table:
        names, sizes, owner, _, _ = of_flush(table)
        some = np.flatnonzero(DEN * np.bincount(owner, minlength=len(names)) >= NUM * sizes)
        return pa.table({"digest": pa.array([names[i] for i in some], pa.binary())})

    return asked(docs, text_sets, buckets, 2).applyInArrow(tidy_group(enough), "digest binary").distinct()


def prefixes(stored: DataFrame, buckets: int) -> DataFrame:
    """cls, n, lone (shingles that no other class has) and prefix (rarest shared shingles first) of classes that may link.

    stored: cls, shingles.
    """

    def choose(table: pa.Table) -> pa.Table:
        names, sizes, owner, keys, df = of_flush(table)
        order = np.lexsort((keys, df, owner))
        owner, keys = owner[order], keys[order]
        edges = np.searchsorted(owner, np.arange(len(names) + 1))
        lone = sizes - np.diff(edges)
        keep = np.maximum(0, sizes - least(sizes) + 1 - lone)
        some = np.flatnonzero(keep)
        prefix = pa.array([keys[edges[i] : edges[i] + keep[i]].astype(np.int64) for i in some], pa.list_(pa.int64()))
        return pa.table({"cls": pa.array([int.from_bytes(names[i], "little") for i in some], pa.int64()), "n": sizes[some], "lone": lone[some], "prefix": prefix})

    return asked(stored, stored_sets, buckets, FREQUENT).applyInArrow(tidy_group(choose), "cls bigint, n bigint, lone bigint, prefix array<bigint>")


def components(edges: DataFrame) -> DataFrame:
    """id, label (least id of its component) for each end of edges a, b: least labels of neighbours with pointer jumps."""
    both = written(edges.select(F.col("a").alias("id"), F.col("b").alias("to")).union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy("id").agg(F.least("id", F.min("to")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("to"), "label"), "to").groupBy("id").agg(F.min("label").alias("near"))
        step = labels.join(near, "id").select("id", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = step.join(labels.select(F.col("id").alias("label"), F.col("label").alias("further")), "label", "left")
        step = written(jump.select("id", "was", F.least("label", "further").alias("label")), "labels")
        if step.where("was <> label").isEmpty():
            return step.select("id", "label")
        labels = step.select("id", "label")


def rooted(near: DataFrame) -> DataFrame:
    """cls and label of classes that link with their head: the head, or the head of its head, up to four steps away.

    Links lead to a lower rank in a band or to the next band, never in a circle.  Classes of one label are connected;
    the reverse is left to `components`.
    """
    step = near.groupBy(F.col("a").alias("cls")).agg(F.min("b").alias("label"))
    for _ in range(2):
        on = step.select(F.col("cls").alias("label"), F.col("label").alias("further"))
        step = step.join(on, "label", "left").select("cls", F.coalesce("further", "label").alias("label"))
    heads = step.select(F.col("label").alias("cls")).distinct().join(step.select("cls"), "cls", "left_anti").select("cls", F.col("cls").alias("label"))
    return written(step.unionByName(heads), "label")


def band() -> Column:
    """Sizes in bands of a factor 0.8: sets link only within a band or with the next one."""
    return F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(DEN / NUM + 1e-7))).cast("int")


def postings(groups: DataFrame) -> DataFrame:
    """gid, n, band, lone and key: a row per prefix shingle of each group."""
    return groups.select("gid", "n", band().alias("band"), "lone", F.explode("prefix").alias("key"))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def linked(common: int, a: int, b: int) -> bool:
    return DEN * common >= NUM * (a + b - common)


def against_head(table: pa.Table) -> pa.Table:
    """Links a (a member), b (the head) of one head and some of its members."""
    rows = table.to_pylist()
    head = next((np.frombuffer(r["shingles"], np.uint64) for r in rows if r["cls"] is None), None)
    found = []
    for r in rows:
        if r["cls"] is not None and head is not None:
            own = np.frombuffer(r["shingles"], np.uint64)
            if linked(overlap(own, head), len(own), len(head)):
                found.append(r["cls"])
    return pa.table({"a": pa.array(found, pa.int64()), "b": pa.array([rows[0]["head"]] * len(found), pa.int64())})


def stars(members: DataFrame, posts: DataFrame, stored: DataFrame) -> DataFrame:
    """Links a, b of classes with the head of one of their lists, and of heads with those of the next band.

    members: cls, gid; posts: `postings`; stored: cls, shingles.
    """
    rank = F.struct("lone", "gid", "n")
    heads = written(posts.groupBy("key", "band").agg(F.min(rank).alias("head")), "heads")
    chosen = posts.select("gid", "n", "key", "band").join(heads, ["key", "band"]).groupBy("gid").agg(F.min("head").alias("head"))
    pairs = members.join(chosen, "gid").select("cls", F.col("head.gid").alias("head"))
    upper = heads.select("key", (F.col("band") - 1).alias("band"), F.col("head").alias("upper"))
    near = heads.join(upper, ["key", "band"]).where(DEN * F.col("head.n") >= NUM * F.col("upper.n"))
    pairs = written(pairs.unionByName(near.select(F.col("head.gid").alias("cls"), F.col("upper.gid").alias("head"))).where("cls <> head").distinct(), "pairs")
    # Heads of more than BLOCK members, at most one per BLOCK rows, are sent several times.
    large = written(pairs.groupBy("head").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")).where("parts > 1"), "large")
    large = few(large, large.count())
    dealt = pairs.join(large, "head", "left").withColumn("part", F.pmod(F.xxhash64("cls"), F.coalesce("parts", F.lit(1))).cast("int"))
    rows = dealt.select("head", "part", "cls").join(stored.select("cls", "shingles"), "cls").select("head", "part", "cls", "shingles")
    tops = pairs.select("head").distinct().join(large, "head", "left").select(F.col("head").alias("cls"), F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
    tops = tops.join(stored.select("cls", "shingles"), "cls").select(F.col("cls").alias("head"), "part", F.lit(None).cast("bigint").alias("cls"), "shingles")
    return rows.unionByName(tops).groupBy("head", "part").applyInArrow(tidy_group(against_head), "a bigint, b bigint")


def clusters(posts: DataFrame) -> DataFrame:
    """gid and cluster of groups that meet in posting lists (through others).  posts: gid, key."""
    heads = written(posts.groupBy("key").agg(F.min("gid").alias("head"), F.count("*").alias("k")).where("k > 1").select("key", "head"), "heads")
    edges = posts.select("gid", "key").join(heads, "key").select(F.col("gid").alias("a"), F.col("head").alias("b")).distinct()
    return components(edges).select(F.col("id").alias("gid"), F.col("label").alias("cluster"))


def open_members(members: DataFrame, posts: DataFrame) -> DataFrame:
    """members of groups with a list that holds another component in reach, with their cluster.  members: cls, gid, label, ..."""
    marks = members.groupBy("gid").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    marked = posts.join(marks, "gid")
    spread = marked.groupBy("key", "band").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    around = spread.select("key", F.explode(F.array(*(F.col("band") + d for d in (-1, 0, 1)))).alias("band"), "lo", "hi").groupBy("key", "band").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    lists = written(around.where("lo <> hi").select("key", "band"), "lists")
    left = written(posts.join(few(lists, lists.count()), ["key", "band"]).select("gid", "key"), "open")
    # A group of several members may be open by itself: its members share no list with another group then.
    inner = marks.where("lo <> hi").select("gid")
    if left.isEmpty():
        return members.join(inner, "gid").withColumn("cluster", F.col("gid"))
    gids = left.select("gid").unionByName(inner).distinct().join(clusters(left), "gid", "left").select("gid", F.coalesce("cluster", "gid").alias("cluster"))
    return members.join(gids, "gid")


def units(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members with their block, units with the blocks that take part).  members: cluster, cls, n, label, ..."""
    size = F.col("n") * 8
    whole = written(members.groupBy("cluster").agg(F.count("*").alias("size"), F.sum(size).alias("bytes")), "whole")
    small = (F.col("size") <= BLOCK) & (F.col("bytes") <= BLOCK_BYTES)
    rows = members.join(few(whole, whole.count()), "cluster").withColumn("band", F.when(small, F.lit(0)).otherwise(band())).withColumn("small", small).drop("size", "bytes")
    rows = written(rows, "banded")
    count = rows.where("not small").groupBy("cluster", "band", "label").agg(F.count("*").alias("k"))
    main = written(count.groupBy("cluster", "band").agg(F.max_by("label", F.struct("k", "label")).alias("main")), "main")
    rows = rows.join(few(main, main.count()), ["cluster", "band"], "left").withColumn("main", F.when(F.col("label") == F.col("main"), F.col("label")))
    parts = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(size) / BLOCK_BYTES)).cast("int")
    dealt = written(rows.groupBy("cluster", "band", "main").agg(F.when(F.first("small"), 1).otherwise(parts).alias("parts")), "dealt")
    same = F.col("l.main").eqNullSafe(F.col("r.main")) & F.col("l.main").isNotNull()
    left, right = dealt.alias("l"), dealt.alias("r")
    order = lambda side: F.struct(f"{side}.band", F.coalesce(f"{side}.main", F.lit(-1)))
    meet = left.join(right, (F.col("l.cluster") == F.col("r.cluster")) & (F.col("r.band") - F.col("l.band")).between(0, 1) & (order("l") <= order("r")) & ~same)
    each = lambda side, p: F.explode(F.transform(F.sequence(F.lit(0), F.col(f"{side}.parts") - 1), lambda k: F.struct(F.col(f"{side}.band").alias("band"), F.col(f"{side}.main").alias("main"), k.alias("part")))).alias(p)
    pairs = meet.select("r.*", each("l", "x")).alias("r").select("r.cluster", "x", each("r", "y"))
    pairs = pairs.where("x.band <> y.band or not (x.main <=> y.main) or x.part <= y.part")
    own = F.when(F.col("x") == F.col("y"), F.array("x")).otherwise(F.array("x", "y"))
    blocks = pairs.select("cluster", F.struct("x", "y").alias("unit"), F.explode(own).alias("block"), (F.size(own) == 1).alias("alone"))
    sizes = dealt.toDF("_cluster", "_band", "_main", "parts")
    rows = rows.join(sizes, F.col("cluster").eqNullSafe(F.col("_cluster")) & F.col("band").eqNullSafe(F.col("_band")) & F.col("main").eqNullSafe(F.col("_main")))
    part = F.pmod(F.xxhash64("cls"), "parts").cast("int")
    return rows.withColumn("block", F.struct("band", "main", part.alias("part"))).drop("_cluster", "_band", "_main", "parts"), blocks


COLS = ["cls", "gid", "n", "prefix", "label", "shingles", "side", "alone"]


def unit_links(table: pa.Table, every: bool = False) -> pa.Table:
    """Links a, b of the members of one or two blocks: spanning ones, or with `every` all.

    Units of two blocks compare across them only (`side`); `alone` marks units of one block.  Members of one label
    are connected already.
    """
    ids, gids, ns, prefixes_, labels, sides = (table.column(c).to_pylist() for c in ("cls", "gid", "n", "prefix", "label", "side"))
    own = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
    first: dict[int, int] = {}
    parent = [first.setdefault(label, x) if not every else x for x, label in enumerate(labels)]
    across = not table.column("alone")[0].as_py()
    links = []

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def verify(x, y):
        if across and sides[x] == sides[y]:
            return
        a, b = find(x), find(y)
        if a != b and linked(common := overlap(own[x], own[y]), ns[x], ns[y]):
            if not every:
                parent[a] = b
            links.append((ids[x], ids[y], common))

    members: dict[int, list[int]] = {}
    for x, g in enumerate(gids):
        members.setdefault(g, []).append(x)
    heads = sorted((m[0] for m in members.values()), key=lambda x: (ns[x], ids[x]))
    posts: dict[int, list[int]] = {}
    for x in heads:
        mine, near = members[gids[x]], {}
        for i, a in enumerate(mine):
            for b in mine[i + 1 :]:
                verify(a, b)
        for key in prefixes_[x]:
            post = posts.setdefault(key, [])
            for y in post:
                near[y] = None
            post.append(x)
        for y in near:  # smaller or equal sets
            if DEN * ns[y] >= NUM * ns[x]:
                for a in mine:
                    for b in members[gids[y]]:
                        verify(a, b)
    a, b, common = zip(*links, strict=True) if links else ((), (), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "common": pa.array(common, pa.int64())})


def links(members: DataFrame, stored: DataFrame, every: bool = False) -> DataFrame:
    """Links a, b, common within clusters.  members: cluster, cls, gid, n, prefix, label; stored: cls, shingles."""
    rows, blocks = units(members)
    rows = rows.join(stored.select("cls", "shingles"), "cls")
    dealt = rows.join(blocks, ["cluster", "block"]).withColumn("side", F.xxhash64("block"))
    return dealt.select("cluster", "unit", *COLS).groupBy("cluster", "unit").applyInArrow(tidy_group(lambda t: unit_links(t.select(COLS), every)), "a bigint, b bigint, common bigint")


def few(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(quoted(key).cast("bigint").alias("key"), F.xxhash64(quoted(text)).alias("version"), quoted(text).alias("text"))


def prepared(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """sized: key, version, n, digest; classes: digest, row (the least), k (rows), n, least (key); reps: cls, digest, key, version, n of those that
    may link; stored: cls, n, shingles; members: cls, gid, n, lone, prefix."""
    sized = written(sets(docs), "sets")
    total = sized.agg(F.sum("n")).first()[0] or 0
    may = able(docs.select("text"), int(total // BUCKET) + 8)
    least_row = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "version")).alias("row")
    classes = written(sized.where("n > 0").groupBy("digest").agg(least_row, F.count("*").alias("k"), F.max("n").alias("n"), F.min("key").alias("least")), "classes")
    reps = classes.join(may, "digest", "left_semi")
    # The ids are drawn once and written with their rows, so they never change.
    reps = written(reps.select(F.monotonically_increasing_id().alias("cls"), "digest", "row.key", "row.version", "n"), "reps")

    def store(batches):
        for batch in batches:
            found = shingle_sets(batch.column(0))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), batch.column(3), pa.array([digest(s) for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())], names=["cls", "n", "expected", "digest", "shingles"])

    r = few(reps.select("cls", "n", "digest", F.col("key").alias("rep_key"), F.col("version").alias("rep_version")), reps.count())
    texts = docs.join(r, same(docs["key"], r["rep_key"]) & (docs["version"] == r["rep_version"])).select("text", "cls", "n", "digest")
    stored = texts.mapInArrow(tidy(store), "cls bigint, n bigint, expected binary, digest binary, shingles binary").where("digest = expected")
    stored = written(stored.dropDuplicates(["cls"]).select("cls", "n", "shingles"), "stored")
    left = reps.agg(F.sum("n")).first()[0] or 0
    prefix = written(prefixes(stored.select("cls", "shingles"), int(left // BUCKET) + 8), "prefixes")
    groups = written(prefix.groupBy("n", "prefix").agg(F.min("cls").alias("gid")), "groups")
    members = written(prefix.join(groups, ["n", "prefix"]).select("cls", "gid", "n", "lone", "prefix"), "members")
    return sized, classes, reps, stored, members


def classified(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, version (xxhash64 of the text), n, component (a name; null: links with nothing) and component_id of each row."""
    sized, classes, reps, stored, members = prepared(keyed(docs, key, text))
    posts = written(postings(members.where("cls = gid")), "posts")
    near = written(stars(members.select("cls", "gid"), posts, stored), "near")
    label = rooted(near)
    named = written(members.join(label, "cls", "left").withColumn("label", F.coalesce("label", "cls")), "named")
    more = links(open_members(named, posts), stored).select("a", "b")
    label = components(near.unionByName(more)).select(F.col("id").alias("cls"), "label")

    # Only classes with several rows or with links need a join; every other row is its own component.
    ids = reps.select("digest", "cls").join(label, "cls", "left").select("digest", F.coalesce("label", "cls").alias("label"), F.col("label").isNotNull().alias("tied"))
    tied = classes.select("digest", "k", "least").join(ids, "digest", "left").where("k > 1 or tied").select("digest", "label", "least")
    least_of = tied.where("label is not null").groupBy("label").agg(F.min("least").alias("lowest"))
    tied = tied.join(least_of, "label", "left").select("digest", F.coalesce(F.col("label").cast("string"), F.hex("digest")).alias("component"), F.coalesce("lowest", "least").alias("lowest"))
    tied = written(tied, "tied")
    out = sized.join(few(tied, tied.count()), "digest", "left")
    return out.select("key", "version", "n", "component", F.when(F.col("component").isNull(), F.col("key")).otherwise(F.col("lowest")).alias("component_id"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles and component_id of each row of docs."""
    return classified(docs, key, text).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")


def similar_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(every link a, b, common between classes, membership: key, version, n, class).  A class is named by its digest."""
    sized, _, reps, stored, members = prepared(keyed(docs, key, text))
    posts = written(postings(members.where("cls = gid")), "posts")
    inside = members.withColumn("label", F.col("cls")).join(clusters(posts), "gid", "left").withColumn("cluster", F.coalesce("cluster", "gid"))
    found = links(inside, stored, every=True)
    name = lambda side: reps.select(F.col("cls").alias(side), F.hex("digest").alias(f"class_{side}"))
    pairs = found.join(name("a"), "a").join(name("b"), "b").select(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b"), "common")
    return pairs, sized.select(F.col("key").alias(key), "version", "n", F.when(F.col("n") > 0, F.hex("digest")).alias("class"))
