"""WARC archives: records written by tasks, read back, and their index merged from sorted runs.

`plan` finds the response of each payload (the capture with the largest id) by an aggregation over digests; the others
become revisit records, which hold HTTP headers but no payload.  Each task writes archives of about ARCHIVE_BYTES, a
gzip member per record, so that a record can be read by its offset and length alone.  An archive has a name of its task
attempt; only those whose rows Spark commits to the manifest are ever read, so lost executors and repeated tasks leave
no record twice.

`scan` reads whole archives, member by member, checks each digest that the bytes at hand allow, and yields the archive's
captures as a run, sorted by URL key and time.  `merge` deals runs by ranges of (key, time, archive, offset) - no two
captures share that, so a URL with a third of all captures is split like any other - and each task merges the slices of
its runs with a loser tree.  Ranges follow each other, so all tasks together hold one global order.

Folders must be such that both Spark and pyarrow can open them (local or mounted paths, hdfs, s3, gcs).

Defined cases: a null html has an empty payload; a null URL has the key "-"; equal payloads of null ids are all
responses if no row has an id, else revisits; rows that share the largest id are all responses; columns of pages beyond
the named ones aren't archived, whatever their names; no pages, no archives.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from urbanflow.llm.common import others, quoted, tidy, written

#: An archive is closed behind the record with which it reaches so many bytes or records.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 64_000_000, 50_000
#: Captures that a task merges, bytes that are read from an archive at a time, response ids that may be broadcast.
MERGED_ROWS, READ_BYTES, BROADCAST_ROWS = 200_000, 1 << 20, 200_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "urn:page:"
MANIFEST = "archive string, n_records bigint, n_bytes bigint"
CAPTURES = "page_id bigint, url string, url_key string, captured string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, archive string, offset bigint, length bigint"
RUN = CAPTURES + ", place_in_run bigint"
ORDER = ("url_key", "captured", "archive", "offset")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, then path and query, in lower case: org,example)/a?b"""
    rest = F.regexp_replace(F.lower(url), r"^[a-z][a-z0-9+.-]*://", "")
    rest = F.regexp_replace(rest, "#.*$", "")
    host = F.regexp_replace(F.regexp_extract(rest, "^([^/?]*)", 1), r"^www[0-9]*\.|:80$|:443$", "")
    path = F.regexp_replace(rest, "^[^/?]*", "")
    path = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    return F.when(url.isNull(), "-").otherwise(F.concat(F.array_join(F.reverse(F.split(host, "[.]")), ","), F.lit(")"), path))


def date(seconds: Column) -> Column:
    """WARC-Date, whatever the session's zone."""
    at = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.concat(F.replace(F.substring(at.cast("string"), 1, 19), F.lit(" "), F.lit("T")), F.lit("Z"))


def plan(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", at: Column | None = None) -> DataFrame:
    """page_id, url, url_key, captured (WARC-Date), payload, sha1 and refers_to (null: a response).  at: seconds since 1970."""
    rows = pages.select(
        quoted(page).cast("bigint").alias("page_id"), quoted(url).alias("url"), url_key(quoted(url)).alias("url_key"),
        date(F.lit(0) if at is None else F.coalesce(at, F.lit(0))).alias("captured"), F.encode(F.coalesce(quoted(html), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    # Only payloads that occur more than once are joined; a payload with a third of all pages is one row of each task here.
    copies = rows.groupBy("sha1").agg(F.count("*").alias("n"), F.max("page_id").alias("last")).where("n > 1 and last is not null").select(F.col("sha1").alias("own"), "last")
    copies = written(copies, "copies")
    copies = F.broadcast(copies) if copies.count() <= BROADCAST_ROWS else copies
    rows = rows.join(copies, F.col("sha1") == F.col("own"), "left")
    return rows.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))).drop("own", "last")


def record(page, url: str | None, key: str, captured: str, payload: bytes, sha1: str, refers_to) -> bytes:
    """One record, as WARC/1.1."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{RECORD}{'none' if page is None else page}>", f"WARC-Date: {captured}"]
    head += [] if url is None else ["WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A")]
    head += [f"X-URL-Key: {key}".replace("\r", "%0D").replace("\n", "%0A"), f"WARC-Payload-Digest: sha1:{base32(bytes.fromhex(sha1))}"]
    head += [] if refers_to is None else [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{RECORD}{refers_to}>"]
    head += [f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def archive(rows: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the rows of `plan` to archives below path; the manifest: a row per archive."""
    names = ["page_id", "url", "url_key", "captured", "payload", "sha1", "refers_to"]

    def run(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        out, name, n, size = None, "", 0, 0
        try:
            for batch in batches:
                columns = [batch.column(i) for i in range(len(names))]
                for i in range(len(batch)):
                    if out is None:
                        name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    raw = member(record(*(c[i].as_py() for c in columns)))
                    out.write(raw)
                    n, size = n + 1, size + len(raw)
                    if size >= archive_bytes or n >= ARCHIVE_RECORDS:
                        out.close()
                        out = None
                        yield pa.RecordBatch.from_pylist([{"archive": name, "n_records": n, "n_bytes": size}])
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield pa.RecordBatch.from_pylist([{"archive": name, "n_records": n, "n_bytes": size}])

    return written(rows.select(*names).mapInArrow(tidy(run), MANIFEST), "manifest")


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """offset, length and bytes of each gzip member; one record is in memory at a time."""
    at, held = 0, b""
    while True:
        unpack, parts, used = zlib.decompressobj(31), [], 0
        while not unpack.eof:
            held = held or stream.read(READ_BYTES)
            if not held:
                if used:
                    raise ValueError(f"the archive ends inside the record at {at}")
                return
            parts.append(unpack.decompress(held))
            used += len(held) - len(unpack.unused_data)
            held = unpack.unused_data
        yield at, used, b"".join(parts)
        at += used


def parsed(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers of a record, its HTTP headers and what follows those."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n" or fields["warc-block-digest"] != "sha1:" + base32(hashlib.sha1(block).digest()):
        raise ValueError(f"the record {fields['warc-record-id']} is damaged")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def number(urn: str | None):
    """The page of a record id, null where it has none."""
    tail = (urn or "").strip("<>").removeprefix(RECORD)
    return None if tail in ("", "none") else int(tail)


def capture(raw: bytes) -> dict:
    fields, http, payload = parsed(raw)
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    size = next(int(x[16:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
    if kind == "response" and (len(payload) != size or base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    return {"page_id": number(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "url_key": fields["x-url-key"], "captured": fields["warc-date"], "record_type": kind, "payload_digest": digest, "payload_bytes": size, "refers_to": number(fields.get("warc-refers-to"))}


def scan(manifest: DataFrame, path: str) -> DataFrame:
    """The captures of each archive, as a run: sorted by key, time and place."""

    def run(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    rows = [capture(raw) | {"archive": name, "offset": at, "length": n} for at, n, raw in members(stream)]
                rows.sort(key=lambda r: tuple(r[k] for k in ORDER))
                yield pa.RecordBatch.from_pylist([r | {"place_in_run": i} for i, r in enumerate(rows)], schema=SCHEMA)

    n = max(1, manifest.count())
    return manifest.repartition(n, "archive").select("archive").mapInArrow(tidy(run), RUN)


SCHEMA = pa.schema([(name, pa.string() if kind == "string" else pa.int64()) for name, kind in (f.split() for f in RUN.split(", "))])


class LoserTree:
    """k sorted lists of keys merged: each leaf holds the next key of its list, each inner node the loser of its match.

    next() gives the winner's list and place; taking it replays only the matches on that leaf's way to the root.
    """

    def __init__(self, lists: list[list]):
        self.lists, self.k = lists, len(lists)
        self.at = [0] * self.k
        self.losers = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self.replay(leaf, building=True)

    def less(self, a: int, b: int) -> bool:
        """Whether list a's next key comes before list b's; a list at its end loses."""
        if self.at[a] >= len(self.lists[a]):
            return False
        return self.at[b] >= len(self.lists[b]) or self.lists[a][self.at[a]] < self.lists[b][self.at[b]]

    def replay(self, leaf: int, building: bool = False) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self.losers[node] < 0 and building:  # the first to come waits for its opponent
                self.losers[node] = winner
                return
            if self.less(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple[int, int]]:
        for _ in range(sum(map(len, self.lists))):
            leaf = self.losers[0]
            yield leaf, self.at[leaf]
            self.at[leaf] += 1
            self.replay(leaf)


def merge(runs: DataFrame, rows_a_task: int = MERGED_ROWS) -> DataFrame:
    """The captures of all runs in one order, with part (of the order), place (in the part) and nth (of its URL in the part).

    A task holds the slices of its range, some rows_a_task captures: ranges are cut between any two captures.
    """
    n = max(1, -(-runs.count() // rows_a_task))
    dealt = runs.repartitionByRange(n, *ORDER).sortWithinPartitions("archive", "place_in_run").select(*others(runs, "place_in_run"))

    def run(batches):
        from pyspark import TaskContext

        batches = list(batches)
        if not sum(map(len, batches)):
            return
        table = pa.Table.from_batches(batches)
        keys = list(zip(*(table.column(k).to_pylist() for k in ORDER), strict=True))
        starts = [i for i in range(len(keys)) if i == 0 or keys[i][2] != keys[i - 1][2]]
        ends = [*starts[1:], len(keys)]
        order = [starts[leaf] + i for leaf, i in LoserTree([keys[a:b] for a, b in zip(starts, ends, strict=True)])]
        nth = []
        for i, row in enumerate(order):
            nth.append(nth[-1] + 1 if i and keys[row][0] == keys[order[i - 1]][0] else 1)
        merged = table.take(pa.array(order, pa.int64()))
        own = {"part": pa.array([TaskContext.get().partitionId()] * len(order), pa.int32()), "place": pa.array(range(len(order)), pa.int64()), "nth": pa.array(nth, pa.int64())}
        for name, values in own.items():
            merged = merged.append_column(name, values)
        yield from merged.combine_chunks().to_batches()

    return dealt.mapInArrow(tidy(run), CAPTURES + ", part int, place bigint, nth bigint")


def histories(merged: DataFrame) -> DataFrame:
    """merged (written) with position (in the whole order, from 0) and capture (number within the URL's history, from 1).

    Only the first URL of a part can have captures in parts before it, so what is added is a row per part.
    """
    parts = merged.groupBy("part").agg(F.count("*").alias("n"), F.min("url_key").alias("url_key"))
    ranked = Window.orderBy("part")
    parts = written(parts.select("part", "url_key", (F.sum("n").over(ranked) - F.col("n")).alias("base")), "parts")
    before = Window.partitionBy("url_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = F.broadcast(parts.select("url_key").distinct())
    counts = merged.join(firsts, "url_key", "left_semi").groupBy("part", "url_key").agg(F.count("*").alias("k"))
    earlier = counts.select("part", "url_key", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("earlier")).where("earlier > 0")
    out = merged.join(F.broadcast(parts.select("part", "base")), "part").join(F.broadcast(earlier), ["part", "url_key"], "left")
    return out.withColumns({"position": F.col("base") + F.col("place"), "capture": F.col("nth") + F.coalesce("earlier", F.lit(0))}).drop("base", "part", "place", "nth", "earlier")


def index(manifest: DataFrame, path: str, rows_a_task: int = MERGED_ROWS) -> DataFrame:
    """The merged index of all archives: a row per capture, with its position and its number in the history of its URL."""
    return histories(written(merge(written(scan(manifest, path), "runs"), rows_a_task), "merged"))
