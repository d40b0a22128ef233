"""Line dedup by the spread of a line over sites.

Lines that occur at least MIN_SITES times gather a HyperLogLog sketch of the sites that carry them, straight from their
occurrences: sketches are built within tasks and merged by aggregation, so a line costs a row of each task however many
sites have it.  A line whose estimate lies near the threshold gets an exact distinct count.  Lines on
at least MIN_SITES sites are boilerplate: every occurrence goes but the first (lowest document id, then position), so
nothing that the corpus says disappears altogether.

Everything is built-in SQL.  Texts are cut into hashed lines once, and those are written; all later steps read the
hashes.  Lines are never shuffled by their hash, but for counts, which are summed within tasks first: frequent lines and
boilerplate are broadcast if they are no more than BROADCAST_ROWS, else joined (where adaptive execution splits a
line that a third of all documents carry).  Only documents that lose lines are rewritten.

Defined cases: lines are compared without surrounding white space and blank lines always stay; a null site counts
as no site; null or empty texts stay as they are; a document that loses every line keeps an empty text and is marked
`emptied`; a document is an id (null or not) and a text, so rows that share an id are cut each by its own lines, and
only rows of equal id and equal text are one document; columns called removed_lines or emptied are replaced, all others
keep their values, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.common import fresh, others, quoted, row_hash, same, written

MIN_SITES = 10
#: Estimates within this share of the threshold are counted exactly; the sketch's error is about 3 % (2^10 registers).
BAND, LOG_REGISTERS = 0.25, 10
#: What may be broadcast: rows of line hashes, bytes of line positions.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64_000_000
NEW = ("removed_lines", "emptied")


def occurrences(docs: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """A row per non-blank line: 128 bits of hash, id and version (hash of the whole text), position and site."""
    lines = docs.select(quoted(key).alias("id"), F.xxhash64(quoted(text)).alias("version"), quoted(site).alias("site"), F.posexplode(F.split(quoted(text), "\n")).alias("pos", "line"))
    line = F.trim(F.regexp_replace("line", r"^\s+|\s+$", ""))
    return lines.withColumn("line", line).where("line <> ''").select("id", "version", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def on_line(side: DataFrame) -> tuple[DataFrame, Column]:
    """side with other names for h1 and h2, and the condition that they equal a line's: h1 is the key, h2 a filter."""
    side = side.withColumnsRenamed({"h1": "own1", "h2": "own2"})
    return few(side), (F.col("h1") == F.col("own1")) & same(F.col("h2"), F.col("own2"))


def spread(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """h1, h2, sites (estimated) and the first occurrence of each line that occurs min_sites times.  lines: `occurrences`, written."""
    line = ["h1", "h2"]
    frequent = written(lines.groupBy(*line).agg(F.count("*").alias("n")).where(F.col("n") >= min_sites).select(*line), "frequent")
    repeated = lines.join(*on_line(frequent), "left_semi")
    rated = repeated.groupBy(*line).agg(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS)).alias("sketch"), F.min(F.struct("id", "pos", "version")).alias("first"))
    return rated.select(*line, "first", F.hll_sketch_estimate("sketch").alias("sites"))


def near_band(rated: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Lines of which the estimate doesn't tell whether they reach min_sites."""
    return rated.where(F.col("sites").between(min_sites * (1 - BAND), min_sites * (1 + BAND)))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """h1, h2 and the kept occurrence of each line on at least min_sites sites.  Only lines of the near band meet by site."""
    line = ["h1", "h2"]
    rated = written(spread(lines, min_sites), "rated")
    sure = rated.where(F.col("sites") > min_sites * (1 + BAND)).select(*line, "first")
    near = near_band(rated, min_sites).select(*line, "first")
    exact = lines.join(*on_line(near.select(*line)), "left_semi").select(*line, "site").distinct().groupBy(*line).agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites)
    return sure.unionByName(near.join(exact.select(*line), line))


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES, key: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """docs with the text cut, and removed_lines (positions from 0) and emptied."""
    lines = written(occurrences(docs, key, text, site), "lines")
    bad = written(boilerplate(lines, min_sites), "bad")
    gone = lines.join(*on_line(bad)).where(~(F.struct("id", "pos", "version").eqNullSafe(F.col("first"))))
    gone = written(gone.groupBy("id", "version").agg(F.sort_array(F.collect_set("pos")).alias("gone")), "gone")
    taken = gone.agg(F.sum(64 + 4 * F.size("gone"))).first()[0] or 0

    # Many documents may have one text, so what is joined is a hash of id and text.
    mine = fresh(docs, "gone_row", "gone_id", "gone_version", "gone")
    gone = gone.select(row_hash(F.col("id"), F.col("version")), "id", "version", "gone").toDF(*mine)
    gone = F.broadcast(gone) if taken <= BROADCAST_BYTES else gone
    gone_row, gone_id, gone_version, at = (F.col(c) for c in mine)
    version = F.xxhash64(quoted(text))
    rows = docs.join(gone, (row_hash(quoted(key), version) == gone_row) & same(quoted(key), gone_id) & same(version, gone_version), "left")
    cut = F.array_join(F.filter(F.split(quoted(text), "\n"), lambda x, i: ~F.array_contains(at, i)), "\n")
    left = F.when(at.isNull(), quoted(text)).otherwise(cut)
    return rows.select(
        *((left.alias(text) if c == text else quoted(c)) for c in others(docs, *NEW)), F.coalesce(at, F.array().cast("array<int>")).alias("removed_lines"),
        (at.isNotNull() & (F.trim(F.regexp_replace(left, r"\s+", "")) == "")).alias("emptied"))
