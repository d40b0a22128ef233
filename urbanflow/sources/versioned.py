"""Versioned tables: Parquet files that never change, and a log that says which of them make each version.

`data/batch=<id>/...` holds what one write has left, partitioned or not.  `log/<version>.json` holds the files that a
version adds and removes.  A writer puts the files first and then the log entry, all at once and only if no other writer
has taken that version; who comes second looks at the new version and tries again.  So readers see a version whole or
not at all, two writers never undo each other, and a version captured once reads the same rows for ever.

File names pass through the driver, rows never do.  Files of writes that failed stay behind unread.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable
from typing import NamedTuple
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from urbanflow.sources.work import written_once

ENTRY = "version bigint, head string, add string, remove string"
#: How often a writer that comes second tries again.
TRIES = 100


class Version(NamedTuple):
    """One version of a table; number -1 stands for a table that doesn't exist yet."""

    number: int
    files: list[str]
    schema: StructType | None
    partition_by: list[str]
    tokens: frozenset[str]


class Change(NamedTuple):
    """What a writer makes of a version.  removed: names of the new files -> names of those that go."""

    rows: DataFrame
    removed: Callable[[list[str]], Iterable[str]]
    schema: StructType
    partition_by: list[str]


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _hadoop(spark, f"{path}/log")
    return store.exists(at)


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Whether the file was put there, whole and at once; False if it was there before."""
    part = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
    store, at = _hadoop(spark, part)
    out = store.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if urlparse(str(at.toUri())).scheme in ("", "file"):  # Hadoop's local rename replaces what is there
            try:
                os.link(*(_hadoop(spark, p)[1].toUri().getPath() for p in (part, path)))
                return True
            except FileExistsError:
                return False
        files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration())
        rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
        how = spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        try:
            files.rename(at, _hadoop(spark, path)[1], how)
            return True
        except Exception as e:
            if "FileAlreadyExistsException" in str(e):
                return False
            raise
    finally:
        store.delete(at, False)


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A version by its number, else the newest."""
    if not exists(spark, path):
        if number is not None:
            raise ValueError(f"{path} has no version {number}")
        return Version(-1, [], None, [], frozenset())
    log = spark.read.schema(ENTRY).json(f"{path}/log")
    heads = {r.version: json.loads(r["head"]) for r in log.where("head is not null").select("version", "head").collect()}  # a row per version
    number = max(heads) if number is None else number
    if number not in heads:
        raise ValueError(f"{path} has no version {number}")
    log = log.where(F.col("version") <= number)
    files = log.where("add is not null").select(F.col("add").alias("file")).join(log.where("remove is not null").select(F.col("remove").alias("file")), "file", "left_anti")
    head = heads[number]
    tokens = frozenset(h["token"] for v, h in heads.items() if v <= number and h["token"])
    return Version(number, sorted(r.file for r in files.collect()), StructType.fromJson(head["schema"]), head["partition_by"], tokens)


def newest(spark: SparkSession, path: str) -> int:
    return version(spark, path).number


def frame(spark: SparkSession, path: str, files: list[str], schema: StructType) -> DataFrame:
    """The rows of some files of the table; columns that a file lacks are null."""
    if not files:
        return spark.createDataFrame([], schema)
    whole = StructType([*schema.fields, StructField("batch", StringType())])
    rows = spark.read.schema(whole).option("basePath", f"{path}/data").parquet(*(f"{path}/data/{f}" for f in files))
    return rows.select(*(F.col(f"`{name}`") for name in schema.names))


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of exactly one version (default: the newest)."""
    own = version(spark, path, number)
    if own.schema is None:
        raise ValueError(f"{path} has no version yet")
    return frame(spark, path, own.files, own.schema)


def _written(rows: DataFrame, path: str, partition_by: list[str]) -> list[str]:
    """Puts the rows below data/ and gives the names of their files."""
    batch = f"batch={uuid.uuid4().hex}"
    rows.write.partitionBy(*partition_by).parquet(f"{path}/data/{batch}")
    found = rows.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(f"{path}/data/{batch}").select("path")
    return sorted(batch + r.path.split(batch, 1)[1] for r in found.collect())


def commit(spark: SparkSession, path: str, change: Callable[[Version], Change | None], token: str | None = None, tries: int = TRIES) -> int:
    """Makes the next version and gives its number.  change: what to write, given the newest version (None: nothing).

    A token that the log holds already means that this write has been done before: nothing happens.
    """
    for _ in range(tries):
        now = version(spark, path)
        made = None if token is not None and token in now.tokens else change(now)
        if made is None:
            return now.number
        added = _written(made.rows, path, made.partition_by)
        number = now.number + 1
        head = {"schema": made.schema.jsonValue(), "partition_by": made.partition_by, "token": token}
        lines = [{"version": number, "head": json.dumps(head)}, *({"version": number, "remove": f} for f in sorted(set(made.removed(added)))), *({"version": number, "add": f} for f in added)]
        if publish(spark, f"{path}/log/{number:020d}.json", "\n".join(map(json.dumps, lines)) + "\n"):
            return number
        store, at = _hadoop(spark, f"{path}/data/{added[0].split('/')[0]}") if added else (None, None)
        if store:
            store.delete(at, True)
    raise RuntimeError(f"{path}: {tries} tries, and another writer came first each time")


def wider(old: StructType | None, new: StructType) -> StructType:
    """Columns of both, the old ones first; one with two types is an error."""
    if old is None:
        return new
    for f in new.fields:
        if f.name in old.names and old[f.name].dataType != f.dataType:
            raise ValueError(f"{f.name} is {old[f.name].dataType.simpleString()} in the table, not {f.dataType.simpleString()}")
    return StructType([*old.fields, *(f for f in new.fields if f.name not in old.names)])


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in schema.fields])


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    return commit(df.sparkSession, path, lambda now: Change(df, lambda _: now.files, _nullable(df.schema), partition_by or []))


def append(df: DataFrame, path: str, partition_by: list[str] | None = None, token: str | None = None) -> int:
    """New columns are null in older rows."""

    def change(now: Version) -> Change:
        return Change(df, lambda _: [], wider(now.schema, _nullable(df.schema)), now.partition_by if now.number >= 0 else partition_by or [])

    return commit(df.sparkSession, path, change, token)


def touched(target: DataFrame, source: DataFrame, keys: list[str]) -> list[str]:
    """Names of the target's files that hold a key of the source; null keys equal each other.

    Only the keys are read, and of them only row groups within the source's range.
    """
    side = source.select(*(F.col(f"`{k}`").alias(f"_{i}") for i, k in enumerate(keys)))
    bounds = side.agg(*(f(f"_{i}").alias(f"{f.__name__}_{i}") for i in range(len(keys)) for f in (F.min, F.max))).first()
    near = F.lit(True)
    for i, k in enumerate(keys):
        kind = target.schema[k].dataType
        inside = F.lit(False) if bounds[f"min_{i}"] is None else F.col(f"`{k}`").between(F.lit(bounds[f"min_{i}"]).cast(kind), F.lit(bounds[f"max_{i}"]).cast(kind))
        near = near & (inside | F.col(f"`{k}`").isNull())
    rows = target.where(near).select(*(F.col(f"`{k}`").alias(f"_t{i}") for i, k in enumerate(keys)), F.col("_metadata.file_path").alias("_file"))
    same = [F.col(f"_t{i}").eqNullSafe(F.col(f"_{i}")) for i in range(len(keys))]
    return [unquote(r["_file"]).split("/data/", 1)[-1] for r in rows.join(side, same, "left_semi").select("_file").distinct().collect()]


def without(rows: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    side = source.select(*(F.col(f"`{k}`").alias(f"_{i}") for i, k in enumerate(keys)))
    return rows.join(side, [F.col(f"`{k}`").eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)], "left_anti")


def upsert(df: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None, token: str | None = None) -> int:
    """Rows of df in place of those with the same keys, and as new ones.  Only files that hold such a key are rewritten.

    df is written to a work folder first, since its keys are looked at several times before its rows are.
    """
    with written_once(df) as rows:
        return _upsert(rows, path, keys, partition_by, token)


def _upsert(df: DataFrame, path: str, keys: list[str], partition_by: list[str] | None, token: str | None) -> int:
    spark = df.sparkSession
    if twice := df.groupBy(*(F.col(f"`{k}`") for k in keys)).count().where("count > 1").limit(3).collect():
        raise ValueError(f"keys are repeated in the source: {[tuple(r)[:-1] for r in twice]}")

    def change(now: Version) -> Change:
        if now.number < 0:
            return Change(df, lambda _: [], _nullable(df.schema), partition_by or [])
        if gone := sorted(set(now.schema.names) - set(df.columns)):
            raise ValueError(f"the source lacks {gone}")
        hit = sorted(set(touched(frame(spark, path, now.files, now.schema), df, keys)) & set(now.files))
        kept = without(frame(spark, path, hit, now.schema), df, keys)
        schema = wider(now.schema, _nullable(df.schema))
        return Change(kept.unionByName(df, allowMissingColumns=True).select(*(F.col(f"`{c}`") for c in schema.names)), lambda _: hit, schema, now.partition_by)

    return commit(spark, path, change, token)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> int:
    """The partitions that df has rows of (a null counts as one) are replaced by those rows, all in one version."""
    folder = lambda name: name.split("/", 1)[1].rsplit("/", 1)[0]  # noqa: E731  behind the batch, before the file

    def change(now: Version) -> Change:
        if now.number >= 0 and now.partition_by != partition_by:
            raise ValueError(f"{path} is partitioned by {now.partition_by}, not {partition_by}")

        def removed(added: list[str]) -> list[str]:
            if not added:
                raise ValueError("no rows, so no partition to replace")
            received = {folder(name) for name in added}
            return [name for name in now.files if folder(name) in received]

        return Change(df, removed, wider(now.schema, _nullable(df.schema)), partition_by)

    return commit(df.sparkSession, path, change)
