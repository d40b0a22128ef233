"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """A-Z only; every other character stays as it is.  Texts of ASCII alone take the faster way."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, UPPER, UPPER.lower()))


#: The folders that `scratch` has opened, the innermost last.
_OPEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    Without that setting a local session (tests) takes a folder of this machine; any other raises.
    """
    base = _OPEN[-1] if _OPEN else spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        base = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A shared folder for the intermediate tables made inside the block; it goes at the end, so write results before."""
    _OPEN.append(shared_dir(spark))
    try:
        yield _OPEN[-1]
    finally:
        delete(spark, _OPEN.pop())


def written(df: DataFrame, name: str = "t") -> DataFrame:
    """Cut the lineage: write to the shared folder and read again, so lost executors lose nothing."""
    path = f"{shared_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores at its end as it takes to differ from all columns of df."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def others(df: DataFrame, *names: str) -> list[str]:
    """The columns of df without those called like the names."""
    gone = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in gone]


def same(a: Column, b: Column) -> Column:
    """a <=> b of integers or dates as a plain condition, not as a join key.

    A broadcast table with one long as its key is compact; one with several keys takes 32 MB of each executor at least.
    """
    return F.coalesce(F.abs(F.when(a == b, 0).otherwise(1)) == 0, F.lit(False)) & a.isNotNull() | a.isNull() & b.isNull()


def row_hash(key: Column, version: Column) -> Column:
    """One long of a document's id and its text's hash: rows of one text but other ids don't share it, as copies would."""
    return F.xxhash64(F.lit("row"), key, version)


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def pieces(sizes, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of consecutive rows whose sizes sum to about `limit`; a larger row stands alone."""
    a = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield a, i
            a, total = i, 0
        total += n
    if a < len(sizes):
        yield a, len(sizes)


def text_parts(column: pa.Array, limit: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, UTF-8 of each text) for runs of rows of about `limit` bytes; null texts are empty."""
    for a, b in pieces([(n or 0) + 50 for n in pc.binary_length(column).to_pylist()], limit):
        yield a, [raw or b"" for raw in column.slice(a, b - a).cast(pa.binary()).to_pylist()]


def release() -> None:
    """Python workers outlive their tasks: give the free memory of this one back to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def tidy(run: Callable) -> Callable:
    """run (batches -> batches), and release() after it."""

    def runs(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return runs


def tidy_group(run: Callable) -> Callable:
    """run (table -> table), and release() after it; for large groups."""

    def runs(table):
        try:
            return run(table)
        finally:
            release()

    return runs


def extended(df: DataFrame, ddl: str) -> StructType:
    """The schema of df with more fields at its end."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])
