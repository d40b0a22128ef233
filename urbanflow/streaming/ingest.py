"""Incremental ingestion: file streams that take what is there and stop."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from urbanflow.operators import dedup, sinks
from urbanflow.operators.columns import check_names, normalize_column_names
from urbanflow.operators.reshape import explode_nested_records

METADATA = ["_ingestion_timestamp", "_ingestion_run_id", "_source_file", "_file_date", "_source_file_modification_time"]
FILE_DATE = r"/(\d{4}/\d{2}/\d{2})/"


def csv_stream(spark: SparkSession, path: str, schema: str, sep: str = ";", encoding: str = "UTF-8", **more: str) -> DataFrame:
    options = {"sep": sep, "header": "true", "encoding": encoding, "mode": "PERMISSIVE", "recursiveFileLookup": "true"} | more
    return spark.readStream.format("csv").schema(schema).options(**options).load(path)


def evolving_csv_stream(spark: SparkSession, path: str, schema: str, sep: str = ";", encoding: str = "UTF-8", rescued: str = "_rescued") -> DataFrame:
    """Typed columns; a row with a value that doesn't parse keeps its whole text in `rescued`, beside nulls.

    A stream that is started again with more columns at the end of its schema goes on where it was, and older rows of
    its target have nulls there (read it with mergeSchema).
    """
    return csv_stream(spark, path, f"{schema}, `{rescued}` string", sep, encoding, columnNameOfCorruptRecord=rescued)


def xml_stream(spark: SparkSession, path: str, row_tag: str, schema=None, sample: str | None = None) -> DataFrame:
    """Streams need a schema; without one, that of a batch read of `sample` is taken."""
    schema = schema or spark.read.format("xml").option("rowTag", row_tag).load(sample or path).schema
    return spark.readStream.format("xml").option("rowTag", row_tag).option("recursiveFileLookup", "true").schema(schema).load(path)


def file_date(path: str):
    """The date in .../yyyy/MM/dd/... of a path column, else null."""
    found = F.regexp_extract(path, FILE_DATE, 1)
    return F.to_date(F.when(found != "", found), "yyyy/MM/dd")


def add_metadata(df: DataFrame, run_id: str) -> DataFrame:
    if clash := sorted(set(METADATA) & set(df.columns)):
        raise ValueError(f"columns exist already: {clash}")
    df = df.select("*", F.col("_metadata.file_path").alias("_source_file"), F.col("_metadata.file_modification_time").alias("_source_file_modification_time"))
    return df.withColumns({"_ingestion_timestamp": F.current_timestamp(), "_ingestion_run_id": F.lit(run_id), "_file_date": file_date("_source_file")})


def append_available(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> None:
    """Append all that is available, each file once per checkpoint, then stop."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start(path).awaitTermination()


def ingest(df: DataFrame, run_id: str, path: str, checkpoint: str, records: tuple[str, list[str]] | None = None) -> None:
    """Metadata, nested records, normal names, append."""
    rows = add_metadata(df, run_id)
    if records:
        rows = explode_nested_records(rows, records[0], [*records[1], *METADATA])
    append_available(check_names(normalize_column_names(rows)), path, checkpoint)


def write_available(df: DataFrame, checkpoint: str, write: Callable[[DataFrame, str], None]) -> None:
    """Calls write(batch, token) with all that is available, then stops.

    The token is the same whenever a batch is run again, after a failure between its write and the stream's own note of
    it; a sink that keeps tokens does nothing then.
    """

    def run(batch: DataFrame, number: int) -> None:
        own = json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        write(batch, f"{own}:{number}")

    df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def upsert_available(df: DataFrame, path: str, keys: list[str], order: list[Column], checkpoint: str) -> None:
    """Upserts all that is available into a versioned table: of the rows of a key in a batch, the first by `order`."""
    write_available(df, checkpoint, lambda batch, token: sinks.write(dedup.deduplicate(batch, keys, order), path, "merge", keys=keys, token=token))


def lines_stream(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """value (a line), _file and _start (where in the file its split begins)."""
    rows = spark.readStream.format("text").option("recursiveFileLookup", "true").load(path)
    value = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    return rows.select(value.alias("value"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))


def fields_of(line: str, sep: str) -> Column:
    """The fields of a line of CSV; quoted ones may hold separators and doubled quotes."""
    s = re.escape(sep)
    found = F.regexp_extract_all(line, F.lit(f'(?:^|{s})("(?:[^"]|"")*"(?={s}|$)|[^{s}]*)'), F.lit(1))
    quoted = lambda x: x.startswith('"') & x.endswith('"') & (F.length(x) > 1)
    return F.transform(found, lambda x: F.when(quoted(x), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))


def rescued_rows(lines: DataFrame, schema: str, sep: str = ";", rescued: str = "_rescued") -> DataFrame:
    """Lines of CSV files with a header each -> typed columns, and a map of what they couldn't take.

    Columns go by the names in their own file's header, whatever their order.  A field whose text isn't of its type is
    null and its text is in the map, under its name; so are fields of columns that the schema lacks, and those beyond the
    header as _c<place>.  Every other field keeps its value.  The map is null where there is nothing to rescue.
    """
    lines = lines.withColumn("value", F.regexp_replace("value", "^\ufeff|\r$", ""))
    first = lines.where("_start = 0").withColumn("_id", F.monotonically_increasing_id())
    headers = first.groupBy("_file").agg(F.min_by("value", "_id").alias("_header")).withColumn("_names", fields_of("_header", sep))
    named = F.transform("_names", lambda x, i: F.when((F.trim(x) == "") | (F.array_position("_names", x) != i + 1), F.concat(F.lit("_c"), i)).otherwise(F.trim(x)))
    headers = headers.select(F.col("_file").alias("_of"), "_header", named.alias("_names"))
    rows = lines.join(headers, F.col("_file") == F.col("_of")).where("value <> _header and trim(value) <> ''").withColumn("_values", fields_of("value", sep))
    place = F.transform("_values", lambda v, i: F.struct(F.coalesce(F.get("_names", i), F.concat(F.lit("_c"), i)).alias("k"), F.when(v != "", v).alias("v")))
    rows = rows.select("_file", F.map_from_entries(F.filter(place, lambda e: e.v.isNotNull())).alias("_fields"))
    wanted = StructType.fromDDL(schema).fields
    typed = {f.name: F.col("_fields")[f.name].try_cast(f.dataType) for f in wanted}
    rows = rows.select("_file", "_fields", *(c.alias(name) for name, c in typed.items()))
    failed = F.array_compact(F.array(*(F.when(F.col("_fields")[f.name].isNotNull() & F.col(f"`{f.name}`").isNull(), f.name) for f in wanted)))
    left = F.map_filter("_fields", lambda k, _: ~k.isin([f.name for f in wanted]) | F.array_contains(failed, k))
    return rows.select(*(f"`{f.name}`" for f in wanted), F.when(F.size(left) > 0, left).alias(rescued), F.col("_file").alias("_source_file"))


def rescue_available(spark: SparkSession, source: str, schema: str, path: str, checkpoint: str, sep: str = ";", encoding: str = "UTF-8") -> None:
    """Appends the rows of all new files below source to a versioned table, with what didn't fit the schema beside them.

    The stream may be started again with a wider schema: older rows have nulls in the new columns.
    """
    write_available(lines_stream(spark, source, encoding), checkpoint, lambda batch, token: sinks.write(rescued_rows(batch, schema, sep), path, "append", token=token))
