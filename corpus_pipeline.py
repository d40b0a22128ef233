"""From raw documents to token ids: classify, cut boilerplate lines, join near duplicates, decontaminate, encode.

Each stage takes all that the one before kept, written as Parquet and read again, and its decisions take effect.

Defined cases: no documents give no rows; documents without an id, or with one that others have, go through as any other,
each by its id and text; rows of equal id and equal text are one document from the near-duplicate join on; null and empty
texts are scored, link with nothing and encode to no tokens; other columns are kept up to the encoder, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflow.llm import byte_bpe, decontaminate, jaccard_join, line_dedup, quality
from urbanflow.llm.common import delete, fresh, row_hash, same, scratch, shared_dir, table, written


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a predicted quality of 1."""
    return quality.classify(docs, table(spark, sf_dir, "labels")).where("predicted = 1").select(*docs.columns)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that many sites share; documents of nothing else go."""
    return line_dedup.dedup_lines(docs).where("not emptied").select(*docs.columns)


def join_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, the document with the least id (nulls last).

    A document is an id (null or not) and a text: rows of equal id and equal text are one, others stay apart.
    """
    rows = jaccard_join.classified(docs).groupBy("key", "version").agg(F.count("*").alias("k"), F.max("component").alias("component"))
    rows = written(rows, "classes")
    rank = F.struct(F.isnull("key").alias("no_id"), "key", "version")
    best = written(rows.where("component is not null").groupBy("component").agg(F.min(rank).alias("best")), "best")
    copies = rows.where("component is not null").join(best, "component").where(rank != F.col("best"))
    left = matched(docs, copies, "left_anti")
    # Rows of one id and one text are rare: only those are shuffled.
    twice = rows.where("k > 1")
    if twice.isEmpty():
        return left
    version, = fresh(docs, "version")
    again = matched(left, twice, "left_semi").withColumn(version, F.xxhash64("text"))
    return matched(left, twice, "left_anti").unionByName(again.dropDuplicates(["doc_id", version]).drop(version))


def matched(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """docs joined (how: left_semi or left_anti) to rows of key and version, by a hash of both: copies share their version."""
    row, key, version = fresh(docs, "row", "row_key", "row_version")
    keys = written(keys.select(row_hash(F.col("key"), F.col("version")).alias(row), F.col("key").alias(key), F.col("version").alias(version)), "keys")
    own, text = F.col("doc_id").cast("bigint"), F.xxhash64("text")
    return docs.join(jaccard_join.few(keys, keys.count()), (row_hash(own, text) == F.col(row)) & same(own, F.col(key)) & same(text, F.col(version)), how)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item."""
    return decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).where("not contaminated").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and offsets, and whether decoding them gives the text's bytes again."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    back = byte_bpe.round_trip(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return back.select("doc_id", "token_ids", "token_starts", "token_ends", F.size("token_ids").cast("bigint").alias("n_tokens"), F.col("decoded").eqNullSafe(F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [
    ("quality_classifier", classify),
    ("line_dedup", cut_lines),
    ("jaccard_join", join_near),
    ("decontaminate", decontaminated),
    ("byte_bpe", encode),
]

#: SQL can express neither the classifier nor the merges of the encoder; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    base = shared_dir(spark)
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}_{name}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
