"""The operators over the standard tables, with production parameters; digest columns come from their outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflow.llm import alignment, byte_bpe, chat, decontaminate, jaccard_join, license_scan, line_dedup, media, pii, quality, url_filter, warc, whitening
from urbanflow.llm.common import shared_dir, table

#: Rules for hosts and their subdomains, with the start of the path.
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
PII_KEY = b"surrogates of documents"
#: Seconds since 1970 of the capture of page 0.
CAPTURED_FROM = 1_700_000_000


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), RULES)


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media.store(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    back = media.sniff(stored).drop("blob")
    size = F.length("payload").cast("bigint")
    kinds = F.transform("media", lambda m: m["type"])
    wav = F.get("carved", F.array_position(kinds, F.lit("audio/wav")).cast("int") - 1)
    return back.select(
        "doc_id", "n_bytes", size.alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -16, 16)).alias("tail_crc32"), F.length(wav).cast("bigint").alias("media_bytes"),
        F.sha2(wav, 256).alias("media_sha256"), F.concat_ws(";", "media_type", "feature", F.array_join(kinds, ",")).alias("feature"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.format_turns(rows.unionByName(more)))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie at <source>/<lang>/<shelf>/<id>, but every tenth one a level higher and every hundredth two."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", F.when(F.col("doc_id") % 100 != 0, F.col("lang")), F.when(F.col("doc_id") % 10 != 0, F.concat(F.lit("shelf"), F.expr("doc_id div 500"))), F.col("doc_id").cast("string"))
    own = license_scan.scan(docs.select("doc_id", "text"), license_scan.TEMPLATES)
    return license_scan.inherit(docs.select("doc_id", path.alias("path")), own)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.sort_array(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", F.size("hit_words").cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), "contaminated")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pii.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return done.select("doc_id", "text", F.col("n_entities").cast("bigint").alias("n_entities"), F.array_join("kinds", ",").alias("kinds"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.PATTERN)
    back = byte_bpe.decode(coded.select("doc_id", "token_ids", F.coalesce(F.array_max("token_ends"), F.lit(0)).alias("n_chars")), path)
    return back.select(
        "doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "n_chars")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return rated.select("doc_id", "held_out", "score", "predicted")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return cut.select("doc_id", "text", F.size("removed_lines").cast("bigint").alias("n_removed"), F.array_join(F.transform("removed_lines", lambda x: x.cast("string")), ",").alias("removed"), "emptied")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_corpus(table(spark, sf_dir, "documents").select("doc_id", "text"), *paths).drop("text")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(whitening.quantised(table(spark, sf_dir, "embeddings"), "embedding", 64, 1_000_000), "vec_id")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages have no time of capture: each counts as captured page_id seconds after a fixed instant."""
    path = shared_dir(spark)
    pages = warc.plan(table(spark, sf_dir, "pages"), at=F.col("page_id") + CAPTURED_FROM)
    found = warc.index(warc.archive(pages, path), path)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "capture", "position")


QUERIES = {
    f.__name__: f for f in (
        op1_url_filter, op2_media, op3_chat, op4_license_scan, op5_decontaminate, op6_pii, op7_byte_bpe, op8_jaccard_join, op9_quality, op10_line_dedup, op11_alignment, op12_whitening, op13_warc)
}
