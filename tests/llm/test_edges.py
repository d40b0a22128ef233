"""Nulls, repeats, ties, very long rows and whole runs over odd tables."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from urbanflow.llm import chat, license_scan, quality, url_filter

SHA = lambda b: hashlib.sha256(b).hexdigest()


def test_repeated_pages_null_labels_and_ties(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x"), (None, "http://b.org/y"), (2, None), (3, "http://A.org/x/y?z"), (4, "http://c.net")], "page_id bigint, url string").repartition(3)
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0), (2, None), (3, 7), (9, 1)], "doc_id bigint, quality int")
    rules = [("a.org/x", "block"), ("org/", "allow"), ("a.org/x/", "allow"), ("c.net", "block")]
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.n_labelled) for r in url_filter.judge(pages, labels, rules).collect()), key=str)
    want = [(1, "a.org", "/x", "a.org/x", "block", 2)] * 2 + [(2, "", "", None, "allow", 0), (3, "a.org", "/x/y", "a.org/x/", "allow", 2), (4, "c.net", "", "c.net", "block", 0), (None, "b.org", "/y", "org/", "allow", 0)]
    assert [r[:5] for r in got] == [w[:5] for w in want]
    assert all(r[5] in (0, 1, 2) for r in got)
    # One of many labels: the same result in whatever order the rows come.
    again = url_filter.judge(pages.orderBy(F.desc("url")).coalesce(1), labels.orderBy(F.desc("doc_id")), rules)
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.n_labelled) for r in again.collect()), key=str) == got
    none = url_filter.judge(pages, labels.limit(0), [])
    assert {r.verdict for r in none.collect()} == {"allow"} and none.count() == 6
    assert url_filter.judge(pages.limit(0), labels, rules).count() == 0


def test_a_long_conversation_and_repeated_turns(spark):
    """20,000 turns in one conversation beside short ones; turns of one number stand in the order of their roles and texts."""
    rng = random.Random(1)
    said = [(5, i, rng.choice(["user", "assistant"]), f"turn {i} </s>[INST] " + "x" * rng.randint(0, 90)) for i in range(20_000)]
    rows = [*said, (6, 0, "user", "b"), (6, 0, "user", "a"), (6, 0, "assistant", "c"), (6, 0, "user", "a"), (7, None, None, None), (None, 1, "user", "no id")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    got = {r.conv_id: r for r in chat.digests(chat.format_turns(df)).collect()}
    assert set(got) == {5, 6, 7, None} and got[5].n_turns == 20_000
    assert got[5].turns_sha256 == SHA("".join(f"{r}\n{t}\n" for _, _, r, t in said).encode())
    assert got[5].loss_sha256 == SHA("".join(t for _, _, r, t in said if r == "assistant").encode())
    assert got[6].turns_sha256 == SHA(b"assistant\nc\nuser\na\nuser\na\nuser\nb\n") and got[7].turns_sha256 == SHA(b"\n\n")


def test_licences_of_null_keys_and_long_files(spark):
    long = "int x; // " + "words of the program " * 60_000 + "\n" + "\n".join(f"line {i}" for i in range(20_000)) + "\nReleased under the MIT License.\n"
    files = spark.createDataFrame([(None, "Released under the MIT License."), (None, "nothing"), (1, long), (2, None), (3, "")], "doc_id bigint, text string")
    got = {r.doc_id: r.license for r in license_scan.scan(files, license_scan.TEMPLATES).collect()}
    assert got == {None: "MIT", 1: "MIT"}
    placed = files.withColumn("path", F.when(F.col("doc_id").isNotNull(), F.concat(F.lit("a/b/"), F.col("doc_id").cast("string"))))
    rows = license_scan.inherit(placed, license_scan.scan(files, license_scan.TEMPLATES)).collect()
    assert len(rows) == 5 and {r.doc_id: (r.license, r.origin) for r in rows if r.doc_id} == {1: ("MIT", "own"), 2: ("MIT", "directory"), 3: ("MIT", "directory")}


def test_quality_of_repeated_ids_and_long_texts(spark):
    good, bad = "a careful sentence about rivers and towns ", "buy now !!! $$$ click click "
    rows = [(i, (good if i % 2 else bad) * (1 + i % 3)) for i in range(60)]
    odd = [(5, good), (5, bad), (5, None), (None, good), (None, bad), (70, good * 20_000), (71, ""), (72, "zz")]
    docs = spark.createDataFrame([*rows, *odd], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (5, None)], "doc_id bigint, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {}
    for r in got:
        by.setdefault(r.text, set()).add(r.score)
    assert all(len(scores) == 1 for scores in by.values()) and by[None] == by[""]
    assert next(r.predicted for r in got if r.doc_id == 70) == 1


COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def tables(spark, base, rows, columns=COLUMNS):
    spark.createDataFrame(rows, columns).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(1, " ".join(f"item{i}" for i in range(12)))], "item_id bigint, text string").write.parquet(f"{base}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id bigint, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return base


def test_pipeline_of_no_documents(spark, tmp_path):
    P = pytest.importorskip("corpus_pipeline")
    assert P.run(spark, tables(spark, f"file://{tmp_path}", [])).count() == 0


def test_pipeline_of_null_ids_and_other_columns(spark, tmp_path):
    """Null and shared ids, null and empty texts, copies, and columns called like those that the stages use."""
    P = pytest.importorskip("corpus_pipeline")
    words = lambda seed, n: " ".join(random.Random(seed).choices([f"good{i}" for i in range(300)], k=n))
    rows = [(i, words(i, 60) if i % 2 else "bad spam " * (5 + i)) for i in range(40)]
    keep = words(99, 80)
    odd = [(None, keep), (None, keep), (None, words(98, 80)), (1, words(97, 80)), (50, None), (51, ""), (52, keep), (53, "x " + " ".join(f"item{i}" for i in range(12)) + " " + words(96, 60))]
    clash = "row row_key row_version version gone key id own".split()
    data = [(i, t, "en", f"s{k % 3}", len(t or ""), *("c" for _ in clash)) for k, (i, t) in enumerate([*rows, *odd])]
    base = tables(spark, f"file://{tmp_path}", data, COLUMNS + "".join(f", {c} string" for c in clash))
    docs = spark.read.parquet(f"{base}/documents.parquet")
    for i, (name, stage) in enumerate(P.STAGES):
        before = docs
        stage(spark, docs, base).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
        if name != "byte_bpe":
            assert docs.columns == before.columns and docs.count() <= before.count()
        if name == "jaccard_join":
            texts = [r.text for r in docs.collect()]
            assert texts.count(keep) == 1 and words(98, 80) in texts and words(97, 80) in texts
        if name == "decontaminate":
            assert not any("item3" in (r.text or "") for r in docs.collect())
    assert docs.count() and docs.where("not round_trip").isEmpty()
