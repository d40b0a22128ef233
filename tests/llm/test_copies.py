"""Many copies of one text take about the time of as many different texts; sketches decide all but the near band."""

import random
import time

import pytest
from pyspark.sql import functions as F

from urbanflow.llm import decontaminate, line_dedup

N = 60_000


def copies_and_others(spark):
    """N documents of one text, N of different texts; both hold a line that many sites share and a passage of the benchmark."""
    passage = " ".join(f"word{i}" for i in range(12))
    base = spark.range(N).select(F.col("id").alias("doc_id"), F.concat(F.lit("site"), F.col("id") % 50).alias("source"))
    text = lambda own: F.concat(F.lit(f"a shared line\n{passage}\n"), own)
    return [base.withColumn("text", text(own)) for own in (F.lit("own"), F.concat(F.lit("own"), F.col("doc_id").cast("string")))]


def seconds(run):
    began = time.time()
    rows = run().agg(F.count("*"), F.sum(F.crc32(F.col("text").cast("binary")))).first()
    return time.time() - began, rows[0]


@pytest.mark.parametrize("name", ["contamination", "dedup_lines", "matched"])
def test_copies_take_no_longer(spark, name):
    bench = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(12)))], "item_id bigint, text string")

    def matched(df):
        corpus_pipeline = pytest.importorskip("corpus_pipeline")
        keys = df.select(F.col("doc_id").alias("key"), F.xxhash64("text").alias("version"))
        return corpus_pipeline.matched(df, keys.where("key % 2 = 0"), "left_semi")

    run = {"contamination": lambda df: decontaminate.contamination(df, bench), "dedup_lines": line_dedup.dedup_lines, "matched": matched}[name]
    same, other = copies_and_others(spark)
    run(other.limit(10)).count()  # code is compiled
    (slow, rows), (fast, _) = seconds(lambda: run(same)), seconds(lambda: run(other))
    assert rows == (N // 2 if name == "matched" else N) and slow < 1.5 * fast + 2, (slow, fast)


def test_copies_keep_their_own_results(spark):
    """Every row of one text gets the result of that text, whatever its id."""
    bench = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(10))), (2, "short item")], "item_id bigint, text string")
    hit, clean = "x " + " ".join(f"W{i}" for i in range(10)), "nothing to see"
    rows = [(i % 3 or None, t) for i, t in enumerate([hit, clean, None, "a short item", "", hit] * 7)]
    got = decontaminate.contamination(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), bench).collect()
    want = {hit: (list(range(1, 11)), [1]), "a short item": ([1, 2], [2])}
    assert len(got) == len(rows) and all((list(r.hit_words), list(r.items)) == want.get(r.text, ([], [])) for r in got)


def test_only_the_near_band_meets_by_site(spark):
    """Lines on 1 to 60 sites, each many times on some of them: which are cut follows from exact counts, which are counted from the sketch."""
    rng, rows = random.Random(3), []
    for sites in range(1, 61):
        rows += [(f"line of {sites}", f"s{k}") for k in range(sites) for _ in range(rng.choice([1, 1, 5]))]
    rows += [("line of 3", "s1")] * 400 + [("no site", None)] * 400
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, line, site) for i, (line, site) in enumerate(rows)], "doc_id bigint, text string, source string").repartition(6)
    lines = line_dedup.occurrences(docs, "doc_id", "text", "source")
    rated = line_dedup.spread(lines)
    names = {r.h1: r.text for r in docs.select(F.xxhash64("text").alias("h1"), "text").distinct().collect()}
    estimates = {names[r.h1]: r.sites for r in rated.collect()}
    assert estimates["no site"] == 0 and all(abs(n - int(line.split()[-1])) <= 0.1 * n + 1 for line, n in estimates.items() if line != "no site")
    near = {names[r.h1] for r in line_dedup.near_band(rated).collect()}
    assert 4 <= len(near) <= 8 and near <= {f"line of {k}" for k in range(7, 14)}
    cut = {names[r.h1] for r in line_dedup.boilerplate(lines).collect()}
    assert cut == {f"line of {k}" for k in range(10, 61)}
    plan = rated._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(h1" in plan and "site" not in "".join(x for x in plan.split("\n") if "hashpartitioning" in x)
