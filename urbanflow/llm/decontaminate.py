"""Benchmark decontamination by winnowing.

Both sides hash every k-gram of words and keep the least hash of each window of W consecutive k-grams, so any shared
span of K + W - 1 = 10 words shares a fingerprint.  Fingerprints of the documents join those of the test items.  A hit
is then extended: each test window with the fingerprint states where in it the fingerprint lies, which gives the
document's words to compare with the window, one by one, so hash collisions don't count.  Items of fewer than 10 words
are one window of their own length, found by the hash of the whole of them.

Everything is built-in SQL.  Three passes read the documents: the first keeps the hashes of texts with a
fingerprint hit, the second compares the words of those only, each different text once, the third adds the results to
all rows.  What is found depends on the text alone, so it goes by 128 bits of the text's hash, and copies meet one row
however many they are.  Each small side is broadcast only below a counted size; beyond it both sides are shuffled.

Defined cases: null and empty texts have no words and aren't contaminated; items without words hit nothing; repeated
items count each by its id; every row gets the result of its text, whatever its key; columns
called like the new ones are replaced, all others keep their values, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.common import ascii_lower, fresh, others, quoted, same, written

K, W = 5, 6
SPAN = K + W - 1
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows that may be broadcast: fingerprints, documents with hits.
BROADCAST_ROWS = 500_000
#: Bytes of results that may be broadcast.
BROADCAST_BYTES = 64_000_000
NEW = ("n_words", "hit_words", "items", "contaminated")


def words(text: Column) -> Column:
    """Runs of 0-9, a-z and characters beyond ASCII, after A-Z are lower-cased."""
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), BREAK), ""), F.array().cast("array<string>"))


def grams(n: int) -> Column:
    """Hashes of the n-grams of `words`, by position."""
    own = ", ".join(f"get(words, i + {k})" for k in range(n))
    return F.expr(f"transform(if(size(words) >= {n}, sequence(0, size(words) - {n}), array()), i -> xxhash64({own}))")


def each_window(body: str) -> Column:
    """body (of i, the window's place) for each window of W hashes in `grams`."""
    return F.expr(f"transform(if(size(grams) >= {W}, sequence(0, size(grams) - {W}), array()), i -> {body})")


IN_WINDOW = ", ".join(f"get(grams, i + {k})" for k in range(W))
LEAST = f"least({IN_WINDOW})"
#: Where the window's fingerprint lies, from 0.
PLACE = f"CAST(i - 1 + array_position(array({IN_WINDOW}), {LEAST}) AS INT)"


def item_windows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """span, print (fingerprint), off (its place in the window), window (words) and the items with it, a row per window."""
    rows = benchmark.select(quoted(item).alias("item"), words(quoted(text)).alias("words")).where("size(words) > 0")
    long = rows.where(f"size(words) >= {SPAN}").withColumn("grams", grams(K))
    long = long.select("item", "words", "grams", F.posexplode(each_window(PLACE)).alias("at", "place"))
    long = long.select("item", F.lit(SPAN).alias("span"), F.get("grams", "place").alias("print"), (F.col("place") - F.col("at")).alias("off"), F.slice("words", F.col("at") + 1, SPAN).alias("window"))
    out = long
    for n in range(1, SPAN):
        out = out.unionByName(rows.where(F.size("words") == n).select("item", F.lit(n).alias("span"), F.get(grams(n), F.lit(0)).alias("print"), F.lit(0).alias("off"), F.col("words").alias("window")))
    return out.groupBy("span", "print", "off", "window").agg(F.collect_set("item").alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """All rows of docs with n_words, hit_words (positions from 0), items (ids) and contaminated."""
    tests = written(item_windows(benchmark, item, item_text), "tests")
    sizes = tests.groupBy("span").agg(F.count("*").alias("n")).collect()  # ten rows at most
    short, total = sorted(r["span"] for r in sizes if r["span"] < SPAN), sum(r["n"] for r in sizes)
    sized = F.broadcast if total <= BROADCAST_ROWS else lambda df: df

    # Which documents share a fingerprint with an item.
    version, second = F.xxhash64(quoted(text)), F.xxhash64(F.lit(1), quoted(text))
    rows = docs.select(version.alias("version"), second.alias("second"), words(quoted(text)).alias("words"))
    prints = [F.struct(F.lit(SPAN).alias("span"), F.array_distinct(each_window(LEAST)).alias("prints"))]
    prints += [F.struct(F.lit(m).alias("span"), F.array_distinct(grams(m)).alias("prints")) for m in short]
    seen = rows.withColumn("grams", grams(K)).select("version", "second", F.explode(F.array(*prints)).alias("e")).select("version", "second", "e.span", F.explode("e.prints").alias("print"))
    prints = sized(tests.select(F.col("span").alias("own_span"), F.col("print").alias("own_print")).distinct())
    hits = seen.join(prints, (F.col("print") == F.col("own_print")) & same(F.col("span"), F.col("own_span")), "left_semi").select(F.col("version").alias("hit_version"), F.col("second").alias("hit_second")).distinct()
    hits = written(hits, "hits")
    hits = F.broadcast(hits) if hits.count() <= BROADCAST_ROWS else hits

    # Extending: from the places of fingerprints to the windows that they may belong to, word by word.
    texts = rows.join(hits, (F.col("version") == F.col("hit_version")) & same(F.col("second"), F.col("hit_second")), "left_semi")
    texts = texts.dropDuplicates(["version", "second"]).withColumn("grams", grams(K))
    places = [F.struct(F.lit(SPAN).alias("span"), F.transform(F.array_distinct(each_window(PLACE)), lambda p: F.struct(p.alias("place"), F.get("grams", p).alias("print"))).alias("prints"))]
    places += [F.struct(F.lit(m).alias("span"), F.transform(grams(m), lambda g, i: F.struct(i.alias("place"), g.alias("print"))).alias("prints")) for m in short]
    near = texts.select("version", "second", "words", F.explode(F.array(*places)).alias("e")).select("version", "second", "words", "e.span", F.inline("e.prints"))
    windows = sized(tests.withColumnsRenamed({"span": "own_span", "print": "own_print"}))
    near = near.join(windows, (F.col("print") == F.col("own_print")) & same(F.col("span"), F.col("own_span")))
    at = F.col("place") - F.col("off")
    exact = near.withColumn("at", at).where("at >= 0").where(F.slice("words", F.col("at") + 1, F.col("span")) == F.col("window"))
    spans = exact.select("version", "second", "items", F.sequence("at", F.col("at") + F.col("span") - 1).alias("covered"))
    found = spans.groupBy("version", "second").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("covered")))).alias("covered"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("tests"))
    found = written(found, "found")
    taken = found.agg(F.sum(64 + 4 * F.size("covered") + 16 * F.size("tests"))).first()[0] or 0

    mine = fresh(docs, "hit_version", "hit_second", "covered", "tests")  # no column of docs has such a name
    found = found.toDF(*mine)
    found = F.broadcast(found) if taken <= BROADCAST_BYTES else found
    hit_version, hit_second, covered, names = (F.col(c) for c in mine)
    item_type = "array<" + benchmark.schema[item].dataType.simpleString() + ">"
    out = docs.join(found, (version == hit_version) & same(second, hit_second), "left")
    return out.select(
        *(quoted(c) for c in others(docs, *NEW)), F.size(words(quoted(text))).cast("bigint").alias("n_words"), F.coalesce(covered, F.array().cast("array<int>")).alias("hit_words"),
        F.coalesce(names, F.array().cast(item_type)).alias("items"), hit_version.isNotNull().alias("contaminated"))
