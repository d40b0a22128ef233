"""URL filters: explicit rules first, then empirical-Bayes reputation of the host.

Labelled page outcomes are counted by host.  The rate of a host is shrunk towards that of its registered domain (one
label before its public suffix), which is shrunk towards its suffix, which is shrunk towards all pages: beta-binomial
posteriors whose prior strengths come from the spread between the children of each level (method of moments).  A host
is blocked if the lower posterior bound, mean - Z deviations, is below MIN_SHARE of the rate of all pages.

Everything is built-in SQL.  Pages are counted before any shuffle, so a host with a third of all pages sends one row
per task; joining reputations back is a join with one row per host, where adaptive execution splits a hot host.

Defined cases: a null url or one without :// has an empty host and path; labels that are null count for nothing;
a page with several labels counts each; without any label all rates are 1/2 and hosts are allowed by the same bound;
repeated pages are judged each; other columns of pages and labels are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.common import ascii_lower, quoted

Z, MIN_SHARE = 1.0, 0.9
#: Public suffixes of two labels (a parameter; all others have one).
SUFFIXES = ("ac.uk", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "net.au", "org.au", "org.uk")
#: Prior strengths are kept between these.
WEAKEST, STRONGEST = 1.0, 1000.0


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls.  A rule is a host, with a path prefix from its first /."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, slash, start = text.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def strength(level: DataFrame, name: str) -> DataFrame:
    """One row: the prior strength by the spread of the rates n, s around their parents' mean m."""
    labelled = level.where("n > 0").agg(
        F.sum("n").alias("all"), F.count("*").alias("k"),
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("m"), 2)).alias("spread"),
        F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("binomial"))
    # Under a common rate the spread is k/all of the binomial variance; what exceeds it is the variance of the rates.
    rho = F.try_divide(F.col("spread") - F.col("binomial") * F.col("k") / F.col("all"), F.col("binomial"))
    value = F.when(rho > 0, F.least(F.greatest(1 / rho - 1, F.lit(WEAKEST)), F.lit(STRONGEST))).otherwise(F.lit(STRONGEST))
    return labelled.select(F.when(F.col("k") > 1, value).otherwise(F.lit(STRONGEST)).alias(name))


def shrunk(level: DataFrame, parents: DataFrame, on: str, key: str) -> DataFrame:
    """key, n, s and the posterior mean `p` and weight of each row of `level`, given its parents' means m."""
    rows = level.join(parents, on)
    rows = rows.join(F.broadcast(strength(rows, "w")))  # one row
    return rows.select(key, "n", "s", ((F.col("s") + F.col("w") * F.col("m")) / (F.col("n") + F.col("w"))).alias("p"), (F.col("n") + F.col("w")).alias("weight"))


def reputation(outcomes: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """host -> mean, bound, n_labelled, rate (of all pages), from rows (host, good) with good 1, 0 or null (unlabelled)."""
    parts = F.split("host", r"\.")
    last = lambda n: F.array_join(F.slice(parts, F.greatest(F.size(parts) - n + 1, F.lit(1)), n), ".")
    hosts = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("s"))
    hosts = hosts.withColumns({"domain": F.when(last(2).isin(*suffixes), last(3)).otherwise(last(2)), "suffix": F.when(last(2).isin(*suffixes), last(2)).otherwise(last(1))})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).withColumn("all", F.lit(1))
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).select(F.lit(1).alias("all"), F.coalesce(F.try_divide("s", "n"), F.lit(0.5)).alias("m"))
    up = lambda df, key: df.select(key, F.col("p").alias("m"))
    suffixes = shrunk(suffixes, F.broadcast(whole), "all", "suffix")
    domains = shrunk(domains, up(suffixes, "suffix"), "suffix", "domain")
    rated = shrunk(hosts, up(domains, "domain"), "domain", "host")
    deviation = F.sqrt(F.col("p") * (1 - F.col("p")) / (F.col("weight") + 1))
    rated = rated.select("host", F.col("p").alias("mean"), (F.col("p") - F.lit(Z) * deviation).alias("bound"), F.col("n").alias("n_labelled"))
    return rated.join(F.broadcast(whole.select(F.col("m").alias("rate"))))  # one row


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], page: str = "page_id", url: str = "url", label: str = "quality", label_key: str = "doc_id", suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """page, host, path, rule, verdict, mean, bound for every row of pages.  labels: outcomes (0/1) by page."""
    rows = pages.select(quoted(page).alias(page), host_of(quoted(url)).alias("host"), path_of(quoted(url)).alias("path"))
    marks = labels.where(F.col(label).isin(0, 1)).select(F.col(label_key).alias(page), F.col(label).cast("bigint").alias("good"))
    rated = reputation(rows.select(page, "host").join(marks, page, "left"), suffixes)
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    return rows.join(rated, "host", "left").select(
        page, "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("bound") >= MIN_SHARE * F.col("rate"), "allow").otherwise("block")).alias("verdict"),
        F.round("mean", 6).alias("mean"), F.round("bound", 6).alias("bound"), "n_labelled")
