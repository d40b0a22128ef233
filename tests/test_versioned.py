"""Versioned tables: pinned versions, upserts that touch few files, writers at once, partitions swapped whole, streams."""

import json
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from urbanflow.operators import quality, sinks, snapshots
from urbanflow.sources import versioned

KV = "k int, v string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def data_files(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


def test_every_version_stays_readable(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    a = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], KV)
    assert sinks.write(a, path, "merge", keys=["k"]) == 0
    assert sinks.write(spark.createDataFrame([(2, "B"), (None, "N"), (3, "c")], KV), path, "merge", keys=["k"]) == 1
    assert sinks.write(spark.createDataFrame([(9, "z", 1.5)], f"{KV}, w double"), path, "append") == 2
    assert sinks.write(spark.createDataFrame([(7,)], "q int"), path, "overwrite") == 3
    assert rows_of(versioned.read(spark, path, 0)) == rows_of(a)
    assert rows_of(versioned.read(spark, path, 1)) == sorted([(1, "a"), (2, "B"), (3, "c"), (None, "N")], key=str)
    assert sorted(versioned.read(spark, path, 2).where("w is null or k = 9").collect(), key=str) == sorted([(1, "a", None), (2, "B", None), (3, "c", None), (9, "z", 1.5), (None, "N", None)], key=str)
    assert versioned.read(spark, path).collect() == [(7,)]
    for number in (4, -1):
        with pytest.raises(ValueError, match="no version"):
            versioned.read(spark, path, number)
    with pytest.raises(ValueError, match="repeated"):
        sinks.write(a.unionByName(a), f"{path}2", "merge", keys=["k"])
    with pytest.raises(ValueError, match="lacks"):
        sinks.write(a.select("k"), f"{path}3", "merge", keys=["k"]), sinks.write(a, f"{path}4", "merge", keys=["k"]), sinks.write(a.select("k"), f"{path}4", "merge", keys=["k"])
    with pytest.raises(ValueError, match="sideways"):
        sinks.write(a, path, "sideways")


def test_empty_tables_and_odd_names(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    empty = spark.createDataFrame([], KV)
    for strategy in ("overwrite", "append", "merge"):
        sinks.write(empty, f"{path}-{strategy}", strategy, keys=["k"])
        assert versioned.read(spark, f"{path}-{strategy}").collect() == []
        sinks.write(spark.createDataFrame([(1, "x")], KV), f"{path}-{strategy}", "merge", keys=["k"])
        assert versioned.read(spark, f"{path}-{strategy}").collect() == [(1, "x")]
    odd = spark.createDataFrame([(1, "a b%/=:ü?[1]*"), (2, None), (3, "")], KV)
    versioned.overwrite(odd, path, ["v"])
    versioned.upsert(spark.createDataFrame([(1, "a b%/=:ü?[1]*"), (4, "#")], KV), path, ["k"])
    assert rows_of(versioned.read(spark, path)) == sorted([(1, "a b%/=:ü?[1]*"), (2, None), (3, None), (4, "#")], key=str)


def test_an_upsert_writes_only_the_files_it_touches(spark, tmp_path):
    path, n = f"{tmp_path}/t", 40_000
    df = spark.range(n).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v")).repartitionByRange(16, "id")
    versioned.overwrite(df, f"file://{path}")
    before = data_files(path)
    versioned.upsert(spark.createDataFrame([(5, "five"), (6, "six"), (n, "new")], "id bigint, v string"), f"file://{path}", ["id"])
    new = sum(size for f, size in data_files(path).items() if f not in before)
    assert len(before) == 16 and new < 1.6 * max(before.values())
    entry = [json.loads(x) for x in open(f"{path}/log/{1:020d}.json")]
    assert sum("remove" in x for x in entry) == 1
    now = versioned.read(spark, f"file://{path}")
    assert now.count() == n + 1 and {r.id for r in now.where("length(v) < 5").collect()} == {5, 6, n}


def together(jobs):
    failed = []

    def run(job):
        try:
            job()
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=run, args=(job,)) for job in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed, failed


def test_writers_at_once_lose_nothing(spark, tmp_path):
    """Three writers upsert overlapping keys in one file, each several times; a counter column would show a lost update."""
    path, turns = f"file://{tmp_path}/t", 3
    versioned.overwrite(spark.createDataFrame([(0, "start")], KV), path)

    def writer(w):
        def job():
            for i in range(turns):
                versioned.upsert(spark.createDataFrame([(100 * w + i, f"w{w}"), (1000 + i, f"w{w}")], KV), path, ["k"])

        return job

    together([writer(w) for w in (1, 2, 3)])
    got = dict(rows_of(versioned.read(spark, path)))
    assert set(got) == {0, *(100 * w + i for w in (1, 2, 3) for i in range(turns)), *(1000 + i for i in range(turns))}
    assert versioned.newest(spark, path) == 3 * turns and all(got[100 * w + i] == f"w{w}" for w in (1, 2, 3) for i in range(turns))


def test_who_comes_second_reads_the_new_version_first(spark, tmp_path, monkeypatch):
    """Another writer takes the version just before this one's entry: both changes of one row's neighbours are kept."""
    path = f"file://{tmp_path}/t"
    versioned.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], KV).coalesce(1), path)
    publish, others = versioned.publish, [spark.createDataFrame([(1, "other")], KV)]

    def late(*args):
        if others:
            versioned.upsert(others.pop(), path, ["k"])
        return publish(*args)

    monkeypatch.setattr(versioned, "publish", late)
    assert versioned.upsert(spark.createDataFrame([(2, "mine")], KV), path, ["k"]) == 2
    assert rows_of(versioned.read(spark, path)) == [(1, "other"), (2, "mine")]
    assert len({f.split("/data/")[1].split("/")[0] for f in data_files(f"{tmp_path}/t")}) == 3  # what the loser wrote first is gone


def test_a_log_entry_is_taken_once(spark, tmp_path):
    (tmp_path / "log").mkdir()
    took = []
    together([lambda i=i: took.append((versioned.publish(spark, f"file://{tmp_path}/log/0.json", f"writer {i}"), i)) for i in range(12)])
    winner, = [i for won, i in took if won]
    assert (tmp_path / "log" / "0.json").read_text() == f"writer {winner}" and [f for f in os.listdir(tmp_path / "log") if not f.endswith(".crc")] == ["0.json"]


def test_partitions_are_swapped_whole(spark, tmp_path, monkeypatch):
    path, kp = f"file://{tmp_path}/t", "k int, p int"
    versioned.overwrite(spark.createDataFrame([(1, None), (2, 7), (3, 8)], kp), path, ["p"])
    old = rows_of(versioned.read(spark, path))
    new = spark.createDataFrame([(4, None), (5, 7)], kp)

    def broken(*_):
        raise OSError("the log can't be reached")

    with monkeypatch.context() as m:
        m.setattr(versioned, "publish", broken)
        with pytest.raises(OSError):
            sinks.write(new, path, "replace_partitions", partition_by=["p"])
    assert rows_of(versioned.read(spark, path)) == old  # all its files are there, but none is read
    half = new.withColumn("k", F.when(F.col("k") == 5, F.raise_error(F.lit("stop"))).otherwise(F.col("k")))
    with pytest.raises(Exception, match="stop"):
        sinks.write(half, path, "replace_partitions", partition_by=["p"])
    assert rows_of(versioned.read(spark, path)) == old
    sinks.write(new, path, "replace_partitions", partition_by=["p"])
    assert rows_of(versioned.read(spark, path)) == [(3, 8), (4, None), (5, 7)] and rows_of(versioned.read(spark, path, 0)) == old
    with pytest.raises(ValueError, match="no partition"):
        sinks.write(new.limit(0), path, "replace_partitions", partition_by=["p"])
    with pytest.raises(ValueError, match="partitioned by"):
        sinks.write(new, path, "replace_partitions", partition_by=["k"])


def no_null(df):
    return quality.counters(df, {"null_key": F.col("k").isNull()})


def test_a_snapshot_is_that_of_the_captured_versions(spark, tmp_path):
    src = f"file://{tmp_path}/src"
    versioned.overwrite(spark.createDataFrame([(1,), (2,)], "k int"), src)
    captured = snapshots.capture(spark, {"src": src}, {"src": 0})
    versioned.overwrite(spark.createDataFrame([(3,)], "k int"), src)
    versioned.upsert(spark.createDataFrame([(4,)], "k int"), src, ["k"])
    back = snapshots.build(captured, f"file://{tmp_path}/a", {"run": "r"}, lambda t: {"x": t["src"]}, no_null)
    assert rows_of(back["x"]) == [(1, "r", '{"src":0}'), (2, "r", '{"src":0}')]
    with pytest.raises(ValueError, match="versions expected"):
        snapshots.capture(spark, {"src": src}, {"src": 0})
    now = snapshots.capture(spark, {"src": src})
    assert now.versions == {"src": 2} and rows_of(now.frames["src"]) == [(3,), (4,)]
    with pytest.raises(ValueError, match="null_key"):
        snapshots.build(now, f"file://{tmp_path}/b", {"run": "r"}, lambda t: {"x": t["src"].withColumn("k", F.lit(None).cast("int"))}, no_null)


def test_random_histories_equal_a_dict(spark, tmp_path):
    rng, path, want, states = random.Random(2), f"file://{tmp_path}/t", {}, []
    for _ in range(8):
        own = {rng.choice([None, *range(12)]): str(rng.random()) for _ in range(rng.randint(0, 6))}
        versioned.upsert(spark.createDataFrame(list(own.items()), KV).repartition(2), path, ["k"])
        want |= own
        states.append(dict(want))
    for i, state in enumerate(states):
        assert dict(rows_of(versioned.read(spark, path, i))) == state
