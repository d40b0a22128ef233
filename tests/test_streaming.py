"""Streams that upsert, repeat a batch, and rescue fields."""

import pytest
from pyspark.sql import functions as F

from urbanflow.sources import versioned
from urbanflow.streaming import ingest

SCHEMA = "k int, v string, t int"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_a_repeated_batch_changes_nothing(spark, tmp_path, monkeypatch):
    """The stream dies after the write and before its own note of it; started again, it runs the batch again."""
    base = f"file://{tmp_path}"
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
    run = lambda: ingest.upsert_available(stream(), f"{base}/t", ["k"], [F.desc("t")], f"{base}/c")
    land(spark, f"{base}/in", [(1, "old", 1), (1, "new", 2), (2, "b", 1)])
    run()
    assert rows_of(versioned.read(spark, f"{base}/t")) == [(1, "new", 2), (2, "b", 1)]
    land(spark, f"{base}/in", [(2, "B", 5), (3, "c", 5), (None, "n", 5), (None, "m", 4)])
    write = ingest.sinks.write

    def dies(*args, **more):
        write(*args, **more)
        raise OSError("the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(ingest.sinks, "write", dies)
        with pytest.raises(Exception, match="the driver is gone"):
            run()
    want = sorted([(1, "new", 2), (2, "B", 5), (3, "c", 5), (None, "n", 5)], key=str)
    assert versioned.newest(spark, f"{base}/t") == 1 and rows_of(versioned.read(spark, f"{base}/t")) == want
    # Meanwhile somebody else has changed a row: the repeated batch doesn't put it back.
    versioned.upsert(spark.createDataFrame([(3, "later", 9)], SCHEMA), f"{base}/t", ["k"])
    run()
    assert versioned.newest(spark, f"{base}/t") == 2 and (3, "later", 9) in rows_of(versioned.read(spark, f"{base}/t"))
    run()
    land(spark, f"{base}/in", [(4, "d", 1)])
    run()
    assert versioned.newest(spark, f"{base}/t") == 3 and len(rows_of(versioned.read(spark, f"{base}/t"))) == 5


def test_fields_are_rescued_one_by_one(spark, tmp_path):
    base = f"file://{tmp_path}"
    (tmp_path / "in").mkdir()
    put = lambda name, text, code="utf-8": (tmp_path / "in" / name).write_bytes(text.encode(code))
    put("a.csv", 'k;v;d\r\n1;"x; ""y""";2024-01-02\r\n\r\nbad;z;2024-13-02\r\n2;;\r\n3;q;2024-01-03;extra;;more\r\n4\r\n')
    schema = "k int, v string, d date"
    ingest.rescue_available(spark, f"{base}/in", schema, f"{base}/t", f"{base}/c")
    put("b.csv", '﻿w;d;k;;k\n1.5;2024-02-01;5;anon;again\nno;2024-02-02;6;;\nw;d;k;;k\n')
    put("empty.csv", "")
    put("head.csv", "k;v;d\n")
    ingest.rescue_available(spark, f"{base}/in", f"{schema}, w double", f"{base}/t", f"{base}/c")
    got = {(r.k, r.v, str(r.d), r.w, tuple(sorted((r["_rescued"] or {}).items()))) for r in versioned.read(spark, f"{base}/t").collect()}
    assert got == {
        (1, 'x; "y"', "2024-01-02", None, ()), (None, "z", "None", None, (("d", "2024-13-02"), ("k", "bad"))), (2, None, "None", None, ()),
        (3, "q", "2024-01-03", None, (("_c3", "extra"), ("_c5", "more"))), (4, None, "None", None, ()),
        (5, None, "2024-02-01", 1.5, (("_c3", "anon"), ("_c4", "again"))), (6, None, "2024-02-02", None, (("w", "no"),)),
    }


def test_other_encodings_and_separators(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes("k|v\n1|niño\nx|año\n".encode("latin-1"))
    ingest.rescue_available(spark, f"file://{tmp_path}/in", "k int, v string", f"file://{tmp_path}/t", f"file://{tmp_path}/c", sep="|", encoding="ISO-8859-1")
    assert sorted((r.v, r["_rescued"]) for r in versioned.read(spark, f"file://{tmp_path}/t").collect()) == [("año", {"k": "x"}), ("niño", None)]
