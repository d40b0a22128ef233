"""Digest columns, extra columns, empty tables and learning, each against a plain recomputation."""

import hashlib
import itertools
import math
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_llm import SF, brute_components, docs_of
from urbanflow.llm import byte_bpe, chat, decontaminate, jaccard_join, license_scan, line_dedup, media, pii, quality, url_filter
from urbanflow.llm.queries import QUERIES

SHA = lambda b: hashlib.sha256(b).hexdigest()
CLASHING = "id version hit_id hit_version draws cut_text score blob media gone gone_id key n digest cls line own row_key row_version rank h1 first covered tests words grams".split()


def texts_of(sf=SF):
    return dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())


def with_clashes(df):
    return df.select("*", *(F.concat(F.lit(f"{c}:"), F.monotonically_increasing_id().cast("string")).alias(c) for c in CLASHING if c not in df.columns))


def public():
    import public_tokenizers as P

    return P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN


TEXTS = ["Mail a.b@mail1.example.com", "shared line\nown words of some length here and there", None, "", "shared line", "one two three four five six seven eight nine ten"]
BENCH = [(1, "two three four five six seven eight nine ten one")]


def applied(name, df):
    spark = df.sparkSession
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (3, 1)], "doc_id bigint, quality int")
    path, pattern = public()
    return {
        "media": lambda: media.sniff(media.store(df, out="stored_blob"), blob="stored_blob").drop("media"), "chat": lambda: chat.format_turns(df.withColumn("role", F.lit("user"))),
        "decontaminate": lambda: decontaminate.contamination(df, bench), "pii": lambda: pii.pseudonymize(df, b"k"), "byte_bpe": lambda: byte_bpe.decode(byte_bpe.encode(df, path, pattern), path),
        "quality": lambda: quality.classify(df, labels), "line_dedup": lambda: line_dedup.dedup_lines(df),
    }[name]()


@pytest.mark.parametrize("name", ["media", "chat", "decontaminate", "pii", "byte_bpe", "quality", "line_dedup"])
def test_columns_of_any_name_keep_their_values(spark, name):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(None, "x", "s"), (1, TEXTS[1], "s"), (1, "another text", None)]
    df = with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string, source string").coalesce(1))
    own = [c for c in df.columns if c not in {"media": ("media",), "quality": ("score",)}.get(name, ()) and c != "text"]
    out = applied(name, df)
    assert sorted(map(str, out.select(own).collect())) == sorted(map(str, df.select(own).collect()))
    assert applied(name, df.limit(0)).count() == 0


def test_joins_and_scans_ignore_other_columns(spark):
    df = with_clashes(spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[5]), (9, TEXTS[5]), (9, "z")], "doc_id bigint, text string"))
    got = sorted(map(tuple, jaccard_join.near_duplicates(df).collect()), key=str)
    assert got == sorted([(0, 1, 0), (1, 6, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 6, 5), (None, 6, 5), (9, 6, 5), (9, 1, 9)], key=str)
    assert jaccard_join.near_duplicates(df.limit(0)).count() == 0
    files = df.withColumn("path", F.lit("a/b"))
    assert license_scan.inherit(files, license_scan.scan(files, license_scan.TEMPLATES)).count() == files.count()
    assert license_scan.inherit(files.limit(0), license_scan.scan(files.limit(0), license_scan.TEMPLATES)).count() == 0
    pages = with_clashes(spark.createDataFrame([(1, "http://a.com/x")], "page_id bigint, url string"))
    assert url_filter.judge(pages, spark.createDataFrame([(1, 1)], "doc_id bigint, quality int"), []).count() == 1
    turns = spark.createDataFrame([(1, 0, "user", "hi")], "c bigint, t bigint, speaker string, said string")
    done = chat.digests(chat.format_turns(turns, "speaker", "said"), "c", "t", role="speaker").collect()
    assert done[0].turns_sha256 == SHA(b"user\nhi\n") and chat.digests(chat.format_turns(turns.limit(0), "speaker", "said"), "c", "t", role="speaker").count() == 0


def test_similar_pairs_by_brute_force(spark, monkeypatch):
    import random

    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rng, base = random.Random(5), [f"w{i}" for i in range(50)]
    texts = [" ".join(base)] * 2
    for _ in range(25):
        w = base[:]
        for _ in range(rng.randrange(3)):
            w[rng.randrange(50)] = f"v{rng.randrange(5)}"
        texts.append(" ".join(w))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(46)} for t in texts]
    want = {frozenset((frozenset(a), frozenset(b))) for a, b in itertools.combinations(sets, 2) if a != b and 100 * len(a & b) >= 80 * len(a | b)}
    pairs, rows = jaccard_join.similar_pairs(docs_of(spark, texts))
    of = {r["class"]: frozenset(sets[r.doc_id]) for r in rows.collect()}
    got = pairs.collect()
    assert {frozenset((of[r.a], of[r.b])) for r in got} == want and len(got) == len(want) > 8 and all(r.common == len(of[r.a] & of[r.b]) for r in got)


def test_bad_hosts_are_blocked(spark):
    hosts = {"good.com": (20, 18), "bad.com": (20, 2), "a.bad.com": (10, 1), "b.co.uk": (20, 19), "c.co.uk": (20, 1), "d.good.com": (0, 0)}
    pages, labels = [], []
    for host, (n, good) in hosts.items():
        for k in range(max(n, 1)):
            pages.append((len(pages), f"https://{host}/{k}"))
            if n:
                labels.append((len(pages) - 1, int(k < good)))
    got = {r.host: r.verdict for r in url_filter.judge(spark.createDataFrame(pages, "page_id bigint, url string"), spark.createDataFrame(labels, "doc_id bigint, quality int"), []).collect()}
    assert got["good.com"] == got["b.co.uk"] == "allow" and got["bad.com"] == got["a.bad.com"] == got["c.co.uk"] == "block"


def wrapped(text, width=70, mark="# "):
    import textwrap

    return "\n".join(mark + x for x in textwrap.wrap(text, width))


def test_real_licences(spark):
    L = license_scan
    mit = f"The MIT License (MIT)\n\nCopyright (c) 2020 Jane Doe\n\n{wrapped(L.PERMIT, mark='')}\n\n{wrapped(L.AS_IS, mark='')}\n"
    apache = wrapped("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0")
    gpl = f"                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\nPreamble\n\n{'other words ' * 300}"
    bsd = f"Copyright 2001\n\n{wrapped(L.REDISTRIBUTE + ': ' + L.SOURCE_BINARY + ' ' + L.BSD_AS_IS, mark=' * ')}"
    files = {1: mit, 2: f"#!/bin/sh\n{apache}\necho", 3: gpl, 4: bsd, 5: "// SPDX-License-Identifier: MIT OR Zlib\nint x;", 6: "I like the public library, and this software is free of charge.", 7: None, 8: ""}
    df = spark.createDataFrame(list(files.items()), "doc_id bigint, text string")
    got = {r.doc_id: (r.license, r.kind) for r in L.scan(df, L.TEMPLATES).collect()}
    assert {i: x[0] for i, x in got.items()} == {1: "MIT", 2: "Apache-2.0", 3: "GPL-3.0", 4: "BSD-2-Clause", 5: "MIT"}
    assert got[3][1] == "block" and got[5][1] == "spdx"
    idf, tw, top = L.weights(L.TEMPLATES)
    words = set(L.anchors(L.TEMPLATES, 0.8))
    assert all(sum(w * w for k, w in t.items() if k not in words) < 0.64 for t in tw) and top > max(idf.values()) - 1e-9


def test_media_query_by_recomputation(spark):
    texts = texts_of()
    got = {r.doc_id: r for r in QUERIES["op2_media"](spark, SF).collect()}
    assert got.keys() == texts.keys() and len({tuple(r[1:]) for r in got.values()}) == len(set(texts.values()))
    for i, t in texts.items():
        raw = (t or "").encode()
        p = raw + b" " * (-len(raw) % 192 if raw else 192)
        wav = media.store_wav(p)
        x = np.frombuffer(p, np.uint8).astype(float)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256) == (len(raw), len(p), SHA(p), zlib.crc32(p[-16:]), len(wav), SHA(wav))
        kind, mean, var, high, kinds = r.feature.split(";")
        assert kind == "audio/wav" and kinds in ("audio/wav", "audio/wav,image/png", "image/png,audio/wav") and abs(float(mean[5:]) - x.mean() * 1000) <= 1 and abs(float(var[4:]) - x.var() * 1000) <= 1
        assert abs(int(high[5:]) - (x > 127).mean() * 1000) <= 1


def test_media_is_carved_from_every_layout(spark):
    rows = media.sniff(media.store(docs_of(spark, [f"text {i}" for i in range(40)]))).collect()
    assert {tuple(m.type for m in r.media) for r in rows} == {("audio/wav",), ("audio/wav", "image/png"), ("image/png", "audio/wav")}
    for r in rows:
        assert r.media_type == "audio/wav" and [bytes(c) for c in r.carved] == [bytes(r.blob)[m.start : m.start + m.length] for m in r.media]
        assert media.THUMBNAIL in [bytes(c) for c in r.carved] or len(r.carved) == 1


def test_validators():
    segment = lambda kind, body: b"\xff" + bytes([kind]) + (len(body) + 2).to_bytes(2, "big") + body
    jpeg = b"\xff\xd8" + segment(0xE0, b"JFIF") + segment(0xDA, b"h") + b"a\xff\x00b\xff\xd0c" + segment(0xC4, b"t") + segment(0xDA, b"h") + b"d\xff\x00\xff\xd9"
    pdf = b"%PDF-1.4 x startxref 1 %%EOF more startxref 2 %%EOF"
    flac = b"fLaC\x80\x00\x00\x22" + bytes(34) + b"\xff\xf8rest"
    for kind, good in (("image/jpeg", jpeg), ("application/pdf", pdf), ("audio/flac", flac)):
        tail = b"" if kind == "audio/flac" else b"junk"
        assert media.sniff_bytes(b"xx" + good + tail) == [(kind, 2, len(good))]
    assert media.sniff_bytes(jpeg[:-2]) == [] and media.sniff_bytes(b"%PDF-1.4 no end") == [] and media.sniff_bytes(flac[:-6]) == []


def test_bpe_query_and_split_characters(spark):
    import tiktoken

    path, pattern = public()
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.vocabulary(path), special_tokens={})
    texts = texts_of()
    for r in QUERIES["op7_byte_bpe"](spark, SF).collect():
        t = texts[r.doc_id] or ""
        ids = own.encode_ordinary(t)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.n_chars) == (len(ids), SHA(",".join(map(str, ids)).encode()), SHA(t.encode()), len(t))
    emoji = "x👍🏽é 你"
    ids = own.encode_ordinary(emoji)
    assert "".join(byte_bpe.stream_text(path, ([i] for i in ids))) == emoji
    cut = spark.createDataFrame([(k, ids[k:]) for k in range(len(ids))] + [(99, None)], "k int, token_ids array<int>")
    for r in byte_bpe.decode_text(cut, path).collect():
        assert r.decoded_text == (own.decode_bytes(ids[r.k :]).decode("utf-8", "replace") if r.k < 99 else "")


def plain_features(text):
    raw, out = (text or "").encode(), []
    for n in quality.NGRAMS:
        for i in range(len(raw) - n + 1):
            gram = int.from_bytes(raw[i : i + n], "big")
            out.append((((gram ^ ((n - 1) * 0x3C6EF372 & 0xFFFFFFFF)) * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - quality.BITS))
    for word in raw.translate(bytes(32 if quality.SPACE[b] else b for b in range(256))).split():
        h = sum((c + 1) * pow(0xD6E8FEB86659FD93, k & 63, 2**64) for k, c in enumerate(word)) % 2**64
        out.append((((h ^ (h >> 31)) * 0x9E3779B97F4A7C15) % 2**64) >> (64 - quality.BITS))
    return out


def test_quality_scores_by_brute_force_and_held_out_auc(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    learned = quality.learning_rows(docs, labels, ~quality.held_out())
    texts, marks = texts_of("/root/testdata/sf0.01"), dict(duckdb.connect().execute("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet' WHERE quality IS NOT NULL").fetchall())
    mine = sorted((int(y), sorted(plain_features(texts[i]))) for i, y in marks.items() if zlib.crc32(str(i).encode()) % 3 != 1 and texts[i])
    assert sorted((y, sorted(np.repeat(ids, counts).tolist())) for ids, counts, y in learned) == mine
    weights, prior = quality.fit(learned)
    got = {r.doc_id: r for r in QUERIES["op9_quality"](spark, "/root/testdata/sf0.01").collect()}
    assert got.keys() == texts.keys()
    for i, t in itertools.islice(texts.items(), 150):
        f = plain_features(t)
        z = float(np.mean(weights[f].astype(float))) if f else prior
        assert abs(got[i].score - 1 / (1 + math.exp(-z))) < 1e-6 and got[i].predicted == int(got[i].score >= 0.5) and got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
    held = [(got[i].score, y) for i, y in marks.items() if got[i].held_out]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert len(bad) > 5 and sum((a > b) + (a == b) / 2 for a in good for b in bad) / len(good) / len(bad) > 0.95


def test_what_the_driver_takes_is_bounded(spark, monkeypatch):
    docs = docs_of(spark, [f"some words number {i} of a text" for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    whole = quality.learning_rows(docs, labels, F.lit(True))
    monkeypatch.setattr(quality, "MAX_PAIRS", sum(len(r[0]) for r in whole) // 2)
    part = quality.learning_rows(docs, labels, F.lit(True))
    assert len(whole) == 40 and 15 < len(part) < 25 and sum(len(r[0]) for r in part) <= quality.MAX_PAIRS


def test_pipeline_by_brute_force(spark, tmp_path):
    """Each stage on all that the one before kept, recomputed in plain Python."""
    import corpus_pipeline as P
    from urbanflow.llm.oracles import OP5

    cols = "doc_id, text, lang, source, n_chars"
    con = duckdb.connect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(f"file://{tmp_path}/{name}")
        docs = spark.read.parquet(f"file://{tmp_path}/{name}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if name != "byte_bpe":
            assert docs.columns == before.columns == cols.split(", ")
    rated = {r.doc_id: r.predicted for r in QUERIES["op9_quality"](spark, SF).collect()}
    assert set(kept["quality_classifier"]) == {i for i, p in rated.items() if p == 1}

    sites = {}
    for r in kept["quality_classifier"].values():
        for pos, line in enumerate((r.text or "").split("\n")):
            if line.strip():
                sites.setdefault(line.strip(), []).append((r.doc_id, pos, r.source))
    bad = {k: min(v)[:2] for k, v in sites.items() if len({s for _, _, s in v}) >= line_dedup.MIN_SITES}
    cut = {}
    for r in kept["quality_classifier"].values():
        lines = (r.text or "").split("\n")
        left = [x for pos, x in enumerate(lines) if x.strip() not in bad or bad[x.strip()] == (r.doc_id, pos)]
        if len(left) == len(lines) or "".join(left).strip():
            cut[r.doc_id] = r.text if len(left) == len(lines) else "\n".join(left)
    assert {i: r.text for i, r in kept["line_dedup"].items()} == cut

    ids = sorted(cut)
    groups = [c for _, c in brute_components([cut[i] for i in ids])]
    assert set(kept["jaccard_join"]) == {ids[c] for c in groups} and all(r.text == cut[i] for i, r in kept["jaccard_join"].items())

    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/jaccard_join/*.parquet'")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    clean = {i for i, hit in con.execute(f"SELECT doc_id, contaminated FROM ({OP5})").fetchall() if not hit}
    assert set(kept["decontaminate"]) == clean == set(kept["byte_bpe"])

    import tiktoken

    path, pattern = public()
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.vocabulary(path), special_tokens={})
    assert all(r.round_trip and list(r.token_ids) == own.encode_ordinary(cut[i] or "") for i, r in kept["byte_bpe"].items())
    assert P.run(spark, SF).count() == len(clean)


def test_license_of_rows_that_share_a_key(spark):
    """Equal rows score as one; rows of other texts are scored apart, and the best of them counts."""
    mit, notice = "Released under the MIT License.", "x = 1\nLicensed under the Apache License, Version 2.0\ny"
    files = spark.createDataFrame([(1, mit), (2, mit), (2, mit), (2, mit), (3, "alpha beta gamma"), (3, mit), (4, notice), (5, notice), (5, notice), (6, None), (6, "")], "doc_id bigint, text string")
    got = {r.doc_id: (r.license, r.cosine, r.kind, r.place) for r in license_scan.scan(files, license_scan.TEMPLATES).collect()}
    assert got.keys() == {1, 2, 3, 4, 5} and got[1] == got[2] == got[3] and got[4] == got[5]
    assert got[1] == ("MIT", 1.0, "line", 0) and got[4] == ("Apache-2.0", 1.0, "line", 1)
