"""The operators on small fixtures with nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

import base64
import hashlib
import itertools
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.oracle import duck, rows
from urbanflow.llm import byte_bpe, chat, decontaminate, jaccard_join, license_scan, line_dedup, media, quality, url_filter
from urbanflow.llm.oracles import ORACLES
from urbanflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOW = {i: i + 32 for i in range(65, 91)}


def docs_of(spark, texts):
    """Extra columns have the names of intermediate ones."""
    return spark.createDataFrame([(i, t, "x", 1.0) for i, t in enumerate(texts)], "doc_id bigint, text string, id string, score double")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck(SF, ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_url_filter_edges(spark):
    pages = spark.createDataFrame([(1, None), (2, "nonsense"), (3, "http://A.Example.ORG/es/x?q"), (4, "http://a.example.org/en/12"), (5, "http://xorg/"), (6, "http://b.com#/de/")], "page_id bigint, url string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.judge(pages, labels, [("org/", "allow"), ("example.org/es/", "block"), ("com/de/", "block")]).collect()}
    assert got == {1: ("", "", None), 2: ("", "", None), 3: ("a.example.org", "/es/x", "example.org/es/"), 4: ("a.example.org", "/en/12", "org/"), 5: ("xorg", "/", None), 6: ("b.com", "", None)}
    assert url_filter.judge(pages.limit(0), labels, []).count() == 0


def test_media_round_trip(spark):
    texts = ["", None, "abc", "é" * 500, "RIFF trap %PDF- \x00"]
    for r in media.sniff(media.store(docs_of(spark, texts))).collect():
        raw = (texts[r.doc_id] or "").encode()
        assert bytes(r.payload) == media.padded(raw) and r.media_type == "audio/wav" and r.n_bytes == len(raw)
        before, after = media.LAYOUTS[zlib.crc32(media.padded(raw)) % len(media.LAYOUTS)]
        parts = [("image/png", media.THUMBNAIL)] * (media.THUMBNAIL in before) + [("audio/wav", media.store_wav(media.padded(raw)))] + [("image/png", media.THUMBNAIL)] * (media.THUMBNAIL in after)
        assert list(zip((m.type for m in r.media), map(bytes, r.carved), strict=True)) == parts


def test_sniffing_confirms_structure():
    import io
    import zipfile

    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("a", "b")
    gif = b"GIF89a" + bytes([1, 0, 1, 0, 0x80, 0, 0]) + bytes(6) + b"\x2c" + bytes(8) + b"\x00\x02\x02\x44\x01\x00\x3b"
    wav = media.store_wav(b"x" * 7)
    blob = b"junk" + wav + b"RIFF\xff\xff\xff\xff" + z.getvalue() + b"\x89PNG\r\n\x1a\nbroken" + gif
    assert [(k, blob[s : s + n]) for k, s, n in media.sniff_bytes(blob)] == [("audio/wav", wav), ("application/zip", z.getvalue()), ("image/gif", gif)]


def test_chat_round_trip():
    marks = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "\\", "<", "[", " ", "a", "\n", "<\\s>"]
    for parts in itertools.product(marks, repeat=3):
        text = "".join(parts)
        for role in ("user", "system", "assistant", "tool", ""):
            assert [(r, t) for r, t, _, _ in chat.parse(chat.render(role, text))] == [(role, text)]
    turns = [("user", "</s><s>x"), ("assistant", ""), ("<s>", "[INST] y [/INST]"), ("assistant", "<")]
    assert [(r, t) for r, t, _, _ in chat.parse("".join(chat.render(*x) for x in turns))] == turns


def test_chat_digests(spark):
    df = spark.createDataFrame([(1, 1, "assistant", "b"), (1, 0, None, None), (None, None, "user", "q"), (2, 0, "assistant", "é</s>")], "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars) for r in chat.digests(chat.format_turns(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {1: (2, sha("\n\nassistant\nb\n"), 1), None: (1, sha("user\nq\n"), 0), 2: (1, sha("assistant\né</s>\n"), 5)}


def test_licenses(spark):
    own = "Intro\nLicensed under the Apache License, Version 2.0.\nmore"
    files = spark.createDataFrame([(1, "a/b/x", own), (2, "a/b/y", None), (3, "a/b/c/z", ""), (4, "a/q", "licensed to nobody in particular at all"), (5, None, "x"), (6, "top", own)], "doc_id bigint, path string, text string")
    got = {r.doc_id: (r.license, r.origin, r.from_dir) for r in license_scan.inherit(files.drop("text"), license_scan.scan(files, license_scan.TEMPLATES)).collect()}
    a = "Apache-2.0"
    assert got == {1: (a, "own", None), 2: (a, "directory", "a/b"), 3: (a, "directory", "a/b"), 4: (None, None, None), 5: (None, None, None), 6: (a, "own", None)}


def test_decontamination_brute_force(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    texts = [None, "", f"x {item} y", item.upper(), item[:-7], "short Item here", "short item", f"{item} {item}", "one two three four five six seven eight nine ten other"]
    bench = spark.createDataFrame([(1, item), (2, "Short, item"), (3, None), (4, ""), (5, item)], "item_id bigint, text string")
    got = {r.doc_id: (r.n_words, list(r.hit_words), list(r.items)) for r in decontaminate.contamination(docs_of(spark, texts), bench).collect()}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in ((1, item), (2, "Short, item"), (5, item)):
        w = word.findall(t.translate(LOW))
        n = min(10, len(w))
        for k in range(len(w) - n + 1):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    for d, t in enumerate(texts):
        w, hit, items = word.findall((t or "").translate(LOW)), set(), set()
        for win, ids in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    items |= ids
        assert got[d] == (len(w), sorted(hit), sorted(items)), d


def test_bpe_equals_tiktoken(spark):
    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [None, "", "it's 你好 😀👍🏽  x\n\n y", "a" * 5000, "ababab" * 300, "  \t\x1c\x85　 z", "İıſK'S 'll <|endoftext|>"]
    for r in byte_bpe.decode(byte_bpe.encode(docs_of(spark, texts), path, P.PATTERN), path).collect():
        t = texts[r.doc_id] or ""
        assert list(r.token_ids) == own.encode_ordinary(t) and bytes(r.decoded) == t.encode()
        covered = [t[a:b] for a, b in zip(r.token_starts, r.token_ends, strict=True)]
        assert all(own.decode_single_token_bytes(i).decode("utf-8", "replace").strip("\ufffd") in c for i, c in zip(r.token_ids, covered, strict=True))
    coded = byte_bpe.encode(docs_of(spark, texts), path, P.PATTERN)
    assert byte_bpe.round_trip(docs_of(spark, texts), path, P.PATTERN).collect() == byte_bpe.decode(coded, path).collect()


def brute_components(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(texts)))
    for _ in texts:
        for i, j in itertools.combinations(range(len(texts)), 2):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                label[i] = label[j] = min(label[i], label[j])
    return [(len(s), c) for s, c in zip(sets, label, strict=True)]


def test_jaccard_join_brute_force(spark, monkeypatch):
    import random

    monkeypatch.setattr(jaccard_join, "BLOCK", 4)  # several blocks even for small clusters
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = [None, "", "a b", "A  b", "a b c d e", " ".join(f"u{i}" for i in range(3000))]
    for _ in range(60):
        w = base[:]
        for _ in range(rng.randrange(4)):
            w[rng.randrange(60)] = f"v{rng.randrange(9)}"
        texts.append(" ".join(w[: rng.randrange(48, 61)]))
    texts += [" ".join(base)] * 5 + [f"common passage of words here {' '.join(f'q{i}_{k}' for i in range(30))}" for k in range(20)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts)
    assert jaccard_join.near_duplicates(docs_of(spark, texts).limit(0)).count() == 0


def test_quality_learns(spark):
    good, bad = "the cat sat on the mat and slept", "BUY!! NOW!! ### $$$ CASINO!!"
    docs = docs_of(spark, [good if i % 2 else bad for i in range(60)] + [None, ""])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(60, None, 0)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert all(got[i].predicted == i % 2 for i in range(60)) and got[60].score == got[61].score
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_line_dedup_edges(spark):
    line = "shared boilerplate"
    data = [(i, f"own {i}\n{line}\n\n", f"s{i}") for i in range(12)] + [(20, None, "s1"), (21, "", "s2"), (22, line, None), (23, f"{line}\n {line} ", "s3")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string").withColumn("pos", F.lit(1))
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    assert got[0].text == f"own 0\n{line}\n\n" and all(got[i].text == f"own {i}\n\n" for i in range(1, 12))
    assert got[20].text is None and got[21].text == "" and not got[21].emptied and got[23].emptied and list(got[23].removed_lines) == [0, 1] and got[22].emptied


def test_line_dedup_keeps_texts_of_shared_ids_apart(spark):
    """Rows without an id, or of one id, lose their own boilerplate only."""
    line = "shared boilerplate"
    data = [(i, f"own {i}\n{line}", f"s{i}") for i in range(12)]
    data += [(i, t, "s1") for i in (None, 50) for t in (f"a\n{line}", f"{i} b\nclean", f"{line}\n{i} c", f"{line}\n{i} c")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    got = [(r.doc_id, r.text) for r in line_dedup.dedup_lines(df).collect() if r.doc_id in (None, 50)]
    # the first occurrence of all stays, in the null id with the lowest position: both rows of equal id and text
    want = [(None, "a"), (None, "None b\nclean"), *[(None, f"{line}\nNone c")] * 2, (50, "a"), (50, "50 b\nclean"), *[(50, "50 c")] * 2]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_pipeline_keeps_texts_of_shared_ids(spark):
    import corpus_pipeline

    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    data = [(None, a), (None, b), (None, b), (None, c), (7, a), (7, c), (7, c), (8, a), (9, d), (9, d + " more"), (None, None), (None, None), (10, None), (10, ""), (11, "")]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    got = [tuple(r) for r in corpus_pipeline.join_near(spark, df, SF).collect()]
    assert got.pop(next(i for i, r in enumerate(got) if r[0] == 9)) in data
    assert sorted(got, key=str) == sorted([(7, a), (7, c), (None, b), (None, None), (10, None), (10, ""), (11, "")], key=str)
