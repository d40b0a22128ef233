"""Alignment of two tokenizers against a plain double loop over whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from urbanflow.llm import alignment, queries
from urbanflow.llm.byte_bpe import byte_table

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SIGNS = ["a", "b", " ", "  ", "\n", "é", "漢", "字", "😀", "é", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "▁", "\t", "'s", "ing", "1", "23", " ", "​", "\x1c", "\x00", "ﬁ", "...", "-" * 40, "ا"]


@pytest.fixture(scope="module")
def brute():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    byte = {c: i for i, c in enumerate(byte_table())}

    def pieces(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids[0]], [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
        return (ids, raw) if text and all(b"".join(r) == b" " + text.encode() for r in raw) else (([], []), ([], []))

    def measures(texts):
        """For all documents: n_a, n_b, n_groups, n_links, n_best, count_sum, digest."""
        own, counts = [], Counter()
        for text in texts:
            (x, y), raw = pieces(text or "")
            ends = [np.cumsum([len(r) for r in side]).tolist() for side in raw]
            links, groups, low = [], [], 0
            for end in sorted(set(ends[0]) & set(ends[1])):
                p, q = ([i for i, e in zip(ids, at, strict=True) if low < e <= end] for ids, at in zip((x, y), ends, strict=True))
                low = end
                groups.append(",".join(map(str, p)) + "|" + ",".join(map(str, q)))
                links += [(i, j) for i in p for j in q]
            own.append((len(x), len(y), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if x else ""))
            counts.update(set(links))
        most = Counter()
        for (i, _), n in counts.items():
            most[i] = max(most[i], n)
        return [(a, b, g, len(k), sum(counts[p] == most[p[0]] for p in k), sum(counts[p] for p in k), d) for a, b, g, k, d in own]

    return measures


def texts_of(seed, n=150):
    rng = random.Random(seed)
    out = [None, "", " ", "word", "<|endoftext|> is text", "a  b", "ﬁ ligature", "x" * 300, "no▁piece"]
    out += ["".join(rng.choices(SIGNS, k=rng.randint(1, 30))) for _ in range(n)]
    return out + out[: n // 2] + ["many copies of one"] * 40


@pytest.mark.parametrize("hot", [alignment.HOT, 20])
def test_measures_equal_brute_force(spark, brute, hot):
    """With all pairs broadcast, and with the frequent ones only."""
    texts = texts_of(1)
    docs = spark.createDataFrame([(i, t, 7, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, n_a int, text_h1 string, code int").repartition(3)
    got = alignment.align_corpus(docs, *PATHS, hot=hot).toPandas().sort_values("doc_id")
    assert list(got.columns) == ["doc_id", "text", "text_h1", "code", *alignment.NEW]
    assert [tuple(r) for r in got[list(alignment.NEW)].itertuples(index=False)] == brute(texts)
    assert set(got.text_h1) == {"x"} and set(got.code) == {1}


def test_cuts_and_crowded_groups_change_nothing(brute, monkeypatch):
    texts = [t for t in texts_of(2, 400) if t is not None]
    want = [r[:4] + r[6:] for r in brute(texts)]
    for long, crowded, cuts in ((200_000, 1024, True), (1, 2, True), (25, 4, True), (200_000, 1, False)):
        monkeypatch.setattr(alignment, "LONG", long)
        monkeypatch.setattr(alignment, "CROWDED", crowded)
        own = alignment.Aligner(*PATHS)
        assert own.cuts
        own.cuts = cuts
        for _ in range(2):  # with no part known, with all known
            measures, digests, stops, codes, times = own(texts)
            assert [(*m, d) for m, d in zip(measures.tolist(), digests, strict=True)] == want
            assert np.diff(stops, prepend=0).sum() == len(codes) and times.sum() == measures[:, 3].sum()


def test_a_very_long_text(brute):
    text = "A sentence of some words, " * 20_000 + "漢字" * 5000
    measures, digests, *_ = alignment.Aligner(*PATHS)([text, "", "end"])
    assert measures[0][0] > 100_000 and measures[1].tolist() == [0, 0, 0, 0] and digests[1] == ""
    assert (*measures[2].tolist(), digests[2]) == tuple(np.array(brute(["end"]), object)[0][[0, 1, 2, 3, 6]])


def test_no_rows_and_only_null_texts(spark):
    for rows in ([], [(1, None), (1, None), (None, "")]):
        got = alignment.align_corpus(spark.createDataFrame(rows, "doc_id bigint, text string"), *PATHS).collect()
        assert len(got) == len(rows) and all((r.n_a, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == (0, 0, 0, 0, "") for r in got)


def test_query_on_whole_documents(spark, brute):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").toPandas().sort_values("doc_id")
    got = queries.op11_alignment(spark, sf).toPandas().sort_values("doc_id")
    assert [tuple(r) for r in got[list(alignment.NEW)].itertuples(index=False)] == brute(list(docs["text"]))
