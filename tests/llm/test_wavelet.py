"""Token shards: exact round trips, ranks and selects against plain lists."""
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from clientlens.llm import queries, wavelet
from clientlens.session import scratch_path

JSON = queries.public_tokenizer("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_str(JSON)


def whole(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_are_those_of_the_whole_text():
    r = random.Random(2)
    letters = [chr(c) for c in range(1, 0x250)] + [
        "́", "̀", "'s", "'t", "'LL", "<|endoftext|>", "<|ENDoftext|>", "<|startoftext|>", " ", "\n", "\x85", "\xa0", " ",
        "Σ", "ς", "İ", "中", "\U0001F600", "\x1c", "\x0b", "\x0c", "‍", ",", ".", "!?", "a", "É", "ß"] * 8
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 30))) for _ in range(20_000)]
    texts += [None, "", "A" * 5000, "Wörter, Ärzte; École. don't <|endoftext|>.", "A<|ENDOFTEXT|>b"]
    encoder = wavelet.Encoder(JSON, 1)
    for k in range(0, len(texts), 50):
        ids, counts = encoder.encode(pa.array(texts[k:k + 50], pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [whole(t) for t in texts[k:k + 50]]


@pytest.mark.parametrize("block", [64, 1 << 17])
def test_rank_select_access(monkeypatch, block):
    monkeypatch.setattr(wavelet, "BLOCK", block)
    r = random.Random(3)
    for _ in range(80):
        n = r.randint(0, 500)
        ids = np.array([r.randrange(r.choice([1, 2, 9, 50_000, 70_000])) for _ in range(n)], np.uint32)
        wm = wavelet.WaveletMatrix(wavelet.shard_bytes(ids, [None], [n]) + b"\n")
        assert wm.ids().tolist() == ids.tolist()
        assert [wm.access(i) for i in range(0, n, 7)] == ids[::7].tolist()
        for t in {*ids.tolist()[:5], 3, 1 << 20, -1}:
            assert wm.occurrences(t) == np.flatnonzero(ids == t).tolist()
            i = r.randint(0, n)
            assert wm.rank(t, i) == int((ids[:i] == t).sum())
    with pytest.raises(IndexError):
        wm.select(1 << 19, 0)
    with pytest.raises(ValueError):
        wavelet.WaveletMatrix(b"none of it....")


def written(spark, docs, size=wavelet.SHARD):
    path = scratch_path(spark, "shards")
    frame = spark.createDataFrame([(t, d, "c", 1) for d, t in docs], "text string, doc_id long, content string, n long")
    wavelet.write_shards(frame, path, JSON, 1, size=size)
    return path


def test_shards_hold_all_documents_in_order(spark):
    r = random.Random(5)
    docs = [(d, " ".join(r.choice(["Haus", "maison,", "42", "it's"]) for _ in range(r.randint(0, 40)))) for d in range(300)]
    docs += [(None, "no id"), (None, None), (7, "again"), (7, "again"), (-5, ""), (400, "long " * 20_000)] + [(11, "hot")] * 500
    r.shuffle(docs)
    path = written(spark, docs, 64)
    rows = wavelet.read_documents(spark, path).orderBy("start").collect()
    assert sorted(((x.doc_id, x.n_tokens, x.ids_crc32) for x in rows), key=str) == sorted(
        ((d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ((d, whole(t)) for d, t in docs)), key=str)
    assert [x.doc_id for x in rows] == [d for d, _ in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0))]
    assert [x.start for x in rows] == np.cumsum([0] + [x.n_tokens for x in rows])[:-1].tolist()
    token = whole("Haus")[0]
    found = wavelet.find_tokens(spark, path, [token, 49_000], places=True).collect()
    assert sum(x.n for x in found) == sum(whole(t).count(token) for _, t in docs) and {x.token for x in found} == {token}
    assert all(len(x.places) == x.n for x in found) and len(found) > 3
    assert wavelet.find_tokens(spark, path, [token]).columns == ["token", "part", "shard", "n"]


def test_no_rows(spark):
    assert wavelet.read_documents(spark, written(spark, [])).collect() == []


def test_query_on_the_fixture(spark):
    sf = "/root/testdata/sf0.001"
    want, start = [], 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = whole(r.text)
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.op12_token_shards(spark, sf).collect())) == want
