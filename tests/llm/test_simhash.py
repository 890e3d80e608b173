"""SimHash near-duplicates against a brute force over all pairs."""
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientlens.llm import simhash
from clientlens.llm.components import connected_components

SCHEMA = "doc_id long, text string, fingerprint string, component_id string, fp int"


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def brute(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", "y", 1) for d, t in rows], SCHEMA)


def sample(seed=3):
    r = random.Random(seed)
    vocab = [f"W{i}é" if i % 7 == 0 else f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        words = [r.choice(vocab) for _ in range(r.choice([1, 2, 3, 40, 300]))]
        rows.append((len(rows) * 3, " ".join(words)))
        for _ in range(r.choice([0, 0, 1, 3])):
            other = list(words)
            other[r.randrange(len(other))] = r.choice(vocab)
            rows.append((len(rows) * 3, "\n".join(other)))
    return rows + [(5000, None), (4999, ""), (4998, " \t\n"), (None, "lost id"), (None, ""), (0, rows[0][1]), (7, "w1 " * 30000)]


def test_components_match_all_pairs(spark):
    rows = sample()
    got = simhash.simhash_components(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == brute(rows)


def test_empty_table(spark):
    assert simhash.simhash_components(frame(spark, [])).collect() == []


@pytest.mark.parametrize("bucket", [1, 4, 64])
def test_links_of_close_fingerprints_any_bucket_size(spark, monkeypatch, bucket):
    """Clouds of fingerprints around a few centres: chains, cliques, buckets
    far larger than the bound."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    r = np.random.default_rng(bucket)
    fps = set()
    for centre in r.integers(0, 1 << 63, 6):
        for _ in range(80):
            flips = r.choice(64, r.integers(0, 5), replace=False)
            fps.add(int(centre) ^ sum(1 << int(b) for b in flips if b < 63))
    fps = sorted(fps)
    links = simhash.simhash_links(spark.createDataFrame([(x, 0) for x in fps], "fp long, first long"))
    got = {x.node: x.root for x in connected_components(links).collect()}
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin(a ^ b).count("1") <= 2:
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert {x: got.get(x, x) for x in fps} == {x: find(x) for x in fps}


def test_golay_keys_are_shared_within_two_bits():
    r = np.random.default_rng(1)
    words = r.integers(0, 1 << 23, 3000)
    near = words ^ (1 << r.integers(0, 23, 3000)) ^ (1 << r.integers(0, 23, 3000))
    for a, b in zip(simhash.golay_keys(words), simhash.golay_keys(near)):
        assert set(a[a >= 0]) & set(b[b >= 0])


def test_components_of_a_chain_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(5, 5), (100, 101), (101, 100), (-3, 200)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, 101: 100, 200: -3} or got == {
        **{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, -3: -3, 200: -3}


def test_one_document_of_each_group_stays(spark):
    rows = sample()
    kept = simhash.one_per_component(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "fingerprint", "component_id", "fp"]
    want = sorted({d for d, _, c in brute(rows) if d is not None and d == c})
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == want
    assert kept.where(F.col("doc_id").isNull()).count() == 2


def test_unrelated_documents_that_share_an_id_stay(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(60)) for w in ("a", "b", "c"))
    docs = [(7, one, "x"), (7, two, "y"), (8, one, "z"), (7, one, "x"), (9, three, "r"), (None, one, "n"), (3, two + " more", "q")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, row string").withColumn("did", F.col("doc_id"))
    kept = simhash.one_per_component(frame)
    assert kept.columns == frame.columns
    rows = {(r.doc_id, r.text, r.row) for r in kept.collect()}
    near = bin(simhash.fingerprint(two.encode(), 3) ^ simhash.fingerprint((two + " more").encode(), 3)).count("1") <= 2
    assert rows == {(7, one, "x"), (9, three, "r"), (None, one, "n"), (3, two + " more", "q")} | (set() if near else {(7, two, "y")})
    assert kept.count() == len(rows)
