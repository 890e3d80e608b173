"""MinHash fingerprints: the neighbour chain by brute force, likeness against
the true Jaccard."""
import hashlib
import random

import numpy as np
import pytest

from clientlens.llm import minhash

SCHEMA = "doc_id long, text string, at int, ghost boolean, o long"


def brute(rows):
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), r[1] is not None, r[1] or ""))
    out = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        n = len(t)
        edited = t[:n - n // 2] + nxt[:n // 2]
        own, changed, other = (minhash.fingerprint(x.encode()) for x in (t, edited, nxt))
        out.append((d, n, hashlib.sha256(edited.encode()).hexdigest(), own.hex(), changed.hex(), minhash.likeness(own, changed), minhash.likeness(own, other)))
    return sorted(out, key=str)


def sample(n=120, seed=2):
    r = random.Random(seed)
    vocab = ["Das", "é", "😀x", *(f"w{i}" for i in range(200))]
    rows = [(r.randrange(10 ** 9) if i % 2 else i, " ".join(r.choice(vocab) for _ in range(r.choice([0, 1, 3, 30, 200])))) for i in range(n)]
    return rows + [(None, "lost"), (None, None), (3, ""), (7, "dup"), (7, "dup"), (7, "eup"), (1 << 62, "top"), (-5, "w1 " * 50000)]


@pytest.mark.parametrize("partitions", ["1", "8", "50"])
def test_neighbours_match_brute_force(spark, partitions):
    rows = sample()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = minhash.neighbour_fingerprints(spark.createDataFrame([(d, t, 1, True, 2) for d, t in rows], SCHEMA)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_one_and_no_document(spark):
    got = minhash.neighbour_fingerprints(spark.createDataFrame([(1, "abcd", 1, True, 2)], SCHEMA)).collect()
    assert [(r.edited_sha256, r.near_next) for r in got] == [(hashlib.sha256(b"abab").hexdigest(), 1.0)]
    assert minhash.neighbour_fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []


def test_likeness_estimates_jaccard():
    r = random.Random(5)
    errors = []
    for _ in range(60):
        words = [f"v{r.randrange(10 ** 6)}" for _ in range(400)]
        cut = r.randint(0, 400)
        other = words[:cut] + [f"u{r.randrange(10 ** 6)}" for _ in range(400 - cut)]
        a, b = ({tuple(x[i:i + 5]) for i in range(396)} for x in (words, other))
        errors.append(minhash.likeness(*(minhash.fingerprint(" ".join(x).encode()) for x in (words, other))) - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_near_duplicates_match_all_pairs(spark):
    r = random.Random(7)
    rows = []
    for i in range(40):
        words = [f"v{r.randrange(5000)}" for _ in range(r.choice([3, 60, 200]))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(r.choice([0, 1, 4])):
            other = list(words)
            for _ in range(r.choice([0, 1, 2])):
                other[r.randrange(len(other))] = "edit"
            rows.append((len(rows), "\n".join(other).upper()))
    rows += [(900, None), (901, ""), (902, "x " * 50000), (None, "lost"), (903, rows[0][1]), (903, rows[0][1])]
    links, classes = minhash.near_duplicates(spark.createDataFrame([(d, t, 1, True, 2) for d, t in rows], SCHEMA))
    first, sets = {}, {}
    for d, t in rows:
        if d is not None:
            shingles = tuple(minhash.shingle_hashes((t or "").encode()).tolist())
            first[shingles] = min(d, first.get(shingles, d))
            sets[d] = shingles
    want = {(a, b): len(set(x) & set(y)) / len(set(x) | set(y)) for x, a in first.items() for y, b in first.items() if a < b and set(x) | set(y)}
    want = {k: v for k, v in want.items() if v >= 0.8}
    assert {(x.a, x.b): round(x.jaccard, 9) for x in links.collect()} == {k: round(v, 9) for k, v in want.items()}
    root = {a: a for a in first.values()}
    for _ in root:
        for a, b in want:
            root[a] = root[b] = min(root[a], root[b])
    got = classes.collect()
    assert len(got) == sum(d is not None for d, _ in rows)
    for x in got:
        one = first[sets[x.doc_id]]
        assert (x.first_id, x.class_id, x.n_links) == (one, root[one], sum(one in k for k in want))
