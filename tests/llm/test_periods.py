"""Periodic runs against brute force."""
import hashlib
import random
from zlib import crc32

import numpy as np

from clientlens.llm import periods, queries


def brute_lyndon(t):
    n = len(t)
    return [next((j for j in range(i + 1, n) if t[j:] < t[i:]), n) - i for i in range(n)]


def brute_runs(w, shortest=24, repeats=3):
    n, out = len(w), set()
    for p in range(1, n // repeats + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(shortest, repeats * p):
                seg = w[i:j + p]
                if not any(seg[q:] == seg[:-q] for q in range(1, p)):
                    out.add((i, j + p - i, p))
            i = max(j, i) + 1
    return sorted(out)


def looped(did, text):
    words = (text or "").encode().split()
    h = crc32(str("" if did is None else did).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def brute_row(did, text):
    words = looped(did, text)
    runs = brute_runs(words)
    drop = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1] * 10**9 // r[2], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    return (did, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_lyndon_arrays_and_runs():
    r = random.Random(1)
    for _ in range(1500):
        letters = r.choice([1, 2, 3])
        t = [r.randrange(letters) for _ in range(r.randint(1, 40))]
        assert periods.lyndon_array(t) == brute_lyndon(t)
        for shortest, repeats in ((2, 2), (4, 3), (1, 3)):
            assert periods.runs_of(np.array(t), shortest, repeats) == brute_runs(t, shortest, repeats)


def query(spark, docs, tmp_dir):
    spark.createDataFrame([(d, t, "r", 1) for d, t in docs], "doc_id long, text string, runs string, row long").write.parquet(f"{tmp_dir}/documents.parquet")
    return sorted(map(tuple, queries.op13_periodic_runs(spark, tmp_dir).collect()), key=str)


def test_query_against_brute_force(spark, tmp_dir):
    r = random.Random(3)
    words = [f"w{i}" for i in range(40)]

    def text():
        out = []
        while len(out) < r.choice([0, 20, 60, 200]):
            out += [r.choice(words) for _ in range(r.randint(0, 15))] + [r.choice(words) for _ in range(r.randint(1, 9))] * r.randint(1, 9) + out[-30:] * r.randint(0, 2)
        return r.choice([" ", "\n", " \t "]).join(out)

    docs = [(d, text()) for d in range(300)]
    docs += [(1001, None), (1002, ""), (None, "a b " * 20), (7, "a b " * 20), (7, "a b " * 20), (7, "other"), (1003, "x " * 3000 + "y " * 23 + "z " * 24),
             (1004, "\x1c \x85 \xa0 " * 9)]
    assert query(spark, docs, tmp_dir) == sorted((brute_row(d, t) for d, t in docs), key=str)


def test_no_rows(spark, tmp_dir):
    assert query(spark, [], tmp_dir) == []


def test_fixture(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r) for r in queries.op13_periodic_runs(spark, sf).collect()}
    rows = [r for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert len(got) == len(rows)
    short = [r for r in rows if len(r.text or "") < 6000]
    assert [got[r.doc_id] for r in short] == [brute_row(*r) for r in short]


def test_very_long_text(spark, tmp_dir):
    rows = query(spark, [(1, "a b c " * 100_000)], tmp_dir)
    assert rows[0][1:6] == (1, 0, 300_000, 3, 100_000_000)
