"""Mixing: targets by brute force, rounding invariants, reruns."""
import random
from collections import defaultdict

import pytest

from clientlens.llm import mixing

SCHEMA = "id long, source string, size long"


def brute_targets(rows):
    own = defaultdict(int)
    for _, s, n in rows:
        own[s] += n
    order = sorted((s for s in own if s is not None)) + ([None] if None in own else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    goal = 1.5 * sum(own.values())
    target, full = {}, set()
    while True:
        free = [s for s in order if s not in full]
        left = goal - sum(2 * own[s] for s in full)
        target = {s: 2.0 * own[s] if s in full else left * weight[s] / sum(weight[x] for x in free) for s in order}
        over = {s for s in free if target[s] > 2 * own[s]}
        if not over:
            return own, target
        full |= over


def sample(n=3000, seed=1):
    r = random.Random(seed)
    names = ["b", "a", "B", "é", "zz", "", None, "src10", "src9"]
    weights = [30, 5, 5, 5, 5, 1, 5, 2, 40]
    return [(i, r.choices(names, weights)[0], r.choice([0, 1, 5, 50, 200, 900])) for i in range(n)]


@pytest.mark.parametrize("leaf,fan", [(20_000, 64), (50, 3)])
def test_targets_and_taken(spark, monkeypatch, leaf, fan):
    monkeypatch.setattr(mixing, "LEAF", leaf)
    monkeypatch.setattr(mixing, "FAN", fan)
    rows = sample()
    own, target = brute_targets(rows)
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.id, r.source, r.size) for r in got), key=str) == sorted(rows, key=str)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == own[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        rate = r.target / r.source_size if r.size else 0
        assert r.copies in (int(rate), int(rate) + 1) and r.copies <= 2
        taken[r.source] += r.copies * r.size
    for s in target:
        assert abs(taken[s] - target[s]) <= 900 / 2 + 1e-6


def test_reruns_and_partitions_agree(spark):
    rows = sample(800, 5)
    runs = [{(r.id, r.source): r.copies for r in mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(k)).collect()} for k in (1, 7)]
    assert runs[0] == runs[1]


def test_pivot_keeps_words_and_settles_one():
    r = random.Random(0)
    for _ in range(2000):
        p, q, s, t = r.uniform(0.01, 0.99), r.uniform(0.01, 0.99), r.randint(1, 900), r.randint(1, 900)
        a, b = mixing.pivot(p, s, q, t, r.random())
        assert abs(a * s + b * t - p * s - q * t) < 1e-6 and -1e-9 <= min(a, b) and max(a, b) <= 1 + 1e-9
        assert a in (0.0, 1.0) or b in (0.0, 1.0)


def test_probabilities_hold_on_average():
    r = random.Random(3)
    p, s, q, t = 0.3, 10, 0.6, 70
    mean = [sum(x) / 40000 for x in zip(*(mixing.pivot(p, s, q, t, r.random()) for _ in range(40000)))]
    assert abs(mean[0] - p) < 0.01 and abs(mean[1] - q) < 0.01


def test_edges(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, None, 5), (None, None, 5), (1, "a", 0), (1, "a", 0), (2, "a", None)]
    got = mixing.mix(spark.createDataFrame([(a, b, c or 0) for a, b, c in rows], SCHEMA)).collect()
    assert len(got) == 5 and sum(r.copies * r.size for r in got) in (15, 20, 10)
    zero = mixing.mix(spark.createDataFrame([(1, "a", 0)], SCHEMA)).collect()
    assert [(r.target, r.copies) for r in zero] == [(0.0, 0)]


def test_documents_of_the_mix(spark):
    docs = spark.createDataFrame([(i, " ".join(["w"] * (i % 9)), f"s{i % 4}", "en", 1) for i in range(200)] + [(500, None, None, None, 2)],
                                 "doc_id long, text string, source string, lang string, copies int")
    out = mixing.mixed_documents(docs).collect()
    assert out and all(r.copies >= 1 and r.size == len(r.text.split()) and r.taken == r.copies * r.size for r in out)
    sizes = sum(i % 9 for i in range(200))
    assert abs(sum(r.taken for r in out) - 1.5 * sizes) <= 4 * 8
