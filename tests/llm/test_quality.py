"""Quality: EM recovers accuracies, held-out accuracy against true labels."""
import numpy as np

from clientlens.llm import quality, queries
from clientlens.llm.common import read

SCHEMA = "doc_id long, text string, votes string, row int"


def test_em_recovers_labeller_rates():
    r = np.random.default_rng(1)
    n, share = 40000, 0.8
    good = r.random(n) < share
    truth = np.array([[0.3, 0.01], [0.2, 0.02], [0.25, 0.005], [0.3, 0.01], [0.15, 0.01], [0.8, 0.05], [0.6, 0.03], [0.7, 0.02]])
    votes = np.where(r.random((n, 8)) < truth[:, good.astype(int)].T, quality.BAD, quality.GOOD)
    votes[r.random((n, 8)) < 0.1] = quality.NONE
    packed = np.array([quality.pattern(tuple(v)) for v in votes])
    seen, counts = np.unique(packed, return_counts=True)
    model = quality.estimate(seen, counts.astype(float))
    assert abs(model.good - share) < 0.02
    assert np.abs(model.rates - truth).max() < 0.04
    assert np.mean((model.posterior(packed) >= 0.5) == good) > 0.97


def test_patterns_round_trip():
    r = np.random.default_rng(2)
    for _ in range(50):
        v = tuple(int(x) for x in r.integers(0, 3, len(quality.LABELLERS)))
        assert tuple(quality.unpacked(np.array([quality.pattern(v)]))[0]) == v


def test_true_labels_of_the_fixture(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op3_quality(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in read(spark, sf, "labels").collect()}
    assert len(rows) == 1000
    assert np.mean([rows[d].keep for d, q in labels.items() if q == 1]) > 0.99
    assert np.mean([rows[d].keep for d, q in labels.items() if q == 0]) < 0.1


def test_edges(spark):
    prose = "The quick brown fox jumps over the lazy dog near the river bank today."
    rows = [(i, prose, "v", 1) for i in range(40)] + [(i, "BUY!! NOW!! CHEAP!! PILLS!! " * 10, "v", 1) for i in range(40, 50)]
    rows += [(60, None, "v", 1), (61, "", "v", 1), (None, prose, "v", 1), (60, None, "v", 1), (62, "x " * 200000, "v", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = quality.classify(docs).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.keep == (r.score >= 0.5) for r in out)
    assert all(r.keep for r in out if r.row.text == prose)
    assert not any(r.keep for r in out if r.row.doc_id in range(40, 50))
    assert quality.good_documents(docs).schema == docs.schema
    assert quality.classify(docs.limit(0)).collect() == []


def test_vocabulary_of_long_texts():
    r = np.random.default_rng(4)
    vocabulary = quality.LABELLERS.index("vocabulary")
    for n in (3000, 3001, 9000, 100_000):
        loop = " ".join(f"word{i % 40}" for i in range(n))
        prose = " ".join(f"word{i}" for i in r.integers(0, 5000, n))
        assert quality.votes(loop.encode())[vocabulary] == quality.BAD
        assert quality.votes(prose.encode())[vocabulary] == quality.GOOD


def test_the_driver_gets_no_more_than_the_sample(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE", 10)
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, target, f=quality.fit: seen.append(len(rows)) or f(rows, target))
    docs = spark.range(5000).selectExpr("id % 3 as doc_id", "concat('some text of the number ', id) as text", "id as tid", "id as pattern")
    assert quality.classify(docs).count() == 5000
    assert seen == [10]


def test_a_short_loop_is_judged_like_a_long_one():
    for times in (14, 15, 3000):
        assert quality.votes(b"buy now " * times)[-1] == quality.BAD
