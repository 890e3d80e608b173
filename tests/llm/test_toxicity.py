"""PU learning: held-out accuracy, the risk's correction, edge cases."""
import zlib

import numpy as np
import pytest

from clientlens.llm import queries, toxicity

DOCS = "doc_id long, text string, score string, side int"
LABELS = "doc_id long, toxic int, quality int, features string"


def corpus(n=1500, seed=4):
    """Rows with planted insults in one document of eight, two in five labelled."""
    r = np.random.default_rng(seed)
    vocab = [f"word{i}" for i in range(800)]
    bad = ["grunkle", "snarfing", "snarfo", "blortish"]
    docs, labels, toxic = [], [], {}
    for i in range(n):
        words = list(r.choice(vocab, r.integers(5, 300)))
        toxic[i] = bool(r.random() < 1 / 8)
        if toxic[i]:
            for w in r.choice(bad, 3):
                words.insert(int(r.integers(0, len(words))), str(w))
        docs.append((i, " ".join(words), "s", 1))
        if r.random() < 0.4:
            labels.append((i, int(toxic[i]), 1, "f"))
    return docs, labels, toxic


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels, toxic = corpus()
    extra = [(None, "lost", "", 0), (5000, None, "", 0), (5001, "", "", 0), (5001, "", "", 0), (5002, "word1 " * 200000, "", 0)]
    labels += [(9999, 1, 0, "no such document"), (None, 1, 0, ""), (7, None, 0, "")]
    rows = toxicity.toxicity(spark.createDataFrame(docs + extra, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    return rows, toxic, len(docs) + len(extra)


def test_held_out_accuracy(scored):
    rows, toxic, n = scored
    assert len(rows) == n
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    assert len(held) > 200
    right = [r.predicted == toxic[r.doc_id] for r in held]
    assert np.mean(right) > 0.97
    caught = [r.predicted for r in held if toxic[r.doc_id]]
    assert np.mean(caught) > 0.9


def test_columns_and_edges(scored):
    rows, _, _ = scored
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    empty = {r.score for r in rows if r.doc_id in (5000, 5001)}
    assert len(empty) == 1 and max(empty) < 0.5


def test_no_positives_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "", 0), (2, "c", "", 0)], DOCS)
    rows = toxicity.toxicity(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(rows) == 2 and all(r.predicted == 0 for r in rows)
    assert toxicity.toxicity(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).collect() == []


def test_scores_are_the_models(scored):
    """The task's sums against the model by hand."""
    r = np.random.default_rng(0)
    model = toxicity.train([toxicity.doc_features(b"foo bar baz")] * 30, [toxicity.doc_features(bytes(f"w{i} bar", "ascii")) for i in range(60)], 0.1)
    assert model.word(b"foo") > 0 and model.word(b"w1") == 0
    assert abs(toxicity.threshold(np.array([2.0, 3.0]), np.array([-1.0] * 9 + [2.5]), 0.1) - 0.5) < 1e-9
    assert r is not None


def test_query_on_fixture(spark):
    from clientlens.llm.common import read
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op2_toxicity(spark, sf).collect()}
    labels = {r.doc_id: r.toxic for r in read(spark, sf, "labels").collect()}
    insults = ("idiot", "clown", "moron", "pathetic")
    texts = {r.doc_id: r.text.lower() for r in read(spark, sf, "documents").collect()}
    clear = [d for d, t in labels.items() if t and sum(x in texts[d] for x in insults) >= 2]
    assert np.mean([rows[d].predicted for d in clear]) > 0.9
    clean = [d for d, t in labels.items() if not t]
    assert np.mean([rows[d].predicted for d in clean]) < 0.03


def test_the_driver_gets_no_more_than_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "POSITIVES", 5)
    monkeypatch.setattr(toxicity, "UNLABELLED", 5)
    learn = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5][:3]
    docs = spark.range(5000).selectExpr(f"element_at(array({learn[0]}L, {learn[1]}L, {learn[2]}L), cast(id % 3 + 1 as int)) as doc_id",
                                        "concat('text number ', id) as text", "id as side", "id as tid")
    labels = spark.createDataFrame([(i, 1) for i in learn], "doc_id long, toxic int")
    positive, unlabelled, _ = toxicity.learning_sample(docs, labels, "doc_id", "text")
    assert (len(positive), len(unlabelled)) == (5, 5)
    assert toxicity.toxicity(docs, labels).count() == 5000
