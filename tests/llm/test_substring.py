"""Repeated windows against a brute force over all windows."""
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from clientlens.llm import substring

SCHEMA = "doc_id long, text string, key string, marks int, n_words string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window=20):
    docs = {}
    for d, t in rows:
        docs.setdefault((-(1 << 63) if d is None else d, t), WORD.findall(t or ""))
    order = sorted(docs, key=lambda k: k[0])
    seen, out = set(), {}
    for k in order:
        words = docs[k]
        gone = set()
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[k] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return sorted(((d, *out[(-(1 << 63) if d is None else d, t)]) for d, t in rows), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "k", 2, "n") for d, t in rows], SCHEMA)


def result(spark, rows):
    got = substring.remove_repeats(frame(spark, rows)).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("sha"))
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.sha) for r in got.collect()), key=str)


def sample(seed=5, n=150):
    r = random.Random(seed)
    vocab = ["a", "b", "the", "É", "x\xa0y", "w w", *(f"v{i}" for i in range(300))]
    passages = [[r.choice(vocab) for _ in range(r.randint(15, 90))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(r.randint(0, 5)):
            if r.random() < 0.5:
                p = r.choice(passages)
                a = r.randint(0, 10)
                words += p[a:len(p) - r.randint(0, 10)]
            words += [r.choice(vocab) for _ in range(r.randint(0, 60))]
        rows.append((1000 - i, r.choice([" ", "\n", "  "]).join(words)))
    rows += [(2000, " ".join(["same"] * 500)), (2001, " ".join(["a", "b", "c"] * 200)), (2002, " ".join(["same"] * 19)),
             (2003, None), (2004, ""), (2005, " \n"), (None, rows[0][1]), (2006, rows[3][1]), (2007, rows[3][1])]
    return rows


def test_windows_match_brute_force(spark):
    rows = sample()
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("group", [2, 7])
def test_cut_prefixes_give_the_same(spark, monkeypatch, group):
    """Prefixes with more places than a group holds go through the longer prefix."""
    monkeypatch.setattr(substring, "GROUP", group)
    rows = sample(seed=group, n=80)
    assert result(spark, rows) == brute(rows)


def test_crowded_prefixes_grow_before_they_are_dealt(spark, monkeypatch):
    """One phrase of 40 words in every document: its prefixes are cut into
    parts of the wanted number; a crowded phrase of eight words before
    different words is not, since longer prefixes tell its places apart."""
    monkeypatch.setattr(substring, "GROUP", 10)
    shared, phrase = [f"s{i}" for i in range(40)], [f"p{i}" for i in range(8)]
    rows = [(i, " ".join([*(f"a{i}_{j}" for j in range(30)), *shared, *(f"b{i}_{j}" for j in range(30)), *phrase,
                          *(f"c{i}_{j}" for j in range(30))])) for i in range(45)]
    assert result(spark, rows) == brute(rows)
    parts: dict[int, set[int]] = {}
    texts = frame(spark, rows).select(F.struct("*").alias("row")).withColumn("did", F.col("row.doc_id")).withColumn("tid", F.lit(0).cast("long"))
    short = texts.select("did", "tid", "row").mapInArrow(lambda it: substring._anchor_rows(it, 20, "text"),
                                                        "key long, did long, tid long, place long, more binary")
    sized = substring._with_size(short, F.lit(1)).where("size > 10")
    lists = sized.groupBy("did", "tid").agg(F.collect_list(F.struct("key", F.lit(-1).cast("long").alias("grp"), "place", "more")).alias("anchors"))
    longer = (texts.join(lists, ["did", "tid"]).select("did", "tid", "row", "anchors")
              .mapInArrow(lambda it: substring._longer_prefixes(it, 20, "text"), "key long, did long, tid long, place long"))
    for r in longer.collect():
        pos, far, near = (int(x) for x in substring._unpack(r.place))
        assert 0 <= near <= far <= 12 and (far <= 6 or near >= 7)
        parts.setdefault(r.key, set()).add(r.did)
    sizes = {len(v) for v in parts.values()}
    assert 45 in sizes and sizes <= {1, 45}


def test_a_hot_prefix_is_split(spark):
    """A prefix that most rows have is read by several tasks once it is large
    (here: 64 KB), and every row keeps its count."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    places = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") % 10 < 7, -5).otherwise(F.col("id") % 9000).alias("key"),
                                                F.col("id").alias("did"), F.xxhash64("id").alias("tid"), F.col("id").alias("place"))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sized = substring._with_size(places, F.lit(1))
        got = {r.key: (r["size"], r.n) for r in sized.groupBy("key", "size").agg(F.count("*").alias("n")).collect()}
        frame_ = sized.groupBy("did").agg(F.max("size").alias("size"))
        frame_.collect()
        assert "skew=true" in frame_._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = {r.key: (r.n, r.n) for r in places.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").collect()}
    assert got == want


def test_groups_over_several_batches(spark, monkeypatch):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = sample(seed=11, n=80)
        assert result(spark, rows) == brute(rows)
        monkeypatch.setattr(substring, "GROUP", 5)
        assert result(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_repeated_rows_are_one_document(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, text), (2, "other " + text)]
    got = result(spark, rows)
    assert [r for r in got if r[0] == 1] == [(1, 40, 0, hashlib.sha256(text.encode()).hexdigest())] * 2
    assert sorted(r[2] for r in got if r[0] == 2) == [40, 40]


def test_very_long_text_and_empty_table(spark):
    r = random.Random(1)
    words = [f"u{r.randrange(10 ** 6)}" for _ in range(60000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[20000:20050] + ["end"]))]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []


def test_documents_without_their_repeats(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text, "en", 5), (2, "new\n" + text, None, 6), (3, "a\nb", "de", 3), (4, None, "x", None)],
                                 "doc_id long, text string, lang string, n_chars long")
    out = substring.without_repeats(docs)
    assert out.schema == docs.schema
    assert sorted(map(tuple, out.collect())) == [(1, text, "en", 5), (2, "new", None, 3), (3, "a\nb", "de", 3), (4, None, "x", None)]
