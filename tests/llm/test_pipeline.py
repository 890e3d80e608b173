"""The corpus pipeline, each stage against a brute force over its own input."""
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from clientlens.llm import mixing, quality
from test_simhash import brute as brute_components
from test_substring import WORD

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs(seed=1):
    r = random.Random(seed)
    vocab = [f"{a}{b}{c}" for a in "bdfgl" for b in "aeiou" for c in ("n", "r", "st", "nd", "mer", "ting")]

    def prose(n):
        out = []
        while len(out) < n:
            s = [r.choice(vocab) for _ in range(r.randint(5, 12))]
            out += [s[0].capitalize(), *s[1:-1], s[-1] + "."]
        return " ".join(out[:n])

    items = [(i, prose(30)) for i in range(4)]
    passage = prose(70)
    rows = []
    for i in range(150):
        kind = i % 10
        text = prose(r.randint(10, 120))
        if kind == 1:
            text = "BUY!! " + " ".join(w.upper() + "!!" for w in text.split())
        elif kind == 2:
            text = " ".join(w + r.choice(["***", "&&&", "$$$", "###"]) for w in text.split())
        elif kind == 3 and rows:
            text = rows[r.randrange(len(rows))][1] or ""
        elif kind == 4:
            text = f"{text} {passage} {prose(20)}"
        elif kind == 5:
            text = f"{text}\n{r.choice(items)[1]} {prose(15)}"
        rows.append((i, text, r.choice(["en", None]), r.choice(["a", "b", None]), len(text)))
    return rows + [(500, "", "en", "a", 0), (501, None, None, None, None), (None, prose(40), "en", "a", 1)], items


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, items = make_docs()
    root = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    frames = [spark.read.parquet(f"{root}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], root).write.parquet(f"{root}/stage{k}")
        frames.append(spark.read.parquet(f"{root}/stage{k}"))
    return [[tuple(r) for r in f.collect()] for f in frames], [f.columns for f in frames], items, root


def key(rows):
    return sorted(rows, key=str)


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "substring dedup", "benchmark decontamination", "mixing sources to target weights"]
    assert all(c == stages[1][0] for c in stages[1][:-1])


def test_quality_stage(stages):
    before, after = stages[0][0], stages[0][1]
    texts = [(r[0], (r[1] or "").encode()) for r in before]
    patterns = np.array([quality.pattern(quality.votes(t)) for _, t in texts])
    seen, counts = np.unique(patterns, return_counts=True)
    model = quality.estimate(seen, counts.astype(float))
    sample = sorted(((d, i.tobytes(), s.tobytes(), quality.pattern(quality.votes(t)))
                     for d, t in texts if d is not None for i, s in [quality.doc_features(t)]))
    scorer = quality.fit([(np.frombuffer(i, np.int32), np.frombuffer(s, float)) for _, i, s, _ in sample],
                         model.posterior(np.array([p for *_, p in sample])))
    want = [r for r, (_, t) in zip(before, texts) if round(scorer.score(t), 9) >= quality.KEEP]
    assert key(after) == key(want)
    assert {r[0] % 10 for r in before if r not in after and r[0] is not None} <= {1, 2, 3}


def test_neardup_stage(stages):
    before, after = stages[0][1], stages[0][2]
    component = {d: c for d, _, c in brute_components([(r[0], r[1]) for r in before])}
    assert key(after) == key([r for r in before if r[0] is None or component[r[0]] == r[0]])


def test_substring_stage(stages):
    before, after = stages[0][2], stages[0][3]
    seen, want = set(), []
    for r in sorted(before, key=lambda r: -(1 << 63) if r[0] is None else r[0]):
        words = WORD.findall(r[1] or "")
        gone = set()
        for i in range(len(words) - 19):
            w = tuple(words[i:i + 20])
            if w in seen:
                gone.update(range(i, i + 20))
            seen.add(w)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        want.append((r[0], kept, *r[2:4], len(kept)) if gone else r)
    assert key(after) == key(want)
    assert any(a != b for a, b in zip(key(before), key(after)))


def test_decontamination_stage(stages):
    before, after, items = stages[0][3], stages[0][4], stages[2]

    def tokens(text):
        named = re.sub(r"([a-z,;][ \t\r\n])([A-Z][a-z]+(?:[ \t\r\n][A-Z][a-z]+)*)", "\\1 \x02 ", text or "")
        return re.findall("[a-z\x02]+", named.lower())

    def windows(text):
        t = tokens(text)
        return [tuple(t[i:i + 5]) for i in range(len(t) - 4)]

    def leaked(text):
        own = set(windows(text))
        return any(sum(w in own for w in windows(i)) >= 0.4 * len(windows(i)) for _, i in items)

    assert key(after) == key([r for r in before if not leaked(r[1])])
    assert len(after) < len(before)


def test_mix_stage_and_run(spark, stages):
    rows, columns, root = stages[0][4], stages[1], stages[3]
    mixed = [dict(zip(columns[5], r)) for r in stages[0][5]]
    total = sum(len((r[1] or "").split()) for r in rows)
    assert {r["doc_id"] for r in mixed} <= {r[0] for r in rows}
    assert all(1 <= r["copies"] <= 2 and r["taken"] == r["copies"] * len((r["text"] or "").split()) for r in mixed)
    assert abs(sum(r["taken"] for r in mixed) - mixing.SHARE * total) <= 3 * 120
    got = corpus_pipeline.run(spark, root)
    assert got.columns == columns[5] and key(map(tuple, got.collect())) == key(stages[0][5])


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
