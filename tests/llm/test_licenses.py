"""License scans against a brute force over words."""
import random
import re

from clientlens.llm import licenses

SCHEMA = "doc_id long, text string, labels string, score int"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    hits = [(i, label) for phrase, label in licenses.BASE_PHRASES.items() for i in range(len(words))
            if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in hits]
    return len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def sample():
    r = random.Random(2)
    bits = ["Under the MIT License", "under-the.mit license", "CC BY-NC 4.0", "cc by nc by nc", "Apache License, Version 2.0", "apache license version 20",
            "word", "É", "10", "under the", "mit license", "cc by", "nc", "ünder the mit license", "cc by nc\ncc by nc"]
    rows = [(i, r.choice([" ", "\n", ", "]).join(r.choice(bits) for _ in range(r.randint(0, 40)))) for i in range(200)]
    return rows + [(900, None), (901, ""), (901, ""), (None, "under the mit license"), (902, "x " * 200000 + "cc by nc")]


def test_base_places_match_brute_force(spark):
    rows = sample()
    got = licenses.scan_licenses(spark.createDataFrame([(d, t, "l", 1) for d, t in rows], SCHEMA)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == sorted(
        ((d, *brute(t)) for d, t in rows), key=str)
    for r in got:
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))


def test_expressions():
    def value(text):
        labels, held = licenses.evaluate(licenses.to_postfix(text))
        return sorted(labels), held

    assert value("MIT") == (["mit"], 0.1)
    assert value("MIT OR GPL-3.0-only") == (["gpl-3.0-only", "mit"], 0.1)
    assert value("MIT AND GPL-3.0-only") == (["gpl-3.0-only", "mit"], 0.7)
    assert value("GPL-2.0-only WITH Classpath-exception-2.0") == (["gpl-2.0-only"], 0.35)
    assert value("(MIT OR GPL-3.0-only) AND CC-BY-NC-4.0 */") == (["cc-by-nc", "gpl-3.0-only", "mit"], 0.9)
    assert value("MIT OR GPL-3.0-only AND Apache-2.0") == (["apache-2", "gpl-3.0-only", "mit"], 0.1)
    for bad in ("", "OR MIT", "MIT AND", "(MIT", "()", "AND"):
        assert licenses.to_postfix(bad) is None


def test_tags_and_notices():
    scan = licenses.scan(b"// SPDX-License-Identifier: Apache-2.0 OR MIT\ncode, all rights reserved", licenses.automaton())
    assert scan[5] == "apache-2,mit,proprietary" and scan[7] == 1.0 and scan[4] == ""
    assert licenses.scan(b"SPDX-License-Identifier: (MIT", licenses.automaton())[5:7] == ("", 0.0)


def test_empty_table(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], SCHEMA)).collect() == []
