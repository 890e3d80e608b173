"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document.
Expectation-maximisation over the counts of vote patterns of the whole corpus
estimates, without any true label, how often each labeller votes what on good
and on bad documents. The posterior of a document's votes is the soft label
that a linear scorer over hashed word shapes is trained on; the scorer decides.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.llm.common import cut, pieces

BITS = 14
#: Documents, picked by a hash of their id, whose posteriors train the scorer.
SAMPLE = 6_000
ROUNDS = 200
STEPS = 400
RATE = 0.1
DECAY = 1e-4
#: Score from which a document is kept.
KEEP = 0.5
LABELLERS = ("symbols", "capitals", "separators", "repeats", "shouting", "plain_words", "casing", "vocabulary")
BAD, NONE, GOOD = 0, 1, 2
#: Start of the estimation, by labeller: share of bad votes among its votes on
#: bad and on good documents. The first five are detectors of one kind of junk
#: each, the others judge a text as a whole and overlap with them.
START = ((0.25, 0.01),) * 5 + ((0.70, 0.03),) * 3
PRIOR_GOOD = 0.8
#: Weight of START in documents, so rare votes keep a sensible meaning.
PSEUDO = 20.0
#: Fewer words are too few for most labellers.
ENOUGH = 6
#: Words of a block in which distinct ones are counted.
BLOCK = 3000

_SHAPES = bytes(88 if 65 <= b <= 90 else 120 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))
_PLAIN = re.compile(rb"[\"'(+]*(X?x|X|Xx[Xx-]*|x-x|0[0.,:/()-]*)[.,;:?!\"')]?")
_SMALL = re.compile(rb"[^A-Za-z]*X?x[^X]*")


def shapes(text: bytes) -> list[bytes]:
    """Word shapes: runs of capitals, other letters and digits become X, x
    and 0; further characters stay."""
    out = text.translate(_SHAPES)
    for run in (b"xx", b"XX", b"00"):
        while run in out:
            out = out.replace(run, run[:1])
    return out.split()


def profile(text: bytes) -> tuple[int, int, Counter]:
    """(words, words that equal the one before, shapes with their counts)."""
    words = text.split()
    return len(words), sum(map(eq, words, islice(words, 1, None))), Counter(shapes(text))


def votes(text: bytes, known: tuple[int, int, Counter] | None = None) -> tuple[int, ...]:
    """One vote of each labeller. Distinct words are counted over all of the
    text, block by block, so that the share of a long text means the same."""
    n, again, forms = known or profile(text)
    if not n:
        return (NONE,) * len(LABELLERS)
    marks = sum(text.count(c) for c in (b"*", b"&", b"$", b"%", b"#", b"@", b"~", b"^", b"=", b"<", b">"))
    big = sum(k * c for x, c in forms.items() if (k := x.count(b"X")) and b"x" not in x)
    bars = text.count(b"|") + text.count("•".encode()) + text.count("»".encode())
    plain = sum(c for x, c in forms.items() if _PLAIN.fullmatch(x))
    small = sum(c for x, c in forms.items() if _SMALL.fullmatch(x))
    words = text.split()
    distinct = sum(len(set(words[i:i + BLOCK])) for i in range(0, n, BLOCK))

    def vote(bad: bool, good: bool, enough: bool = n >= ENOUGH) -> int:
        return NONE if not enough else BAD if bad else GOOD if good else NONE

    return (
        vote(marks > 0.3 * n, marks <= 0.3 * n),
        vote(big > 0.6 * n, big <= 0.6 * n),
        vote(bars > 0.2 * n, bars <= 0.2 * n),
        vote(again > 0.25 * n, again <= 0.25 * n),
        vote(text.count(b"!") > 0.3 * n, text.count(b"!") <= 0.3 * n),
        vote(plain < 0.6 * n, plain > 0.9 * n),
        vote(small < 0.5 * n, small > 0.9 * n),
        vote(distinct < 0.2 * n or again > 0.4 * n, distinct > 0.3 * n and again < 0.05 * n),
    )


def pattern(votes_: tuple[int, ...]) -> int:
    out = 0
    for v in votes_:
        out = 3 * out + v
    return out


def unpacked(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(LABELLERS) - 1, -1, -1) % 3


@dataclass(frozen=True)
class LabelModel:
    good: float  # share of good documents
    rates: np.ndarray  # [labeller, class bad/good]: share of bad votes among its votes

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that documents of these vote patterns are good; a
        labeller that does not vote says nothing."""
        v = unpacked(np.asarray(patterns, np.int64))
        bad, good = np.log(self.rates[:, 0] / self.rates[:, 1]), np.log((1 - self.rates[:, 0]) / (1 - self.rates[:, 1]))
        gap = np.where(v == BAD, bad, np.where(v == GOOD, good, 0.0)).sum(axis=1) + np.log((1 - self.good) / self.good)
        return 1 / (1 + np.exp(np.clip(gap, -60, 60)))


def estimate(patterns: np.ndarray, counts: np.ndarray) -> LabelModel:
    """Expectation-maximisation over (pattern, documents) counts, 3 to the
    power of the labellers at most."""
    start = np.array(START)
    model = LabelModel(PRIOR_GOOD, start)
    v = unpacked(patterns)
    for _ in range(ROUNDS):
        p = model.posterior(patterns)
        rates = np.empty_like(start)
        for c, weight in enumerate((counts * (1 - p), counts * p)):
            bad = weight @ (v == BAD) + PSEUDO * start[:, c]
            rates[:, c] = bad / (weight @ (v != NONE) + PSEUDO)
        good = (float((counts * p).sum()) + PSEUDO * PRIOR_GOOD) / (float(counts.sum()) + PSEUDO)
        done = np.abs(rates - model.rates).max() < 1e-9 and abs(good - model.good) < 1e-9
        model = LabelModel(good, rates)
        if done:
            break
    return model


def doc_features(text: bytes, known: tuple[int, int, Counter] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word shapes and a marker of repeated neighbours, as shares of
    the words."""
    n, again, forms = known or profile(text)
    if not n:
        return np.zeros(0, np.int32), np.zeros(0)
    forms = forms | Counter({b"=previous": again})
    index = np.fromiter((zlib.crc32(k) & ((1 << BITS) - 1) for k in forms), np.int32, len(forms))
    return index, np.fromiter(forms.values(), float, len(forms)) / n


@dataclass(frozen=True)
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, text: bytes, known: tuple[int, int, Counter] | None = None) -> float:
        index, share = doc_features(text, known)
        return float(1 / (1 + np.exp(-np.clip(self.weights[index] @ share + self.bias, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray) -> Scorer:
    """Logistic scorer on soft labels, full batches with Adam. The classes
    weigh alike, so that rare bad documents count."""
    size = 1 << BITS
    if not len(rows):
        return Scorer(np.zeros(size), 2.0)
    flat = np.concatenate([r[0] for r in rows])
    share = np.concatenate([r[1] for r in rows])
    of = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    weigh = target / max(target.sum(), 1.0) + (1 - target) / max((1 - target).sum(), 1.0)
    w, m, v = (np.zeros(size + 1) for _ in range(3))
    w[-1] = 2.0
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(of, w[flat] * share, len(rows)) + w[-1], -30, 30)))
        g = weigh * (p - target)
        grad = np.append(np.bincount(flat, g[of] * share, size), g.sum()) + DECAY * w
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Scorer(w[:-1], float(w[-1]))


def vote_patterns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tid: a hash of the text, pattern) of every document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([pattern(votes(t)) for t in texts], pa.int64())], names=["id", "tid", "pattern"])

    return _keyed(docs, id_col, text_col).mapInArrow(task, "id long, tid long, pattern long")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.withColumn("tid", F.xxhash64(F.coalesce("text", F.lit(""))))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[LabelModel, Scorer]:
    """Both models from the documents alone. Votes are counted over all rows;
    the scorer learns from SAMPLE of them (its ids are broadcast, its features
    go to the driver)."""
    patterns = cut(vote_patterns(docs, id_col, text_col))
    counted = patterns.groupBy("pattern").count().orderBy("pattern").collect()
    model = estimate(np.array([r.pattern for r in counted], np.int64), np.array([r["count"] for r in counted], float))
    picked = patterns.where("id is not null").distinct().orderBy(F.xxhash64("id"), "id", F.xxhash64("tid"), "tid").limit(SAMPLE)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, 2):
                found = [doc_features(t) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([i.tobytes() for i, _ in found], pa.binary()),
                                                  pa.array([s.tobytes() for _, s in found], pa.binary())], names=["id", "pattern", "at", "shares"])

    # repeats of a row are one, so no more than SAMPLE features reach the driver
    rows = (_keyed(docs, id_col, text_col).join(F.broadcast(picked), ["id", "tid"]).dropDuplicates(["id", "tid"]).select("id", "pattern", "text")
            .mapInArrow(task, "id long, pattern long, at binary, shares binary").collect())
    rows = sorted(rows, key=lambda r: (r.id, r.at, r.shares))
    target = model.posterior(np.array([r.pattern for r in rows], np.int64)) if rows else np.zeros(0)
    return model, fit([(np.frombuffer(r.at, np.int32), np.frombuffer(r.shares, float)) for r in rows], target)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: row (all its columns as a struct), votes (one
    letter a labeller: b, n or g), posterior (of the votes), score, keep.

    Null or empty texts get no votes and the score of no words. Null ids and
    repeated rows are judged like any other; extra columns are carried along
    untouched; no rows: no rows.
    """
    model, scorer = train(docs, id_col, text_col)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, 1):
                known = [profile(t) for t in texts]
                cast = [votes(t, k) for t, k in zip(texts, known, strict=True)]
                score = np.round([scorer.score(t, k) for t, k in zip(texts, known, strict=True)], 9)
                posterior = np.round(model.posterior(np.array([pattern(v) for v in cast], np.int64)), 9)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(["".join("bng"[x] for x in v) for v in cast]), pa.array(posterior), pa.array(score),
                     pa.array(score >= KEEP)], names=["row", "votes", "posterior", "score", "keep"])

    rows = docs.select(F.struct("*").alias("row")).select("row", F.col("row")[text_col].cast("string").alias("text"))
    return rows.mapInArrow(task, f"row {rows.schema['row'].dataType.simpleString()}, votes string, posterior double, score double, keep boolean")


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents (all columns) that the classifier keeps."""
    return classify(docs).where("keep").select("row.*")
