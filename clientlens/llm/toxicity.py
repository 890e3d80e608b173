"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, documents drawn from all of the
learning rows the unlabelled. A linear scorer over hashed word features is
trained in numpy on the risk

    pi * E_p[l(f)] + max(0, E_u[l(-f)] - pi * E_p[l(-f)])

with the sigmoid loss; pi is the share of toxic rows among the labelled
learning rows. When the second part of a step goes below zero the model
begins to fit the unlabelled positives, and the step goes back on it instead
(the non-negative correction).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientlens.llm.common import pieces
from clientlens.llm.licenses import WORDS

BITS = 18
#: Bounds of the learning sample (documents). Rows are picked by a hash of their id.
POSITIVES = 2_000
UNLABELLED = 4_000
#: A feature counts if so many positives have it, and if its share of them is
#: surely (by two standard errors) over LIFT times its share of the unlabelled.
SUPPORT = 3
LIFT = 2.0
STEPS = 300
RATE = 0.05
DECAY = 1e-3
#: Words whose weight a task keeps at hand.
CACHE = 500_000


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # float32, by feature
    bias: float

    def word(self, word: bytes) -> float:
        return float(sum(self.weights[f] for f in features(word)))


def features(word: bytes) -> list[int]:
    """A word's features: itself and its first four and five letters."""
    mask = (1 << BITS) - 1
    text = word.decode("utf-8", "ignore")
    out = [zlib.crc32(word) & mask]
    for n in (4, 5):
        if len(text) > n:
            out.append(zlib.crc32(text[:n].encode(), n) & mask)
    return out


def doc_words(text: bytes) -> set[bytes]:
    return set(text.translate(WORDS).split())


def doc_features(text: bytes) -> np.ndarray:
    """Features of the distinct words of a text; a feature counts once for
    each word that has it."""
    return np.array([f for w in sorted(doc_words(text)) for f in features(w)], np.int32)


def held_out(id_col: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text is a
    multiple of 5. A null id is held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _rows(docs: list[np.ndarray], support: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all documents end to end, and the document of each."""
    of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    flat = np.concatenate(docs) if docs else np.zeros(0, np.int32)
    keep = support[flat]
    return flat[keep], of[keep]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def telling(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Which features tell positives from the rest."""
    in_p, in_u = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for counts, docs in ((in_p, positive), (in_u, unlabelled)):
        for doc in docs:
            counts[np.unique(doc)] += 1
    share = in_p / len(positive)
    least = share - 2 * np.sqrt(share * (1 - share) / len(positive))
    return (in_p >= SUPPORT) & (least > LIFT * (in_u + 1) / (len(unlabelled) + 1))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, seed: int = 7) -> Model:
    """Non-negative PU learning with Adam over mini-batches. Without positives
    or unlabelled rows every score is the prior."""
    size = 1 << BITS
    prior = min(max(prior, 1e-4), 0.999)
    start = float(np.log(prior / (1 - prior)))
    weights = np.zeros(size)
    if not positive or not unlabelled:
        return Model(weights.astype(np.float32), start)
    support = telling(positive, unlabelled)
    r = np.random.default_rng(seed)
    bias = start
    m, v = np.zeros(size + 1), np.zeros(size + 1)

    def side(docs: list[np.ndarray], share: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pick = [docs[i] for i in r.choice(len(docs), min(share, len(docs)), replace=False)]
        flat, of = _rows(pick, support)
        return flat, of, np.bincount(of, weights[flat], len(pick)) + bias

    for step in range(1, STEPS + 1):
        fp, op, sp = side(positive, 256)
        fu, ou, su = side(unlabelled, 512)
        pp, pu = _sigmoid(sp), _sigmoid(su)  # sigmoid loss: l(f) = 1 - p, l(-f) = p
        negative = pu.mean() - prior * pp.mean()
        dp, du = pp * (1 - pp) / len(pp), pu * (1 - pu) / len(pu)
        if negative >= 0:
            gp, gu = -2 * prior * dp, du
        else:
            gp, gu = prior * dp, -du
        gp, gu = gp / prior, gu / prior  # same direction, scale of the positives
        grad = np.bincount(fp, gp[op], size) + np.bincount(fu, gu[ou], size) + DECAY * weights
        grad = np.append(grad, gp.sum() + gu.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    weights[~support] = 0

    def scored(docs: list[np.ndarray]) -> np.ndarray:
        flat, of = _rows(docs, support)
        return np.bincount(of, weights[flat], len(docs)) + bias

    return Model(weights.astype(np.float32), float(bias) - threshold(scored(positive), scored(unlabelled), prior))


def threshold(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """The score above which a document is called toxic: least non-negative
    PU risk of the zero-one loss, halfway between two scores."""
    scores = np.unique(np.concatenate([positive, unlabelled]))
    cuts = (scores[1:] + scores[:-1]) / 2
    if not len(cuts):
        return 0.0
    missed = np.searchsorted(np.sort(positive), cuts) / len(positive)
    called = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    risk = prior * missed + np.maximum(0.0, called - prior * (1 - missed))
    return float(cuts[np.flatnonzero(risk <= risk.min() + 1e-12)[-1]])


def learning_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> tuple[list, list, float]:
    """Feature arrays of the positives and the unlabelled, and the prior, all
    from rows that are not held out. At most POSITIVES + UNLABELLED ids are
    picked (and so broadcast) by a hash of the id. Of what rows they have, by a
    hash of id and text, at most POSITIVES and UNLABELLED texts go to the driver as features."""
    known = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
             .where(~held_out(F.col("id")) & F.col("toxic").isNotNull()).groupBy("id").agg(F.max("toxic").alias("toxic")))
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    ids = docs.select(F.col(id_col).cast("long").alias("id")).where(~held_out(F.col("id")))

    def first(rows: DataFrame, most: int) -> DataFrame:
        return rows.select("id").orderBy(F.xxhash64("id"), "id").limit(most)

    picked = (first(known.where("toxic = 1"), POSITIVES).select("id", F.lit(1).alias("side"))
              .unionByName(first(ids.distinct(), UNLABELLED).select("id", F.lit(0).alias("side"))))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, 2):
                found = [doc_features(t).tobytes() for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.binary())], names=["id", "side", "features"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # an id may have many rows: of a side's texts, the first of a hash are taken, once each
    rows = texts.join(F.broadcast(picked), "id").select("id", "side", "text").withColumn("tid", F.xxhash64(F.coalesce("text", F.lit(""))))
    places = rows.select("id", "side", "tid").distinct()
    order = [F.xxhash64("id", "tid"), "id", "tid"]
    chosen = F.broadcast(places.where("side = 1").orderBy(*order).limit(POSITIVES).unionByName(places.where("side = 0").orderBy(*order).limit(UNLABELLED)))
    found = (rows.join(chosen, ["id", "side", "tid"]).dropDuplicates(["id", "side", "tid"]).select("id", "side", "text")
             .mapInArrow(task, "id long, side int, features binary").collect())
    found.sort(key=lambda x: (x.id, x.features))
    sides = [[np.frombuffer(x.features, np.int32) for x in found if x.side == side] for side in (1, 0)]
    return sides[0], sides[1], prior


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every document; an empty text has the score of no
    words. Texts are read whole."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, float] = {}
        for batch in batches:
            for part, texts in pieces(batch, 1):
                sums = []
                for text in texts:
                    total = model.bias
                    for word in doc_words(text):
                        weight = known.get(word)
                        if weight is None:
                            if len(known) >= CACHE:
                                known.clear()
                            weight = known[word] = model.word(word)
                        total += weight
                    sums.append(total)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_sigmoid(np.round(np.array(sums, float), 9)))], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(task, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Labels, language, source and id are never inputs of a score. Null texts
    are empty. Labels that repeat: toxic if one says so; null labels are
    left out; without any confirmed toxic row every score is below 0.5. A null
    id is held out. Repeated rows get equal scores; no rows: no rows.
    """
    model = train(*learning_sample(docs, labels, id_col, text_col))
    scored = score_documents(docs, model, id_col, text_col)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
