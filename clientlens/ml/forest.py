"""Random forests grown on counted rows.

A tree only asks on which side of a cut a number lies, and a number has at most
``MOST_BINS`` bins (as Spark's ``maxBins``). Rows of one label that agree in all
categories and bins are alike to every tree, so they are kept once, with their
number n, and a tree draws its bootstrap for them at once: the sum of n
Poisson(1) draws is one Poisson(n) draw. No row is left out; rows that are all
different stay as many as they are. Trees grow level by level, all of a forest in
one pass over the counted rows: tasks sum the class counts of each open node's
bins, which meet per tree, where the best splits are found; the driver gets these.
The split rule is that of Spark's ``RandomForestClassifier`` (Gini, square root of
the features per node, no split without gain, pruned leaves), and the result is a
``RandomForestClassificationModel``. A tree cut off at a smaller depth is the tree
that would have been grown to it, so one growth serves all depths.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.ml.features import PREPARED, Preparation
from clientlens.session import parallelism

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers may not have this package

#: Bins of a number at most.
MOST_BINS = 32
COUNT = "__n"


def cells(df: DataFrame, cols: Sequence[str], most: int = MOST_BINS) -> dict[str, list[float]]:
    """Per column the values that stand for its bins, ascending: all values if
    there are at most ``most``, else so many quantiles. The cuts are the middles
    between neighbours. At most ``2 * most`` values a column come to the driver
    (a few more where their approximate number is too low)."""
    if not cols:
        return {}
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    few = [c for c in cols if sizes[c] <= 2 * most]
    found = df.agg(*[F.collect_set(c).alias(c) for c in few]).first() if few else {}
    many = [c for c in cols if c not in few or len(found[c]) > most]
    quantiles = df.approxQuantile(many, [(i + 0.5) / most for i in range(most)], 0.005) if many else []
    out = dict(zip(many, quantiles)) | {c: found[c] for c in few if c not in many}
    return {c: sorted(set(out[c])) for c in cols}


def in_cell(column: str, values: Sequence[float], scale: float) -> Column:
    """The value that stands for the bin of a number, which is compared as the
    scaler gives it: bit by bit as the model will compare it."""
    x = F.col(column) * F.lit(scale)

    def pick(low: int, high: int) -> Column:
        if low == high:
            return F.lit(float(values[low]))
        mid = (low + high) // 2
        cut = (values[mid] * scale + values[mid + 1] * scale) / 2
        return F.when(x <= cut, pick(low, mid)).otherwise(pick(mid + 1, high))
    return pick(0, len(values) - 1) if values else F.col(column)


@dataclass(frozen=True)
class CountedRows:
    """How rows are counted under fitted feature stages (preparation first,
    scaler last, which has the numbers at the end): the numbers' bins and the
    columns that make up a row."""

    stages: PipelineModel
    preparation: Preparation
    cat_cols: tuple[str, ...]
    label_col: str
    cells: dict[str, list[float]]
    scales: dict[str, float]

    @classmethod
    def of(cls, df: DataFrame, stages: PipelineModel, preparation: Preparation, cat_cols: Sequence[str],
           num_cols: Sequence[str], label_col: str) -> CountedRows:
        found = cells(preparation.stage().transform(df), [f"{c}{PREPARED}" for c in num_cols])
        std = stages.stages[-1].std.toArray().tolist()[-len(num_cols):] if num_cols else []
        scales = {c: 1.0 / s if s else 0.0 for c, s in zip(found, std)}
        return cls(stages, preparation, tuple(cat_cols), label_col, found, scales)

    @property
    def classes(self) -> int:
        return next(len(s.labels) for s in self.stages.stages
                    if isinstance(s, StringIndexerModel) and s.isSet("outputCol") and s.getOutputCol() == "label")

    def groups(self, df: DataFrame) -> DataFrame:
        """Rows that no tree can tell apart, once, with their number."""
        rows = self.preparation.stage().transform(df).select(
            *self.cat_cols, self.label_col, *[in_cell(c, v, self.scales[c]).alias(c) for c, v in self.cells.items()])
        return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(COUNT))

    def vectors(self, groups: DataFrame) -> DataFrame:
        """(label, x, n) of ``groups``, x as the features of the fitted stages."""
        done = PipelineModel(stages=self.stages.stages[1:]).transform(groups)
        return done.select("label", vector_to_array("features").alias("x"), COUNT)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)), pa.array(matrix.ravel()))


def _bins(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], axis=1).astype(np.int8)


def _gini(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=-1)
    out = np.ones(total.shape)
    for k in range(counts.shape[-1]):  # in Spark's order, so that equal gains stay equal
        out -= (counts[..., k] / np.maximum(total, 1)) ** 2
    return np.where(total > 0, out, 0.0)


def _children(bins: np.ndarray, rows: np.ndarray, at: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    return 2 * at + 1 + (bins[rows, feature[at]] > cut[at])


@dataclass(frozen=True)
class Forest:
    """Trees as heaps (the children of node i are 2i+1 and 2i+2): per node its
    feature (-1: a leaf), the last bin of its left side, gain and class counts."""

    cuts: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    counts: np.ndarray

    def leaves(self, depth: int) -> np.ndarray:
        """The features of the trees cut off at ``depth``; sibling leaves that
        predict the same are one."""
        feature = np.where(np.arange(self.feature.shape[1]) < 2 ** depth - 1, self.feature, -1)
        says = self.counts.argmax(axis=2)
        for i in range(2 ** depth - 2, -1, -1):
            left, right = 2 * i + 1, 2 * i + 2
            same = (feature[:, left] < 0) & (feature[:, right] < 0) & (says[:, left] == says[:, right])
            feature[same, i] = -1
        return feature

    def model(self, spark: SparkSession, trees: int, depth: int) -> RandomForestClassificationModel:
        """The first ``trees`` trees as a Spark model."""
        sc = spark.sparkContext
        tree, ml = sc._jvm.org.apache.spark.ml.tree, sc._jvm.org.apache.spark.ml.classification
        feature, classes = self.leaves(depth), self.counts.shape[2]
        says, impurity = self.counts.argmax(axis=2), _gini(self.counts)

        def stats(t: int, i: int):
            values = sc._gateway.new_array(sc._jvm.double, classes)
            for k in range(classes):
                values[k] = float(self.counts[t, i, k])
            return sc._jvm.org.apache.spark.mllib.tree.impurity.GiniCalculator(values, int(self.counts[t, i].sum()))

        def node(t: int, i: int):
            says_it = float(says[t, i]), float(impurity[t, i])
            if feature[t, i] < 0:
                return tree.LeafNode(*says_it, stats(t, i))
            f = int(feature[t, i])
            split = tree.ContinuousSplit(f, float(self.cuts[f][self.cut[t, i]]))
            return tree.InternalNode(*says_it, float(self.gain[t, i]), node(t, 2 * i + 1), node(t, 2 * i + 2), split, stats(t, i))

        made = sc._gateway.new_array(ml.DecisionTreeClassificationModel, trees)
        for t in range(trees):
            made[t] = ml.DecisionTreeClassificationModel(_uid("DecisionTreeClassifier"), node(t, 0), len(self.cuts), classes)
        return RandomForestClassificationModel(
            ml.RandomForestClassificationModel(_uid("RandomForestClassifier"), made, len(self.cuts), classes))

    def votes(self, vectors: DataFrame, points: Sequence[tuple[int, int]]) -> DataFrame:
        """(label, n, votes_0 ...): for each point (trees, depth) the sum of its
        trees' shares of class 1."""
        cuts, cut, share = self.cuts, self.cut, self.counts[:, :, 1] / np.maximum(self.counts.sum(axis=2), 1)
        leaves = {d: self.leaves(d) for _, d in points}

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bins = _bins(_matrix(b.column("x"), len(cuts)), cuts)
                sums = np.zeros((len(points), b.num_rows))
                for d, feature in leaves.items():
                    for t in range(max(n for n, at in points if at == d)):
                        at, rows = np.zeros(b.num_rows, dtype=np.int64), np.arange(b.num_rows)
                        while (rows := rows[feature[t][at[rows]] >= 0]).size:
                            at[rows] = _children(bins, rows, at[rows], feature[t], cut[t])
                        for p, (n, depth) in enumerate(points):
                            if depth == d and t < n:
                                sums[p] += share[t][at]
                yield pa.RecordBatch.from_arrays([b.column("label"), b.column(COUNT), *[pa.array(s) for s in sums]],
                                                 names=["label", COUNT, *[f"votes_{p}" for p in range(len(points))]])

        return vectors.mapInArrow(score, f"label double, {COUNT} long, " + ", ".join(f"votes_{p} double" for p in range(len(points))))


def _uid(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[-12:]}"


def grow(rows: DataFrame, counted: CountedRows, layout: Callable[..., DataFrame], tree_partitions: Callable[[int], int],
         tasks: int, trees: int, depth: int, seed: int = 42, subset: str = "sqrt", bootstrap: bool = True) -> Forest:
    """Grow ``trees`` trees to ``depth`` on all of ``rows``, counted in ``tasks``
    tasks at most before their counts meet. The draws of a tree follow its number,
    the seed and the counted rows, not partitions or cores."""
    seed %= 2 ** 32
    spark = rows.sparkSession
    groups = counted.groups(rows.coalesce(tasks)).persist()
    size, most = groups.agg(F.count(F.lit(1)), F.max(COUNT)).first()
    parts = tree_partitions(size)
    vectors = counted.vectors(layout(groups, parts))
    values: dict[int, list[float]] = {}
    for slot, value in vectors.select(F.posexplode("x")).distinct().collect():  # bins of the slots
        values.setdefault(slot, []).append(value)
    cuts = [np.array([(a + b) / 2 for a, b in zip(v, v[1:])]) for v in (sorted(values[s]) for s in range(len(values)))]
    width, classes = len(cuts), counted.classes
    kind, kept = (np.int32, "int") if (most or 0) < 2 ** 30 else (np.int64, "long")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rngs = [np.random.default_rng([seed, t, part]) for t in range(trees)]
        for b in batches:
            n = b.column(COUNT).to_numpy()
            weights = np.stack([r.poisson(n) if bootstrap else n for r in rngs], axis=1).astype(kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.column("label").to_numpy().astype(np.int32)), _lists(_bins(_matrix(b.column("x"), width), cuts)), _lists(weights)],
                names=["label", "bins", "weights"])

    bagged = vectors.mapInArrow(draw, f"label int, bins array<tinyint>, weights array<{kept}>").persist()
    feature = np.full((trees, 2 ** (depth + 1) - 1), -1, dtype=np.int32)
    cut = np.zeros(feature.shape, dtype=np.int32)
    gain = np.zeros(feature.shape)
    counts = np.zeros((*feature.shape, classes))
    per_node = math.ceil(math.sqrt(width)) if subset == "sqrt" else width
    open_nodes = [[0] for _ in range(trees)]
    try:
        for level in range(max(depth, 1)):
            if not any(open_nodes):
                break
            chosen = [np.array([np.sort(np.random.default_rng([seed, t, i, 1]).choice(width, per_node, replace=False)) for i in nodes],
                               dtype=np.int64).reshape(-1, per_node) for t, nodes in enumerate(open_nodes)]
            for t, i, *found in _level(bagged.coalesce(min(parts, 4 * parallelism(spark))), level, open_nodes, chosen, feature, cut, width, classes, trees):
                (f, c, g), (own, left, right) = found[:3], np.array(found[3:]).reshape(3, classes)
                counts[t, i] = own
                if g > 0 and depth:
                    feature[t, i], cut[t, i], gain[t, i] = f, c, g
                    counts[t, 2 * i + 1], counts[t, 2 * i + 2] = left, right
            open_nodes = [[j for i in nodes if feature[t, i] >= 0 for j in (2 * i + 1, 2 * i + 2)
                           if level + 1 < depth and _gini(counts[t, j]) > np.finfo(float).eps] for t, nodes in enumerate(open_nodes)]
    finally:
        bagged.unpersist()
        groups.unpersist()
    return Forest(cuts, feature, cut, gain, counts)


def _level(bagged: DataFrame, level: int, open_nodes: list[list[int]], chosen: list[np.ndarray], feature: np.ndarray,
           cut: np.ndarray, width: int, classes: int, trees: int) -> list[tuple]:
    """(tree, node, feature, cut, gain, class counts of the node, its left and
    its right side) of the best split of each open node. A row per open node."""
    first, per_node = 2 ** level - 1, chosen[0].shape[1]
    place = np.full((trees, 2 ** level), -1, dtype=np.int64)
    for t, nodes in enumerate(open_nodes):
        place[t, [i - first for i in nodes]] = range(len(nodes))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(len(nodes) * per_node * MOST_BINS * classes) for nodes in open_nodes]
        for b in batches:
            label, bins, weights = b.column("label").to_numpy(), _matrix(b.column("bins"), width), _matrix(b.column("weights"), trees)
            for t in range(trees):
                if not open_nodes[t]:
                    continue
                rows = np.flatnonzero(weights[:, t])
                at = np.zeros(rows.size, dtype=np.int64)
                for _ in range(level):
                    inner = feature[t][at] >= 0
                    rows, at = rows[inner], at[inner]
                    at = _children(bins, rows, at, feature[t], cut[t])
                at = place[t][at - first]
                rows, at = rows[at >= 0], at[at >= 0]
                w, said = weights[rows, t], label[rows]
                for s in range(per_node):
                    cell = (at * per_node + s) * MOST_BINS + bins[rows, chosen[t][at, s]]
                    sums[t] += np.bincount(cell * classes + said, weights=w, minlength=sums[t].size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(trees, dtype=np.int32)), pa.array([s.tobytes() for s in sums])], names=["tree", "sums"])

    names = [f"{side}_{k}" for side in ("own", "left", "right") for k in range(classes)]

    def best(table: pa.Table) -> pa.Table:
        t = table.column("tree")[0].as_py()
        nodes, total = open_nodes[t], 0
        for x in table.column("sums"):
            total = total + np.frombuffer(x.as_buffer())
        left = np.reshape(total, (len(nodes), per_node, MOST_BINS, classes)).cumsum(axis=2)
        own = left[:, :1, -1:, :]
        left = left[:, :, :-1, :]
        right = own - left
        n, low, high = own.sum(axis=-1), left.sum(axis=-1), right.sum(axis=-1)
        gains = _gini(own) - low / np.maximum(n, 1) * _gini(left) - high / np.maximum(n, 1) * _gini(right)
        gains = np.where((low > 0) & (high > 0), gains, -np.inf).reshape(len(nodes), -1)
        top = gains.argmax(axis=1)
        s, c = np.divmod(top, MOST_BINS - 1)
        each = np.arange(len(nodes))
        sides = np.concatenate([own[:, 0, 0], left[each, s, c], right[each, s, c]], axis=1)
        return pa.table({"tree": pa.array([t] * len(nodes), pa.int32()), "node": pa.array(nodes, pa.int32()),
                         "feature": pa.array(chosen[t][each, s].astype(np.int32)), "cut": pa.array(c.astype(np.int32)),
                         "gain": pa.array(gains[each, top]), **{k: pa.array(sides[:, j]) for j, k in enumerate(names)}})

    sums = bagged.mapInArrow(add, "tree int, sums binary").where(F.length("sums") > 0)
    return sums.groupBy("tree").applyInArrow(
        best, "tree int, node int, feature int, cut int, gain double, " + ", ".join(f"{k} double" for k in names)).collect()
