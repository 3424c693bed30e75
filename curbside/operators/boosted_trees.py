"""Boosted regression trees for many rows: Spark's `GBTRegressor` and its model, fitted from blocks of binned rows.

Spark's own fit holds every training row as objects and adds them up in a hundred passes; it slows down as rows grow. Here
rows lie in blocks of the shared folder: their bins, and eight bytes for what is left to explain. Features of few bins share
a code of their bins, so that one addition counts them all; a feature of many bins has its own. A pass adds a block up in
numpy, Spark shuffles the sums by tree node, and a task per node finds its best split. All rows take part in every pass.

The steps are those of Spark: features are binned once, a continuous one at the midpoints of its values or, if it has more
values than bins, at even ranks; categories are ordered by their mean; splits go by gain in variance; trees after the
first learn twice the residuals and weigh `stepSize`. Where Spark takes the ranks from some 90,000 sampled rows, all rows
are taken here. What comes to the driver is one row per tree node, and at most `maxBins` thresholds a feature.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from math import prod

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.session import discard, fresh_folder, settle_at

BLOCKS_FROM = 4_000_000  # rows
BLOCK_ROWS = 1 << 14
GROUP_BINS = 1 << 10  # codes that features share, at most
SUMMARY_ROWS = 1 << 17  # rows whose distinct values are counted together
SUMMARY_VALUES = 1 << 14  # a task keeps the values of a feature exactly up to twice so many, and by rank beyond
MOST_LEVELS = 10  # tables of a tree go to all tasks; deeper trees are left to Spark
EPSILON = 2.0**-52

_BLOCK = "rows int, codes binary, target binary"
_SPLIT = (
    "node int, n double, total double, squares double, gain double, feature int, bins array<int>, "
    "left_n double, left_total double, left_squares double"
)
_BLOCK_FILES = {"compression": "none", "parquet.enable.dictionary": "false"}  # codes are as small as they get
_BLOCK_SETTINGS = {  # a block is a row of some 200 kB
    "spark.sql.parquet.columnarReaderBatchSize": "8",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "8",
}


@dataclass
class Bins:
    """How values become bins: the thresholds of a continuous feature, the number of categories of another."""

    thresholds: list[np.ndarray | None]
    categories: list[int]

    def count(self, feature: int) -> int:
        edges = self.thresholds[feature]
        return self.categories[feature] if edges is None else len(edges) + 1

    @property
    def features(self) -> int:
        return len(self.thresholds)

    @cached_property
    def groups(self) -> list[list[int]]:
        """Features that share a code, each in the first group with room for its bins."""
        groups: list[list[int]] = []
        for f in range(self.features):
            room = (g for g in groups if prod(self.count(h) for h in g) * self.count(f) <= GROUP_BINS)
            group = next(room, None)
            if group is None:
                groups.append(group := [])
            group.append(f)
        return groups

    def shape(self, group: list[int]) -> list[int]:
        return [self.count(f) for f in group]

    @cached_property
    def width(self) -> int:
        return max(prod(self.shape(group)) for group in self.groups)

    @cached_property
    def most(self) -> int:
        return max(self.count(f) for f in range(self.features))

    @cached_property
    def dtype(self) -> np.dtype:
        return np.min_scalar_type(self.width - 1)

    def left_codes(self, feature: int, bins: list[int]) -> tuple[int, np.ndarray]:
        """The group of a feature, and which of the group's codes go left."""
        left = np.zeros(self.count(feature), bool)
        left[np.array(bins) if self.thresholds[feature] is None else slice(bins[0] + 1)] = True
        number = next(i for i, group in enumerate(self.groups) if feature in group)
        group = self.groups[number]
        code = np.arange(prod(self.shape(group)))
        return number, left[np.unravel_index(code, self.shape(group))[group.index(feature)]]

    def by_feature(self, sums: list[np.ndarray]) -> np.ndarray:
        """Sums by (..., code) of each group as sums by (feature, bin, ...)."""
        out = np.zeros((self.features, self.most, *sums[0].shape[:-1]))
        for group, part in zip(self.groups, sums):
            part = part[..., : prod(self.shape(group))].reshape(*part.shape[:-1], *self.shape(group))
            first = part.ndim - len(group)
            for i, f in enumerate(group):
                others = tuple(first + j for j in range(len(group)) if j != i)
                out[f, : self.count(f)] = np.moveaxis(part.sum(axis=others), -1, 0)
        return out


@dataclass
class Node:
    """Rows, sum and sum of squares of what its rows are to learn; a split that is taken has children."""

    sums: tuple[float, float, float]
    gain: float = 0.0
    feature: int = 0
    left_bins: list[int] = field(default_factory=list)  # of categories; a continuous feature has the last bin only
    children: tuple[int, int] | None = None

    @property
    def prediction(self) -> float:
        return self.sums[1] / self.sums[0] if self.sums[0] else 0.0

    @property
    def impurity(self) -> float:
        return float(_variance(*map(np.float64, self.sums)))


class BlockGBTRegressor(GBTRegressor):
    """`GBTRegressor` with the same parameters and model, fitted in blocks where rows are many.

    Fewer rows are left to Spark's own fit, which has less to start a pass for. So are settings that take part of the
    rows or features, weights, another loss, validation and very deep trees.
    """

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        if self._plain() and dataset.count() >= BLOCKS_FROM:
            return self.fit_in_blocks(dataset)
        return super()._fit(dataset)

    def fit_in_blocks(self, dataset: DataFrame) -> GBTRegressionModel:
        """The model of all rows of `dataset`; for settings that `fit` leaves to Spark it is not meant."""
        spark = dataset.sparkSession
        folders = [fresh_folder(spark, "boosting")]
        try:
            stored = settle_at(_flat(dataset, self.getLabelCol(), self.getFeaturesCol()), folders[0])
            bins = self._bins(stored, _categories(dataset, self.getFeaturesCol()))
            folders.append(fresh_folder(spark, "boosting"))
            in_blocks = _block_session(spark)
            blocks = _written(in_blocks, stored.mapInArrow(_coded(bins), _BLOCK), folders[1])
            discard(spark, folders.pop(0))
            trees: list[list[Node]] = []
            weights = [1.0] + [self.getStepSize()] * (self.getMaxIter() - 1)
            for number, weight in enumerate(weights, 1):
                trees.append(self._tree(blocks, bins))
                if number < len(weights):
                    folders.append(fresh_folder(spark, "boosting"))
                    rest = blocks.mapInArrow(_learned(trees[-1], bins, weight, number == 1), _BLOCK)
                    blocks = _written(in_blocks, rest, folders[1])
                    discard(spark, folders.pop(0))
        finally:
            for folder in folders:
                discard(spark, folder)
        return self._copyValues(self._create_model(_spark_model(spark, self.uid, trees, weights, bins)))

    def _plain(self) -> bool:
        plain = not any(self.isDefined(p) and self.getOrDefault(p) for p in (self.weightCol, self.validationIndicatorCol))
        return (
            plain and self.getLossType() == "squared" and self.getSubsamplingRate() == 1.0
            and self.getFeatureSubsetStrategy() in ("all", "auto") and self.getMinWeightFractionPerNode() == 0.0
            and 1 <= self.getMaxDepth() <= MOST_LEVELS
        )

    def _bins(self, stored: DataFrame, categories: dict[int, int]) -> Bins:
        """Thresholds from the distinct values of all rows, and the numbers of categories."""
        rows = stored.count()
        if not rows:
            raise ValueError("no training rows")
        features = len(stored.columns) - 1
        most = min(self.getMaxBins(), rows)
        wide = {f: n for f, n in categories.items() if n > most}
        if wide:
            raise ValueError(f"maxBins (or the number of rows) is {most}, features have more categories: {wide}")
        counted = stored.mapInArrow(_counted_values(features, categories), "feature int, value double, n double")
        edges = counted.groupBy("feature").applyInPandas(_thresholds(most - 1), "feature int, edges array<double>")
        found = {r.feature: np.array(r.edges, float) for r in edges.collect()}
        return Bins(
            [None if f in categories else found[f] for f in range(features)], [categories.get(f, 0) for f in range(features)]
        )

    def _tree(self, blocks: DataFrame, bins: Bins) -> list[Node]:
        """A tree grown level by level; a level is one pass over all rows."""
        nodes = [Node((0.0, 0.0, 0.0))]
        open_nodes = [0]
        best = _best_split(bins, self.getMinInstancesPerNode(), self.getMinInfoGain())
        for level in range(1, self.getMaxDepth() + 1):
            if not open_nodes:
                break
            sums = blocks.mapInArrow(_histograms(nodes, bins, open_nodes), "node int, sums binary")
            found = sums.groupBy("node").applyInPandas(best, _SPLIT).collect()
            open_nodes = []
            for r in sorted(found, key=lambda r: r.node):
                node = nodes[r.node]
                node.sums = (r.n, r.total, r.squares)
                if not r.gain > 0:
                    continue
                node.gain, node.feature, node.left_bins = r.gain, r.feature, list(r.bins)
                left = (r.left_n, r.left_total, r.left_squares)
                node.children = len(nodes), len(nodes) + 1
                nodes += [Node(left), Node(tuple(a - b for a, b in zip(node.sums, left)))]
                if level < self.getMaxDepth():
                    open_nodes += [c for c in node.children if abs(nodes[c].impurity) >= EPSILON]
        return nodes


def _categories(dataset: DataFrame, features: str) -> dict[int, int]:
    """Numbers of categories of the features that the vector's attributes say are nominal or binary."""
    attributes = dataset.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    nominal = {a["idx"]: len(a["vals"]) if "vals" in a else a.get("num_vals", 0) for a in attributes.get("nominal", [])}
    unknown = [f for f, n in nominal.items() if not n]
    if unknown:
        raise ValueError(f"features are marked as nominal, but the number of their values is not known: {unknown}")
    return nominal | {a["idx"]: 2 for a in attributes.get("binary", [])}


def _flat(dataset: DataFrame, label: str, features: str) -> DataFrame:
    """The label and a column for each feature: these are stored and read several times faster than vectors."""
    given = dataset.select(F.col(label).cast("double").alias("label"), vector_to_array(F.col(features)).alias("x"))
    count = dataset.schema[features].metadata.get("ml_attr", {}).get("num_attrs")
    if count is None:
        first = given.where("x IS NOT NULL").first()
        count = len(first.x) if first else 0
    return given.select("label", *[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(count)])


def _block_session(spark: SparkSession) -> SparkSession:
    """A session with its own settings, as readers and Arrow batches are made for thousands of small rows."""
    session = spark.newSession()
    for key, value in _BLOCK_SETTINGS.items():
        session.conf.set(key, value)
    return session


def _written(spark: SparkSession, blocks: DataFrame, path: str) -> DataFrame:
    blocks.write.options(**_BLOCK_FILES).parquet(path)
    return spark.read.schema(_BLOCK).parquet(path)


def _columns_of(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Labels and features of `rows` rows or a few more at a time; what Spark's fit refuses is refused."""

    def of(held: list[pa.RecordBatch]) -> tuple[np.ndarray, list[np.ndarray]]:
        table = pa.Table.from_batches(held)
        labels, *values = (column.to_numpy() for column in table.columns)
        if table.column(0).null_count or np.isnan(labels).any():
            raise ValueError("Labels MUST NOT be Null or NaN")
        if any(column.null_count for column in table.columns[1:]):
            raise ValueError("Vectors MUST NOT be Null")
        if not all(np.isfinite(v).all() for v in values):
            raise ValueError("Vector values MUST NOT be NaN or Infinity")
        return labels, values

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield of(held)
            held, size = [], 0
    if size:
        yield of(held)


def _merged(values: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order with their counts; more than twice `most` are merged with the next larger ones."""
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    last = np.append(values[1:] != values[:-1], True)
    values, sums = values[last], np.cumsum(counts)[last]
    while len(values) > 2 * most:
        # the odd places and the greatest value stay; sums hold all up to a value, so nothing is lost
        kept = np.append(np.arange(1, len(values) - 1, 2), len(values) - 1)
        values, sums = values[kept], sums[kept]
    return values, np.diff(sums, prepend=0.0)


def _counted_values(features: int, categories: dict[int, int]) -> Callable:
    """Distinct values of each continuous feature, with counts."""

    def count(batches):
        kept = {f: (np.empty(0), np.empty(0)) for f in range(features) if f not in categories}
        for _, x in _columns_of(batches, SUMMARY_ROWS):
            for f, (values, counts) in kept.items():
                new, n = np.unique(x[f], return_counts=True)
                kept[f] = _merged(np.append(values, new), np.append(counts, n), SUMMARY_VALUES)
        for f, (values, counts) in kept.items():
            ids = np.full(len(values), f, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(values), pa.array(counts)], ["feature", "value", "n"])

    return count


def _thresholds(most: int) -> Callable:
    """Up to `most` thresholds of a feature: all midpoints, or those whose ranks come nearest to even steps."""

    def thresholds(rows: pd.DataFrame) -> pd.DataFrame:
        values, counts = _merged(rows["value"].to_numpy(), rows["n"].to_numpy(), SUMMARY_VALUES)
        middles = (values[:-1] + values[1:]) / 2
        if len(middles) > most:
            sums = np.cumsum(counts)
            step = sums[-1] / (most + 1)
            aim, taken = step, []
            for i, (below, upto) in enumerate(zip(sums[:-1], sums[1:])):
                if abs(below - aim) < abs(upto - aim):
                    taken.append(i)
                    aim += step
            middles = middles[taken]
        return pd.DataFrame({"feature": [rows["feature"].iloc[0]], "edges": [middles]})

    return thresholds


def _block(codes: np.ndarray, target: np.ndarray) -> pa.RecordBatch:
    parts = [pa.array([part.tobytes()], pa.binary()) for part in (codes, target)]
    return pa.RecordBatch.from_arrays([pa.array([len(target)], pa.int32()), *parts], ["rows", "codes", "target"])


def _coded(bins: Bins) -> Callable:
    """Rows as blocks: the codes of all rows, group after group, and the labels as what is to be learned."""

    def bin_of(feature: int, values: np.ndarray) -> np.ndarray:
        edges, categories = bins.thresholds[feature], bins.categories[feature]
        if edges is not None:
            return np.searchsorted(edges, values, side="left")
        if len(values) and not (0 <= values.min() and values.max() < categories):
            raise ValueError(f"feature {feature} has a value that is none of its {categories} categories")
        return values.astype(np.intp)

    def code(batches):
        for labels, x in _columns_of(batches, BLOCK_ROWS):
            found = [bin_of(f, x[f]) for f in range(bins.features)]
            codes = [np.ravel_multi_index([found[f] for f in group], bins.shape(group)) for group in bins.groups]
            yield _block(np.array(codes, bins.dtype), labels)

    return code


def _blocks(batches: Iterable[pa.RecordBatch], bins: Bins) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for rows, codes, target in zip(*(batch.column(c) for c in ("rows", "codes", "target"))):
            shape = len(bins.groups), rows.as_py()
            yield np.frombuffer(codes.as_buffer(), bins.dtype).reshape(shape), np.frombuffer(target.as_buffer())


class _Walk:
    """The node of every row of a block: from the root, as many steps as the tree has levels."""

    def __init__(self, nodes: list[Node], bins: Bins) -> None:
        self.width = bins.width
        self.group = np.zeros(len(nodes), np.intp)
        self.next = np.repeat(np.arange(len(nodes), dtype=np.intp)[:, None], self.width, 1)  # a leaf stays
        depth = [0] * len(nodes)
        for i, node in enumerate(nodes):
            if node.children:
                self.group[i], left = bins.left_codes(node.feature, node.left_bins)
                self.next[i, : len(left)] = np.where(left, *node.children)
                for child in node.children:
                    depth[child] = depth[i] + 1
        self.levels = max(depth)
        self.next = self.next.ravel()

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        rows = codes.shape[1]
        at = np.zeros(rows, np.intp)
        if not self.levels:
            return at
        codes, places, starts = codes.ravel(), np.arange(rows), self.group * rows
        at += self.next.take(codes[starts[0] : starts[0] + rows])
        for _ in range(1, self.levels):
            code = codes.take(starts.take(at) + places)
            at *= self.width
            at += code
            at = self.next.take(at)
        return at


def _histograms(nodes: list[Node], bins: Bins, wanted: list[int]) -> Callable:
    """Per wanted node: number, sum and sum of squares of what is to be learned, by feature and bin."""
    walk, width = _Walk(nodes, bins), bins.width
    slot = np.full(len(nodes), len(wanted), np.intp)
    slot[wanted] = np.arange(len(wanted))
    size = (len(wanted) + 1) * width  # rows in leaves go to the last slot

    def add(batches):
        sums = np.zeros((len(bins.groups), 3, size))
        for codes, target in _blocks(batches, bins):
            squares = target * target
            start = slot.take(walk(codes)) * width
            for group, code in zip(sums, codes):
                cell = start + code
                group[0] += np.bincount(cell, minlength=size)
                group[1] += np.bincount(cell, target, size)
                group[2] += np.bincount(cell, squares, size)
        found = bins.by_feature(list(sums.reshape(len(bins.groups), 3, -1, width)))
        parts = [np.moveaxis(found[..., i], -1, 0).tobytes() for i in range(len(wanted))]
        yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int32()), pa.array(parts, pa.binary())], ["node", "sums"])

    return add


def _variance(n: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, (squares - total * total / n) / n, 0.0)


def _best_split(bins: Bins, least_rows: int, least_gain: float) -> Callable:
    """The split of a node with the greatest gain; the first of equal ones. Gain 0: the node stays a leaf."""

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        sums = sum(np.frombuffer(part) for part in rows["sums"]).reshape(3, bins.features, -1)
        whole = sums[:, 0].sum(axis=1)
        found = (0.0, 0, [], np.zeros(3))
        for f in range(bins.features):
            count = bins.count(f)
            if count < 2:
                continue
            by_bin, order = sums[:, f, :count], np.arange(count)
            if bins.thresholds[f] is None:
                with np.errstate(divide="ignore", invalid="ignore"):
                    order = np.argsort(np.where(by_bin[0] > 0, by_bin[1] / by_bin[0], np.inf), kind="stable")
            upto = np.cumsum(by_bin[:, order], axis=1)
            left, total = upto[:, :-1], upto[:, -1:]
            right = total - left
            gain = _variance(*total) - (left[0] * _variance(*left) + right[0] * _variance(*right)) / whole[0]
            gain[(left[0] < least_rows) | (right[0] < least_rows) | (gain < least_gain)] = -np.inf
            at = int(np.argmax(gain))
            if gain[at] > found[0]:
                taken = [at] if bins.thresholds[f] is not None else order[: at + 1].tolist()
                found = (float(gain[at]), f, taken, left[:, at])
        gain, feature, taken, left = found
        return pd.DataFrame([(rows["node"].iloc[0], *whole, gain, feature, taken, *left)], columns=_columns(_SPLIT))

    return best


def _columns(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


def _learned(nodes: list[Node], bins: Bins, weight: float, first: bool) -> Callable:
    """Blocks with what a tree leaves to learn: twice the residuals, of which all trees but the first start."""
    walk = _Walk(nodes, bins)
    predictions = np.array([node.prediction for node in nodes]) * (2 * weight)

    def learn(batches):
        for codes, target in _blocks(batches, bins):
            yield _block(codes, (2 * target if first else target) - predictions.take(walk(codes)))

    return learn


def _spark_model(spark: SparkSession, uid: str, trees: list[list[Node]], weights: list[float], bins: Bins):
    """The model as Spark's own, so that it predicts, describes and saves itself like any other."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    regression, tree = jvm.org.apache.spark.ml.regression, jvm.org.apache.spark.ml.tree
    tree_model, double = regression.DecisionTreeRegressionModel, jvm.double
    leaf_node, inner_node = tree.LeafNode, tree.InternalNode
    by_threshold, by_category = tree.ContinuousSplit, tree.CategoricalSplit
    calculator = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator

    def array(kind, values):
        made = gateway.new_array(kind, len(values))
        for i, value in enumerate(values):
            made[i] = value
        return made

    def node_of(nodes: list[Node], at: int):
        """The Java node and, of a leaf, its prediction: children that are leaves of one prediction are one leaf."""
        node = nodes[at]
        stats = calculator(array(double, [float(s) for s in node.sums]), int(node.sums[0]))
        if node.children:
            (left, a), (right, b) = (node_of(nodes, child) for child in node.children)
            if a is None or a != b:
                edges = bins.thresholds[node.feature]
                if edges is None:
                    categories = array(double, [float(c) for c in node.left_bins])
                    split = by_category(node.feature, categories, bins.categories[node.feature])
                else:
                    split = by_threshold(node.feature, float(edges[node.left_bins[0]]))
                return inner_node(node.prediction, node.impurity, node.gain, left, right, split, stats), None
        leaf = node.prediction if not node.children else a
        return leaf_node(leaf, node.impurity, stats), leaf

    made = array(tree_model, [tree_model(node_of(nodes, 0)[0], bins.features) for nodes in trees])
    return regression.GBTRegressionModel(uid, made, array(double, weights), bins.features)
