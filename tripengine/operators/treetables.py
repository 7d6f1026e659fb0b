"""Fitted trees as tables: their nodes, shallower versions, and attributions by leaf paths."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripengine.session import scratch

#: Rows that one step of an attribution looks at; each needs a few numbers per path.
BLOCK_ROWS = 4096


class Node(NamedTuple):
    prediction: float
    weight: float  # of the training rows that reached it
    left: int  # -1 in a leaf
    right: int
    feature: int
    bounds: tuple[float, ...]  # a threshold, or the categories that go left
    categories: int  # -1 where the feature is continuous


class Forest(NamedTuple):
    """Trees of nodes in preorder, with the weight of each tree's prediction in the sum."""
    trees: list[list[Node]]
    weights: list[float]


def _saved(model) -> str:
    path = scratch(SparkSession.active(), "model")
    model.save(path)
    return path


def _is_tree(model) -> bool:
    return isinstance(model, DecisionTreeRegressionModel)


def forest_of(model) -> Forest:
    """The nodes of a decision tree, a random forest or boosted trees.

    Read from the saved form; the driver holds fitted trees anyway.
    """
    spark, path = SparkSession.active(), _saved(model)
    data = spark.read.parquet(f"{path}/data")
    if _is_tree(model):
        data = data.select(F.lit(0).alias("tree"), "*")
    else:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    trees: dict[int, list[Node]] = {}
    for r in data.orderBy("tree", "id").collect():
        split = r["split"]
        trees.setdefault(r["tree"], []).append(Node(
            r["prediction"], r["impurityStats"][0], r["leftChild"], r["rightChild"],
            split["featureIndex"], tuple(split["leftCategoriesOrThreshold"]), split["numCategories"]))
    found = [trees[t] for t in sorted(trees)]
    if _is_tree(model):
        return Forest(found, [1.0])
    weights = [float(w) for w in model.treeWeights]
    # a forest reports weight 1 per tree and predicts the mean, boosting predicts the weighted sum
    whole = sum(weights) if "RandomForest" in type(model).__name__ else 1.0
    return Forest(found, [w / whole for w in weights])


def truncated(model, depth: int | None = None, trees: int | None = None):
    """The model cut off at a depth, or with its first trees only, as a model of the same kind."""
    return truncations(model, [(depth, trees)])[0]


def truncations(model, cuts: Sequence[tuple[int | None, int | None]]) -> list:
    """A model for each (depth, number of trees) to keep, all cut out of one saved model.

    A node predicts the mean of the rows that reached it, so a tree cut off at
    a depth is the tree that greedy growth to that depth gives.
    """
    spark, path = SparkSession.active(), _saved(model)
    data = spark.read.parquet(f"{path}/data")
    data = data.select(F.lit(0).alias("tree"), "*") if _is_tree(model) else \
        data.select(F.col("treeID").alias("tree"), "nodeData.*")
    shape = data.select("tree", "id", "leftChild", "rightChild").orderBy("tree", "id").toArrow()
    meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    return [_written(model, data, shape, meta, path, depth, trees) for depth, trees in cuts]


def _written(model, data: DataFrame, shape: pa.Table, meta: dict, path: str, depth: int | None, trees: int | None):
    spark, out = data.sparkSession, scratch(data.sparkSession, "model")
    renumbered = spark.createDataFrame(_renumbered(shape, depth))
    leaf = F.col("cut")
    nodes = data.join(renumbered, ["tree", "id"]).where("true" if trees is None else f"tree < {trees}").select(
        "tree", F.col("new_id").alias("id"), "prediction", "impurity", "impurityStats", "rawCount",
        F.when(leaf, -1.0).otherwise(F.col("gain")).alias("gain"),
        F.col("new_left").alias("leftChild"), F.col("new_right").alias("rightChild"),
        F.when(leaf, F.struct(F.lit(-1).alias("featureIndex"),
                              F.array().cast("array<double>").alias("leftCategoriesOrThreshold"),
                              F.lit(-1).alias("numCategories"))).otherwise(F.col("split")).alias("split"))
    meta = meta | {"paramMap": dict(meta["paramMap"])}
    if depth is not None:
        meta["paramMap"]["maxDepth"] = depth
    if _is_tree(model):
        nodes = nodes.drop("tree")
    else:
        every = spark.read.parquet(f"{path}/treesMetadata")
        kept = every if trees is None else every.where(F.col("_1") < trees)
        kept.coalesce(1).write.parquet(f"{out}/treesMetadata")
        meta["numTrees"] = kept.count()
        if trees is not None:
            meta["paramMap"]["maxIter" if "maxIter" in meta["paramMap"] else "numTrees"] = meta["numTrees"]
        nodes = nodes.select(F.col("tree").alias("treeID"), F.struct(*nodes.columns[1:]).alias("nodeData"))
    nodes.coalesce(1).write.parquet(f"{out}/data")
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{out}/metadata")
    return type(model).load(out)


def _renumbered(shape: pa.Table, depth: int | None) -> pa.Table:
    """Nodes down to a depth with new numbers: those kept stay in preorder, without gaps."""
    tree, number, left, right = (shape.column(c).to_numpy().astype(np.int64) for c in shape.column_names)
    first = np.searchsorted(tree, tree)  # nodes of a tree are numbered from 0 without gaps
    level = np.zeros(len(tree), np.int64)
    inner = left >= 0
    for at in np.flatnonzero(inner):  # parents come before their children
        level[first[at] + left[at]] = level[first[at] + right[at]] = level[at] + 1
    kept = np.ones(len(tree), bool) if depth is None else level <= depth
    cut = inner & (level == depth) if depth is not None else np.zeros(len(tree), bool)
    new = np.cumsum(kept) - 1
    new -= new[first]  # roots are always kept
    goes_on = inner & ~cut
    sides = [np.where(goes_on, new[np.where(goes_on, first + side, 0)], -1) for side in (left, right)]
    columns = {"tree": tree, "id": number, "new_id": new, "new_left": sides[0], "new_right": sides[1]}
    return pa.table({k: pa.array(v[kept].astype(np.int32)) for k, v in columns.items()} | {"cut": pa.array(cut[kept])})


class Path(NamedTuple):
    """What leads to a leaf, each feature once."""
    value: float  # of the leaf, by the weight of its tree
    features: list[int]
    bounds: list[tuple[float, float] | frozenset[float]]  # above, up to; or the categories that pass
    shares: list[float]  # of the training rows, where the feature is not known


def leaf_paths(forest: Forest) -> list[Path]:
    """The table of all ways from a root to a leaf."""
    paths = []
    for nodes, weight in zip(forest.trees, forest.weights, strict=True):
        open_ = [(0, {})]
        while open_:
            at, known = open_.pop()
            node = nodes[at]
            if node.left < 0:
                paths.append(Path(node.prediction * weight, list(known), [b for b, _ in known.values()],
                                  [s for _, s in known.values()]))
                continue
            for child, goes_left in ((node.left, True), (node.right, False)):
                share = nodes[child].weight / node.weight
                before, held = known.get(node.feature, (None, 1.0))
                if node.categories < 0:
                    low, high = before or (-np.inf, np.inf)
                    t = node.bounds[0]
                    passes = (low, min(high, t)) if goes_left else (max(low, t), high)
                else:
                    own = set(node.bounds)
                    own = own if goes_left else set(map(float, range(node.categories))) - own
                    passes = frozenset(own if before is None else own & before)
                open_.append((child, known | {node.feature: (passes, held * share)}))
    return paths


def expected_value(forest: Forest) -> float:
    """The prediction where nothing is known: leaves by the training rows in them."""
    return float(sum(p.value * np.prod(p.shares) for p in leaf_paths(forest)))


#: Cells a table of looked-up contributions may have. Longer paths are worked out row by row.
TABLE_CELLS = 512


class Attribution:
    """Shapley values of a forest's features, where unknown features follow the training rows.

    A leaf adds ``value * (passes - share)`` for each feature of its path, times
    the Shapley-weighted mean over sets of the other features of the product of
    ``passes`` inside the set and ``share`` outside. That mean is the integral
    over ``t`` from 0 to 1 of the product of ``t * passes + (1 - t) * share``, a
    polynomial that Gauss-Legendre points integrate exactly. So the factors of a
    path are worked out once, and no set is listed.

    What a path adds depends only on which of its bounds a row passes. So paths
    that share features are put together, their sums are tabled for each cell
    that their bounds cut out, and a row looks its cells up.
    """

    def __init__(self, forest: Forest, features: int):
        self.features = features
        paths = sorted((p for p in leaf_paths(forest) if p.features), key=lambda p: sorted(p.features))
        self.categorical = {f for p in paths for f, b in zip(p.features, p.bounds, strict=True)
                            if isinstance(b, frozenset)}
        self.marks = {f: self._marks([b for p in paths for g, b in zip(p.features, p.bounds, strict=True) if g == f])
                      for f in {f for p in paths for f in p.features}}
        self.tables, self.long, group, cells = [], [], [], {}
        for p in paths:
            own = {f: self._passing(f, b)[None] for f, b in zip(p.features, p.bounds, strict=True)}
            if 2 ** len(own) > TABLE_CELLS:
                self.long.append(self._factors(p))
                continue
            joined = {f: np.unique(np.concatenate([part[f] for part in (cells, own) if f in part]), axis=0)
                      for f in {**cells, **own}}
            if group and np.prod([len(np.unique(rows, axis=1).T) for rows in joined.values()]) > TABLE_CELLS:
                self.tables.append(self._table(group, cells))
                group, joined = [], own
            group, cells = [*group, p], joined
        if group:
            self.tables.append(self._table(group, cells))

    @staticmethod
    def _marks(bounds: list) -> np.ndarray:
        """Numbers that part a feature's values: thresholds, or its categories."""
        return np.array(sorted({v for b in bounds for v in b if np.isfinite(v)}))

    def _passing(self, feature: int, bounds) -> np.ndarray:
        """For each place a value may take among the marks: does it pass?"""
        marks = self.marks[feature]
        if isinstance(bounds, frozenset):  # places of the categories, then of any other value
            return np.append(np.isin(marks, list(bounds)), False)
        upper, lower = np.append(marks, np.inf), np.insert(marks, 0, -np.inf)
        return (lower >= bounds[0]) & (upper <= bounds[1])

    def _places(self, feature: int, column: np.ndarray) -> np.ndarray:
        marks = self.marks[feature]
        at = np.searchsorted(marks, column)
        if feature in self.categorical:
            at[(at < len(marks)) & (marks[np.minimum(at, len(marks) - 1)] != column)] = len(marks)
        return at

    @staticmethod
    def _factors(p: Path) -> tuple:
        points, weights = np.polynomial.legendre.leggauss(len(p.features) // 2 + 1)
        t = (points + 1) / 2
        share = np.array(p.shares)
        missed = (1 - t)[:, None] * share  # factor by point and feature where it fails
        return p, weights / 2 * p.value, missed, missed + t[:, None], share

    @staticmethod
    def _added(factors: tuple, ok: list[np.ndarray]) -> list[np.ndarray]:
        """What a path adds to each of its features, from where they pass."""
        p, weights, missed, passed, share = factors
        mean = np.zeros((len(ok), len(ok[0])))  # of the other features' products
        for q, weight in enumerate(weights):
            of_each = [np.where(o, passed[q, j], missed[q, j]) for j, o in enumerate(ok)]
            product = weight * reduce(np.multiply, of_each)  # no factor is zero, so each divides out again
            for j, factor in enumerate(of_each):
                mean[j] += product / factor
        return [(o - share[j]) * mean[j] for j, o in enumerate(ok)]

    def _table(self, group: list[Path], cells: dict[int, np.ndarray]) -> tuple:
        """Sums of the group's paths by cell, and what each feature's places add to a cell's number."""
        steps, kinds, size = [], {}, 1
        for f, rows in cells.items():
            found, kind = np.unique(rows, axis=1, return_inverse=True)
            first = np.unique(kind, return_index=True)[1]
            kinds[f] = (first, size, found.shape[1])
            steps.append((f, (kind.ravel() * size).astype(np.int32)))
            size *= found.shape[1]
        number = np.arange(size)
        place = {f: first[number // step % count] for f, (first, step, count) in kinds.items()}
        sums = np.zeros((self._width(cells), size))
        for p in group:
            ok = [self._passing(f, b)[place[f]] for f, b in zip(p.features, p.bounds, strict=True)]
            self._add(sums, list(cells), p, ok)
        return steps, sums

    @staticmethod
    def _width(cells: dict) -> int:
        return len(cells)

    def _add(self, sums: np.ndarray, order: list[int], p: Path, ok: list[np.ndarray]) -> None:
        """Add what a path adds to each of its features to the sums of a table's cells."""
        for f, added in zip(p.features, self._added(self._factors(p), ok), strict=True):
            sums[order.index(f)] += added

    def of(self, values: np.ndarray) -> np.ndarray:
        """A row of contributions for each row of feature values."""
        found = np.zeros((self.features, len(values)))
        places = {f: self._places(f, values[:, f]) for f in self.marks}
        for steps, sums in self.tables:
            cell = reduce(np.add, [step[places[f]] for f, step in steps])
            for j, (f, _) in enumerate(steps):
                found[f] += sums[j][cell]
        for factors in self.long:
            p = factors[0]
            ok = [self._passing(f, b)[places[f]] for f, b in zip(p.features, p.bounds, strict=True)]
            for f, added in zip(p.features, self._added(factors, ok), strict=True):
                found[f] += added
        return found.T


class Swaps(Attribution):
    """How a forest's prediction changes where a row takes one feature's value from another row.

    Only leaves whose paths ask for the feature change; their tables are looked up for both values.
    """

    @staticmethod
    def _width(cells: dict) -> int:
        return 1

    def _add(self, sums: np.ndarray, order: list[int], p: Path, ok: list[np.ndarray]) -> None:
        sums[0] += p.value * reduce(np.logical_and, ok)

    def changes(self, own: np.ndarray, other: np.ndarray) -> np.ndarray:
        """A row of changes, one for each feature, for each pair of rows."""
        found = np.zeros((self.features, len(own)))
        before, after = ({f: self._places(f, values[:, f]) for f in self.marks} for values in (own, other))
        for steps, sums in self.tables:
            cell = reduce(np.add, [step[before[f]] for f, step in steps])
            plain = sums[0][cell]
            for f, step in steps:
                found[f] += sums[0][cell - step[before[f]] + step[after[f]]] - plain
        for p, *_ in self.long:
            given = dict(zip(p.features, p.bounds, strict=True))
            ok = {f: self._passing(f, b)[before[f]] for f, b in given.items()}
            plain = reduce(np.logical_and, ok.values())
            for f, b in given.items():
                swapped = reduce(np.logical_and, [v for g, v in ok.items() if g != f], self._passing(f, b)[after[f]])
                found[f] += p.value * (swapped.astype(float) - plain)
        return found.T


def is_forest(model) -> bool:
    """A fitted tree, forest or boosting, which ``forest_of`` can read."""
    return isinstance(model, (DecisionTreeRegressionModel, RandomForestRegressionModel, GBTRegressionModel))


def swap_changes(pairs: DataFrame, model, names: Sequence[str], own: str = "own", other: str = "other",
                 count: str = "n") -> DataFrame:
    """Sum of absolute changes by feature over counted pairs of arrays, summed up in each task: feature, total, n."""
    width = len(names)
    swaps = Swaps(forest_of(model), width)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(width), 0
        for b in batches:
            a, o = (b.column(i).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width) for i in (0, 1))
            n = b.column(2).to_numpy()
            for i in range(0, len(n), BLOCK_ROWS):
                at = slice(i, i + BLOCK_ROWS)
                total += n[at] @ np.abs(swaps.changes(a[at], o[at]))
            rows += int(n.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(names)), pa.array(total), pa.array([rows] * width)], names=["feature", "total", "n"])

    return pairs.select(own, other, count).mapInArrow(work, "feature string, total double, n long")


def attributions(df: DataFrame, model, features: str = "features", output: str = "contributions") -> DataFrame:
    """The rows, without their vector columns, with each feature's contribution to the prediction.

    A row's contributions sum to its prediction minus ``expected_value``. Tasks
    look at whole batches of rows and hold the forest's tables beside them.
    """
    width = model.numFeatures
    of = Attribution(forest_of(model), width)  # made once; Spark ships it with the function
    names = [f.name for f in df.schema
             if not isinstance(f.dataType, VectorUDT) and f.name.lower() != output.lower()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            given = b.column(b.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width)
            made = [of.of(given[i:i + BLOCK_ROWS]) for i in range(0, len(given), BLOCK_ROWS)]
            flat = pa.array(np.concatenate(made).ravel() if made else np.zeros(0))
            offsets = pa.array(np.arange(0, b.num_rows * width + 1, width, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.ListArray.from_arrays(offsets, flat)],
                                             names=[*names, output])

    rows = df.select(*(F.col(f"`{c}`") for c in names), vector_to_array(features).alias(output))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]),
                        f"`{output}` array<double>"])
    return rows.mapInArrow(work, schema)


def mean_attributions(df: DataFrame, model, names: Sequence[str], features: str = "features",
                      column: str = "mean_attribution") -> DataFrame:
    """Mean absolute contribution of each feature, in units of the label, largest first.

    Each task sums up its own rows, so that a row per feature and task is shuffled.
    """
    width = len(names)
    of = Attribution(forest_of(model), width)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(width), 0
        for b in batches:
            given = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width)
            for i in range(0, len(given), BLOCK_ROWS):
                total += np.abs(of.of(given[i:i + BLOCK_ROWS])).sum(axis=0)
            rows += b.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(names)), pa.array(total), pa.array([rows] * width)], names=["feature", "total", "n"])

    sums = df.select(vector_to_array(features)).mapInArrow(work, "feature string, total double, n long")
    return sums.groupBy("feature").agg(F.try_divide(F.sum("total"), F.sum("n")).alias(column)) \
        .orderBy(F.desc(column), "feature")
