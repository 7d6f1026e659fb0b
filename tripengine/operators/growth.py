"""Trees over many rows, grown level by level from sums over blocks of binned rows.

Rows are binned once: a block holds some thousand rows as one code a column and
their label. A level is one pass over the blocks. Each task sums counts and
labels by node and code, the sums of a few nodes meet in one place, and splits
are picked there: in tasks, so that the driver gets a row for each split, or on
the driver where all sums are small. The model is written in Spark's own form and loaded, so it is a Spark model as any other.

Bins are those of Spark's trees: each value has its own where they are few, as
do categories, others are parted by quantiles, here of all rows. Columns that
are never set together, as those of a one-hot code, share one code.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from math import prod
from threading import Lock
from typing import NamedTuple
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripengine.session import materialise, scratch

#: Rows in a block at least, and nodes whose sums meet in one task.
BLOCK_ROWS, NODES = 16_384, 64
#: Sums of all tasks that the driver takes at once; more meet in tasks.
DRIVER_BYTES = 64 << 20
#: The deepest trees grown here: a task holds sums for each node of a level.
DEEPEST = 10
#: How often a forest's tree draws a row, by a 16-bit random number.
POISSON = np.searchsorted(np.cumsum(1 / (np.e * np.cumprod([1, *range(1, 12)]))),
                          (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)
#: Of a node's spread, what a split must at least explain to be more than rounding.
LEAST_GAIN = 1e-12


class Bins(NamedTuple):
    edges: list[np.ndarray]  # thresholds of each feature, empty where it has categories or never changes
    categories: dict[int, int]  # number of categories by feature
    columns: list[list[int]]  # features of each code; several are yes-or-no and never set together
    sizes: list[int]  # codes of each column
    many: bool  # is there a feature of more values than bins?

    @property
    def width(self) -> int:
        return sum(self.sizes)


class Split(NamedTuple):
    feature: int
    threshold: float
    left: list[int] | None  # categories that go left
    column: int
    mask: np.ndarray  # of the column's codes, those that go left
    gain: float
    sides: np.ndarray  # count, sum and sum of squares of both sides


class Tree:
    """A tree in growth: sums of each node, its split and its children."""

    def __init__(self):
        self.sums, self.splits, self.children, self.open = [np.zeros(3)], [None], [(-1, -1)], [0]

    def part(self, node: int, split: Split) -> list[int]:
        first = len(self.sums)
        self.sums += list(split.sides)
        self.splits += [None, None]
        self.children += [(-1, -1), (-1, -1)]
        self.splits[node], self.children[node] = split, (first, first + 1)
        return [first, first + 1]

    def tables(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Column asked by each node, the node that follows each code, and the place among open nodes."""
        column = np.array([0 if s is None else s.column for s in self.splits], np.int64)
        follow = np.repeat(np.arange(len(column), dtype=np.int64)[:, None], width, axis=1)
        for node, split in enumerate(self.splits):
            if split is not None:
                left, right = self.children[node]
                follow[node, :len(split.mask)] = np.where(split.mask, left, right)
        place = np.full(len(column), -1, np.int64)
        place[self.open] = np.arange(len(self.open))
        return column, follow.ravel(), place

    @property
    def values(self) -> np.ndarray:
        return np.array([s[1] / s[0] if s[0] else 0.0 for s in self.sums])


def can_grow(estimator, df: DataFrame) -> bool:
    """Are the estimator's settings those that are known here?"""
    def get(name, other):
        return estimator.getOrDefault(name) if estimator.hasParam(name) else other

    known = {"minInstancesPerNode": 1, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0, "subsamplingRate": 1.0,
             "impurity": "variance", "lossType": "squared"}
    asked = any(estimator.hasParam(p) and estimator.isDefined(p) and estimator.getOrDefault(p)
                for p in ("weightCol", "validationIndicatorCol"))
    nominal = _categories(df, estimator.getFeaturesCol())
    strategy = get("featureSubsetStrategy", "all")
    return (not asked and all(get(k, v) == v for k, v in known.items()) and estimator.getMaxDepth() <= DEEPEST
            and estimator.getMaxBins() <= 255 and max(nominal.values(), default=0) <= estimator.getMaxBins()
            and strategy in (("auto", "all") if isinstance(estimator, RandomForestRegressor) else ("all",)))


def _categories(df: DataFrame, features: str) -> dict[int, int]:
    attributes = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    found = {a["idx"]: len(a["vals"]) if "vals" in a else a.get("num_vals", 256) for a in attributes.get("nominal", [])}
    return found | {a["idx"]: 2 for a in attributes.get("binary", [])}


def _vectors(b: pa.RecordBatch) -> np.ndarray:
    """A row of features for each row of a batch whose first column are arrays."""
    return b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)


def describe(rows: DataFrame, categories: dict[int, int], most: int) -> Bins | None:
    """Bins of arrays ``x`` with label ``y``; none where a value or label is missing."""
    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, both, odd = None, 0, False
        for b in batches:
            if not b.num_rows:
                continue
            x = _vectors(b)
            odd = odd or b.column(1).null_count > 0 or bool(np.isnan(x).any())
            values = [np.zeros(0)] * x.shape[1] if values is None else values
            values = [v if len(v) > most else _more(v, c)[:most + 1] for v, c in zip(values, x.T, strict=True)]
            set_ = (x != 0).astype(np.float32)
            both = both + (set_.T @ set_).astype(np.float64)
        if values is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([values], pa.list_(pa.list_(pa.float64()))), pa.array([both.ravel()], pa.list_(pa.float64())),
                 pa.array([odd])], names=["values", "both", "odd"])

    found = rows.mapInArrow(seen, "values array<array<double>>, both array<double>, odd boolean").collect()
    if any(r.odd for r in found):
        return None
    values = [np.unique(np.concatenate(own)) for own in zip(*[r["values"] for r in found], strict=True)]
    together = sum(np.array(r["both"]) for r in found).reshape(len(values), -1)
    many = [f for f, v in enumerate(values) if f not in categories and len(v) > most]
    quantiles = {}
    if many:
        shares = ", ".join(f"{i / most}D" for i in range(1, most))
        got = rows.agg(*[F.expr(f"percentile_approx(x[{f}], array({shares}), 10000)").alias(str(f)) for f in many])
        quantiles = {f: np.unique(own) for f, own in zip(many, got.first(), strict=True)}
    edges = [np.zeros(0) if f in categories else quantiles[f] if f in quantiles else (v[1:] + v[:-1]) / 2
             for f, v in enumerate(values)]
    columns: list[list[int]] = []
    sizes: list[int] = []
    for f, v in enumerate(values):
        if f not in categories and len(v) == 2 and v[0] == 0:  # a share of a code that others have, too
            for c, others in enumerate(columns):
                if sizes[c] < 255 and all(_yes_or_no(values[g], g, categories) and together[f, g] == 0 for g in others):
                    others.append(f)
                    sizes[c] = len(others) + 1
                    break
            else:
                columns.append([f])
                sizes.append(2)
        elif f in categories or len(edges[f]):
            columns.append([f])
            sizes.append(categories.get(f, len(edges[f]) + 1))
    return Bins(edges, categories, columns, sizes, bool(many))


def _more(known: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Known values and those of a column; only new ones are sorted."""
    if len(known):
        column = column[known[np.minimum(np.searchsorted(known, column), len(known) - 1)] != column]
    return np.union1d(known, column) if len(column) else known


def _yes_or_no(values: np.ndarray, feature: int, categories: dict[int, int]) -> bool:
    return feature not in categories and len(values) == 2 and values[0] == 0


def blocks(rows: DataFrame, bins: Bins) -> DataFrame:
    """The rows as stored blocks: a number, codes by column, and labels. A few batches make a block."""
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        held, count = [], 0
        for b in batches:
            x = _vectors(b)
            codes = np.zeros((len(bins.columns), b.num_rows), np.uint8)
            for c, features in enumerate(bins.columns):
                for j, f in enumerate(features):
                    if len(features) > 1:
                        codes[c][x[:, f] > bins.edges[f][0]] = j + 1
                    else:
                        codes[c] = x[:, f] if f in bins.categories else np.searchsorted(bins.edges[f], x[:, f])
            held.append((codes, b.column(1).to_numpy()))
            count += b.num_rows
            if count >= BLOCK_ROWS:
                yield _joined((part << 32) + made, held)
                made, held, count = made + 1, [], 0
        if count:
            yield _joined((part << 32) + made, held)

    return materialise(rows.mapInArrow(coded, "block long, codes binary, label binary"), "blocks")


def _joined(number: int, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    codes, labels = zip(*held, strict=True)
    return _block(number, np.concatenate(codes, axis=1), np.concatenate(labels))


def _block(number: int, codes: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([codes.tobytes()], pa.binary()), pa.array([label.tobytes()], pa.binary())],
        names=["block", "codes", "label"])


def _read(b: pa.RecordBatch, columns: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for number, codes, label in zip(*(c for c in b.columns[:3]), strict=True):
        yield (number.as_py(), np.frombuffer(codes.as_buffer(), np.uint8).reshape(columns, -1),
               np.frombuffer(label.as_buffer(), np.float64))


def _nodes_of(codes: np.ndarray, rows: np.ndarray, tables: tuple, width: int, levels: int) -> np.ndarray:
    """The node of a tree that each of the rows has come to."""
    column, follow, _ = tables
    flat, n = codes.ravel(), codes.shape[1]
    at = np.zeros(len(rows), np.int64)
    for _ in range(levels):
        at = follow[at * width + flat[column[at] * n + rows]]
    return at


def level(table: DataFrame, bins: Bins, trees: Sequence[Tree], depth: int, last: bool, seed: int,
          draws: bool, drawn: int) -> list[tuple[int, int, np.ndarray, Split | None]]:
    """Sums and best split of each open node: tree, node, sums, split."""
    width, span = max(bins.sizes, default=1), bins.width
    tables = {t: tree.tables(width) for t, tree in enumerate(trees) if tree.open}
    opened = {t: list(trees[t].open) for t in tables}
    starts = np.cumsum([0, *bins.sizes])
    kinds = 3 if last else 2  # squares are asked for the leaves that come of this level only
    ended = {t: any(s is None and n not in own for n, s in enumerate(trees[t].splits))
             for t, own in ((t, set(o)) for t, o in opened.items())}

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {t: np.zeros((len(own), kinds * span + 3)) for t, own in opened.items()}
        for b in batches:
            for number, codes, label in _read(b, len(bins.columns)):
                for t in tables:
                    weight, rows = None, np.arange(len(label))
                    if draws:
                        draw = np.random.Generator(np.random.PCG64([seed, t, number]))
                        weight = POISSON[draw.integers(0, len(POISSON), len(label), np.uint16)]
                        rows = np.flatnonzero(weight)
                    place = tables[t][2][_nodes_of(codes, rows, tables[t], width, depth)]
                    if ended[t]:
                        here = place >= 0
                        rows, place = rows[here], place[here]
                    y = label[rows]
                    w = None if weight is None else weight[rows].astype(np.float64)
                    wy = y if w is None else w * y
                    given = [w, wy, wy * y]
                    own, k = sums[t], len(opened[t])
                    for i, v in enumerate(given):
                        own[:, kinds * span + i] += np.bincount(place, v, k)
                    whole = len(rows) == len(label)
                    for c, size in enumerate(bins.sizes):
                        key = place * size + (codes[c] if whole else codes[c][rows])
                        for i, v in enumerate(given[:kinds]):
                            at = i * span + starts[c]
                            own[:, at:at + size] += np.bincount(key, v, k * size).reshape(k, size)
        for t, own in sums.items():
            for i in range(0, len(own), NODES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t], pa.int32()), pa.array([i], pa.int32()),
                     pa.array([own[i:i + NODES].tobytes()], pa.binary())], names=["tree", "first", "sums"])

    def parted(group: pa.Table) -> pa.Table:
        t, first = group.column("tree")[0].as_py(), group.column("first")[0].as_py()
        total = sum(np.frombuffer(v.as_buffer(), np.float64) for v in group.column("sums"))
        out = []
        for i, own in enumerate(total.reshape(-1, kinds * span + 3)):
            node = opened[t][first + i]
            some = range(len(bins.edges))
            if drawn < len(bins.edges):
                some = np.random.Generator(np.random.PCG64([seed, t, node, 1])).choice(
                    len(bins.edges), drawn, replace=False)
            stats = np.zeros((3, span))
            stats[:kinds] = own[:kinds * span].reshape(kinds, span)
            split = best_split(bins, stats, own[-3:], set(map(int, some)))
            out.append({"tree": t, "node": node, "sums": own[-3:].tolist(), "feature": -1} if split is None else
                       {"tree": t, "node": node, "sums": own[-3:].tolist(), "feature": split.feature,
                        "threshold": split.threshold, "lefts": split.left, "place": split.column,
                        "mask": split.mask.tolist(), "gain": split.gain, "sides": split.sides.ravel().tolist()})
        return pa.Table.from_pylist(out, pa.schema([
            ("tree", pa.int32()), ("node", pa.int32()), ("sums", pa.list_(pa.float64())), ("feature", pa.int32()),
            ("threshold", pa.float64()), ("lefts", pa.list_(pa.int32())), ("place", pa.int32()),
            ("mask", pa.list_(pa.bool_())), ("gain", pa.float64()), ("sides", pa.list_(pa.float64()))]))

    partial = table.mapInArrow(summed, "tree int, first int, sums binary")
    held = 8 * (kinds * span + 3) * sum(map(len, opened.values())) * table.rdd.getNumPartitions()
    if held <= DRIVER_BYTES:  # few sums are met without a shuffle
        got = partial.toArrow()
        met = [r for t, first in sorted({*zip(got["tree"].to_pylist(), got["first"].to_pylist(), strict=True)})
               for r in parted(got.filter((pc.field("tree") == t) & (pc.field("first") == first))).to_pylist()]
    else:
        met = partial.groupBy("tree", "first").applyInArrow(
            parted, "tree int, node int, sums array<double>, feature int, threshold double, lefts array<int>, "
                    "place int, mask array<boolean>, gain double, sides array<double>").toArrow().to_pylist()
    return [(r["tree"], r["node"], np.array(r["sums"]), None if r["feature"] < 0 else Split(
        r["feature"], r["threshold"], r["lefts"], r["place"], np.array(r["mask"]), r["gain"],
        np.array(r["sides"]).reshape(2, 3))) for r in met]


def best_split(bins: Bins, stats: np.ndarray, whole: np.ndarray, some: set[int]) -> Split | None:
    """The split of most gain out of sums by code (count, sum, squares), the first feature of equal ones."""
    n, s, q = whole
    spread = q - s * s / n if n else 0.0
    found: Split | None = None
    least, start = LEAST_GAIN * abs(q), 0
    for c, (features, size) in enumerate(zip(bins.columns, bins.sizes, strict=True)):
        own = stats[:, start:start + size]
        start += size
        if not some & set(features):
            continue
        order = np.arange(size)
        if len(features) > 1:  # unset goes left
            right = own[:, 1:]
            left = whole[:, None] - right
        else:
            if features[0] in bins.categories:
                order = np.argsort(np.where(own[0] > 0, own[1] / np.maximum(own[0], 1e-300), np.inf), kind="stable")
            left = np.cumsum(own[:, order], axis=1)[:, :-1]
            right = whole[:, None] - left
        with np.errstate(divide="ignore", invalid="ignore"):
            explained = left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - s * s / n
        explained = np.where((left[0] > 0.5) & (right[0] > 0.5), explained, -np.inf)
        if len(features) > 1:
            explained = np.where(np.isin(features, list(some)), explained, -np.inf)
        if not explained.size:
            continue
        k = int(np.argmax(explained))
        gain, feature = float(explained[k]), features[k] if len(features) > 1 else features[0]
        if gain <= least or spread <= least or found is not None and (gain, -feature) <= (
                found.gain * n, -found.feature):
            continue
        mask = np.zeros(size, bool)
        if len(features) > 1:
            mask[:] = True
            mask[k + 1] = False
            threshold, lefts = float(bins.edges[feature][0]), None
        else:
            mask[order[:k + 1]] = True
            lefts = sorted(map(int, order[:k + 1])) if feature in bins.categories else None
            threshold = 0.0 if lefts is not None else float(bins.edges[feature][k])
        found = Split(feature, threshold, lefts, c, mask, gain / n, np.stack([left[:, k], right[:, k]]))
    return found


def grow(table: DataFrame, bins: Bins, count: int, depth: int, seed: int, draws: bool, drawn: int) -> list[Tree]:
    """Trees side by side, a pass for each level."""
    trees = [Tree() for _ in range(count)]
    for at in range(depth):
        if not any(t.open for t in trees):
            break
        found = level(table, bins, trees, at, at == depth - 1, seed, draws, drawn)
        for t in trees:
            t.open = []
        for t, node, sums, split in sorted(found, key=lambda r: r[:2]):
            trees[t].sums[node] = sums
            if split is not None:
                trees[t].open += trees[t].part(node, split)
    return trees


def _residuals(table: DataFrame, bins: Bins, tree: Tree, first: bool, rate: float) -> DataFrame:
    """The blocks with what boosting leaves to the next tree: twice the label minus the prediction so far."""
    width, columns, values = max(bins.sizes, default=1), len(bins.columns), tree.values
    tables, levels = tree.tables(width), _depth(tree)

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, codes, label in _read(b, columns):
                seen = values[_nodes_of(codes, np.arange(len(label)), tables, width, levels)]
                yield _block(number, codes, 2 * (label - seen) if first else label - 2 * rate * seen)

    return table.mapInArrow(left, "block long, codes binary, label binary")


def _depth(tree: Tree) -> int:
    deep = [0] * len(tree.sums)
    for node, pair in enumerate(tree.children):
        for child in pair:
            if child >= 0:
                deep[child] = deep[node] + 1
    return max(deep)


#: Bins and blocks of tables that several models are fitted on.
_made: WeakKeyDictionary[DataFrame, dict] = WeakKeyDictionary()
_locks: WeakKeyDictionary[DataFrame, Lock] = WeakKeyDictionary()
_one = Lock()


def _prepared(df: DataFrame, features: str, label: str, most: int, few: int) -> tuple[Bins | None, DataFrame | None]:
    """Bins and stored blocks of a table, made once for all its models; no blocks for up to ``few`` cells."""
    with _one:
        lock, made = _locks.setdefault(df, Lock()), _made.setdefault(df, {})
    with lock:
        rows = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
        kinds, table = (features, label, most), (features, label, most, "blocks")
        if kinds not in made:
            made[kinds] = describe(rows, _categories(df, features), most)
        bins = made[kinds]
        if bins is None or not bins.columns or not bins.many and prod(bins.sizes) <= few:
            return bins, None
        if table not in made or not _there(made[table]):
            made[table] = blocks(rows, bins)
        return bins, made[table]


def _there(table: DataFrame) -> bool:
    return all(at.getFileSystem(conf).exists(at) for conf, at in _folders(table))


def _remove(table: DataFrame) -> None:
    """End a stored table that nothing reads any more."""
    for conf, at in _folders(table):
        at.getFileSystem(conf).delete(at, True)


def _folders(table: DataFrame) -> list[tuple]:
    spark = table.sparkSession
    return [(spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path(path))
            for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}]


def fit(estimator, df: DataFrame, few: int = 0):
    """The estimator's model, or none where a value or label is missing, no feature ever
    changes, or rows have up to ``few`` combinations of values."""
    bins, table = _prepared(df, estimator.getFeaturesCol(), estimator.getLabelCol(), estimator.getMaxBins(), few)
    if table is None:
        return None
    depth, count, seed = estimator.getMaxDepth(), len(bins.edges), abs(estimator.getSeed())
    if not isinstance(estimator, GBTRegressor):
        forest = isinstance(estimator, RandomForestRegressor)
        several = forest and estimator.getNumTrees() > 1
        draws = several and estimator.getBootstrap()
        drawn = -(-count // 3) if several and estimator.getFeatureSubsetStrategy() == "auto" else count
        trees = grow(table, bins, estimator.getNumTrees() if forest else 1, depth, seed, draws, drawn)
        return _model(estimator, trees, [1.0] * len(trees), bins, df.sparkSession)
    trees, rate, left = [], estimator.getStepSize(), table
    for i in range(estimator.getMaxIter()):
        trees += grow(left, bins, 1, depth, seed, False, count)
        if i + 1 < estimator.getMaxIter():
            before, left = left, materialise(_residuals(left, bins, trees[-1], i == 0, rate), "residuals")
            if i:
                _remove(before)
    return _model(estimator, trees, [1.0] + [rate] * (len(trees) - 1), bins, df.sparkSession)


def _model(estimator, trees: Sequence[Tree], weights: Sequence[float], bins: Bins, spark):
    """Grown trees as a Spark model: one fitted on two rows is saved, and its nodes are replaced."""
    features, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    many = {"numTrees": 2} if isinstance(estimator, RandomForestRegressor) else \
        {"maxIter": 1} if isinstance(estimator, GBTRegressor) else None
    two = spark.createDataFrame([([0.0] * len(bins.edges), 0.0), ([1.0] * len(bins.edges), 1.0)],
                                f"`{features}` array<double>, `{label}` double").coalesce(1)
    small = estimator.copy({estimator.getParam(k): v for k, v in (many or {}).items()}).fit(
        two.withColumn(features, array_to_vector(features)))
    path, out = scratch(spark, "model"), scratch(spark, "model")
    small.save(path)
    schema = spark.read.parquet(f"{path}/data").schema
    meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    nodes = [(t, row) for t, tree in enumerate(trees) for row in _rows(tree, bins)]
    if many is None:
        given = [row for _, row in nodes]
    else:
        given = nodes
        name = next(iter(many))
        meta["paramMap"][name] = estimator.getOrDefault(name)
        meta["numTrees"] = len(trees)
        of_trees = spark.read.parquet(f"{path}/treesMetadata")
        first = of_trees.first()
        spark.createDataFrame([(t, first[1], w) for t, w in enumerate(weights)], of_trees.schema).coalesce(1) \
            .write.parquet(f"{out}/treesMetadata")
    spark.createDataFrame(given, schema).coalesce(1).write.parquet(f"{out}/data")
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{out}/metadata")
    return type(small).load(out)


def _rows(tree: Tree, bins: Bins) -> list[tuple]:
    """A tree's nodes in preorder, as Spark saves them."""
    order, stack = [], [0]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in reversed(tree.children[node]) if c >= 0]
    number = {node: i for i, node in enumerate(order)}
    rows, values = [], tree.values
    for node in order:
        n, s, q = map(float, tree.sums[node])
        split = tree.splits[node]
        left, right = (number[c] if c >= 0 else -1 for c in tree.children[node])
        asked = (-1, [], -1) if split is None else \
            (split.feature, [split.threshold], -1) if split.left is None else \
            (split.feature, [float(v) for v in split.left], bins.categories[split.feature])
        rows.append((number[node], float(values[node]), max(q - s * s / n, 0.0) / n if n else 0.0, [n, s, q],
                     round(n), -1.0 if split is None else split.gain, left, right, asked))
    return rows
