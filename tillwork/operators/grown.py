"""Random forests of two classes, grown level by level from binned rows (NumPy over Arrow batches).

The forest is that of Spark's ``RandomForestClassifier``: every tree has its own Poisson sample of the rows
(with replacement), every node tries the square root of the features, splits by Gini impurity of weighted
rows lie between bins, and children that predict the same are one leaf. What differs is the order of work. Spark adds
each row to the statistics of all trees at once, which leave the processor's cache with every row; here a task goes
tree by tree over a block of rows of one byte a feature, and one count per tree, node, feature, bin and class
leaves it. Counts are whole numbers, so a forest does not depend on how rows are dealt to tasks.

All rows are read for every level. A row's copies in a tree come from its own number and the tree's, so nothing but
the binned table is kept between levels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators.bins import BINS, seen, thresholds
from tillwork.session import new_path, written

#: Rows that a task holds at once.
BLOCK = 1 << 16
#: Copies of a row in a Poisson sample of mean 1, by 16 random bits.
_COPIES = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]),
                          (np.arange(1 << 16) + 0.5) / (1 << 16)).astype("uint8")


@dataclass
class Tree:
    """Nodes by their place in the full tree: the children of ``i`` are 2 i + 1 and 2 i + 2."""
    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)
    counts: np.ndarray = field(init=False)
    #: Places at the level that is next to be split, and the features that each of them tries.
    open: np.ndarray = field(init=False)
    tried: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        size = 2 ** (self.depth + 1) - 1
        self.feature, self.cut = np.zeros(size, "int64"), np.full(size, 255, "uint8")
        self.gain, self.counts = np.full(size, -1.0), np.zeros((size, 2), "int64")
        self.open, self.tried = np.zeros(1, "int64"), np.zeros((0, 0), "int64")


def copies(numbers: np.ndarray, tree: int) -> np.ndarray:
    """How often each row, given by its number, is in the sample of a tree."""
    h = (numbers + np.uint64((0x9E3779B97F4A7C15 * (tree + 1)) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    return _COPIES[h >> np.uint64(48)]


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """The byte strings of a column, all of one length, as a matrix."""
    if not len(column):
        return np.zeros((0, width), "uint8")
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], "int32")[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], "uint8")[ends[0]:ends[-1]].reshape(len(column), width)


def binned_rows(rows: DataFrame, cuts: Sequence[Sequence[float]], label: str, features: str = "features") -> DataFrame:
    """Columns bins (a byte a feature), label, number (of the row): a table that every level reads."""
    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).flatten().to_numpy().reshape(len(batch), len(cuts))
            found = np.empty(values.shape, "uint8")
            for k, cut in enumerate(cuts):
                found[:, k] = np.searchsorted(np.asarray(cut, "float64"), values[:, k])  # equal goes left
            ends = np.arange(0, found.size + 1, len(cuts), dtype="int32")
            packed = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(ends), pa.py_buffer(found.tobytes())])
            yield pa.RecordBatch.from_arrays([packed, batch.column(1), batch.column(2)], names=["bins", "label", "number"])

    numbered = rows.select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("label"),
                           F.xxhash64(F.monotonically_increasing_id()).alias("number"))
    return written(numbered.mapInArrow(bins, "bins binary, label int, number long"), "binned-rows")


def _counted(trees: list[Tree], level: int, width: int, bootstrap: bool):
    """A function of a task's batches: rows tree, counts (by tried feature, open node, bin, class)."""
    first = 2 ** level - 1
    slots = []
    for tree in trees:
        slot = np.full(2 ** level, -1, "int64")
        slot[tree.open - first] = np.arange(len(tree.open))
        slots.append(slot)

    def add(sums: list[np.ndarray], found: list[tuple]) -> None:
        bins, label, number = (np.concatenate(part) for part in zip(*found))
        n, flat = len(bins), np.ascontiguousarray(bins.T).ravel()
        for t, (tree, slot, total) in enumerate(zip(trees, slots, sums)):
            if not len(tree.open):
                continue
            often = copies(number, t) if bootstrap else np.ones(n, "uint8")
            at = np.flatnonzero(often)
            place, begins = np.zeros(len(at), "int64"), tree.feature * n
            for _ in range(level):
                value = begins.take(place)
                value += at
                right = flat.take(value) > tree.cut.take(place)
                place += place
                place += 1
                place += right
            node = slot.take(place - first)
            if node.size and node.min() < 0:
                inside = np.flatnonzero(node >= 0)
                at, node = at.take(inside), node.take(inside)
            often, begin = often.take(at).astype("float64"), node * (2 * BINS)
            begin += label.take(at)
            for k, total_k in enumerate(total):
                value = (tree.tried[:, k] * n).take(node)
                value += at
                code = flat.take(value).astype("int64")
                code += code
                code += begin
                total_k += np.bincount(code, often, minlength=len(total_k))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whole numbers, held as doubles, as which they are added up.
        sums = [np.zeros((tree.tried.shape[1], len(tree.open) * 2 * BINS)) for tree in trees]
        found, held = [], 0
        for batch in batches:
            found.append((_rows(batch.column(0), width), batch.column(1).to_numpy(), batch.column(2).to_numpy().view("uint64")))
            held += len(batch)
            if held >= BLOCK:
                add(sums, found)
                found, held = [], 0
        if held:
            add(sums, found)
        for t, total in enumerate(sums):
            if total.any():
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([total.astype("int64").tobytes()], pa.binary())], names=["tree", "counts"])

    return count


def best_splits(counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """For counts by tried feature, node, bin, class: which tried feature and bin split each node best, the gain
    (-1 without a split), and the counts left and right of it."""
    left = counts.cumsum(axis=2)
    total = left[:, :, -1:, :]
    right = total - left

    def size_and_impurity(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weighted = part * weights
        size = weighted.sum(axis=-1)
        return size, 1 - ((weighted / np.maximum(size, 1e-300)[..., None]) ** 2).sum(axis=-1)

    (all_size, impurity), (size_l, impurity_l), (size_r, impurity_r) = map(size_and_impurity, (total, left, right))
    gain = impurity - size_l / all_size * impurity_l - size_r / all_size * impurity_r
    gain = np.where((left.sum(axis=-1) > 0) & (right.sum(axis=-1) > 0), gain, -1.0)
    tried, nodes, bins = gain.shape
    flat = gain.transpose(1, 0, 2).reshape(nodes, tried * bins)
    best, every = flat.argmax(axis=1), np.arange(nodes)
    which, cut = best // bins, best % bins
    return which, cut, flat[every, best], left[which, every, cut], right[which, every, cut]


def grow(binned: DataFrame, cuts: Sequence[Sequence[float]], trees: int, depth: int, weights: Sequence[float],
         seed: int, tried: int | None = None, bootstrap: bool = True) -> list[Tree]:
    """Trees of a table of :func:`binned_rows`; ``weights`` are those of the classes."""
    spark, width = binned.sparkSession, len(cuts)
    tried = tried or math.ceil(math.sqrt(width))
    forest, weights = [Tree(depth) for _ in range(trees)], np.asarray(weights, "float64")
    # Each task sends its counts once a level, so tasks are as few as keep every core at work.
    dealt = binned.coalesce(2 * spark.sparkContext.defaultParallelism)
    for level in range(depth):
        for t, tree in enumerate(forest):
            tree.tried = np.array([np.random.default_rng([seed, t, place]).permutation(width)[:tried] for place in tree.open],
                                  "int64").reshape(-1, min(tried, width))
        shapes = [(tree.tried.shape[1], len(tree.open), BINS, 2) for tree in forest]

        def split(parts: pd.DataFrame) -> pd.DataFrame:
            t = int(parts["tree"].iloc[0])
            counts = sum(np.frombuffer(part, "int64") for part in parts["counts"]).reshape(shapes[t])
            which, cut, gain, left, right = best_splits(counts, weights)
            return pd.DataFrame({"tree": t, "node": np.arange(len(cut)), "which": which, "cut": cut, "gain": gain,
                                 "l0": left[:, 0], "l1": left[:, 1], "r0": right[:, 0], "r1": right[:, 1]})

        found = (dealt.mapInArrow(_counted(forest, level, width, bootstrap), "tree int, counts binary")
                 .groupBy("tree").applyInPandas(split, "tree int, node long, which long, cut long, gain double, "
                                                       "l0 long, l1 long, r0 long, r1 long").toPandas())
        for t, rows in found.groupby("tree"):
            _split(forest[t], rows.sort_values("node"), level)
        if not any(len(tree.open) for tree in forest):
            break
    return forest


def _split(tree: Tree, rows: pd.DataFrame, level: int) -> None:
    """Writes the splits of a level into the tree, and opens the children that may be split."""
    left, right = rows[["l0", "l1"]].to_numpy(), rows[["r0", "r1"]].to_numpy()
    tree.counts[tree.open] = left + right
    good = rows["gain"].to_numpy() > 0
    place, left, right = tree.open[good], left[good], right[good]
    tree.feature[place] = tree.tried[good, rows["which"].to_numpy()[good]]
    tree.cut[place], tree.gain[place] = rows["cut"].to_numpy()[good], rows["gain"].to_numpy()[good]
    tree.counts[2 * place + 1], tree.counts[2 * place + 2] = left, right
    children = np.sort(np.concatenate([2 * place + 1, 2 * place + 2]))
    mixed = (tree.counts[children] > 0).all(axis=1)
    tree.open = children[mixed] if level + 1 < tree.depth else children[:0]


def node_rows(tree: Tree, cuts: Sequence[Sequence[float]], weights: Sequence[float]) -> list[tuple]:
    """The nodes in the order and form in which Spark stores a tree; equal leaves are put together."""
    rows: list[tuple] = []

    def stats(place: int) -> tuple[list[float], float, float]:
        sums = [float(n * w) for n, w in zip(tree.counts[place], weights)]
        size = sum(sums) or 1.0
        return sums, float(sums[1] > sums[0]), 1 - sum((s / size) ** 2 for s in sums)

    def leaf(place: int) -> float | None:
        """What the node predicts if it is a leaf, or becomes one as its leaves predict the same."""
        if place not in known:
            a = b = None
            if tree.gain[place] > 0:
                a, b = leaf(2 * place + 1), leaf(2 * place + 2)
            known[place] = stats(place)[1] if tree.gain[place] <= 0 or (a is not None and a == b) else None
        return known[place]

    def add(place: int) -> int:
        sums, prediction, impurity = stats(place)
        at, number = len(rows), int(tree.counts[place].sum())
        rows.append(())
        if leaf(place) is not None:
            rows[at] = (at, prediction, impurity, sums, number, -1.0, -1, -1, (-1, [], -1))
        else:
            feature = int(tree.feature[place])
            children = add(2 * place + 1), add(2 * place + 2)
            rows[at] = (at, prediction, impurity, sums, number, float(tree.gain[place]), *children,
                        (feature, [float(cuts[feature][tree.cut[place]])], -1))
        return at

    known: dict[int, float | None] = {}
    add(0)
    return rows


def fit_forest(estimator: RandomForestClassifier, rows: DataFrame, keys: Sequence[str],
               weights: Sequence[float]) -> RandomForestClassificationModel:
    """What ``estimator`` fits, labels being 0 and 1 and ``weights`` those of the two classes.

    Its columns, trees, depth and seed are used. Thresholds come from as many rows as Spark takes.
    """
    spark, features, label = rows.sparkSession, estimator.getFeaturesCol(), estimator.getLabelCol()
    sample = seen(rows.select(*keys, vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y")),
                  ["x", "y"], keys, estimator.getSeed())
    weighted = [weights[r["y"]] for r in sample]
    cuts = [thresholds(values, weighted) for values in zip(*(r["x"] for r in sample))]
    binned = binned_rows(rows, cuts, label, features)
    forest = grow(binned, cuts, estimator.getNumTrees(), estimator.getMaxDepth(), weights, estimator.getSeed())
    # The form of a stored forest, with all parameters, is that of one fitted to a row of each class.
    row = Vectors.dense([0.0] * len(cuts))
    two = spark.createDataFrame([(row, 0.0, 1.0), (row, 1.0, 1.0)], [features, label, estimator.getWeightCol()])
    path = new_path(spark, "forest")
    estimator.fit(two).write().save(f"{path}/empty")
    for part, read in (("metadata", spark.read.text), ("treesMetadata", spark.read.parquet)):
        getattr(read(f"{path}/empty/{part}").coalesce(1).write, "text" if part == "metadata" else "parquet")(f"{path}/grown/{part}")
    nodes = [(t, node) for t, tree in enumerate(forest) for node in node_rows(tree, cuts, weights)]
    spark.createDataFrame(nodes, spark.read.parquet(f"{path}/empty/data").schema).write.parquet(f"{path}/grown/data")
    return RandomForestClassificationModel.load(f"{path}/grown")
