"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors of cosine c are sqrt(2 - 2c) apart. All vectors are projected onto the leading
principal directions of the whole table, put into grid cells of that width, and sorted by label
and cell (epsilon grid order). The sequence is cut into blocks of bounded size; each knows the
box of its projections. Pairs of intervals are joined recursively: an interval stands for a run
of blocks, and only pairs whose boxes come near enough are opened into their parts, down to
blocks and, inside a task, on to runs of a few rows. What the boxes skip is provably too far
apart; what remains is compared by cosine in double precision.

Equal vectors of a label are one node with a count. A block pair gives back a row per linked
node (number of links, smallest node reached), never the pairs themselves, so that a group of
near copies costs comparisons but no rows.

Defined results: a vector that is null, zero or holds a null or a non-finite number, or whose
label or id is null, links with nothing and is kept; vectors of different lengths do not link;
repeated ids with one vector count as copies, with different ones as different nodes; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tillwork.llm.graph import components
from tillwork.session import written

FAN = 3  # bits: an interval is opened into eight


def _units(rows, width: int) -> np.ndarray:
    """Vectors scaled to length one in double precision, filled up with zeros to ``width``."""
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    largest = np.abs(out).max(axis=1, keepdims=True)
    out /= np.where(largest > 0, largest, 1)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(norm > 0, norm, 1)


def _directions(nodes: DataFrame, width: int, count: int) -> np.ndarray:
    """Leading principal directions of all vectors: width x count numbers reach the driver."""
    def gram(batches):
        total = np.zeros((width, width))
        for batch in batches:
            unit = _units(batch["embedding"], width)
            total += unit.T @ unit
        yield pd.DataFrame({"place": np.arange(width * width), "value": total.ravel()})

    sums = nodes.select("embedding").mapInPandas(gram, "place int, value double").groupBy("place").agg(F.sum("value"))
    matrix = np.zeros(width * width)
    for place, value in sums.collect():
        matrix[place] = value
    return np.linalg.eigh(matrix.reshape(width, width))[1][:, ::-1][:, :count]


def _blocks(nodes: DataFrame, axes: np.ndarray, reach: float, size: int) -> DataFrame:
    """Sort in grid order and number the blocks of every task: columns part, block, at, low, high."""
    width, count = axes.shape

    def cells(batches):
        for batch in batches:
            near = _units(batch["embedding"], width) @ axes
            grid = np.floor(near / reach).astype("int32")
            yield batch.assign(near=list(near), **{f"c{i}": grid[:, i] for i in range(count)})

    grid = [f"c{i}" for i in range(count)]
    kept = [f"{n} {t}" for n, t in nodes.dtypes]
    placed = nodes.mapInPandas(cells, ", ".join([*kept, "near array<double>", *(f"{c} int" for c in grid)]))
    order = ["label", "length", *grid, "rep", "mark"]

    def numbered(batches):
        task, block, filled, last = TaskContext.get().partitionId(), -1, 0, None
        for batch in batches:
            numbers = []
            for key in zip(batch["label"], batch["length"]):
                if key != last or filled == size:
                    block, filled, last = block + 1, 0, key
                filled += 1
                numbers.append(block)
            yield batch.assign(part=task, block=numbers)

    return placed.repartitionByRange(*order).sortWithinPartitions(*order).drop(*grid).mapInPandas(
        numbered, ", ".join([*kept, "near array<double>", "part int", "block int"]))


def _near_blocks(blocks: DataFrame, count: int, reach: float) -> tuple[DataFrame, DataFrame]:
    """Pairs a <= b of blocks whose boxes are within reach, by opening intervals from the root, and
    which block has which number."""
    spark = blocks.sparkSession
    box = ([F.min(F.col("near")[i]).alias(f"low{i}") for i in range(count)]
           + [F.max(F.col("near")[i]).alias(f"high{i}") for i in range(count)])
    boxes = blocks.groupBy("part", "block").agg(F.first("label").alias("label_low"), F.first("label").alias("label_high"), *box)
    sizes = boxes.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("part", F.coalesce(F.sum("n").over(  # a row per task of the sort
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    leaves = written(boxes.join(starts, "part").withColumn("id", F.col("start") + F.col("block")), "vector-boxes")
    top = leaves.agg(F.max("id")).first()[0]
    merged = ([F.min("label_low").alias("label_low"), F.max("label_high").alias("label_high")]
              + [F.min(f"low{i}").alias(f"low{i}") for i in range(count)]
              + [F.max(f"high{i}").alias(f"high{i}") for i in range(count)])
    levels = [leaves.drop("part", "block", "start")]
    while top is not None and top > 0:
        top >>= FAN
        levels.append(levels[-1].groupBy(F.shiftright("id", FAN).alias("id")).agg(*merged))
    pairs = spark.createDataFrame([(0, 0)], "a long, b long")
    for level in reversed(levels[:-1]):
        def side(name: str, level=level) -> DataFrame:
            return level.select(F.shiftright("id", FAN).alias(name), *(
                F.col(c).alias(f"{name}_{c}") for c in level.columns))
        gap = [F.greatest(F.col(f"a_low{i}") - F.col(f"b_high{i}"), F.col(f"b_low{i}") - F.col(f"a_high{i}"), F.lit(0.0))
               for i in range(count)]
        near = sum((g * g for g in gap[1:]), gap[0] * gap[0]) <= reach * reach
        pairs = (pairs.join(side("a"), "a").join(side("b"), "b")
                 .where((F.col("a_id") <= F.col("b_id")) & near & (F.col("a_label_low") <= F.col("b_label_high"))
                        & (F.col("b_label_low") <= F.col("a_label_high")))
                 .select(F.col("a_id").alias("a"), F.col("b_id").alias("b")))
    names = leaves.select("id", "part", "block")
    return pairs, names


def _linker(cosine: float, reach: float, width: int, leaf: int = 128):
    def links(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["side", "row"], kind="stable").reset_index(drop=True)
        unit, near = _units(group["embedding"], width), np.array(group["near"].tolist())
        length, weight = group["length"].to_numpy(), group["copies"].to_numpy()
        split = int((group["side"] == 0).sum())
        alone = bool((group["a"] == group["b"]).all())  # a block with itself
        total, parent = np.zeros(len(group), "int64"), np.arange(len(group))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            return i

        def join(a0: int, a1: int, b0: int, b1: int) -> None:
            a, b = near[a0:a1], near[b0:b1]
            gap = np.maximum(0, np.maximum(a.min(0) - b.max(0), b.min(0) - a.max(0)))
            if gap @ gap > reach * reach:
                return
            if max(a1 - a0, b1 - b0) > leaf:
                if a1 - a0 >= b1 - b0 and not (alone and a0 == b0):
                    middle = (a0 + a1) // 2
                    join(a0, middle, b0, b1)
                    join(middle, a1, b0, b1)
                elif alone and a0 == b0:
                    middle = (a0 + a1) // 2
                    join(a0, middle, a0, middle)
                    join(a0, middle, middle, a1)
                    join(middle, a1, middle, a1)
                else:
                    middle = (b0 + b1) // 2
                    join(a0, a1, b0, middle)
                    join(a0, a1, middle, b1)
                return
            close = unit[a0:a1] @ unit[b0:b1].T >= cosine
            close &= length[a0:a1, None] == length[None, b0:b1]
            if alone and a0 == b0:
                close = np.triu(close, 1)
            for i, j in zip(*np.nonzero(close)):
                i, j = a0 + i, b0 + j
                total[i] += weight[j]
                total[j] += weight[i]
                x, y = root(i), root(j)
                if x != y:
                    parent[max(x, y)] = min(x, y)

        if alone:
            join(0, split, 0, split)
        elif split:
            join(0, split, split, len(group))
        rows = np.flatnonzero(total)
        low = np.array([root(i) for i in rows], dtype="int64")
        return pd.DataFrame({"rep": group["rep"].to_numpy()[rows], "mark": group["mark"].to_numpy()[rows],
                             "links": total[rows], "low_rep": group["rep"].to_numpy()[low] if len(low) else [],
                             "low_mark": group["mark"].to_numpy()[low] if len(low) else []})
    return links


def near_vectors(table: DataFrame, cosine: float = 0.98, directions: int = 6, block: int = 1024,
                 id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """Columns: id, n_links, component_id (smallest id reached), kept."""
    if not 0 < cosine <= 1:
        raise ValueError("the cosine must be above 0 and at most 1")
    reach = float(np.sqrt(2 - 2 * cosine)) + 1e-7
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = table.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"),
                        F.col(vector_column).cast("array<double>").alias("embedding"))
    usable = F.coalesce(finite & F.exists("embedding", lambda v: v != 0), F.lit(False)) & F.col("label").isNotNull() & F.col("id").isNotNull()
    good = rows.where(usable)
    nodes = written(good.groupBy("label", "embedding").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
                    .withColumn("mark", F.xxhash64("label", "embedding")).withColumn("length", F.size("embedding")), "vectors")
    width = nodes.agg(F.max("length")).first()[0] or 1
    count = min(directions, width)
    blocks = written(_blocks(nodes, _directions(nodes, width, count), reach, block)
                     .withColumn("row", F.monotonically_increasing_id()), "vector-blocks")
    pairs, names = _near_blocks(blocks, count, reach)
    pairs = written(pairs, "vector-block-pairs")
    sides = pairs.select("a", "b", F.lit(0).alias("side"), F.col("a").alias("id")).unionByName(
        pairs.where("a != b").select("a", "b", F.lit(1).alias("side"), F.col("b").alias("id")))
    kind = table.schema[id_column].dataType.simpleString()
    met = (sides.join(names, "id").join(blocks.drop("label"), ["part", "block"]).groupBy("a", "b").applyInPandas(
        _linker(cosine, reach, width), f"rep {kind}, mark long, links long, low_rep {kind}, low_mark long"))
    met = written(met, "vector-links")
    node, low = F.struct(F.col("rep").alias("rep"), F.col("mark").alias("mark")), F.struct(
        F.col("low_rep").alias("rep"), F.col("low_mark").alias("mark"))
    groups = components(met.select(node.alias("a"), low.alias("b")))
    linked = met.groupBy("rep", "mark").agg(F.sum("links").alias("links"))
    known = (nodes.select("label", "embedding", "rep", "mark", "copies")
             .join(linked, ["rep", "mark"], "left")
             .join(groups.select("node.rep", "node.mark", F.col("component.rep").alias("low")), ["rep", "mark"], "left")
             .select("label", "embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("low", "rep").alias("component_id")))
    out = (good.join(known, ["label", "embedding"]).select("id", "n_links", "component_id")
           .unionByName(rows.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))))
    return out.select(F.col("id").alias(id_column), "n_links", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
