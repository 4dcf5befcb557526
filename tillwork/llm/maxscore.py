"""Exact top-k by integer inner product with MaxScore.

Vectors become integers (floor of ``scale`` times each component). A dimension is a term, its
posting list in a shard is that component of the shard's rows, its bound for a query the most it
can add there. A shard's rows are read in runs by ascending id. For each run and query the
terms are ordered by bound; the largest tail of terms whose bounds together do not exceed the score to beat
is non-essential. The essential postings are traversed for all rows of the run; then the other
terms are probed, largest bound first, only for rows that are still competitive. A run whose
bounds together do not beat the score is skipped. The best rows of all shards are merged.

Rows are dealt into shards and queries into blocks of bounded size, and every shard meets every
block in a task of its own: memory is bounded and no task sees more than one shard and one block.
Arithmetic is exact: 32-bit or 64-bit floating point where all sums are proven to be integers
below 2^24 or 2^53, whole numbers of any size else.

Defined results: vectors that are null or hold a null or non-finite component take no part, the
empty vector does; a shorter vector is filled up with zeros; every row is a candidate for every
query but itself, so rows that repeat an id, a vector or both count each, and a repeated query row is a
query again; ties go to the smaller id, a null id last, and then to the earlier row; scores beyond 64
bits count as the nearest 64-bit number; a table without queries or candidates gives no rows;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tillwork.session import written

RUN = 4096  # rows of a shard that share one set of bounds
LIMIT = 1 << 63
PROBE = 6  # terms that are probed before rows are dropped again


def quantised(vectors, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) for each component, as whole numbers in doubles or, beyond 2^53, in objects."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    with np.errstate(over="ignore"):
        scaled = np.floor(out * scale)
    if len(out) and not np.abs(scaled).max(initial=0) < 2.0 ** 53:
        whole = np.abs(out) >= 2.0 ** 53 / scale  # then scale * x needs more digits than a double has
        return np.array([[int(x) * scale + int(np.floor((x - np.trunc(x)) * scale)) if w else int(s) for x, s, w in zip(a, b, c)]
                         for a, b, c in zip(out, scaled, whole)], dtype=object).reshape(out.shape)
    return scaled


def _common_type(x: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cheapest type in which every partial sum of every product is exact."""
    if x.dtype != object and q.dtype != object:
        most = np.abs(q).sum(axis=1).max(initial=0) * np.abs(x).max(initial=0)
        if most < 2.0 ** 24:
            return x.astype("float32"), q.astype("float32")
        if most < 2.0 ** 53:
            return x, q
    whole = np.vectorize(int, otypes=[object])
    return (whole(x) if x.size else x.astype(object)), (whole(q) if q.size else q.astype(object))


def best_rows(x: np.ndarray, q: np.ndarray, own: np.ndarray, k: int, run: int = RUN) -> tuple[list, list]:
    """For each query the places (ascending ids first) and scores of its ``k`` best rows of ``x``.

    ``own`` is the place of the query itself among the rows, or -1.
    """
    x, q = _common_type(x, q)
    best = [np.zeros(0, "int64")] * len(q)
    scores = [np.zeros(0, x.dtype)] * len(q)
    for at in range(0, len(x), run):
        postings = np.ascontiguousarray(x[at:at + run].T)
        high, low = postings.max(axis=1), postings.min(axis=1)
        bounds = np.maximum(q * high, q * low)
        order = np.argsort(-bounds, axis=1, kind="stable")
        ranked = np.take_along_axis(bounds, order, axis=1)
        # rest[:, j]: the most that all terms from the j-th on can add; exact, as sums of whole numbers are.
        rest = np.concatenate([np.cumsum(ranked[:, ::-1], axis=1)[:, ::-1], np.zeros((len(q), 1), ranked.dtype)], axis=1)
        for i in range(len(q)):
            beat = scores[i][-1] if len(scores[i]) == k else -np.inf
            if not rest[i, 0] > beat:
                continue  # no row of this run can be better; equal ones have larger ids
            tail = np.flatnonzero(rest[i] > beat)  # the terms from `essential` on cannot beat it on their own
            essential = int(tail[-1]) + 1 if len(tail) else 0
            essential = min(max(essential, 1), q.shape[1])
            terms = order[i]
            part = q[i, terms[:essential]] @ postings[terms[:essential]]
            rows = np.flatnonzero(part + rest[i, essential] > beat)
            if own[i] >= at:
                rows = rows[rows + at != own[i]]
            part = part[rows]
            for j in range(essential, q.shape[1], PROBE):
                if not len(rows):
                    break
                probed = terms[j:j + PROBE]
                part = part + q[i, probed] @ postings[probed[:, None], rows]
                left = part + rest[i, min(j + PROBE, q.shape[1])] > beat
                rows, part = rows[left], part[left]
            if len(rows):
                if part.dtype == object:
                    part = np.array([min(max(v, -LIMIT), LIMIT - 1) for v in part], dtype=object)
                places, values = np.concatenate([best[i], rows + at]), np.concatenate([scores[i], part])
                if len(values) > 4 * k and values.dtype != object:
                    most = np.partition(values, len(values) - k)[len(values) - k]
                    places, values = places[values >= most], values[values >= most]
                first = np.lexsort((places, -values))[:k] if values.dtype != object else np.array(
                    sorted(range(len(values)), key=lambda n: (-values[n], places[n]))[:k], "int64")
                best[i], scores[i] = places[first], values[first]
    return best, scores


def _searcher(k: int, scale: int):
    def search(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "row"], na_position="last", kind="stable")
        rows, queries = group[~group["asks"]], group[group["asks"]]
        width = max(map(len, group["vector"]), default=0)
        if not len(rows) or not len(queries):
            width = 0
        place = {row: n for n, row in enumerate(rows["row"])}
        own = np.array([place.get(row, -1) for row in queries["row"]], "int64")
        if width:
            best, scores = best_rows(quantised(rows["vector"], width, scale), quantised(queries["vector"], width, scale), own, k)
        elif len(rows) and len(queries):  # vectors without components: all scores are zero
            best = [np.array([n for n in range(min(len(rows), k + 1)) if n != o][:k], "int64") for o in own]
            scores = [np.zeros(len(b)) for b in best]
        else:
            best, scores = [], []
        if not any(map(len, best)):
            return pd.DataFrame({"query_id": [], "query_row": [], "id": [], "row": [], "score": []})
        found = np.concatenate(best)
        each = np.repeat(np.arange(len(best)), [len(b) for b in best])
        return pd.DataFrame({"query_id": queries["id"].to_numpy()[each], "query_row": queries["row"].to_numpy()[each],
                             "id": rows["id"].to_numpy()[found], "row": rows["row"].to_numpy()[found],
                             "score": [int(s) for part in scores for s in part]})
    return search


def top_by_inner_product(table: DataFrame, asks: Column, k: int = 5, scale: int = 256, shard_rows: int = 1 << 16,
                         block_rows: int = 1 << 16, least_shards: int = 48, id_column: str = "vec_id",
                         vector_column: str = "embedding") -> DataFrame:
    """Columns query_id, rank (from 1), id, score: the ``k`` best rows for every row where ``asks`` holds.

    Small tables are dealt into shards of at least 512 rows, up to ``least_shards`` of them.
    """
    if k < 1 or scale < 1:
        raise ValueError("k and scale must be at least 1")
    usable = F.coalesce(F.forall(vector_column, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    rows = written(table.where(usable).select(
        F.col(id_column).alias("id"), F.col(vector_column).alias("vector"),
        F.coalesce(asks, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("row")), "search-rows")
    number, queries = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    shards = max(-(-number // shard_rows), min(least_shards, -(-number // 512)), 1)
    blocks = max(-(-queries // block_rows), 1)

    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")

    def each(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    sides = (rows.select("id", "vector", "row", F.lit(False).alias("asks"), dealt(shards).alias("shard"), each(blocks).alias("block"))
             .unionByName(rows.where("asks").select("id", "vector", "row", "asks", dealt(blocks).alias("block"), each(shards).alias("shard"))))
    kind = table.schema[id_column].dataType.simpleString()
    found = sides.groupBy("shard", "block").applyInPandas(
        _searcher(k, scale), f"query_id {kind}, query_row long, id {kind}, row long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_column), "score"))
