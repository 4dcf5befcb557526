"""Similarity join over word shingles by fixed MinHash bands.

Every text is a set of five-word shingles; equal sets are one class with a count. A class has a
MinHash key for each of several bands ("trees"). Two classes are candidates if they share a key.
The rows of a band ("prefix") are the most, up to ``DEPTH``, that meet pairs at the threshold with
the target recall, ``1 - (1 - threshold^length)^trees``; they do not depend on the data. Classes
that meet in a tree (a sorted run of equal prefixes, reduced to its smallest class before it is
shuffled) form candidate groups. Each group's shingle sets are brought together once, in chunks
of bounded size; every two chunks of a group are compared in a task of their own, where pairs
that share a prefix are verified by their exact Jaccard similarity. A chunk pair gives back a row
per linked class (number of links, smallest class reached), never the pairs themselves.

Defined results: a null text, or one without any letter or digit, links with nothing; a text of
fewer than five words is one shingle; rows that repeat an id with an equal set are counted as
copies; null ids are one document; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.graph import components
from tillwork.llm.shingles import minima, mix, permutations, shingle_set
from tillwork.session import stored, written

TREES, DEPTH = 20, 8


def prefix_length(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """Shorten the prefix until pairs at the threshold are met with the recall."""
    for length in range(depth, 0, -1):
        if 1 - (1 - threshold ** length) ** trees >= recall:
            return length
    raise ValueError("too few trees for this recall")


def _set_id(shingles: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit hashes of a set."""
    one, two = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), mix(shingles + np.uint64(0x14057B7EF767814F))
    return int(one.sum(dtype="uint64").view("int64")), int(two.sum(dtype="uint64").view("int64"))


def _signer(width: int, trees: int, length: int):
    def signed(batches):
        factors, offsets = permutations(trees * length)
        for batch in batches:
            h1, h2, sizes, keys = [], [], [], []
            for text in batch["text"]:
                s = shingle_set(text, width)
                a, b = _set_id(s)
                h1.append(a)
                h2.append(b)
                sizes.append(len(s))
                key = np.zeros(trees, "uint64")
                for level in minima(s, factors, offsets).reshape(trees, length).T:
                    key = mix(key * np.uint64(3) + level)
                keys.append(mix(key + np.arange(trees, dtype="uint64")).view("int64"))
            yield pd.DataFrame({"id": batch["id"], "h1": h1, "h2": h2, "size": sizes, "keys": keys})
    return signed


def _verifier(threshold: float):
    def links(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("side", kind="stable").reset_index(drop=True)
        split = int((group["side"] == 0).sum())
        alone = bool((group["a"] == group["b"]).all())  # a chunk with itself
        keys = np.array(group["keys"].tolist(), dtype="int64").reshape(len(group), -1)
        sets = [np.asarray(s, dtype="int64") for s in group["shingles"]]
        sizes, copies = np.array([len(s) for s in sets]), group["copies"].to_numpy()
        codes = np.unique(np.concatenate(sets), return_inverse=True)[1] if sets else np.zeros(0, "int64")
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        mark = np.zeros(int(codes.max()) + 1 if len(codes) else 1, bool)
        total, parent = np.zeros(len(group), "int64"), np.arange(len(group))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            return i

        for i in range(split):
            others = np.arange(i + 1 if alone else split, len(group))
            others = others[(keys[others] == keys[i]).any(axis=1)]
            others = others[np.minimum(sizes[others], sizes[i]) >= threshold * np.maximum(sizes[others], sizes[i])]
            if not len(others):
                continue
            own = codes[cuts[i]:cuts[i + 1]]
            mark[own] = True
            flat = np.concatenate([codes[cuts[j]:cuts[j + 1]] for j in others])
            starts = np.concatenate([[0], np.cumsum(sizes[others])[:-1]])
            common = np.add.reduceat(mark[flat].astype("int64"), starts)
            mark[own] = False
            for j in others[common / (sizes[i] + sizes[others] - common) >= threshold]:
                total[i] += copies[j]
                total[j] += copies[i]
                x, y = root(i), root(j)
                if x != y:
                    parent[max(x, y)] = min(x, y)
        rows = np.flatnonzero(total)
        low = np.array([root(i) for i in rows], dtype="int64")
        return pd.DataFrame({"rep": group["rep"].iloc[rows].to_numpy(), "h1": group["h1"].to_numpy()[rows],
                             "links": total[rows], "low_rep": group["rep"].iloc[low].to_numpy(),
                             "low_h1": group["h1"].to_numpy()[low]})
    return links


def similar_texts(docs: DataFrame, threshold: float = 0.8, recall: float = 0.999, width: int = 5,
                  chunk_rows: int = 256, chunk_shingles: int = 1 << 18, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """A row per document: id, class_id, n_links, component_id (smallest id reached), kept."""
    return stored(docs.sparkSession, "forest-classes", lambda: _similar_texts(
        docs, threshold, recall, width, chunk_rows, chunk_shingles, id_column, text_column))


def _similar_texts(docs: DataFrame, threshold: float, recall: float, width: int, chunk_rows: int,
                   chunk_shingles: int, id_column: str, text_column: str) -> DataFrame:
    kind = docs.schema[id_column].dataType.simpleString()
    length = prefix_length(threshold, recall)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    signed = written(texts.mapInPandas(_signer(width, TREES, length),
                                       f"id {kind}, h1 long, h2 long, size long, keys array<long>"), "forest-signed")
    classes = written(signed.where("size > 0").groupBy("h1", "h2").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"),
        F.first("keys").alias("keys")), "forest-classes")
    node = F.struct("rep", "h1")
    runs = classes.select(node.alias("node"), F.explode("keys").alias("key"))
    heads = runs.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head != last")
    groups = components(runs.join(heads.select("key", "head"), "key").where("head != node")
                        .select(F.col("head").alias("a"), F.col("node").alias("b")).distinct())
    grouped = written(classes.join(groups.select(F.col("node.rep").alias("rep"), F.col("node.h1").alias("h1"), "component"),
                                   ["rep", "h1"]), "forest-groups")
    parts = grouped.groupBy("component").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / chunk_rows), F.ceil(F.sum("size") / chunk_shingles)).cast("int").alias("parts"))
    # A chunk meets itself and every other one; its rows are sent once to each of these pairs.
    chunked = (grouped.join(parts, "component")
               .withColumn("part", F.pmod(F.xxhash64(F.lit("chunk"), "rep", "h1"), F.col("parts")).cast("int")))
    copies_to = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.struct(
        F.least("part", other).alias("a"), F.greatest("part", other).alias("b"),
        (F.col("part") > other).cast("int").alias("side")))

    def with_sets(batches):
        for batch in batches:
            sets = [shingle_set(t, width) for t in batch["text"]]
            same = np.array([(a, b) == _set_id(s) for a, b, s in zip(batch["h1"], batch["h2"], sets)], dtype=bool)
            batch = batch.drop(columns="text").assign(shingles=[s.view("int64") for s in sets])
            yield batch[same]

    sent = (texts.join(chunked.withColumnRenamed("rep", "id"), "id")
            .select(F.col("id").alias("rep"), "h1", "h2", "copies", "keys", "component", "part", "parts", "text")
            .mapInPandas(with_sets, f"rep {kind}, h1 long, h2 long, copies long, keys array<long>, "
                         f"component struct<rep: {kind}, h1: long>, part int, parts int, shingles array<long>")
            .dropDuplicates(["rep", "h1", "h2"])
            .withColumn("to", F.explode(copies_to))
            .select("rep", "h1", "copies", "keys", "shingles", F.col("component.rep").alias("g1"),
                    F.col("component.h1").alias("g2"), F.col("to.a").alias("a"), F.col("to.b").alias("b"), F.col("to.side").alias("side")))
    met = written(sent.groupBy("g1", "g2", "a", "b").applyInPandas(
        _verifier(threshold), f"rep {kind}, h1 long, links long, low_rep {kind}, low_h1 long"), "forest-links")
    linked = met.groupBy("rep", "h1").agg(F.sum("links").alias("links"))
    found = components(met.select(node.alias("a"), F.struct(F.col("low_rep").alias("rep"), F.col("low_h1").alias("h1")).alias("b")))
    known = (classes.select("h1", "h2", "rep", "copies").join(linked, ["rep", "h1"], "left")
             .join(found.select(F.col("node.rep").alias("rep"), F.col("node.h1").alias("h1"), F.col("component.rep").alias("low")),
                   ["rep", "h1"], "left")
             .select("h1", "h2", F.col("rep").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("low", "rep").alias("component_id")))
    out = (signed.where("size > 0").select("id", "h1", "h2").join(known, ["h1", "h2"])
           .select("id", "class_id", "n_links", "component_id")
           .unionByName(signed.where("size = 0").select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
                                                        F.col("id").alias("component_id"))))
    return out.select(F.col("id").alias(id_column), "class_id", "n_links", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
