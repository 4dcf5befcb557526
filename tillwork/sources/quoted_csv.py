"""CSV with line breaks inside quotes, read in splits.

Spark's ``multiLine`` reads a file in one task, since a split cannot know whether it begins inside
quotes. Here files are read as lines, in as many splits as they have, and the quotes tell: a line
begins a record if the quotes before it in the file are even in number. A first read counts the quotes
of each split; from these the driver, which plans the splits anyway, learns which splits begin inside
quotes. A second read puts lines together as they stream by, in Arrow batches, without a shuffle. Only what a split cannot
finish, two pieces at most, goes through a shuffle and meets its neighbours. Parsing is Spark's own.

The rows are those of ``multiLine``, in no order. A file whose first line ends in a carriage return has
such line ends, and those inside its quotes become line feeds. Quotes inside quoted fields are doubled
and unquoted fields hold none (RFC 4180). A quote that is never closed makes the rest of its
file one record, as it does for ``multiLine``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Whole records have no place; pieces are told apart by the split they come from.
_RECORDS = "file long, block long, piece int, first boolean, value string"
_WHOLE, _HEAD, _TAIL = 0, 1, 2  # a head goes on with the record of an earlier split, a tail begins one


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, lineSep="\n").select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _open_splits(lines: DataFrame, quote: str) -> tuple[set[tuple[int, int]], set[int]]:
    """The splits that begin inside quotes, and the files with carriage returns."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    first = F.first(F.endswith("value", F.lit("\r")))  # of a split's lines, which a task reads in order
    splits = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"), first.alias("cr"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    known = splits.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("open"),
                          (F.col("cr") & (F.col("block") == 0)).alias("crlf"))
    rows = known.where("open OR crlf").collect()  # a row per split at most
    return {(r["file"], r["block"]) for r in rows if r["open"]}, {r["file"] for r in rows if r["crlf"]}


def _assembler(opened: set[tuple[int, int]], quote: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, begun, held = None, 0, False, []  # of the split in hand: parity, whether a record began, its lines

        def batch_of(values, pieces, firsts) -> pa.RecordBatch:
            number = len(values)
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(number, split[0])), pa.array(np.full(number, split[1])), pa.array(pieces, pa.int32()),
                pa.array(firsts, pa.bool_()), pa.array(values, pa.string()) if isinstance(values, list) else values],
                names=["file", "block", "piece", "first", "value"])

        def rest():
            if held:
                yield batch_of(["\n".join(held)], [_TAIL if begun else _HEAD], [begun == "first"])

        for batch in batches:
            file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1), len(file)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if split != (file[a], block[a]):
                    yield from rest()
                    split, begun, held = (file[a], block[a]), False, []
                    inside = int((int(file[a]), int(block[a])) in opened)
                lines = batch.column("value").slice(a, b - a)
                quotes = pc.count_substring(lines, quote).to_numpy(zero_copy_only=False)
                parity = (inside + np.concatenate([[0], np.cumsum(quotes)])) % 2
                starts, inside = np.flatnonzero(parity[:-1] == 0), int(parity[-1])
                if not len(starts):
                    held += lines.to_pylist()
                    continue
                held += lines.slice(0, starts[0]).to_pylist()
                if held:
                    yield batch_of(["\n".join(held)], [_WHOLE if begun else _HEAD], [begun == "first"])
                sizes = np.diff(starts)
                if len(sizes):
                    single = sizes == 1
                    firsts = np.zeros(len(sizes), bool)
                    firsts[0] = not begun and split[1] == 0
                    begun = begun or "later"
                    if single.any():
                        yield batch_of(lines.take(pa.array(starts[:-1][single])).cast(pa.string()), np.zeros(single.sum(), "int32"), firsts[single])
                    if not single.all():
                        longer = ["\n".join(lines.slice(s, n).to_pylist()) for s, n in zip(starts[:-1][~single].tolist(), sizes[~single].tolist())]
                        yield batch_of(longer, np.zeros(len(longer), "int32"), firsts[~single])
                held = lines.slice(starts[-1]).to_pylist()
                begun = "first" if not begun and split[1] == 0 else "later"
        yield from rest()
    return run


def records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """Columns file (a hash), first (whether it is the first of its file) and value, of all records but empty lines."""
    lines = _lines(spark, path)
    opened, crlf = _open_splits(lines, quote)
    found = lines.mapInArrow(_assembler(opened, quote), _RECORDS)
    order = Window.partitionBy("file").orderBy("block", "piece")
    pieces = found.where(F.col("piece") != _WHOLE).withColumn("record", F.count_if(F.col("piece") == _TAIL).over(order))
    parts = F.sort_array(F.collect_list(F.struct("block", "piece", "value")))
    joined = pieces.groupBy("file", "record").agg(F.bool_or("first").alias("first"), parts.alias("parts")).select(
        "file", "first", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"))
    ended = F.regexp_replace("value", "\r$", "")
    value = F.when(F.col("file").isin(list(crlf)), F.replace(ended, F.lit("\r\n"), F.lit("\n"))).otherwise(ended) if crlf else ended
    return found.where(F.col("piece") == _WHOLE).select("file", "first", "value").unionByName(joined).select(
        "file", "first", value.alias("value")).where("value <> ''")


def read_quoted_csv(spark: SparkSession, path: str, schema: str, header: bool = True, quote: str = '"') -> DataFrame:
    """The rows of CSV files of the given columns. A header that names other columns is an error."""
    names = spark.createDataFrame([], schema).schema.names if isinstance(schema, str) else schema.names
    options = {"quote": quote, "escape": quote}
    found = records(spark, path, quote)
    if header:
        found = found.where(_is_data(names, options))
    return found.select(F.from_csv("value", _ddl(schema), options).alias("row")).select("row.*")


def _ddl(schema: str | StructType) -> str:
    return schema if isinstance(schema, str) else schema.toDDL()


def _is_data(names: list[str], options: dict) -> Column:
    """False for the first record of a file, which must name the columns."""
    told = F.from_csv("value", ", ".join(f"c{i} string" for i in range(len(names))), options)
    same = F.array(*(F.lower(told[f"c{i}"]) for i in range(len(names)))) == F.array(*(F.lit(n.lower()) for n in names))
    complaint = F.concat(F.lit(f"the header is not {','.join(names)}: "), F.col("value"))
    return F.when(~F.col("first"), F.lit(True)).otherwise(F.when(same, F.lit(False)).otherwise(
        F.raise_error(complaint).cast("boolean")))
