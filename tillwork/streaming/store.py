"""A keyed table that a stream changes batch by batch: changes, compaction, a pointer to the newest state.

Every batch adds the rows that changed, one row a key, to ``changes/<batch>``, dealt into buckets by
key. Every ``compact_every`` such batches the buckets that changed, and only these, are merged with
their part of the state into ``base/<batch>``. The file ``pointer.json`` names what makes up the newest
state; it is replaced in one step after all it names is written, so readers see one
batch or the next and never list the history. What the pointer no longer names is deleted
``keep`` batches later, so that readers of older pointers can finish; storage is bounded by two copies of the
state and the changes of ``compact_every + keep`` batches.

A repeated batch is skipped if the pointer has it, and overwrites its own folders if not.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POINTER = "pointer.json"
GONE = "is_gone"  # marks a key that leaves the state


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _remove(spark: SparkSession, path: str) -> None:
    system, where = _file_system(spark, path)
    system.delete(where, True)


def _folders(spark: SparkSession, path: str) -> list[str]:
    system, where = _file_system(spark, path)
    return [s.getPath().getName() for s in system.listStatus(where) if s.isDirectory()] if system.exists(where) else []


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside ``path`` and put it in its place in one step."""
    system, new = _file_system(spark, f"{path}.new")
    out = system.create(new, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    hadoop, gateway = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
    rename = getattr(hadoop, "Options$Rename")
    modes = gateway.new_array(rename, 1)
    modes[0] = rename.OVERWRITE
    place = system.makeQualified(_file_system(spark, path)[1])
    hadoop.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration()).rename(
        system.makeQualified(new), place, modes)


def read_pointer(spark: SparkSession, path: str) -> dict | None:
    try:
        return json.loads(spark.read.text(f"{path}/{POINTER}", wholetext=True).first()[0])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class SnapshotStore:
    """The state below ``path``, one row for each value of ``keys`` (which may be null)."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 16,
                 compact_every: int = 8, keep: int = 2):
        if min(buckets, compact_every) < 1 or keep < 0:
            raise ValueError("buckets and compact_every must be at least 1, keep at least 0")
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.buckets, self.compact_every, self.keep = buckets, compact_every, keep

    def apply(self, changes: DataFrame, batch: int) -> None:
        """Take in a batch: the new row of each key that changed; those marked ``is_gone`` leave."""
        pointer = read_pointer(self.spark, self.path)
        if pointer is None:
            pointer = {"batch": -1, "keys": self.keys, "buckets": self.buckets, "schema": changes.schema.jsonValue(),
                       "base": {}, "changes": [], "retired": []}
        if pointer["batch"] >= batch:
            return
        pointer["schema"] = changes.schema.jsonValue()  # of older files, columns they lack are null
        self._write(changes, f"{self.path}/changes/{batch}", pointer["buckets"])
        touched = [int(n.split("=")[1]) for n in _folders(self.spark, f"{self.path}/changes/{batch}") if n.startswith("bucket=")]
        if touched:
            pointer["changes"].append({"batch": batch, "buckets": sorted(touched)})
        else:
            pointer["retired"].append([batch, f"changes/{batch}"])
        if len(pointer["changes"]) >= self.compact_every:
            self._compact(pointer, batch)
        pointer["batch"] = batch
        due = [folder for at, folder in pointer["retired"] if at + self.keep <= batch]
        pointer["retired"] = [r for r in pointer["retired"] if r[0] + self.keep > batch]
        _replace_text(self.spark, f"{self.path}/{POINTER}", json.dumps(pointer))
        for folder in due:
            _remove(self.spark, f"{self.path}/{folder}")

    def _write(self, rows: DataFrame, path: str, buckets: int) -> None:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")
        (rows.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket")
         .mode("overwrite").parquet(path))

    def _compact(self, pointer: dict, batch: int) -> None:
        touched = {b for c in pointer["changes"] for b in c["buckets"]}
        merged = _merged(self.spark, self.path, pointer, touched)
        self._write(merged, f"{self.path}/base/{batch}", pointer["buckets"])
        filled = {int(n.split("=")[1]) for n in _folders(self.spark, f"{self.path}/base/{batch}") if n.startswith("bucket=")}
        base, retired = pointer["base"], [f"changes/{c['batch']}" for c in pointer["changes"]]
        for b in touched:
            old = base.pop(str(b), None)
            if old is not None:
                # The last bucket of an old version takes the folder of that version along.
                retired.append(f"base/{old}/bucket={b}" if old in base.values() else f"base/{old}")
            if b in filled:
                base[str(b)] = batch
        if not filled:
            retired.append(f"base/{batch}")
        pointer["changes"], pointer["retired"] = [], pointer["retired"] + [[batch, folder] for folder in retired]


def _merged(spark: SparkSession, path: str, pointer: dict, buckets: set[int] | None = None) -> DataFrame:
    """The newest row of every key in the given buckets (all of them: None), without those that left."""
    schema, keys = StructType.fromJson(pointer["schema"]), pointer["keys"]

    def files(folders: list[str]) -> DataFrame:
        return spark.read.schema(schema).parquet(*(f"{path}/{f}" for f in folders)) if folders else spark.createDataFrame([], schema)

    def wanted(b) -> bool:
        return buckets is None or int(b) in buckets

    changed = {b for c in pointer["changes"] for b in c["buckets"] if wanted(b)}
    same = [f"base/{v}/bucket={b}" for b, v in pointer["base"].items() if wanted(b) and int(b) not in changed]
    parts = [files([f"base/{v}/bucket={b}" for b, v in pointer["base"].items() if int(b) in changed]).withColumn("_version", F.lit(-1))]
    for c in pointer["changes"]:
        own = [f"changes/{c['batch']}/bucket={b}" for b in c["buckets"] if b in changed]
        if own:
            parts.append(files(own).withColumn("_version", F.lit(c["batch"])))
    newest = F.max_by(F.struct(*schema.names), "_version").alias("row")
    merged = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(newest).select("row.*")
    return files(same).unionByName(merged).where(~F.col(GONE))


def newest_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The state that the pointer names; None where there is no pointer."""
    pointer = read_pointer(spark, path.rstrip("/"))
    return None if pointer is None else _merged(spark, path.rstrip("/"), pointer).drop(GONE)
