"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings that hold at any size. The number of shuffle partitions is left to the
# cluster: AQE merges small ones and splits skewed ones at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the Python line of every column expression costs more than planning it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "tillwork", master: str | None = None, **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; keys of ``extra`` use ``__`` for the dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on (the time zone) on a session built elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session that names none uses a folder of its own below the warehouse, which is shared, too.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


# The open scopes of this thread or task, outermost first: threads do not see each other's.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Remove at the end what :func:`written` wrote inside; consume or store results before that.

    Scopes may be nested, and each thread has its own.
    """
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield paths
    finally:
        _SCOPES.reset(token)
        for name in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Write what ``build`` returns, and remove the tables that it wrote on the way."""
    outer = _SCOPES.get()
    with scratch(spark) as paths:
        built = build()
        token = _SCOPES.set(outer)  # the result belongs to the scopes around this one
        try:
            result = written(built, name)
        finally:
            _SCOPES.reset(token)
    return result


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages read files, whichever executors are lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def new_path(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one, which the scopes around remove."""
    path = f"{shared_folder(spark)}/tables/{name}-{uuid.uuid4().hex}"
    for scope in _SCOPES.get():
        scope.append(path)
    return path


def written(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Used instead of a checkpoint where the result is scanned several times, a few
    columns at a time.
    """
    path = new_path(df.sparkSession, name)
    df.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_evenly(df: DataFrame, name: str, *keys: str, rows_per_file: int = 250_000) -> DataFrame:
    """:func:`written`, dealt by the hash of ``keys`` into at least as many files as tasks run at once.

    For work that costs by the row, not by the byte, such as fitting a model: the size-based merge of
    small partitions, and files of one row group, would leave it to a single task. Rows are sorted within
    their file, so that a repeated run finds the same files.
    """
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.repartition(parts, *keys).sortWithinPartitions(*df.columns)
    return written(dealt, name, rows_per_file)
