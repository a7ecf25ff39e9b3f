"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"

# Settings the library relies on. They are runtime settings, so a session made
# by somebody else can be brought in line with configure().
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # Template fields and record keys match exactly, case included.
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Top-k per group is cut in each map task, for large k too.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    # Decoding binary files hands whole files to Python: bound the batch by
    # bytes, since 10,000 workbooks in one batch would not fit a task.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "formweave", memory: str = "12g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """Actions inside the block run with another value of one setting."""
    was = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, was)


_own_folder: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local master may fall back to a temporary folder: there the driver
    and the executors are one process.
    """
    configured = spark.conf.get(SHARED_DIR_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR_CONF} to a folder all executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="formweave-"))
    return _own_folder[0]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def kept_path(spark: SparkSession, kind: str) -> str:
    """A new folder in the shared one, deleted with the copies of its block."""
    path = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    _handles[-1].append(path)
    return path


# Handles in use, the innermost last; the first belongs to the process.
_handles: list[list[str]] = [[]]


@contextmanager
def copies(spark: SparkSession) -> Iterator[list[str]]:
    """Own the copies written inside the block: they are deleted at its end.

    Copies of other results, made before, after or in an inner block, stay.
    """
    own: list[str] = []
    _handles.append(own)
    try:
        yield own
    finally:
        _handles.remove(own)
        _delete(spark, own)


def drop_copies(spark: SparkSession) -> int:
    """Delete the copies written outside copies() blocks, once their results are used."""
    return _delete(spark, _handles[0])


def _delete(spark: SparkSession, paths: list[str]) -> int:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    dropped = 0
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        dropped += bool(path.getFileSystem(conf).delete(path, True))
    return dropped


def materialise(df: DataFrame, row_group: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back.

    The copy survives lost executors, freezes values that a recomputation
    could change (partition ids, sampled range bounds), and stays columnar, so
    a later pass over one column reads that column only. Copies live until
    the end of their copies() block, until drop_copies(), or until the folder's
    owner clears it. ``row_group`` bounds the bytes of a row group, the least that
    a later scan can make a task of.
    """
    spark = df.sparkSession
    path = kept_path(spark, "formweave")
    (df.write if row_group is None else df.write.option("parquet.block.size", row_group)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
