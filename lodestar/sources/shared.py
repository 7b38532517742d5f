"""Tables in the cluster's shared folder, for whatever is used twice or too deep to compute again."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_scope: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A folder of our own is made only where the setting is
    missing and everything runs in one process."""
    path = spark.conf.get(CHECKPOINT_DIR, None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="lodestar-")
        spark.conf.set(CHECKPOINT_DIR, path)
    return path.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _for_now(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.deleteOnExit(where)
    held = _scope.get()
    if held is not None:
        held.append(path)


def place(spark: SparkSession) -> str:
    """A new folder in the shared one. It goes when the application ends, or with the `scratch` scope in which it was asked for."""
    path = f"{shared_dir(spark)}/lodestar-{uuid.uuid4().hex}"
    files, where = _file_system(spark, path)
    files.mkdirs(where)
    _for_now(spark, path)
    return path


#: Up to so many bytes a table may come as a single row group, which one task would read alone.
SMALL = 1 << 28


def spread(df: DataFrame) -> DataFrame:
    """A small table (by the optimiser's estimate) dealt over all cores before much is done with each row; a larger one
    is read in many pieces anyway, and is left as it is."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= SMALL else df


def materialise(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there, so a lost executor costs a
    reread of some files, and frames that use it twice compute it once. (checkpoint() would compute it twice.)
    The table goes when the application ends, or with the `scratch` scope in which it was made."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lodestar-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _for_now(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, by: str, buckets: int) -> DataFrame:
    """Like `materialise`, in so many buckets by one column, a file each, under a name of its own in the session's catalogue: what groups or
    joins by that column reads its rows where they are, without a shuffle."""
    name = f"lodestar_{uuid.uuid4().hex}"
    df.repartition(buckets, by).write.format("parquet").bucketBy(buckets, by).option("path", place(df.sparkSession)).saveAsTable(name)
    return df.sparkSession.table(name)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are materialised within are deleted at its end; write or collect results before."""
    held: list[str] = []
    token = _scope.set(held)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in held:
            files, where = _file_system(spark, path)
            files.delete(where, True)
