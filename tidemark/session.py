"""Session helpers: where scratch data goes, staged tables, writer settings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def build_session(app: str = "tidemark", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the operators rely on for large inputs.

    AQE splits skewed join sides and rebalanced partitions at run time, so both
    stay on; the shuffle partition count is only a starting point it coalesces.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Executors on other hosts must be able to read what is staged here, so a
    machine-local folder is only made up for a local master.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/") + "/tidemark"
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.conf.get("spark.app.id", master)
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_ROOTS[app]


def scratch_dir(spark: SparkSession, label: str = "run") -> str:
    """A new, unused folder below the scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once to shared scratch and read it from there.

    For a frame that a plan reads several times: the files cut the lineage, survive
    the loss of any executor, and give Catalyst an exact size to decide between a
    broadcast and a shuffled join.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark, "stored")
    with micros_writer(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame) -> Iterator[tuple[DataFrame, int]]:
    """A stored copy for one operation, with its size in bytes; it is removed on exit."""
    spark = df.sparkSession
    path = scratch_dir(spark, "stage")
    try:
        copy = stored(df, path)
        yield copy, path_bytes(spark, path)
    finally:
        delete_path(spark, path)


@contextmanager
def micros_writer(spark: SparkSession) -> Iterator[None]:
    """Write instants as 64-bit microseconds; Spark's own default is INT96."""
    key = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(key)
    spark.conf.set(key, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Does the path or glob match anything?"""
    fs, path = _path(spark, pattern)
    found = fs.globStatus(path)
    return found is not None and len(found) > 0


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total length of the files below a path."""
    fs, hadoop_path = _path(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def list_glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob; used for folders, never for the files of a table."""
    fs, path = _path(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(path) or ()]


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file."""
    fs, hadoop_path = _path(spark, path)
    fs.create(hadoop_path, True).close()


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _path(spark, path)
    return fs.delete(hadoop_path, True)
