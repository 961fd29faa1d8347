"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import uuid

from py4j.protocol import Py4JError
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings the jobs rely on. AQE splits skewed join partitions and coalesces small ones; the
# broadcast threshold stays Spark's own, so a side is broadcast only when its size was checked.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task sorts, or keeps in a hash table, about twenty times what it fetches compressed.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
    # Stream state lives on disk instead of the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "shelfline", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Input files behind one shuffle partition before adaptive execution joins small ones.
INPUT_PER_PARTITION = 4 << 20


def configure(spark: SparkSession, path: str | None = None) -> SparkSession:
    """Apply the settings that a running session can take to a session made elsewhere.

    With the folder of the input, shuffles start with partitions in proportion to its size, at least as many as the
    session names. Adaptive execution joins small partitions but splits no large one: with a fixed number of them the
    memory of a task would grow with the input.
    """
    for key, value in SETTINGS.items():
        if key.startswith(("spark.sql.adaptive.", "spark.sql.files.")):
            spark.conf.set(key, value)
    if path is not None:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        size = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(least, -(-size // INPUT_PER_PARTITION))))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or else one in the warehouse of the session."""
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def fresh_path(spark: SparkSession, name: str) -> str:
    """New, unused path in the shared folder, which ``release`` deletes."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _stored.append(path)
    return path


def materialize(df: DataFrame, name: str = "table", **options: str | int) -> DataFrame:
    """Write ``df`` once as a columnar table in the shared folder and read it back.

    Used where several branches need the same aggregate: they then read the stored result with
    their own columns instead of repeating the scan, and losing an executor costs no recomputation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialize``, and the value of each aggregate over the rows, taken by the pass that writes them."""
    spark, path, seen = df.sparkSession, fresh_path(df.sparkSession, name), Observation()
    df.observe(seen, *[m.alias(k) for k, m in metrics.items()]).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get


_stored: list[str] = []


@atexit.register
def _sweep() -> None:
    """Leave nothing behind when the driver ends in order."""
    jvm = SparkContext._jvm
    if jvm is None:
        return
    try:
        conf = jvm.org.apache.hadoop.conf.Configuration()
        while _stored:
            p = jvm.org.apache.hadoop.fs.Path(_stored.pop())
            p.getFileSystem(conf).delete(p, True)
    except Py4JError:  # the JVM is gone already
        pass


def release(spark: SparkSession) -> int:
    """Delete all that was written under ``fresh_path``, once no result that reads it is needed any more."""
    jvm, done = spark.sparkContext._jvm, 0
    while _stored:
        p = jvm.org.apache.hadoop.fs.Path(_stored.pop())
        done += p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return done
