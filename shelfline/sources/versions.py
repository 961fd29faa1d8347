"""Tables that change all at once: each state is a folder that Spark writes, and one small file names the current one.

A change writes the whole new state beside the old one and then renames a new ``CURRENT`` over the old. Until then
readers see the old state; a run that is lost leaves a folder that nobody reads. The state before the current one is
kept for readers that are still on it. One load at a time changes a table. Where the cluster has a catalog with a
table format of its own, ``plans.incremental.upsert`` serves its merge just as well.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def current(spark: SparkSession, path: str) -> dict | None:
    """``version``, ``previous`` and ``schema`` of the current state."""
    fs, p = _path(spark, f"{path}/CURRENT")
    return json.loads(spark.read.text(f"{path}/CURRENT").first().value) if fs.exists(p) else None


def exists(spark: SparkSession, path: str) -> bool:
    return current(spark, path) is not None


def switch(spark: SparkSession, path: str, state: dict) -> None:
    """Make ``state`` the current one by a rename."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, draft = _path(spark, f"{path}/_CURRENT-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(state).encode()))
    finally:
        out.close()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/CURRENT")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(draft), fs.makeQualified(target), over)


def read(spark: SparkSession, path: str) -> DataFrame:
    state = current(spark, path)
    schema = T.StructType.fromJson(state["schema"])
    return spark.read.schema(schema).parquet(f"{path}/{state['version']}").select(*schema.names)


def replace(df: DataFrame, path: str, partition_col: str) -> None:
    """Make ``df`` the new state of the table."""
    spark, old, version = df.sparkSession, current(df.sparkSession, path), uuid.uuid4().hex
    df.hint("rebalance", partition_col).write.partitionBy(partition_col).parquet(f"{path}/{version}")
    switch(spark, path, {"version": version, "previous": old and old["version"], "schema": df.schema.jsonValue()})
    if old and old["previous"]:
        fs, p = _path(spark, f"{path}/{old['previous']}")
        fs.delete(p, True)
