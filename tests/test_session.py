"""Session settings."""

import pytest
from pyspark.sql import functions as F

from shelfline import session as ss

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture
def settings(spark):
    yield spark.conf
    spark.conf.unset(INITIAL)
    ss.configure(spark)


def tasks_of(df):
    """Tasks of the last stage as adaptive execution ran it."""
    return len(df.select(F.spark_partition_id().alias("p")).distinct().collect())


def test_a_task_gets_no_more_of_a_larger_input(spark, settings, tmp_path, monkeypatch):
    monkeypatch.setattr(ss, "INPUT_PER_PARTITION", 1 << 20)
    rows = []
    for n in (1_500_000, 6_000_000):  # about 12 and 48 MB
        path = str(tmp_path / str(n))
        spark.range(n).select(F.xxhash64("id").alias("k")).write.parquet(f"{path}/t.parquet")
        ss.configure(spark, path)
        settings.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        rows.append(n / tasks_of(spark.read.parquet(f"{path}/t.parquet").groupBy("k").count()))
    assert rows[1] < 1.5 * rows[0]


def test_a_small_input_keeps_the_partitions_of_the_session(spark, settings, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/t.parquet")
    ss.configure(spark, str(tmp_path))
    assert settings.get(INITIAL) == settings.get("spark.sql.shuffle.partitions") == "4"
