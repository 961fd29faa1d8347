"""Fitted models and their scores, kept in the shared folder under a hash of what they were made from."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import shared_dir


def fingerprint(df: DataFrame, places: int = 3) -> str:
    """Hash of the rows of ``df`` in any order; doubles count to ``places``, so the order of their sums plays no part."""
    def plain(name: str, kind: str):
        c = F.col(f"`{name}`")
        return F.round(c, places) if kind in ("double", "float") else c
    row = F.xxhash64(*[plain(n, k) for n, k in df.dtypes])
    found = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("x"), F.sum(F.pmod(row, F.lit(1 << 31))).alias("s")).first()
    return hashlib.sha256(json.dumps([df.columns, found.n, found.x, found.s]).encode()).hexdigest()[:24]


class ModelStore:
    """Artefacts of one data set. What is there is loaded, what is not is made and kept, whoever asks first.

    An artefact is complete once its ``value.json`` is there, which is renamed into place last; a run that is lost
    half-way leaves nothing that counts, and two that make the same artefact leave either one.
    """

    def __init__(self, spark: SparkSession, data: str, root: str | None = None) -> None:
        self.spark, self.root = spark, f"{root or shared_dir(spark)}/model-store/{data}"

    def _path(self, key: dict) -> str:
        return f"{self.root}/{hashlib.sha256(json.dumps(key, sort_keys=True).encode()).hexdigest()[:24]}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return jvm, at, at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _read(self, path: str):
        _, at, fs = self._fs(f"{path}/value.json")
        return json.loads(self.spark.read.text(f"{path}/value.json").first().value) if fs.exists(at) else None

    def _write(self, path: str, value) -> None:
        jvm, draft, fs = self._fs(f"{path}/_value-{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        target = jvm.org.apache.hadoop.fs.Path(f"{path}/value.json")
        if not fs.rename(draft, target):  # someone else was first
            fs.delete(draft, False)

    def value(self, key: dict, make: Callable[[], object]):
        """A value that JSON can hold."""
        path = self._path(key)
        found = self._read(path)
        if found is None:
            found = make()
            self._write(path, found)
        return found

    def model(self, key: dict, make: Callable[[], tuple]) -> tuple[PipelineModel, dict]:
        """A fitted pipeline and its scores."""
        path = self._path(key)
        found = self._read(path)
        if found is None:
            model, found = make()
            model.write().overwrite().save(f"{path}/model")
            self._write(path, found)
        return PipelineModel.load(f"{path}/model"), found
