"""The steps of one run of a job on a store, kept beside it so that a rerun goes on where it stopped (SNK-13)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import store as ST


class Journal:
    """A folder with one empty file for each step that is done, and tables that steps leave for
    later ones.  A file is created whole or not at all, so a step counts as done or not."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._target(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def done(self, step: str) -> bool:
        return self._fs.exists(self._target(self.at(f"{step}.done")))

    def mark(self, step: str) -> None:
        self._fs.create(self._target(self.at(f"{step}.done")), True).close()

    def clear(self) -> None:
        ST.delete(self.spark, self.path)
