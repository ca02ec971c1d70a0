"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from bikenet.session import shared_folder


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table written below ``spark.checkpoint.dir`` and read again.

    This cuts lineage: what follows survives the loss of any executor without repeating the work.
    """
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


class Tables:
    """The intermediate tables of one operator, written under names and dropped after their last reader."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.root = spark, shared_folder(spark, purpose)
        self.paths: dict[str, str] = {}

    def write(self, name: str, frame: DataFrame) -> DataFrame:
        """As :func:`written`; an earlier table of the name stays until it is dropped."""
        path = self.paths[name] = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete the newest table of each name; nothing may read them any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
