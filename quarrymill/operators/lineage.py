"""Tables written to the shared folder that the session names, to cut lineage."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a folder of this machine in local mode, and an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return named or "file://" + os.path.join(tempfile.gettempdir(), "quarrymill-checkpoints")


class Scratch:
    """Written tables of one job. Unlike a checkpoint's, their sizes are known to the planner, which so finds out what is small enough to
    broadcast; a checkpoint takes over the estimates of its plan, and these are multiplied from round to round."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.paths = spark, f"{shared_folder(spark)}/quarrymill-{uuid.uuid4().hex}", {}
        atexit.register(self.clear)

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{len(self.paths):04d}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        """Deletes tables that nothing reads any more; other frames are passed over."""
        for df in frames:
            path, held = self.paths.get(id(df), (None, None))
            if held is df and path:
                self.paths[id(df)] = ("", df)
                self._delete(path)

    def clear(self) -> None:
        """At the driver's end."""
        if self.spark.sparkContext._jsc is not None:
            self._delete(self.folder)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
