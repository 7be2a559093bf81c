"""Tables between the steps of a job, in the folder the cluster shares.

A step that several later ones read is written once as Parquet and read back: its lineage ends
there, a lost executor costs no recomputation of earlier steps, and later steps read only the
columns they need.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names; a local session without one gets a temporary folder."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="rosterweave-")


class Stage:
    """Callable that stores a frame under a name and returns the stored table."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self._spark = spark
        self.folder = f"{(folder or shared_folder(spark)).rstrip('/')}/rosterweave-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def within(self, name: str) -> Stage:
        """A stage of its own in the folder of this one, for steps that name tables themselves."""
        return Stage(self._spark, f"{self.folder}/{name}")

    def drop(self, name: str) -> None:
        """Delete a stored table that no later step reads; those that were made from it are stored."""
        jvm = self._spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
