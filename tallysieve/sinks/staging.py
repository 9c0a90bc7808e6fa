"""Written intermediate tables in the shared folder of the cluster.

Staged tables cut lineage, survive lost executors and carry exact sizes, so that Spark decides on
broadcasts from what was written rather than from guesses.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ship

SHARED_FOLDER = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session; a temporary one only where none is named and driver and tasks are one process."""
    named = spark.conf.get(SHARED_FOLDER, None)
    if not named:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError(f"{SHARED_FOLDER} must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="tallysieve-")
        spark.conf.set(SHARED_FOLDER, named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def free(spark: SparkSession) -> None:
    """Ask for the driver's garbage to be collected, with which shuffles of ended jobs go."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Staging:
    """Writes a frame under its name and reads it back.

    What was shuffled to make a table is not needed once it is written; Spark drops those files when the driver's
    garbage is collected, which is asked for before the next table is made, so that shuffles of all steps do not pile
    up on the executors.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, codec: str = "zstd") -> None:
        self.spark, self.codec = spark, codec
        self.folder = folder or new_folder(spark, "staging")
        ship(spark)

    def free(self) -> None:
        free(self.spark)

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        self.free()
        target = f"{self.folder}/{name}"
        df.write.mode("overwrite").option("compression", self.codec).parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def drop(self, *names: str) -> None:
        """Remove the named staged tables, all where none is named; frames that read them are of no use afterwards."""
        from ..sources import stores

        for folder in [f"{self.folder}/{name}" for name in names] or [self.folder]:
            if stores.opens(folder):
                store, place = stores.store_of(folder)
                if stores.kind_of(folder)[0] == stores.FOLDER:
                    store.delete_dir(place)
