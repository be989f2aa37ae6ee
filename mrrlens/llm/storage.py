"""Tables written between the steps of an operator, in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mrrlens.plans.warehouse import shared_folder
from mrrlens.session import session_settings

# Spark then removes the shuffle files of a write as soon as it is done.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """A folder of its own below `spark.checkpoint.dir`, for one call of an operator.

    A written table cuts the lineage: what is read back does not depend on the
    executors that computed it. The operator's result may read these tables, so
    they stay until their owner removes `folder`.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = shared_folder(spark, temporary=True)
        self._tables = 0

    def keep(self, frame: DataFrame, settings: dict[str, str] | None = None) -> DataFrame:
        """Write a frame now and read it back."""
        self._tables += 1
        path = f"{self.folder}/table={self._tables}"
        with session_settings(self.spark, {SHUFFLE_CLEANUP: "true", **(settings or {})}):
            frame.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)
