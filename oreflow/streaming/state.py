"""Small state that a stream carries from batch to batch, as versioned tables.

Batch ``n`` reads version ``n - 1`` and writes version ``n``. A batch that is replayed
after a failure overwrites its own version, so every batch counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Versions that a table of state keeps: the one before, its own, and one to spare.
KEPT = 3


class VersionedTable:
    """With ``keep``, versions take turns in so many folders, so storage does not grow with the batches."""

    def __init__(self, folder: str, schema: str, keep: int | None = None):
        self.folder, self.keep = folder, keep
        self.schema = T.StructType.fromDDL(schema)

    def _path(self, batch_id: int) -> str:
        if self.keep:
            return f"{self.folder}/turn={batch_id % self.keep}"
        return f"{self.folder}/batch_id={batch_id}"

    def read(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Version of one batch; before the first batch the table is empty."""
        if batch_id < 0:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self._path(batch_id))

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.select(*self.schema.names).write.mode("overwrite").parquet(self._path(batch_id))

    def history(self, spark: SparkSession) -> DataFrame:
        """All versions, with their ``batch_id``; only for a table that keeps them all."""
        if self.keep:
            raise ValueError("this table keeps its last versions only")
        with_batch = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        return spark.read.schema(with_batch).parquet(self.folder)
