"""A uniform sample of all messages so far, with its hot hashtags after each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from oreflow.operators.messages import HOT_TAGS, SAMPLE_SIZE, SEED, bottom_k, sample_report
from oreflow.sources.reports import start_reports
from oreflow.streaming.state import KEPT, VersionedTable


class ReservoirStream:
    """State: the sample and the number of messages seen, both a few rows."""

    def __init__(self, folder: str, k: int = SAMPLE_SIZE, seed: int = SEED, n_tags: int = HOT_TAGS):
        self.folder, self.k, self.seed, self.n_tags = folder, k, seed, n_tags
        self.sample = VersionedTable(f"{folder}/sample", "id bigint, text string, seen bigint", keep=KEPT)
        self.reports = VersionedTable(f"{folder}/reports", "seen bigint, hot_tags string, mean_length double")

    def start(self, messages: DataFrame, until_done: bool = False) -> StreamingQuery:
        return start_reports(messages.select("id", "text"), self.run_batch, f"{self.folder}/checkpoint", until_done)

    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self.sample.read(spark, batch_id - 1)
        seen_before = before.agg(F.max("seen")).first()[0] or 0
        batch = batch.persist()
        try:
            seen = seen_before + batch.count()
            # A few rows, taken while the batch is held.
            best = spark.createDataFrame(bottom_k(batch, self.k, self.seed).select("id", "text").collect(), "id bigint, text string")
        finally:
            batch.unpersist()
        both = before.select("id", "text").unionByName(best)
        kept = bottom_k(both, self.k, self.seed).select("id", "text", F.lit(seen).cast("bigint").alias("seen"))
        self.sample.write(kept, batch_id)
        now = self.sample.read(spark, batch_id)
        self.reports.write(sample_report(now, seen, self.n_tags), batch_id)
