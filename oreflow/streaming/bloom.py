"""Bloom-filter answers on a stream of messages, reported after each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from oreflow.functions.text import jvm_hash
from oreflow.operators.bloom import MODULI, mark_false_positives, slot_times
from oreflow.operators.messages import tag_arrivals
from oreflow.sources.reports import start_reports
from oreflow.streaming.state import KEPT, VersionedTable


def sequenced(messages: DataFrame) -> DataFrame:
    """(seq, tag): every hashtag with its place in the whole sequence of messages.

    ``seq`` is a struct of the message's id and the tag's position in it, in this order.
    """
    return tag_arrivals(messages).select(F.struct("id", "position").alias("seq"), "tag")


class BloomStream:
    """The exact tag set lives in the state store, the slots in a table of fixed size.

    The stream keeps, for every tag, the time of the batch that it first came in and its
    first place: minima that are formed per task before the shuffle. A batch touches only
    its own tags, and a tag is new when its first batch is this one. A key of its own, null,
    counts all arrivals. So one reading of the batch gives everything.
    """

    def __init__(self, folder: str, moduli: tuple[int, ...] = MODULI, exact_key: str = "hash"):
        if exact_key not in ("hash", "tag"):
            raise ValueError("exact_key must be 'hash' or 'tag'")
        self.folder, self.moduli, self.exact_key = folder, moduli, exact_key
        self.slots = VersionedTable(f"{folder}/slots", "slot int", keep=KEPT)
        self.reports = VersionedTable(
            f"{folder}/reports",
            "correct bigint, incorrect bigint, unique_tags bigint, false_positives bigint, arrivals bigint",
        )

    def start(self, messages: DataFrame, until_done: bool = False) -> StreamingQuery:
        tags = sequenced(messages).withColumn("tag_hash", jvm_hash(F.col("tag")))
        key = F.col("tag_hash" if self.exact_key == "hash" else "tag").cast("string")
        # The time is the batch's, the same when the batch is run again.
        now = F.current_timestamp()
        rows = tags.select(
            F.explode(
                F.array(
                    F.struct(key.alias("key"), "tag_hash", F.struct(now.alias("time"), "seq").alias("first"), now.alias("last")),
                    F.struct(F.lit(None).cast("string").alias("key"), "tag_hash", F.struct(now.alias("time"), "seq").alias("first"), now.alias("last")),
                )
            ).alias("row")
        ).select("row.*")
        running = rows.groupBy("key").agg(
            F.min("tag_hash").alias("tag_hash"), F.min("first").alias("first"), F.max("last").alias("last"), F.count("*").alias("running")
        )
        return start_reports(running, self.run_batch, f"{self.folder}/checkpoint", until_done, output_mode="update")

    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        """A batch that holds nothing leaves the slots as they are and reports zeros."""
        spark = batch.sparkSession
        tags = batch.persist()
        before = self.reports.read(spark, batch_id - 1).first()
        try:
            total = tags.filter("key IS NULL").select("running").first()
            total = total[0] if total else (before["arrivals"] if before else 0)
            first = tags.filter("key IS NOT NULL AND first.time = last").select("key", "tag_hash", F.col("first.seq").alias("seq"))
            new_times = slot_times(first, self.moduli)
            # A slot set in an earlier batch was set before anything in this one: it gets no time.
            older = self.slots.read(spark, batch_id - 1).distinct()
            times = new_times.join(older.withColumn("old", F.lit(True)), "slot", "full").select("slot", "since", F.coalesce("old", F.lit(False)).alias("old"))
            marked = mark_false_positives(first, times, self.moduli)
            counts = marked.agg(F.count("*").alias("new_tags"), F.count_if("false_positive").alias("incorrect")).first()
            self.slots.write(older.unionByName(new_times.select("slot")).distinct(), batch_id)
        finally:
            tags.unpersist()
        arrivals = total - (before["arrivals"] if before else 0)
        unique = counts["new_tags"] + (before["unique_tags"] if before else 0)
        wrong = counts["incorrect"] + (before["false_positives"] if before else 0)
        row = (arrivals - counts["incorrect"], counts["incorrect"], unique, wrong, total)
        self.reports.write(spark.createDataFrame([row], self.reports.schema), batch_id)
