"""Writers of the report formats.

Sorted reports are range-partitioned: the part files, taken in name order, are the
report. Nothing is brought together in one task; a caller who wants one file of a small
report asks for it with ``one_file``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from oreflow.functions.text import label_of

# Fixed value: seconds between micro-batches.
BATCH_SECONDS = 10


def write_csv(df: DataFrame, path: str, order: list[str] | None = None, one_file: bool = False) -> None:
    """A CSV report; fields that hold a comma are quoted."""
    rows = df.orderBy(*order) if order else df
    (rows.coalesce(1) if one_file else rows).write.mode("overwrite").csv(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """``"user","item","rating"`` rows by user, then item, every field quoted."""
    rows = predictions.select(
        F.col("user").cast("string").alias("user"),
        F.col("item").cast("string").alias("item"),
        F.col("prediction").cast("string").alias("rating"),
    )
    rows.orderBy("user", "item").write.mode("overwrite").option("quoteAll", True).csv(path)


def itemset_pieces(found: DataFrame) -> DataFrame:
    """Labels with what goes before them, so that one line holds all sets of a size.

    The pieces are short of their closing bracket, which the writer adds as the record
    separator. A size with millions of itemsets is thus written row by row.
    """
    labelled = found.select("size", label_of(F.col("items")).alias("label"))
    heads = labelled.groupBy("size").agg(F.min("label").alias("head"))
    first_size = heads.agg(F.min("size")).first()[0]
    lead: Column = (
        F.when(F.col("label") != F.col("head"), ", ").when(F.col("size") == first_size, "").otherwise("\n\n")
    )
    piece = F.concat(lead, F.expr("substring(label, 1, length(label) - 1)"))
    # One row per itemset size. All parts of a frequent set are frequent, so a set of m
    # items stands for 2^m reported rows and there are few sizes.
    return labelled.join(F.broadcast(heads), "size").select("size", "label", piece.alias("value"))


def write_itemsets(found: DataFrame, path: str) -> None:
    """``(a, b), (a, c)`` with one line per size and an empty line between sizes."""
    rows = itemset_pieces(found).orderBy("size", "label").select("value")
    rows.write.mode("overwrite").option("lineSep", ")").text(path)


def write_clusters(reported: DataFrame, path: str) -> None:
    """A cluster report as one JSON object."""
    reported.write.mode("overwrite").json(path)


def start_reports(
    stream: DataFrame,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    until_done: bool = False,
    output_mode: str = "append",
) -> StreamingQuery:
    """Run ``each_batch`` on every micro-batch, every ten seconds or until the input is read."""
    writer = stream.writeStream.outputMode(output_mode).foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    if until_done:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{BATCH_SECONDS} seconds").start()
