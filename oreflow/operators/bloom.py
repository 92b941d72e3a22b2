"""Bloom-filter membership of hashtags and its false positives.

The filter decides each arrival from the slots set so far. A slot is set from the first
arrival of any tag that hashes to it. So an arrival is answered "seen" wrongly exactly
when it is the first of its tag and earlier tags have set both of its slots. That needs
first arrivals only: no arrival has to be replayed in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.functions.text import jvm_hash
from oreflow.session import materialise

# The moduli of the two slot hashes. The filter has as many slots as the largest.
MODULI = (64, 59)
# Slot times of a filter up to this size are broadcast; those of a larger one are joined.
BROADCAST_SLOTS = 1 << 20
# Blocks that running totals are accumulated over.
BLOCKS = 4096


def slot(tag_hash: Column, modulus: int) -> Column:
    return F.abs(tag_hash % F.lit(modulus)).cast("int")


def first_arrivals(arrivals: DataFrame, exact_key: str = "hash") -> DataFrame:
    """(key, tag_hash, seq) of the first arrival of each tag, from (seq, tag).

    With ``hash`` the tags are told apart by hash code, with ``tag`` by their text.
    Text is hashed after the first reduction, once per distinct tag.
    """
    if exact_key not in ("hash", "tag"):
        raise ValueError("exact_key must be 'hash' or 'tag'")
    tags = arrivals.groupBy("tag").agg(F.min("seq").alias("seq")).withColumn("tag_hash", jvm_hash(F.col("tag")))
    key = "tag_hash" if exact_key == "hash" else "tag"
    return tags.groupBy(F.col(key).alias("key")).agg(F.min("seq").alias("seq"), F.min("tag_hash").alias("tag_hash"))


def slot_times(first: DataFrame, moduli: tuple[int, ...] = MODULI) -> DataFrame:
    """(slot, since): when each slot was set. At most one row per slot of the filter."""
    slots = F.array(*[slot(F.col("tag_hash"), m) for m in moduli])
    return first.select(F.explode(slots).alias("slot"), "seq").groupBy("slot").agg(F.min("seq").alias("since"))


def filter_words(times: DataFrame) -> DataFrame:
    """(word, bits): the filter itself, 32 slots to a word."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot") % 32)
    return times.groupBy(F.floor(F.col("slot") / 32).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))


def mark_false_positives(first: DataFrame, times: DataFrame, moduli: tuple[int, ...] = MODULI) -> DataFrame:
    """First arrivals with ``false_positive``: earlier tags had set every slot.

    ``times`` may have a column ``old`` that marks slots set before all of these arrivals.
    """
    if "old" not in times.columns:
        times = times.withColumn("old", F.lit(False))
    marked = first
    wrong = F.lit(True)
    for i, modulus in enumerate(moduli):
        side = times.select(F.col("slot").alias(f"slot{i}"), F.col("since").alias(f"since{i}"), F.col("old").alias(f"old{i}"))
        if max(moduli) <= BROADCAST_SLOTS:
            side = F.broadcast(side)
        marked = marked.withColumn(f"slot{i}", slot(F.col("tag_hash"), modulus)).join(side, f"slot{i}")
        wrong = wrong & (F.col(f"old{i}") | (F.col(f"since{i}") < F.col("seq")))
    return marked.select("key", "tag_hash", "seq", wrong.alias("false_positive"))


def false_positives(
    arrivals: DataFrame, moduli: tuple[int, ...] = MODULI, exact_key: str = "hash"
) -> DataFrame:
    """Every distinct tag with its first arrival and whether the filter got it wrong."""
    first = first_arrivals(arrivals, exact_key)
    return mark_false_positives(first, slot_times(first, moduli), moduli)


def summary(arrivals: DataFrame, moduli: tuple[int, ...] = MODULI, exact_key: str = "hash") -> DataFrame:
    """One row: arrivals answered rightly and wrongly, and unique tags."""
    marked = false_positives(arrivals, moduli, exact_key)
    total = arrivals.agg(F.count("*")).scalar()
    wrong = F.col("incorrect")
    return marked.agg(
        F.count("*").alias("unique_tags"), F.count_if("false_positive").alias("incorrect")
    ).select(total.alias("arrivals"), (total - wrong).alias("correct"), wrong, "unique_tags")


def running_totals(df: DataFrame, order: str, columns: list[str], blocks: int = BLOCKS) -> DataFrame:
    """Running sums of ``columns`` by the whole-numbered ``order``.

    The range of ``order`` is cut into blocks of equal width. Rows are summed inside
    their block, and only the sums of the blocks, whose number is fixed, are accumulated
    in one place.
    """
    ends = df.agg(F.min(order).alias("low"), F.max(order).alias("high")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    width = (high - low) // blocks + 1
    blocked = df.withColumn("_block", F.floor((F.col(order) - low) / width).cast("int"))
    sums = blocked.groupBy("_block").agg(*[F.sum(c).alias(f"_{c}") for c in columns])
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "_block", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in columns]
    )
    inside = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    running = blocked.select("*", *[F.sum(c).over(inside).alias(f"_in_{c}") for c in columns])
    totals = [(F.col(f"_{c}") + F.col(f"_in_{c}")).alias(f"total_{c}") for c in columns]
    return running.join(F.broadcast(offsets), "_block").select(*df.columns, *totals)


def batch_report(
    arrivals: DataFrame, batch: Column, moduli: tuple[int, ...] = MODULI, exact_key: str = "hash"
) -> DataFrame:
    """Per batch: right and wrong answers; over all batches so far: unique tags, wrong answers.

    ``arrivals`` is (seq, tag); ``batch`` gives the whole-numbered batch of a ``seq``, which
    rises with it.
    """
    marked = false_positives(arrivals, moduli, exact_key)
    sizes = arrivals.groupBy(batch.alias("batch")).agg(F.count("*").alias("arrivals"))
    firsts = marked.groupBy(batch.alias("batch")).agg(
        F.count("*").alias("new_tags"), F.count_if("false_positive").alias("incorrect")
    )
    per_batch = sizes.join(firsts, "batch", "left").select(
        "batch",
        "arrivals",
        F.coalesce("incorrect", F.lit(0)).cast("bigint").alias("incorrect"),
        F.coalesce("new_tags", F.lit(0)).cast("bigint").alias("new_tags"),
    )
    totals = running_totals(materialise(per_batch, "batches"), "batch", ["new_tags", "incorrect"])
    return totals.select(
        "batch",
        (F.col("arrivals") - F.col("incorrect")).alias("correct"),
        "incorrect",
        F.col("total_new_tags").alias("unique_tags"),
        F.col("total_incorrect").alias("false_positives"),
    )
