from __future__ import annotations

import glob
import random
import re
import time
from collections import Counter
from itertools import combinations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oreflow.operators import itemsets
from oreflow.session import scratch_path
from oreflow.sources import reports


def brute_force(baskets, support):
    found = {}
    items = sorted({i for b in baskets.values() for i in b})
    size, level = 1, [(i,) for i in items]
    while level:
        counts = {c: sum(1 for b in baskets.values() if b.issuperset(c)) for c in level}
        kept = {c: n for c, n in counts.items() if n >= support}
        found.update(kept)
        size += 1
        alive = sorted({i for c in kept for i in c})
        level = list(combinations(alive, size)) if size <= 5 else []
    return found


def collected(df):
    return {tuple(r["items"]): r["freq"] for r in df.collect()}


def test_small(spark):
    rows = [("1", "a"), ("1", "b"), ("2", "a"), ("2", "b"), ("2", "c"), ("3", "a"), ("3", "a")]
    df = spark.createDataFrame(rows, "basket_id string, item string")
    for method in ("prefixes", "fpgrowth"):
        found = itemsets.frequent_itemsets(df, 2, method)
        assert collected(found) == {("a",): 3, ("b",): 2, ("a", "b"): 2}
        assert {r["size"] for r in found.collect()} == {1, 2}


def test_nothing_frequent(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "basket_id string, item string")
    for method in ("prefixes", "fpgrowth"):
        assert itemsets.frequent_itemsets(df, 2, method).count() == 0


def skewed(seed):
    """Random baskets, one item in most of them, one basket with a third of all rows."""
    rng = random.Random(seed)
    baskets = {f"b{i}": {f"x{int(rng.triangular(0, 25, 0)):02d}" for _ in range(rng.randint(1, 9))} for i in range(300)}
    for name in rng.sample(sorted(baskets), 250):
        baskets[name].add("everywhere")
    baskets["giant"] = {f"x{i:02d}" for i in range(25)} | {f"only{i}" for i in range(700)}
    return baskets


@pytest.mark.parametrize("task_rows", [10**9, 400, 16])
def test_prefixes_equal_brute_force(spark, task_rows):
    baskets = skewed(task_rows)
    df = spark.createDataFrame([(b, i) for b, s in baskets.items() for i in s], "basket_id string, item string")
    found = itemsets.frequent_itemsets(df, 20, task_rows=task_rows)
    assert found.count() == found.select("items").distinct().count()
    assert collected(found) == brute_force(baskets, 20)


def test_integer_items_sort_as_numbers(spark):
    rows = [(b, i) for b in range(3) for i in (2, 10, 100)]
    df = spark.createDataFrame(rows, "basket_id bigint, item bigint")
    assert (2, 10, 100) in collected(itemsets.frequent_itemsets(df, 3))


def test_hot_item_is_dealt_evenly(spark):
    """One item holds a third of three million rows; no task gets more than twice the median, at any support."""
    rows = spark.range(1_000_000).select(
        F.col("id").alias("basket_id"),
        F.explode(F.array(F.lit(0), *(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(200)).cast("int") + 1 for k in range(2)))).alias("item"),
    )
    baskets = itemsets.build_baskets(rows)
    for support in (500, 5000):
        ordered = itemsets._ordered(baskets.join(itemsets.frequent_items(baskets, support), "item"))
        table = itemsets.extensions(None, ordered)
        counted = itemsets._counted(table, support)
        work = counted.agg(F.sum("work"), F.max("work")).first()
        # Rarer items come first, so the item of all baskets has nothing after it and its sets are its partners'.
        assert counted.filter("item = 0").first()["work"] == 0
        assert work[1] * itemsets.SPLIT * 8 <= 20 * work[0]
        sizes = sorted(r["count"] for r in itemsets.task_tables(table, counted.filter("work > 0"), 16).groupBy("task").count().collect())
        assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]


def test_large_tables_are_split_by_further_items(spark, monkeypatch):
    rounds = []
    real = itemsets.extensions

    def counting(parents, ordered):
        rounds.append(parents)
        return real(parents, ordered)

    monkeypatch.setattr(itemsets, "extensions", counting)
    baskets = {b: set(range(12)) - {b % 12} for b in range(60)}
    df = spark.createDataFrame([(b, i) for b, s in baskets.items() for i in s], "basket_id int, item int")
    assert collected(itemsets.frequent_itemsets(df, 35, task_rows=64)) == brute_force(baskets, 35)
    assert len(rounds) > 2


def test_supports_shrink_with_size_and_threshold(spark):
    baskets = skewed(3)
    df = spark.createDataFrame([(b, i) for b, s in baskets.items() for i in s], "basket_id string, item string")
    low, high = collected(itemsets.frequent_itemsets(df, 15)), collected(itemsets.frequent_itemsets(df, 30))
    assert high == {k: n for k, n in low.items() if n >= 30}
    for found, n in low.items():
        for smaller in combinations(found, len(found) - 1):
            assert not smaller or low[smaller] >= n


def test_report_file(spark):
    rows = [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (3, "c"), (4, "a"), (4, "c"), (4, "b")]
    df = spark.createDataFrame(rows, "basket_id int, item string")
    path = scratch_path(spark, "itemsets")
    reports.write_itemsets(itemsets.frequent_itemsets(df, 2), path)
    text = "".join(open(f).read() for f in sorted(glob.glob(f"{path}/part-*")))
    assert text == "(a), (b), (c)\n\n(a, b), (a, c)"


def test_validation(spark):
    df = spark.createDataFrame([("1", "a")], "basket_id string, item string")
    with pytest.raises(ValueError):
        itemsets.frequent_itemsets(df, 0)
    with pytest.raises(ValueError):
        itemsets.frequent_itemsets(df, 1, "other")


def spread_baskets(spark):
    """Baskets of ten of 400 items, no pair of which is frequent."""
    items = F.array(*(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(400)) for k in range(10)))
    rows = spark.range(400).select(F.col("id").alias("basket_id"), F.explode(items).alias("item"))
    return rows.distinct()


def test_large_tables_without_frequent_extensions_are_not_written(spark, monkeypatch):
    written = []
    real = itemsets.materialise
    monkeypatch.setattr(itemsets, "materialise", lambda df, label: written.append(label) or real(df, label))
    found = itemsets.frequent_itemsets(spread_baskets(spark), 8, task_rows=16)
    assert {r["size"] for r in found.select("size").distinct().collect()} == {1}
    assert "projected" not in written and "often" in written


def test_tasks_get_one_row_per_basket(spark):
    baskets = spread_baskets(spark)
    ordered = itemsets._ordered(baskets.join(itemsets.frequent_items(baskets, 8), "item"))
    counted = itemsets._counted(ordered, 8).filter("work > 0")
    dealt = itemsets.task_tables(ordered, counted, 4)
    assert dealt.count() <= 4 * 400
    # All own items of all tasks are those that have later ones.
    assert dealt.agg(F.sum(F.size(F.filter("own", lambda o: o)))).first()[0] == ordered.join(counted, "item").count()


def test_library_miner_gets_paired_items_only(spark, monkeypatch):
    def refuse(**options):
        raise AssertionError("no pair is frequent")

    monkeypatch.setattr(itemsets, "FPGrowth", refuse)
    found = collected(itemsets.frequent_itemsets(spread_baskets(spark), 8, "fpgrowth"))
    assert found and {len(items) for items in found} == {1}


def test_library_miner_equals_brute_force(spark):
    baskets = skewed(5)
    df = spark.createDataFrame([(b, i) for b, s in baskets.items() for i in s], "basket_id string, item string")
    assert collected(itemsets.frequent_itemsets(df, 20, "fpgrowth")) == brute_force(baskets, 20)


def test_null_items_are_in_no_set(spark):
    df = spark.createDataFrame([(b, i) for b in range(4) for i in ("a", "b", None)], "basket_id int, item string")
    for method in ("prefixes", "fpgrowth"):
        assert collected(itemsets.frequent_itemsets(df, 3, method)) == {("a",): 4, ("b",): 4, ("a", "b"): 4}


def test_dealt_baskets_are_sorted_in_parts(spark, monkeypatch):
    """F9-F12: partitions follow the rows that are dealt, whatever the session's number, and find the same sets."""
    assert itemsets.dealt_parts(0, 4) == itemsets.dealt_parts(itemsets.SORTED_ROWS, 4) == 4
    assert itemsets.dealt_parts(50 * itemsets.SORTED_ROWS, 4) == 50
    assert itemsets.dealt_parts(5000 * itemsets.SORTED_ROWS, 4) == itemsets.MOST_PARTS
    rng = random.Random(5)
    baskets = {b: {rng.randrange(12) for _ in range(6)} for b in range(80)}
    rows = spark.createDataFrame([(b, i) for b, items in baskets.items() for i in items], "basket_id long, item long")
    monkeypatch.setattr(itemsets, "SORTED_ROWS", 10)
    assert collected(itemsets.frequent_itemsets(rows, 8)) == brute_force(baskets, 8)


def pair_counts(prefix_baskets):
    """How many baskets of each prefix hold two items, the first of them marked as large."""
    counts = Counter()
    for prefix, items, owners, parts in prefix_baskets:
        counts.update(((*prefix, items[i]), j) for i in range(len(items)) if owners[i] is not None and owners[i] < 0 for j in items[i + 1 :])
    return counts


def shuffled_blocks(monkeypatch, baskets, n_items, support, counted_rows, chunk):
    """What the two sides of the count of large tables make of baskets that come ``chunk`` at a time, and the bytes between them."""
    monkeypatch.setattr(itemsets, "COUNTED_ROWS", counted_rows)
    schema = pa.schema([("prefix", pa.list_(pa.int32())), ("items", pa.list_(pa.int32())), ("owners", pa.list_(pa.int32())), ("parts", pa.int32())])
    columns = [dict(zip(schema.names, b, strict=True)) for b in baskets]
    batches = [pa.RecordBatch.from_pylist(columns[i : i + chunk], schema) for i in range(0, len(columns), chunk)]
    sent = pa.Table.from_batches(list(itemsets._pair_blocks(n_items)(iter(batches))))
    rows = sorted(sent.to_pylist(), key=lambda r: (r["prefix"], r["part"]))
    got = {}
    for batch in itemsets._block_sums(n_items, support)(iter(pa.Table.from_pylist(rows, sent.schema).to_batches(max_chunksize=7))):
        for r in batch.to_pylist():
            assert (key := (tuple(r["prefix"]), r["item"])) not in got
            got[key] = r["freq"]
    return got, sum(len(r["cells"]) for r in rows)


@pytest.mark.parametrize("parts", [[1], [8], [1, 4, 2]])
def test_counts_of_large_tables_equal_brute_force(monkeypatch, parts):
    """whatever the prefixes, their parts and the pairs that are counted at a time."""
    rng = random.Random(3)
    baskets = []
    for i in range(300):
        of = i % len(parts)
        items = sorted(rng.sample(range(37), rng.randint(1, 9)) + [40])
        baskets.append(([] if len(parts) == 1 else [50 + of], items, [rng.choice((-parts[of], 0, None)) for _ in items], parts[of]))
    for counted_rows, chunk in ((10**6, 1000), (60, 16), (1, 3)):
        got, _ = shuffled_blocks(monkeypatch, baskets, 53, 5, counted_rows, chunk)
        assert got == {pair: n for pair, n in pair_counts(baskets).items() if n >= 5}


def test_cells_of_many_items_fit(monkeypatch):
    """prefixes whose cells together don't fit 64 bits are counted apart."""
    n = 1_500_000_000
    baskets = [([p], [p, n - 2, n - 1], [-2, -2, None], 2) for p in range(9) for _ in range(2)]
    got, _ = shuffled_blocks(monkeypatch, baskets, n, 2, 10**6, 100)
    assert got == {pair: 2 for pair in pair_counts(baskets)} and len(got) == 27


def test_counts_of_large_tables_travel_in_two_bytes_a_pair(monkeypatch):
    """as arrays of items they took four, and as much again where they did not fit memory."""
    rng = random.Random(4)
    baskets = [([], sorted(rng.sample(range(20_000), 40)), [-4] * 40, 4) for _ in range(1500)]
    _, size = shuffled_blocks(monkeypatch, baskets, 20_000, 1, 10**6, 10_000)
    assert size <= 2 * 1500 * 40 * 39 / 2


def test_summed_in_parts(spark, monkeypatch):
    """large tables of all rounds in several parts."""
    monkeypatch.setattr(itemsets, "TASK_ROWS", 200)
    baskets = skewed(11)
    df = spark.createDataFrame([(b, i) for b, s in baskets.items() for i in s], "basket_id string, item string")
    assert collected(itemsets.frequent_itemsets(df, 30, task_rows=16)) == brute_force(baskets, 30)
    assert collected(itemsets.frequent_itemsets(df, 30, "fpgrowth")) == brute_force(baskets, 30)


def test_shuffle_files_go_when_a_step_is_written(spark):
    """they stayed until the driver happened to collect its garbage."""

    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (re.match(r"shuffle_(\d+)_", blocks.apply(i).getName()) for i in range(blocks.size()))
        return {m[1] for m in names if m}

    before, step = shuffles(), spark.range(100_000).repartition(4, "id")
    stored = itemsets.materialise(step, "step")
    for _ in range(30):
        if not (left := shuffles() - before):
            break
        time.sleep(0.1)
    assert not left and stored.distinct().count() == step.count() == 100_000


def test_items_are_numbered_by_frequency(spark):
    rows = [(None, 5), ("b", 2), ("a", 2), ("c", 1), ("é", 9)]
    singles = spark.createDataFrame(rows, "item string, freq bigint")
    numbered = itemsets._numbered(singles.repartition(4))
    assert {r["item"]: r["number"] for r in numbered.collect()} == {"c": 0, "a": 1, "b": 2, "é": 3}
