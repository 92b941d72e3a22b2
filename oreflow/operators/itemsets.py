"""Exact frequent itemsets over baskets, of every size.

Sets are enumerated as a tree: a set's children add one item that comes later in a fixed order, rarer
items first. What a set needs to grow is its projected table: the baskets that hold it, with their
items after its last one. Frequent items go by their number, the rarest first. Projected tables travel as one array
per basket and set. Small ones are dealt to tasks by the hash of their set and mined there to the end. The extensions of
large ones are counted where the baskets are, a bounded number at a time, and the counts summed; only what is frequent is
written as the table of the next round. So no task holds more than its share, however often one item occurs.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.text import label_of
from oreflow.session import materialise_lean as materialise

# Rows of projected tables that a task aims for, at most and, where more tasks would leave little to each, at least.
TASK_ROWS, LEAST_ROWS = 2_000_000, 1_000_000
# A table above this part of a task's rows is split by its next item.
SPLIT = 16
# Rows of projected tables that one partition of dealt baskets stands for, so that it is sorted in memory, and the most
# partitions, beyond which writers sort their rows, too.
SORTED_ROWS, MOST_PARTS = 8_000_000, 200
# Rows of large projected tables that are counted at a time, and that a task aims for.
COUNTED_ROWS, COUNTING_ROWS = 4_000_000, 16_000_000


def build_baskets(rows: DataFrame) -> DataFrame:
    """Baskets as distinct (basket_id, item) rows; a basket is never gathered into one row."""
    return rows.select("basket_id", "item").distinct()


def frequent_items(baskets: DataFrame, support: int) -> DataFrame:
    """(item, freq) of the items that at least ``support`` baskets hold."""
    return baskets.groupBy("item").agg(F.count("*").alias("freq")).filter(F.col("freq") >= support)


def frequent_itemsets(rows: DataFrame, support: int, method: str = "prefixes", task_rows: int = TASK_ROWS) -> DataFrame:
    """(items, size, freq) of all itemsets held by at least ``support`` baskets.

    Items inside a set ascend. ``prefixes`` grows sets by prefix-projected tables; ``fpgrowth`` uses the
    library miner. Both are exact. A task mines about ``task_rows`` rows of projected tables, or fewer if
    there are few. Neither this nor the number of tasks depends on the support.
    """
    if support < 1:
        raise ValueError("support must be at least 1")
    if method not in ("prefixes", "fpgrowth"):
        raise ValueError("method must be 'prefixes' or 'fpgrowth'")
    baskets = materialise(build_baskets(rows), "baskets")
    singles = materialise(_numbered(frequent_items(baskets, support)), "items")
    # Items below the support are in no frequent set; the others go by their number.
    numbers = singles.select("item", "number")
    ordered = _ordered(baskets.join(numbers, "item").select("basket_id", F.col("number").alias("item")))
    if method == "fpgrowth":
        return _canonical(_mine_with_fpgrowth(ordered, singles, support, task_rows), numbers)
    return _canonical(_mine_prefixes(ordered, support, task_rows), numbers)


def _numbered(singles: DataFrame) -> DataFrame:
    """(item, freq, number): the items numbered 0, 1, 2, ... from the rarest on, equally rare ones in order.

    Items are sorted in ranges; only the sizes of the ranges are summed up in one place.
    """
    ranges = singles.where("item IS NOT NULL").repartitionByRange("freq", "item").sortWithinPartitions("freq", "item")
    # The upper bits hold the range, the lower 33 the place in it.
    placed = materialise(ranges.withColumn("at", F.monotonically_increasing_id()), "sorted-items").withColumn("range", F.shiftright("at", 33))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("range").agg(F.count("*").alias("size"))
    starts = sizes.select("range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    number = F.col("start") + F.col("at") - F.shiftleft("range", 33)
    return placed.join(F.broadcast(starts), "range").select("item", "freq", number.cast("int").alias("number"))


def _ordered(pruned: DataFrame) -> DataFrame:
    """(basket_id, item, place, later): each item's place in its basket and how many items follow it.

    Rarer items come first; where there is no ``freq``, items are numbers in that order.
    """
    basket = Window.partitionBy("basket_id")
    place = F.row_number().over(basket.orderBy(*[c for c in ("freq", "item") if c in pruned.columns]))
    numbered = pruned.select("basket_id", "item", place.alias("place"), F.count("*").over(basket).alias("n"))
    return materialise(numbered.select("basket_id", "item", "place", (F.col("n") - F.col("place")).cast("int").alias("later")), "ordered-baskets")


def _canonical(found: DataFrame, numbers: DataFrame) -> DataFrame:
    """(items, size, freq) of sets of item numbers."""
    each = found.select("items", "freq", F.explode("items").alias("number")).join(numbers, "number")
    named = each.groupBy("items", "freq").agg(F.array_sort(F.collect_list("item")).alias("named"))
    return named.select(F.col("named").alias("items"), F.size("items").alias("size"), F.col("freq").cast("bigint").alias("freq"))


def _mine_with_fpgrowth(ordered: DataFrame, singles: DataFrame, support: int, task_rows: int) -> DataFrame:
    """The library miner on what is left of the baskets without items that are in no frequent pair."""
    alone = singles.select(F.array("number").alias("items"), "freq")
    size = ordered.agg(F.sum("later")).first()[0] or 0
    owners = singles.select(F.col("number").alias("item"), F.lit(-_parts(size)).alias("owner"))
    every = materialise(_marked(ordered, owners), "marked-baskets")
    pairs = materialise(frequent_extensions(every, support, size, singles.count()), "pairs")
    paired = pairs.select(F.col("prefix")[0].alias("item")).union(pairs.select("item")).distinct()
    left = ordered.join(paired, "item", "left_semi").groupBy("basket_id").agg(F.collect_list("item").alias("items"))
    arrays = materialise(left.where(F.size("items") > 1).select("items"), "basket-arrays")
    total = arrays.count()
    if total < support:
        return alone
    # Half a basket of margin keeps the fraction from rounding across the threshold.
    work = arrays.agg(F.sum(F.size("items") * (F.size("items") - 1) / 2)).first()[0]
    parts = max(ordered.sparkSession.sparkContext.defaultParallelism, int(work // task_rows))
    miner = FPGrowth(itemsCol="items", minSupport=(support - 0.5) / total, numPartitions=parts)
    found = miner.fit(arrays).freqItemsets
    return alone.unionByName(found.filter((F.col("freq") >= support) & (F.size("items") > 1)).select("items", "freq"))


def extensions(parents: DataFrame | None, rows: DataFrame) -> DataFrame:
    """(prefix, basket_id, item, place, later): the projected tables of all ``parents`` (prefix, basket_id, items).

    Of their items only the frequent extensions (prefix, item) in ``rows`` stay. Without parents ``rows`` is the table
    itself, as the projection of the empty set, and has no prefix.
    """
    if parents is None:
        return rows
    often = rows.select("prefix", "item")
    grows = parents.join(often.select("prefix").distinct(), "prefix", "left_semi")
    each = grows.select("prefix", "basket_id", F.posexplode("items").alias("at", "item")).join(often, ["prefix", "item"])
    basket = Window.partitionBy("prefix", "basket_id")
    numbered = each.select(
        "prefix", "basket_id", "item", F.row_number().over(basket.orderBy("at")).alias("place"), F.count("*").over(basket).alias("n")
    )
    return numbered.select("prefix", "basket_id", "item", "place", (F.col("n") - F.col("place")).alias("later"))


def _prefix(table: DataFrame) -> list[str]:
    return [c for c in table.columns if c == "prefix"]


def _longer(table: DataFrame) -> Column:
    """The prefix of a row with its item."""
    return F.concat("prefix", F.array("item")) if _prefix(table) else F.array("item")


def _counted(table: DataFrame, support: int) -> DataFrame:
    """(prefix, item, freq, work) of the frequent extensions; ``work`` is the number of rows of their own tables."""
    counts = table.groupBy(*_prefix(table), "item").agg(F.count("*").alias("freq"), F.sum("later").alias("work"))
    return counts.filter(F.col("freq") >= support)


def _marked(table: DataFrame, owners: DataFrame) -> DataFrame:
    """(prefix, basket_id, items, owners) of a table's baskets: the items in order, and the ``owner`` of each (prefix, item), if any.

    A basket's row is short beside its work, which is half the square of its frequent items.
    """
    prefix = _prefix(table)
    each = table.join(owners, [*prefix, "item"], "left")
    cells = F.sort_array(F.collect_list(F.struct("place", "item", "owner")))
    packed = each.groupBy(*prefix, "basket_id").agg(cells.alias("cells"))
    return packed.select(*prefix, "basket_id", F.col("cells.item").alias("items"), F.col("cells.owner").alias("owners"))


def dealt_tables(marked: DataFrame) -> DataFrame:
    """(task, prefix, items, own): what each task needs to mine the extensions whose owner, from 0 on, it is.

    A basket comes once per task and prefix, from the task's first item there on; ``own`` marks the task's items.
    """
    prefix = _prefix(marked)
    dealt = marked.select(*prefix, "items", "owners", F.explode(F.array_distinct(F.filter("owners", lambda o: o >= 0))).alias("task"))
    start = F.array_position("owners", F.col("task")).cast("int")
    count = F.size("items") - start + 1
    own = F.transform(F.slice("owners", start, count), lambda o: F.coalesce(o == F.col("task"), F.lit(False)))
    return dealt.select("task", *prefix, F.slice("items", start, count).alias("items"), own.alias("own"))


def dealt_parts(work: int, cores: int) -> int:
    """Partitions of the ``dealt_tables`` of extensions with ``work`` rows in all."""
    return max(cores, min(-(-work // SORTED_ROWS), MOST_PARTS))


def task_tables(table: DataFrame, small: DataFrame, tasks: int) -> DataFrame:
    """The ``dealt_tables`` of the ``small`` extensions of a table, dealt by their hash."""
    prefix = _prefix(table)
    return dealt_tables(_marked(table, small.select(*prefix, "item", _owner(prefix, tasks).alias("owner"))))


def _owner(prefix: list[str], tasks: int) -> Column:
    return F.pmod(F.xxhash64(*prefix, "item"), F.lit(tasks)).cast("int")


def children(marked: DataFrame) -> DataFrame:
    """(prefix, basket_id, items): the projected tables of the extensions with an owner below 0, one row per basket."""
    prefix = _prefix(marked)
    each = marked.select(*prefix, "basket_id", "items", F.posexplode("owners").alias("at", "owner")).where("owner < 0 AND at + 1 < size(items)")
    item = F.get("items", F.col("at"))
    longer = F.concat("prefix", F.array(item)) if prefix else F.array(item)
    rest = F.slice("items", F.col("at") + 2, F.size("items") - F.col("at") - 1)
    return each.select(longer.alias("prefix"), "basket_id", rest.alias("items"))


def _parts(work: int) -> int:
    """Parts in which the extensions of large tables of ``work`` rows in all are summed: a power of two."""
    return 1 << (-(-work // TASK_ROWS) - 1).bit_length() if work else 1


def frequent_extensions(marked: DataFrame, support: int, size: int, n_items: int) -> DataFrame:
    """(prefix, item, freq) of the frequent extensions of all ``children`` of ``marked``, which have ``size`` rows in all.

    Items are numbers below ``n_items``. The owner, below 0, tells in how many parts the counts of a prefix are summed: -4
    means four. Children are not formed: a task counts the pairs of its baskets' items and sends, per prefix and part, the
    sorted pairs as bytes. A part has its share of every item's partners, so one item in very many baskets is in all parts.
    """
    cores = marked.sparkSession.sparkContext.defaultParallelism
    parts = -F.array_min(F.filter("owners", lambda o: o < 0))
    large = marked.withColumn("parts", parts).where("parts > 0")
    tasks = max(cores, -(-size // COUNTING_ROWS))
    if _prefix(marked):
        piece = F.pmod(F.xxhash64("basket_id"), F.col("parts"))
        spread = large.repartition(tasks, "prefix", piece).sortWithinPartitions("prefix")
    else:
        spread = large.withColumn("prefix", F.array().cast(T.ArrayType(marked.schema["items"].dataType.elementType))).repartition(tasks, "basket_id")
    sent = spread.select("prefix", "items", "owners", "parts").mapInArrow(_pair_blocks(n_items), "prefix array<int>, parts int, part int, cells binary")
    dealt = sent.repartition(max(cores, -(-size // (4 * TASK_ROWS))), "prefix", "part").sortWithinPartitions("prefix", "part")
    return dealt.mapInArrow(_block_sums(n_items, support), "prefix array<int>, item int, freq bigint")


def _pair_blocks(n_items: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (prefix, parts, part, cells) of baskets (prefix, items, owners, parts), some ``COUNTED_ROWS`` pairs at a time."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            lengths = np.diff(batch.column("items").offsets.to_numpy()).astype(np.int64)
            size += int((lengths * (lengths - 1) // 2).sum())
            if size > COUNTED_ROWS:
                yield from _counted_pairs(pa.Table.from_batches(held), n_items)
                held, size = [], 0
        if size:
            yield from _counted_pairs(pa.Table.from_batches(held), n_items)

    return blocks


def _counted_pairs(rows: pa.Table, n_items: int) -> Iterator[pa.RecordBatch]:
    prefixes, kept = _prefix_codes(rows.column("prefix"))
    parts = np.ones(len(kept), dtype=np.int64)
    parts[prefixes] = rows.column("parts").to_numpy()
    lists = rows.column("items").combine_chunks()
    items = lists.flatten().to_numpy().astype(np.int64)
    large = pc.fill_null(pc.less(rows.column("owners").combine_chunks().flatten(), 0), False).to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    ends, of = np.repeat(np.cumsum(sizes), sizes), np.repeat(prefixes, sizes)
    # So many prefixes, at a time, whose cells fit 64 bits.
    most = max(1, 2**62 // int((parts * _span(parts, n_items)).max()))
    for low in range(0, len(kept), most):
        at = np.flatnonzero(large & (ends - np.arange(len(items)) > 1) & (of >= low) & (of < low + most))
        n_pairs = np.cumsum(ends[at] - at - 1)
        cuts = np.searchsorted(n_pairs, np.arange(COUNTED_ROWS, n_pairs[-1], COUNTED_ROWS)) + 1 if len(at) else []
        for some in np.split(at, cuts):
            if len(some):
                cells, counts = _distinct_cells(some, items, ends, of - low, parts[low : low + most], n_items)
                yield _blocks(cells, counts, parts[low : low + most], kept[low : low + most], n_items)


def _span(parts: np.ndarray | int, n_items: int) -> np.ndarray | int:
    """The cells of a part: for each item a share of its partners."""
    return n_items * (n_items // parts + 1)


def _distinct_cells(at: np.ndarray, items: np.ndarray, ends: np.ndarray, of: np.ndarray, parts: np.ndarray, n_items: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of the items at some places with the later ones of their baskets, as sorted cells, and how often each occurs.

    Cells go by prefix, then by part, which is the sum of both items modulo ``parts``, then by first and second item.
    """
    n_later = ends[at] - at - 1
    width = int((parts * _span(parts, n_items)).max())
    if (parts == parts[0]).all():
        of_pair, p = (lambda x: x), int(parts[0])
    else:
        of_pair, p = (lambda x: np.repeat(x, n_later)), parts[of[at]]
    first = np.repeat(items[at], n_later)
    second = items[_ranges(at + 1, ends[at])]
    cells = np.repeat(of[at] * width + items[at] * (n_items // p + 1), n_later)
    first += second
    first &= of_pair(p - 1)
    first *= of_pair(_span(p, n_items))
    cells += first
    second //= of_pair(p)
    cells += second
    cells.sort()
    begins = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
    return cells[begins], np.diff(begins, append=len(cells))


def _blocks(cells: np.ndarray, counts: np.ndarray, parts: np.ndarray, kept: list[tuple], n_items: int) -> pa.RecordBatch:
    width = int((parts * _span(parts, n_items)).max())
    span = _span(parts, n_items)
    block = cells // width
    block = block * int(parts.max()) + cells % width // span[block]
    begins = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    owner, part = np.divmod(block[begins], int(parts.max()))
    steps = np.diff(cells, prepend=0)
    steps[begins] = cells[begins] - owner * width - part * span[owner]
    ends = np.append(begins[1:], len(cells))
    packed = [_packed(steps[i:j], counts[i:j]) for i, j in zip(begins.tolist(), ends.tolist(), strict=True)]
    names = pa.array([kept[i] for i in owner.tolist()], pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays(
        [names, pa.array(parts[owner], pa.int32()), pa.array(part, pa.int32()), pa.array(packed, pa.binary())], ["prefix", "parts", "part", "cells"]
    )


def _packed(steps: np.ndarray, counts: np.ndarray) -> bytes:
    """Both, counts less 1, byte by byte: all lowest bytes first, as far as any is above 0, each place compressed by itself."""
    planes, widths = [], []
    for numbers in (steps, counts - 1):
        widths.append((int(numbers.max()).bit_length() + 7) // 8)
        bytes_of = numbers.astype("<i8").view(np.uint8).reshape(-1, 8)
        planes.extend(pa.compress(np.ascontiguousarray(bytes_of[:, k]), codec="zstd", asbytes=True) for k in range(widths[-1]))
    return struct.pack(f"<QBB{len(planes)}Q", len(steps), *widths, *map(len, planes)) + b"".join(planes)


def _unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The cells within their part, and the counts."""
    n, *widths = struct.unpack_from("<QBB", block)
    sizes, at, numbers = iter(struct.unpack_from(f"<{sum(widths)}Q", block, 10)), 10 + 8 * sum(widths), []
    for width in widths:
        bytes_of = np.zeros((n, 8), dtype=np.uint8)
        for k in range(width):
            size = next(sizes)
            bytes_of[:, k] = np.frombuffer(pa.decompress(block[at : at + size], n, codec="zstd", asbytes=True), dtype=np.uint8)
            at += size
        numbers.append(bytes_of.view("<i8").reshape(-1))
    return np.cumsum(numbers[0]), numbers[1] + 1


def _block_sums(n_items: int, support: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(prefix, item, freq) of the frequent pairs in blocks (prefix, parts, part, cells) that are sorted by prefix and part."""

    def summed(key: tuple, blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        prefix, parts, part = key
        cells, counts = (np.concatenate(x) for x in zip(*map(_unpacked, blocks), strict=True))
        order = np.argsort(cells, kind="stable")
        cells = cells[order]
        begins = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
        freq = np.add.reduceat(counts[order], begins)
        often = freq >= support
        if not often.any():
            return
        first, second = np.divmod(cells[begins][often], n_items // parts + 1)
        second = second * parts + ((part - first) & (parts - 1))
        longer = pa.array([[*prefix, i] for i in first.tolist()], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([longer, pa.array(second, pa.int32()), pa.array(freq[often], pa.int64())], ["prefix", "item", "freq"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("prefix", "parts", "part")), strict=True)
            for (prefix, parts, part), cells in zip(keys, batch.column("cells").to_pylist(), strict=True):
                key = (tuple(prefix), parts, part)
                if key != last and held:
                    yield from summed(last, held)
                    held = []
                last = key
                held.append(cells)
        if held:
            yield from summed(last, held)

    return sums


def _prefix_codes(column: pa.ChunkedArray) -> tuple[np.ndarray, list[tuple]]:
    """A number for each row's prefix, and the prefixes by number."""
    known: dict[tuple, int] = {}
    codes = np.fromiter((known.setdefault(tuple(p), len(known)) for p in column.to_pylist()), dtype=np.int64, count=len(column))
    return codes, list(known)


def _codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each value, and the values by number."""
    encoded = values.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def _mine_prefixes(ordered: DataFrame, support: int, task_rows: int) -> DataFrame:
    item_type = ordered.schema["item"].dataType
    schema = T.StructType([T.StructField("items", T.ArrayType(item_type)), T.StructField("freq", T.LongType())])
    cores = ordered.sparkSession.sparkContext.defaultParallelism
    found, parents, rows, n_items = None, None, ordered, 0
    while True:
        table = extensions(parents, rows)
        if parents is not None:
            table = materialise(table, "projected")
        counted = materialise(_counted(table, support), "extensions")
        n_items = n_items or counted.count()
        sets = counted.select(_longer(counted).alias("items"), "freq")
        found = sets if found is None else found.unionByName(sets)

        open_sets = counted.filter("work > 0")
        size = open_sets.agg(F.sum("work")).first()[0] or 0
        share = min(task_rows, max(-(-size // cores), LEAST_ROWS))
        limit = max(1, share // SPLIT)
        sizes = open_sets.agg(
            F.sum(F.when(F.col("work") <= limit, F.col("work"))).alias("small"), F.sum(F.when(F.col("work") > limit, F.col("work"))).alias("large")
        ).first()
        # Half of a task's share on average, so that the sum of those that meet by chance stays near it.
        tasks = max(cores, -(-2 * (sizes["small"] or 0) // share))
        parts = F.lit(_parts(sizes["large"] or 0))
        if _prefix(table):
            large = F.sum(F.when(F.col("work") > limit, F.col("work"))).over(Window.partitionBy("prefix"))
            parts = F.pow(F.lit(2.0), F.ceil(F.log2(F.ceil(large / TASK_ROWS))))
        owner = F.when(F.col("work") <= limit, _owner(_prefix(table), tasks)).otherwise(-parts.cast("int"))
        # Rows without a basket id share no basket, so they are in no set of two.
        named = table.where("basket_id IS NOT NULL")
        marked = materialise(_marked(named, open_sets.select(*_prefix(table), "item", owner.alias("owner"))), "marked-baskets")
        if sizes["small"]:
            dealt = dealt_tables(marked).repartition(dealt_parts(sizes["small"], cores), "task")
            mined = dealt.groupBy("task").applyInArrow(local_miner(support), schema)
            found = found.unionByName(materialise(mined, "mined"))
        if not sizes["large"]:
            return found
        parents = children(marked)
        rows = materialise(frequent_extensions(marked, support, sizes["large"], n_items), "often")
        if rows.isEmpty():
            return found


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    sizes = ends - starts
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _grow(prefix: list, items: np.ndarray, ends: np.ndarray, allowed: np.ndarray | None, names: list, support: int, out: tuple[list, list]) -> None:
    """Adds all frequent sets that extend ``prefix`` by two items or more, or by one where ``allowed`` is none.

    ``items`` are the rows of the projected table, basket by basket; ``ends`` is where each row's basket ends.
    ``allowed`` marks the rows whose item may come first.
    """
    pending = [(prefix, items, ends, allowed)]
    frequent = np.zeros(len(names), dtype=bool)
    while pending:
        prefix, items, ends, allowed = pending.pop()
        first = np.arange(len(items)) if allowed is None else np.flatnonzero(allowed)
        order = first[np.argsort(items[first], kind="stable")]
        codes, begins = np.unique(items[order], return_index=True)
        for code, begin, end in zip(codes.tolist(), begins.tolist(), [*begins[1:].tolist(), len(order)], strict=True):
            at = order[begin:end]
            later = items[_ranges(at + 1, ends[at])]
            if len(at) < support or not len(later):
                continue
            # Where a task has far more items than this table has rows, its own ones are counted.
            if len(names) > 8 * len(later):
                seen, counts = np.unique(later, return_counts=True)
            else:
                counts = np.bincount(later, minlength=len(names))
                seen = np.arange(len(names))
            often, counts = seen[counts >= support], counts[counts >= support]
            if not len(often):
                continue
            grown = [*prefix, names[code]]
            out[0].extend([*grown, names[i]] for i in often.tolist())
            out[1].extend(counts.tolist())
            if len(often) > 1:
                # The child's table holds frequent items only.
                frequent[often] = True
                sizes = ends[at] - at - 1
                keep = frequent[later]
                frequent[often] = False
                left = np.add.reduceat(keep, np.cumsum(sizes[sizes > 0]) - sizes[sizes > 0], dtype=np.int64)
                pending.append((grown, later[keep], np.repeat(np.cumsum(left), left), None))


def local_miner(support: int) -> Callable[[pa.Table], pa.Table]:
    """Frequent itemsets of one task: those that extend a prefix, if there is any, by one of the task's own items and at least one later item."""

    def mine(task: pa.Table) -> pa.Table:
        out: tuple[list, list] = ([], [])
        item_type = task.schema.field("items").type.value_type
        if "prefix" in task.column_names:
            owner, prefixes = _prefix_codes(task.column("prefix"))
        else:
            owner, prefixes = np.zeros(len(task), dtype=np.int64), [()]
        for code, prefix in enumerate(prefixes):
            rows = task if len(prefixes) == 1 else task.filter(pa.array(owner == code))
            lists = rows.column("items").combine_chunks()
            codes, names = _codes(lists.flatten())
            own = rows.column("own").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(lists.offsets.to_numpy())
            _grow(list(prefix), codes, np.repeat(np.cumsum(sizes), sizes), own, names.to_pylist(), support, out)
        return pa.table({"items": pa.array(out[0], pa.list_(item_type)), "freq": pa.array(out[1], pa.int64())})

    return mine


def itemset_report(found: DataFrame) -> DataFrame:
    """Labels such as ``(a, b)`` by size, then in order, one row each."""
    return found.select("size", label_of(F.col("items")).alias("label"), "freq").orderBy("size", "label")


def size_summary(found: DataFrame) -> DataFrame:
    """Number of frequent itemsets of each size."""
    return found.groupBy("size").agg(F.count("*").alias("n")).orderBy("size")
