"""Near-duplicates by a chosen-path similarity join over sets of word shingles.

Equal sets are one item. In each of ``TREES`` independent trees an item walks down by its minwise
tokens: the token of its set that comes first under the hash function of tree and depth names the
branch. A node of few items is a leaf; larger ones branch again, down to the deepest level. Items
that share a leaf are compared in three steps:

1. Each item meets the first item of its leaves that its sketch agrees with; the similarity is
   confirmed on the full sets, and the links give components.
2. Of the other pairs of a leaf, those within one component cannot change the result. The rest are
   pairs of an item outside the leaf's main component and any item of another component. They are
   met in rounds of more and more items, with components merged in between. All
   those that agree in size, sketch and parity are confirmed on the full sets. The parity of a set
   is the number of its tokens, odd or even, in each of ``PARITY`` buckets: sets differ in at least as
   many tokens as parities, so it rejects no pair that reaches the threshold.
3. All links together give the final components.

A pair of similarity ``j`` meets in one tree with probability ``j ** depth``. At 0.8 all trees miss a
pair with probability 5e-10 at depth 2, 1.5e-5 at depth 4 and 2e-3 at depth 6; only nodes of more
than ``SMALL`` items go below depth 2. A sketch of 128 one-bit minwise values rejects a pair of
similarity 0.8 with a probability below 1e-8.

A null or empty text, and one of white space alone, has no set and is linked with nothing; a text
with fewer words than a shingle is one shingle of all its words. A row without an id is linked with
nothing. Rows that share an id are compared each by its own text; each row gets a result, and
repeats get equal ones. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import bounded_batches, documents_only
from oreflow.llm.components import connected_components
from oreflow.session import materialise

TREES, LEVELS, SMALL = 21, (2, 4, 6), 32
HASHES, AGREE = 128, 90
PARITY = 1024
FIRST, TIMES_MORE = 8, 8

_WORD = np.ones(256, dtype=bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.Generator(np.random.PCG64(20))
_FLIP = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_TIMES = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(raw: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``words`` words; all bytes of the text count."""
    inside = _WORD[raw]
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    lengths = ends - starts
    # Each byte times a power for its place in the word, summed by word.
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _ODD))
    sums = np.add.reduceat((_mixed(_LOWER[raw[inside]] + np.uint64(1))) * powers[place], np.cumsum(lengths) - lengths)
    hashes = _mixed(sums + lengths.astype(np.uint64))
    width = min(words, len(hashes))
    joined = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
    for k in range(width):
        joined = _mixed(joined * _ODD + hashes[k : len(hashes) - width + 1 + k])
    return np.unique(joined)


def _minwise(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each hash function."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for begin in range(0, len(shingles), 4096):
        part = shingles[begin : begin + 4096]
        for k in range(0, HASHES, 16):
            low[k : k + 16] = np.minimum(low[k : k + 16], ((part ^ _FLIP[k : k + 16, None]) * _TIMES[k : k + 16, None]).min(axis=1))
    return low


def _paths(low: np.ndarray) -> np.ndarray:
    """For every tree the node at each level, as a hash of the tokens on the way."""
    depth = max(LEVELS)
    tokens = low[: TREES * depth].reshape(TREES, depth)
    node, out = np.arange(TREES, dtype=np.uint64), []
    for d in range(depth):
        node = _mixed(node * _ODD + tokens[:, d])
        if d + 1 in LEVELS:
            out.append(node)
    return np.stack(out, axis=1).ravel().view(np.int64)


def _parity(shingles: np.ndarray) -> np.ndarray:
    """Whether the number of tokens in each bucket is odd, 64 buckets to a number."""
    counts = np.bincount((_mixed(shingles ^ _ODD) % np.uint64(PARITY)).astype(np.int64), minlength=PARITY)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _describe(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for text in batch.column("text"):
                shingles = shingle_set(np.frombuffer(text.as_buffer(), dtype=np.uint8), words)
                if len(shingles):
                    low = _minwise(shingles)
                    bits = np.packbits((_mixed(low) & np.uint64(1)).astype(np.uint8)).view(np.int64)
                    name = np.array([shingles.sum(dtype=np.uint64), np.bitwise_xor.reduce(_mixed(shingles + _ODD))]).tobytes()
                    values = [name, len(shingles), int(bits[0]), int(bits[1]), _paths(low), _parity(shingles)]
                else:
                    values = [None, 0, None, None, None, None]
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("version"), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))],
                ["doc_id", "version", "item", "n", "s1", "s2", "paths", "parity"],
            )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(np.frombuffer(text.as_buffer(), dtype=np.uint8), words).view(np.int64) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(sets, pa.list_(pa.int64()))], ["item", "set"])

    return run


def similar(a: str, b: str, percent: int) -> Column:
    """Whether sizes and sketches allow the pair's similarity to reach the threshold."""
    size = F.least(f"{a}.n", f"{b}.n") * 100 >= percent * F.greatest(f"{a}.n", f"{b}.n")
    apart = sum(F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in ("s1", "s2"))
    return size & (HASHES - apart >= AGREE)


def close_parity(a: str, b: str, percent: int) -> Column:
    """False only if the sets differ in more tokens than the threshold allows."""
    odd = sum(F.bit_count(F.col(f"{a}.p{k}").bitwiseXOR(F.col(f"{b}.p{k}"))) for k in range(PARITY // 64))
    return odd * (100 + percent) <= (100 - percent) * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def leaves(items: DataFrame) -> DataFrame:
    """(node, item, n, s1, s2): the items of every leaf with at least two."""
    kept = None
    walking = items.select("item", "n", "s1", "s2", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.slice("paths", t * len(LEVELS) + 1, len(LEVELS)))).alias("tree", "path")).drop("tree")
    for level in range(len(LEVELS)):
        named = walking.withColumn("node", F.col("path")[level])
        sizes = materialise(named.groupBy("node").agg(F.count("*").alias("size")).where("size > 1"), "nodes")
        last = level + 1 == len(LEVELS)
        found = materialise(named.join(sizes, "node").select("node", "size", "item", "n", "s1", "s2", *([] if last else ["path"])), "members")
        leaf = (found if last else found.where(F.col("size") <= SMALL)).select("node", "item", "n", "s1", "s2")
        kept = leaf if kept is None else kept.unionByName(leaf)
        if last:
            break
        walking = found.where(F.col("size") > SMALL).drop("node", "size")
    return kept


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, *more: str) -> DataFrame:
    """The pairs (a, b), with the columns ``more``, whose full sets reach the threshold."""
    first, second = sets.select(F.col("item").alias("a"), F.col("set").alias("set_a")), sets.select(F.col("item").alias("b"), F.col("set").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (
        materialise(pairs, "pairs").join(first, "a").join(second, "b")
        .where(100 * both >= percent * (F.size("set_a") + F.size("set_b") - both))
        .select("a", "b", *more)
    )


def classes(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, version, n_shingles, component_id) of every row; ``version`` is a hash of the text."""
    bounded_batches(docs.sparkSession)
    texts = documents_only(docs).withColumn("version", F.xxhash64("text"))
    described = materialise(
        texts.mapInArrow(
            _describe(words), "doc_id long, version long, item binary, n long, s1 long, s2 long, paths array<long>, parity array<long>"
        ),
        "described",
    )
    linked = described.where("doc_id IS NOT NULL AND item IS NOT NULL")
    # Of copies one stands for all; its row is where the text is read again.
    items = materialise(
        linked.groupBy("item").agg(*(F.first(c).alias(c) for c in ("n", "s1", "s2", "paths", "parity")), F.min(F.struct("doc_id", "version")).alias("row")), "items"
    )
    members = materialise(leaves(items), "leaves")

    a, b = members.alias("a"), members.alias("b")
    heads = materialise(members.groupBy("node").agg(F.min(F.struct("item", "n", "s1", "s2")).alias("head")).select("node", "head.*"), "heads")
    first = (
        b.join(heads.alias("a"), "node")
        .where((F.col("a.item") < F.col("b.item")) & similar("a", "b", percent))
        .groupBy(F.col("b.item").alias("b"))
        .agg(F.min("a.item").alias("a"))
    )
    stars = materialise(first.select("a", "b"), "stars")

    # Full sets of all items that have a leaf in common with an item of like sketch.
    close = _close_items(members, percent)
    rows = items.join(close, "item").select("item", "row.doc_id", "row.version")
    # Shuffled at every size: the items' number has no bound that would let them be broadcast.
    wanted = texts.join(materialise(rows, "close-rows").hint("merge"), ["doc_id", "version"]).dropDuplicates(["item"]).select("item", "text")
    sets = materialise(wanted.mapInArrow(_sets(words), "item binary, set array<long>"), "sets")

    links = materialise(confirmed(stars, sets, percent), "star-links")
    roots = materialise(connected_components(links).select(F.col("node").alias("item"), "root"), "star-roots")
    labelled = materialise(members.join(roots, "item", "left").withColumn("root", F.coalesce("root", "item")), "labelled")
    merged = _merge_crossing(labelled, items, stars, sets, percent)
    final = _follow(labelled.select("item", "root").distinct(), merged)

    owned = materialise(linked.select("item", "doc_id").distinct().join(final, "item", "left").select("doc_id", "item", F.coalesce("root", "item").alias("root")), "owned")
    lowest = materialise(owned.groupBy("root").agg(F.min("doc_id").alias("component_id")), "lowest")
    named = materialise(owned.join(lowest, "root").groupBy("item").agg(F.min("component_id").alias("component_id")), "named")
    return described.join(named.withColumnRenamed("item", "found"), F.col("item") == F.col("found"), "left").select(
        "doc_id",
        "version",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def _follow(rows: DataFrame, merged: DataFrame | None) -> DataFrame:
    """``rows`` with each root replaced by the one that it has been merged into."""
    if merged is None:
        return rows
    moved = rows.join(merged.select(F.col("node").alias("root"), F.col("root").alias("into")), "root", "left")
    return moved.withColumn("root", F.coalesce("into", "root")).drop("into")


def _merge_crossing(labelled: DataFrame, items: DataFrame, stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """(node, root): the components to merge, by links between items of one leaf but different components.

    An item outside its leaf's main component belongs with all items of the main one and with the later
    ones outside. It meets them in rounds: first about ``FIRST`` of the leaf, drawn by a hash, then
    ``TIMES_MORE`` times as many. What a round links is merged before the next, and pairs within a component
    are met no more: an item with many links to the main component finds some of them in an early
    round, and only items without any are compared with all.
    """
    counts = labelled.groupBy("node", "root").agg(F.count("*").alias("n_root"))
    mains = materialise(
        counts.groupBy("node").agg(F.max(F.struct("n_root", "root"))["root"].alias("main"), F.count("*").alias("n_roots"), F.sum("n_root").alias("size")).where("n_roots > 1"),
        "mains",
    )
    largest = mains.agg(F.max("size")).first()[0]
    if largest is None:
        return None
    rounds = _rounds(largest)
    parities = items.select("item", *(F.col("parity")[k].alias(f"p{k}") for k in range(PARITY // 64)))
    draw = F.pmod(F.xxhash64("item", "node"), F.lit(1 << 30)) / (1 << 30) * F.col("size")
    later = sum(((draw >= FIRST * TIMES_MORE**r).cast("int") for r in range(rounds - 1)), F.lit(0))
    mixed = materialise(
        labelled.join(mains, "node").join(parities, "item").withColumn("outside", F.col("root") != F.col("main")).withColumn("round", later).drop("main", "n_roots", "size"),
        "mixed",
    )
    merged, links = None, None
    for r in range(rounds):
        a = _follow(mixed.where("outside"), merged).alias("a")
        b = _follow(mixed.where(F.col("round") == r), merged).alias("b")
        crossing = a.join(b, "node").where(
            (F.col("a.root") != F.col("b.root"))
            & (~F.col("b.outside") | (F.col("a.item") < F.col("b.item")))
            & similar("a", "b", percent)
            & close_parity("a", "b", percent)
        )
        ordered = F.col("a.item") < F.col("b.item")
        pairs = crossing.select(
            F.least("a.item", "b.item").alias("a"),
            F.greatest("a.item", "b.item").alias("b"),
            F.when(ordered, F.col("a.root")).otherwise(F.col("b.root")).alias("root_a"),
            F.when(ordered, F.col("b.root")).otherwise(F.col("a.root")).alias("root_b"),
        ).distinct()
        found = confirmed(pairs.join(stars, ["a", "b"], "left_anti"), sets, percent, "root_a", "root_b")
        new = materialise(found.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(), "crossing-links")
        if not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            merged = materialise(connected_components(links), "merged")
    return merged


def _rounds(largest: int) -> int:
    """The number of rounds after which all items of a leaf of ``largest`` have been met."""
    rounds = 1
    while FIRST * TIMES_MORE ** (rounds - 1) < largest:
        rounds += 1
    return rounds


def _close_items(members: DataFrame, percent: int) -> DataFrame:
    """The items that are worth a look at their full sets.

    In a small leaf those with a partner of like size and sketch; in a large one, all. Neither
    gathers pairs: a partner is enough, and large leaves hold few items that share none.
    """
    sizes = members.groupBy("node").agg(F.count("*").alias("size"))
    sized = materialise(members.join(materialise(sizes, "leaf-sizes"), "node"), "sized")
    small = sized.where(F.col("size") <= SMALL)
    a, b = small.alias("a"), small.alias("b")
    paired = a.join(b, "node").where((F.col("a.item") < F.col("b.item")) & similar("a", "b", percent)).select(F.explode(F.array("a.item", "b.item")).alias("item"))
    return materialise(paired.unionByName(sized.where(F.col("size") > SMALL).select("item")).distinct(), "close")


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their class, and those without an id, with all columns."""
    kept = classes(docs, words, percent).where("doc_id IS NULL OR doc_id = component_id").select("doc_id", "version").distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    joined = rows.join(
        kept.select(F.struct("doc_id", "version").alias("found")),
        F.col("row.doc_id").cast("long").eqNullSafe(F.col("found.doc_id")) & (F.xxhash64(F.coalesce("row.text", F.lit(""))) == F.col("found.version")),
        "left_semi",
    )
    return joined.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def digest(docs: DataFrame, words: int = 2, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    return classes(docs, words, percent).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
