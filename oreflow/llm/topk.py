"""Exact top-k search by inner product.

Queries are dealt into blocks and vectors into shards. Each pair of block and shard is one
tile: a matrix product, a partial selection of every query's best ``k``, and one short list
per query. The lists meet in a merge tree of bounded fan-in.

Null vectors, vectors that hold null or non-finite components, and rows without an id take no part,
nor do vectors with a component of ``RANGE`` or more after scaling. Vectors of another length than the
query's are no candidates of it. Rows, not ids, are queries and candidates: only a query's own row
is left out, and repeated rows or others that share its id are candidates and queries of
their own. Products are exact; a score beyond the range of a long is the end of that range. Ties go to the
smaller id. An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.session import materialise

# Rows of a block of queries, of a shard of vectors and of the strip of a shard that is multiplied at once.
BLOCK, SHARD, STRIP = 8192, 32768, 512
# Scaled components stay below this.
RANGE = 2.0**62
LEAST, MOST = -(1 << 63), (1 << 63) - 1
# Lists that meet in one step of the merge tree.
FAN_IN = 16

LISTS = "part long, query_row long, query_id long, vec_id long, score long"
NO_LIST = pd.DataFrame({"part": [], "query_row": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, scale: float) -> DataFrame:
    """(row, vec_id, v, dims): every usable vector as integers ``floor(scale * x)``; ``row`` tells rows apart."""
    fits = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(F.lit(scale) * x) < F.lit(RANGE)))
    usable = (
        vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
        .where(F.col("vec_id").isNotNull() & fits)
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", F.transform("v", lambda x: F.floor(F.lit(scale) * x)).alias("v"))
    )
    # Stored, so that queries and candidates see one numbering.
    return materialise(usable.withColumn("dims", F.size("v")), "vectors")


def _products(queries: np.ndarray, strip: np.ndarray) -> np.ndarray:
    """Integer inner products; floating-point products only where every partial sum is exact."""
    bound = int(np.abs(queries).max(initial=0)) * int(np.abs(strip).max(initial=0)) * max(1, queries.shape[1])
    if bound < 1 << 53:
        return (queries.astype(np.float64) @ strip.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return queries @ strip.T
    exact = queries.astype(object) @ strip.astype(object).T
    return np.minimum(np.maximum(exact, LEAST), MOST).astype(np.int64)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Column numbers of each row's ``k`` best scores; ids ascend along every row, so ties go to the left."""
    width = scores.shape[1]
    if width <= k:
        return np.broadcast_to(np.arange(width), scores.shape)
    if max(int(scores.max(initial=0)), -int(scores.min(initial=0))) < (1 << 62) // width:
        keyed = scores * width + (width - 1 - np.arange(width))
        return np.sort(np.argpartition(keyed, width - k, axis=1)[:, width - k :], axis=1)
    order = np.argsort(-scores.astype(object), axis=1, kind="stable")[:, :k]
    return np.sort(order, axis=1)


def _tile(k: int):
    def search(key: tuple, queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        lists = []
        if queries.empty or vectors.empty:
            return NO_LIST
        for dims, block in queries.groupby("size"):
            shard = vectors[vectors["dims"] == dims].sort_values("vec_id", kind="stable")
            if shard.empty:
                continue
            ids, numbers = shard["vec_id"].to_numpy(), shard["row"].to_numpy()
            for _, batch in block.groupby(np.arange(len(block)) // BLOCK):
                asked = np.array(batch["q"].tolist(), dtype=np.int64).reshape(len(batch), dims)
                own, own_ids = batch["query_row"].to_numpy(), batch["query_id"].to_numpy()
                found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                for begin in range(0, len(ids), STRIP):
                    strip_ids = ids[begin : begin + STRIP]
                    strip = np.array(shard["v"].iloc[begin : begin + STRIP].tolist(), dtype=np.int64).reshape(len(strip_ids), dims)
                    scores = _products(asked, strip)
                    # One more than asked, as the query's own row may be among the best.
                    best = _best(scores, k + 1)
                    rows = np.repeat(np.arange(len(own)), best.shape[1])
                    columns = best.ravel()
                    other = numbers[begin : begin + STRIP][columns] != own[rows]
                    found.append((rows[other], strip_ids[columns[other]], scores[rows[other], columns[other]]))
                    if len(found) > 8 or begin + STRIP >= len(ids):
                        rows, near, score = (np.concatenate(x) for x in zip(*found, strict=True))
                        order = np.lexsort((near, ~score, rows))
                        rows, near, score = rows[order], near[order], score[order]
                        first = np.searchsorted(rows, rows, "left")
                        keep = np.arange(len(rows)) - first < k
                        found = [(rows[keep], near[keep], score[keep])]
                rows, near, score = found[0]
                lists.append(pd.DataFrame({"part": key[1], "query_row": own[rows], "query_id": own_ids[rows], "vec_id": near, "score": score}))
        return pd.concat([NO_LIST, *lists])

    return search


def _keep_best(lists: DataFrame, k: int, *group: str) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: float = 64.0,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows for each row where ``is_query`` holds, one list per row.

    ``is_query`` is a condition on ``vec_id``.
    """
    usable = whole_vectors(vectors, id_column, vector_column, scale)
    # New columns: two sides of one cogroup must not share any.
    asked = usable.where(is_query).select(
        (F.col("row") + 0).alias("query_row"),
        (F.col("vec_id") + 0).alias("query_id"),
        F.slice("v", 1, F.size("v")).alias("q"),
        (F.col("dims") + 0).alias("size"),
    )
    n_vectors, n_queries = usable.count(), asked.count()
    shards, blocks = max(1, math.ceil(n_vectors / SHARD)), max(1, math.ceil(n_queries / BLOCK))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    shards = max(shards, min(cores, math.ceil(n_vectors / STRIP)))

    def dealt(rows: DataFrame, own: str, n: int, other: str, copies: int) -> DataFrame:
        """Each row in one of ``n`` parts by its hash, copied to every part of the other side."""
        return rows.select(
            "*",
            F.pmod(F.xxhash64(rows.columns[0]), F.lit(n).cast("long")).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias(other),
        )

    lists = (
        dealt(asked, "block", blocks, "part", shards)
        .groupBy("block", "part")
        .cogroup(dealt(usable, "part", shards, "block", blocks).groupBy("block", "part"))
        .applyInPandas(_tile(k), LISTS)
    )
    while shards > FAN_IN:
        shards = math.ceil(shards / FAN_IN)
        lists = _keep_best(lists.withColumn("part", F.floor(F.col("part") / FAN_IN)), k, "query_row", "part").drop("rank")
    return _keep_best(lists, k, "query_row").select("query_id", "rank", "vec_id", "score")
