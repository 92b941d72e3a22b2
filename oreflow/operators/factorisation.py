"""Rating prediction by matrix factorisation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.session import materialise, scratch_root

# Fixed values of the factorisation.
RANK = 2
ITERATIONS = 40
REGULARISATION = 0.28
SEED = 42

SIDES = ("user", "item")
# Blocks of the library solver. Its starting factors depend on them, so they don't follow the data.
BLOCKS = 10

# Ids that are numbered in one bucket, on average, and the fewest buckets.
BUCKET_IDS, FEWEST_BUCKETS = 1_000_000, 1024


def dense_index(ids: DataFrame, name: str) -> DataFrame:
    """Number the distinct ids 0, 1, 2, ... without bringing them to one place.

    Ids are numbered inside hash buckets; each bucket starts where the ones before
    it end. Only the sizes of the buckets, one row for up to a million ids, are ranked
    as a whole. ``ids`` is read once; what follows reads the distinct ones.
    """
    counted = materialise(ids.groupBy(name).agg(F.count("*").alias("rows")), "ids")
    buckets = max(FEWEST_BUCKETS, (counted.agg(F.sum("rows")).first()[0] or 0) // BUCKET_IDS)
    placed = counted.select(name, F.pmod(F.xxhash64(name), F.lit(buckets)).alias("bucket"))
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("size"))
    placed = placed.withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy(name)))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    index = placed.join(F.broadcast(starts), "bucket")
    return index.select(name, (F.col("start") + F.col("place") - 1).cast("int").alias(f"{name}_idx"))


def extend_index(index: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """The index with unseen ids numbered after the ones it has."""
    unseen = ids.select(name).distinct().join(index, name, "left_anti")
    start = index.count()
    added = dense_index(unseen, name)
    return index.unionByName(added.withColumn(f"{name}_idx", (F.col(f"{name}_idx") + start).cast("int")))


@dataclass(frozen=True)
class Factorisation:
    """Factors per id, with the id numbering they were trained on."""

    user_factors: DataFrame
    item_factors: DataFrame
    users: DataFrame
    items: DataFrame

    def predict(self, test: DataFrame, *more: str) -> DataFrame:
        """(user, item, ``more`` columns of the row, prediction); pairs with an id unseen in training give no row."""
        product = F.zip_with("user_factor", "item_factor", lambda a, b: a * b)
        return (
            test.select("user", "item", *more)
            .join(self.users.join(self.user_factors, "user_idx"), "user")
            .join(self.items.join(self.item_factors, "item_idx"), "item")
            .select("user", "item", *more, F.aggregate(product, F.lit(0.0), lambda a, b: a + b).alias("prediction"))
        )


def fit(
    train: DataFrame,
    rank: int = RANK,
    iterations: int = ITERATIONS,
    regularisation: float = REGULARISATION,
    seed: int = SEED,
    blocks: int = BLOCKS,
    solver: str = "library",
) -> Factorisation:
    """Explicit-feedback alternating least squares on (user, item, rating).

    The ``library`` solver keeps all ratings of an id in one block. Its predictions depend on ``blocks``, so
    their number is the caller's: about one for two million ratings. The solver by ``sums`` lets an id have any
    number of ratings and needs no blocks. The two start differently, so which one runs is for the caller to say.
    """
    if solver not in ("library", "sums"):
        raise ValueError("solver must be 'library' or 'sums'")
    scratch_root(train.sparkSession)  # so that the library solver can cut its lineage there
    users = materialise(dense_index(train, "user"), "user-index")
    items = materialise(dense_index(train, "item"), "item-index")
    numbered = (
        train.join(users, "user")
        .join(items, "item")
        .select("user_idx", "item_idx", F.col("rating").cast("float").alias("rating"))
    )
    if solver == "sums":
        numbered = materialise(numbered, "numbered")
        user_factors, item_factors = _fit_by_sums(numbered, items, rank, iterations, regularisation, seed)
        return Factorisation(user_factors, item_factors, users, items)

    # The library sorts each block's ratings by user; it merges runs that are sorted faster.
    numbered = materialise(numbered.sortWithinPartitions("user_idx"), "numbered")
    als = ALS(
        rank=rank,
        maxIter=iterations,
        regParam=regularisation,
        seed=seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        userCol="user_idx",
        itemCol="item_idx",
        ratingCol="rating",
        checkpointInterval=10,
    )
    model = als.fit(numbered)

    def factors(of: DataFrame, side: str) -> DataFrame:
        values = F.col("features").cast("array<double>").alias(f"{side}_factor")
        return materialise(of.select(F.col("id").alias(f"{side}_idx"), values), f"{side}-factors")

    return Factorisation(factors(model.userFactors, "user"), factors(model.itemFactors, "item"), users, items)


def hashed_start(key: Column, place: int, seed: int) -> Column:
    """A number from 0.1 to 1.1 for an id and a place of its factor, which any engine with md5 repeats."""
    digest = F.md5(F.concat(F.lit(f"{seed}-{place}-"), key.cast("string")).cast("binary"))
    return F.conv(F.left(digest, F.lit(8)), 16, 10).cast("double") / float(1 << 32) + 0.1


def _fit_by_sums(
    numbered: DataFrame, items: DataFrame, rank: int, iterations: int, regularisation: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Alternating least squares whose normal equations are grouped sums.

    Sums are formed per task before the shuffle, so an id may have any number of
    ratings: what meets in one place is one small equation per task and id.
    """
    start = F.array(*(hashed_start(F.col("item"), i, seed) for i in range(rank)))
    item_factors = materialise(items.select("item_idx", start.alias("item_factor")), "item-factors")
    user_factors = None
    for _ in range(iterations):
        user_factors = _solve(numbered, item_factors, "item", "user", rank, regularisation)
        item_factors = _solve(numbered, user_factors, "user", "item", rank, regularisation)
    return user_factors, item_factors


def _solve(ratings: DataFrame, fixed: DataFrame, known: str, wanted: str, rank: int, regularisation: float) -> DataFrame:
    """The best factors of one side for given factors of the other.

    The lower triangle of each id's normal equations is summed; elimination and back substitution are
    column expressions, one step per place of the factor.
    """
    f = [F.col(f"{known}_factor")[i] for i in range(rank)]
    r = F.col("rating").cast("double")
    more = regularisation * F.count("*")
    products = [(F.sum(f[i] * f[j]) + (more if i == j else 0.0)).alias(f"a{i}_{j}") for i in range(rank) for j in range(i + 1)]
    targets = [F.sum(r * f[i]).alias(f"b{i}") for i in range(rank)]
    solved = ratings.join(fixed, f"{known}_idx").groupBy(f"{wanted}_idx").agg(*products, *targets)
    for k in range(rank - 1):
        below = range(k + 1, rank)
        ratio = {i: F.col(f"a{i}_{k}") / F.col(f"a{k}_{k}") for i in below}
        solved = solved.withColumns(
            {f"a{i}_{j}": F.col(f"a{i}_{j}") - ratio[i] * F.col(f"a{j}_{k}") for i in below for j in range(k + 1, i + 1)}
            | {f"b{i}": F.col(f"b{i}") - ratio[i] * F.col(f"b{k}") for i in below}
        )
    for i in reversed(range(rank)):
        rest = F.col(f"b{i}")
        for j in range(i + 1, rank):
            rest = rest - F.col(f"a{j}_{i}") * F.col(f"x{j}")
        solved = solved.withColumn(f"x{i}", rest / F.col(f"a{i}_{i}"))
    factor = F.array(*(F.col(f"x{i}") for i in range(rank))).alias(f"{wanted}_factor")
    return materialise(solved.select(f"{wanted}_idx", factor), f"{wanted}-factors")
