"""Library clustering and cluster reports."""

from __future__ import annotations

from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.operators import lloyd
from oreflow.operators.features import LIBRARY_BUCKETS, OWN_BUCKETS, each_word, hashed_vectors
from oreflow.session import materialise

# Seed of the library algorithms and words shown per cluster.
SEED = 42
TOP_TERMS = 10
# Coordinates of centres that are broadcast.
BROADCAST_CELLS = 1 << 22


def metrics(assigned: DataFrame) -> DataFrame:
    """Per cluster: size, sum of squared distances, and sum of their squares."""
    d2 = F.col("distance2")
    return assigned.groupBy("cluster").agg(
        F.count("*").alias("size"), F.sum(d2).alias("error"), F.sum(d2 * d2).alias("sum_sq_error")
    )


def total_error(measured: DataFrame) -> DataFrame:
    """WSSE over all clusters of ``metrics``."""
    return measured.agg(F.sum("error").alias("wsse"), F.sum("sum_sq_error").alias("sum_sq_error"))


def word_counts(worded: DataFrame) -> DataFrame:
    """(cluster, word, n): every occurrence counts for its document's cluster."""
    return each_word(worded, "cluster").groupBy("cluster", "word").agg(F.count("*").alias("n"))


def top_terms(worded: DataFrame, n: int = TOP_TERMS) -> DataFrame:
    """The ``n`` most frequent words of each cluster, ties in word order.

    Every task keeps its own top ``n`` before the shuffle, so even one cluster with
    all documents brings few rows to the final ranking.
    """
    ranking = Window.partitionBy("cluster").orderBy(F.desc("n"), "word")
    ranked = word_counts(worded).withColumn("place", F.row_number().over(ranking))
    return ranked.filter(F.col("place") <= n)


def report(algorithm: str, assigned: DataFrame, worded: DataFrame) -> DataFrame:
    """One row (algorithm, WSSE, clusters) with a nested entry per cluster.

    The entry of a cluster holds id (from 1), size, error and top terms. There are as
    many entries as clusters and ten words in each.
    """
    terms = (
        top_terms(worded)
        .groupBy("cluster")
        .agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("ranked"))
        .select("cluster", F.col("ranked.word").alias("terms"))
    )
    entries = metrics(assigned).join(terms, "cluster", "left")
    entry = F.struct(
        (F.col("cluster") + 1).alias("id"),
        "size",
        "error",
        F.coalesce("terms", F.array().cast("array<string>")).alias("terms"),
    )
    return entries.agg(
        F.sum("error").alias("WSSE"),
        F.array_sort(F.collect_list(entry)).alias("clusters"),
    ).select(F.lit(algorithm).alias("algorithm"), "WSSE", "clusters")


def flat_report(reported: DataFrame) -> DataFrame:
    """A report with one row per cluster."""
    return reported.select("algorithm", "WSSE", F.explode("clusters").alias("c")).select(
        "algorithm", "WSSE", "c.id", "c.size", "c.error", F.array_join("c.terms", " ").alias("terms")
    )


def own_report(documents: DataFrame, feature: str, k: int, iterations: int, buckets: int = OWN_BUCKETS) -> DataFrame:
    """Own k-means on term frequencies (``W``) or TF-IDF (``T``)."""
    vectors = hashed_vectors(documents, buckets, feature)
    parts = F.unwrap_udt(F.col("features"))
    points = materialise(
        vectors.select("doc_id", "words", parts["indices"].alias("idx"), parts["values"].alias("val")), "points"
    )
    centroids = lloyd.fit_sparse(points.select("doc_id", "idx", "val"), "doc_id", k, iterations, buckets)
    assigned = lloyd.assign(points.select("doc_id", "idx", "val"), "doc_id", centroids)
    assigned = materialise(assigned, "assigned")
    return report("K-Means", assigned, points.select("doc_id", "words").join(assigned, "doc_id"))


def library_report(
    documents: DataFrame, algorithm: str, k: int, iterations: int, buckets: int = LIBRARY_BUCKETS
) -> DataFrame:
    """Library clustering of TF-IDF vectors: ``K`` for k-means, ``B`` for bisecting k-means."""
    makers = {"K": ("K-Means", KMeans), "B": ("Bisecting K-Means", BisectingKMeans)}
    if algorithm not in makers:
        raise ValueError("algorithm must be 'K' (k-means) or 'B' (bisecting k-means)")
    name, maker = makers[algorithm]
    vectors = materialise(
        hashed_vectors(documents, buckets, "T").select("doc_id", "words", "features"), "vectors"
    )
    model = maker(k=k, maxIter=iterations, seed=SEED, predictionCol="cluster").fit(vectors)
    assigned = materialise(
        with_distances(model.transform(vectors), [c.tolist() for c in model.clusterCenters()]).select(
            "words", "cluster", "distance2"
        ),
        "assigned",
    )
    return report(name, assigned, assigned)


def with_distances(assigned: DataFrame, centres: list[list[float]]) -> DataFrame:
    """Squared distance of each vector to the centre of its own cluster."""
    spark = assigned.sparkSession
    rows = [(i, centre) for i, centre in enumerate(centres)]
    table = spark.createDataFrame(rows, "cluster int, centre array<double>")
    squares = F.zip_with(vector_to_array("features"), "centre", lambda x, c: (x - c) * (x - c))
    # Centres of a checked size go to every task, larger ones meet their cluster's vectors in a join.
    joined = assigned.join(F.broadcast(table) if len(rows) * len(centres[0]) <= BROADCAST_CELLS else table, "cluster")
    return joined.withColumn("distance2", F.aggregate(squares, F.lit(0.0), lambda a, x: a + x)).drop("centre")


def mixture_summary(documents: DataFrame, k: int, iterations: int, buckets: int = LIBRARY_BUCKETS) -> DataFrame:
    """Gaussian mixture of TF-IDF vectors: weight, mean magnitude and covariance per component.

    ``sigma`` is the covariance matrix row by row, ``buckets`` squared numbers.
    """
    vectors = materialise(hashed_vectors(documents, buckets, "T").select("features"), "vectors")
    model = GaussianMixture(k=k, maxIter=iterations, seed=SEED).fit(vectors)
    gaussians = model.gaussiansDF.collect()
    rows = [
        (i, float(w), float(g["mean"].norm(2)), [[float(x) for x in row] for row in g["cov"].toArray()])
        for i, (w, g) in enumerate(zip(model.weights, gaussians))
    ]
    schema = "component int, weight double, magnitude double, sigma array<array<double>>"
    return documents.sparkSession.createDataFrame(rows, schema)
