from __future__ import annotations

import glob
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreflow.operators import clusters, features, lloyd
from oreflow.session import scratch_path
from oreflow.sources import reports


def dense(spark, matrix):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "id bigint, val array<double>").repartition(3)


def sparse(spark, matrix):
    rows = [(i, [int(j) for j in np.flatnonzero(r)], [float(x) for x in r[np.flatnonzero(r)]]) for i, r in enumerate(matrix)]
    return spark.createDataFrame(rows, "id bigint, idx array<int>, val array<double>").repartition(3)


def plain_step(matrix, centroids):
    distance = ((matrix[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    best = distance.argmin(axis=1)
    moved = [matrix[best == c].mean(axis=0) if (best == c).any() else centroids[c] for c in range(len(centroids))]
    return best, distance[np.arange(len(matrix)), best], np.array(moved)


@pytest.mark.parametrize("make", [dense, sparse])
def test_lloyd_equals_plain_loops(spark, make):
    rng = np.random.default_rng(1)
    matrix = rng.normal(size=(200, 12)) * (rng.random((200, 12)) < 0.4)
    matrix[17] = 0  # a point without any non-zero value
    points = make(spark, matrix)
    centroids = lloyd.starting_points(points, "id", 4, 12)
    assert all(any(np.allclose(c, row) for row in matrix) for c in centroids)
    expected = centroids
    for _ in range(4):
        _, _, expected = plain_step(matrix, expected)
    fitted = lloyd.fit(points, "id", 4, 3, 12)
    assert np.allclose(fitted, expected)
    best, distance, _ = plain_step(matrix, fitted)
    for row in lloyd.assign(points, "id", fitted).collect():
        assert row["cluster"] == best[row["id"]]
        assert row["distance2"] == pytest.approx(distance[row["id"]], abs=1e-9)


def test_empty_cluster_keeps_its_centroid_and_ties_take_the_lowest(spark):
    matrix = np.array([[0.0, 0.0], [2.0, 0.0]])
    centroids = np.array([[1.0, 1.0], [1.0, -1.0], [50.0, 50.0]])
    points = dense(spark, matrix)
    assert {r["cluster"] for r in lloyd.assign(points, "id", centroids).collect()} == {0}
    moved = lloyd.step(points, centroids)
    assert np.allclose(moved, [[1.0, 0.0], [1.0, -1.0], [50.0, 50.0]])


def test_many_centroids_of_many_dimensions(spark):
    """A hundred centroids of a million dimensions: only cells that are not zero are held."""
    rng = np.random.default_rng(4)
    rows = [(i, sorted(rng.choice(1 << 20, 20, replace=False).tolist()), [1.0] * 20) for i in range(300)]
    points = spark.createDataFrame(rows, "id bigint, idx array<int>, val array<double>").repartition(3)
    fitted = lloyd.fit_sparse(points, "id", 100, 1, 1 << 20)
    assert fitted.shape == (100, 1 << 20) and len(fitted.value) <= 300 * 20
    assert lloyd.assign(points, "id", fitted).select("cluster").distinct().count() > 50


@pytest.mark.parametrize("rows", [[(1, [1.0, 2.0]), (2, [1.0])], [(1, [1.0, 2.0]), (2, None)]])
def test_vectors_must_have_all_dimensions(spark, rows):
    points = spark.createDataFrame(rows, "id bigint, val array<double>").coalesce(1)
    with pytest.raises(Exception, match="has not 2 dimensions"):
        lloyd.assign(points, "id", np.eye(2)).collect()


def documents(spark, n=60):
    rng = random.Random(2)
    topics = ["red green blue yellow pink", "cat dog bird fish cow", "one two three four five"]
    rows = [(i, " ".join(rng.choice(topics[i % 3].split()) for _ in range(rng.randint(5, 30)))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("feature", ["W", "T"])
def test_own_report(spark, feature):
    row = clusters.own_report(documents(spark), feature, 3, 5).first()
    assert row["algorithm"] == "K-Means"
    assert [c["id"] for c in row["clusters"]] == [1, 2, 3]
    assert sum(c["size"] for c in row["clusters"]) == 60
    assert sum(c["error"] for c in row["clusters"]) == pytest.approx(row["WSSE"])
    assert all(0 < len(c["terms"]) <= 10 for c in row["clusters"])


@pytest.mark.parametrize("algorithm, name", [("K", "K-Means"), ("B", "Bisecting K-Means")])
def test_library_report_and_its_file(spark, algorithm, name):
    reported = clusters.library_report(documents(spark), algorithm, 3, 10)
    path = scratch_path(spark, "clusters")
    reports.write_clusters(reported, path)
    (line,) = [line for f in glob.glob(f"{path}/part-*") for line in open(f)]
    stored = json.loads(line)
    assert list(stored) == ["algorithm", "WSSE", "clusters"] and stored["algorithm"] == name
    assert list(stored["clusters"][0]) == ["id", "size", "error", "terms"]
    assert sum(c["size"] for c in stored["clusters"]) == 60
    assert sum(c["error"] for c in stored["clusters"]) == pytest.approx(stored["WSSE"])
    assert clusters.flat_report(reported).count() == 3


def test_library_error_is_the_training_cost(spark):
    from pyspark.ml.clustering import KMeans

    vectors = features.hashed_vectors(documents(spark), 82, "T").select("features")
    model = KMeans(k=3, maxIter=10, seed=42, predictionCol="cluster").fit(vectors)
    measured = clusters.with_distances(model.transform(vectors), [c.tolist() for c in model.clusterCenters()])
    total = clusters.total_error(clusters.metrics(measured)).first()["wsse"]
    assert total == pytest.approx(model.summary.trainingCost)


def test_choices_are_validated(spark):
    with pytest.raises(ValueError):
        clusters.library_report(documents(spark), "G", 3, 5)
    with pytest.raises(ValueError):
        features.hashed_vectors(documents(spark), 82, "X")


def test_top_terms_are_cut_before_the_shuffle(spark):
    df = features.with_words(documents(spark)).withColumn("cluster", F.col("doc_id") % 2)
    top = clusters.top_terms(df.select("cluster", "words"), 3)
    counts = [tuple(r) for r in clusters.word_counts(df).select("cluster", "word", "n").collect()]
    for cluster in (0, 1):
        best = sorted(((w, n) for c, w, n in counts if c == cluster), key=lambda wn: (-wn[1], wn[0]))[:3]
        got = top.filter(F.col("cluster") == cluster).orderBy("place").collect()
        assert [(r["word"], r["n"]) for r in got] == best
    assert "WindowGroupLimit" in top._jdf.queryExecution().toString()


def test_hashed_features_equal_exact_counts(spark):
    docs = documents(spark)
    totals = features.sparse_points(features.hashed_vectors(docs, 1 << 20)).collect()
    exact = {r["doc_id"]: r["n"] for r in features.term_frequency(docs).groupBy("doc_id").agg(F.sum("n").alias("n")).collect()}
    assert {r["doc_id"]: sum(r["val"]) for r in totals} == exact


def test_tf_idf_formula(spark):
    docs = spark.createDataFrame([(1, "a a b"), (2, "a c")], "doc_id bigint, text string")
    got = {(r["doc_id"], r["word"]): r["tf_idf"] for r in features.tf_idf(features.term_frequency(docs), 2).collect()}
    assert got[1, "a"] == pytest.approx(0.0)
    assert got[1, "b"] == pytest.approx(np.log(3 / 2))


def test_mixture_summary(spark):
    rows = clusters.mixture_summary(documents(spark), 2, 3, buckets=8).collect()
    assert sum(r["weight"] for r in rows) == pytest.approx(1.0)
    assert all(r["magnitude"] > 0 for r in rows)
    for r in rows:
        sigma = np.array(r["sigma"])
        assert sigma.shape == (8, 8) and np.allclose(sigma, sigma.T) and (np.linalg.eigvalsh(sigma) > -1e-9).all()


def test_a_hot_word_can_be_split(spark):
    """Both sides of the join on the word are read from storage, so the adaptive join may split either."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.files.openCostInBytes", "64m")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "32k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        docs = spark.range(60_000).selectExpr("id as doc_id", "concat('the w', id) as text").repartition(6)
        path = scratch_path(spark, "tf")
        features.term_frequency(docs).repartition(8).write.parquet(path)  # several files, whose reading tasks the join can tell apart
        weighted = features.tf_idf(spark.read.parquet(path), 60_000)
        weighted.write.format("noop").mode("overwrite").save()
        assert weighted.count() == 120_000
        weighted.collect()
        assert "skew=true" in weighted._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in ("files.openCostInBytes", "autoBroadcastJoinThreshold", "adaptive.skewJoin.skewedPartitionThresholdInBytes", "adaptive.advisoryPartitionSizeInBytes", "adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(f"spark.sql.{name}")


def test_steps_read_blocks_of_plain_bytes(spark):
    """steps scan bytes, and tables of a bounded size give what whole ones give."""
    rows = [(i, [d for d in range(12) if (i * 7 + d * 5) % 4 == 0], None) for i in range(60)]
    rows = [(i, idx, [float((i + d) % 9 + 1) for d in idx]) for i, idx, _ in rows] + [(60, [], [])]
    points = spark.createDataFrame(rows, "doc_id long, idx array<int>, val array<double>").repartition(3)
    stored = lloyd.blocks(points, 12)
    assert {f.dataType.simpleString() for f in stored.schema} == {"binary"}
    dense = np.zeros((61, 12))
    for i, idx, val in rows:
        dense[i, idx] = val
    start = np.array([dense[3], dense[10], dense[3], np.full(12, 2.0), np.full(12, 900.0)])
    best = ((dense[:, None] - start[None]) ** 2).sum(2).argmin(1)
    expected = np.array([dense[best == c].mean(0) if (best == c).any() else start[c] for c in range(5)])
    np.testing.assert_allclose(lloyd.step(points, start), expected, rtol=1e-12)


@pytest.mark.parametrize("dense", [1 << 23, 25, 3])
def test_tables_of_centroids_are_bounded(monkeypatch, dense):
    monkeypatch.setattr(lloyd, "DENSE", dense)
    sizes, idx, val = np.array([2, 0, 3]), np.array([1, 9, 0, 1, 5]), np.array([4.0, 1.0, 2.0, 3.0, 1.0])
    points, centres = np.zeros((3, 10)), np.arange(50.0).reshape(5, 10) % 4
    points[np.repeat(np.arange(3), sizes), idx] = val
    batch = lloyd._Batch([lloyd._Block(sizes[:2], idx[:2], val[:2]), lloyd._Block(sizes[2:], idx[2:], val[2:])], 10)
    assert all(table.size <= max(dense, batch.width) for _, table in lloyd.Centroids.of(centres).groups(batch.dims, batch.group))
    best, distance = (np.concatenate(x) for x in zip(*batch.nearest(lloyd.Centroids.of(centres))))
    squares = ((points[:, None] - centres[None]) ** 2).sum(2)
    assert (best == squares.argmin(1)).all()
    np.testing.assert_allclose(distance, squares.min(1))
    totals = np.zeros(50)
    for cells, some in batch.sums([best[:2], best[2:]], 5, 10):
        totals[cells] += some
    assert (totals.reshape(5, 10) == np.array([points[best == c].sum(0) for c in range(5)])).all()


def test_a_point_that_is_a_centroid_has_no_distance(spark):
    """Sums run in one order for points, centroids and their products, whatever zeros lie between."""
    rng = np.random.default_rng(3)
    matrix = rng.random((20, 300)) * (rng.random((20, 300)) < 0.5)
    rows = [(i, list(range(300)), row.tolist()) for i, row in enumerate(matrix)]
    points = spark.createDataFrame(rows, "id bigint, idx array<int>, val array<double>")
    assert [r["distance2"] for r in lloyd.assign(points, "id", matrix).collect()] == [0.0] * 20
