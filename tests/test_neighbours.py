from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreflow.operators import evaluation, factorisation, neighbours
from oreflow.operators.skew import hot_keys, salted_join
from oreflow.session import grouped_by, materialise


def brute_force(train, test, heavy_over, overlap_over, cosine_over, mean_centering=False):
    """User-based prediction with plain loops."""
    rows_of, raters, items_of = {}, {}, {}
    for u, i, r in train:
        rows_of.setdefault(u, []).append(r)
        raters.setdefault(i, []).append((u, r))
        items_of.setdefault(u, {})
        items_of[u][i] = max(r, items_of[u].get(i, -1))
    mean = {u: sum(v) / len(v) for u, v in rows_of.items()}
    norm = {u: math.sqrt(sum(x * x for x in v)) for u, v in rows_of.items()}
    heavy = {u: len(v) > heavy_over for u, v in rows_of.items()}
    item_mean = {i: sum(r for _, r in v) / len(v) for i, v in raters.items()}
    rated_by = {i: {u for u, _ in v} for i, v in raters.items()}

    def weights(a):
        found = {}
        for b in items_of:
            common = items_of[a].keys() & items_of[b].keys()
            if not heavy[b] or len(common) <= overlap_over:
                continue
            dot = sum(items_of[a][i] * items_of[b][i] for i in common)
            if dot / (norm[a] * norm[b]) <= cosine_over:
                continue
            ca, cb = sum(items_of[a][i] for i in common), sum(items_of[b][i] for i in common)
            co_mean = cb / len(common)
            if mean_centering:
                ca, cb = ca / len(common), co_mean
            num = sum((items_of[a][i] - ca) * (items_of[b][i] - cb) for i in common)
            da = sum((items_of[a][i] - ca) ** 2 for i in common)
            db = sum((items_of[b][i] - cb) ** 2 for i in common)
            found[b] = (num / math.sqrt(da * db) if da * db > 0 else 0.0, co_mean)
        return found

    out = {}
    for u, i in test:
        if u not in mean and i not in item_mean:
            out[u, i] = (1, 2.5)
        elif u not in mean:
            out[u, i] = (2, item_mean[i])
        elif i not in item_mean or heavy[u]:
            out[u, i] = (3, mean[u])
        elif i in items_of[u]:
            out[u, i] = (4, items_of[u][i])
        else:
            voters = {b: w for b, w in weights(u).items() if b in rated_by[i]}
            if not voters:
                out[u, i] = (5, (mean[u] + item_mean[i]) / 2)
                continue
            num = sum((items_of[b][i] - m) * w for b, (w, m) in voters.items())
            den = sum(abs(w) for w, _ in voters.values())
            vote = num / den if den else 0.0
            out[u, i] = (5, (mean[u] + vote) * (math.log(len(mean)) - math.log(len(rated_by[i]))))
    return out, {a: weights(a) for a in items_of if not heavy[a]}


def dataset(seed, hot=False):
    rng = random.Random(seed)
    train = []
    for u in range(60):
        n = rng.randint(3, 12) if u % 2 else rng.randint(13, 25)
        for i in rng.sample(range(30), n):
            train.append((f"u{u}", f"i{i}", float(rng.randint(1, 5))))
    train += rng.sample(train, 20)  # repeated rows
    train += [(u, i, float(rng.randint(1, 5))) for u, i, _ in rng.sample(train, 20)]  # with other ratings
    if hot:
        train += [(f"u{u}", "hot", float(rng.randint(1, 5))) for u in range(60)]
    test = {(f"u{rng.randint(0, 64)}", f"i{rng.randint(0, 33)}") for _ in range(400)}
    return train, sorted(test)


@pytest.mark.parametrize("seed, hot, overlap, min_hot", [(1, False, 5, 10**9), (2, True, 3, 5), (3, True, 0, 1)])
@pytest.mark.parametrize("centering", ["sum", "mean"])
def test_equals_brute_force(spark, seed, hot, overlap, min_hot, centering):
    train, test = dataset(seed, hot)
    expected, expected_weights = brute_force(train, test, 12, overlap, 0.3, centering == "mean")
    train_df = spark.createDataFrame(train, "user string, item string, rating double")
    test_df = spark.createDataFrame(test, "user string, item string")
    tables = neighbours.rating_tables(train_df, heavy_over=12)

    found = neighbours.neighbour_weights(tables, None, overlap, 0.3, centering, min_hot).collect()
    got = {(r["user"], r["neighbour"]): r["weight"] for r in found}
    want = {(a, b): w for a, ws in expected_weights.items() for b, (w, _) in ws.items()}
    assert got.keys() == want.keys() and len(got) > 5
    for pair in want:
        assert got[pair] == pytest.approx(want[pair], abs=1e-7)

    predicted = neighbours.predict(tables, test_df, overlap, 0.3, centering, min_hot_rows=min_hot).collect()
    assert len(predicted) == len(test)
    assert {r["rule"] for r in predicted} == {1, 2, 3, 4, 5}
    for r in predicted:
        rule, value = expected[r["user"], r["item"]]
        assert r["rule"] == rule
        assert r["prediction"] == pytest.approx(value, abs=1e-6)


def test_popular_items_are_not_looked_up(spark):
    """Everybody rates the popular items; only the rare ones may bring candidates."""
    train = [(f"h{u}", f"p{i}", 4.0) for u in range(30) for i in range(21)]
    train += [("h0", f"r{i}", 4.0) for i in range(5)]
    train += [("light", f"p{i}", 4.0) for i in range(10)] + [("light", f"r{i}", 4.0) for i in range(5)]
    df = spark.createDataFrame(train, "user string, item string, rating double")
    tables = neighbours.rating_tables(df)
    rows = neighbours.neighbour_weights(tables).collect()
    assert [(r["user"], r["neighbour"], r["overlap"]) for r in rows] == [("light", "h0", 15)]


def test_clamp_and_validation(spark):
    train, test = dataset(4)
    tables = neighbours.rating_tables(spark.createDataFrame(train, "user string, item string, rating double"), 12)
    df = spark.createDataFrame(test, "user string, item string")
    values = [r[0] for r in neighbours.predict(tables, df, 3, 0.3, clamp=(1, 5)).select("prediction").collect()]
    assert min(values) >= 1 and max(values) <= 5
    with pytest.raises(ValueError):
        neighbours.neighbour_weights(tables, centering="median")


def test_salted_join_equals_join(spark):
    rng = random.Random(5)
    many = spark.createDataFrame([("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 9)}", i) for i in range(500)], "k string, a int")
    few = spark.createDataFrame([("hot", i) for i in range(5)] + [(f"k{i}", i) for i in range(9)], "k string, b int")
    hot = hot_keys(many.groupBy("k").count(), "k", "count", min_rows=50, max_share=0.05)
    assert [r["k"] for r in hot.collect()] == ["hot"] and hot.first()["_parts"] > 1
    plain = sorted(tuple(r) for r in many.join(few, "k").select("k", "a", "b").collect())
    assert sorted(tuple(r) for r in salted_join(many, few, "k", hot).select("k", "a", "b").collect()) == plain


def test_hot_keys_are_bounded(spark):
    counts = spark.range(10_000).selectExpr("id as k", "1000 as n")
    assert hot_keys(counts, "k", "n", min_rows=1).count() == 0
    assert hot_keys(spark.createDataFrame([], "k int, n bigint"), "k", "n").count() == 0


def test_error_bands_and_rmse(spark):
    errors = spark.createDataFrame([(e,) for e in (-4.5, -0.2, 0.0, 1.0, 3.9, 4.0)], "error double")
    assert [r["n"] for r in evaluation.error_bands(errors).collect()] == [2, 1, 0, 1, 2]
    assert [r["n"] for r in evaluation.error_bands(errors, signed=True).collect()] == [3, 1, 0, 1, 1]
    squares = [e * e for e in (-4.5, -0.2, 0.0, 1.0, 3.9, 4.0)]
    assert evaluation.rmse(errors).first()["rmse"] == pytest.approx(math.sqrt(sum(squares) / 6))


def test_evaluation_report(spark):
    test = spark.createDataFrame([("u", "i", 3.0), ("u", "i", 5.0), ("v", "i", 1.0)], "user string, item string, rating double")
    predicted = spark.createDataFrame([("u", "i", 3.0)], "user string, item string, prediction double")
    got = {r["metric"]: r["value"] for r in evaluation.evaluation_report(lambda: predicted, test).collect()}
    assert got[">=0 and <1"] == 1 and got[">=2 and <3"] == 1
    assert got["RMSE"] == pytest.approx(math.sqrt(2)) and got["seconds"] > 0


def test_dense_index(spark):
    ids = spark.createDataFrame([(f"id{i % 700}",) for i in range(2000)], "user string")
    index = factorisation.dense_index(ids, "user")
    assert sorted(r["user_idx"] for r in index.collect()) == list(range(700))
    more = spark.createDataFrame([("id3",), ("new1",), ("new2",)], "user string")
    extended = {r["user"]: r["user_idx"] for r in factorisation.extend_index(index, more, "user").collect()}
    assert sorted(extended.values()) == list(range(702))
    assert {extended["new1"], extended["new2"]} == {700, 701}


@pytest.mark.parametrize("solver", ["library", "sums"])
def test_factorisation_learns_and_drops_the_unknown(spark, solver):
    rng = random.Random(6)
    taste = {f"u{u}": rng.uniform(0.6, 1.4) for u in range(40)}
    quality = {f"i{i}": rng.uniform(1.5, 3.5) for i in range(30)}
    rows = [(u, i, taste[u] * quality[i]) for u in taste for i in quality]
    rng.shuffle(rows)
    train = spark.createDataFrame(rows[:900], "user string, item string, rating double")
    test = spark.createDataFrame(rows[900:] + [("new", "i1", 1.0), ("u1", "new", 1.0)], train.schema)
    predicted = factorisation.fit(train, iterations=8, regularisation=0.002, blocks=2, solver=solver).predict(test)
    row = evaluation.rmse(evaluation.with_errors(test, predicted)).first()
    assert row["n"] == len(rows) - 900
    assert row["rmse"] < 0.1


def test_both_solvers_reach_the_same_error(spark):
    train_rows, _ = dataset(7)
    train = spark.createDataFrame(train_rows, "user string, item string, rating double")
    scores = [
        evaluation.rmse(evaluation.with_errors(train, factorisation.fit(train, iterations=15, blocks=2, solver=s).predict(train)))
        .first()["rmse"]
        for s in ("library", "sums")
    ]
    assert scores[0] == pytest.approx(scores[1], abs=0.02)


def test_ids_are_read_once_and_predictions_carry_ratings(spark):
    """The index reads its distinct ids, not the rows again, and errors need no second look at the tested rows."""
    rows = [(f"u{u}", f"i{i}", float(1 + (u + i) % 5)) for u in range(20) for i in range(9) if (u * i) % 4]
    train = materialise(spark.createDataFrame([*rows, (None, "i1", 2.0), ("u1", None, 3.0)], "user string, item string, rating double"), "t")
    index = factorisation.dense_index(train, "user")
    assert not set(index.inputFiles()) & set(train.inputFiles())
    numbers = {r["user"]: r["user_idx"] for r in index.collect()}
    assert set(numbers) == {r[0] for r in rows} | {None} and sorted(numbers.values()) == list(range(len(numbers)))
    model = factorisation.fit(train, iterations=3, blocks=2)
    expected = evaluation.with_errors(train, model.predict(train)).collect()
    found = evaluation.errors_of(model.predict(train, "rating"))
    assert len(expected) == len(rows) and sorted(found.collect()) == sorted(expected)


def test_the_solver_is_a_choice(spark):
    """No number of ratings changes the solver behind the caller's back."""
    rows = [(f"u{i}", "hot", 3.0) for i in range(40)]
    train = spark.createDataFrame(rows, "user string, item string, rating double")
    with pytest.raises(ValueError):
        factorisation.fit(train, solver="auto")
    for solver in ("library", "sums"):
        predicted = factorisation.fit(train, iterations=3, regularisation=0.01, solver=solver).predict(train)
        assert predicted.count() == 40


def test_tables_are_written_when_asked_for(spark):
    train_rows, _ = dataset(7)
    tables = neighbours.rating_tables(spark.createDataFrame(train_rows, "user string, item string, rating double"))
    assert not {"pairs", "users", "items"} & set(vars(tables))
    tables.items.count()
    assert {"pairs", "users", "items"} & set(vars(tables)) == {"pairs", "items"}


def test_fewer_candidates_than_leaving_out_on_one_side(spark):
    """The index leaves out popular items of both sides and users that no light user can resemble, and loses no pair."""
    train, _ = dataset(5, hot=True)
    train += [("giant", f"i{i}", 1.0) for i in range(30)] + [("giant", f"g{i}", 1.0) for i in range(500)]
    df = spark.createDataFrame(train, "user string, item string, rating double")
    tables = neighbours.rating_tables(df, heavy_over=12)
    overlap, cosine = 5, 0.5
    users = {r["user"]: r for r in tables.users.collect()}
    light = tables.users.filter(f"NOT heavy AND items > {overlap}").select("user")
    reached = neighbours.within_reach(tables, overlap, cosine).select("user")
    assert users["giant"]["heavy"] and "giant" not in {r["user"] for r in reached.collect()}
    both = {tuple(r) for r in neighbours.candidate_pairs(tables, light, reached, overlap).select("user", "neighbour").collect()}

    # The look-up that leaves items out of the light users only.
    items = {r["item"]: r["raters"] for r in tables.items.collect()}
    held = {}
    for u, i, _ in train:
        held.setdefault(u, set()).add(i)
    drop = overlap + 1 - neighbours.PROBE_HITS
    one_side = set()
    for a in (r["user"] for r in light.collect()):
        probes = sorted(held[a], key=lambda i: (items[i], i))[: len(held[a]) - drop]
        one_side |= {(a, b) for b, u in users.items() if u["heavy"] and len(held[b] & set(probes)) >= neighbours.PROBE_HITS}
    assert both < one_side
    shared = {(a, b) for a, b in one_side if len(held[a] & held[b]) > overlap and b != "giant"}
    assert shared <= both
    expected = {(a, b) for a, found in brute_force(train, [], 12, overlap, cosine)[1].items() for b in found}
    weights = neighbours.neighbour_weights(tables, overlap_over=overlap, cosine_over=cosine)
    assert {tuple(r) for r in weights.select("user", "neighbour").collect()} == expected


@pytest.mark.parametrize("rank", [1, 2, 4])
def test_equations_are_solved_in_columns(spark, rank):
    """A step of the solver by sums gives the regularised least squares of each id, at any rank, without Python workers."""
    rng = np.random.default_rng(rank)
    factors = {i: rng.random(rank) + 0.1 for i in range(9)}
    rows = [(u, int(i), float(rng.integers(1, 6))) for u in range(6) for i in rng.choice(9, rng.integers(1, 9), replace=False)]
    rows += rows[:3]
    ratings = spark.createDataFrame(rows, "user_idx int, item_idx int, rating float")
    fixed = spark.createDataFrame([(i, f.tolist()) for i, f in factors.items()], "item_idx int, item_factor array<double>")
    found = factorisation._solve(ratings, fixed, "item", "user", rank, 0.28)
    for row in found.collect():
        own = [(factors[i], r) for u, i, r in rows if u == row["user_idx"]]
        left = sum(np.outer(f, f) for f, _ in own) + 0.28 * len(own) * np.eye(rank)
        assert np.allclose(row["user_factor"], np.linalg.solve(left, sum(f * r for f, r in own)))
    assert found.count() == 6


def test_few_candidates_at_a_low_overlap(spark):
    """Unpopular items are not left out, so that hardly any pair is compared that shares too little."""
    rng = random.Random(8)
    train = [(f"l{u}", f"i{i}", 3.0) for u in range(40) for i in rng.sample(range(200), 12)]
    train += [(f"h{u}", f"i{i}", 3.0) for u in range(80) for i in rng.sample(range(200), 30)]
    train += [("twin", i, 3.0) for a, i, _ in train if a == "l0"] + [("twin", f"i{i}", 4.0) for i in range(200, 220)]
    tables = neighbours.rating_tables(spark.createDataFrame(train, "user string, item string, rating double"))
    light, heavy = (tables.users.filter(c).select("user") for c in ("NOT heavy", "heavy"))
    found = {tuple(r) for r in neighbours.candidate_pairs(tables, light, heavy, 5).collect()}
    held = {}
    for u, i, _ in train:
        held.setdefault(u, set()).add(i)
    shared = {(a, b): len(held[a] & held[b]) for a in held if a[0] == "l" for b in held if b[0] != "l"}
    assert ("l0", "twin") in found and {p for p, n in shared.items() if n > 5} <= found
    assert all(shared[p] >= neighbours.SURE_HITS for p in found)


def test_popular_items_are_left_out_further(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "POPULAR", 3)
    monkeypatch.setattr(neighbours, "POSTINGS", 4)
    train_rows, _ = dataset(9)
    tables = neighbours.rating_tables(spark.createDataFrame(train_rows, "user string, item string, rating double"), 12)
    expected = {(a, b) for a, found in brute_force(train_rows, [], 12, 5, 0.5)[1].items() for b in found}
    weights = neighbours.neighbour_weights(tables, overlap_over=5, cosine_over=0.5)
    assert {tuple(r) for r in weights.select("user", "neighbour").collect()} == expected


def test_tasks_that_group_hold_few_rows(spark):
    """The number of tasks follows the rows, however well they compress."""
    rows = spark.range(2000).select((F.col("id") % 7).alias("user"), F.col("id").alias("item"))
    assert grouped_by(rows, 2000, "user", "item", task_rows=20).rdd.getNumPartitions() == 100
    assert grouped_by(rows, 0, "user").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
