"""Usefulness model on a small synthetic-free frame: metrics, bins, importance."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from plaudit.operators.attribution import _tabled, _walked, forest_nodes, path_contributions
from plaudit.operators.ranking import ranked_areas
from plaudit.plans import usefulness as u


def test_elite_at_review_year(spark):
    df = spark.createDataFrame(
        [(["2012"], dt.datetime(2012, 5, 1)), (["2012"], dt.datetime(2013, 5, 1)), (None, dt.datetime(2012, 1, 1)), ([], None)],
        "years array<string>, date timestamp_ntz",
    )
    assert [r[0] for r in df.select(u.elite_at(F.col("years"), F.col("date"))).collect()] == [1, 0, 0, 0]


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(1)
    y, p = rng.poisson(2, 200), rng.random(200) * 4
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")
    df = df.withColumn("bucket", u.useful_bucket(F.col("y")))
    found = {r.bucket: r for r in u.regression_metrics(df, "y", "p", "bucket").collect()}
    for name, mask in (("overall", y >= 0), ("0", y == 0), ("1-5", (y > 0) & (y <= 5))):
        error = y[mask] - p[mask]
        assert found[name].n == mask.sum()
        assert found[name].rmse == pytest.approx(np.sqrt((error**2).mean()))
        assert found[name].mae == pytest.approx(np.abs(error).mean())
        spread = ((y[mask] - y[mask].mean()) ** 2).sum()
        if spread:
            assert found[name].r2 == pytest.approx(1 - (error**2).sum() / spread)
        else:
            assert found[name].r2 is None


def test_model_learns_and_attributes_to_the_driving_feature(spark):
    rows = spark.range(600).select(
        F.col("id").cast("string").alias("review_id"),
        *[
            (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(10)).cast("double")).alias(name)
            for i, name in enumerate(u.FEATURES)
        ],
    )
    data = rows.withColumn("useful", (F.col("review_length") * 2).cast("long"))
    split = u.split_features(data)
    assert split.filter("is_train").count() == sum(
        int(0.8 * r["count"]) for r in split.groupBy("useful_bucket").count().collect()
    )
    model = u.train_usefulness(split.filter("is_train"), rounds=3, depth=3, rate=0.5)
    scored = u.predict(model, split.filter("NOT is_train"))
    assert scored.filter("prediction < 0").isEmpty()
    assert u.regression_metrics(scored, "useful", "prediction").first().r2 > 0.9
    paths = u.contributions(model, split).join(model.transform(u._assembled(split)).select("review_id", F.col("prediction").alias("p")), "review_id")
    assert paths.filter(F.abs(F.col("p") - F.col("prediction")) > 1e-9).isEmpty() and paths.count() == 600
    assert forest_nodes(spark, model).filter("node = 0").count() == 3
    table = {r.feature: r for r in u.feature_attribution(model, data, 200).collect()}
    assert max(table, key=lambda name: table[name].mean_size) == "review_length"
    assert set(table) == set(u.FEATURES)
    assert table["review_length"].rmse_increase > 1
    assert max(abs(r.rmse_increase) for n, r in table.items() if n != "review_length") < 0.5


def test_a_tree_of_one_leaf_has_bias_only(spark):
    nodes = spark.createDataFrame([(0, 2.0, 0, None, None, None, None, 1.5)], "tree int, weight double, node int, feature int, threshold double, left int, right int, value double")
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, x double")
    assert {(r.k, r.bias, r.x, r.prediction) for r in path_contributions(rows, nodes, "k", ["x"]).collect()} == {("a", 3.0, 0.0, 3.0), ("b", 3.0, 0.0, 3.0)}
    assert path_contributions(rows.limit(0), nodes, "k", ["x"]).isEmpty()


def test_rows_are_not_multiplied_by_trees_and_repeated_keys_add_up(spark):
    columns = "tree int, weight double, node int, feature int, threshold double, left int, right int, value double"
    nodes = spark.createDataFrame(
        [(0, 1.0, 0, 0, 1.0, 1, 2, 4.0), (0, 1.0, 1, None, None, None, None, 1.0), (0, 1.0, 2, None, None, None, None, 8.0),
         (1, 0.5, 0, None, None, None, None, 2.0)], columns)
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 0.0), ("c", 3.0), (None, float("nan"))], "k string, x double")
    found = path_contributions(rows, nodes, "k", ["x"])
    assert {(r.k, r.bias, r.x, r.prediction) for r in found.collect()} == {
        ("a", 5.0, -3.0, 2.0), ("b", 5.0, 4.0, 9.0), ("c", 10.0, 1.0, 11.0), (None, 5.0, 4.0, 9.0)}
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()


def test_areas_match_pairs_and_curve(spark):
    rng = np.random.default_rng(2)
    label, score = rng.integers(0, 2, 300), rng.integers(0, 25, 300)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(label, score)] + [(1, None), (None, 3)], "label int, score int")
    found = ranked_areas(df, "score", "label", range_values=4).first()
    up, down = score[label == 1][:, None], score[label == 0][None]
    assert found.auc_roc == pytest.approx(((up > down) + 0.5 * (up == down)).mean())
    points = [((label[score >= s] == 1).sum() / label.sum(), label[score >= s].mean()) for s in sorted(set(score), reverse=True)]
    recall, precision = zip((0.0, points[0][1]), *points)
    assert found.auc_pr == pytest.approx(np.trapezoid(precision, recall))
    assert (found.n_positive, found.n_negative) == (label.sum(), 300 - label.sum())
    alone = ranked_areas(df.filter("label = 1"), "score", "label").first()
    assert alone.auc_roc is None and alone.n_negative == 0
    assert ranked_areas(df.limit(0), "score", "label").first().auc_pr is None


def test_votes_are_those_of_the_reviews_which_are_not_written(spark, tmp_path):
    from plaudit.plans.workspace import Workspace

    tables = {
        "orders": ([(0, 1), (1, 1), (2, 2), (2, 2), (3, 0), (None, 0)], "o_orderkey long, o_custkey long"),
        "lineitem": (
            [(0, 1, 1, 1, 5.0, 0.05), (0, 1, 1, 2, 25.0, 0.02), (1, 1, 1, 1, None, 0.01), (2, 1, 1, 1, 50.0, None), (9, 1, 1, 1, 1.0, 0.1)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double",
        ),
        # Order 1 falls on a document number that occurs twice.
        "documents": ([(0, "x"), (1, "y"), (1, "z"), (None, "w")], "doc_id long, text string"),
    }
    for name, (data, schema) in tables.items():
        df = spark.createDataFrame(data, schema)
        if name == "lineitem":
            df = df.withColumn("l_shipdate", F.lit("2000-01-01").cast("timestamp_ntz"))
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    w = Workspace(spark, str(tmp_path))
    found = sorted(w.votes.collect(), key=str)
    assert "reviews" not in vars(w)
    assert len(found) == 6 and found == sorted(w.reviews.select("user_id", "useful").collect(), key=str)


def test_leaves_know_what_the_way_to_them_adds():
    # A root that asks feature 1; its left child asks feature 0, then feature 1 again; the right child is a leaf.
    tree = {"root": 0, "feature": np.array([1, 0, -1, 1, -1, -1, -1]), "threshold": np.array([5.0, 2.0, np.nan, 1.0, np.nan, np.nan, np.nan]),
            "left": np.array([1, 3, 2, 4, 4, 5, 6]), "right": np.array([2, 6, 2, 5, 4, 5, 6]), "value": np.array([4.0, 3.0, 8.0, 2.0, 1.0, 2.5, 7.0])}
    leaf = {"root": 0, "feature": np.array([-1]), "threshold": np.array([np.nan]), "left": np.array([0]), "right": np.array([0]), "value": np.array([6.0])}
    tables = _tabled([(0.5, tree), (2.0, leaf)], 2)
    assert [depth for _, depth, _ in tables] == [3, 0]
    x = np.array([[2.0, 1.0], [2.0, 5.0], [np.nan, 0.0], [0.0, np.nan], [0.0, 6.0]])
    bias, added = _walked(x, tables)
    assert bias == 0.5 * 4.0 + 2.0 * 6.0
    # Means along the way: 4, 3, 2, then 1 or 2.5; 4, 3, 7; 4, 8.
    assert added.tolist() == [[-0.5, -1.0], [-0.5, -0.25], [2.0, -0.5], [0.0, 2.0], [0.0, 2.0]]
