"""Link prediction on a graph with two planted circles."""

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation, functions as F

from plaudit.operators.graph import Graph
from plaudit.operators.similarity import audience_similarity
from plaudit.plans import links
from plaudit.session import cut_lineage


@pytest.fixture(scope="module")
def circles(spark):
    # Users and businesses of the same parity meet; days run from 0 to 99.
    draws = spark.range(1500).select(
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(60)).alias("u"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(40)).alias("b"),
        (F.col("id") % 100).cast("int").alias("day"),
        "id",
    ).filter("u % 2 = b % 2")
    reviewed = cut_lineage(draws.select(
        F.concat(F.lit("u"), "u").alias("user_id"),
        F.concat(F.lit("b"), "b").alias("business_id"),
        F.col("id").cast("string").alias("review_id"),
        F.lit(4).alias("stars"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("day")).cast("timestamp_ntz").alias("date"),
    ))
    users = spark.range(60).select(
        F.concat(F.lit("u"), "id").alias("user_id"), F.concat(F.lit("N"), "id").alias("name"),
        F.lit(100).cast("long").alias("review_count"), F.lit(4.0).alias("average_stars"),
    )
    shops = spark.range(40).select(
        F.concat(F.lit("b"), "id").alias("business_id"), F.concat(F.lit("S"), "id").alias("name"),
        F.lit(4.0).alias("stars"), F.lit(150).cast("long").alias("review_count"),
    )
    empty = spark.range(0)
    return Graph(users, shops, empty, empty, empty, reviewed, empty, empty, empty, empty, empty)


def test_model_finds_the_circles(spark, circles):
    before, after, moment = links.split_by_time(circles.reviewed, 0.8)
    total = circles.reviewed.count()
    assert before.count() + after.count() == total
    assert abs(before.count() / total - 0.8) < 0.02
    model = links.train_links(circles, dimension=16, trees=5, depth=4, test_pairs=300)
    metrics = {r.metric: r.value for r in model.metrics().collect()}
    assert metrics["split_timestamp"] == moment
    assert metrics["auc_pr_train"] > 0.7
    assert abs(model.importances().agg(F.sum("importance")).first()[0] - 1) < 1e-6
    found = links.recommendations(circles, model).collect()
    assert len(found) == 15 and {r.place for r in found} == {1, 2, 3}
    assert {r.user_id for r in found} == {"u0", "u1", "u10", "u11", "u12"}
    known = {(r.user_id, r.business_id) for r in circles.reviewed.collect()}
    assert not known & {(r.user_id, r.business_id) for r in found}
    same = sum(int(r.user_id[1:]) % 2 == int(r.business_id[1:]) % 2 for r in found)
    assert same >= 10


def test_a_forest_scores_after_a_frame_was_observed(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    rows = spark.createDataFrame([(float(i % 2), Vectors.dense([float(i % 2), float(i)])) for i in range(20)], ["label", "features"])
    fitted = RandomForestClassifier(numTrees=2, maxDepth=2, seed=1).fit(rows)
    forest = links._without_summary(fitted, spark)
    assert forest.featureImportances == fitted.featureImportances
    assert forest.toDebugString == fitted.toDebugString
    found = forest.transform(rows).groupBy("label").agg(F.min("prediction"), F.max("prediction")).collect()
    assert {tuple(r) for r in found} == {(0.0, 0.0, 0.0), (1.0, 1.0, 1.0)}


def test_nearest_audiences_are_counted_and_placed_after_one_shuffle(spark):
    visits = spark.range(3000).select(
        F.lit("all").alias("group"), F.concat(F.lit("b"), F.col("id") % 40).alias("item"), F.concat(F.lit("u"), F.col("id") * 7 % 311).alias("member")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = audience_similarity(visits, 5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = plan[plan.index("Window [row_number") :]
    assert "HashAggregate" in below[: below.index("Exchange")]


def test_audience_recommendations_reach_every_user_without_a_product(spark, circles):
    found = links.audience_recommendations(circles, nearest=10, k=3)
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    rows = found.collect()
    known = {(r.user_id, r.business_id) for r in circles.reviewed.collect()}
    assert rows and not known & {(r.user_id, r.business_id) for r in rows}
    assert all(int(r.user_id[1:]) % 2 == int(r.business_id[1:]) % 2 for r in rows)
    # Whoever has not been everywhere in their circle gets something.
    open_users = {u for u in {u for u, _ in known} if sum(a == u for a, _ in known) < 20}
    assert {r.user_id for r in rows} == open_users


def test_pairs_are_stored_with_a_byte_per_entry_and_scored_in_the_same_bins(spark, circles, monkeypatch):
    stored = {}

    def seen(df, label="stage"):
        stored[label] = df.dtypes
        return cut_lineage(df, label)

    monkeypatch.setattr(links, "cut_lineage", seen)
    model = links.train_links(circles, dimension=16, trees=3, depth=3)
    assert dict(stored["featured"])["features"] == "array<tinyint>"
    assert len(model.cuts) == 16 and all(0 < len(c) <= 31 for c in model.cuts)
    features = [r.features.toArray() for r in model.score(circles.reviewed.select(*links.PAIR).distinct()).collect()]
    assert all((f == f.round()).all() and f.min() >= 0 and f.max() <= 31 for f in features)
    assert len({tuple(f) for f in features}) > 10
