"""Predicting the useful votes of a review."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, functions as F

from plaudit.functions.numbers import ratio, right_closed_bin
from plaudit.functions.texts import review_length
from plaudit.functions.times import days_between
from plaudit.operators.attribution import forest_nodes, mean_contributions, path_contributions
from plaudit.operators.centrality import business_pagerank, friend_degree
from plaudit.operators.graph import Graph
from plaudit.operators.sampling import dense_index, sample_rows, stratified_split
from plaudit.operators.skew import HotKeys
from plaudit.session import cut_lineage

# Names and bins of the model.  Fixed values; a bin holds its upper edge.
FEATURES = (
    "review_stars",
    "review_length",
    "user_tenure_days",
    "user_review_count",
    "user_average_stars",
    "is_elite_at_review",
    "user_degree",
    "business_pagerank",
)
BUCKET_UPPERS = (0, 5, 20)
BUCKET_LABELS = ("0", "1-5", "6-20", "21+")


def useful_bucket(useful: Column) -> Column:
    return right_closed_bin(useful, BUCKET_UPPERS, BUCKET_LABELS)


def elite_at(elite_years: Column, date: Column) -> Column:
    """1 if the user was elite in the year of the date."""
    hit = F.array_contains(elite_years, F.year(date).cast("string"))
    return F.coalesce(hit, F.lit(False)).cast("int")


def usefulness_features(
    reviews: DataFrame,
    users: DataFrame,
    graph: Graph,
    isolated_degree: int = 0,
    sample: int | None = None,
    **hot_limits,
) -> DataFrame:
    """One row per review: key, eight features and the target `useful`.

    Degree and PageRank are computed per user and per business and joined to the
    reviews once each.  Missing graph values and tenures count as zero, rows still
    incomplete are dropped.
    """
    degrees = friend_degree(graph.user, graph.friends_with, isolated_degree)
    authors = (
        users.select(
            "user_id",
            "yelping_since",
            "elite_years",
            F.col("review_count").alias("user_review_count"),
            F.col("average_stars").alias("user_average_stars"),
        )
        .join(degrees.withColumnRenamed("degree", "user_degree"), "user_id", "left")
    )
    ranks = business_pagerank(graph.business, graph.reviewed, weighted=False).select(
        "business_id", F.col("pagerank").alias("business_pagerank")
    )
    facts = sample_rows(reviews, ["review_id"], sample).select(
        "review_id",
        "user_id",
        "business_id",
        "useful",
        "date",
        F.col("stars").alias("review_stars"),
        F.coalesce(review_length(reviews), F.lit(0)).alias("review_length"),
    )
    # Both columns are measured on the stored reviews, before anything is joined.
    by_user = HotKeys.find(facts, "user_id", **hot_limits)
    by_business = HotKeys.find(facts, "business_id", **hot_limits)
    # Dates and lists of years have done their part before the rows are dealt out again.
    written = (
        by_user.join(facts, authors, ["review_id"])
        .withColumn("user_tenure_days", days_between(F.col("yelping_since"), F.col("date")))
        .withColumn("is_elite_at_review", elite_at(F.col("elite_years"), F.col("date")))
        .drop("user_id", "yelping_since", "elite_years", "date")
    )
    rated = by_business.join(written, ranks, ["review_id"], "left")
    return (
        rated.select("review_id", *FEATURES, "useful")
        .na.fill(0, ["user_degree", "business_pagerank", "user_tenure_days"])
        .na.drop()
    )


def split_features(features: DataFrame, fraction: float = 0.8, seed: int = 42) -> DataFrame:
    """Add `useful_bucket` and `is_train`, exact within every bucket."""
    bucketed = features.withColumn("useful_bucket", useful_bucket(F.col("useful")))
    return stratified_split(bucketed, "useful_bucket", ["review_id"], fraction, seed)


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)


def train_usefulness(
    train: DataFrame, rounds: int = 300, depth: int = 6, rate: float = 0.05, seed: int = 42
) -> GBTRegressionModel:
    """Gradient-boosted trees with squared error."""
    trees = GBTRegressor(
        labelCol="useful",
        maxIter=rounds,
        maxDepth=depth,
        stepSize=rate,
        lossType="squared",
        seed=seed,
        # Long boosting runs cut their lineage in the shared folder.
        checkpointInterval=10,
    )
    return trees.fit(_assembled(train))


def predict(model: GBTRegressionModel, df: DataFrame) -> DataFrame:
    """Predictions, with negative ones raised to zero."""
    scored = model.transform(_assembled(df)).drop("features")
    return scored.withColumn("prediction", F.greatest("prediction", F.lit(0.0)))


def regression_metrics(
    df: DataFrame, truth: str, prediction: str, bucket: str | None = None
) -> DataFrame:
    """RMSE, MAE and R2 over all rows (`overall`) and per bucket, in one pass.

    R2 is null where the truth does not vary.
    """
    y, error = F.col(truth).cast("double"), F.col(truth) - F.col(prediction)
    sums = [
        F.count(F.lit(1)).alias("n"),
        F.sum(error * error).alias("ss"),
        F.sum(F.abs(error)).alias("abs"),
        F.sum(y).alias("y"),
        F.sum(y * y).alias("yy"),
    ]
    names = ("n", "ss", "abs", "y", "yy")
    group = F.col(bucket) if bucket else F.lit("all")
    per_bucket = df.groupBy(group.alias("bucket")).agg(*sums)
    overall = per_bucket.agg(*[F.sum(c).alias(c) for c in names]).select(
        F.lit("overall").alias("bucket"), *names
    )
    both = overall.unionByName(per_bucket) if bucket else overall
    spread = F.col("yy") - F.col("y") * F.col("y") / F.col("n")
    return both.filter(F.col("n") > 0).select(
        "bucket",
        "n",
        F.sqrt(F.col("ss") / F.col("n")).alias("rmse"),
        (F.col("abs") / F.col("n")).alias("mae"),
        (1 - F.when(spread > 1e-9, F.col("ss") / spread)).alias("r2"),
    )


def permutation_importance(
    model: GBTRegressionModel, df: DataFrame, sample: int | None = None, seed: int = 42
) -> DataFrame:
    """Contribution of each feature on all rows, or on a sample of fixed size.

    `importance` is the model's own split gain; `rmse_increase` is the loss in
    accuracy when the feature's values are dealt out anew among the rows.
    """
    rows = cut_lineage(
        dense_index(sample_rows(df, ["review_id"], sample, seed), ["review_id"], seed, "place"),
        "sample",
    )
    deals = dense_index(rows, ["review_id"], seed + 1, "deal").select(
        "deal", *[F.col(name).alias(f"dealt_{name}") for name in FEATURES]
    )
    paired = cut_lineage(rows.join(deals, F.col("place") == F.col("deal")), "dealt")
    trials = [predict(model, rows).select(F.lit("").alias("feature"), "useful", "prediction")]
    for name in FEATURES:
        swapped = paired.withColumn(name, F.col(f"dealt_{name}"))
        trials.append(predict(model, swapped).select(F.lit(name).alias("feature"), "useful", "prediction"))
    error = F.col("useful") - F.col("prediction")
    scores = (
        reduce(DataFrame.unionByName, trials)
        .groupBy("feature")
        .agg(F.sqrt(F.avg(error * error)).alias("rmse"))
    )
    # Nine rows.
    measured = {row["feature"]: row["rmse"] for row in scores.collect()}
    gains = model.featureImportances.toArray()
    table = [
        (name, float(gain), measured.get(name, 0.0) - measured.get("", 0.0))
        for name, gain in zip(FEATURES, gains)
    ]
    return df.sparkSession.createDataFrame(
        table, "feature string, importance double, rmse_increase double"
    ).orderBy(F.desc("importance"), "feature")


def contributions(model: GBTRegressionModel, df: DataFrame) -> DataFrame:
    """Per review the bias, what each feature adds to it, and the prediction before negative ones are raised."""
    return path_contributions(df, forest_nodes(df.sparkSession, model), "review_id", FEATURES)


def feature_attribution(model: GBTRegressionModel, df: DataFrame, sample: int | None = None, seed: int = 42) -> DataFrame:
    """`permutation_importance` beside the mean additive contribution of every feature over all rows."""
    paths = mean_contributions(contributions(model, df), FEATURES)
    found = permutation_importance(model, df, sample, seed).join(paths, "feature")
    return found.orderBy(F.desc("importance"), "feature")
