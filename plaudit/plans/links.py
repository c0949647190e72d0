"""Link prediction between users and businesses, and recommendations from it."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from plaudit.functions.numbers import half_up
from plaudit.operators.embedding import fast_rp, pair_products
from plaudit.operators.graph import Graph, project, with_epoch
from plaudit.operators.ranking import percentiles, ranked_areas
from plaudit.operators.sampling import dense_index, sample_rows
from plaudit.operators.similarity import audience_similarity
from plaudit.operators.skew import HotKeys
from plaudit.operators.topk import top_per_group
from plaudit.operators.trees import BORDER_ROWS, split_points
from plaudit.session import cut_lineage, new_path

PAIR = ["user_id", "business_id"]
# Ascending thresholds for every entry of the pair feature.
Cuts = tuple[tuple[float, ...], ...]


def split_moment(reviewed: DataFrame, share: float = 0.8) -> DataFrame:
    """One row with the given percentile of time, `moment`; null without edges."""
    return percentiles(with_epoch(reviewed), "timestamp", {"moment": share})


def split_by_time(reviewed: DataFrame, share: float = 0.8) -> tuple[DataFrame, DataFrame, float]:
    """Edges before and from the given percentile of time, and that moment."""
    timed = with_epoch(reviewed)
    moment = split_moment(reviewed, share).first()["moment"]
    return (
        timed.filter(F.col("timestamp") < moment),
        timed.filter(F.col("timestamp") >= moment),
        moment,
    )


def shuffled_negatives(positives: DataFrame, known: DataFrame, seed: int) -> DataFrame:
    """Unlinked pairs that combine the users of the positives with businesses of others.

    Both columns are numbered in different hash orders and joined by number: as many
    candidates as positives, each end as frequent as among them, and no product of
    users and businesses anywhere.
    """
    users = dense_index(positives, PAIR, seed).select("index", "user_id")
    shops = dense_index(positives, PAIR, seed + 1).select("index", "business_id")
    return users.join(shops, "index").select(*PAIR).distinct().join(known, PAIR, "left_anti")


def drawn_negatives(
    users: DataFrame, businesses: DataFrame, known: DataFrame, n: int, seed: int
) -> DataFrame:
    """About n unlinked pairs, both ends drawn by hash from the given vertices."""
    left = dense_index(users.select("user_id"), ["user_id"], seed)
    right = dense_index(businesses.select("business_id"), ["business_id"], seed)
    n_left, n_right = left.count(), right.count()
    if not n_left or not n_right:
        return known.select(*PAIR).limit(0)
    draws = users.sparkSession.range(n).select(
        F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n_left)).alias("u"),
        F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(n_right)).alias("b"),
    )
    return (
        draws.join(left.withColumnRenamed("index", "u"), "u")
        .join(right.withColumnRenamed("index", "b"), "b")
        .select(*PAIR)
        .distinct()
        .join(known, PAIR, "left_anti")
    )


def pair_features(pairs: DataFrame, vectors: DataFrame, cuts: Cuts | None = None) -> DataFrame:
    """Attach the elementwise product of both ends' embeddings as an ML vector, or the bins its entries fall into."""
    products = pair_products(cut_lineage(pairs, "pairs"), vectors, *PAIR, "features", cuts)
    return _as_vectors(products)


def _as_vectors(rows: DataFrame) -> DataFrame:
    return rows.withColumn("features", array_to_vector(F.col("features").cast("array<double>")))


def _borders(pairs: DataFrame, vectors: DataFrame, seed: int) -> Cuts:
    """Thresholds between the bins of every entry of the pair feature, from a sample of fixed size."""
    products = pair_products(cut_lineage(sample_rows(pairs, PAIR, BORDER_ROWS, seed), "sample"), vectors, *PAIR, "features")
    entries = np.array([row["features"] for row in products.select("features").collect()])
    return tuple(tuple(split_points(column).tolist()) for column in entries.T)


def _without_summary(forest: RandomForestClassificationModel, spark: SparkSession) -> RandomForestClassificationModel:
    """The same forest, written and read back, so that its training summary stays behind.

    The summary holds the session.  Scoring sends the model to the tasks, and a session in which a
    frame has been observed cannot be sent.
    """
    path = new_path(spark, "forest")
    forest.write().save(path)
    return RandomForestClassificationModel.load(path)


@dataclass(frozen=True)
class LinkModel:
    forest: RandomForestClassificationModel
    vectors: DataFrame
    moment: float
    train_auc_pr: float
    test_auc_roc: float
    cuts: Cuts | None = None

    def metrics(self) -> DataFrame:
        rows = [
            ("split_timestamp", float(self.moment)),
            ("auc_pr_train", self.train_auc_pr),
            ("auc_roc_test", self.test_auc_roc),
        ]
        return self.vectors.sparkSession.createDataFrame(rows, "metric string, value double")

    def importances(self) -> DataFrame:
        """Weight of every dimension of the pair feature in the forest."""
        rows = [(i, float(x)) for i, x in enumerate(self.forest.featureImportances.toArray())]
        return self.vectors.sparkSession.createDataFrame(rows, "feature int, importance double")

    def score(self, pairs: DataFrame) -> DataFrame:
        scored = self.forest.transform(pair_features(pairs, self.vectors, self.cuts))
        return scored.withColumn("probability", vector_to_array("probability")[1])


def train_links(
    graph: Graph,
    dimension: int = 64,
    trees: int = 10,
    depth: int = 8,
    share: float = 0.8,
    test_pairs: int | None = None,
    seed: int = 42,
) -> LinkModel:
    """Fit a forest on reviews before a moment and test it on reviews after it.

    All pairs of the training period are positives.  The evaluation takes all pairs of the
    later period and about as many unreviewed ones, or `test_pairs` of either side.
    """
    before, after, moment = split_by_time(graph.reviewed, share)
    old_pairs = cut_lineage(before.select(*PAIR).distinct(), "train-pairs")
    all_pairs = cut_lineage(graph.reviewed.select(*PAIR).distinct(), "all-pairs")
    vertices = graph.user.select(F.col("user_id").alias("id")).union(
        graph.business.select("business_id")
    )
    vectors = fast_rp(
        vertices, project(old_pairs, "user_id", "business_id", "undirected"), dimension, seed=seed
    )

    def labelled(positive: DataFrame, negative: DataFrame) -> DataFrame:
        pairs = positive.withColumn("label", F.lit(1.0)).unionByName(
            negative.withColumn("label", F.lit(0.0))
        )
        return cut_lineage(pairs, "labelled")

    def featured(pairs: DataFrame) -> DataFrame:
        # The trees ask for bins only, so a byte per entry is stored instead of a double.
        return _as_vectors(cut_lineage(pair_products(pairs, vectors, *PAIR, "features", cuts), "featured"))

    pairs = labelled(old_pairs, shuffled_negatives(old_pairs, old_pairs, seed))
    cuts = _borders(pairs, vectors, seed)
    train = featured(pairs)
    forest = _without_summary(
        RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(train), train.sparkSession
    )
    late = cut_lineage(sample_rows(after.select(*PAIR).distinct(), PAIR, test_pairs, seed), "late")
    unseen = drawn_negatives(
        graph.user.filter(F.col("review_count") > 5),
        graph.business.filter(F.col("review_count") > 10),
        all_pairs,
        late.count() if test_pairs is None else test_pairs,
        seed,
    )
    test = featured(labelled(late, unseen))

    def areas(pairs: DataFrame) -> Row:
        scored = forest.transform(pairs).select("label", vector_to_array("probability")[1].alias("score"))
        return ranked_areas(scored, "score", "label").first()

    return LinkModel(forest, vectors, moment, areas(train)["auc_pr"], areas(test)["auc_roc"], cuts)


def audience_candidates(graph: Graph, people: DataFrame, nearest: int = 10, min_reviews: int = 100) -> DataFrame:
    """Businesses close to what a user has reviewed: `user_id`, `business_id`, `score`, `n_paths`.

    Every business leads to its `nearest` others by audience; `score` adds up the similarities of all
    ways from a user's businesses to one they have not reviewed and that has over
    `min_reviews` reviews.  The rows are the users' reviews times `nearest`, never users times businesses.
    """
    visits = graph.reviewed.select(F.lit("all").alias("group"), F.col("business_id").alias("item"), F.col("user_id").alias("member"))
    pairs = audience_similarity(visits, nearest).select("item", "other", "similarity")
    pairs = cut_lineage(
        pairs.join(graph.business.filter(F.col("review_count") > min_reviews).select(F.col("business_id").alias("other")), "other", "left_semi"),
        "nearest",
    )
    theirs = cut_lineage(
        graph.reviewed.join(people.select("user_id"), "user_id", "left_semi").select("user_id", F.col("business_id").alias("item")).distinct(),
        "theirs",
    )
    # At most `nearest` rows per business on one side; a business that everybody reviewed is split.
    ways = HotKeys.find(theirs, "item").join(theirs, pairs, ["user_id"])
    # What a user has reviewed is dealt out with the ways, by user: neither the sums nor the ranking deal them out again.
    met = ways.select("user_id", F.col("other").alias("business_id"), "similarity").unionByName(
        theirs.select("user_id", F.col("item").alias("business_id"), F.lit(None).cast("double").alias("similarity"))
    )
    found = met.repartition("user_id").groupBy(*PAIR).agg(
        F.sum("similarity").alias("score"), F.count("similarity").alias("n_paths"), F.count_if(F.col("similarity").isNull()).alias("known")
    )
    return found.filter(F.col("known") == 0).drop("known")


def audience_recommendations(
    graph: Graph, low: int = 50, high: int = 200, min_reviews: int = 100, nearest: int = 10, k: int = 3, model: LinkModel | None = None
) -> DataFrame:
    """For every user with more than `low` and fewer than `high` reviews the k best candidates.

    Ordered by their score, or by the probability a link model gives them.
    """
    people = graph.user.filter((F.col("review_count") > low) & (F.col("review_count") < high))
    found = audience_candidates(graph, people, nearest, min_reviews)
    by = "score"
    if model is not None:
        found, by = model.score(found).select(*PAIR, "score", "n_paths", "probability"), "probability"
    # Sums of the same similarities in another order must not decide a place.
    ranked = found.withColumn(by, F.round(by, 9))
    return top_per_group(ranked, ["user_id"], by, ["business_id"], k)


def recommendations(
    graph: Graph,
    model: LinkModel,
    low: int = 50,
    high: int = 200,
    n_users: int = 5,
    min_reviews: int = 100,
    k: int = 3,
) -> DataFrame:
    """For a handful of active users the k likeliest businesses they have not reviewed."""
    chosen = (
        graph.user.filter((F.col("review_count") > low) & (F.col("review_count") < high))
        .orderBy("user_id")
        .limit(n_users)
        .select("user_id", "name")
    )
    # A fixed handful of users, written into the plan as literals next to every business.
    people = [row["user_id"] for row in chosen.collect()]
    if not people:
        people = [None]
    pairs = graph.business.filter(F.col("review_count") > min_reviews).select(
        "business_id", F.explode(F.array(*[F.lit(p).cast("string") for p in people])).alias("user_id")
    )
    theirs = graph.reviewed.filter(F.col("user_id").isin(people)).select(*PAIR).distinct()
    fresh = pairs.filter(F.col("user_id").isNotNull()).join(theirs, PAIR, "left_anti")
    scored = model.score(fresh).select(*PAIR, "probability")
    best = top_per_group(scored, ["user_id"], "probability", ["business_id"], k)
    return (
        best.join(graph.user.select("user_id", F.col("name").alias("User")), "user_id")
        .join(
            graph.business.select("business_id", F.col("name").alias("Recommended_Restaurant")),
            "business_id",
        )
        .select(
            "User",
            "user_id",
            "place",
            "Recommended_Restaurant",
            "business_id",
            half_up(F.col("probability"), 3).alias("Confidence"),
        )
        .orderBy("user_id", "place")
    )
