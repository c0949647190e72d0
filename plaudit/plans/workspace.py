"""Review-network entities derived from star-schema test tables.

Every entity is cleaned with the operators of this package, written once to the
shared folder on first use and scanned from there by all later queries, as an
analyst would run the ETL once and query its tables many times.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plaudit.functions.texts import code_points
from plaudit.operators import graph as g
from plaudit.operators.cleaning import add_tip_counts, checkin_stats, clean_businesses, clean_users
from plaudit.operators.communities import Convergence
from plaudit.plans.links import LinkModel, train_links
from plaudit.plans.network import friend_communities
from plaudit.plans.usefulness import split_features, train_usefulness, usefulness_features
from plaudit.session import cut_lineage

class StoredGraph(g.Graph):
    """The graph of a workspace; every table is built and written when it is first asked for."""

    def __init__(self, workspace: Workspace):
        object.__setattr__(self, "_workspace", workspace)

    @cached_property
    def user(self) -> DataFrame:
        return cut_lineage(g.user_vertices(self._workspace.users), "user")

    @cached_property
    def business(self) -> DataFrame:
        return cut_lineage(g.business_vertices(self._workspace.businesses), "business")

    @cached_property
    def category(self) -> DataFrame:
        return cut_lineage(g.category_vertices(self._workspace.businesses), "category")

    @cached_property
    def city(self) -> DataFrame:
        return cut_lineage(g.city_vertices(self._workspace.businesses), "city")

    @cached_property
    def state(self) -> DataFrame:
        return cut_lineage(g.state_vertices(self._workspace.businesses), "state")

    @cached_property
    def reviewed(self) -> DataFrame:
        w = self._workspace
        return cut_lineage(g.reviewed(w.reviews, w.users, w.businesses), "reviewed")

    @cached_property
    def tip_left(self) -> DataFrame:
        w = self._workspace
        return cut_lineage(g.tip_left(w.tips, w.users, w.businesses), "tip_left")

    @cached_property
    def in_category(self) -> DataFrame:
        return cut_lineage(g.in_category(self._workspace.businesses), "in_category")

    @cached_property
    def located_in(self) -> DataFrame:
        return cut_lineage(g.located_in(self._workspace.businesses), "located_in")

    @cached_property
    def part_of(self) -> DataFrame:
        return cut_lineage(g.part_of(self._workspace.businesses), "part_of")

    @cached_property
    def friends_with(self) -> DataFrame:
        return cut_lineage(g.friends_with(self._workspace.users), "friends_with")


def _stars() -> Column:
    return (1 + F.floor((F.col("l_quantity") - 1) / 10)).cast("int")


def _useful() -> Column:
    return F.round(F.col("l_discount") * 100).cast("long")


_OPEN: dict[tuple[str, str], Workspace] = {}


def open_workspace(spark: SparkSession, folder: str) -> Workspace:
    """The workspace of a folder, shared by all queries of one Spark application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _OPEN:
        _OPEN[key] = Workspace(spark, folder)
    return _OPEN[key]


class Workspace:
    """Lazily built entity tables over `<folder>/<table>.parquet`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- documents -----------------------------------------------------------------

    @cached_property
    def n_documents(self) -> int:
        return self.source("documents").count()

    @cached_property
    def n_customers(self) -> int:
        return self.source("customer").count()

    def _orders(self) -> DataFrame:
        """Orders with the document that all their lines carry."""
        place = F.pmod("o_orderkey", F.lit(self.n_documents))
        return self.source("orders").select("o_orderkey", "o_custkey", place.alias("doc_id"))

    def _review_rows(self, orders: DataFrame, carried: str) -> DataFrame:
        """One review per line of an order, with the column `carried` of `orders`."""
        stamp = F.date_format("l_shipdate", "yyyyMMdd")
        return (
            self.source("lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", stamp).alias(
                    "review_id"
                ),
                F.concat(F.lit("u"), "o_custkey").alias("user_id"),
                F.concat(F.lit("b"), "l_partkey").alias("business_id"),
                _stars().alias("stars"),
                F.col("l_shipdate").alias("date"),
                _useful().alias("useful"),
                carried,
            )
        )

    @cached_property
    def reviews(self) -> DataFrame:
        """Reviews with the length of their text, measured once per document and joined once per order."""
        lengths = self.source("documents").select("doc_id", code_points(F.col("text")).alias("text_length"))
        return cut_lineage(self._review_rows(self._orders().join(lengths, "doc_id", "left"), "text_length"), "reviews")

    @property
    def votes(self) -> DataFrame:
        """`user_id` and `useful` of every row of `reviews`, which need not be written for them."""
        numbers = self.source("documents").select("doc_id")
        return self._review_rows(self._orders().join(numbers, "doc_id", "left"), "doc_id").select("user_id", "useful")

    @property
    def reviews_with_text(self) -> DataFrame:
        """Reviews that carry their whole text; not written, the text is large.

        Lines and orders are dealt out by order at any size, so that the texts are spread over all tasks.
        """
        texts = self.source("documents").select("doc_id", "text")
        return self._review_rows(self._orders().hint("merge"), "doc_id").join(texts, "doc_id", "left").drop("doc_id")

    @property
    def checkin_tokens(self) -> DataFrame:
        """Check-ins as tokens in time order per business."""
        return (
            self.source("events")
            .filter(F.col("event_type") == "view")
            .select(
                F.concat(F.lit("b"), F.get_json_object("props", "$.k")).alias("business_id"),
                F.unix_micros(F.col("ts").cast("timestamp")).alias("ord"),
                F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("token"),
            )
        )

    @property
    def raw_checkins(self) -> DataFrame:
        """Check-ins as in the raw file: one list of times per business as a string, blank where there is none."""
        lists = self.checkin_tokens.groupBy("business_id").agg(
            F.array_join(F.array_sort(F.collect_list("token")), ", ").alias("date")
        )
        shops = self.source("part").select(F.concat(F.lit("b"), "p_partkey").alias("business_id"))
        return shops.join(lists, "business_id", "left").withColumn("date", F.coalesce("date", F.lit("")))

    @property
    def raw_businesses(self) -> DataFrame:
        """Businesses before cleaning: categories are one string."""
        places = (
            self.source("nation")
            .join(self.source("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("state"))
        )
        counts = self.source("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
            F.count(F.lit(1)).alias("review_count")
        )
        words = F.split("p_name", " ")
        return (
            self.source("part")
            .join(places, F.pmod("p_partkey", F.lit(25)) == F.col("n_nationkey"))
            .join(counts, "p_partkey", "left")
            .select(
                F.concat(F.lit("b"), "p_partkey").alias("business_id"),
                F.col("p_name").alias("name"),
                "city",
                "state",
                (1.0 + F.pmod("p_size", F.lit(9)) * F.lit(0.5).cast("double")).cast("double").alias("stars"),
                F.coalesce("review_count", F.lit(0).cast("long")).alias("review_count"),
                F.concat_ws(
                    ", ", "p_type", "p_brand", F.element_at(words, 1), F.element_at(words, 2)
                ).alias("categories"),
            )
        )

    @cached_property
    def businesses(self) -> DataFrame:
        cleaned = clean_businesses(self.raw_businesses, checkin_stats(self.checkin_tokens))
        return cut_lineage(add_tip_counts(cleaned, self.tips), "businesses")

    @cached_property
    def review_sums(self) -> DataFrame:
        """Per user what `reviews` add up to; lines are summed by order before they meet the orders.

        A review whose document number occurs several times counts as often, as it does in `reviews`.
        """
        of_order = self.source("lineitem").groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum(_useful()).alias("useful"),
            F.count(_stars()).alias("rated"),
            F.sum(_stars()).alias("stars"),
        )
        copies = self.source("documents").groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
        orders = self._orders().join(copies, "doc_id", "left").select(
            "o_orderkey", F.concat(F.lit("u"), "o_custkey").alias("user_id"), F.coalesce("copies", F.lit(1)).alias("copies")
        )
        # The lines lie by order after their sum; orders that seem small must not travel through the driver.
        met = of_order.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        sums = met.groupBy("user_id").agg(
            F.sum(F.col("lines") * F.col("copies")).alias("review_count"),
            F.sum(F.col("useful") * F.col("copies")).alias("useful"),
            F.try_divide(
                F.sum(F.col("stars") * F.col("copies")).cast("double"), F.sum(F.col("rated") * F.col("copies"))
            ).alias("average_stars"),
        )
        return cut_lineage(sums, "review_sums")

    @property
    def raw_users(self) -> DataFrame:
        """Users before cleaning: elite years and friends are strings."""
        sums = self.review_sums
        n, key = F.lit(self.n_customers), F.col("c_custkey")
        first = F.lit(1995) + F.pmod(key, F.lit(5))

        def friend(number):
            return F.concat(F.lit("u"), F.pmod(number, n).cast("string"))

        joined = F.date_add(F.lit("1990-01-01").cast("date"), F.pmod(key * 37, F.lit(1826)).cast("int"))
        return (
            self.source("customer")
            .select(
                F.concat(F.lit("u"), "c_custkey").alias("user_id"),
                F.col("c_name").alias("name"),
                F.date_format(joined, "yyyy-MM-dd HH:mm:ss").alias("yelping_since"),
                F.when(F.pmod(key, F.lit(3)) == 0, "")
                .otherwise(F.concat_ws(",", first.cast("string"), (first + 1).cast("string")))
                .alias("elite"),
                F.when(F.pmod(key, F.lit(10)) == 0, "None")
                .otherwise(
                    F.concat_ws(", ", friend(key * 31 + 7), friend(key * 17 + 3), friend(key + 25))
                )
                .alias("friends"),
            )
            .join(sums, "user_id", "left")
            .withColumn("review_count", F.coalesce("review_count", F.lit(0).cast("long")))
            .withColumn("useful", F.coalesce("useful", F.lit(0).cast("long")))
        )

    @cached_property
    def users(self) -> DataFrame:
        return cut_lineage(clean_users(self.raw_users), "users")

    @cached_property
    def tips(self) -> DataFrame:
        rows = (
            self.source("events")
            .filter(F.col("event_type") == "purchase")
            .select(
                F.concat(F.lit("u"), "user_id").alias("user_id"),
                F.concat(F.lit("b"), F.get_json_object("props", "$.k")).alias("business_id"),
                F.col("ts").alias("date"),
                F.col("props").alias("text"),
            )
        )
        return cut_lineage(rows, "tips")

    # -- graph ---------------------------------------------------------------------

    @cached_property
    def graph(self) -> g.Graph:
        return StoredGraph(self)

    @cached_property
    def communities(self) -> DataFrame:
        """Community of every user, stored like a vertex property."""
        return self._detected[0]

    @property
    def community_rounds(self) -> DataFrame:
        """The rounds that led to `communities`."""
        return self._detected[1].table(self.spark)

    @cached_property
    def _detected(self) -> tuple[DataFrame, Convergence]:
        rounds = Convergence()
        return cut_lineage(friend_communities(self.graph, convergence=rounds), "communities"), rounds

    @cached_property
    def usefulness_features(self) -> DataFrame:
        """Feature rows of the usefulness model, shared by training and evaluation."""
        return cut_lineage(usefulness_features(self.reviews, self.users, self.graph), "features")

    @cached_property
    def usefulness_split(self) -> DataFrame:
        return cut_lineage(split_features(self.usefulness_features), "split")

    @cached_property
    def usefulness_model(self) -> GBTRegressionModel:
        """The full boosting run, shared by the queries of one session."""
        return train_usefulness(self.usefulness_split.filter("is_train"))

    @cached_property
    def link_model(self) -> LinkModel:
        return train_links(self.graph)
