"""Property graph as vertex and edge tables."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plaudit.functions.times import epoch_seconds
from plaudit.session import cut_lineage
from plaudit.sources.files import write_table


def _first_per_key(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key: the smallest by the columns in order, whichever task sees it first."""
    return df.groupBy(key).agg(F.min(F.struct(*columns)).alias("first")).select(key, "first.*")


def user_vertices(users: DataFrame) -> DataFrame:
    return _first_per_key(users, "user_id", ["name", "review_count", "average_stars"])


def business_vertices(businesses: DataFrame) -> DataFrame:
    return _first_per_key(businesses, "business_id", ["name", "stars", "review_count"])


def category_vertices(businesses: DataFrame) -> DataFrame:
    return businesses.select(F.explode("categories").alias("name")).distinct()


def city_vertices(businesses: DataFrame) -> DataFrame:
    return businesses.select(F.col("city").alias("name")).na.drop().distinct()


def state_vertices(businesses: DataFrame) -> DataFrame:
    return businesses.select(F.col("state").alias("code")).na.drop().distinct()


def in_category(businesses: DataFrame) -> DataFrame:
    return businesses.select("business_id", F.explode("categories").alias("category")).distinct()


def located_in(businesses: DataFrame) -> DataFrame:
    return businesses.select("business_id", "city").na.drop().distinct()


def part_of(businesses: DataFrame) -> DataFrame:
    """City to state.  A city is known by its name, so it may belong to several states."""
    return businesses.select("city", "state").na.drop().distinct()


def _with_ends(edges: DataFrame, users: DataFrame, businesses: DataFrame) -> DataFrame:
    """Keep the edges whose user and business both exist."""
    return edges.join(users.select("user_id"), "user_id", "left_semi").join(
        businesses.select("business_id"), "business_id", "left_semi"
    )


def _strangers(edges: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """The ends that do not exist.  Hardly any, so they are stored and their real size decides how they are joined."""
    return cut_lineage(edges.select(key).distinct().join(known.select(key), key, "left_anti"), "strangers")


def reviewed(reviews: DataFrame, users: DataFrame, businesses: DataFrame) -> DataFrame:
    """One edge per review; parallel edges stay apart.

    The same id with the same ends is one edge and keeps the latest values; an
    undated review keeps its stars.  Hardly any ids repeat and the largest struct is found by sorting,
    so the rows are dealt out first and sorted in small parts, not once more in every scan task.
    Whole edges are dealt out once; their ends are looked up by themselves.
    """
    latest = F.max(F.struct("date", "stars"))
    key = ["user_id", "business_id", "review_id"]
    ended = reviews.select(*key, "date", "stars").filter(F.col("user_id").isNotNull() & F.col("business_id").isNotNull())
    for end, known in (("user_id", users), ("business_id", businesses)):
        ended = ended.join(_strangers(reviews, end, known), end, "left_anti")
    return (
        ended.repartition(*key).groupBy(*key)
        .agg(latest.alias("latest"))
        .select("user_id", "business_id", "review_id", "latest.stars", "latest.date")
    )


def tip_left(tips: DataFrame, users: DataFrame, businesses: DataFrame) -> DataFrame:
    """One edge per user and business, dated by the latest tip."""
    latest = tips.groupBy("user_id", "business_id").agg(F.max("date").alias("date"))
    return _with_ends(latest, users, businesses)


def friends_with(users: DataFrame, symmetrise: bool = False) -> DataFrame:
    """Undirected friendships, one row per pair with `user_id < friend_id`.

    By default a pair counts when the smaller id lists the larger one;
    `symmetrise=True` also accepts a listing by the larger id only.
    """
    listed = users.select("user_id", F.explode("friends").alias("friend_id")).filter(
        ~F.col("friend_id").isin("", "None")
    )
    if symmetrise:
        listed = listed.select(
            F.least("user_id", "friend_id").alias("user_id"),
            F.greatest("user_id", "friend_id").alias("friend_id"),
        )
    pairs = listed.filter(F.col("user_id") < F.col("friend_id")).distinct()
    known = users.select("user_id")
    return pairs.join(known, "user_id", "left_semi").join(
        known.withColumnRenamed("user_id", "friend_id"), "friend_id", "left_semi"
    ).select("user_id", "friend_id")


def with_epoch(edges: DataFrame) -> DataFrame:
    """Add `timestamp`, the date in seconds since 1970."""
    return edges.withColumn("timestamp", epoch_seconds(F.col("date")))


def project(
    edges: DataFrame,
    source: str,
    target: str,
    orientation: str = "natural",
    weight: str | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Subgraph as `src`, `dst`, `w` edges: filtered, weighted and oriented."""
    kept = edges if where is None else edges.filter(where)
    amount = F.col(weight).cast("double") if weight else F.lit(1.0)
    forward = kept.select(F.col(source).alias("src"), F.col(target).alias("dst"), amount.alias("w"))
    backward = forward.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    if orientation == "natural":
        return forward
    if orientation == "reversed":
        return backward
    return forward.unionByName(backward)


@dataclass(frozen=True)
class Graph:
    """The five vertex tables and six edge tables."""

    user: DataFrame
    business: DataFrame
    category: DataFrame
    city: DataFrame
    state: DataFrame
    reviewed: DataFrame
    tip_left: DataFrame
    in_category: DataFrame
    located_in: DataFrame
    part_of: DataFrame
    friends_with: DataFrame

    @classmethod
    def build(cls, businesses: DataFrame, users: DataFrame, reviews: DataFrame, tips: DataFrame) -> Graph:
        return cls(
            user=user_vertices(users),
            business=business_vertices(businesses),
            category=category_vertices(businesses),
            city=city_vertices(businesses),
            state=state_vertices(businesses),
            reviewed=reviewed(reviews, users, businesses),
            tip_left=tip_left(tips, users, businesses),
            in_category=in_category(businesses),
            located_in=located_in(businesses),
            part_of=part_of(businesses),
            friends_with=friends_with(users),
        )

    def tables(self) -> dict[str, DataFrame]:
        return {field.name: getattr(self, field.name) for field in fields(self)}

    def write(self, folder: str) -> None:
        for name, table in self.tables().items():
            write_table(table, f"{folder}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> Graph:
        return cls(**{f.name: spark.read.parquet(f"{folder}/{f.name}") for f in fields(cls)})
