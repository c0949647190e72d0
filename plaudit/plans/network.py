"""Graph analytics over the vertex and edge tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from plaudit.functions.numbers import half_up, ratio
from plaudit.operators.centrality import betweenness, business_pagerank, friend_degree
from plaudit.operators.communities import louvain
from plaudit.operators.graph import Graph, project
from plaudit.operators.ranking import spearman
from plaudit.operators.similarity import audience_similarity
from plaudit.operators.skew import hot_key_join, salted_join
from plaudit.operators.topk import both_ends, mode_of_counts, top_k, top_per_group
from plaudit.session import cut_lineage

# -- C1: most connected users --------------------------------------------------------


def top_connected_users(graph: Graph, k: int = 10) -> DataFrame:
    """Users with the most friends."""
    degrees = friend_degree(graph.user, graph.friends_with)
    leaders = top_k(degrees, "degree", ["user_id"], k)
    # Exactly k rows meet the user table.
    return (
        graph.user.join(F.broadcast(leaders), "user_id")
        .select(
            F.col("user_id").alias("UserID"),
            F.col("name").alias("Name"),
            F.col("degree").alias("FriendCount"),
            F.col("review_count").alias("TotalReviewCount"),
            F.col("average_stars").alias("MeanStarRating"),
        )
        .orderBy(F.desc("FriendCount"), "UserID")
    )


# -- C2: best businesses per state ---------------------------------------------------


def top3_by_state(
    graph: Graph, min_reviews: int = 50, k: int = 3, own_state: DataFrame | None = None
) -> DataFrame:
    """The k best rated businesses of every state, with city and categories.

    The state follows from the city, so a business in a city name shared by several
    states counts in each of them.  `own_state` (`business_id`, `state`) uses the
    business's own state instead.
    """
    known = graph.business.filter(F.col("review_count") >= min_reviews)
    placed = known.join(graph.located_in, "business_id")
    if own_state is not None:
        spots = placed.join(own_state.select("business_id", "state"), "business_id")
    else:
        # The k best of a state are among the k best of its cities: a large city is
        # cut down before its states are attached.
        finalists = top_per_group(placed, ["city"], "stars", ["business_id"], k, place="in_city")
        spots = finalists.join(graph.part_of, "city")
    # k rows per state, needed twice.
    best = cut_lineage(top_per_group(spots, ["state"], "stars", ["business_id"], k), "best")
    labels = (
        graph.in_category.join(best.select("business_id").distinct(), "business_id", "left_semi")
        .groupBy("business_id")
        .agg(F.array_sort(F.collect_list("category")).alias("categories"))
    )
    entry = F.struct(
        "place",
        F.struct(
            F.col("name").alias("Name"),
            F.col("city").alias("City"),
            F.col("stars").alias("Stars"),
            F.coalesce("categories", F.array().cast("array<string>")).alias("Categories"),
        ).alias("item"),
    )
    # k entries per state.
    return (
        best.join(labels, "business_id", "left")
        .groupBy(F.col("state").alias("State"))
        .agg(
            F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["item"]).alias(
                "Top3Businesses"
            )
        )
    )


# -- C3: most travelled users --------------------------------------------------------


def most_travelled_users(graph: Graph, k: int = 10, **hot_limits) -> DataFrame:
    """Users whose reviews cover the most cities, with their mean rating in each.

    Cities are counted for everybody, ratings only for the k leaders.
    """
    visits = graph.reviewed.select("user_id", "business_id", "review_id")
    counts = (
        hot_key_join(visits, graph.located_in, "business_id", ["review_id"], **hot_limits)
        .select("user_id", "city")
        .distinct()
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("NumberOfCities"))
    )
    # Exactly k rows.
    leaders = F.broadcast(top_k(counts, "NumberOfCities", ["user_id"], k))
    theirs = graph.reviewed.select("user_id", "business_id", "stars").join(leaders, "user_id")
    lists = (
        theirs.join(graph.located_in, "business_id")
        .groupBy("user_id", "NumberOfCities", "city")
        .agg(F.avg("stars").alias("avgRating"))
        .groupBy("user_id", "NumberOfCities")
        .agg(F.array_sort(F.collect_list(F.struct("city", "avgRating"))).alias("MeanRatingPerCity"))
    )
    return (
        graph.user.select("user_id", "name")
        .join(F.broadcast(lists), "user_id")
        .select(
            F.col("name").alias("Name"),
            F.col("user_id").alias("UserID"),
            "NumberOfCities",
            "MeanRatingPerCity",
        )
        .orderBy(F.desc("NumberOfCities"), "UserID")
    )


# -- C4: fans of a category ----------------------------------------------------------


def category_fans(
    graph: Graph, category: str = "Mexican", min_businesses: int = 5, k: int = 50, **hot_limits
) -> DataFrame:
    """Users who reviewed many businesses of a category, against their overall mean."""
    members = graph.in_category.filter(F.col("category") == category).select("business_id")
    visits = hot_key_join(graph.reviewed, members, "business_id", ["review_id"], **hot_limits)
    fans = (
        visits.groupBy("user_id", "business_id")
        .agg(F.sum("stars").alias("stars"), F.count("stars").alias("n"))
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("CategoryReviewCount"),
            ratio(F.sum("stars"), F.sum("n")).alias("mean"),
        )
        .filter(F.col("CategoryReviewCount") >= min_businesses)
    )
    leaders = F.broadcast(top_k(fans, "CategoryReviewCount", ["user_id"], k))
    return (
        graph.user.select("user_id", "name", "average_stars")
        .join(leaders, "user_id")
        .select(
            F.col("user_id").alias("UserID"),
            F.col("name").alias("Name"),
            "CategoryReviewCount",
            half_up(F.col("mean"), 2).alias("CategoryMean"),
            half_up(F.col("average_stars"), 2).alias("OverallMean"),
            half_up(F.col("mean") - F.col("average_stars"), 2).alias("RatingDifference"),
        )
        .orderBy(F.desc("CategoryReviewCount"), "UserID")
    )


# -- C5: safest categories, graph edition --------------------------------------------


def safest_categories_graph(graph: Graph, min_reviews: int = 10_000, k: int = 10) -> DataFrame:
    """Best rated categories above a review volume; ordered by the rounded mean."""
    stats = (
        graph.in_category.join(graph.business, "business_id")
        .groupBy(F.col("category").alias("Category"))
        .agg(
            F.count(F.lit(1)).alias("NumBusinesses"),
            F.sum("review_count").alias("TotalReviews"),
            half_up(F.avg("stars"), 2).alias("AvgRating"),
        )
        .filter(F.col("TotalReviews") > min_reviews)
    )
    return top_k(stats, "AvgRating", ["Category"], k)


# -- G1: PageRank --------------------------------------------------------------------


def ranked_businesses(graph: Graph, k: int = 1000, digits: int = 9, **options) -> DataFrame:
    """The k reviewed businesses with the highest star-weighted PageRank.

    Ranks are rounded, as their last digits depend on the order of summation.
    """
    ranks = business_pagerank(graph.business, graph.reviewed, weighted=True, **options)
    reviewed = graph.business.filter(F.col("review_count") > 0)
    named = reviewed.join(ranks, "business_id").select(
        "business_id",
        F.col("name").alias("Name"),
        half_up(F.col("pagerank"), digits).alias("PageRank"),
        F.col("review_count").alias("ReviewCount"),
        F.col("stars").alias("AvgStars"),
    )
    return top_k(named, "PageRank", ["business_id"], k)


def pagerank_report(graph: Graph, k: int = 15, pool: int = 1000) -> DataFrame:
    """The leaders of the pool."""
    return top_k(ranked_businesses(graph, pool), "PageRank", ["business_id"], k)


def pagerank_spearman(graph: Graph, pool: int = 1000) -> DataFrame:
    """Rank correlation of PageRank with review count and with stars over the pool."""
    leaders = cut_lineage(ranked_businesses(graph, pool), "leaders")
    parts = [
        spearman(leaders, "PageRank", other).select(F.lit(other).alias("against"), "spearman")
        for other in ("ReviewCount", "AvgStars")
    ]
    return reduce(DataFrame.unionByName, parts)


# -- G2: where communities live ------------------------------------------------------


def friend_communities(graph: Graph, **options) -> DataFrame:
    """`user_id`, `community` by greedy modularity on the friendship graph."""
    vertices = graph.user.select(F.col("user_id").alias("id"))
    edges = project(graph.friends_with, "user_id", "friend_id", "undirected")
    found = louvain(vertices, edges, **options)
    return found.select(F.col("id").alias("user_id"), "community")


def community_geo(
    graph: Graph,
    communities: DataFrame,
    min_size: int = 25,
    size_on: str = "n_reviews",
    k: int = 15,
    own_state: DataFrame | None = None,
    **hot_limits,
) -> DataFrame:
    """Main state and geographic concentration of communities.

    `n_reviews` counts review-to-state paths, `n_members` the users behind them;
    `size_on` names the one that must reach `min_size`.  A city name shared by several
    states counts in each of them; `own_state` (`business_id`, `state`) uses the
    business's own state instead.
    """
    if own_state is None:
        states = graph.located_in.join(graph.part_of, "city").select("business_id", "state")
    else:
        states = own_state.select("business_id", "state").na.drop().distinct()
    # A user leaves this step as one row with a short list, one entry per state.
    per_user = (
        hot_key_join(graph.reviewed, states, "business_id", ["review_id"], **hot_limits)
        .groupBy("user_id", "state")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("user_id")
        .agg(F.collect_list(F.struct("state", "n")).alias("visits"))
    )
    # The first entry of a user's list stands for the user as a member.
    by_state = (
        per_user.join(communities, "user_id")
        .select("community", F.posexplode("visits").alias("nth", "visit"))
        .groupBy("community", F.col("visit.state").alias("state"))
        .agg(F.sum("visit.n").alias("n"), F.count_if(F.col("nth") == 0).alias("n_members"))
    )
    shaped = (
        mode_of_counts(by_state, ["community"], "state", ["n_members"])
        .select(
            F.col("community").alias("CommunityID"),
            F.col("n_total").alias("n_reviews"),
            "n_members",
            F.col("state").alias("TopState"),
            half_up(ratio(F.col("n_item"), F.col("n_total")), 3).alias("GeoConcentration"),
        )
        .filter(F.col(size_on) >= min_size)
    )
    return top_k(shaped, "GeoConcentration", ["CommunityID"], k)


# -- G3: market saturation -----------------------------------------------------------


def largest_cities(graph: Graph, min_businesses: int = 20, k: int = 10) -> DataFrame:
    counts = (
        graph.located_in.groupBy("city")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_businesses)
    )
    return top_k(counts, "n", ["city"], k)


def similar_businesses(
    graph: Graph, cities: DataFrame, top: int = 50, min_shared: int = 3, **options
) -> DataFrame:
    """Ordered pairs of businesses of one city with similar audiences.

    The k nearest are chosen first, the shared-reviewer threshold applies to them.
    """
    spots = graph.located_in.join(cities.select("city"), "city", "left_semi")
    # One row per business; only its reviewers matter, not how often they came.
    visits = hot_key_join(graph.reviewed, spots, "business_id", ["review_id"]).select(
        F.col("city").alias("group"), F.col("business_id").alias("item"), F.col("user_id").alias("member")
    )
    return audience_similarity(visits, top, **options).filter(F.col("shared") >= min_shared)


def market_saturation(
    graph: Graph,
    min_city_businesses: int = 20,
    n_cities: int = 10,
    top: int = 50,
    min_shared: int = 3,
    min_businesses: int = 5,
    k: int = 5,
    distinct_on: str = "name",
    digits: int | None = None,
    **options,
) -> DataFrame:
    """Mean audience similarity per city and category: most and least saturated markets.

    All cities are handled in one job keyed by city.  Pairs are ordered, so a pair in
    both top lists counts twice.  `distinct_on` says what counts as one business.
    """
    cities = largest_cities(graph, min_city_businesses, n_cities)
    pairs = similar_businesses(graph, cities, top, min_shared, **options)
    # A business's categories are few: one short list per business travels with a pair.
    labels = graph.in_category.groupBy("business_id").agg(F.collect_set("category").alias("labels"))
    named = graph.business.select("business_id", "name").join(labels, "business_id")
    first = named.select(F.col("business_id").alias("item"), "name", F.col("labels").alias("mine"))
    second = labels.select(F.col("business_id").alias("other"), F.col("labels").alias("theirs"))
    counted = "name" if distinct_on == "name" else "item"
    each = (
        # A small audience can be the nearest of very many others.
        salted_join(pairs.join(first, "item"), second, "other", ["item"])
        .withColumn("category", F.explode(F.array_intersect("mine", "theirs")))
        .groupBy("group", "category", counted)
        .agg(F.sum("similarity").alias("similarity"), F.count(F.lit(1)).alias("n"))
    )
    mean = ratio(F.sum("similarity"), F.sum("n"))
    stats = (
        each.groupBy(F.col("group").alias("City"), F.col("category").alias("Category"))
        .agg(
            (mean if digits is None else half_up(mean, digits)).alias("Mean_Similarity"),
            F.count(F.lit(1)).alias("Unique_Businesses"),
        )
        .filter(F.col("Unique_Businesses") >= min_businesses)
    )
    return both_ends(stats, "Mean_Similarity", ["City", "Category"], k)


# -- G4: bridges between clusters ----------------------------------------------------


def group_stats(graph: Graph, members: DataFrame, group: str = "side", mean_on: str = "rows", **hot_limits) -> DataFrame:
    """Mean reviews and cities and categories per head of groups of users.

    `members` holds `user_id` and the group name.  The mean runs over review-and-category
    rows, or once over every user that has a review with `mean_on="users"`; cities and
    categories are counted once per group and divided by its size.
    """
    if mean_on not in ("rows", "users"):
        raise ValueError(mean_on)
    few = cut_lineage(members, "members")
    sizes = few.groupBy(group).agg(F.count(F.lit(1)).alias("n_users"))
    visits = graph.reviewed.join(few, "user_id").select(group, "user_id", "business_id", "review_id")
    placed = hot_key_join(visits, graph.located_in, "business_id", ["review_id"], "left", **hot_limits)
    # Users meet a business again and again; the fan-out needs each meeting once.
    met = placed.groupBy(group, "user_id", "business_id", "city").agg(F.count(F.lit(1)).alias("n"))
    rows = met.join(graph.in_category, "business_id", "left").join(
        graph.user.select("user_id", "review_count").join(
            few.select("user_id").distinct(), "user_id", "left_semi"
        ),
        "user_id",
    )
    mean = ratio(F.sum(F.col("n") * F.col("review_count")), F.sum("n")).alias("mean_reviews")
    if mean_on == "users":
        known = rows.select(group, "user_id", "review_count").distinct()
        per_user = known.groupBy(group).agg(F.avg("review_count").alias("user_mean"))
        rows, mean = rows.join(per_user, group), F.first("user_mean").alias("mean_reviews")
    return (
        rows.groupBy(group)
        .agg(
            mean,
            F.count_distinct("city").alias("cities"),
            F.count_distinct("category").alias("categories"),
        )
        .join(sizes, group)
        .select(
            group,
            "n_users",
            half_up(F.col("mean_reviews"), 1).alias("MeanReviews"),
            half_up(ratio(F.col("cities"), F.col("n_users")), 1).alias("DistinctCities"),
            half_up(ratio(F.col("categories"), F.col("n_users")), 1).alias("DistinctCategories"),
        )
    )


def bridge_users(graph: Graph, k: int = 20, sources: int | None = 250, seed: int = 42, **options) -> DataFrame:
    """Users between clusters (high betweenness, outside the top degrees) against hubs.

    One row per group with the number of users in both top lists.
    """
    vertices = graph.user.select(F.col("user_id").alias("id"))
    edges = project(graph.friends_with, "user_id", "friend_id", "undirected")
    scores = betweenness(vertices, edges, sources, seed=seed, **options).withColumn(
        "score", F.round("score", 9)
    )
    central = top_k(scores, "score", ["id"], k).select(F.col("id").alias("user_id"))
    degrees = friend_degree(graph.user, graph.friends_with)
    hubs = cut_lineage(top_k(degrees, "degree", ["user_id"], k).select("user_id"), "hubs")
    central = cut_lineage(central, "central")
    shared = central.intersect(hubs).agg(F.count(F.lit(1)).alias("overlap"))
    bridges = central.subtract(hubs).withColumn("side", F.lit("bridge"))
    members = bridges.unionByName(hubs.withColumn("side", F.lit("hub")))
    return group_stats(graph, members).withColumn("overlap", F.lit(shared.first()[0]))
