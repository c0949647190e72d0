"""Document analytics over businesses, users and reviews.

Reviews are always reduced per business or per user before they meet the other
table.  That keeps the join and the fan-out over categories at the size of the
smaller table, and a business or user with a large part of all reviews arrives as
one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plaudit.functions.numbers import (
    average_where,
    bin_label,
    count_where,
    half_even,
    is_fall,
    ratio,
    step_bin,
    total,
)
from plaudit.functions.texts import review_length
from plaudit.operators.ranking import exact_percentiles
from plaudit.operators.sampling import sample_rows
from plaudit.operators.topk import both_ends, top_k

STARS = (1, 2, 3, 4, 5)

# Bin edges and labels of the reports.  Fixed values; a label names its bin loosely,
# the edges decide: a bin holds its lower edge and not its upper one.
VOLUME_EDGES = (0, 10, 50, 200, 1000, 5000)
VOLUME_LABELS = (
    "0-10 (Micro)",
    "11-50 (Low)",
    "51-200 (Mid)",
    "201-1000 (High)",
    "1001-5000 (Very High)",
    "5000+ (Extreme)",
)
TENURE_EDGES = (0, 2, 5, 10, 15)
TENURE_LABELS = (
    "Newcomers (<2 yrs)",
    "Established (2-5 yrs)",
    "Experienced (5-10 yrs)",
    "Long-term (10-15 yrs)",
    "Veterans (15+ yrs)",
)
VISIT_EDGES = (1, 10, 50, 200, 500, 1000)
VISIT_LABELS = (
    "Rarely Visited (1-10)",
    "Occasionally Visited (10-50)",
    "Popular (50-200)",
    "Highly Visited (200-500)",
    "Top-Tier (500-1000)",
    "Mega-Business (1000+)",
)
LOW, MEDIUM, HIGH = "Low (Bottom 25%)", "Medium (Middle 50%)", "High (Top 25%)"
ELITE, NOT_ELITE = "Elite User", "Non-Elite User"


def by_group(businesses: DataFrame, group: str) -> DataFrame:
    """Businesses keyed by a plain column, or once per item of a list column."""
    if dict(businesses.dtypes)[group].startswith("array"):
        return businesses.withColumn(group, F.explode(group))
    return businesses


# -- M1: safest and least safe -------------------------------------------------------


def safest(
    businesses: DataFrame, group: str, min_reviews: int, min_businesses: int, k: int = 5
) -> DataFrame:
    """Best and worst groups (`city` or `categories`) by mean stars, given enough volume."""
    stats = (
        by_group(businesses, group)
        .groupBy(group)
        .agg(
            F.avg("stars").alias("avg_stars"),
            total(F.col("review_count")).alias("total_reviews"),
            F.count(F.lit(1)).alias("business_count"),
        )
        .filter(
            (F.col("total_reviews") >= min_reviews) & (F.col("business_count") >= min_businesses)
        )
    )
    return both_ends(stats, "avg_stars", [group], k)


def safest_cities(businesses: DataFrame, min_reviews: int = 1000, min_businesses: int = 50) -> DataFrame:
    return safest(businesses, "city", min_reviews, min_businesses)


def safest_categories(
    businesses: DataFrame, min_reviews: int = 5000, min_businesses: int = 100
) -> DataFrame:
    return safest(businesses, "categories", min_reviews, min_businesses)


# -- M2: rating trends ---------------------------------------------------------------


def rating_trends(
    businesses: DataFrame,
    reviews: DataFrame,
    group: str,
    state: str,
    start: str,
    end: str,
    min_reviews: int,
    min_years: int = 3,
    k: int = 5,
    record_cap: int | None = None,
) -> DataFrame:
    """Groups of one state whose yearly mean rating rose or fell most.

    The trend is the last kept year's mean minus the first one's.  `record_cap`
    restricts the reviews of the state to a repeatable subset before dates apply.
    """
    local = businesses.filter(F.col("state") == state)
    # Only the state's reviews reach the aggregation.
    reviews = reviews.join(local.select("business_id"), "business_id", "left_semi")
    if record_cap is not None:
        reviews = sample_rows(reviews, ["review_id"], record_cap)
    window = F.col("date").between(
        F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    )
    yearly = (
        reviews.filter(window)
        .groupBy("business_id", F.year("date").alias("year"))
        .agg(F.sum("stars").alias("stars"), F.count(F.lit(1)).alias("n"))
    )
    means = (
        by_group(yearly.join(local.select("business_id", group), "business_id"), group)
        .groupBy(group, "year")
        .agg(total(F.col("stars")).alias("stars"), F.sum("n").alias("reviews"))
        .filter(F.col("reviews") >= min_reviews)
        .withColumn("avg_stars", F.col("stars") / F.col("reviews"))
    )
    # One entry per year: the lists are bounded by the length of the window.
    trends = (
        means.groupBy(group)
        .agg(
            F.array_sort(F.collect_list(F.struct("year", "avg_stars", "reviews"))).alias("timeline"),
            (F.max_by("avg_stars", "year") - F.min_by("avg_stars", "year")).alias("trend"),
            F.count(F.lit(1)).alias("years"),
        )
        .filter(F.col("years") >= min_years)
        .select(group, "trend", "timeline")
    )
    return both_ends(trends, "trend", [group], k)


def city_trends(
    businesses: DataFrame,
    reviews: DataFrame,
    state: str = "PA",
    start: str = "2017-01-01",
    end: str = "2021-12-31 23:59:59",
    min_reviews: int = 20,
    **options,
) -> DataFrame:
    return rating_trends(businesses, reviews, "city", state, start, end, min_reviews, **options)


def category_trends(
    businesses: DataFrame,
    reviews: DataFrame,
    state: str = "PA",
    start: str = "2017-01-01",
    end: str = "2021-12-31 23:59:59",
    min_reviews: int = 50,
    **options,
) -> DataFrame:
    return rating_trends(businesses, reviews, "categories", state, start, end, min_reviews, **options)


# -- M3: review volume against rating ------------------------------------------------


def volume_vs_rating(
    businesses: DataFrame,
    edges: Sequence[int] = VOLUME_EDGES,
    labels: Sequence[str] = VOLUME_LABELS,
) -> DataFrame:
    """Mean and spread of stars per review-volume tier, in tier order."""
    return (
        businesses.groupBy(step_bin(F.col("review_count"), edges).alias("bin"))
        .agg(
            F.avg("stars").alias("mean"),
            F.stddev_pop("stars").alias("spread"),
            F.count(F.lit(1)).alias("business_count"),
        )
        .orderBy("bin")
        .select(
            bin_label(F.col("bin"), labels).alias("volume_tier"),
            half_even(F.col("mean"), 3).alias("avg_rating"),
            half_even(F.col("spread"), 3).alias("rating_volatility_stddev"),
            "business_count",
        )
    )


# -- M4: review behaviour per category -----------------------------------------------


def review_behavior(
    businesses: DataFrame,
    reviews: DataFrame,
    state: str | None = "PA",
    min_reviews: int = 500,
    k: int = 20,
    record_cap: int | None = None,
) -> DataFrame:
    """Length, usefulness and star shares of the most reviewed categories of a state."""
    local = businesses if state is None else businesses.filter(F.col("state") == state)
    if state is not None or record_cap is not None:
        reviews = reviews.join(local.select("business_id"), "business_id", "left_semi")
    if record_cap is not None:
        reviews = sample_rows(reviews, ["review_id"], record_cap)
    per_business = reviews.groupBy("business_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("useful").alias("useful"),
        F.sum(review_length(reviews)).alias("length"),
        *[count_where(F.col("stars") == s).alias(f"stars_{s}") for s in STARS],
    )
    sums = (
        per_business.join(local.select("business_id", "categories"), "business_id")
        .withColumn("category", F.explode("categories"))
        .groupBy("category")
        .agg(
            F.sum("n").alias("total_reviews"),
            total(F.col("useful")).alias("useful"),
            total(F.col("length")).alias("length"),
            *[F.sum(f"stars_{s}").alias(f"stars_{s}") for s in STARS],
        )
        .filter(F.col("total_reviews") >= min_reviews)
    )
    rows = F.col("total_reviews")
    shares = F.struct(
        *[half_even(ratio(F.col(f"stars_{s}"), rows) * 100, 1).alias(f"{s}_star") for s in STARS]
    )
    shaped = sums.select(
        "category",
        half_even(ratio(F.col("length"), rows), 1).alias("avg_review_length"),
        half_even(ratio(F.col("useful"), rows), 3).alias("useful_ratio"),
        shares.alias("star_distribution_pct"),
        "total_reviews",
    )
    return top_k(shaped, "total_reviews", ["category"], k)


# -- M5: tenure ----------------------------------------------------------------------


def tenure_behavior(
    users: DataFrame,
    reference_year: int = 2022,
    edges: Sequence[int] = TENURE_EDGES,
    labels: Sequence[str] = TENURE_LABELS,
) -> DataFrame:
    """Rating given and usefulness by years since joining.

    Usefulness is the mean of each user's own votes per review.
    """
    tenure = F.lit(reference_year) - F.year("yelping_since")
    return (
        users.filter(F.col("review_count") > 0)
        .groupBy(step_bin(tenure, edges).alias("bin"))
        .agg(
            F.avg("average_stars").alias("rating"),
            F.avg(ratio(F.col("useful"), F.col("review_count"))).alias("usefulness"),
            F.count(F.lit(1)).alias("user_count"),
        )
        .select(
            bin_label(F.col("bin"), labels).alias("tenure_tier"),
            half_even(F.col("rating"), 3).alias("avg_rating_given"),
            half_even(F.col("usefulness"), 3).alias("avg_usefulness_score"),
            "user_count",
        )
        .orderBy(F.desc_nulls_last("avg_usefulness_score"), "tenure_tier")
    )


# -- Sums per user, shared by M6 and P1 ----------------------------------------------


def _user_sums(reviews: DataFrame) -> DataFrame:
    stars, length = F.col("stars"), review_length(reviews)
    return reviews.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("stars").alias("n_stars"),
        F.sum("stars").alias("stars"),
        F.sum(stars * stars).alias("squares"),
        F.count("useful").alias("n_useful"),
        F.sum("useful").alias("useful"),
        F.count(length).alias("n_length"),
        F.sum(length).alias("length"),
        *[count_where(stars == s).alias(f"stars_{s}") for s in STARS],
    )


def _mean(name: str) -> Column:
    return ratio(F.sum(name), F.sum(f"n_{name}"))


# -- M6: elite users against the rest ------------------------------------------------


def elite_vs_regular(users: DataFrame, reviews: DataFrame, sample: int | None = None) -> DataFrame:
    """Rating, length and usefulness of reviews by the author's elite flag."""
    sums = _user_sums(sample_rows(reviews, ["review_id"], sample))
    return (
        sums.join(users.select("user_id", "is_elite_ever"), "user_id")
        .groupBy("is_elite_ever")
        .agg(
            half_even(_mean("stars"), 3).alias("mean_star_rating"),
            half_even(_mean("length"), 1).alias("mean_review_length"),
            half_even(_mean("useful"), 3).alias("mean_useful_per_review"),
            F.sum("n").alias("sample_size"),
        )
        .select(
            F.when(F.col("is_elite_ever"), F.lit(ELITE)).otherwise(F.lit(NOT_ELITE)).alias("user_status"),
            "mean_star_rating",
            "mean_review_length",
            "mean_useful_per_review",
            "sample_size",
        )
        .orderBy("user_status")
    )


# -- M7: check-ins -------------------------------------------------------------------


def checkin_vs_rating(
    businesses: DataFrame,
    edges: Sequence[int] = VISIT_EDGES,
    labels: Sequence[str] = VISIT_LABELS,
) -> DataFrame:
    """Mean stars per visit tier of businesses with check-ins, best tier first."""
    return (
        businesses.filter(F.col("checkin_count") > 0)
        .groupBy(step_bin(F.col("checkin_count"), edges).alias("bin"))
        .agg(F.avg("stars").alias("mean"), F.count(F.lit(1)).alias("business_count"))
        .select(
            bin_label(F.col("bin"), labels).alias("visit_tier"),
            half_even(F.col("mean"), 3).alias("avg_rating"),
            "business_count",
        )
        .orderBy(F.desc_nulls_last("avg_rating"), "visit_tier")
    )


def checkin_gap_by_category(
    businesses: DataFrame, high: int = 100, low: int = 20, min_businesses: int = 200, k: int = 10
) -> DataFrame:
    """Categories in which much visited businesses are rated better than little visited ones."""
    visits = F.col("checkin_count")
    gaps = (
        businesses.filter(visits > 0)
        .withColumn("category", F.explode("categories"))
        .groupBy("category")
        .agg(
            average_where(F.col("stars"), visits >= high).alias("high"),
            average_where(F.col("stars"), visits < low).alias("low"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter(F.col("n") >= min_businesses)
        .select(
            "category",
            half_even(F.col("high"), 3).alias("high_visit_avg"),
            half_even(F.col("low"), 3).alias("low_visit_avg"),
            (F.col("high") - F.col("low")).alias("rating_gap"),
        )
    )
    return top_k(gaps, "rating_gap", ["category"], k)


# -- P1: cohorts ---------------------------------------------------------------------


def cohort_analysis(users: DataFrame, reviews: DataFrame, sample: int | None = None) -> DataFrame:
    """Review statistics by the year in which the author joined."""
    sums = _user_sums(sample_rows(reviews, ["review_id"], sample))
    n = F.sum("n_stars")
    mean = _mean("stars")
    variance = ratio(F.sum("squares"), n) - mean * mean
    return (
        sums.join(users.select("user_id", "yelping_since"), "user_id")
        .groupBy(F.year("yelping_since").alias("cohort_year"))
        .agg(
            half_even(mean, 3).alias("mean_stars"),
            half_even(F.sqrt(F.greatest(variance, F.lit(0.0))), 3).alias("std_stars"),
            half_even(_mean("length"), 1).alias("mean_length"),
            half_even(_mean("useful"), 3).alias("mean_useful"),
            *[
                half_even(ratio(F.sum(f"stars_{s}"), F.sum("n")), 3).alias(f"pct_{s}_star")
                for s in STARS
            ],
        )
        .orderBy("cohort_year")
    )


def best_cohorts(cohorts: DataFrame) -> DataFrame:
    """The cohort with the highest mean stars and the one with the most useful votes.

    Compares the reported (rounded) means; the earliest year wins a tie.
    """

    def leader(measure: str) -> Column:
        ranked = F.struct((-F.col(measure)).alias("m"), "cohort_year")
        return F.min(F.when(F.col(measure).isNotNull(), ranked))["cohort_year"]

    return cohorts.agg(
        leader("mean_stars").alias("highest_stars_cohort"),
        leader("mean_useful").alias("highest_useful_cohort"),
    )


# -- P2: month-over-month consistency ------------------------------------------------


def mom_consistency(
    businesses: DataFrame,
    reviews: DataFrame,
    min_months: int = 24,
    min_reviews: int = 0,
    null_as_down: bool = True,
    sample: int | None = None,
) -> DataFrame:
    """Share of months in which a category's mean rating rose, and in which it fell.

    A month is compared with the previous observed one.  The first month has no
    predecessor; it counts as a month and, by default, as a fall.
    """
    monthly = (
        sample_rows(reviews, ["review_id"], sample)
        .groupBy("business_id", F.year("date").alias("year"), F.month("date").alias("month"))
        .agg(
            F.sum("stars").alias("stars"),
            F.count("stars").alias("n_stars"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    means = (
        monthly.join(businesses.select("business_id", "categories"), "business_id")
        .withColumn("category", F.explode("categories"))
        .groupBy("category", "year", "month")
        .agg(_mean("stars").alias("mean"), F.sum("n").alias("n"))
    )
    # One row per category and month: a partition is as long as the calendar.
    months = Window.partitionBy("category").orderBy("year", "month")
    deltas = means.withColumn("delta", F.col("mean") - F.lag("mean").over(months))
    counted = (
        deltas.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("months"),
            F.sum("n").alias("reviews"),
            count_where(F.col("delta") > 0).alias("ups"),
            count_where(is_fall(F.col("delta"), null_as_down)).alias("downs"),
        )
        .filter((F.col("months") >= min_months) & (F.col("reviews") >= min_reviews))
    )
    return counted.select(
        "category",
        ratio(F.col("ups"), F.col("months")).alias("upward_consistency"),
        ratio(F.col("downs"), F.col("months")).alias("downward_consistency"),
    )


def most_consistent(consistency: DataFrame, k: int = 3) -> DataFrame:
    """The k categories rising most steadily and the k falling most steadily."""
    up = top_k(consistency, "upward_consistency", ["category"], k)
    down = top_k(consistency, "downward_consistency", ["category"], k)
    return up.withColumn("side", F.lit("upward")).unionByName(
        down.withColumn("side", F.lit("downward"))
    )


# -- P3: check-in tiers against categories -------------------------------------------


def checkin_crosstab(businesses: DataFrame, n_categories: int = 10) -> DataFrame:
    """Stars, reviews and tips per review for the largest categories by check-in tier.

    Tiers come from the quartiles of businesses with check-ins and apply to all
    businesses, so those without check-ins fall into the lowest.
    """
    lower, upper = exact_percentiles(
        businesses.filter(F.col("checkin_count") > 0), "checkin_count", [0.25, 0.75]
    )
    visits = F.col("checkin_count")
    # A missing count sorts below every number, hence into the lowest tier.
    tier = (
        F.when(visits.isNull() | (visits <= lower), LOW).when(visits >= upper, HIGH).otherwise(MEDIUM)
    )
    each = businesses.select(
        F.explode("categories").alias("Category"), "stars", "review_count", "tip_count", tier.alias("Checkin_Tier")
    )
    sums = each.groupBy("Category").agg(F.sum("review_count").alias("n"))
    # Exactly `n_categories` rows.
    largest = F.broadcast(top_k(sums, "n", ["Category"], n_categories).select("Category"))
    reviews = total(F.col("review_count"))
    tips = F.when(reviews == 0, F.lit(0.0)).otherwise(ratio(total(F.col("tip_count")), reviews))
    return (
        each.join(largest, "Category", "left_semi")
        .groupBy("Category", "Checkin_Tier")
        .agg(
            half_even(F.avg("stars"), 2).alias("Mean_Stars"),
            half_even(F.avg("review_count"), 0).alias("Mean_Review_Count"),
            half_even(tips, 3).alias("Tip_to_Review_Ratio"),
        )
        .orderBy("Category", "Checkin_Tier")
    )


def crosstab_pivot(crosstab: DataFrame) -> DataFrame:
    """One row per category with every measure under every tier."""
    return (
        crosstab.withColumn(
            "tier", F.element_at(F.split("Checkin_Tier", " "), 1)
        )
        .groupBy("Category")
        .pivot("tier", ["High", "Low", "Medium"])
        .agg(
            F.first("Mean_Stars").alias("Mean_Stars"),
            F.first("Mean_Review_Count").alias("Mean_Review_Count"),
            F.first("Tip_to_Review_Ratio").alias("Tip_to_Review_Ratio"),
        )
        .orderBy("Category")
    )
