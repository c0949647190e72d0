"""Raw records to typed tables, and the repairs applied to tables already loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plaudit.functions.texts import code_points, empty_list, split_list, split_or_empty
from plaudit.functions.times import parse_day, parse_stamp, weekday_name
from plaudit.operators.topk import top_per_group

TOPS = ("top_days", "top_hours", "top_day_hours")


def checkin_tokens(raw: DataFrame) -> DataFrame:
    """One row per listed check-in: `business_id`, `ord` (place in the list), `token`."""
    listed = raw.filter(F.col("date") != "").select(
        "business_id", F.posexplode(split_list(F.col("date"), ", ")).alias("ord", "token")
    )
    return listed.withColumn("ord", F.col("ord").cast("long"))


def checkin_stats(tokens: DataFrame) -> DataFrame:
    """Check-in count and the three busiest weekdays, hours and weekday-hours per business.

    Tokens that are no timestamps count as check-ins but not for the busiest
    times.  Equal counts keep the order of first appearance.  The tokens are
    reduced to one row per business, weekday and hour before anything else.
    """
    slots = (
        tokens.select(
            "business_id",
            "ord",
            weekday_name(parse_day(F.col("token"))).alias("day"),
            F.substring("token", 12, 2).alias("hour"),
        )
        .groupBy("business_id", "day", "hour")
        .agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first"))
    )
    counts = slots.groupBy("business_id").agg(F.sum("n").alias("checkin_count"))
    labels = F.array(
        F.struct(F.lit(TOPS[0]).alias("kind"), F.col("day").alias("label")),
        F.struct(F.lit(TOPS[1]).alias("kind"), F.col("hour").alias("label")),
        F.struct(
            F.lit(TOPS[2]).alias("kind"),
            F.concat("day", F.lit("_"), "hour", F.lit(":00")).alias("label"),
        ),
    )
    ranked = (
        slots.filter(F.col("day").isNotNull())
        .select("business_id", "n", "first", F.inline(labels))
        .groupBy("business_id", "kind", "label")
        .agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    )
    leaders = top_per_group(ranked, ["business_id", "kind"], "n", ["first", "label"], 3)
    # Three rows per business and kind: the lists are bounded.
    lists = leaders.groupBy("business_id").agg(
        *[
            F.transform(
                F.array_sort(
                    F.collect_list(F.when(F.col("kind") == kind, F.struct("place", "label")))
                ),
                lambda item: item["label"],
            ).alias(kind)
            for kind in TOPS
        ]
    )
    return counts.join(lists, "business_id", "left").select(
        "business_id",
        "checkin_count",
        *[F.coalesce(kind, empty_list()).alias(kind) for kind in TOPS],
    )


def checkin_summary(raw: DataFrame) -> DataFrame:
    """`checkin_stats` of raw rows; a business with an empty list gets zero and empty lists."""
    blank = raw.filter(F.col("date").isNull() | (F.col("date") == "")).select(
        "business_id",
        F.lit(0).cast("long").alias("checkin_count"),
        *[empty_list().alias(kind) for kind in TOPS],
    )
    return checkin_stats(checkin_tokens(raw)).unionByName(blank)


def clean_businesses(raw: DataFrame, stats: DataFrame) -> DataFrame:
    """Categories as a list, check-in statistics attached, missing counts zero."""
    if dict(raw.dtypes)["categories"] == "string":
        raw = raw.withColumn("categories", split_list(F.col("categories"), ", "))
    return raw.join(stats, "business_id", "left").withColumn(
        "checkin_count", F.coalesce("checkin_count", F.lit(0).cast("long"))
    )


def clean_users(raw: DataFrame) -> DataFrame:
    """Elite years and friends as lists, join date parsed, elite flags derived."""
    return (
        raw.withColumn("elite_years", split_or_empty(F.col("elite"), ","))
        .withColumn("friends", split_or_empty(F.col("friends"), ", ", ("None", "")))
        .withColumn("yelping_since", parse_stamp(F.col("yelping_since")))
        .withColumn("elite_year_count", F.size("elite_years"))
        .withColumn("is_elite_ever", F.col("elite_year_count") > 0)
        .drop("elite")
    )


def clean_reviews(raw: DataFrame) -> DataFrame:
    """Date parsed; the text's length is stored so that analytics need not read the text."""
    return raw.withColumn("date", parse_stamp(F.col("date"))).withColumn(
        "text_length", code_points(F.col("text"))
    )


def clean_tips(raw: DataFrame) -> DataFrame:
    return raw.withColumn("date", parse_stamp(F.col("date")))


def repair_elite(users: DataFrame) -> DataFrame:
    """Users whose elite list is empty or holds one empty string are not elite.

    `elite_years` may be a list or, in older loads, a string.
    """
    years = F.col("elite_years")
    if dict(users.dtypes)["elite_years"] == "string":
        blank = years == ""
        kept = split_list(years, ",")
    else:
        blank = (F.size(years) == 0) | ((F.size(years) == 1) & (F.element_at(years, 1) == ""))
        kept = years
    blank = F.coalesce(blank, F.lit(False))
    return (
        users.withColumn("__blank", blank)
        .withColumn("elite_years", F.when(F.col("__blank"), empty_list()).otherwise(kept))
        .withColumn(
            "is_elite_ever", F.when(F.col("__blank"), F.lit(False)).otherwise(F.col("is_elite_ever"))
        )
        .withColumn(
            "elite_year_count", F.when(F.col("__blank"), F.lit(0)).otherwise(F.col("elite_year_count"))
        )
        .drop("__blank")
    )


def repair_friends(users: DataFrame) -> DataFrame:
    """Friends still stored as a string become a list; lists pass unchanged."""
    if dict(users.dtypes)["friends"] != "string":
        return users
    text = F.col("friends")
    return users.withColumn(
        "friends",
        F.when(text.isin("None", ""), empty_list()).otherwise(split_list(text, ", ")),
    )


def add_tip_counts(businesses: DataFrame, tips: DataFrame) -> DataFrame:
    """Number of tips per business, zero where there is none."""
    counts = tips.groupBy("business_id").agg(F.count(F.lit(1)).alias("tip_count"))
    return (
        businesses.drop("tip_count")
        .join(counts, "business_id", "left")
        .withColumn("tip_count", F.coalesce("tip_count", F.lit(0).cast("long")))
    )
