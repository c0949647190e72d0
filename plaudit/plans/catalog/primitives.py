"""One query per relational building block, on the entities of the test tables."""

from pyspark.sql import Window, functions as F

from plaudit.functions.numbers import (
    average_where,
    count_where,
    half_even,
    half_up,
    ratio,
    right_closed_bin,
    step_bin,
)
from plaudit.functions.texts import code_points, split_list, trimmed_items
from plaudit.functions.times import days_between, epoch_seconds, parse_day, parse_stamp, weekday_name
from plaudit.operators.centrality import friend_degree
from plaudit.operators.graph import project
from plaudit.operators.ranking import percentiles, spearman
from plaudit.operators.sampling import sample_rows
from plaudit.operators.skew import HotKeys, hot_key_join
from plaudit.operators.topk import both_ends, most_frequent, top_k, top_per_group
from plaudit.plans import network
from plaudit.plans.catalog.base import half_up_sql, query
from plaudit.plans.catalog.graphs import SIMILAR
from plaudit.plans.catalog.reports import ends_sql


def stamp(text):
    return F.lit(text).cast("timestamp_ntz")


# -- projections, filters, predicates ------------------------------------------------


@query("filter_equality", "SELECT business_id, stars FROM businesses WHERE city = 'NATION_3'")
def _(w):
    return w.businesses.filter(F.col("city") == "NATION_3").select("business_id", "stars")


@query(
    "filter_date_range",
    """SELECT review_id, date FROM reviews
       WHERE date BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-06-30'""",
)
def _(w):
    between = F.col("date").between(stamp("1997-01-01"), stamp("1997-06-30"))
    return w.reviews.filter(between).select("review_id", "date")


@query(
    "filter_comparisons",
    """SELECT business_id, review_count, stars FROM businesses
       WHERE review_count > 25 AND review_count <= 40 AND stars >= 2.0 AND stars < 4.5""",
)
def _(w):
    n, s = F.col("review_count"), F.col("stars")
    return w.businesses.filter((n > 25) & (n <= 40) & (s >= 2.0) & (s < 4.5)).select(
        "business_id", "review_count", "stars"
    )


@query(
    "filter_after_aggregation",
    """SELECT user_id, count(*) AS n, CAST(sum(useful) AS BIGINT) AS useful FROM reviews
       GROUP BY 1 HAVING count(*) >= 45 AND sum(useful) > 200""",
)
def _(w):
    per_user = w.reviews.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("useful").alias("useful")
    )
    return per_user.filter((F.col("n") >= 45) & (F.col("useful") > 200))


@query(
    "filter_in_list",
    """SELECT business_id, category FROM business_category
       WHERE category IN ('ECONOMY', 'PROMO', 'red') AND state NOT IN ('ASIA')""",
)
def _(w):
    each = w.businesses.select("business_id", "state", F.explode("categories").alias("category"))
    kept = F.col("category").isin("ECONOMY", "PROMO", "red") & ~F.col("state").isin("ASIA")
    return each.filter(kept).select("business_id", "category")


@query(
    "filter_in_subquery",
    """SELECT business_id, category FROM business_category
       WHERE category IN (SELECT category FROM business_category GROUP BY 1
                          ORDER BY sum(review_count) DESC, category LIMIT 3)""",
)
def _(w):
    each = w.businesses.select("business_id", "review_count", F.explode("categories").alias("category"))
    sums = each.groupBy("category").agg(F.sum("review_count").alias("n"))
    largest = F.broadcast(top_k(sums, "n", ["category"], 3))
    return each.join(largest, "category", "left_semi").select("business_id", "category")


@query(
    "filter_or_not_null",
    """SELECT user_id, review_count, average_stars FROM users
       WHERE average_stars IS NOT NULL AND (review_count > 50 OR len(elite_years) = 0 OR friends = [])""",
)
def _(w):
    either = (F.col("review_count") > 50) | (F.size("elite_years") == 0) | (F.size("friends") == 0)
    return w.users.filter(F.col("average_stars").isNotNull() & either).select(
        "user_id", "review_count", "average_stars"
    )


@query(
    "filter_field_exists",
    "SELECT 'tips' AS name, 'compliment_count' AS field, false AS is_present, count(*) AS n_rows FROM tips",
)
def _(w):
    return w.tips.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("tips").alias("name"),
        F.lit("compliment_count").alias("field"),
        F.lit("compliment_count" in w.tips.columns).alias("is_present"),
        "n_rows",
    )


@query(
    "filter_negated_pattern",
    """SELECT DISTINCT user_id, business_id FROM tips t
       WHERE user_id IN (SELECT user_id FROM users)
         AND NOT EXISTS (SELECT 1 FROM reviews r
                         WHERE r.user_id = t.user_id AND r.business_id = t.business_id)""",
)
def _(w):
    tipped = w.graph.tip_left.select("user_id", "business_id")
    return tipped.join(w.graph.reviewed, ["user_id", "business_id"], "left_anti")


@query(
    "project_rename_compute",
    """SELECT business_id AS _id, upper(name) AS label, stars * review_count AS weight,
              review_count - tip_count AS difference FROM businesses""",
)
def _(w):
    return w.businesses.drop("top_days", "top_hours").select(
        F.col("business_id").alias("_id"),
        F.upper("name").alias("label"),
        (F.col("stars") * F.col("review_count")).alias("weight"),
        (F.col("review_count") - F.col("tip_count")).alias("difference"),
    )


@query(
    "project_nested",
    """SELECT business_id, city AS place_city, state AS place_state, stars AS rating_stars,
              review_count AS rating_n FROM businesses""",
)
def _(w):
    nested = w.businesses.select(
        "business_id",
        F.struct("city", "state").alias("place"),
        F.struct("stars", F.col("review_count").alias("n")).alias("rating"),
    )
    return nested.select(
        "business_id",
        F.col("place.city").alias("place_city"),
        F.col("place.state").alias("place_state"),
        F.col("rating.stars").alias("rating_stars"),
        F.col("rating.n").alias("rating_n"),
    )


@query(
    "project_replace_root",
    """SELECT r.review_id, r.stars, r.useful, b.city
       FROM reviews r JOIN businesses b ON b.business_id = r.business_id WHERE b.state = 'ASIA'""",
)
def _(w):
    local = w.businesses.filter(F.col("state") == "ASIA").select("business_id", "city")
    whole = w.reviews.select("business_id", F.struct("review_id", "stars", "useful").alias("r"))
    return whole.join(local, "business_id").select("r.*", "city")


@query("unnest_list", "SELECT user_id, unnest(friends) AS friend_id FROM users")
def _(w):
    return w.users.select("user_id", F.explode("friends").alias("friend_id"))


@query(
    "unnest_parameter",
    """SELECT r.user_id, count(*) AS n FROM reviews r
       JOIN (SELECT unnest(['u1', 'u2', 'u3', 'u5', 'u8', 'nobody']) AS user_id) p ON p.user_id = r.user_id
       GROUP BY 1""",
)
def _(w):
    ids = [(i,) for i in ("u1", "u2", "u3", "u5", "u8", "nobody")]
    wanted = F.broadcast(w.spark.createDataFrame(ids, "user_id string"))
    return w.reviews.join(wanted, "user_id").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "drop_and_fill_nulls",
    """SELECT b.business_id, coalesce(t.n, 0) AS checkins, coalesce(b.city, '?') AS city
       FROM businesses b LEFT JOIN (SELECT business_id, count(*) AS n FROM checkin_tokens GROUP BY 1) t
            ON t.business_id = b.business_id WHERE b.name IS NOT NULL""",
)
def _(w):
    counts = w.checkin_tokens.groupBy("business_id").agg(F.count(F.lit(1)).alias("checkins"))
    joined = w.businesses.select("business_id", "name", "city").join(counts, "business_id", "left")
    filled = joined.na.drop(subset=["name"]).na.fill(0, ["checkins"]).na.fill("?", ["city"])
    return filled.select("business_id", "checkins", "city")


# -- joins ---------------------------------------------------------------------------


@query(
    "join_inner",
    """SELECT r.review_id, b.city, u.is_elite_ever FROM reviews r
       JOIN businesses b ON b.business_id = r.business_id JOIN users u ON u.user_id = r.user_id""",
)
def _(w):
    by_shop, by_user = HotKeys.find(w.reviews, "business_id"), HotKeys.find(w.reviews, "user_id")
    placed = by_shop.join(w.reviews, w.businesses.select("business_id", "city"), ["review_id"])
    written = by_user.join(placed, w.users.select("user_id", "is_elite_ever"), ["review_id"])
    return written.select("review_id", "city", "is_elite_ever")


@query(
    "join_left",
    """SELECT b.business_id, t.n AS tips FROM businesses b
       LEFT JOIN (SELECT business_id, count(*) AS n FROM tips GROUP BY 1) t
              ON t.business_id = b.business_id""",
)
def _(w):
    tips = w.tips.groupBy("business_id").agg(F.count(F.lit(1)).alias("tips"))
    return w.businesses.select("business_id").join(tips, "business_id", "left")


@query(
    "join_multi_hop",
    """SELECT u.user_id, p.state, count(*) AS n FROM users u JOIN reviews r ON r.user_id = u.user_id
       JOIN businesses b ON b.business_id = r.business_id JOIN part_of p ON p.city = b.city
       GROUP BY 1, 2""",
)
def _(w):
    states = w.graph.located_in.join(w.graph.part_of, "city").select("business_id", "state")
    paths = hot_key_join(w.graph.reviewed, states, "business_id", ["review_id"])
    return paths.groupBy("user_id", "state").agg(F.count(F.lit(1)).alias("n"))


@query(
    "join_optional_match",
    """SELECT u.user_id, count(t.business_id) AS tips, count(*) AS n_rows
       FROM users u LEFT JOIN (SELECT DISTINCT user_id, business_id FROM tips
                               WHERE business_id IN (SELECT business_id FROM businesses)) t
            ON t.user_id = u.user_id GROUP BY 1""",
)
def _(w):
    per_user = w.graph.tip_left.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return w.graph.user.join(per_user, "user_id", "left").select(
        "user_id",
        F.coalesce("n", F.lit(0).cast("long")).alias("tips"),
        F.coalesce("n", F.lit(1).cast("long")).alias("n_rows"),
    )


@query(
    "join_existing_ends",
    """SELECT user_id, business_id, count(*) AS n FROM tips
       WHERE user_id IN (SELECT user_id FROM users)
         AND business_id IN (SELECT business_id FROM businesses) GROUP BY 1, 2""",
)
def _(w):
    known = w.tips.join(w.users, "user_id", "left_semi").join(w.businesses, "business_id", "left_semi")
    return known.groupBy("user_id", "business_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "join_shared_neighbours",
    "WITH " + SIMILAR.format(group="b.city", where="") + """
    SELECT DISTINCT x.item, x.other, x.shared, c.category FROM nearest x
    JOIN in_category c ON c.business_id = x.item
    JOIN in_category d ON d.business_id = x.other AND d.category = c.category
    WHERE x.place <= 50 AND x.shared >= 3""",
)
def _(w):
    cities = w.graph.city.select(F.col("name").alias("city"))
    pairs = network.similar_businesses(w.graph, cities, 50, 3).select("item", "other", "shared")
    mine = w.graph.in_category.withColumnRenamed("business_id", "item")
    theirs = w.graph.in_category.withColumnRenamed("business_id", "other")
    return pairs.join(mine, "item").join(theirs, ["other", "category"])


@query(
    "join_candidates_minus_existing",
    """SELECT u.user_id, b.business_id FROM businesses b
       CROSS JOIN (SELECT user_id FROM users WHERE review_count > 30 ORDER BY user_id LIMIT 5) u
       WHERE b.review_count > 35
         AND NOT EXISTS (SELECT 1 FROM reviews r
                         WHERE r.user_id = u.user_id AND r.business_id = b.business_id)""",
)
def _(w):
    few = w.graph.user.filter("review_count > 30").orderBy("user_id").limit(5).select("user_id").collect()
    people = F.array(*[F.lit(row["user_id"]) for row in few])
    pairs = w.graph.business.filter("review_count > 35").select(
        "business_id", F.explode(people).alias("user_id")
    )
    return pairs.join(w.graph.reviewed, ["user_id", "business_id"], "left_anti")


@query(
    "join_list_per_row",
    """SELECT b.business_id, b.name, c.labels FROM businesses b
       LEFT JOIN (SELECT business_id, string_agg(category, '|' ORDER BY category) AS labels
                  FROM in_category GROUP BY 1) c ON c.business_id = b.business_id""",
)
def _(w):
    lists = w.graph.in_category.groupBy("business_id").agg(
        F.array_join(F.array_sort(F.collect_list("category")), "|").alias("labels")
    )
    return w.graph.business.select("business_id", "name").join(lists, "business_id", "left")


# -- aggregations --------------------------------------------------------------------


@query(
    "aggregate_basic",
    """SELECT city, count(*) AS n, CAST(sum(review_count) AS BIGINT) AS reviews, avg(stars) AS stars,
              min(review_count) AS low, max(review_count) AS high FROM businesses GROUP BY 1""",
)
def _(w):
    return w.businesses.groupBy("city").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("review_count").alias("reviews"),
        F.avg("stars").alias("stars"),
        F.min("review_count").alias("low"),
        F.max("review_count").alias("high"),
    )


@query(
    "aggregate_stddev_pop",
    "SELECT state, round(stddev_pop(stars), 9) AS spread FROM businesses GROUP BY 1",
)
def _(w):
    return w.businesses.groupBy("state").agg(half_up(F.stddev_pop("stars"), 9).alias("spread"))


@query(
    "aggregate_rating_histogram",
    "SELECT business_id, "
    + ", ".join(f"count(*) FILTER (WHERE stars = {s}) AS stars_{s}" for s in range(1, 6))
    + " FROM reviews GROUP BY 1",
)
def _(w):
    return w.reviews.groupBy("business_id").agg(
        *[count_where(F.col("stars") == s).alias(f"stars_{s}") for s in range(1, 6)]
    )


@query(
    "aggregate_conditional_average",
    """SELECT user_id, avg(CASE WHEN useful >= 5 THEN stars END) AS useful_mean,
              avg(CASE WHEN useful < 1 THEN stars END) AS useless_mean FROM reviews GROUP BY 1""",
)
def _(w):
    return w.reviews.groupBy("user_id").agg(
        average_where(F.col("stars"), F.col("useful") >= 5).alias("useful_mean"),
        average_where(F.col("stars"), F.col("useful") < 1).alias("useless_mean"),
    )


_yearly = """SELECT business_id, CAST(year(date) AS INTEGER) AS year, avg(stars) AS mean
             FROM reviews GROUP BY 1, 2"""


@query(
    "aggregate_first_last",
    f"""SELECT business_id, min_by(mean, year) AS first_mean, max_by(mean, year) AS last_mean,
               count(*) AS years FROM ({_yearly}) GROUP BY 1""",
)
def _(w):
    yearly = w.reviews.groupBy("business_id", F.year("date").alias("year")).agg(
        F.avg("stars").alias("mean")
    )
    return yearly.groupBy("business_id").agg(
        F.min_by("mean", "year").alias("first_mean"),
        F.max_by("mean", "year").alias("last_mean"),
        F.count(F.lit(1)).alias("years"),
    )


@query("aggregate_ordered_structs", f"SELECT * FROM ({_yearly})")
def _(w):
    yearly = w.reviews.groupBy("business_id", F.year("date").alias("year")).agg(
        F.avg("stars").alias("mean")
    )
    lists = yearly.groupBy("business_id").agg(
        F.array_sort(F.collect_list(F.struct("year", "mean"))).alias("timeline")
    )
    return lists.select("business_id", F.inline("timeline"))


@query(
    "aggregate_count_distinct",
    """SELECT b.city, count(DISTINCT r.user_id) AS users, count(DISTINCT r.business_id) AS businesses
       FROM reviews r JOIN businesses b ON b.business_id = r.business_id GROUP BY 1""",
)
def _(w):
    placed = hot_key_join(
        w.reviews, w.businesses.select("business_id", "city"), "business_id", ["review_id"]
    )
    return placed.groupBy("city").agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("business_id").alias("businesses")
    )


@query(
    "aggregate_collect_list",
    """SELECT user_id, string_agg(city || ':' || n, ',' ORDER BY city) AS cities
       FROM (SELECT r.user_id, b.city, count(*) AS n FROM reviews r
             JOIN businesses b ON b.business_id = r.business_id GROUP BY 1, 2) GROUP BY 1""",
)
def _(w):
    placed = hot_key_join(
        w.reviews, w.businesses.select("business_id", "city"), "business_id", ["review_id"]
    )
    per_city = placed.groupBy("user_id", "city").agg(F.count(F.lit(1)).alias("n"))
    # One entry per city.
    listed = per_city.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("city", "n"))).alias("cities")
    )
    shown = F.transform("cities", lambda c: F.concat(c["city"], F.lit(":"), c["n"].cast("string")))
    return listed.select("user_id", F.array_join(shown, ",").alias("cities"))


@query(
    "aggregate_composite_keys",
    """SELECT business_id, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
              count(*) AS n, avg(stars) AS mean FROM reviews GROUP BY 1, 2, 3""",
)
def _(w):
    return w.reviews.groupBy(
        "business_id", F.year("date").alias("year"), F.month("date").alias("month")
    ).agg(F.count(F.lit(1)).alias("n"), F.avg("stars").alias("mean"))


@query(
    "aggregate_two_levels",
    """SELECT n_cities, count(*) AS users FROM (
         SELECT r.user_id, count(DISTINCT b.city) AS n_cities FROM reviews r
         JOIN businesses b ON b.business_id = r.business_id GROUP BY 1) GROUP BY 1""",
)
def _(w):
    placed = hot_key_join(
        w.reviews, w.businesses.select("business_id", "city"), "business_id", ["review_id"]
    )
    per_user = placed.groupBy("user_id").agg(F.count_distinct("city").alias("n_cities"))
    return per_user.groupBy("n_cities").agg(F.count(F.lit(1)).alias("users"))


@query(
    "aggregate_bins_with_default",
    """SELECT CASE WHEN review_count >= 20 AND review_count < 30 THEN 0
                   WHEN review_count >= 30 AND review_count < 40 THEN 1 ELSE 2 END AS bin,
              count(*) AS n, CAST(sum(tip_count) AS BIGINT) AS tips FROM businesses GROUP BY 1""",
)
def _(w):
    return w.businesses.groupBy(step_bin(F.col("review_count"), (20, 30, 40)).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("tip_count").alias("tips")
    )


@query(
    "aggregate_exact_percentiles",
    """SELECT quantile_cont(review_count, 0.25) AS p25, quantile_cont(review_count, 0.5) AS p50,
              quantile_cont(review_count, 0.9) AS p90 FROM businesses""",
)
def _(w):
    return percentiles(w.businesses, "review_count", {"p25": 0.25, "p50": 0.5, "p90": 0.9})


@query(
    "aggregate_mode",
    """SELECT city, stars, n AS n_item, n_total FROM (
         SELECT city, stars, n, CAST(sum(n) OVER (PARTITION BY city) AS BIGINT) AS n_total,
                row_number() OVER (PARTITION BY city ORDER BY n DESC, stars) AS rn
         FROM (SELECT city, stars, count(*) AS n FROM businesses GROUP BY 1, 2)) WHERE rn = 1""",
)
def _(w):
    return most_frequent(w.businesses, ["city"], "stars")


@query(
    "aggregate_pivot",
    """SELECT state, count(*) FILTER (WHERE stars = 1.0) AS one, count(*) FILTER (WHERE stars = 3.0) AS three,
              count(*) FILTER (WHERE stars = 5.0) AS five FROM businesses GROUP BY 1""",
)
def _(w):
    wide = w.businesses.groupBy("state").pivot("stars", [1.0, 3.0, 5.0]).agg(F.count(F.lit(1)))
    return wide.toDF("state", "one", "three", "five").na.fill(0)


@query(
    "aggregate_global",
    """SELECT count(*) AS n, count(DISTINCT user_id) AS users, avg(stars) AS stars,
              CAST(sum(useful) AS BIGINT) AS useful FROM reviews""",
)
def _(w):
    return w.reviews.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("user_id").alias("users"),
        F.avg("stars").alias("stars"),
        F.sum("useful").alias("useful"),
    )


@query(
    "aggregate_ratio_of_sums",
    """SELECT city, CASE WHEN sum(review_count) = 0 THEN NULL
                    ELSE sum(tip_count) / sum(review_count) END AS tips_per_review,
              round_even(CAST(count(*) FILTER (WHERE stars >= 4) AS DOUBLE) / count(*) * 100, 1) AS pct_good
       FROM businesses GROUP BY 1""",
)
def _(w):
    good = ratio(count_where(F.col("stars") >= 4), F.count(F.lit(1))) * 100
    return w.businesses.groupBy("city").agg(
        ratio(F.sum("tip_count"), F.sum("review_count")).alias("tips_per_review"),
        half_even(good, 1).alias("pct_good"),
    )


@query(
    "aggregate_spearman",
    """SELECT round(corr(a, b), 9) AS spearman FROM (
         SELECT rank() OVER (ORDER BY stars) + (count(*) OVER (PARTITION BY stars) - 1) / 2 AS a,
                rank() OVER (ORDER BY useful) + (count(*) OVER (PARTITION BY useful) - 1) / 2 AS b
         FROM reviews)""",
)
def _(w):
    return spearman(w.reviews, "stars", "useful").select(F.round("spearman", 9).alias("spearman"))


# -- windows, sorts, limits, sets ----------------------------------------------------


@query(
    "window_lag",
    f"""SELECT business_id, year, mean - lag(mean) OVER (PARTITION BY business_id ORDER BY year) AS delta
        FROM ({_yearly})""",
)
def _(w):
    yearly = w.reviews.groupBy("business_id", F.year("date").alias("year")).agg(
        F.avg("stars").alias("mean")
    )
    before = F.lag("mean", 1).over(Window.partitionBy("business_id").orderBy("year"))
    return yearly.select("business_id", "year", (F.col("mean") - before).alias("delta"))


@query(
    "window_top_per_group",
    """SELECT city, business_id, review_count, CAST(rn AS INTEGER) AS place FROM (
         SELECT *, row_number() OVER (PARTITION BY city ORDER BY review_count DESC, business_id) AS rn
         FROM businesses) WHERE rn <= 3""",
)
def _(w):
    return top_per_group(
        w.businesses.select("city", "business_id", "review_count"), ["city"], "review_count", ["business_id"], 3
    )


@query(
    "window_nearest_per_node",
    """SELECT src, dst, friends, CAST(rn AS INTEGER) AS place FROM (
         SELECT e.user_id AS src, e.friend_id AS dst, d.degree AS friends,
                row_number() OVER (PARTITION BY e.user_id ORDER BY d.degree DESC, e.friend_id) AS rn
         FROM friend_ends e JOIN degrees d ON d.user_id = e.friend_id) WHERE rn <= 50""",
)
def _(w):
    degrees = friend_degree(w.graph.user, w.graph.friends_with).toDF("dst", "friends")
    ends = project(w.graph.friends_with, "user_id", "friend_id", "undirected").select("src", "dst")
    return top_per_group(ends.join(degrees, "dst"), ["src"], "friends", ["dst"], 50)


@query(
    "window_best_per_user",
    """SELECT user_id, review_id, useful, CAST(rn AS INTEGER) AS place FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY useful DESC, review_id) AS rn
         FROM reviews) WHERE rn <= 3""",
)
def _(w):
    rows = w.reviews.select("user_id", "review_id", "useful")
    return top_per_group(rows, ["user_id"], "useful", ["review_id"], 3)


@query(
    "sort_multi_key",
    "SELECT state, city, business_id, stars FROM businesses ORDER BY state, stars DESC, business_id",
)
def _(w):
    return w.businesses.select("state", "city", "business_id", "stars").orderBy(
        F.asc("state"), F.desc("stars"), F.asc("business_id")
    )


@query(
    "limit_top_k",
    "SELECT business_id, review_count FROM businesses ORDER BY review_count DESC, business_id LIMIT 20",
)
def _(w):
    return top_k(w.businesses.select("business_id", "review_count"), "review_count", ["business_id"], 20)


@query(
    "limit_both_ends",
    ends_sql(
        "SELECT user_id, review_count FROM users", "review_count", "user_id", "user_id, review_count", 7
    ),
)
def _(w):
    return both_ends(w.users.select("user_id", "review_count"), "review_count", ["user_id"], 7)


@query(
    "limit_arg_max",
    """SELECT arg_max(year, mean) AS best_year FROM (
         SELECT CAST(year(date) AS INTEGER) AS year, avg(stars) AS mean FROM reviews GROUP BY 1)""",
)
def _(w):
    yearly = w.reviews.groupBy(F.year("date").alias("year")).agg(F.avg("stars").alias("mean"))
    return yearly.agg(F.max_by("year", "mean").alias("best_year"))


@query(
    "limit_record_cap",
    """SELECT count(*) AS n, CAST(sum(stars) AS BIGINT) AS stars FROM (
         SELECT r.stars FROM reviews r JOIN businesses b ON b.business_id = r.business_id
         WHERE b.state = 'ASIA' ORDER BY md5('42|' || r.review_id), r.review_id LIMIT 1000)""",
)
def _(w):
    local = w.businesses.filter(F.col("state") == "ASIA")
    own = w.reviews.join(local, "business_id", "left_semi")
    return sample_rows(own, ["review_id"], 1000).agg(
        F.count(F.lit(1)).alias("n"), F.sum("stars").alias("stars")
    )


@query(
    "limit_random_sample",
    """SELECT review_id, stars FROM reviews ORDER BY md5('7|' || review_id), review_id LIMIT 500""",
)
def _(w):
    return sample_rows(w.reviews, ["review_id"], 500, seed=7).select("review_id", "stars")


@query(
    "set_union",
    """SELECT user_id AS id, 'User' AS label FROM users
       UNION SELECT business_id, 'Business' FROM businesses""",
)
def _(w):
    users = w.users.select(F.col("user_id").alias("id"), F.lit("User").alias("label"))
    shops = w.businesses.select("business_id", F.lit("Business"))
    return users.union(shops).distinct()


@query("set_intersect", "SELECT user_id FROM tips INTERSECT SELECT user_id FROM reviews")
def _(w):
    return w.tips.select("user_id").intersect(w.reviews.select("user_id"))


@query("set_difference", "SELECT user_id FROM reviews EXCEPT SELECT user_id FROM tips")
def _(w):
    return w.reviews.select("user_id").subtract(w.tips.select("user_id"))


@query(
    "set_bag_union",
    """SELECT 'review' AS kind, business_id, date FROM reviews
       UNION ALL SELECT 'tip', business_id, date FROM tips""",
)
def _(w):
    reviews = w.reviews.select(F.lit("review").alias("kind"), "business_id", "date")
    return reviews.unionByName(w.tips.select(F.lit("tip").alias("kind"), "business_id", "date"))


# -- scalar functions ----------------------------------------------------------------


@query(
    "scalar_split_trim",
    """SELECT user_id, CAST(len(items) AS INTEGER) AS n, array_to_string(items, '/') AS items FROM (
         SELECT user_id, friends AS items FROM users)""",
)
def _(w):
    text = w.raw_users.select("user_id", F.when(F.col("friends") != "None", F.col("friends")).alias("t"))
    items = trimmed_items(split_list(F.coalesce("t", F.lit("")), ","))
    return text.select("user_id", items.alias("i")).select(
        "user_id", F.size("i").alias("n"), F.array_join("i", "/").alias("items")
    )


@query(
    "scalar_substring_concat",
    """SELECT business_id, token, substring(token, 12, 2) || ':00' AS hour, count(*) AS n
       FROM checkin_tokens GROUP BY 1, 2, 3""",
)
def _(w):
    hour = F.concat(F.substring("token", 12, 2), F.lit(":00"))
    return w.checkin_tokens.groupBy("business_id", "token", hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "scalar_code_points",
    "SELECT doc_id, CAST(length(text) AS INTEGER) AS n, length(text) = n_chars AS agrees FROM documents",
)
def _(w):
    n = code_points(F.col("text"))
    return w.source("documents").select("doc_id", n.alias("n"), (n == F.col("n_chars")).alias("agrees"))


_mixed = """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'not a date'
                                  WHEN event_id % 7 = 1 THEN ''
                                  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS raw FROM events"""


@query(
    "scalar_lenient_parse",
    f"""SELECT event_id, try_strptime(raw, '%Y-%m-%d %H:%M:%S') AS stamp,
               CAST(try_strptime(substring(raw, 1, 10), '%Y-%m-%d') AS DATE) AS day FROM ({_mixed})""",
)
def _(w):
    kind = F.pmod("event_id", F.lit(7))
    raw = F.when(kind == 0, "not a date").when(kind == 1, "").otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    texts = w.source("events").select("event_id", raw.alias("raw"))
    return texts.select(
        "event_id", parse_stamp(F.col("raw")).alias("stamp"), parse_day(F.col("raw")).alias("day")
    )


@query(
    "scalar_calendar_parts",
    """SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
              dayname(date) AS weekday, count(*) AS n FROM reviews GROUP BY 1, 2, 3""",
)
def _(w):
    return w.reviews.groupBy(
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        weekday_name(F.col("date")).alias("weekday"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "scalar_date_difference",
    """SELECT r.review_id, CAST(date_diff('day', u.yelping_since, r.date) AS INTEGER) AS days,
              CAST(epoch(r.date) AS BIGINT) AS seconds
       FROM reviews r JOIN users u ON u.user_id = r.user_id""",
)
def _(w):
    joined = hot_key_join(w.reviews, w.users.select("user_id", "yelping_since"), "user_id", ["review_id"])
    return joined.select(
        "review_id",
        days_between(F.col("yelping_since"), F.col("date")).alias("days"),
        epoch_seconds(F.col("date")).alias("seconds"),
    )


@query(
    "scalar_arithmetic",
    f"""SELECT user_id, CASE WHEN review_count = 0 THEN NULL ELSE useful / review_count END AS ratio,
              {half_up_sql('average_stars', 2)} AS half_up, round_even(average_stars, 1) AS half_even,
              greatest(review_count - 40, 0) AS clipped, CAST(review_count AS DOUBLE) AS as_double
       FROM users""",
)
def _(w):
    return w.users.select(
        "user_id",
        ratio(F.col("useful"), F.col("review_count")).alias("ratio"),
        half_up(F.col("average_stars"), 2).alias("half_up"),
        half_even(F.col("average_stars"), 1).alias("half_even"),
        F.greatest(F.col("review_count") - 40, F.lit(0)).alias("clipped"),
        F.col("review_count").cast("double").alias("as_double"),
    )


@query(
    "scalar_conditionals",
    """SELECT business_id, CASE WHEN stars >= 4 THEN 'high' WHEN stars >= 2.5 THEN 'mid' ELSE 'low' END AS tier,
              CASE WHEN checkin_count > 0 THEN 'visited' ELSE 'unvisited' END AS visits,
              coalesce(nullif(tip_count, 0), -1) AS tips FROM businesses""",
)
def _(w):
    tier = F.when(F.col("stars") >= 4, "high").when(F.col("stars") >= 2.5, "mid").otherwise("low")
    return w.businesses.select(
        "business_id",
        tier.alias("tier"),
        F.when(F.col("checkin_count") > 0, "visited").otherwise("unvisited").alias("visits"),
        F.coalesce(F.nullif("tip_count", F.lit(0)), F.lit(-1)).alias("tips"),
    )


@query(
    "scalar_arrays",
    """SELECT business_id, CAST(len(categories) AS INTEGER) AS n, list_contains(categories, 'ECONOMY') AS economy,
              array_to_string(categories[1:2], '|') AS leading, categories[3] AS third FROM businesses""",
)
def _(w):
    return w.businesses.select(
        "business_id",
        F.size("categories").alias("n"),
        F.array_contains("categories", "ECONOMY").alias("economy"),
        F.array_join(F.slice("categories", 1, 2), "|").alias("leading"),
        F.element_at("categories", 3).alias("third"),
    )


@query(
    "scalar_right_closed_bins",
    """SELECT CASE WHEN useful <= 0 THEN '0' WHEN useful <= 5 THEN '1-5' WHEN useful <= 20 THEN '6-20'
                   ELSE '21+' END AS bucket, count(*) AS n FROM reviews GROUP BY 1""",
)
def _(w):
    bucket = right_closed_bin(F.col("useful"), (0, 5, 20), ("0", "1-5", "6-20", "21+"))
    return w.reviews.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
