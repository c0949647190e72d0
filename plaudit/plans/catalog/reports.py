"""The composite reports.  Thresholds fit the size of the test tables."""

from pyspark.sql import functions as F

from plaudit.plans import ratings as r
from plaudit.plans.catalog.base import query


def ends_sql(stats: str, by: str, keys: str, columns: str, k: int = 5) -> str:
    """Best and worst k rows of a subquery, as `both_ends` selects them."""
    up = ", ".join(f"{key.strip()} DESC" for key in keys.split(","))
    return f"""
        WITH stats AS ({stats}), placed AS (
          SELECT *, row_number() OVER (ORDER BY {by} DESC NULLS LAST, {keys}) AS hi,
                 row_number() OVER (ORDER BY {by} ASC NULLS FIRST, {up}) AS lo FROM stats)
        SELECT {columns}, 'best' AS side, CAST(hi AS INTEGER) AS place FROM placed WHERE hi <= {k}
        UNION ALL
        SELECT {columns}, 'worst' AS side, CAST(lo AS INTEGER) AS place FROM placed WHERE lo <= {k}"""


def safest_sql(group: str, source: str, min_reviews: int, min_businesses: int, alias: str) -> str:
    return ends_sql(
        f"""SELECT {group} AS {alias}, avg(stars) AS avg_stars,
                   CAST(sum(review_count) AS BIGINT) AS total_reviews, count(*) AS business_count
            FROM {source} GROUP BY 1
            HAVING sum(review_count) >= {min_reviews} AND count(*) >= {min_businesses}""",
        "avg_stars",
        alias,
        f"{alias}, avg_stars, total_reviews, business_count",
    )


@query("safest_cities", safest_sql("city", "businesses", 500, 20, "city"))
def _(w):
    return r.safest_cities(w.businesses, 500, 20)


@query("safest_categories", safest_sql("category", "business_category", 1000, 30, "categories"))
def _(w):
    return r.safest_categories(w.businesses, 1000, 30)


def trends_sql(group: str, source: str, min_reviews: int) -> str:
    return f"""
        WITH yearly AS (
          SELECT b.{group} AS grp, year(r.date) AS year, sum(r.stars) AS stars, count(*) AS reviews
          FROM reviews r JOIN {source} b ON b.business_id = r.business_id
          WHERE b.state = 'ASIA' AND r.date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31 23:59:59'
          GROUP BY 1, 2 HAVING count(*) >= {min_reviews}),
        means AS (SELECT *, stars / reviews AS avg_stars FROM yearly),
        stats AS (
          SELECT grp, max_by(avg_stars, year) - min_by(avg_stars, year) AS trend
          FROM means GROUP BY 1 HAVING count(*) >= 3),
        placed AS (
          SELECT *, row_number() OVER (ORDER BY trend DESC, grp) AS hi,
                 row_number() OVER (ORDER BY trend, grp DESC) AS lo FROM stats),
        ends AS (
          SELECT grp, trend, 'best' AS side, hi AS place FROM placed WHERE hi <= 5
          UNION ALL SELECT grp, trend, 'worst', lo FROM placed WHERE lo <= 5)
        SELECT e.grp AS "group", e.side, CAST(e.place AS INTEGER) AS place, e.trend,
               CAST(m.year AS INTEGER) AS year, m.avg_stars, m.reviews
        FROM ends e JOIN means m ON m.grp = e.grp"""


def flat_trends(trends, group):
    return trends.select(
        F.col(group).alias("group"), "side", "place", "trend", F.inline("timeline")
    )


WINDOW = dict(state="ASIA", start="1996-01-01", end="2000-12-31 23:59:59")


@query("city_trends", trends_sql("city", "businesses", 20))
def _(w):
    return flat_trends(r.city_trends(w.businesses, w.reviews, **WINDOW), "city")


@query("category_trends", trends_sql("category", "business_category", 50))
def _(w):
    return flat_trends(r.category_trends(w.businesses, w.reviews, **WINDOW), "categories")


def bins_sql(value: str, edges, labels) -> tuple[str, str]:
    """CASE expressions for the bin index and for its label."""
    cases = " ".join(
        f"WHEN {value} >= {low} AND {value} < {high} THEN {i}"
        for i, (low, high) in enumerate(zip(edges, edges[1:]))
    )
    names = " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(labels))
    return f"CASE {cases} ELSE {len(labels) - 1} END", f"CASE bin {names} END"


def spans(edges) -> tuple[str, ...]:
    """Labels of whole-number bins that hold their lower edge, and of what lies beyond them."""
    return (*[f"{low}-{high - 1}" if high - low > 1 else str(low) for low, high in zip(edges, edges[1:])], f"{edges[-1]}+")


# Review counts of the test tables lie between 5 and 60.
VOLUME = (0, 20, 25, 30, 35, 45)
_bin, _label = bins_sql("review_count", VOLUME, spans(VOLUME))


@query(
    "volume_vs_rating",
    f"""SELECT {_label} AS volume_tier, round_even(m, 3) AS avg_rating,
               round_even(s, 3) AS rating_volatility_stddev, n AS business_count
        FROM (SELECT {_bin} AS bin, avg(stars) AS m, stddev_pop(stars) AS s, count(*) AS n
              FROM businesses GROUP BY 1)""",
)
def _(w):
    return r.volume_vs_rating(w.businesses, VOLUME, spans(VOLUME))


_shares = ", ".join(
    f'round_even((CAST(sum(CASE WHEN r.stars = {s} THEN 1 ELSE 0 END) AS DOUBLE) / count(*)) * 100, 1) AS "{s}_star"'
    for s in r.STARS
)


@query(
    "review_behavior",
    f"""SELECT b.category, round_even(CAST(sum(r.text_length) AS DOUBLE) / count(*), 1) AS avg_review_length,
               round_even(CAST(sum(r.useful) AS DOUBLE) / count(*), 3) AS useful_ratio, {_shares},
               count(*) AS total_reviews
        FROM written_reviews r JOIN business_category b ON b.business_id = r.business_id
        WHERE b.state = 'ASIA' GROUP BY 1 HAVING count(*) >= 100
        ORDER BY total_reviews DESC, b.category LIMIT 20""",
)
def _(w):
    report = r.review_behavior(w.businesses, w.reviews, "ASIA", 100)
    return report.select("*", "star_distribution_pct.*").drop("star_distribution_pct")


TENURE = (0, 6, 8, 9, 10)
_bin, _label = bins_sql("tenure", TENURE, spans(TENURE))


@query(
    "tenure_behavior",
    f"""SELECT {_label} AS tenure_tier, round_even(rating, 3) AS avg_rating_given,
               round_even(useful, 3) AS avg_usefulness_score, n AS user_count
        FROM (SELECT {_bin} AS bin, avg(average_stars) AS rating,
                     avg(useful / review_count) AS useful, count(*) AS n
              FROM (SELECT *, 2001 - year(yelping_since) AS tenure FROM users WHERE review_count > 0)
              GROUP BY 1)""",
)
def _(w):
    return r.tenure_behavior(w.users, 2001, TENURE, spans(TENURE))


@query(
    "elite_vs_regular",
    """SELECT CASE WHEN u.is_elite_ever THEN 'Elite User' ELSE 'Non-Elite User' END AS user_status,
              round_even(avg(r.stars), 3) AS mean_star_rating,
              round_even(avg(r.text_length), 1) AS mean_review_length,
              round_even(avg(r.useful), 3) AS mean_useful_per_review, count(*) AS sample_size
       FROM written_reviews r JOIN users u ON u.user_id = r.user_id GROUP BY u.is_elite_ever""",
)
def _(w):
    return r.elite_vs_regular(w.users, w.reviews)


VISITS = (1, 10, 15, 20, 25, 30)
_bin, _label = bins_sql("checkin_count", VISITS, spans(VISITS))


@query(
    "checkin_vs_rating",
    f"""SELECT {_label} AS visit_tier, round_even(m, 3) AS avg_rating, n AS business_count
        FROM (SELECT {_bin} AS bin, avg(stars) AS m, count(*) AS n FROM businesses
              WHERE checkin_count > 0 GROUP BY 1)""",
)
def _(w):
    return r.checkin_vs_rating(w.businesses, VISITS, spans(VISITS))


@query(
    "checkin_gap_by_category",
    """SELECT category, round_even(h, 3) AS high_visit_avg, round_even(l, 3) AS low_visit_avg,
              h - l AS rating_gap
       FROM (SELECT category, avg(CASE WHEN checkin_count >= 21 THEN stars END) AS h,
                    avg(CASE WHEN checkin_count < 19 THEN stars END) AS l
             FROM business_category WHERE checkin_count > 0 GROUP BY 1 HAVING count(*) >= 3)
       ORDER BY rating_gap DESC NULLS LAST, category LIMIT 10""",
)
def _(w):
    return r.checkin_gap_by_category(w.businesses, high=21, low=19, min_businesses=3)


_pct = ", ".join(
    f"round_even(CAST(sum(CASE WHEN r.stars = {s} THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 3) AS pct_{s}_star"
    for s in r.STARS
)
_cohorts = f"""SELECT CAST(year(u.yelping_since) AS INTEGER) AS cohort_year,
              round_even(avg(r.stars), 3) AS mean_stars, round_even(stddev_pop(r.stars), 3) AS std_stars,
              round_even(avg(r.text_length), 1) AS mean_length,
              round_even(avg(r.useful), 3) AS mean_useful, {_pct}
       FROM written_reviews r JOIN users u ON u.user_id = r.user_id GROUP BY 1"""


@query("cohort_analysis", _cohorts)
def _(w):
    return r.cohort_analysis(w.users, w.reviews)


@query(
    "best_cohorts",
    f"""WITH cohorts AS ({_cohorts})
        SELECT (SELECT cohort_year FROM cohorts ORDER BY mean_stars DESC, cohort_year LIMIT 1)
                   AS highest_stars_cohort,
               (SELECT cohort_year FROM cohorts ORDER BY mean_useful DESC, cohort_year LIMIT 1)
                   AS highest_useful_cohort""",
)
def _(w):
    return r.best_cohorts(r.cohort_analysis(w.users, w.reviews))


_consistency = """
    SELECT category, CAST(sum(CASE WHEN delta > 0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS upward_consistency,
           CAST(sum(CASE WHEN delta < 0 {null} THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS downward_consistency
    FROM (SELECT category, mean - lag(mean) OVER (PARTITION BY category ORDER BY y, m) AS delta
          FROM (SELECT b.category, year(r.date) AS y, month(r.date) AS m, avg(r.stars) AS mean
                FROM reviews r JOIN business_category b ON b.business_id = r.business_id
                GROUP BY 1, 2, 3))
    GROUP BY 1 HAVING count(*) >= 24"""


@query("mom_consistency", _consistency.format(null="OR delta IS NULL"))
def _(w):
    return r.mom_consistency(w.businesses, w.reviews)


@query("mom_consistency_plain_nulls", _consistency.format(null=""))
def _(w):
    return r.mom_consistency(w.businesses, w.reviews, null_as_down=False)


@query(
    "most_consistent_categories",
    f"""WITH c AS ({_consistency.format(null="OR delta IS NULL")})
        (SELECT *, 'upward' AS side FROM c ORDER BY upward_consistency DESC, category LIMIT 3)
        UNION ALL
        (SELECT *, 'downward' AS side FROM c ORDER BY downward_consistency DESC, category LIMIT 3)""",
)
def _(w):
    return r.most_consistent(r.mom_consistency(w.businesses, w.reviews))


_crosstab = f"""
    WITH q AS (SELECT quantile_cont(checkin_count, 0.25) AS p25, quantile_cont(checkin_count, 0.75) AS p75
               FROM businesses WHERE checkin_count > 0),
    top AS (SELECT category FROM business_category GROUP BY 1
            ORDER BY sum(review_count) DESC, category LIMIT 10),
    cross_tab AS (
      SELECT category AS "Category",
             CASE WHEN checkin_count <= p25 THEN '{r.LOW}' WHEN checkin_count >= p75 THEN '{r.HIGH}'
                  ELSE '{r.MEDIUM}' END AS "Checkin_Tier",
             round_even(avg(stars), 2) AS "Mean_Stars",
             round_even(avg(review_count), 0) AS "Mean_Review_Count",
             round_even(CASE WHEN sum(review_count) = 0 THEN 0
                             ELSE sum(tip_count) / sum(review_count) END, 3) AS "Tip_to_Review_Ratio"
      FROM business_category CROSS JOIN q WHERE category IN (SELECT category FROM top) GROUP BY 1, 2)"""


@query("checkin_crosstab", _crosstab + " SELECT * FROM cross_tab")
def _(w):
    return r.checkin_crosstab(w.businesses)


_cells = ", ".join(
    f"""max(CASE WHEN "Checkin_Tier" LIKE '{tier} %' THEN "{m}" END) AS "{tier}_{m}" """
    for tier in ("High", "Low", "Medium")
    for m in ("Mean_Stars", "Mean_Review_Count", "Tip_to_Review_Ratio")
)


@query("checkin_crosstab_pivot", _crosstab + f' SELECT "Category", {_cells} FROM cross_tab GROUP BY 1')
def _(w):
    return r.crosstab_pivot(r.checkin_crosstab(w.businesses))
