"""Null, rounding, binning and parsing rules on small hand-made frames."""

import datetime as dt

from pyspark.sql import functions as F

from plaudit.functions import numbers as n, texts, times
from plaudit.operators.topk import both_ends, most_frequent, top_k, top_per_group
from plaudit.plans import ratings


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_rounding_rules(spark):
    row = one(
        spark,
        n.half_even(F.lit(2.5), 0),
        n.half_up(F.lit(2.5), 0),
        n.half_even(F.lit(0.125), 2),
        n.half_up(F.lit(2.425), 2),
    )
    assert tuple(row) == (2.0, 3.0, 0.12, 2.43)


def test_ratio_guards_zero(spark):
    assert tuple(one(spark, n.ratio(F.lit(1), F.lit(0)), n.ratio(F.lit(1), F.lit(4)))) == (None, 0.25)


def test_step_bin_is_left_closed_with_default(spark):
    values = [0, 9, 10, 49, 50, -1, None]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    found = [r[0] for r in df.select(n.step_bin(F.col("v"), (0, 10, 50))).collect()]
    assert found == [0, 0, 1, 1, 2, 2, 2]


def test_right_closed_bin(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 5, 6, 20, 21)], "v int")
    found = [
        r[0]
        for r in df.select(n.right_closed_bin(F.col("v"), (0, 5, 20), ("0", "1-5", "6-20", "21+"))).collect()
    ]
    assert found == ["0", "1-5", "1-5", "6-20", "6-20", "21+"]


def test_missing_change_counts_as_fall(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (1.0,), (None,)], "d double")
    faithful = [r[0] for r in df.select(n.is_fall(F.col("d"))).collect()]
    plain = [r[0] for r in df.select(n.is_fall(F.col("d"), False)).collect()]
    assert faithful == [True, False, False, True]
    assert plain == [True, False, False, False]


def test_average_where_ignores_others(spark):
    df = spark.createDataFrame([(1, 2.0), (5, 4.0), (9, None)], "k int, v double")
    row = df.agg(
        n.average_where(F.col("v"), F.col("k") > 2), n.average_where(F.col("v"), F.col("k") > 99)
    ).first()
    assert tuple(row) == (4.0, None)


def test_splitting(spark):
    row = one(
        spark,
        texts.split_or_empty(F.lit(""), ","),
        texts.split_or_empty(F.lit("None"), ", ", ("None", "")),
        texts.split_or_empty(F.lit("a, b"), ", "),
        texts.split_list(F.lit("a.b"), "."),
        texts.trimmed_items(texts.split_list(F.lit(" a ,, b"), ",")),
        texts.code_points(F.lit("né😀")),
    )
    assert tuple(row) == ([], [], ["a", "b"], ["a", "b"], ["a", "b"], 3)


def test_lenient_parsing_and_days(spark):
    row = one(
        spark,
        times.parse_stamp(F.lit("2016-04-26 19:49:16")),
        times.parse_stamp(F.lit("soon")),
        times.parse_day(F.lit("2016-04-26 19:49:16")),
        times.parse_day(F.lit("2016-13-26")),
        times.days_between(
            F.lit("2020-01-01 23:59:00").cast("timestamp_ntz"), F.lit("2020-01-02 00:01:00").cast("timestamp_ntz")
        ),
        times.weekday_name(F.lit("2016-04-26").cast("date")),
    )
    assert tuple(row) == (
        dt.datetime(2016, 4, 26, 19, 49, 16),
        None,
        dt.date(2016, 4, 26),
        None,
        1,
        "Tuesday",
    )


def test_top_k_and_ends_break_ties_by_key(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", None), ("e", 0.5)], "k string, v double")
    assert [r.k for r in top_k(df, "v", ["k"], 3).collect()] == ["b", "c", "a"]
    ends = {(r.side, r.place): r.k for r in both_ends(df, "v", ["k"], 2).collect()}
    assert ends == {("best", 1): "b", ("best", 2): "c", ("worst", 1): "d", ("worst", 2): "e"}


def test_worst_end_is_the_reversed_tail(spark):
    df = spark.createDataFrame([(k, 1.0) for k in "abcd"], "k string, v double")
    ordered = [r.k for r in top_k(df, "v", ["k"], 4).collect()]
    worst = sorted((r.place, r.k) for r in both_ends(df, "v", ["k"], 3).collect() if r.side == "worst")
    assert [k for _, k in worst] == ordered[-3:][::-1]


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    top = top_per_group(df, ["g"], "id", ["id"], 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted((r.g, r.id) for r in top.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]


def test_mode_takes_smallest_on_ties(spark):
    df = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", "b"), ("x", "a"), ("y", "c")], "g string, i string")
    assert sorted(map(tuple, most_frequent(df, ["g"], "i").collect())) == [("x", "a", 2, 4), ("y", "c", 1, 1)]


BUSINESSES = "business_id string, city string, state string, categories array<string>, stars double, review_count long, checkin_count long, tip_count long"
REVIEWS = "review_id string, user_id string, business_id string, stars int, useful long, text string, date timestamp_ntz"


def reviews_by_month(spark, means):
    rows = []
    for month, stars in enumerate(means, 1):
        rows.append((f"r{month}", "u", "b", stars, 1, "txt", dt.datetime(2020, month, 3)))
    return spark.createDataFrame(rows, REVIEWS)


def test_consistency_counts_the_first_month_as_fall(spark):
    shops = spark.createDataFrame([("b", "c", "s", ["Cat"], 3.0, 3, 1, 0)], BUSINESSES)
    reviews = reviews_by_month(spark, [3, 4, 2, 2])
    faithful = ratings.mom_consistency(shops, reviews, min_months=4).first()
    assert tuple(faithful) == ("Cat", 0.25, 0.5)
    plain = ratings.mom_consistency(shops, reviews, min_months=4, null_as_down=False).first()
    assert tuple(plain) == ("Cat", 0.25, 0.25)
    assert ratings.mom_consistency(shops, reviews, min_months=4, min_reviews=5).isEmpty()


def test_consistency_compares_observed_months(spark):
    shops = spark.createDataFrame([("b", "c", "s", ["Cat"], 3.0, 3, 1, 0)], BUSINESSES)
    reviews = reviews_by_month(spark, [3, 9, 4]).filter("month(date) <> 2")
    assert tuple(ratings.mom_consistency(shops, reviews, min_months=2).first()) == ("Cat", 0.5, 0.5)


def test_trends_weight_reviews_and_cap(spark):
    shops = spark.createDataFrame(
        [("b1", "X", "PA", ["A"], 3.0, 3, 1, 0), ("b2", "X", "PA", ["A", "B"], 3.0, 3, 1, 0), ("b3", "Y", "NV", ["A"], 3.0, 3, 1, 0)],
        BUSINESSES,
    )
    rows, i = [], 0
    for year, stars in ((2018, (1, 2)), (2019, (3, 3)), (2020, (5, 4))):
        for shop, s in zip(("b1", "b2"), stars):
            i += 1
            rows.append((f"r{i}", "u", shop, s, 0, "t", dt.datetime(year, 5, 5)))
    rows.append(("out", "u", "b1", 1, 0, "t", dt.datetime(2025, 1, 1)))
    reviews = spark.createDataFrame(rows, REVIEWS)
    found = ratings.city_trends(shops, reviews, min_reviews=2).filter("side = 'best'").collect()
    assert [(r.city, r.trend) for r in found] == [("X", 3.0)]
    assert [tuple(t) for t in found[0].timeline] == [(2018, 1.5, 2), (2019, 3.0, 2), (2020, 4.5, 2)]
    assert ratings.city_trends(shops, reviews, min_reviews=2, record_cap=3).isEmpty()
    assert ratings.city_trends(shops, reviews, min_reviews=2, record_cap=7).count() == 2


def test_elite_report_matches_direct_aggregation(spark):
    users = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "user_id string, is_elite_ever boolean")
    reviews = spark.createDataFrame(
        [("1", "a", "x", 5, 1, "ab", None), ("2", "a", "x", 4, None, None, None), ("3", "b", "x", 1, 3, "abcd", None), ("4", "z", "x", 1, 3, "abcd", None)],
        REVIEWS,
    )
    found = {r.user_status: r for r in ratings.elite_vs_regular(users, reviews).collect()}
    assert tuple(found["Elite User"])[1:] == (4.5, 2.0, 1.0, 2)
    assert tuple(found["Non-Elite User"])[1:] == (1.0, 4.0, 3.0, 1)


def test_crosstab_puts_unvisited_into_the_lowest_tier(spark):
    rows = [(f"b{i}", "c", "s", ["Cat"], float(i % 5 + 1), 10 * i, i, i) for i in range(5)]
    shops = spark.createDataFrame(rows + [("n", "c", "s", ["Cat"], 1.0, 0, None, 0)], BUSINESSES)
    table = {r.Checkin_Tier: r for r in ratings.checkin_crosstab(shops).collect()}
    # Visited counts 1..4: quartiles 1.75 and 3.25.
    assert table[ratings.LOW].Mean_Stars == round((1 + 2 + 1) / 3, 2)
    assert table[ratings.MEDIUM].Mean_Review_Count == 25.0
    assert table[ratings.HIGH].Tip_to_Review_Ratio == 0.1


def test_cohort_leaders_take_the_earliest_on_ties(spark):
    df = spark.createDataFrame([(2003, None, None), (2004, 3.0, 1.0), (2005, 3.0, 2.0)], "cohort_year int, mean_stars double, mean_useful double")
    assert tuple(ratings.best_cohorts(df).first()) == (2004, 2005)
