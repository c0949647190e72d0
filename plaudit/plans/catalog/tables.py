"""Sources, sinks, cleaning steps and quality checks."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from plaudit.functions.texts import code_points
from plaudit.operators import cleaning, quality
from plaudit.operators.graph import Graph
from plaudit.plans import etl
from plaudit.plans.catalog.base import query
from plaudit.session import new_path, remove_path
from plaudit.sources import documents, files, schemas, upserts

# -- scans and sinks -----------------------------------------------------------------


@query(
    "json_lines_scan",
    """SELECT business_id, name, city, state, stars, review_count,
              array_to_string(categories, ', ') AS categories FROM businesses""",
)
def _(w):
    path = new_path(w.spark, "json")
    w.raw_businesses.write.json(path)
    scanned = files.scan_json_lines(w.spark, path, schemas.RAW["business"])
    return scanned.select(
        "business_id", "name", "city", "state", "stars", "review_count", "categories"
    )


@query(
    "parquet_sink_partitioned",
    "SELECT city, state, count(*) AS n, CAST(sum(review_count) AS BIGINT) AS reviews FROM businesses GROUP BY 1, 2",
)
def _(w):
    path = new_path(w.spark, "parquet")
    files.write_table(w.businesses, path, ["state"])
    table = files.scan_table(w.spark, path)
    return table.groupBy("city", "state").agg(
        F.count(F.lit(1)).alias("n"), F.sum("review_count").alias("reviews")
    )


@query("parquet_scan_columns", "SELECT user_id, useful FROM users")
def _(w):
    path = new_path(w.spark, "parquet")
    files.write_table(w.users, path)
    return files.scan_table(w.spark, path, ["user_id", "useful"])


@query(
    "head_of_every_file",
    """(SELECT 'part' AS folder, p_partkey AS key, p_name AS name FROM part ORDER BY p_partkey LIMIT 300)
       UNION ALL (SELECT 'customer', c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 300)
       UNION ALL (SELECT 'nation', n_nationkey, n_name FROM nation ORDER BY n_nationkey LIMIT 300)""",
)
def _(w):
    # Whole tables as JSON files in the order of their keys; the head of each must be its first lines.
    taken = []
    for name, prefix in (("part", "p_part"), ("customer", "c_cust"), ("nation", "n_nation")):
        source, target = new_path(w.spark, name), new_path(w.spark, "head")
        w.source(name).orderBy(f"{prefix}key").coalesce(1).write.json(source)
        lines = w.spark.read.text(files.extract_heads(w.spark, source, target, 300))
        row = F.from_json("value", f"{prefix}key long, {prefix[:2]}name string")
        taken.append(lines.select(F.lit(name).alias("folder"), row.alias("r")).select("folder", F.col(f"r.{prefix}key").alias("key"), F.col(f"r.{prefix[:2]}name").alias("name")))
    return reduce(DataFrame.unionByName, taken)


@query(
    "document_load",
    """SELECT user_id AS _id, name, review_count, average_stars,
              array_to_string(friends, '/') AS friends FROM users""",
)
def _(w):
    doubled = w.raw_users.unionByName(w.raw_users)
    loaded = documents.load_documents(
        doubled.withColumn("average_stars", F.coalesce("average_stars", F.lit(float("nan")))), "users"
    )
    return loaded.select(
        "_id", "name", "review_count", "average_stars", F.array_join("friends", "/").alias("friends")
    )


@query(
    "full_reload_users",
    """SELECT user_id, name, review_count, yelping_since, is_elite_ever, elite_year_count,
              array_to_string(elite_years, ',') AS elite_years FROM users""",
)
def _(w):
    raw, target = new_path(w.spark, "raw-users"), new_path(w.spark, "users")
    w.raw_users.write.json(raw)
    documents.reload_users(w.spark, raw, target)
    return documents.reload_users(w.spark, raw, target).select(
        "user_id",
        "name",
        "review_count",
        "yelping_since",
        "is_elite_ever",
        "elite_year_count",
        F.array_join("elite_years", ",").alias("elite_years"),
    )


@query("keyed_merge", "SELECT business_id, name, tip_count FROM businesses")
def _(w):
    target = w.businesses.select("business_id", "name").withColumn("tip_count", F.lit(0).cast("long"))
    stray = w.spark.range(3).select(
        F.concat(F.lit("unknown"), "id").alias("business_id"), F.lit(9).cast("long").alias("tip_count")
    )
    counts = w.tips.groupBy("business_id").agg(F.count(F.lit(1)).alias("tip_count"))
    return documents.merge_columns(target, counts.unionByName(stray), "business_id")


@query(
    "conditional_update",
    """SELECT business_id, CASE WHEN city = 'NATION_1' AND stars < 3 THEN 0.0 ELSE stars END AS stars,
              CASE WHEN city = 'NATION_1' AND stars < 3 THEN upper(name) ELSE name END AS name,
              CAST(0 AS BIGINT) AS compliments FROM businesses""",
)
def _(w):
    table = w.businesses.select("business_id", "city", "stars", "name")
    changed = documents.update_where(
        table,
        (F.col("city") == "NATION_1") & (F.col("stars") < 3),
        {"stars": F.lit(0.0), "name": F.upper("name")},
    )
    filled = documents.add_missing(changed, "compliments", F.lit(0).cast("long"))
    return filled.drop("city")


@query("keyed_merge_in_place", "SELECT business_id, name, coalesce(t.n, 0) AS tip_count FROM businesses "
       "LEFT JOIN (SELECT business_id, count(*) AS n FROM tips GROUP BY 1) t USING (business_id)")  # fmt: skip
def _(w):
    """The counts written into a stored table, bucket by bucket."""
    table = upserts.KeyedTable(new_path(w.spark, "keyed"), "business_id", 16)
    table.write(w.businesses.select("business_id", "name").withColumn("tip_count", F.lit(0).cast("long")))
    stray = w.spark.range(3).select(
        F.concat(F.lit("unknown"), "id").alias("business_id"), F.lit(9).cast("long").alias("tip_count")
    )
    counts = w.tips.groupBy("business_id").agg(F.count(F.lit(1)).alias("tip_count"))
    table.merge(counts.unionByName(stray))
    return table.read(w.spark).select("business_id", "name", "tip_count")


@query(
    "conditional_update_in_place",
    """SELECT business_id, city, CASE WHEN city = 'NATION_1' AND stars < 3 THEN 0.0 ELSE stars END AS stars,
              CASE WHEN city = 'NATION_1' AND stars < 3 THEN upper(name) ELSE name END AS name FROM businesses""",
)
def _(w):
    """Only the files that hold the city are rewritten."""
    path = new_path(w.spark, "updated")
    w.businesses.select("business_id", "city", "stars", "name").repartitionByRange(8, "city").write.parquet(path)
    upserts.update_in_place(
        w.spark, path, (F.col("city") == "NATION_1") & (F.col("stars") < 3), {"stars": F.lit(0.0), "name": F.upper("name")}
    )
    return w.spark.read.parquet(path)


_sizes = """
    SELECT 'user' AS name, (SELECT count(*) FROM users) AS n_rows
    UNION ALL SELECT 'business', (SELECT count(*) FROM businesses)
    UNION ALL SELECT 'category', (SELECT count(DISTINCT category) FROM in_category)
    UNION ALL SELECT 'city', (SELECT count(DISTINCT city) FROM businesses)
    UNION ALL SELECT 'state', (SELECT count(DISTINCT state) FROM businesses)
    UNION ALL SELECT 'reviewed', (SELECT count(*) FROM reviews)
    UNION ALL SELECT 'tip_left', (SELECT count(*) FROM (SELECT DISTINCT user_id, business_id FROM tips
        WHERE user_id IN (SELECT user_id FROM users) AND business_id IN (SELECT business_id FROM businesses)))
    UNION ALL SELECT 'in_category', (SELECT count(*) FROM in_category)
    UNION ALL SELECT 'located_in', (SELECT count(*) FROM businesses)
    UNION ALL SELECT 'part_of', (SELECT count(*) FROM part_of)
    UNION ALL SELECT 'friends_with', (SELECT count(*) FROM friends_with)"""


@query("graph_build", _sizes)
def _(w):
    folder = new_path(w.spark, "graph")
    w.graph.write(folder)
    return quality.row_counts(Graph.read(w.spark, folder).tables())


@query(
    "etl_round_trip",
    """SELECT b.business_id, b.city, b.stars, b.review_count, b.checkin_count, b.tip_count, len(list_distinct(b.categories)) AS n_labels,
              (SELECT count(*) FROM reviews r WHERE r.business_id = b.business_id) AS n_edges,
              (SELECT coalesce(CAST(sum(r.text_length) AS BIGINT), 0) FROM written_reviews r
               WHERE r.business_id = b.business_id) AS n_letters,
              (SELECT count(DISTINCT t.user_id) FROM tips t
               WHERE t.business_id = b.business_id AND t.user_id IN (SELECT user_id FROM users)) AS n_advisers,
              (SELECT count(DISTINCT r.user_id) FROM reviews r JOIN users u ON u.user_id = r.user_id
               WHERE r.business_id = b.business_id AND u.is_elite_ever) AS n_elite
       FROM businesses b""",
)
def _(w):
    """The whole way: raw JSON files, cleaned tables, graph; every business with what tables and graph know of it."""
    raw, tables, stored = (new_path(w.spark, name) for name in ("raw", "tables", "graph"))
    stamp = F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date")
    entities = {
        "business": w.raw_businesses,
        "user": w.raw_users,
        "review": w.reviews_with_text.select("review_id", "user_id", "business_id", F.col("stars").cast("double"), "useful", "text", stamp),
        "tip": w.tips.select("user_id", "business_id", "text", stamp, F.lit(0).cast("long").alias("compliment_count")),
        "checkin": w.raw_checkins,
    }
    for name, rows in entities.items():
        files.write_json_lines(rows, f"{raw}/{name}.json")
    paths = etl.run_etl(w.spark, raw, tables)
    # The tables hold all that is read from here on.
    remove_path(w.spark, raw)
    graph = etl.run_graph_build(w.spark, tables, stored)
    clean = {name: w.spark.read.parquet(path) for name, path in paths.items()}
    per_review = clean["reviews"].groupBy("business_id").agg(F.sum(code_points(F.col("text"))).cast("long").alias("n_letters"))
    known = graph.reviewed.join(clean["users"].select("user_id", "is_elite_ever"), "user_id")
    edges = known.groupBy("business_id").agg(
        F.count(F.lit(1)).alias("n_edges"), F.count_distinct(F.when(F.col("is_elite_ever"), F.col("user_id"))).alias("n_elite")
    )
    advisers = graph.tip_left.groupBy("business_id").agg(F.count_distinct("user_id").alias("n_advisers"))
    labels = graph.in_category.groupBy("business_id").agg(F.count(F.lit(1)).alias("n_labels"))
    found = graph.business.select("business_id", "stars", "review_count").join(graph.located_in, "business_id")
    found = found.join(clean["businesses"].select("business_id", "checkin_count", "tip_count"), "business_id")
    counts = ("n_labels", "n_edges", "n_letters", "n_advisers", "n_elite")
    for part in (labels, edges, per_review, advisers):
        found = found.join(part, "business_id", "left")
    return found.select("business_id", "city", "stars", "review_count", "checkin_count", "tip_count", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts])


@query(
    "named_result_sets",
    """SELECT 'cities' AS query, 'Businesses by city' AS title, count(DISTINCT city) AS n FROM businesses
       UNION ALL SELECT 'users', 'Users by elite flag', count(DISTINCT is_elite_ever) FROM users""",
)
def _(w):
    folder = new_path(w.spark, "results")
    files.append_result(w.businesses.groupBy("city").count(), folder, "cities", "Businesses by city")
    files.append_result(w.users.groupBy("is_elite_ever").count(), folder, "users", "Users by elite flag")
    return files.read_results(w.spark, folder).groupBy("query", "title").agg(
        F.count(F.lit(1)).alias("n")
    )


# -- cleaning ------------------------------------------------------------------------


def _tops_sql(kind: str, label: str) -> str:
    return f"""
        {kind} AS (
          SELECT business_id, string_agg(label, '|' ORDER BY place) AS {kind} FROM (
            SELECT business_id, label, row_number() OVER (
                     PARTITION BY business_id ORDER BY count(*) DESC, min(ord)) AS place
            FROM (SELECT business_id, ord, {label} AS label FROM slots) GROUP BY 1, 2)
          WHERE place <= 3 GROUP BY 1)"""


@query(
    "checkin_stats",
    "WITH slots AS (SELECT business_id, ord, dayname(strptime(token, '%Y-%m-%d %H:%M:%S')) AS day, "
    "substring(token, 12, 2) AS hour FROM checkin_tokens),"
    + ",".join(
        [
            _tops_sql("top_days", "day"),
            _tops_sql("top_hours", "hour"),
            _tops_sql("top_day_hours", "day || '_' || hour || ':00'"),
        ]
    )
    + """ SELECT c.business_id, c.n AS checkin_count, top_days, top_hours, top_day_hours
          FROM (SELECT business_id, count(*) AS n FROM checkin_tokens GROUP BY 1) c
               JOIN top_days d ON d.business_id = c.business_id
               JOIN top_hours h ON h.business_id = c.business_id
               JOIN top_day_hours x ON x.business_id = c.business_id""",
)
def _(w):
    stats = cleaning.checkin_stats(w.checkin_tokens)
    return stats.select(
        "business_id",
        "checkin_count",
        *[F.array_join(kind, "|").alias(kind) for kind in cleaning.TOPS],
    )


@query(
    "checkin_summary",
    "WITH listed AS (SELECT business_id, token, row_number() OVER (PARTITION BY business_id ORDER BY token) AS ord "
    "FROM checkin_tokens), "
    "slots AS (SELECT business_id, ord, dayname(strptime(token, '%Y-%m-%d %H:%M:%S')) AS day, "
    "substring(token, 12, 2) AS hour FROM listed),"
    + ",".join(
        [
            _tops_sql("top_days", "day"),
            _tops_sql("top_hours", "hour"),
            _tops_sql("top_day_hours", "day || '_' || hour || ':00'"),
        ]
    )
    + """ SELECT 'b' || p_partkey AS business_id, coalesce(c.n, 0) AS checkin_count,
                 coalesce(top_days, '') AS top_days, coalesce(top_hours, '') AS top_hours,
                 coalesce(top_day_hours, '') AS top_day_hours
          FROM part LEFT JOIN (SELECT business_id, count(*) AS n FROM listed GROUP BY 1) c
                    ON c.business_id = 'b' || p_partkey
               LEFT JOIN top_days d ON d.business_id = c.business_id
               LEFT JOIN top_hours h ON h.business_id = c.business_id
               LEFT JOIN top_day_hours x ON x.business_id = c.business_id""",
)
def _(w):
    return cleaning.checkin_summary(w.raw_checkins).select(
        "business_id",
        "checkin_count",
        *[F.array_join(kind, "|").alias(kind) for kind in cleaning.TOPS],
    )


@query(
    "clean_businesses",
    """SELECT business_id, name, city, state, stars, review_count, checkin_count,
              array_to_string(categories, '|') AS categories FROM businesses""",
)
def _(w):
    cleaned = cleaning.clean_businesses(w.raw_businesses, cleaning.checkin_stats(w.checkin_tokens))
    return cleaned.drop(*cleaning.TOPS).withColumn("categories", F.array_join("categories", "|"))


@query(
    "clean_users",
    """SELECT user_id, name, review_count, useful, average_stars, yelping_since, is_elite_ever,
              elite_year_count, array_to_string(elite_years, '|') AS elite_years,
              array_to_string(friends, '|') AS friends FROM users""",
)
def _(w):
    cleaned = cleaning.clean_users(w.raw_users)
    return cleaned.withColumn("elite_years", F.array_join("elite_years", "|")).withColumn(
        "friends", F.array_join("friends", "|")
    )


@query(
    "clean_review_and_tip_dates",
    """SELECT 'review' AS kind, business_id, date, count(*) AS n FROM reviews GROUP BY 1, 2, 3
       UNION ALL SELECT 'tip', business_id, date_trunc('second', date), count(*) FROM tips GROUP BY 1, 2, 3""",
)
def _(w):
    text = F.date_format("date", "yyyy-MM-dd HH:mm:ss")
    reviews = cleaning.clean_tips(w.reviews.select("business_id", text.alias("date")))
    tips = cleaning.clean_tips(w.tips.select("business_id", text.alias("date")))
    both = reviews.withColumn("kind", F.lit("review")).unionByName(tips.withColumn("kind", F.lit("tip")))
    return both.groupBy("kind", "business_id", "date").agg(F.count(F.lit(1)).alias("n"))


@query(
    "clean_reviews_text_length",
    "SELECT review_id, CAST(text_length AS INTEGER) AS text_length, date FROM written_reviews",
)
def _(w):
    raw = w.reviews_with_text.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
    return cleaning.clean_reviews(raw).select("review_id", "text_length", "date")


@query(
    "repair_elite",
    """SELECT user_id, is_elite_ever, elite_year_count, array_to_string(elite_years, '|') AS elite_years
       FROM users""",
)
def _(w):
    # Break the flags the way an unguarded split of an empty string does.
    blank = F.size("elite_years") == 0
    broken = (
        w.users.withColumn("is_elite_ever", F.lit(True))
        .withColumn("elite_year_count", F.greatest(F.col("elite_year_count"), F.lit(1)))
        .withColumn("elite_years", F.when(blank, F.array(F.lit(""))).otherwise(F.col("elite_years")))
    )
    return cleaning.repair_elite(broken).select(
        "user_id", "is_elite_ever", "elite_year_count", F.array_join("elite_years", "|").alias("elite_years")
    )


@query(
    "repair_friends",
    """SELECT user_id, CAST(len(friends) AS INTEGER) AS n, array_to_string(friends, '|') AS friends
       FROM users""",
)
def _(w):
    return cleaning.repair_friends(w.raw_users).select(
        "user_id", F.size("friends").alias("n"), F.array_join("friends", "|").alias("friends")
    )


@query("tip_counts", "SELECT business_id, tip_count FROM businesses")
def _(w):
    return cleaning.add_tip_counts(w.businesses, w.tips).select("business_id", "tip_count")


# -- quality -------------------------------------------------------------------------


@query(
    "table_row_counts",
    """SELECT 'businesses' AS name, (SELECT count(*) FROM businesses) AS n_rows
       UNION ALL SELECT 'users', (SELECT count(*) FROM users)
       UNION ALL SELECT 'reviews', (SELECT count(*) FROM reviews)
       UNION ALL SELECT 'tips', (SELECT count(*) FROM tips)""",
)
def _(w):
    return quality.row_counts(
        {"businesses": w.businesses, "users": w.users, "reviews": w.reviews, "tips": w.tips}
    )


@query("graph_row_counts", _sizes)
def _(w):
    return quality.row_counts(w.graph.tables())


def _checks_sql(name: str, source: str, fields: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS name, '{field}' AS field, true AS is_present, '{kind}' AS actual_type,
                   true AS type_ok, count(*) FILTER (WHERE {expression} IS NULL) AS n_missing,
                   count(*) AS n_rows FROM {source}"""
        for field, (kind, expression) in fields.items()
    )


_TEXT, _LONG, _REAL, _LIST, _STAMP = "string", "bigint", "double", "array<string>", "timestamp_ntz"
_visited = "nullif(checkin_count, 0)"


@query(
    "field_checks",
    " UNION ALL ".join(
        [
            _checks_sql(
                "businesses",
                "businesses",
                {
                    "business_id": (_TEXT, "business_id"),
                    "name": (_TEXT, "name"),
                    "city": (_TEXT, "city"),
                    "stars": (_REAL, "stars"),
                    "review_count": (_LONG, "review_count"),
                    "checkin_count": (_LONG, "checkin_count"),
                    "top_days": (_LIST, _visited),
                    "top_hours": (_LIST, _visited),
                    "categories": (_LIST, "categories"),
                },
            ),
            _checks_sql(
                "users",
                "users",
                {
                    "user_id": (_TEXT, "user_id"),
                    "name": (_TEXT, "name"),
                    "yelping_since": (_STAMP, "yelping_since"),
                    "is_elite_ever": ("boolean", "is_elite_ever"),
                    "elite_year_count": ("int", "elite_year_count"),
                    "friends": (_LIST, "friends"),
                },
            ),
            _checks_sql(
                "reviews",
                "written_reviews",
                {
                    "review_id": (_TEXT, "review_id"),
                    "user_id": (_TEXT, "user_id"),
                    "business_id": (_TEXT, "business_id"),
                    "stars": ("int", "stars"),
                    "date": (_STAMP, "date"),
                    "text": (_TEXT, "text_length"),
                },
            ),
            _checks_sql(
                "tips",
                "tips",
                {
                    "user_id": (_TEXT, "user_id"),
                    "business_id": (_TEXT, "business_id"),
                    "text": (_TEXT, "text"),
                    "date": (_STAMP, "date"),
                },
            ),
        ]
    ),
)
def _(w):
    tables = {
        "businesses": w.businesses,
        "users": w.users,
        "reviews": w.reviews_with_text,
        "tips": w.tips,
    }
    return quality.check_tables(tables, schemas.EXPECTED_TABLES)


@query(
    "graph_field_checks",
    " UNION ALL ".join(
        [
            _checks_sql(
                "Business",
                "businesses",
                {
                    "business_id": (_TEXT, "business_id"),
                    "name": (_TEXT, "name"),
                    "stars": (_REAL, "stars"),
                    "review_count": (_LONG, "review_count"),
                },
            ),
            _checks_sql(
                "User",
                "users",
                {
                    "user_id": (_TEXT, "user_id"),
                    "name": (_TEXT, "name"),
                    "review_count": (_LONG, "review_count"),
                    "average_stars": (_REAL, "average_stars"),
                },
            ),
            _checks_sql("Category", "(SELECT DISTINCT category AS name FROM in_category)", {"name": (_TEXT, "name")}),
            _checks_sql("City", "(SELECT DISTINCT city AS name FROM businesses)", {"name": (_TEXT, "name")}),
            _checks_sql("State", "(SELECT DISTINCT state AS code FROM businesses)", {"code": (_TEXT, "code")}),
            _checks_sql("REVIEWED", "reviews", {"stars": ("int", "stars"), "date": (_STAMP, "date")}),
            _checks_sql(
                "TIP_LEFT",
                """(SELECT user_id, business_id, max(date) AS date FROM tips
                    WHERE user_id IN (SELECT user_id FROM users)
                      AND business_id IN (SELECT business_id FROM businesses) GROUP BY 1, 2)""",
                {"date": (_STAMP, "date")},
            ),
        ]
    ),
)
def _(w):
    g = w.graph
    tables = {
        "Business": g.business,
        "User": g.user,
        "Category": g.category,
        "City": g.city,
        "State": g.state,
        "REVIEWED": g.reviewed,
        "TIP_LEFT": g.tip_left,
    }
    return quality.check_tables(tables, {**schemas.EXPECTED_VERTICES, **schemas.EXPECTED_EDGES})


@query(
    "key_violations",
    """SELECT 'lineitem' AS name, count(*) AS n_keys, coalesce(CAST(sum(n - 1) AS BIGINT), 0) AS n_extra_rows
       FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
       UNION ALL SELECT 'businesses', count(*), coalesce(CAST(sum(n - 1) AS BIGINT), 0)
       FROM (SELECT business_id, count(*) AS n FROM businesses GROUP BY 1 HAVING count(*) > 1)
       UNION ALL SELECT 'reviews', count(*), coalesce(CAST(sum(n - 1) AS BIGINT), 0)
       FROM (SELECT review_id, count(*) AS n FROM reviews GROUP BY 1 HAVING count(*) > 1)
       UNION ALL SELECT 'users', count(*), coalesce(CAST(sum(n - 1) AS BIGINT), 0)
       FROM (SELECT user_id, count(*) AS n FROM users GROUP BY 1 HAVING count(*) > 1)""",
)
def _(w):
    return quality.key_violations(
        {
            "lineitem": (w.source("lineitem"), ["l_orderkey", "l_linenumber"]),
            "businesses": (w.businesses, ["business_id"]),
            "reviews": (w.reviews, ["review_id"]),
            "users": (w.users, ["user_id"]),
        }
    )
