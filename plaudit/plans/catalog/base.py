"""Registration of queries and the SQL definitions of the entities they use."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plaudit.plans.workspace import Workspace, open_workspace
from plaudit.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The entities in DuckDB SQL, equal row for row to the tables of `Workspace`.
ENTITIES = {
    "reviews": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         strftime(l_shipdate, '%Y%m%d')) AS review_id,
               'u' || o_custkey AS user_id, 'b' || l_partkey AS business_id,
               CAST(1 + floor((l_quantity - 1) / 10) AS INTEGER) AS stars,
               l_shipdate AS date,
               CAST(round(l_discount * 100) AS BIGINT) AS useful,
               l_orderkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "written_reviews": """
        SELECT r.*, d.text_length
        FROM (SELECT *, l_orderkey % (SELECT count(*) FROM documents) AS doc_id FROM reviews) r
             LEFT JOIN (SELECT doc_id, length(text) AS text_length FROM documents) d
               ON d.doc_id = r.doc_id""",
    "checkin_tokens": """
        SELECT 'b' || json_extract_string(props, '$.k') AS business_id,
               epoch_us(ts) AS ord, strftime(ts, '%Y-%m-%d %H:%M:%S') AS token
        FROM events WHERE event_type = 'view'""",
    "tips": """
        SELECT 'u' || user_id AS user_id, 'b' || json_extract_string(props, '$.k') AS business_id,
               ts AS date, props AS text
        FROM events WHERE event_type = 'purchase'""",
    "businesses": """
        SELECT 'b' || p_partkey AS business_id, p_name AS name, n_name AS city, r_name AS state,
               CAST(1.0 + (p_size % 9) * 0.5 AS DOUBLE) AS stars,
               coalesce(rc.n, 0) AS review_count,
               [p_type, p_brand, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)] AS categories,
               coalesce(ci.n, 0) AS checkin_count, coalesce(ti.n, 0) AS tip_count
        FROM part
             JOIN nation ON n_nationkey = p_partkey % 25
             JOIN region ON r_regionkey = n_regionkey
             LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) rc
                    ON rc.l_partkey = p_partkey
             LEFT JOIN (SELECT business_id, count(*) AS n FROM checkin_tokens GROUP BY 1) ci
                    ON ci.business_id = 'b' || p_partkey
             LEFT JOIN (SELECT business_id, count(*) AS n FROM tips GROUP BY 1) ti
                    ON ti.business_id = 'b' || p_partkey""",
    "users": """
        SELECT 'u' || c_custkey AS user_id, c_name AS name,
               coalesce(s.n, 0) AS review_count, coalesce(s.useful, 0) AS useful,
               s.average_stars,
               CAST(DATE '1990-01-01' + CAST((c_custkey * 37) % 1826 AS INTEGER) AS TIMESTAMP)
                   AS yelping_since,
               CASE WHEN c_custkey % 3 = 0 THEN CAST([] AS VARCHAR[])
                    ELSE [CAST(1995 + c_custkey % 5 AS VARCHAR), CAST(1996 + c_custkey % 5 AS VARCHAR)]
               END AS elite_years,
               c_custkey % 3 <> 0 AS is_elite_ever,
               CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 2 END AS elite_year_count,
               CASE WHEN c_custkey % 10 = 0 THEN CAST([] AS VARCHAR[])
                    ELSE ['u' || ((c_custkey * 31 + 7) % n.n), 'u' || ((c_custkey * 17 + 3) % n.n),
                          'u' || ((c_custkey + 25) % n.n)] END AS friends
        FROM customer CROSS JOIN (SELECT count(*) AS n FROM customer) n
             LEFT JOIN (SELECT user_id, count(*) AS n, CAST(sum(useful) AS BIGINT) AS useful,
                               avg(stars) AS average_stars
                        FROM reviews GROUP BY 1) s ON s.user_id = 'u' || c_custkey""",
    "in_category": """
        SELECT DISTINCT business_id, unnest(categories) AS category FROM businesses""",
    "business_category": """
        SELECT * EXCLUDE (categories), unnest(categories) AS category FROM businesses""",
    "friends_with": """
        SELECT DISTINCT f.user_id, f.friend_id
        FROM (SELECT user_id, unnest(friends) AS friend_id FROM users) f
        WHERE f.user_id < f.friend_id AND f.friend_id IN (SELECT user_id FROM users)""",
    "friend_ends": """
        SELECT user_id, friend_id FROM friends_with
        UNION ALL SELECT friend_id, user_id FROM friends_with""",
    "degrees": """
        SELECT u.user_id, count(e.friend_id) AS degree
        FROM users u LEFT JOIN friend_ends e ON e.user_id = u.user_id GROUP BY 1""",
    "part_of": "SELECT DISTINCT city, state FROM businesses",
    "pagerank_weighted": """
        SELECT b.business_id, 0.15 + 0.1275 * coalesce(sum(r.stars / t.s), 0) AS pagerank
        FROM businesses b LEFT JOIN reviews r ON r.business_id = b.business_id
             LEFT JOIN (SELECT user_id, sum(stars) AS s FROM reviews GROUP BY 1) t
                    ON t.user_id = r.user_id GROUP BY 1""",
    "pagerank_plain": """
        SELECT b.business_id, 0.15 + 0.1275 * coalesce(sum(1 / t.s), 0) AS pagerank
        FROM businesses b LEFT JOIN reviews r ON r.business_id = b.business_id
             LEFT JOIN (SELECT user_id, count(*) AS s FROM reviews GROUP BY 1) t
                    ON t.user_id = r.user_id GROUP BY 1""",
}


def with_entities(sql: str) -> str:
    """Prefix a SELECT with the entity definitions it needs, directly or not."""

    def used(text: str) -> set[str]:
        return {name for name in ENTITIES if re.search(rf"\b{name}\b", text)}

    needed, frontier = set(), used(sql)
    while frontier:
        needed |= frontier
        frontier = set().union(*(used(ENTITIES[name]) for name in frontier)) - needed
    if not needed:
        return sql
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({ENTITIES[name]})" for name in ENTITIES if name in needed)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def half_up_sql(value: str, digits: int) -> str:
    """Half-up rounding of the decimal a double prints as, not of its binary neighbour."""
    return f"CAST(round(CAST({value} AS DECIMAL(24, 12)), {digits}) AS DOUBLE)"


def query(name: str, sql: str | None = None):
    """Register a function from a workspace to a DataFrame under a name."""

    def register(build: Callable[[Workspace], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(open_workspace(tune(spark), folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_entities(sql)
        return build

    return register
