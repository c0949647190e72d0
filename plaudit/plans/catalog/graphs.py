"""Graph tables, graph operators and graph reports."""

from pyspark.sql import functions as F

from plaudit.functions.numbers import half_up
from plaudit.operators import centrality, communities, embedding, graph as g
from plaudit.operators.ranking import ranked_areas
from plaudit.operators.similarity import audience_similarity
from plaudit.plans import links, network as n
from plaudit.plans.catalog.base import half_up_sql, query
from plaudit.plans.catalog.reports import ends_sql

# -- vertices and edges --------------------------------------------------------------


@query("user_vertices", "SELECT user_id, name, review_count, average_stars FROM users")
def _(w):
    return w.graph.user


@query("business_vertices", "SELECT business_id, name, stars, review_count FROM businesses")
def _(w):
    return w.graph.business


@query("category_vertices", "SELECT DISTINCT category AS name FROM business_category")
def _(w):
    return w.graph.category


@query("city_vertices", "SELECT DISTINCT city AS name FROM businesses")
def _(w):
    return w.graph.city


@query("state_vertices", "SELECT DISTINCT state AS code FROM businesses")
def _(w):
    return w.graph.state


@query("in_category_edges", "SELECT business_id, category FROM in_category")
def _(w):
    return w.graph.in_category


@query("located_in_edges", "SELECT DISTINCT business_id, city FROM businesses")
def _(w):
    return w.graph.located_in


@query("part_of_edges", "SELECT city, state FROM part_of")
def _(w):
    return w.graph.part_of


@query(
    "reviewed_edges",
    """SELECT user_id, business_id, review_id, stars, date FROM reviews
       WHERE user_id IN (SELECT user_id FROM users)
         AND business_id IN (SELECT business_id FROM businesses)""",
)
def _(w):
    return w.graph.reviewed.select("user_id", "business_id", "review_id", "stars", "date")


@query(
    "tip_left_edges",
    """SELECT user_id, business_id, max(date) AS date FROM tips
       WHERE user_id IN (SELECT user_id FROM users)
         AND business_id IN (SELECT business_id FROM businesses) GROUP BY 1, 2""",
)
def _(w):
    return w.graph.tip_left.select("user_id", "business_id", "date")


@query("friends_with_edges", "SELECT user_id, friend_id FROM friends_with")
def _(w):
    return w.graph.friends_with


@query(
    "friends_with_symmetrised",
    """SELECT DISTINCT least(user_id, friend_id) AS user_id, greatest(user_id, friend_id) AS friend_id
       FROM (SELECT user_id, unnest(friends) AS friend_id FROM users)
       WHERE user_id <> friend_id AND friend_id IN (SELECT user_id FROM users)""",
)
def _(w):
    return g.friends_with(w.users, symmetrise=True)


@query(
    "reviewed_epoch",
    "SELECT review_id, CAST(epoch(date) AS BIGINT) AS timestamp FROM reviews",
)
def _(w):
    return g.with_epoch(w.graph.reviewed).select("review_id", "timestamp")


@query(
    "projection_undirected",
    "SELECT user_id AS src, friend_id AS dst, CAST(1 AS DOUBLE) AS w FROM friend_ends",
)
def _(w):
    return g.project(w.graph.friends_with, "user_id", "friend_id", "undirected")


@query(
    "projection_weighted_until",
    """SELECT user_id AS src, business_id AS dst, CAST(stars AS DOUBLE) AS w FROM reviews
       WHERE date < TIMESTAMP '1998-01-01'""",
)
def _(w):
    until = F.col("date") < F.lit("1998-01-01").cast("timestamp_ntz")
    return g.project(w.graph.reviewed, "user_id", "business_id", weight="stars", where=until)


@query(
    "projection_reversed_city",
    """SELECT r.business_id AS src, r.user_id AS dst, CAST(1 AS DOUBLE) AS w
       FROM reviews r JOIN businesses b ON b.business_id = r.business_id WHERE b.city = 'NATION_3'""",
)
def _(w):
    inside = w.graph.located_in.filter(F.col("city") == "NATION_3")
    local = w.graph.reviewed.join(inside, "business_id", "left_semi")
    return g.project(local, "user_id", "business_id", "reversed")


# -- operators -----------------------------------------------------------------------


@query("friend_degree", "SELECT user_id, degree FROM degrees")
def _(w):
    return centrality.friend_degree(w.graph.user, w.graph.friends_with)


@query(
    "friend_degree_counting_isolated",
    "SELECT user_id, greatest(degree, 1) AS degree FROM degrees",
)
def _(w):
    return centrality.friend_degree(w.graph.user, w.graph.friends_with, isolated=1)


@query(
    "pagerank_weighted",
    "SELECT business_id, round(pagerank, 9) AS pagerank FROM pagerank_weighted",
)
def _(w):
    ranks = centrality.business_pagerank(w.graph.business, w.graph.reviewed, weighted=True)
    return ranks.select("business_id", half_up(F.col("pagerank"), 9).alias("pagerank"))


@query(
    "pagerank_unweighted",
    "SELECT business_id, round(pagerank, 9) AS pagerank FROM pagerank_plain",
)
def _(w):
    ranks = centrality.business_pagerank(w.graph.business, w.graph.reviewed, weighted=False)
    return ranks.select("business_id", half_up(F.col("pagerank"), 9).alias("pagerank"))


SIMILAR = """
    visits AS (SELECT DISTINCT {group} AS grp, r.business_id AS item, r.user_id AS member
               FROM reviews r JOIN businesses b ON b.business_id = r.business_id {where}),
    sizes AS (SELECT grp, item, count(*) AS size FROM visits GROUP BY 1, 2),
    met AS (SELECT a.grp, a.item, b.item AS other, count(*) AS shared
            FROM visits a JOIN visits b ON a.grp = b.grp AND a.member = b.member AND a.item <> b.item
            GROUP BY 1, 2, 3),
    scored AS (SELECT m.grp, m.item, m.other, m.shared,
                      m.shared / (s.size + t.size - m.shared) AS similarity
               FROM met m JOIN sizes s ON s.grp = m.grp AND s.item = m.item
                    JOIN sizes t ON t.grp = m.grp AND t.item = m.other),
    nearest AS (SELECT *, row_number() OVER (PARTITION BY grp, item
                                             ORDER BY similarity DESC, other) AS place FROM scored)"""


@query(
    "audience_similarity",
    "WITH " + SIMILAR.format(group="b.city", where="") + """
    SELECT grp AS "group", item, other, shared, similarity, CAST(place AS INTEGER) AS place
    FROM nearest WHERE place <= 10""",
)
def _(w):
    visits = w.graph.reviewed.join(w.graph.located_in, "business_id").select(
        F.col("city").alias("group"), F.col("business_id").alias("item"), F.col("user_id").alias("member")
    )
    return audience_similarity(visits, 10)


@query("friend_communities")
def _(w):
    return w.communities


@query("community_modularity")
def _(w):
    edges = g.project(w.graph.friends_with, "user_id", "friend_id", "undirected")
    found = w.communities.withColumnRenamed("user_id", "id")
    value = communities.modularity(edges, found)
    return found.agg(F.count_distinct("community").alias("communities")).withColumn(
        "modularity", F.lit(value)
    )


# Breadth-first levels with path counts, then dependencies from the last level back.
BETWEENNESS = """
    steps AS (SELECT user_id AS src, friend_id AS dst FROM friend_ends),
    bfs(source, node, level, paths) USING KEY (source, node) AS (
        SELECT id, id, 0, CAST(1 AS DOUBLE)
        FROM (SELECT user_id AS id FROM users ORDER BY md5('42|' || user_id), user_id LIMIT 250)
        UNION
        SELECT b.source, e.dst, b.level + 1, sum(b.paths)
        FROM bfs b JOIN steps e ON e.src = b.node
        WHERE NOT EXISTS (SELECT 1 FROM recurring.bfs r WHERE r.source = b.source AND r.node = e.dst)
        GROUP BY b.source, e.dst, b.level),
    back(source, node, level, delta, paths) AS (
        SELECT source, node, level, CAST(0 AS DOUBLE), paths FROM bfs
        WHERE level = (SELECT max(level) FROM bfs)
        UNION ALL
        SELECT v.source, v.node, v.level, v.paths * coalesce(c.share, 0), v.paths
        FROM bfs v LEFT JOIN (
            SELECT w.source, e.src AS node, sum((1 + w.delta) / w.paths) AS share
            FROM back w JOIN steps e ON e.dst = w.node GROUP BY 1, 2) c
          ON c.source = v.source AND c.node = v.node
        WHERE v.level = (SELECT max(level) FROM back) - 1),
    central AS (
        SELECT u.user_id AS id, coalesce(sum(CASE WHEN k.level > 0 THEN k.delta END), 0) / 2 AS score
        FROM users u LEFT JOIN back k ON k.node = u.user_id GROUP BY 1)"""


@query(
    "sampled_betweenness",
    f"""SELECT * FROM (WITH RECURSIVE {BETWEENNESS}
        SELECT id, round(score, 6) + 0.0 AS score FROM central)""",
)
def _(w):
    vertices = w.graph.user.select(F.col("user_id").alias("id"))
    edges = g.project(w.graph.friends_with, "user_id", "friend_id", "undirected")
    scores = centrality.betweenness(vertices, edges)
    return scores.select("id", (F.round("score", 6) + F.lit(0.0)).alias("score"))


def _neighbour_means(source: str) -> str:
    """Unit vectors of the means over neighbours, one row per vertex and dimension."""
    return f"""(
        SELECT id, i, CASE WHEN sum(x * x) OVER (PARTITION BY id) > 0
                           THEN x / sqrt(sum(x * x) OVER (PARTITION BY id)) ELSE 0 END AS x
        FROM (SELECT e.src AS id, s.i, avg(s.x) AS x FROM steps e JOIN {source} s ON s.id = e.dst
              GROUP BY 1, 2))"""


_entries = ", ".join(f"max(CASE WHEN i = {i} THEN x END) AS e{i + 1}" for i in range(64))


@query(
    "node_embeddings",
    f"""WITH pairs AS (SELECT DISTINCT user_id, business_id FROM reviews),
        steps AS (SELECT user_id AS src, business_id AS dst FROM pairs
                  UNION ALL SELECT business_id, user_id FROM pairs),
        signs AS (
          SELECT id, i, CASE draw WHEN 0 THEN sqrt(3.0 / 64) WHEN 1 THEN -sqrt(3.0 / 64) ELSE 0.0 END AS x
          FROM (SELECT v.id, d.i,
                       CAST('0x' || substring(md5('42|' || v.id || '|' || d.i), 1, 7) AS BIGINT) % 6 AS draw
                FROM (SELECT DISTINCT src AS id FROM steps) v CROSS JOIN range(64) d(i))),
        one AS {_neighbour_means('signs')}, two AS {_neighbour_means('one')},
        three AS {_neighbour_means('two')},
        summed AS (SELECT a.id, a.i, round(a.x + b.x, 6) + 0.0 AS x
                   FROM two a JOIN three b ON b.id = a.id AND b.i = a.i)
        SELECT id, {_entries} FROM summed GROUP BY 1""",
)
def _(w):
    edges = g.project(w.graph.reviewed, "user_id", "business_id", "undirected")
    vertices = edges.select(F.col("src").alias("id")).distinct()
    vectors = embedding.fast_rp(vertices, edges)
    return vectors.select(
        "id",
        *[
            (F.round(F.element_at("embedding", i), 6) + F.lit(0.0)).alias(f"e{i}")
            for i in range(1, 65)
        ],
    )


@query(
    "hadamard_pairs",
    """SELECT f.user_id, f.friend_id, a.review_count * b.review_count AS reviews,
              a.useful * b.useful AS useful, CAST(a.elite_year_count * b.elite_year_count AS BIGINT) AS elite
       FROM friends_with f JOIN users a ON a.user_id = f.user_id
            JOIN users b ON b.user_id = f.friend_id""",
)
def _(w):
    vectors = w.users.select(
        "user_id", F.array("review_count", "useful", F.col("elite_year_count").cast("long")).alias("v")
    )
    pairs = w.graph.friends_with.join(vectors.withColumnRenamed("v", "left"), "user_id").join(
        vectors.toDF("friend_id", "right"), "friend_id"
    )
    product = pairs.withColumn("v", embedding.hadamard("left", "right"))
    return product.select(
        "user_id",
        "friend_id",
        *[F.element_at("v", i + 1).alias(c) for i, c in enumerate(("reviews", "useful", "elite"))],
    )


# -- reports -------------------------------------------------------------------------


@query(
    "top_connected_users",
    """SELECT u.user_id AS "UserID", u.name AS "Name", d.degree AS "FriendCount",
              u.review_count AS "TotalReviewCount", u.average_stars AS "MeanStarRating"
       FROM degrees d JOIN users u ON u.user_id = d.user_id ORDER BY degree DESC, 1 LIMIT 10""",
)
def _(w):
    return n.top_connected_users(w.graph)


@query(
    "top3_by_state",
    """SELECT state AS "State", CAST(place AS INTEGER) AS place, name AS "Name", city AS "City",
              stars AS "Stars", labels AS "Categories"
       FROM (SELECT p.state, b.name, b.city, b.stars, b.business_id,
                    row_number() OVER (PARTITION BY p.state ORDER BY b.stars DESC, b.business_id) AS place
             FROM businesses b JOIN part_of p ON p.city = b.city WHERE b.review_count >= 30) t
            JOIN (SELECT business_id, string_agg(category, '|' ORDER BY category) AS labels
                  FROM in_category GROUP BY 1) c ON c.business_id = t.business_id
       WHERE place <= 3""",
)
def _(w):
    report = n.top3_by_state(w.graph, min_reviews=30)
    flat = report.select("State", F.posexplode("Top3Businesses").alias("at", "b"))
    return flat.select(
        "State",
        (F.col("at") + 1).alias("place"),
        "b.Name",
        "b.City",
        "b.Stars",
        F.array_join("b.Categories", "|").alias("Categories"),
    )


@query(
    "most_travelled_users",
    """WITH per_city AS (SELECT r.user_id, b.city, avg(r.stars) AS rating
                         FROM reviews r JOIN businesses b ON b.business_id = r.business_id GROUP BY 1, 2),
       leaders AS (SELECT user_id, count(*) AS cities FROM per_city GROUP BY 1
                   ORDER BY cities DESC, user_id LIMIT 10)
       SELECT u.name AS "Name", u.user_id AS "UserID", l.cities AS "NumberOfCities",
              p.city, p.rating AS "avgRating"
       FROM leaders l JOIN users u ON u.user_id = l.user_id JOIN per_city p ON p.user_id = l.user_id""",
)
def _(w):
    report = n.most_travelled_users(w.graph)
    return report.select("Name", "UserID", "NumberOfCities", F.inline("MeanRatingPerCity"))


@query(
    "category_fans",
    f"""SELECT u.user_id AS "UserID", u.name AS "Name", f.n AS "CategoryReviewCount",
              {half_up_sql('f.mean', 2)} AS "CategoryMean",
              {half_up_sql('u.average_stars', 2)} AS "OverallMean",
              {half_up_sql('f.mean - u.average_stars', 2)} AS "RatingDifference"
       FROM (SELECT r.user_id, count(DISTINCT r.business_id) AS n, avg(r.stars) AS mean
             FROM reviews r JOIN in_category c ON c.business_id = r.business_id
             WHERE c.category = 'ECONOMY' GROUP BY 1 HAVING count(DISTINCT r.business_id) >= 5) f
            JOIN users u ON u.user_id = f.user_id ORDER BY f.n DESC, u.user_id LIMIT 50""",
)
def _(w):
    return n.category_fans(w.graph, "ECONOMY")


@query(
    "safest_categories_graph",
    f"""SELECT c.category AS "Category", count(*) AS "NumBusinesses",
              CAST(sum(b.review_count) AS BIGINT) AS "TotalReviews",
              {half_up_sql('avg(b.stars)', 2)} AS "AvgRating"
       FROM in_category c JOIN businesses b ON b.business_id = c.business_id
       GROUP BY 1 HAVING sum(b.review_count) > 2000
       ORDER BY "AvgRating" DESC, "Category" LIMIT 10""",
)
def _(w):
    return n.safest_categories_graph(w.graph, 2000)


_ranked = """ranked AS (
    SELECT b.business_id, b.name AS "Name", round(p.pagerank, 9) AS "PageRank",
           b.review_count AS "ReviewCount", b.stars AS "AvgStars"
    FROM businesses b JOIN pagerank_weighted p ON p.business_id = b.business_id
    WHERE b.review_count > 0 ORDER BY 3 DESC, b.business_id LIMIT {k})"""


@query("pagerank_report", "WITH " + _ranked.format(k=15) + " SELECT * FROM ranked")
def _(w):
    return n.pagerank_report(w.graph)


def _rank(column: str) -> str:
    return (
        f'(rank() OVER (ORDER BY "{column}") + '
        f'(count(*) OVER (PARTITION BY "{column}") - 1) / 2)'
    )


@query(
    "pagerank_spearman",
    "WITH " + _ranked.format(k=1000) + f""",
    ranks AS (SELECT {_rank('PageRank')} AS p, {_rank('ReviewCount')} AS r, {_rank('AvgStars')} AS s
              FROM ranked)
    SELECT 'ReviewCount' AS against, round(corr(p, r), 9) AS spearman FROM ranks
    UNION ALL SELECT 'AvgStars', round(corr(p, s), 9) FROM ranks""",
)
def _(w):
    return n.pagerank_spearman(w.graph).withColumn("spearman", F.round("spearman", 9))


@query("community_geo")
def _(w):
    return n.community_geo(w.graph, w.communities)


# Any partition will do to check the report; this one is the last digit of the user id.
def _geo(states: str) -> str:
    return f"""WITH visits AS (SELECT CAST(right(r.user_id, 1) AS BIGINT) AS community, r.user_id, s.state
                               FROM reviews r JOIN {states} s ON s.business_id = r.business_id),
        counted AS (SELECT community, state, count(*) AS n FROM visits GROUP BY 1, 2),
        top AS (SELECT *, row_number() OVER (PARTITION BY community ORDER BY n DESC, state) AS place,
                       sum(n) OVER (PARTITION BY community) AS total FROM counted),
        heads AS (SELECT community, count(DISTINCT user_id) AS n_members FROM visits GROUP BY 1)
        SELECT t.community AS "CommunityID", CAST(t.total AS BIGINT) AS n_reviews, h.n_members, t.state AS "TopState",
               {half_up_sql('t.n / t.total', 3)} AS "GeoConcentration"
        FROM top t JOIN heads h ON h.community = t.community WHERE t.place = 1 AND t.total >= 25
        ORDER BY "GeoConcentration" DESC, "CommunityID" LIMIT 15"""


def _by_last_digit(w):
    return w.graph.user.select("user_id", F.right("user_id", F.lit(1)).cast("long").alias("community"))


@query(
    "community_geo_of_partition",
    _geo("(SELECT b.business_id, p.state FROM businesses b JOIN part_of p ON p.city = b.city)"),
)
def _(w):
    return n.community_geo(w.graph, _by_last_digit(w))


@query("community_geo_own_state", _geo("(SELECT business_id, state FROM businesses)"))
def _(w):
    return n.community_geo(w.graph, _by_last_digit(w), own_state=w.businesses)


@query("community_convergence")
def _(w):
    """What every round of community detection scored, moved and reached."""
    return w.community_rounds


@query(
    "market_saturation",
    "WITH cities AS (SELECT city FROM businesses GROUP BY 1 HAVING count(*) >= 20 "
    "ORDER BY count(*) DESC, city LIMIT 10), "
    + SIMILAR.format(group="b.city", where="WHERE b.city IN (SELECT city FROM cities)")
    + ", sums AS (SELECT x.grp, c.category, x.similarity, b.name "
    "FROM nearest x JOIN in_category c ON c.business_id = x.item "
    "JOIN in_category d ON d.business_id = x.other AND d.category = c.category "
    "JOIN businesses b ON b.business_id = x.item WHERE x.place <= 50 AND x.shared >= 3), "
    + ends_sql(
        """SELECT grp AS "City", category AS "Category", round(avg(similarity), 9) AS "Mean_Similarity",
                  count(DISTINCT name) AS "Unique_Businesses" FROM sums GROUP BY 1, 2
           HAVING count(DISTINCT name) >= 3""",
        '"Mean_Similarity"',
        '"City", "Category"',
        '"City", "Category", "Mean_Similarity", "Unique_Businesses"',
    ).strip()[5:],
)
def _(w):
    return n.market_saturation(w.graph, min_businesses=3, digits=9)


@query(
    "bridge_users",
    f"""SELECT * FROM (WITH RECURSIVE {BETWEENNESS},
        middle AS (SELECT id FROM central ORDER BY round(score, 9) DESC, id LIMIT 20),
        hubs AS (SELECT user_id AS id FROM degrees ORDER BY degree DESC, user_id LIMIT 20),
        members AS (
          SELECT id, 'bridge' AS side FROM middle WHERE id NOT IN (SELECT id FROM hubs)
          UNION ALL SELECT id, 'hub' FROM hubs),
        sizes AS (SELECT side, count(*) AS n_users FROM members GROUP BY 1)
        SELECT m.side, s.n_users, {half_up_sql('avg(u.review_count)', 1)} AS "MeanReviews",
               {half_up_sql('count(DISTINCT b.city) / s.n_users', 1)} AS "DistinctCities",
               {half_up_sql('count(DISTINCT c.category) / s.n_users', 1)} AS "DistinctCategories",
               CAST((SELECT count(*) FROM middle WHERE id IN (SELECT id FROM hubs)) AS INTEGER) AS overlap
        FROM members m JOIN sizes s ON s.side = m.side JOIN users u ON u.user_id = m.id
             JOIN reviews r ON r.user_id = m.id JOIN businesses b ON b.business_id = r.business_id
             LEFT JOIN in_category c ON c.business_id = r.business_id
        GROUP BY m.side, s.n_users)""",
)
def _(w):
    return n.bridge_users(w.graph)


@query(
    "hub_group_stats_per_user",
    f"""WITH hubs AS (SELECT user_id FROM degrees ORDER BY degree DESC, user_id LIMIT 20)
       SELECT 'hub' AS side, 20::BIGINT AS n_users,
              (SELECT {half_up_sql('avg(u.review_count)', 1)} FROM hubs h JOIN users u ON u.user_id = h.user_id
               WHERE h.user_id IN (SELECT user_id FROM reviews)) AS "MeanReviews",
              round(count(DISTINCT b.city) / 20, 1) AS "DistinctCities",
              round(count(DISTINCT c.category) / 20, 1) AS "DistinctCategories"
       FROM hubs h JOIN reviews r ON r.user_id = h.user_id
            JOIN businesses b ON b.business_id = r.business_id
            LEFT JOIN in_category c ON c.business_id = r.business_id""",
)
def _(w):
    degrees = centrality.friend_degree(w.graph.user, w.graph.friends_with)
    hubs = n.top_k(degrees, "degree", ["user_id"], 20).select("user_id", F.lit("hub").alias("side"))
    return n.group_stats(w.graph, hubs, mean_on="users")


@query(
    "hub_group_stats",
    """WITH hubs AS (SELECT user_id FROM degrees ORDER BY degree DESC, user_id LIMIT 20)
       SELECT 'hub' AS side, 20::BIGINT AS n_users,
              round(avg(u.review_count), 1) AS "MeanReviews",
              round(count(DISTINCT b.city) / 20, 1) AS "DistinctCities",
              round(count(DISTINCT c.category) / 20, 1) AS "DistinctCategories"
       FROM hubs h JOIN users u ON u.user_id = h.user_id JOIN reviews r ON r.user_id = h.user_id
            JOIN businesses b ON b.business_id = r.business_id
            LEFT JOIN in_category c ON c.business_id = r.business_id""",
)
def _(w):
    degrees = centrality.friend_degree(w.graph.user, w.graph.friends_with)
    hubs = n.top_k(degrees, "degree", ["user_id"], 20).select("user_id", F.lit("hub").alias("side"))
    return n.group_stats(w.graph, hubs)


# -- link prediction -----------------------------------------------------------------


@query(
    "split_moment",
    "SELECT quantile_cont(CAST(epoch(date) AS BIGINT), 0.8) AS moment FROM reviews",
)
def _(w):
    return links.split_moment(w.graph.reviewed)


@query(
    "ranked_areas",
    """WITH c AS (SELECT useful AS score, count(*) FILTER (WHERE stars >= 4) AS p, count(*) FILTER (WHERE stars < 4) AS n
                  FROM reviews GROUP BY 1),
       t AS (SELECT *, sum(p) OVER () AS total_p, sum(n) OVER () AS total_n,
                    sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS fp FROM c),
       x AS (SELECT *, tp / (tp + fp) AS here,
                    CASE WHEN tp - p + fp - n > 0 THEN (tp - p) / (tp - p + fp - n) ELSE tp / (tp + fp) END AS before FROM t)
       SELECT CAST(max(total_p) AS BIGINT) AS n_positive, CAST(max(total_n) AS BIGINT) AS n_negative,
              round(sum(p * (total_n - fp + n / 2)) / (max(total_p) * max(total_n)), 9) AS auc_roc,
              round(sum(p * (here + before) / 2) / max(total_p), 9) AS auc_pr FROM x""",
)
def _(w):
    scored = w.reviews.select("useful", (F.col("stars") >= 4).cast("int").alias("liked"))
    found = ranked_areas(scored, "useful", "liked", range_values=3)
    return found.withColumns({c: F.round(c, 9) for c in ("auc_roc", "auc_pr")})


@query(
    "audience_recommendations",
    "WITH " + SIMILAR.format(group="'all'", where="") + """,
    people AS (SELECT user_id FROM users WHERE review_count > 30 AND review_count < 200),
    theirs AS (SELECT DISTINCT user_id, business_id FROM reviews WHERE user_id IN (SELECT user_id FROM people)),
    ways AS (SELECT t.user_id, x.other AS business_id, round(sum(x.similarity), 9) AS score, count(*) AS n_paths
             FROM theirs t JOIN nearest x ON x.item = t.business_id AND x.place <= 10
                  JOIN businesses b ON b.business_id = x.other AND b.review_count > 20
             WHERE NOT EXISTS (SELECT 1 FROM theirs o WHERE o.user_id = t.user_id AND o.business_id = x.other)
             GROUP BY 1, 2)
    SELECT user_id, business_id, score, n_paths, CAST(place AS INTEGER) AS place FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, business_id) AS place FROM ways)
    WHERE place <= 3""",
)
def _(w):
    return links.audience_recommendations(w.graph, low=30, high=200, min_reviews=20).select(*links.PAIR, "score", "n_paths", "place")


@query("link_prediction_metrics")
def _(w):
    return w.link_model.metrics()


@query("link_feature_importance")
def _(w):
    return w.link_model.importances()


@query("recommendations")
def _(w):
    return links.recommendations(w.graph, w.link_model, low=30, high=200, min_reviews=20)
