"""Graph operators against brute force on small graphs."""

import itertools
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plaudit.operators import centrality, communities, embedding, graph as g, similarity
from plaudit.operators.similarity import audience_similarity
from plaudit.plans import links, network

# Treat every key above two rows as hot.
HOT = dict(share=0.0, min_rows=2, fanout=3)

BUSINESS = "business_id string, name string, city string, state string, categories array<string>, stars double, review_count long"
USER = "user_id string, name string, review_count long, average_stars double, friends array<string>"
REVIEW = "review_id string, user_id string, business_id string, stars int, date timestamp_ntz"
TIP = "user_id string, business_id string, date timestamp_ntz"


@pytest.fixture(scope="module")
def small(spark):
    """A city name in two states, a one-sided friendship, parallel reviews, unknown ends."""
    businesses = spark.createDataFrame(
        [
            ("b1", "One", "Springfield", "IL", ["Mexican", "Bars"], 4.0, 60),
            ("b2", "Two", "Springfield", "MA", ["Mexican"], 5.0, 70),
            ("b3", "Three", "Boston", "MA", None, 3.0, 10),
        ],
        BUSINESS,
    )
    users = spark.createDataFrame(
        [
            ("u1", "Ann", 4, 4.0, ["u2", "ghost", ""]),
            ("u2", "Bob", 2, 3.0, ["u1", "None"]),
            ("u3", "Cyd", 1, 2.0, ["u1"]),
            ("u4", "Dee", 0, None, []),
        ],
        USER,
    )
    reviews = spark.createDataFrame(
        [("r1", "u1", "b1", 5, None), ("r2", "u1", "b1", 3, None), ("r3", "u1", "b2", 4, None),
         ("r4", "u2", "b2", 2, None), ("r5", "u3", "b3", 1, None), ("r6", "nobody", "b1", 1, None),
         ("r7", "u1", "nowhere", 1, None), ("r1", "u1", "b1", 5, None)],
        REVIEW,
    ).withColumn("date", F.lit("2020-01-01").cast("timestamp_ntz"))
    tips = spark.createDataFrame([("u1", "b1", None), ("u1", "b1", None), ("nobody", "b1", None)], TIP)
    days = F.date_add(F.lit("2020-01-01").cast("date"), F.monotonically_increasing_id().cast("int") % 9)
    return g.Graph.build(businesses, users, reviews, tips.withColumn("date", days.cast("timestamp_ntz")))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_edges(small):
    assert rows(small.friends_with) == [("u1", "u2")]
    assert small.reviewed.count() == 5
    assert small.tip_left.count() == 1
    assert rows(small.part_of) == [("Boston", "MA"), ("Springfield", "IL"), ("Springfield", "MA")]
    assert rows(small.in_category) == [("b1", "Bars"), ("b1", "Mexican"), ("b2", "Mexican")]
    assert small.category.count() == 2 and small.state.count() == 2 and small.city.count() == 2


def test_one_sided_friendship_needs_symmetrise(spark):
    users = spark.createDataFrame([("u1", "A", 0, 0.0, []), ("u3", "C", 0, 0.0, ["u1"])], USER)
    assert g.friends_with(users).isEmpty()
    assert rows(g.friends_with(users, symmetrise=True)) == [("u1", "u3")]


def test_degree_of_isolated_users(small):
    plain = dict(rows(centrality.friend_degree(small.user, small.friends_with)))
    faithful = dict(rows(centrality.friend_degree(small.user, small.friends_with, isolated=1)))
    assert plain == {"u1": 1, "u2": 1, "u3": 0, "u4": 0}
    assert faithful["u4"] == 1


def test_ambiguous_city_counts_in_both_states(small, spark):
    shared = {r.State: [b.Name for b in r.Top3Businesses] for r in network.top3_by_state(small).collect()}
    assert shared == {"IL": ["Two", "One"], "MA": ["Two", "One"]}
    own = spark.createDataFrame([("b1", "IL"), ("b2", "MA"), ("b3", "MA")], "business_id string, state string")
    strict = {r.State: [b.Name for b in r.Top3Businesses] for r in network.top3_by_state(small, own_state=own).collect()}
    assert strict == {"IL": ["One"], "MA": ["Two"]}


def test_fans_count_distinct_businesses(small):
    fan = network.category_fans(small, min_businesses=2).first()
    assert (fan.UserID, fan.CategoryReviewCount, fan.CategoryMean, fan.RatingDifference) == ("u1", 2, 4.0, 0.0)


def test_travellers(small):
    first = network.most_travelled_users(small, 1, **HOT).first()
    assert (first.UserID, first.NumberOfCities) == ("u1", 1)
    assert [tuple(c) for c in first.MeanRatingPerCity] == [("Springfield", 4.0)]


def test_group_stats_weigh_rows_by_category(small, spark):
    members = spark.createDataFrame([("u1", "x"), ("u3", "x")], "user_id string, side string")
    row = network.group_stats(small, members, **HOT).first()
    # Rows: u1-b1 twice over two categories, u1-b2 once, u3-b3 without category once.
    assert row.MeanReviews == round((4 * 4 + 4 + 1) / 6, 1)
    assert (row.DistinctCities, row.DistinctCategories, row.n_users) == (1.0, 1.0, 2)


def test_community_geo_fans_out_over_states(small, spark):
    groups = spark.createDataFrame([("u1", "c"), ("u2", "c"), ("u3", "d")], "user_id string, community string")
    found = {r.CommunityID: r for r in network.community_geo(small, groups, min_size=1, **HOT).collect()}
    assert (found["c"].n_reviews, found["c"].n_members, found["c"].TopState) == (8, 2, "IL")
    assert found["c"].GeoConcentration == 0.5
    by_members = network.community_geo(small, groups, min_size=2, size_on="n_members")
    assert [r.CommunityID for r in by_members.collect()] == ["c"]


def random_edges(n, m, seed):
    rng = random.Random(seed)
    pairs = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(m)}
    return [(f"n{a}", f"n{b}") for a, b in pairs]


def undirected(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    return g.project(df, "a", "b", "undirected")


def reference_pagerank(nodes, edges, rounds, d=0.85):
    out = defaultdict(float)
    for s, _, w in edges:
        out[s] += w
    rank = {v: 1 - d for v in nodes}
    for _ in range(rounds):
        fresh = {v: 1 - d for v in nodes}
        for s, t, w in edges:
            fresh[t] += d * rank[s] * w / out[s]
        rank = fresh
    return rank


@pytest.mark.parametrize("limits", [{}, HOT])
def test_pagerank_on_a_general_graph(spark, limits):
    rng = random.Random(5)
    nodes = [f"n{i}" for i in range(12)]
    edges = [(rng.choice(nodes[:4]), rng.choice(nodes), float(rng.randint(1, 5))) for _ in range(40)]
    df = spark.createDataFrame(edges, "src string, dst string, w double")
    vertices = spark.createDataFrame([(v,) for v in nodes], "id string")
    found = dict(rows(centrality.pagerank(vertices, df, iterations=3, tolerance=0.0, **limits)))
    expected = reference_pagerank(nodes, edges, 3)
    assert found == pytest.approx(expected)


def brute_betweenness(nodes, pairs, sources):
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    score = dict.fromkeys(nodes, 0.0)
    for s in sources:
        level, paths, order = {s: 0}, defaultdict(float, {s: 1.0}), [s]
        for v in order:
            for w in sorted(near[v]):
                if w not in level:
                    level[w] = level[v] + 1
                    order.append(w)
                if level[w] == level[v] + 1:
                    paths[w] += paths[v]
        for t in order:
            if t == s:
                continue
            # Paths from s to t through v, counted by walking back from t.
            through = defaultdict(float, {t: 1.0})
            for v in reversed(order):
                for w in near[v]:
                    if level.get(w) == level[v] - 1 and through[v]:
                        through[w] += through[v] * paths[w] / paths[v]
            for v in order:
                if v not in (s, t):
                    score[v] += through[v]
    return {v: x / 2 for v, x in score.items()}


@pytest.mark.parametrize("limits", [{}, HOT])
def test_betweenness_with_all_sources_is_exact(spark, limits):
    pairs = random_edges(10, 14, 3)
    nodes = [f"n{i}" for i in range(10)]
    vertices = spark.createDataFrame([(v,) for v in nodes], "id string")
    found = dict(rows(centrality.betweenness(vertices, undirected(spark, pairs), None, **limits)))
    assert found == pytest.approx(brute_betweenness(nodes, pairs, nodes))


def test_sampled_betweenness_uses_only_its_sources_in_any_batching(spark):
    pairs = random_edges(12, 16, 8)
    nodes = [f"n{i}" for i in range(12)]
    vertices = spark.createDataFrame([(v,) for v in nodes], "id string")
    sources = [r.id for r in centrality.sampled_sources(vertices, 4).collect()]
    expected = brute_betweenness(nodes, pairs, sources)
    for batch in (4, 2):
        found = dict(rows(centrality.betweenness(vertices, undirected(spark, pairs), 4, batch)))
        assert found == pytest.approx(expected)


def test_betweenness_keeps_one_row_per_vertex_for_all_sources(spark, monkeypatch):
    sizes, cut = [], centrality.cut_lineage
    monkeypatch.setattr(centrality, "cut_lineage", lambda df, label: sizes.append((label, (made := cut(df, label)).count())) or made)
    nodes = ["hub", *[f"n{i}" for i in range(9)]]
    vertices = spark.createDataFrame([(v,) for v in nodes], "id string")
    pairs = [("hub", v) for v in nodes[1:]]
    found = dict(rows(centrality.betweenness(vertices, undirected(spark, pairs), None, 10, share=0.01, min_rows=2)))
    assert found == pytest.approx(brute_betweenness(nodes, pairs, nodes))
    # Ten sources reach ten vertices each; a level had a row for every source and vertex.
    assert max(n for label, n in sizes if label in ("level", "delta")) == 10


def test_a_vertex_may_go_on_in_the_next_batch():
    def batch(*rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64())))],
            ["node", "role", "at", "value"],
        )

    sent, known, past = centrality.SENT, centrality.KNOWN, centrality.PAST
    batches = [
        batch(("a", sent, [0, 1], [1.0, 2.0]), ("b", sent, [0, 2], [1.0, 1.0])),
        batch(("b", sent, [2, 1], [3.0, 1.0])),
        batch(("b", known, [0], [1.0]), ("b", past, [1], [1.0]), ("c", known, [0], [1.0])),
    ]
    made = [r for b in centrality._met(3, centrality._ahead)(iter(batches)) for r in b.to_pylist()]
    assert [(r["node"], r["at"], r["value"]) for r in made] == [("a", [0, 1], [1.0, 2.0]), ("b", [2], [4.0]), ("c", [], [])]


def test_louvain_separates_cliques(spark):
    cliques = [[f"a{i}" for i in range(5)], [f"b{i}" for i in range(5)], [f"c{i}" for i in range(4)]]
    pairs = [p for c in cliques for p in itertools.combinations(c, 2)] + [("a0", "b0"), ("b1", "c0")]
    edges = undirected(spark, pairs)
    nodes = [v for c in cliques for v in c] + ["alone"]
    vertices = spark.createDataFrame([(v,) for v in nodes], "id string")
    found = communities.louvain(vertices, edges, **HOT)
    groups = defaultdict(set)
    for v, c in rows(found):
        groups[c].add(v)
    assert sorted(map(sorted, groups.values())) == sorted([sorted(c) for c in cliques] + [["alone"]])
    alone = vertices.withColumn("community", F.col("id"))
    assert communities.modularity(edges, found) > communities.modularity(edges, alone)


def test_louvain_rounds_send_nothing_through_the_driver(spark, monkeypatch):
    plans, cut = [], communities.cut_lineage
    monkeypatch.setattr(communities, "cut_lineage", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df, label))
    edges = undirected(spark, [(f"{c}{i}", f"{c}{j}") for c in "ab" for i, j in itertools.combinations(range(4), 2)] + [("a0", "b0")])
    communities.louvain(edges.select(F.col("src").alias("id")).distinct(), edges)
    assert len(plans) > 5 and any("SortMergeJoin" in p for p in plans)
    assert not any("BroadcastHashJoin" in p or "BroadcastExchange" in p for p in plans)


def brute_similarity(visits, k):
    audience = defaultdict(set)
    for group, item, member in visits:
        audience[group, item].add(member)
    result = set()
    for (group, item), mine in audience.items():
        others = []
        for (other_group, other), theirs in audience.items():
            shared = len(mine & theirs)
            if other_group == group and other != item and shared:
                others.append((-shared / len(mine | theirs), other, shared))
        for place, (value, other, shared) in enumerate(sorted(others)[:k], 1):
            result.add((group, item, other, shared, round(-value, 9), place))
    return result


@pytest.mark.parametrize("long_list, block", [(10**6, 8), (5, 2), (5, 100), (2, 3)])
@pytest.mark.parametrize("k", [2, 5])
def test_similarity_with_hot_members_is_exact(spark, k, long_list, block):
    rng = random.Random(k)
    visits = []
    for group in "xy":
        for i in range(40):
            members = rng.sample(range(20), rng.randint(1, 4))
            # Two members visit almost everything.
            members += [100] * (rng.random() < 0.9) + [101] * (rng.random() < 0.7)
            visits += [(group, f"i{i}", f"m{m}") for m in members]
    visits += visits[:5]
    df = spark.createDataFrame(visits, "group string, item string, member string")
    found = audience_similarity(df, k, long_list, block)
    got = {(r.group, r.item, r.other, r.shared, round(r.similarity, 9), r.place) for r in found.collect()}
    assert got == brute_similarity(visits, k)


def test_hot_member_emits_no_pairs_of_its_own(spark):
    # One member visits everything: 300 items, all pairs would be 44,850.
    visits = spark.range(300).select(
        F.lit("g").alias("group"), F.concat(F.lit("i"), "id").alias("item"), F.lit("hub").alias("member")
    )
    found = audience_similarity(visits, 3, long_list=50)
    assert found.count() == 900
    assert found.agg(F.min("similarity")).first()[0] == 1.0


@pytest.mark.parametrize("copies", [True, False])
def test_many_long_lists_emit_few_pairs(spark, monkeypatch, copies):
    """40 lists of some 600 items: 7.2 million pairs on them, 14.4 million in both directions."""
    rng = random.Random(3)
    visits = []
    if copies:
        visits = [("g", f"i{item:04}", f"m{member:02}") for member in range(40) for item in range(600)]
    else:
        # Chains of shops, each with a public of its own.
        publics = [[(chain * 8 + n) * 7 % 40 for n in range(8)] for chain in range(25)]
        for item in range(4000):
            visits += [("g", f"i{item:04}", f"m{member:02}") for member in rng.sample(publics[item % 25], 6)]
    for item in range(4000):
        # Most audiences are larger than their part on long lists.
        visits += [("g", f"i{item:04}", f"own{item}-{i}") for i in range(rng.randint(0, 3))]
    seen = []
    score = similarity._scored

    def counting(pairs, items):
        seen.append(pairs.count())
        return score(pairs, items)

    monkeypatch.setattr(similarity, "_scored", counting)
    rows = audience_similarity(spark.createDataFrame(visits, "group string, item string, member string"), 5).collect()
    assert sum(seen) < 1_000_000
    audience = defaultdict(set)
    for _, item, member in visits:
        audience[item].add(member)
    shared = np.array([[m in audience[i] for m in (f"m{n:02}" for n in range(40))] for i in sorted(audience)], int)
    size = np.array([len(audience[i]) for i in sorted(audience)])
    names = sorted(audience)
    common = shared @ shared.T
    np.fill_diagonal(common, 0)
    value = common / (size[:, None] + size[None] - common)
    want = set()
    for i, name in enumerate(names):
        best = np.lexsort((np.arange(len(names)), -value[i]))[:5]
        want |= {(name, names[j], int(common[i, j]), place) for place, j in enumerate(best, 1) if common[i, j]}
    assert {(r.item, r.other, r.shared, r.place) for r in rows} == want


def test_embeddings_average_neighbours(spark):
    edges = undirected(spark, [("a", "b"), ("a", "c")])
    vertices = spark.createDataFrame([("a",), ("b",), ("c",), ("z",)], "id string")
    found = {r.id: r.embedding for r in embedding.fast_rp(vertices, edges, 8, (1.0,), **HOT).collect()}
    signs = {r.id: r.v for r in vertices.select("id", embedding.sign_vector(F.col("id"), 8, 42).alias("v")).collect()}
    mean = [(x + y) / 2 for x, y in zip(signs["b"], signs["c"])]
    norm = sum(x * x for x in mean) ** 0.5 or 1.0
    assert found["a"] == pytest.approx([x / norm for x in mean])
    assert found["z"] == [0.0] * 8
    assert found["b"] == found["c"]


def test_sign_vectors_are_sparse_and_balanced(spark):
    vector = embedding.sign_vector(F.col("id").cast("string"), 16, 1)
    values = spark.range(500).select(F.explode(vector).alias("x")).groupBy("x").count().collect()
    share = {round(r.x, 6): r["count"] / 8000 for r in values}
    size = round((3 / 16) ** 0.5, 6)
    assert share[0.0] == pytest.approx(2 / 3, abs=0.03)
    assert share[size] == pytest.approx(1 / 6, abs=0.03) and share[-size] == pytest.approx(1 / 6, abs=0.03)


def test_negatives_are_unlinked_and_not_a_product(spark):
    linked = spark.range(400).select(
        F.concat(F.lit("u"), F.col("id") % 40).alias("user_id"),
        F.concat(F.lit("b"), F.col("id") % 37).alias("business_id"),
    ).distinct()
    negatives = links.shuffled_negatives(linked, linked, 1)
    assert negatives.join(linked, links.PAIR).isEmpty()
    assert 0 < negatives.count() <= linked.count()
    people = linked.select("user_id").distinct()
    shops = linked.select("business_id").distinct()
    drawn = links.drawn_negatives(people, shops, linked, 200, 1)
    assert drawn.join(linked, links.PAIR).isEmpty() and 0 < drawn.count() <= 200
    for df in (negatives, drawn):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_louvain_shrinks_its_frontier_and_keeps_communities_connected(spark):
    # A hub that knows everybody, next to rings of cliques.
    cliques = [[f"v{c}_{i}" for i in range(4)] for c in range(6)]
    pairs = [p for c in cliques for p in itertools.combinations(c, 2)] + [(c[0], d[1]) for c, d in zip(cliques, cliques[1:])]
    pairs += [("hub", v) for c in cliques for v in c]
    vertices = spark.createDataFrame([(v,) for v in {x for p in pairs for x in p}], "id string")
    rounds = communities.Convergence()
    found = communities.louvain(vertices, undirected(spark, pairs), convergence=rounds, **HOT)
    group = dict(rows(found))
    assert all(len({group[v] for v in c}) == 1 for c in cliques)
    scored = [r.active for r in rounds.table(spark).collect() if r.phase == "rise" and r.level == 0]
    assert scored[0] == 25 and min(scored) < 25
    best = max(r.modularity for r in rounds.table(spark).collect())
    assert communities.modularity(undirected(spark, pairs), found) >= best - 1e-9
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    for name in set(group.values()):
        members = {v for v in group if group[v] == name}
        reached, open_ = set(), [min(members)]
        while open_:
            v = open_.pop()
            if v not in reached:
                reached.add(v)
                open_ += near[v] & members
        assert reached == members


def test_whole_edges_are_dealt_out_once(spark):
    name = lambda letter, n: F.concat(F.lit(letter), F.col("id") % n)
    reviews = spark.range(6000).select(
        F.concat(F.lit("r"), "id").alias("review_id"), name("u", 700).alias("user_id"), name("b", 900).alias("business_id"),
        F.lit(4).alias("stars"), F.lit("2020-01-01").cast("date").alias("date"),
    )
    users = spark.range(10, 5000).select(name("u", 10000).alias("user_id"))
    shops = spark.range(20, 5000).select(name("b", 10000).alias("business_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        edges = g.reviewed(reviews, users, shops)
        plan = edges._jdf.queryExecution().executedPlan().toString()
        kept = edges.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert kept == sum(i % 700 >= 10 and i % 900 >= 20 for i in range(6000))
    assert plan.count("Exchange hashpartitioning") == 1
