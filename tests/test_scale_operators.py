"""Skew, order statistics and sampling: the large-data paths against plain results."""

import hashlib
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from plaudit.operators.embedding import PART_VERTICES, _bundled, _neighbour_sums, fast_rp, pair_products
from plaudit.operators.graph import reviewed
from plaudit.operators.ranking import average_ranks, exact_percentiles, spearman, value_positions
from plaudit.operators.sampling import dense_index, sample_rows, stratified_split
from plaudit.operators.skew import HotKeys, hot_key_join, salted_join
from plaudit.plans.workspace import StoredGraph
from plaudit.session import cut_lineage, shared_folder

FEW = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
# Force the many-values path on tiny data.
RANGED = dict(range_values=5)


@pytest.fixture(scope="module")
def skewed(spark):
    # One key holds half of the rows; some keys have no match.
    return cut_lineage(
        spark.range(2000).select(
            "id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key")
        )
    )


@pytest.fixture(scope="module")
def lookup(spark):
    keys = [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(0, 50, 3)] + [("unused", 0)]
    return spark.createDataFrame(keys, "key string, v int")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_join_equals_plain_join(skewed, lookup, how):
    hot = HotKeys.find(skewed, "key", share=0.1, min_rows=100, fanout=7)
    assert hot.values == ("hot",)
    plain = sorted(map(str, skewed.join(lookup, "key", how).select("id", "key", "v").collect()))
    split = hot.join(skewed, lookup, ["id"], how).select("id", "key", "v")
    assert sorted(map(str, split.collect())) == plain
    salted = salted_join(skewed, lookup, "key", ["id"], how, fanout=5).select("id", "key", "v")
    assert sorted(map(str, salted.collect())) == plain


def test_no_hot_keys_means_a_plain_join(skewed, lookup):
    joined = hot_key_join(skewed, lookup, "key", ["id"])
    assert "__salt" not in joined._jdf.queryExecution().analyzed().toString()


def test_hot_rows_spread_over_salts(skewed, lookup):
    hot = HotKeys("key", ("hot",), fanout=16)
    joined = hot.join(skewed, lookup, ["id"])
    assert joined.filter("key = 'hot'").count() == 2000
    assert "__salt" in joined._jdf.queryExecution().analyzed().toString()


@FEW
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_percentiles_match_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    wanted = [0.0, 0.25, 0.5, 0.8, 1.0]
    expected = np.percentile(values, [p * 100 for p in wanted])
    assert exact_percentiles(df, "v", wanted) == pytest.approx(list(expected))
    assert exact_percentiles(df, "v", wanted, **RANGED) == pytest.approx(list(expected))


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "v int")
    assert exact_percentiles(empty, "v", [0.5]) == [None]


@FEW
@given(st.lists(st.floats(-5, 5).map(lambda x: round(x, 1)), min_size=2, max_size=40))
def test_ranks_match_pandas(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    expected = dict(zip(map(float, values), pd.Series(values, dtype=float).rank()))
    for limits in ({}, RANGED):
        found = {r["value"]: r["rank"] for r in average_ranks(df, "v", **limits).collect()}
        assert {k + 0.0: v for k, v in found.items()} == {k + 0.0: v for k, v in expected.items()}


@FEW
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=3, max_size=40))
def test_spearman_matches_pandas(spark, pairs):
    frame = pd.DataFrame(pairs, columns=["a", "b"])
    df = spark.createDataFrame(pairs, "a int, b int")
    a, b = frame.a.rank(), frame.b.rank()
    found = spearman(df, "a", "b").first()[0]
    if a.std() == 0 or b.std() == 0:
        assert found is None
    else:
        assert found == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-9)


def test_positions_count_a_dominant_value_once(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, 5).otherwise(F.col("id")).alias("v"))
    first = value_positions(df, "v", **RANGED).orderBy("value").first()
    assert (first["value"], first["n"], first["before"]) == (5, 900, 0)


def digest(key, seed):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 137, 500, 900])
def test_sample_is_exact_and_in_hash_order(spark, n):
    df = spark.range(500)
    found = {r.id for r in sample_rows(df, ["id"], n, seed=3).collect()}
    expected = set(sorted(range(500), key=lambda k: digest(k, 3))[:n])
    assert found == expected


def test_no_sample_is_the_whole_table(spark):
    df = spark.range(10)
    assert sample_rows(df, ["id"], None) is df


@pytest.mark.parametrize("limits", [{}, RANGED])
@pytest.mark.parametrize("kind", ["string", "date", "long"])
def test_positions_of_any_type(spark, kind, limits):
    df = spark.range(60).select(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 23).cast("int")).alias("v"))
    df = df.select(F.unix_date("v").cast("long").alias("v") if kind == "long" else F.col("v").cast(kind).alias("v"))
    values = sorted(r["v"] for r in df.collect())
    found = {r["value"]: (r["n"], r["before"]) for r in value_positions(df, "v", **limits).collect()}
    assert found == {v: (values.count(v), values.index(v)) for v in values}


def test_split_is_exact_in_every_stratum(spark):
    df = spark.range(1000).select(
        "id", F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").otherwise(F.lit(None)).alias("s")
    )
    found = stratified_split(df, "s", ["id"], 0.8, seed=1).collect()
    assert len(found) == 1000
    for stratum, size in (("big", 700), ("mid", 200), (None, 100)):
        rows = [r for r in found if r.s == stratum]
        train = {r.id for r in rows if r.is_train}
        assert len(rows) == size and len(train) == int(size * 0.8)
        assert train == set(sorted((r.id for r in rows), key=lambda k: digest(k, 1))[: int(size * 0.8)])


def test_tiny_strata(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, s string")
    found = {r.id: r.is_train for r in stratified_split(df, "s", ["id"], 0.8).collect()}
    assert found[1] is False and sorted((found[2], found[3])) == [False, True]


def test_dense_index_numbers_rows_without_gaps(spark):
    rows = dense_index(spark.range(300), ["id"], 9).collect()
    assert sorted(r["index"] for r in rows) == list(range(300))
    by_index = [r.id for r in sorted(rows, key=lambda r: r["index"])]
    assert by_index == sorted(range(300), key=lambda k: digest(k, 9))


def test_cut_lineage_reads_from_the_shared_folder(spark):
    df = cut_lineage(spark.range(5).select(F.array("id").alias("a"), F.lit("x").alias("b")))
    assert all(name.startswith(("file:", "hdfs:", "/")) and shared_folder(spark).split(":")[-1] in name for name in df.inputFiles())
    assert df.count() == 5 and df.columns == ["a", "b"]


def test_a_graph_table_is_built_without_the_others(spark):
    shops = spark.createDataFrame([("b1", "X"), ("b2", "X"), ("b3", None)], "business_id string, state string")
    # No users, reviews or tips at all: asking for them would fail.
    stored = StoredGraph(SimpleNamespace(businesses=shops))
    assert [r.code for r in stored.state.collect()] == ["X"]
    assert stored.state is stored.state


def test_review_edges_are_sorted_only_after_they_were_dealt_out(spark):
    rows = [("u1", "b1", "r1", 3, "2020-01-01"), ("u1", "b1", "r1", 4, "2020-01-02"), ("u1", "b1", "r1", 5, None), ("u2", "b9", "r2", 1, None)]
    reviews = spark.createDataFrame(rows, "user_id string, business_id string, review_id string, stars int, date string")
    users = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    found = reviewed(reviews, users, spark.createDataFrame([("b1",)], "business_id string"))
    assert [tuple(r) for r in found.select("review_id", "stars", "date").collect()] == [("r1", 4, "2020-01-02")]
    # Partial and final sums lie behind the exchange that deals the rows out.
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.rindex("Aggregate(") < plan.index("REPARTITION_BY_COL")


def test_hubs_have_the_embedding_of_an_undivided_sum(spark):
    pairs = spark.range(300).select(F.lit("hub").alias("src"), F.concat(F.lit("n"), "id").alias("dst"))
    chain = spark.range(299).select(F.concat(F.lit("n"), "id").alias("src"), F.concat(F.lit("n"), F.col("id") + 1).alias("dst"))
    both = pairs.union(chain)
    edges = both.union(both.select("dst", "src"))
    vertices = edges.select(F.col("src").alias("id")).distinct().union(spark.createDataFrame([("alone",)], "id string"))
    plain = {r.id: r.embedding for r in fast_rp(vertices, edges, 8).collect()}
    split = {r.id: r.embedding for r in fast_rp(vertices, edges, 8, share=0.1, min_rows=50).collect()}
    assert plain.keys() == split.keys() and plain["alone"] == [0.0] * 8
    assert any(plain["hub"])
    assert all(abs(a - b) < 1e-9 for key in plain for a, b in zip(plain[key], split[key]))


def test_vectors_travel_once_per_step_and_not_as_sums_by_task(spark):
    steps = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    state = spark.createDataFrame([("a", [1, -1], 1.0), ("b", [0, 1], 1.0)], "id string, v array<int>, norm double")
    found = _neighbour_sums(steps, state, HotKeys("dst", ()), 2)
    assert {r.id: r.v for r in found.collect()} == {"a": [0.0, 1.0], "b": [1.0, -1.0]}
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.rindex("Aggregate(") < plan.index("REPARTITION_BY_COL")


def test_a_vector_is_dealt_once_to_a_part_that_sums_many_of_its_neighbours(spark):
    steps = spark.range(4000).select(F.concat(F.lit("a"), F.col("id")).alias("src"), F.lit("hub").alias("dst"))
    parts = spark.sparkContext.defaultParallelism
    bundles = _bundled(steps, HotKeys("dst", ()), 4001)
    assert bundles.count() <= parts
    assert bundles.agg(F.sum(F.size("ids"))).first()[0] == 4000
    # The list of a hub is cut, and no part holds more vertices than it may.
    cut = _bundled(steps, HotKeys("dst", ("hub",), 4), 4001)
    assert parts < cut.count() <= 4 * parts and cut.agg(F.sum(F.size("ids"))).first()[0] == 4000
    assert _bundled(steps, HotKeys("dst", ()), 20 * PART_VERTICES).agg(F.count_distinct("part")).first()[0] == 20


def test_products_of_pairs_are_made_where_one_end_lies(spark):
    pairs = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, "hub").otherwise(F.concat(F.lit("u"), F.col("id") % 50)).alias("u"),
        F.when(F.col("id") % 4 == 0, "mall").otherwise(F.concat(F.lit("b"), F.col("id") % 70)).alias("b"),
        "id",
    )
    pairs = pairs.unionByName(spark.createDataFrame([(None, "b1", -1), ("u1", None, -2), ("u1", "gone", -3)], "u string, b string, id long"))
    ends = pairs.select(F.col("u").alias("id")).union(pairs.select("b")).distinct().filter("id <> 'gone'")
    vectors = cut_lineage(ends.select("id", F.array(F.length("id") * F.lit(0.5), F.xxhash64("id") % 7 * F.lit(1.0)).alias("embedding")))
    known = {r.id: r.embedding for r in vectors.collect()}
    wanted = {(r.u, r.b, r.id): [x * y for x, y in zip(known[r.u], known[r.b])] for r in pairs.collect() if r.u in known and r.b in known}
    cuts = ((1.0, 1.5), (-3.0, 0.0, 6.0))
    binned = {k: [sum(c < x for c in cut) for cut, x in zip(cuts, v)] for k, v in wanted.items()}
    for limits in ({}, {"share": 0.1, "min_rows": 50}):
        found = pair_products(pairs, vectors, "u", "b", "p", **limits).collect()
        assert len(found) == 600 and {(r.u, r.b, r.id): r.p for r in found} == wanted
        assert {(r.u, r.b, r.id): r.p for r in pair_products(pairs, vectors, "u", "b", "p", cuts, **limits).collect()} == binned
