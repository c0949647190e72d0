"""Raw JSON to tables: edge cases of every input, repairs, sinks, streaming."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from plaudit.operators import cleaning, quality
from plaudit.plans.etl import run_etl, run_graph_build
from plaudit.sources import documents, files, schemas
from plaudit.streaming.ingest import ingest_folder

RAW = {
    "business": [
        {"business_id": "b1", "name": "One", "city": "X", "state": "PA", "stars": 4.5, "review_count": 2,
         "categories": "Bars, Mexican", "attributes": {"WiFi": "free"}, "hours": {"Monday": "9:0-17:0"}},
        {"business_id": "b2", "name": "Two", "city": "X", "state": "PA", "stars": 3.0, "review_count": 1, "categories": None},
    ],
    "user": [
        {"user_id": "u1", "name": "Ann", "review_count": 2, "useful": 3, "average_stars": 4.0,
         "yelping_since": "2010-02-03 04:05:06", "elite": "2012,2013", "friends": "u2, u9"},
        {"user_id": "u2", "name": "Bob", "review_count": 1, "useful": 0, "average_stars": 2.0,
         "yelping_since": "never", "elite": "", "friends": "None"},
    ],
    "review": [
        {"review_id": "r1", "user_id": "u1", "business_id": "b1", "stars": 5.0, "useful": 2, "text": "né😀", "date": "2012-05-01 10:00:00"},
        {"review_id": "r2", "user_id": "u2", "business_id": "b1", "stars": 2.0, "useful": 0, "text": None, "date": "bad"},
        {"review_id": "r3", "user_id": "u1", "business_id": "b2", "stars": 3.0, "useful": 1, "text": "", "date": "2015-05-01 10:00:00"},
    ],
    "tip": [
        {"user_id": "u1", "business_id": "b1", "text": "go", "date": "2012-05-01 10:00:00", "compliment_count": 0},
        {"user_id": "u1", "business_id": "b1", "text": "again", "date": "2013-05-01 10:00:00", "compliment_count": 1},
    ],
    "checkin": [
        {"business_id": "b1", "date": "2016-04-26 19:49:16, 2016-04-27 19:00:00, oops, 2016-05-03 08:00:00"},
        {"business_id": "b2", "date": ""},
    ],
}


@pytest.fixture()
def raw(tmp_path):
    for name, records in RAW.items():
        (tmp_path / f"{name}.json").write_text("".join(json.dumps(r) + "\n" for r in records), encoding="utf-8")
    return tmp_path


def test_whole_etl(spark, raw, tmp_path):
    paths = run_etl(spark, str(raw), str(tmp_path / "out"))
    b = {r.business_id: r for r in spark.read.parquet(paths["businesses"]).collect()}
    assert b["b1"].categories == ["Bars", "Mexican"] and b["b2"].categories is None
    assert (b["b1"].checkin_count, b["b2"].checkin_count) == (4, 0)
    assert b["b1"].top_days == ["Tuesday", "Wednesday"] and b["b1"].top_hours == ["19", "08"]
    assert b["b1"].top_day_hours == ["Tuesday_19:00", "Wednesday_19:00", "Tuesday_08:00"]
    assert b["b2"].top_days == [] and (b["b1"].tip_count, b["b2"].tip_count) == (2, 0)
    assert b["b1"].attributes == {"WiFi": "free"}
    u = {r.user_id: r for r in spark.read.parquet(paths["users"]).collect()}
    assert u["u1"].elite_years == ["2012", "2013"] and u["u1"].is_elite_ever and u["u1"].elite_year_count == 2
    assert u["u2"].elite_years == [] and not u["u2"].is_elite_ever and u["u2"].friends == []
    assert u["u1"].yelping_since == dt.datetime(2010, 2, 3, 4, 5, 6) and u["u2"].yelping_since is None
    assert "elite" not in u["u1"].asDict()
    r = {x.review_id: x for x in spark.read.parquet(paths["reviews"]).collect()}
    assert (r["r1"].text_length, r["r2"].text_length, r["r3"].text_length) == (3, None, 0)
    assert r["r2"].date is None
    graph = run_graph_build(spark, str(tmp_path / "out"), str(tmp_path / "graph"))
    counts = {x.name: x.n_rows for x in quality.row_counts(graph.tables()).collect()}
    assert counts == {"user": 2, "business": 2, "category": 2, "city": 1, "state": 1, "reviewed": 3,
                      "tip_left": 1, "in_category": 2, "located_in": 2, "part_of": 1, "friends_with": 1}
    edges = {x.review_id: (x.stars, x.date) for x in graph.reviewed.collect()}
    assert edges["r2"] == (2.0, None) and edges["r1"][0] == 5.0
    assert graph.tip_left.first().date == dt.datetime(2013, 5, 1, 10)
    checks = quality.check_tables(
        {name: spark.read.parquet(path) for name, path in paths.items()}, schemas.EXPECTED_TABLES
    )
    assert checks.filter("NOT is_present OR NOT type_ok").isEmpty()
    missing = {(x.name, x.field): x.n_missing for x in checks.collect()}
    assert missing["users", "yelping_since"] == 1 and missing["reviews", "text"] == 1


def test_equal_counts_keep_first_appearance(spark):
    # Thursday, Friday, Monday, Sunday once each, in this order.
    raw = spark.createDataFrame(
        [("b", "2020-01-02 01:00:00, 2020-01-03 01:00:00, 2020-01-06 02:00:00, 2020-01-05 03:00:00")],
        schemas.RAW_CHECKIN,
    )
    row = cleaning.checkin_summary(raw).first()
    assert row.top_days == ["Thursday", "Friday", "Monday"]
    assert row.top_hours == ["01", "02", "03"]


def test_malformed_json_fails(spark, tmp_path):
    (tmp_path / "tip.json").write_text('{"user_id": "u"}\n{broken\n')
    with pytest.raises(Exception):
        files.scan_json_lines(spark, str(tmp_path / "tip.json"), schemas.RAW_TIP).collect()


def test_heads(spark, raw, tmp_path):
    written = files.extract_heads(spark, str(raw), str(tmp_path / "head"), 2)
    assert len(written) == 5
    lines = [r.value for r in spark.read.text(str(tmp_path / "head" / "review.json_head.json")).collect()]
    assert [json.loads(x)["review_id"] for x in lines] == ["r1", "r2"]


@pytest.mark.parametrize("lines", [10, 700, 5000])
def test_heads_of_a_file_in_many_blocks_are_its_first_lines(spark, tmp_path, lines):
    texts = [f"{i:05} " + "x" * (i % 50) for i in range(2000)]
    (tmp_path / "in.json").write_text("\n".join(texts) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = files.head_of_file(spark, str(tmp_path / "in.json"), lines)
        assert [r.value for r in found.collect()] == texts[:lines]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_document_load(spark):
    df = spark.createDataFrame(
        [("u1", float("nan"), " a ,b,, "), ("u1", float("nan"), " a ,b,, "), ("u2", 2.0, "None"), ("u3", None, None)],
        "user_id string, average_stars double, friends string",
    )
    rows = {r._id: r for r in documents.load_documents(df, "users").collect()}
    assert len(rows) == 3 and rows["u1"].average_stars is None and rows["u1"].friends == ["a", "b"]
    assert rows["u2"].friends == [] and rows["u3"].friends is None
    tips = spark.createDataFrame([("u", "b"), ("u", "b")], "user_id string, business_id string")
    assert documents.load_documents(tips, "tips").count() == 2


def test_merge_update_and_missing(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, s string")
    updates = spark.createDataFrame([("b", None, True), ("z", 9, True)], "k string, n int, flag boolean")
    merged = {r.k: r for r in documents.merge_columns(target, updates, "k").collect()}
    assert set(merged) == {"a", "b"}
    assert (merged["a"].n, merged["a"].flag, merged["b"].n, merged["b"].flag) == (1, None, None, True)
    changed = documents.update_where(target, F.col("n") > 1, {"s": F.lit("new")})
    assert [r.s for r in changed.orderBy("k").collect()] == ["x", "new"]
    partly = spark.createDataFrame([(1,), (None,)], "c int")
    assert sorted(r.c for r in documents.add_missing(partly, "c", F.lit(0)).collect()) == [0, 1]
    assert documents.add_missing(partly, "d", F.lit(7)).first().d == 7


def test_repairs(spark):
    lists = spark.createDataFrame(
        [("a", [""], True, 1), ("b", [], True, 0), ("c", ["2012"], True, 1)],
        "user_id string, elite_years array<string>, is_elite_ever boolean, elite_year_count int",
    )
    fixed = {r.user_id: r for r in cleaning.repair_elite(lists).collect()}
    assert tuple(fixed["a"])[1:] == ([], False, 0) and tuple(fixed["b"])[1:] == ([], False, 0)
    assert tuple(fixed["c"])[1:] == (["2012"], True, 1)
    text = lists.withColumn("elite_years", F.concat_ws(",", "elite_years"))
    assert {r.user_id: tuple(r)[1:] for r in cleaning.repair_elite(text).collect()}["a"] == ([], False, 0)
    friends = spark.createDataFrame([("None",), ("",), ("x, y",), (None,)], "friends string")
    assert [r.friends for r in cleaning.repair_friends(friends).collect()] == [[], [], ["x", "y"], None]


def test_quality(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, n int")
    check = {r.field: r for r in quality.field_checks("t", df, {"k": ("string",), "n": ("string",), "z": ("int",)}).collect()}
    assert (check["k"].n_missing, check["k"].type_ok, check["n"].type_ok) == (1, True, False)
    assert (check["z"].is_present, check["z"].n_missing, check["z"].actual_type) == (False, 3, None)
    assert quality.duplicate_keys(df, ["k"]).collect()[0].n == 2
    assert tuple(quality.key_violations({"t": (df, ["k"])}).first()) == ("t", 1, 1)


def test_result_sets(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    files.write_results({"one": df, "two": df}, str(tmp_path / "r"), "parquet")
    assert spark.read.parquet(str(tmp_path / "r" / "two")).count() == 1
    files.append_result(df, str(tmp_path / "log"), "q1", "First")
    files.append_result(df, str(tmp_path / "log"), "q2", "Second")
    found = {r.query: json.loads(r.row) for r in files.read_results(spark, str(tmp_path / "log")).collect()}
    assert found == {"q1": {"k": "a", "n": 1}, "q2": {"k": "a", "n": 1}}


def test_incremental_ingest_resumes(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()

    def drop(name, records):
        (tmp_path / "in" / name).write_text("".join(json.dumps(r) + "\n" for r in records))

    drop("a.json", RAW["review"][:2])
    ingest_folder(spark, "review", source, target, state, 1).awaitTermination()
    assert spark.read.parquet(target).count() == 2
    drop("b.json", RAW["review"][2:])
    ingest_folder(spark, "review", source, target, state, 1).awaitTermination()
    table = spark.read.parquet(target)
    assert sorted(r.review_id for r in table.collect()) == ["r1", "r2", "r3"]
    assert dict(table.dtypes)["date"] == "timestamp_ntz"


def test_users_are_summed_without_review_rows(spark, tmp_path):
    from plaudit.plans.workspace import Workspace

    tables = {
        "customer": ([(0, "a"), (1, "b"), (2, "c")], "c_custkey long, c_name string"),
        "orders": ([(0, 1), (1, 1), (2, 2), (2, 2), (3, 0), (None, 0)], "o_orderkey long, o_custkey long"),
        "lineitem": (
            [(0, 1, 1, 1, 5.0, 0.05), (0, 1, 1, 2, 25.0, 0.02), (1, 1, 1, 1, None, 0.01), (2, 1, 1, 1, 50.0, None),
             (9, 1, 1, 1, 1.0, 0.1), (None, 1, 1, 1, 1.0, 0.1)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double",
        ),
        # Four rows: order 1 falls on a document number that occurs twice.
        "documents": ([(0, "x"), (1, "y"), (1, "z"), (None, "w")], "doc_id long, text string"),
    }
    for name, (data, schema) in tables.items():
        df = spark.createDataFrame(data, schema)
        if name == "lineitem":
            df = df.withColumn("l_shipdate", F.lit("2000-01-01").cast("timestamp_ntz"))
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    w = Workspace(spark, str(tmp_path))
    found = {r.user_id: (r.review_count, r.useful, r.average_stars) for r in w.users.collect()}
    assert "reviews" not in vars(w)
    assert found == {"u0": (0, 0, None), "u1": (4, 9, 2.0), "u2": (2, 0, 5.0)}
    # As many as the reviews themselves.
    by_row = w.reviews.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("useful").alias("useful"), F.avg("stars").alias("stars"))
    assert {r.user_id: (r.n, r.useful or 0, r.stars) for r in by_row.collect()} == {k: v for k, v in found.items() if v[0]}


def test_texts_are_stored_compressed_in_files_that_share_the_reading(spark, tmp_path):
    texts = spark.range(3000).select(F.col("id").cast("string").alias("review_id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("text"))
    lines, table = str(tmp_path / "review.json"), str(tmp_path / "reviews")
    files.write_json_lines(texts.coalesce(1), lines, rows_per_file=700)
    parts = list((tmp_path / "review.json").glob("part-*"))
    assert len(parts) == 5 and all(p.name.endswith(".json.gz") for p in parts)
    assert sum(p.stat().st_size for p in parts) < 3000 * 256 / 2
    back = files.scan_json_lines(spark, lines, texts.schema)
    assert back.exceptAll(texts).isEmpty() and back.count() == 3000
    files.write_table(back, table)
    assert all(p.name.endswith(".zstd.parquet") for p in (tmp_path / "reviews").glob("part-*"))
    assert spark.read.parquet(table).exceptAll(texts).isEmpty()
