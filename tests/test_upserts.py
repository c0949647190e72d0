"""Merges and updates rewrite only what they touch."""

import os

import pytest
from pyspark.sql import functions as F

from plaudit.sources import upserts


def parts(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-") and "_update-" not in d}


@pytest.fixture
def rows(spark):
    return spark.range(1000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 10).alias("group"), "id")


def test_merge_rewrites_the_buckets_of_matched_keys(spark, rows, tmp_path):
    table = upserts.KeyedTable(str(tmp_path / "t"), "key", 16)
    table.write(rows)
    before = parts(table.path)
    updates = spark.createDataFrame([("k1", 7, "x"), ("k2", None, "y"), ("nobody", 1, "z")], "key string, group long, note string")
    touched = table.merge(updates)
    assert 1 <= touched <= 2 and len(before & parts(table.path)) == len(before) - touched
    found = {r["key"]: r for r in table.read(spark).collect()}
    assert len(found) == 1000 and "nobody" not in found
    assert (found["k1"]["group"], found["k1"]["note"]) == (7, "x")
    assert (found["k2"]["group"], found["k2"]["note"]) == (None, "y")
    assert (found["k3"]["group"], found["k3"]["note"], found["k3"]["id"]) == (3, None, 3)


def test_merge_without_a_match_rewrites_nothing(spark, rows, tmp_path):
    table = upserts.KeyedTable(str(tmp_path / "t"), "key", 4)
    table.write(rows)
    before = parts(table.path)
    assert table.merge(spark.createDataFrame([("nobody", 1), (None, 2)], "key string, group long")) == 0
    assert parts(table.path) == before and table.read(spark).count() == 1000


def test_update_rewrites_the_files_that_match(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    rows.repartitionByRange(10, "group").write.parquet(path)
    before = parts(path)
    n = upserts.update_in_place(spark, path, (F.col("group") == 4) & (F.col("id") < 500), {"id": -F.col("id")})
    assert n == 1 and len(before & parts(path)) == len(before) - 1
    changed = spark.read.parquet(path)
    assert changed.count() == 1000 and changed.filter("id < 0").count() == 50
    assert changed.filter("id < 0 AND group <> 4").isEmpty()
    assert upserts.update_in_place(spark, path, F.col("group") == 99, {"id": F.lit(0)}) == 0
    assert not [name for name in os.listdir(path) if name.startswith("_update")]


def test_cut_off_updates_are_finished_or_dropped(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    rows.repartitionByRange(4, "group").write.parquet(path)
    victim = sorted(parts(path))[0]
    kept = spark.read.parquet(path).count()
    lost = spark.read.parquet(victim)
    # The list is written, the exchange did not happen.
    lost.withColumn("id", F.lit(-1).cast("long")).write.parquet(f"{path}/_update-a")
    spark.createDataFrame([(f"file:{victim}",)], "file string").coalesce(1).write.text(f"{path}/_update-a/_replaced")
    # Another one stopped before its list.
    lost.write.parquet(f"{path}/_update-b")
    size = lost.count()
    upserts.finish_updates(spark, path)
    upserts.finish_updates(spark, path)
    after = spark.read.parquet(path)
    assert after.count() == kept and after.filter("id = -1").count() == size and not os.path.exists(victim)
