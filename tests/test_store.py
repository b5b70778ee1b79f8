import os

import pytest
from pyspark.sql import functions as F

from hubbub.sources import store


def rows(spark, lines):
    return spark.createDataFrame(lines, "output_name string, seq long, text string")


def content(spark, path, **options):
    return sorted(tuple(r) for r in store.read_store(spark, path, **options).select("output_name", "seq", "text").collect())


def test_three_runs_and_a_repeated_one(spark, tmp_path):
    path = str(tmp_path / "store")
    store.upsert(rows(spark, [("a", 1, "a1"), ("a", 3, "a3"), ("a", 2, "a2"), ("b", 4, "b4"), (None, 9, "no name")]), path, "r1", buckets=4)
    store.upsert(rows(spark, [("b", 1, "b1"), ("c", 2, "wrong")]), path, "r2")
    store.upsert(rows(spark, [("c", 1, "c1"), ("d", 1, "d1")]), path, "r3")
    assert content(spark, path) == [("a", 3, "a3"), ("b", 1, "b1"), ("c", 1, "c1"), ("d", 1, "d1")]
    # The repeated second run keeps its place: the third one still replaces it, and its first try is gone.
    store.upsert(rows(spark, [("c", 7, "c7"), ("e", 1, "e1")]), path, "r2")
    want = [("a", 3, "a3"), ("b", 4, "b4"), ("c", 1, "c1"), ("d", 1, "d1"), ("e", 1, "e1")]
    assert content(spark, path) == want
    store.compact(spark, path)
    assert content(spark, path) == want and len(store.manifest(spark, path)[1]["runs"]) == 1
    store.upsert(rows(spark, [("a", 1, "late")]), path, "r4")
    assert content(spark, path) == [("a", 1, "late")] + want[1:]


def test_a_run_that_fails_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        store.read_store(spark, path)
    store.upsert(rows(spark, [("a", 1, "a1")]), path, "r1")
    store.stage(rows(spark, [("a", 2, "never counted")]), path, "r2")
    bad = rows(spark, [("a", 2, "x")]).withColumn("text", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        store.upsert(bad, path, "r2")
    assert content(spark, path) == [("a", 1, "a1")]
    store.upsert(rows(spark, [("a", 2, "a2")]), path, "r2")
    assert content(spark, path) == [("a", 2, "a2")]


def test_two_writers_and_an_unfinished_version(spark, tmp_path):
    path = str(tmp_path / "store")
    store.upsert(rows(spark, [("a", 1, "a1")]), path, "r1")
    one, other = (store.stage(rows(spark, [(n, 1, n)]), path, n) for n in ("x", "y"))
    store.publish(spark, path, one)
    with pytest.raises(RuntimeError):
        store.publish(spark, path, other)
    with pytest.raises(RuntimeError):
        store._commit(spark, path, one[1], {})
    assert content(spark, path) == [("a", 1, "a1"), ("x", 1, "x")]
    with open(os.path.join(path, "versions", "000000009.json"), "w") as half:
        half.write('{"key": "outp')
    assert content(spark, path) == [("a", 1, "a1"), ("x", 1, "x")]
    store.upsert(rows(spark, [("y", 1, "y")]), path, "y")
    assert content(spark, path) == [("a", 1, "a1"), ("x", 1, "x"), ("y", 1, "y")] and store.manifest(spark, path)[0] == 10


def test_asked_keys_read_their_buckets(spark, tmp_path):
    path = str(tmp_path / "store")
    store.upsert(rows(spark, [(f"n{k}", k, "x") for k in range(200)]), path, "r1", buckets=16)
    found = store.read_store(spark, path, keys=["n7", "n8", "none"])
    assert sorted(r["output_name"] for r in found.collect()) == ["n7", "n8"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan.replace("isnotnull(_bucket), ", "").replace("PartitionFilters: [isnotnull", "PartitionFilters: [_bucket")
    with pytest.raises(ValueError):
        store.upsert(rows(spark, []), path, "r2", key="text")
    with pytest.raises(ValueError):
        store.upsert(rows(spark, []), path, "../r2")


def test_columns_that_come_later(spark, tmp_path):
    path = str(tmp_path / "store")
    store.upsert(rows(spark, [("a", 1, "a1"), ("b", 1, "b1")]), path, "r1")
    store.upsert(rows(spark, [("b", 2, "b2")]).withColumn("likes", F.lit(5)), path, "r2")
    assert sorted((r["output_name"], r["likes"]) for r in store.read_store(spark, path).collect()) == [("a", None), ("b", 5)]
