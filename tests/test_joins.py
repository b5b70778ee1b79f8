from statistics import median

from pyspark.sql import functions as F

from hubbub.operators import dedup, joins, ranking


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def hot_table(spark, n=4000):
    """One key owns a third of the rows."""
    return spark.createDataFrame([("hot" if i % 3 == 0 else f"k{i % 900}", i) for i in range(n)], "k string, i int")


def test_hot_keys_finds_the_hot_one(spark):
    assert joins.hot_keys(hot_table(spark), "k") == ["hot"]


def test_skewed_join_equals_plain_join(spark):
    many = hot_table(spark).unionByName(spark.createDataFrame([(None, -1)], "k string, i int"))
    one = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("zz", 4)], "k string, v int")
    for how in ("inner", "left"):
        want = rows(many.join(one, "k", how).na.fill(-9).na.fill("?"), "k", "i", "v")
        assert rows(joins.skewed_join(many, one, "k", how).na.fill(-9).na.fill("?"), "k", "i", "v") == want


def test_lookup_join_salted_equals_broadcast(spark):
    many = hot_table(spark)
    table = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, v int")
    for how in ("inner", "left", "left_anti"):
        columns = ["k", "i"] if how == "left_anti" else ["k", "i", F.coalesce("v", F.lit(-1))]
        small = rows(joins.lookup_join(many, table, ["k"], how), *columns)
        assert rows(joins.lookup_join(many, table, ["k"], how, small=False), *columns) == small


def test_size_check(spark):
    table = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, v int")
    assert joins.fits_broadcast(table)
    assert not joins.fits_broadcast(table, max_rows=1)
    assert not joins.fits_broadcast(table, max_bytes=3)
    assert joins.fits_broadcast(table.where("v > 5"))


def test_number_rows_is_one_to_n(spark):
    df = hot_table(spark)
    numbered = ranking.number_rows(df, [F.col("k").asc(), F.col("i").desc()])
    got = [(r.k, r.i) for r in numbered.orderBy("number").collect()]
    assert got == sorted(((r.k, r.i) for r in df.collect()), key=lambda p: (p[0], -p[1]))
    assert rows(numbered, "number") == [(n,) for n in range(1, 4001)]


def test_top_per_group_large_n(spark):
    df = hot_table(spark)
    top = ranking.top_per_group(df, ["k"], [F.col("i").asc()], 1200)
    assert top.where("k = 'hot'").count() == 1200
    assert top.where("k = 'hot'").agg(F.max("i")).first()[0] == 3 * 1199


def test_top_per_group_is_pruned_before_the_shuffle(spark, capsys):
    ranking.top_per_group(hot_table(spark), ["k"], [F.col("i").asc()], 3).explain()
    plan = capsys.readouterr().out
    assert plan.index("row_number(), 3, Final") < plan.index("Exchange") < plan.index("row_number(), 3, Partial")


def test_grouped_median(spark):
    data = [("a", float(i * i % 97)) for i in range(2001)] + [("b", 1.0)] * 5 + [("b", 9.0)] * 5 + [("c", 4.0), ("c", None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r.median for r in ranking.grouped_median(df, ["g"], "v").collect()}
    assert got == {g: median(v for k, v in data if k == g and v is not None) for g in "abc"}


def test_grouped_median_of_large_group(spark):
    df = spark.range(60001).select(F.lit("g").alias("g"), (F.col("id") * 7919 % 60001).cast("double").alias("v"))
    assert ranking.grouped_median(df, ["g"], "v").first()["median"] == 30000.0
    even = df.where("v < 60000").unionByName(spark.range(20000).select(F.lit("g").alias("g"), F.lit(3.0).alias("v")))
    values = sorted(r.v for r in even.select("v").collect())
    assert ranking.grouped_median(even, ["g"], "v").first()["median"] == median(values)


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 5, "w")], "k string, seq int, v string")
    assert rows(dedup.first_per_key(df, ["k"], ["seq"]), "k", "v") == [("a", "x"), ("b", "w")]
    assert rows(dedup.last_per_key(df, ["k"], ["seq"]), "k", "v") == [("a", "y"), ("b", "w")]


def test_comment_cap(spark):
    df = spark.createDataFrame([("a", i) for i in range(9)] + [("b", 1)], "k string, i int")
    assert ranking.cap_comments(df, "k", [F.col("i")], 4).count() == 5
    assert ranking.cap_comments(df, "k", [F.col("i")], 4, page=2).count() == 7
    assert ranking.cap_comments(df, "k", [F.col("i")], 1000, page=100).count() == 10
