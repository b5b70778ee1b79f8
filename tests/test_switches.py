"""Whatever a measured size decides, the rows are the same: both sides on repeated and missing keys, maps, repeated words."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from hubbub.operators import counts, filters, joins, ranking, segment

WORDS = [("ab", 9.0, "N"), ("ab", 2.0, "V"), ("abcd", 1.0, "N"), ("cd", 9.0, None), ("cd", 9.0, "N"), (None, 5.0, "N"), ("", 5.0, "N"), ("beta", None, "V")]
WORDS += [("zz", 1.0, "N")] * 50


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(WORDS, "word string, weight double, tag string")


def test_segment(spark, lexicon):
    units = spark.createDataFrame([("u", 0, "abcd alphabeta"), ("u", 0, "cdab"), (None, 0, "alpha,beta"), (None, None, None), ("v", 1, "")], "article_url string, unit_ix int, text string")
    near, far = (rows(segment.segment(units, lexicon, small=s)) for s in (True, False))
    assert near == far and len(near) == 5


@pytest.mark.parametrize("method", ["jieba", "ckip"])
def test_enrich(spark, lexicon, method):
    comment = "array<struct<comment_content:string,comment_keywords:array<string>>>"
    articles = spark.createDataFrame(
        [("x", "abcd cd", [("abcd", None)]), ("x", "cd cd", [("ab", None), (None, None)]), (None, "beta", None), (None, None, [])],
        f"article_url string, content_raw string, comments {comment}",
    )
    near, far = (rows(counts.enrich(articles, lexicon, method, small=s)) for s in (True, False))
    assert near == far and len(near) == 4


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_lookup_join(spark, how):
    many = spark.createDataFrame([("hot", {"k": i}) for i in range(300)] + [(None, {}), ("cold", None)], "word string, header map<string,int>")
    table = spark.createDataFrame([("hot", 1), ("cold", 2), ("other", 3), (None, 4)], "word string, tag int")
    table = table.select("word") if how == "left_anti" else table
    for frame in (many, many.select("word")):
        near, far = (rows(joins.lookup_join(frame, table, ["word"], how, small=s)) for s in (True, False))
        assert near == far


def test_hot_rows_are_spread_and_cold_rows_are_not_copied(spark):
    many = spark.createDataFrame([("hot", i) for i in range(300)] + [(f"w{i}", i) for i in range(200)], "word string, n int")
    table = spark.createDataFrame([("hot", 1)] + [(f"w{i}", i) for i in range(500)], "word string, tag int")
    assert joins.hot_keys(many, "word") == ["hot"]
    joined = joins.lookup_join(many, table, ["word"], "left", small=False)
    assert joined.count() == 500 and joined.where("tag is null").count() == 0


def test_top_per_group_with_a_map(spark):
    df = spark.createDataFrame([("g", i, {"k": i}) for i in range(1500)], "g string, n int, header map<string,int>")
    for n in (1000, 1001):
        assert ranking.top_per_group(df, ["g"], [F.col("n")], n).count() == n


def test_missing_stop_words_stop_nothing(spark, monkeypatch):
    tokens = spark.createDataFrame([("keep",), ("stop",)], "word string")
    for limit in (10, 0):
        monkeypatch.setattr(filters, "_LITERAL_WORDS", limit)
        assert rows(filters.keep_terms(tokens, ["stop", None])) == ["Row(word='keep')"]
    kept = tokens.select(filters.term_array(F.array("word"), ["stop", None]).alias("w")).where("size(w) > 0")
    assert kept.count() == 1


def test_segmentation_away_from_the_repository(tmp_path):
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {home!r} + "/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
for name in ("segmented_terms_lexicon", "enriched_articles_tagged"):
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
print("both ran")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "both ran" in done.stdout, done.stderr[-2000:]
