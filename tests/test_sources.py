import json

import pytest
from pyspark.sql import functions as F

from hubbub.sources import articles, lexicon, tasks


def write(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, indent=4), encoding="utf-8", newline="")


ARTICLE = {"article_url": "u", "article_title": "t", "article_category": "C", "content_raw": "x", "comments": [{"comment_content": "c"}],
           "content_top_key": [["w", 3]], "comments_top_key": [], "date_year": 2025}


def test_read_policies(spark, tmp_path):
    write(tmp_path / "C_a.json", ARTICLE)
    write(tmp_path / "notes.txt", "no")
    write(tmp_path / "deeper" / "d.json", ARTICLE)
    row = articles.read_articles(spark, str(tmp_path)).collect()
    assert len(row) == 1 and row[0].source_filename == "C_a.json"
    assert [(t.word, t["count"]) for t in row[0].content_top_key] == [("w", 3)] and row[0].comments[0].comment_content == "c"
    assert row[0].article_author is None
    write(tmp_path / "bad.json", '{"article_url": "u"')
    with pytest.raises(Exception):
        articles.read_articles(spark, str(tmp_path)).collect()
    good, rejected = articles.read_articles_tolerant(spark, str(tmp_path))
    assert [r.source_filename for r in good.collect()] == ["C_a.json"]
    assert [r.source_filename for r in rejected.collect()] == ["bad.json"] and rejected.count() == 1


def test_write_keeps_the_last_per_key(spark, tmp_path):
    rows = [("C", "u1", "n", 1, "old"), ("C", "u2", "n", 2, "new"), ("D", "u1", "m", 0, "x")]
    df = spark.createDataFrame(rows, "article_category string, article_url string, output_name string, seq int, content_raw string")
    articles.write_articles(df, str(tmp_path / "name"), key="output_name")
    assert sorted(r.content_raw for r in spark.read.parquet(str(tmp_path / "name")).collect()) == ["new", "x"]
    articles.write_articles(df, str(tmp_path / "url"), form="json")
    assert (tmp_path / "url" / "article_category=C").is_dir()
    assert sorted(r.content_raw for r in spark.read.json(str(tmp_path / "url")).collect()) == ["new", "old"]


def test_json_form_round_trip(spark, tmp_path):
    write(tmp_path / "in" / "a.json", ARTICLE)
    read = articles.read_articles(spark, str(tmp_path / "in"))
    articles.article_json(read).write.json(str(tmp_path / "out"))
    again = articles.read_articles(spark, str(tmp_path / "out"))
    assert again.drop("source_filename").collect() == read.drop("source_filename").collect()
    text = next((tmp_path / "out").glob("*.json")).read_text()
    assert json.loads(text)["content_top_key"] == [["w", "3"]]


def test_methods_and_cells(spark, tmp_path):
    df = spark.createDataFrame([("a", "jieba"), ("a", "ckip")], "article_url string, method string")
    articles.write_by_method(df, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).where("method = 'ckip'").count() == 1
    articles.write_cells(df, str(tmp_path / "c"), form="csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["article_url", "method"]


def test_tasks(spark, tmp_path):
    path = tmp_path / "tasks.json"
    items = [{"title": f"t{i}", "url": f"u{i}", "date": " 1/01"} for i in range(5)]
    write(path, json.dumps(items).replace(", ", ",\r\n"))
    found, problems = tasks.read_tasks(spark, str(path))
    assert [(r.seq, r.title) for r in found.orderBy("seq").collect()] == [(i, f"t{i}") for i in range(5)] and problems.count() == 0
    missing, problems = tasks.read_tasks(spark, str(tmp_path / "none.json"))
    assert missing.count() == 0 and missing.columns == found.columns and problems.first().problem == "task file not found"
    write(tmp_path / "bad.json", "not json")
    assert tasks.read_tasks(spark, str(tmp_path / "bad.json"))[1].count() == 1
    tasks.write_tasks(found, str(tmp_path / "runs"), "20250101000000")
    assert spark.read.json(str(tmp_path / "runs")).where("run_ts = 20250101000000").count() == 5


def test_user_dictionary(spark, tmp_path):
    write(tmp_path / "words.txt", "【===人名===】\r\n張文\r\n柯P \r\n\r\n【===地名===】\r\n台中\r\n張文\r\n")
    rows = sorted((r.word, r.section) for r in lexicon.read_user_dictionary(spark, str(tmp_path / "words.txt")).collect())
    assert rows == [("台中", "【===地名===】"), ("張文", "【===人名===】"), ("柯P", "【===人名===】")]
    write(tmp_path / "stop.txt", "的\r\n　可以\r\n\r\n可以")
    assert sorted(r.word for r in lexicon.read_stop_words(spark, str(tmp_path / "stop.txt")).collect()) == ["可以", "的"]


def test_shared_folder_comes_from_the_session(spark, tmp_path):
    from hubbub.session import durable, shared_dir

    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert durable(spark.range(3)).count() == 3


def test_many_rows_in_the_json_form(spark, tmp_path):
    rows = spark.range(10).select(F.concat(F.lit("u"), "id").alias("article_url"), F.lit("c").alias("article_category"), F.lit(1).alias("seq"))
    articles.write_articles(rows.repartition(1), str(tmp_path / "out"), form="json")
    read = articles.read_articles(spark, str(tmp_path / "out"), lines=True)
    assert sorted(r.article_url for r in read.collect()) == [f"u{i}" for i in range(10)]
    # The same folder as one object per file is refused, not cut short.
    good, rejected = articles.read_articles_tolerant(spark, str(tmp_path / "out"))
    assert good.count() == 0 and rejected.count() == 1
    with pytest.raises(Exception, match="not one article object"):
        articles.read_articles(spark, str(tmp_path / "out")).collect()


def test_article_files_hold_one_article_each(spark, tmp_path):
    rows = spark.range(20).select(F.concat(F.lit("u"), "id").alias("article_url"), F.lit("日本\n").alias("content_raw"))
    folders = articles.write_article_files(rows.repartition(3), str(tmp_path / "out"))
    read = articles.read_articles(spark, folders)
    assert sorted((r.article_url, r.content_raw) for r in read.collect()) == sorted((f"u{i}", "日本\n") for i in range(20))
    assert read.select("source_filename").distinct().count() == 20
    # What an attempt that failed left behind is not read.
    write(tmp_path / "out" / "left" / "part.json", ARTICLE)
    assert articles.read_articles(spark, folders).count() == 20
    none = articles.write_article_files(rows.limit(0), str(tmp_path / "none"))
    assert articles.read_articles(spark, none).count() == 0


def test_files_are_read_as_bytes(spark, tmp_path):
    write(tmp_path / "C_a.json", ARTICLE)
    plan = articles.read_articles(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "binaryFile" in plan
    assert articles.read_articles(spark, str(tmp_path)).count() == 1


def test_files_of_tasks_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """Folders hold a bounded number of files each, and the driver sees folders only, however many files there are."""
    monkeypatch.setattr(articles, "FILES_EACH", 5)
    rows = spark.range(27).select(F.concat(F.lit("u"), "id").alias("article_url"), F.lit("é").alias("content_raw"))
    folders = articles.write_article_files(rows.repartition(2), str(tmp_path / "out"))
    assert 6 <= len(folders) <= 7 and all(len(list((tmp_path / "out" / f.rsplit("/", 1)[1]).iterdir())) <= 5 for f in folders)
    for name in ("_hidden.json", ".hidden.json", "notes.txt"):
        write(tmp_path / "out" / folders[0].rsplit("/", 1)[1] / name, "no article")
    read = articles.read_articles(spark, folders)
    assert read.inputFiles() == []
    assert sorted((r.article_url, r.content_raw) for r in read.collect()) == sorted((f"u{i}", "é") for i in range(27))
    # The same as when the driver lists them.
    assert sorted(read.collect(), key=str) == sorted(articles.read_articles(spark, list(folders)).collect(), key=str)
    write(tmp_path / "out" / folders[0].rsplit("/", 1)[1] / "bad.json", '{"article_url": "u"')
    with pytest.raises(Exception, match="not one article object"):
        articles.read_articles(spark, folders).collect()
    good, rejected = articles.read_articles_tolerant(spark, folders)
    assert good.count() == 27 and [r.source_filename for r in rejected.collect()] == ["bad.json"]
