import random
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hubbub.functions.times import time_range
from hubbub.operators import counts, filters, units
from hubbub.schemas import ARTICLE
from hubbub.sources.lexicon import STOP_WORDS, weighted_dictionary


def article(spark, *docs):
    """Articles from (url, body, comments or None); comments are (time, text)."""
    empty = {f.name: None for f in ARTICLE.fields}
    rows = []
    for url, body, comments in docs:
        built = None if comments is None else [
            {"comment_author": "u", "comment_raw_time": None, "comment_date_format": t, "comment_year": None, "comment_month": None,
             "comment_day": None, "comment_tag": None, "comment_content": c, "comment_keywords": None} for t, c in comments]
        rows.append({**empty, "article_url": url, "content_raw": body, "comments": built, "publish_time": "2025-03-01 10:00:00"})
    return spark.createDataFrame([tuple(r[f.name] for f in ARTICLE.fields) for r in rows], ARTICLE)


def test_ties_keep_first_seen_order(spark):
    a = article(spark, ("u", "bb bb aa aa cc cc", [("t", "zz yy"), ("t", "yy zz xx")]))
    tokens = units.token_rows(units.text_units(a))
    body = counts.top_terms(counts.term_counts(tokens.where("unit_ix = 0")), n=2).orderBy("rank")
    assert [(r.word, r.n) for r in body.collect()] == [("bb", 2), ("aa", 2)]
    comments = counts.top_terms(counts.term_counts(tokens.where("unit_ix > 0")), n=3).orderBy("rank")
    assert [(r.word, r.n) for r in comments.collect()] == [("zz", 2), ("yy", 2), ("xx", 1)]


def test_top_terms_match_most_common(spark):
    rng = random.Random(5)
    docs = [(f"d{i}", " ".join(f"w{rng.randrange(30)}" for _ in range(200)), []) for i in range(20)]
    tokens = units.token_rows(units.text_units(article(spark, *docs)))
    top = counts.top_terms(counts.term_counts(tokens), n=7).orderBy("article_url", "rank").collect()
    for url, text, _ in docs:
        assert [(r.word, r.n) for r in top if r.article_url == url] == Counter(text.split()).most_common(7)


def test_units_mirror_comment_count(spark):
    a = article(spark, ("x", "b", [("t", "1"), ("t", "2")]), ("y", None, None), ("z", "b", []))
    got = {r.article_url: r["count"] for r in units.text_units(a).groupBy("article_url").count().collect()}
    assert got == {"x": 3, "y": 1, "z": 1}
    assert units.explode_comments(a).count() == 2
    assert units.explode_comments(a, where=lambda c: c["comment_content"] == "2").first().comment_ix == 0


def test_enrich_writes_back_by_position(spark):
    a = article(spark, ("x", "台北 可以 台北 12 x", [("t", "柯P 台北"), ("t", ""), ("t", "柯P")]), ("y", "", None))
    lexicon = weighted_dictionary(spark, {"柯P": 1, "台北": 1}, {"柯P": "Nb"})
    done = {r.article_url: r for r in counts.enrich(a, lexicon).collect()}
    x = done["x"]
    assert x.content_keywords == ["台北", "台北"] and x.method == "jieba"
    assert [(t.word, t["count"]) for t in x.content_top_key] == [("台北", 2)]
    assert [c.comment_keywords for c in x.comments] == [["柯P", "台北"], [], ["柯P"]]
    assert [(t.word, t["count"]) for t in x.comments_top_key] == [("柯P", 2), ("台北", 1)]
    assert done["y"].content_keywords == [] and done["y"].comments is None
    tagged = {r.article_url: r for r in counts.enrich(a, lexicon, method="ckip").collect()}["x"]
    assert tagged.content_keywords == [] and [c.comment_keywords for c in tagged.comments] == [["柯P"], [], ["柯P"]]


def test_enrich_with_a_dictionary_too_large_to_send(spark):
    a = article(spark, ("x", "台北 可以 台北 12 x", [("t", "柯P 台北"), ("t", ""), ("t", "柯P")]), ("y", "", None))
    lexicon = weighted_dictionary(spark, {"柯P": 1, "台北": 1}, {"柯P": "Nb"})
    for method in ("jieba", "ckip"):
        near, far = (counts.enrich(a, lexicon, method, small=s).orderBy("article_url") for s in (True, False))
        assert near.columns == far.columns and near.collect() == far.collect()


def test_pooled_words_use_their_own_time(spark):
    a = article(spark, ("x", "body body", [("2025-03-02 00:00:00", "late"), ("2025-03-01 23:59:59", "in time"), (None, "never")]))
    done = counts.enrich(a, segmented=False, stop=())
    words = counts.pooled_words(done, *time_range("2025-03-01", "2025-03-01"))
    got = counts.pooled_frequencies(words, 2).collect()
    assert [(r.word, r.n, r.weight) for r in got] == [("body", 2, 1.0), ("in", 1, 0.5)]
    assert counts.pooled_frequencies(words.where("word = 'none'")).count() == 0


def test_filters(spark):
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) and all(len(w) > 1 for w in STOP_WORDS)
    tokens = spark.createDataFrame([(w,) for w in ["the", "the", "cat", "cat", "x", "12", "²²", "　　", "XD"]], "word string")
    assert sorted(r.word for r in filters.keep_terms(tokens, ["the"]).collect()) == ["XD", "cat", "cat"]
    assert sorted(r.word for r in filters.keep_terms(tokens).collect()) == ["cat", "cat", "the", "the"]
    stop = spark.createDataFrame([("the",), ("the",)], "word string")
    assert sorted(r.word for r in filters.keep_terms(tokens, stop).collect()) == ["XD", "cat", "cat"]
    many = [f"w{i}" for i in range(10_001)] + ["cat"]
    assert sorted(r.word for r in filters.keep_terms(tokens, many).collect()) == ["XD", "the", "the"]


def test_tags(spark, one):
    words, tags = F.array(*[F.lit(w) for w in ("aa", "b", "cc", "dd")]), F.array(*[F.lit(t) for t in ("Na", "VB", "D")])
    zipped = filters.zip_tags(words, tags)
    assert one(F.size(zipped), filters.content_words(zipped)).asDict().values() and list(one(F.size(zipped), filters.content_words(zipped))) == [3, ["aa"]]
    tokens = spark.createDataFrame([("aa", 1), ("zz", 2)], "word string, i int")
    lexicon = spark.createDataFrame([("aa", 1.0, "Na", "NAMES"), ("zz", 1.0, None, None)], "word string, weight double, tag string, section string")
    assert sorted((r.word, r.pos_tag) for r in filters.tag_words(tokens, lexicon).collect()) == [("aa", "Na"), ("zz", "x")]
    assert [(r.word, r.section) for r in filters.gazetteer_hits(tokens, lexicon).collect()] == [("aa", "NAMES")]
    assert filters.gazetteer_hits(tokens, lexicon, ["PLACES"]).count() == 0


def test_words_of_a_text_are_counted_inside_its_row(spark):
    rows = [(1, "be at be, at zz 12 x be"), (2, None), (3, " , "), (4, "at zz"), (4, "zz yy"), (None, "at"), (None, "at be"), (5, "é É é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = counts.words_per_text(docs)
    assert sorted(map(tuple, words.where("doc_id is not null").collect())) == [(1, "at", 2), (1, "be", 3), (1, "zz", 1), (4, "at", 1), (4, "yy", 1), (4, "zz", 2)]
    assert sorted((r.word, r.n) for r in words.where("doc_id is null").collect()) == [("at", 2), ("be", 1)]
    top = counts.top_words_per_text(docs, n=2).where("doc_id in (1, 4)")
    assert sorted(map(tuple, top.collect())) == [(1, "at", 2, 2), (1, "be", 3, 1), (4, "at", 1, 2), (4, "zz", 2, 1)]
    # Without repeated keys no word moves between tasks.
    alone = docs.where("doc_id < 4")
    for found in (counts.words_per_text(alone), counts.top_words_per_text(alone)):
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_top_lists_are_those_of_plain_counting():
    rng = random.Random(4)
    articles = [[[rng.choice("abcdefg") for _ in range(rng.randrange(9))] for _ in range(rng.randrange(1, 5))] for _ in range(60)]
    units = list(chain.from_iterable(articles))
    words = pa.array(list(chain.from_iterable(units)), pa.string())
    for n in (1, 3, 50):
        lists = counts._top_lists(np.array([len(a) for a in articles]), np.array([len(u) for u in units]), words, n)
        body, comments = ([[(t["word"], t["count"]) for t in own] for own in part.to_pylist()] for part in lists)
        assert body == [Counter(a[0]).most_common(n) for a in articles]
        assert comments == [Counter(chain.from_iterable(a[1:])).most_common(n) for a in articles]


def test_tagged_enrichment_crosses_to_python_once(spark):
    """Words that are dropped by their tags never leave the worker that cuts them, and the others are counted there."""
    docs = spark.createDataFrame([("u", "ab cd ab 台北", [("cd ab",), (None,)]), ("v", None, None)], "article_url string, content_raw string, comments array<struct<comment_content:string>>")
    docs = docs.withColumn("comments", F.transform("comments", lambda c: c.withField("comment_keywords", F.lit(None).cast("array<string>"))))
    lexicon = spark.createDataFrame([("ab", 2.0, "Na"), ("cd", 2.0, "VA"), ("台北", 1.0, "x")], "word string, weight double, tag string")
    done = counts.enrich(docs, lexicon, "ckip", small=True)
    assert done._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    u, v = sorted(done.collect(), key=lambda r: r.article_url)
    assert u.content_keywords == ["ab", "cd", "ab"] and [c.comment_keywords for c in u.comments] == [["cd", "ab"], []]
    assert [tuple(t) for t in u.content_top_key] == [("ab", 2), ("cd", 1)] and [tuple(t) for t in u.comments_top_key] == [("cd", 1), ("ab", 1)]
    assert v.content_keywords == [] and v.comments is None and v.content_top_key == v.comments_top_key == []
