"""Declared schemas of the document model. Nothing is inferred at read time."""

from pyspark.sql import types as T

TERM = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("count", T.LongType()),
])

COMMENT = T.StructType([
    T.StructField("comment_author", T.StringType()),
    T.StructField("comment_raw_time", T.StringType()),
    T.StructField("comment_date_format", T.StringType()),
    T.StructField("comment_year", T.IntegerType()),
    T.StructField("comment_month", T.IntegerType()),
    T.StructField("comment_day", T.IntegerType()),
    T.StructField("comment_tag", T.StringType()),
    T.StructField("comment_content", T.StringType()),
    T.StructField("comment_keywords", T.ArrayType(T.StringType())),
])

_HEAD = [
    T.StructField("article_source", T.StringType()),
    T.StructField("article_url", T.StringType()),
    T.StructField("article_title", T.StringType()),
    T.StructField("article_category", T.StringType()),
    T.StructField("article_author", T.StringType()),
    T.StructField("publish_time", T.StringType()),
    T.StructField("date_year", T.IntegerType()),
    T.StructField("date_month", T.IntegerType()),
    T.StructField("date_day", T.IntegerType()),
    T.StructField("reaction_count", T.LongType()),
    T.StructField("comment_count", T.LongType()),
    T.StructField("content_raw", T.StringType()),
    T.StructField("content_keywords", T.ArrayType(T.StringType())),
]

# On disk a top list is [["word", 3], ...]: mixed two-element arrays, which only read as text pairs.
_PAIRS = T.ArrayType(T.ArrayType(T.StringType()))

ARTICLE_JSON = T.StructType(_HEAD + [
    T.StructField("content_top_key", _PAIRS),
    T.StructField("comments", T.ArrayType(COMMENT)),
    T.StructField("comments_top_key", _PAIRS),
])

ARTICLE = T.StructType(_HEAD + [
    T.StructField("content_top_key", T.ArrayType(TERM)),
    T.StructField("comments", T.ArrayType(COMMENT)),
    T.StructField("comments_top_key", T.ArrayType(TERM)),
])

TASK = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("date", T.StringType()),
])

NEWS_ITEM = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("publish_time", T.StringType()),
    T.StructField("scraped_time", T.StringType()),
])

LEXICON = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("tag", T.StringType()),
    T.StructField("section", T.StringType()),
])

POST_PAYLOAD = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("forumAlias", T.StringType()),
    T.StructField("school", T.StringType()),
    T.StructField("createdAt", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("reactionCount", T.LongType()),
    T.StructField("commentCount", T.LongType()),
])

COMMENT_PAYLOAD = T.StructType([
    T.StructField("hidden", T.BooleanType()),
    T.StructField("createdAt", T.StringType()),
    T.StructField("school", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("floor", T.IntegerType()),
])

NEWS_COMMENT = T.StructType([
    T.StructField("user", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("time", T.LongType()),
    T.StructField("likes", T.LongType()),
])
