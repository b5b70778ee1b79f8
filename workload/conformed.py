"""All five source plans in one schema, with their comments."""

from pyspark.sql import functions as F

from hubbub.operators.units import explode_comments
from hubbub.plans import forum, social
from workload.base import ORACLES, query, texts
from workload.forum import article_pages, lines_of
from workload.social import instagram_pages, news_pages, payloads, threads_pages


def _sources(spark, sf_dir):
    good, _ = forum.good_and_bad(forum.parse_articles(article_pages(spark, sf_dir)))
    return (
        good, social.payload_articles(payloads(spark, sf_dir)), social.threads_articles(threads_pages(spark, sf_dir)),
        social.instagram_articles(instagram_pages(spark, sf_dir)), social.news_articles(news_pages(spark, sf_dir)),
    )


def _union(columns, **oracles):
    return " union all ".join(f"select '{source}' as article_source, {columns} from ({ORACLES[name]})" for source, name in oracles.items())


@query(_union("article_url, article_title, content_raw", PTT="forum_articles", Dcard="payload_articles", Threads="threads_articles",
              Instagram="instagram_articles", Yahoo="news_articles"))
def conformed_articles(spark, sf_dir):
    """Every article of five sources, each through its own plan."""
    return social.one_schema(*_sources(spark, sf_dir)).select("article_source", "article_url", "article_title", "content_raw")


@query(_union("article_url, comment_author, comment_content, comment_date_format", PTT="forum_comments", Dcard="payload_comments", Yahoo="news_comments"))
def conformed_comments(spark, sf_dir):
    """Their comments, taken from the one schema."""
    rows = explode_comments(social.one_schema(*_sources(spark, sf_dir)), ("article_source", "article_url"))
    return rows.select("article_source", "article_url", "comment_author", "comment_content", "comment_date_format")


@query("""with l as (select doc_id, source, n_chars, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i from documents)
select doc_id, source as user_name, line as content, strftime(timestamp '2024-01-01 08:00:00' + to_seconds(doc_id * 60 + i * 3600), '%Y-%m-%d %H:%M:%S') as time,
  n_chars as likes, 0::bigint as reply_count from l""")
def news_messages(spark, sf_dir):
    """News comments in their own shape, with likes and replies."""
    lines = texts(spark, sf_dir, "documents", "doc_id").select("doc_id", "source", "n_chars", F.posexplode(lines_of()).alias("i", "content"))
    messages = lines.select("doc_id", F.col("source").alias("user"), "content", F.col("n_chars").alias("likes"),
                            (F.lit(1704067200) + F.col("doc_id") * 60 + F.col("i") * 3600).cast("bigint").alias("time"))
    return social.news_comments(messages)
