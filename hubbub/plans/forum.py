"""Forum boards: index pages to entries and tasks, article pages to articles and comments."""

from functools import partial

from pyspark.sql import functions as F

from hubbub.functions.text import strip_ws
from hubbub.functions.times import comment_time, date_parts, epoch_wall, last_two_tokens, url_epoch, wall_text
from hubbub.functions.urls import absolute_url
from hubbub.operators.audit import NO_AUTHOR, NO_TITLE
from hubbub.operators.joins import fits_broadcast
from hubbub.sources.html import extract_pages, landed
from hubbub.sources.readers import ARTICLE_FIELDS, INDEX_FIELDS, PREVIOUS_FIELDS, read_article, read_index, read_previous

# Header names, the paging label and the source name of this forum.
TITLE_TAG, AUTHOR_TAG, PREVIOUS_LABEL, SOURCE = "標題", "作者", "上頁", "PTT"


def index_entries(pages, base):
    """Index pages (``board``, ``page_seq``, ``html``, ...) to one row per entry."""
    found = extract_pages(pages, read_index, INDEX_FIELDS)
    kept = [c for c in pages.columns if c != "html"]
    rows = found.select(*kept, F.explode("entries").alias("e"))
    return rows.select(
        *kept, "e.pos", "e.title", absolute_url(base, "e.href").alias("url"), "e.date", "e.pinned",
    )


def previous_pages(pages, base, anywhere=False):
    """The 'previous page' address of each index page, NULL where there is none.

    It is the second paging button if that says so; with ``anywhere`` the first link of the page that does, case ignored."""
    if anywhere:
        found = extract_pages(pages, partial(read_previous, label=PREVIOUS_LABEL), PREVIOUS_FIELDS)
    else:
        found = extract_pages(pages, read_index, INDEX_FIELDS)
    link = F.when(F.col("prev_text").isNotNull() if anywhere else F.col("prev_text").contains(PREVIOUS_LABEL), absolute_url(base, "prev_href"))
    return found.select(*[c for c in pages.columns if c != "html"], link.alias("prev_url"))


def parse_articles(pages, source=SOURCE):
    """Article pages (``url``, ``html``, optional ``status_code``) to nested articles.

    Every page gives one row. ``status`` is ok, http_error, bad_url, no_container or parse_error;
    only ok rows have an article.
    """
    code = F.col("status_code") if "status_code" in pages.columns else F.lit(200)
    published = epoch_wall(url_epoch("url"))
    found = extract_pages(landed(pages, published.isNotNull()), read_article, ARTICLE_FIELDS)
    status = (
        F.when(published.isNull(), "bad_url").when(F.col("_refused"), "http_error")
        .when(F.col("page_error").isNotNull(), "parse_error")
        .when(~F.col("has_container"), "no_container").otherwise("ok")
    )
    def header(name):
        return F.col("header")[name]

    has_header = F.size("header") > 0
    found = found.withColumn("_published", published).withColumn("_has_header", has_header)
    complete = F.filter("pushes", lambda p: (
        p["tag"].isNotNull() & p["author"].isNotNull() & p["content"].isNotNull() & p["stamp"].isNotNull()
    ))
    # Staged, because lambdas evaluate a repeated expression each time: text and raw time, then the
    # repaired time, then the comment.
    raw = F.transform(complete, lambda p: F.struct(
        p["tag"].alias("tag"), p["author"].alias("author"), push_text(p["content"]).alias("content"),
        last_two_tokens(p["stamp"]).alias("raw_time")))
    timed = F.transform(raw, lambda p: F.struct(p.alias("p"), comment_time(p["raw_time"], F.col("_published")).alias("time")))
    comments = F.transform(timed, lambda t: push_comment(t["p"], t["time"]))
    # Counted before they become comments, so that a query of the number alone makes none.
    ok = found.withColumn("status", status).withColumn("_count", F.size(complete).cast("bigint")).withColumn("comments", comments)
    return ok.select(
        *[c for c in pages.columns if c not in ("url", "html", "status_code")],
        F.lit(source).alias("article_source"),
        F.col("url").alias("article_url"),
        F.coalesce(F.when(F.col("_has_header"), header(TITLE_TAG)), F.lit(NO_TITLE)).alias("article_title"),
        F.substring("board_text", 3, 2**31 - 1).alias("article_category"),
        F.when(F.col("_has_header"), F.coalesce(header(AUTHOR_TAG), F.lit(NO_AUTHOR))).otherwise("").alias("article_author"),
        wall_text("_published").alias("publish_time"),
        *date_parts("_published", "date"),
        F.col("_count").alias("reaction_count"),
        F.col("_count").alias("comment_count"),
        F.col("body").alias("content_raw"),
        F.array().cast("array<string>").alias("content_keywords"),
        F.array().cast("array<struct<word:string,count:bigint>>").alias("content_top_key"),
        "comments",
        F.array().cast("array<struct<word:string,count:bigint>>").alias("comments_top_key"),
        "header",
        "status",
        F.when(F.col("status") == "http_error", F.concat(F.lit("HTTP "), code.cast("string")))
        .otherwise(F.col("page_error")).alias("error"),
    )


def push_comment(push, time):
    """One push with its repaired time as a canonical comment struct."""
    return F.struct(
        push["author"].alias("comment_author"),
        push["raw_time"].alias("comment_raw_time"),
        wall_text(time).alias("comment_date_format"),
        *date_parts(time, "comment"),
        push["tag"].alias("comment_tag"),
        push["content"].alias("comment_content"),
        F.lit(None).cast("array<string>").alias("comment_keywords"),
    )


def push_text(content):
    """Comment text without its leading colon."""
    return strip_ws(F.substring(strip_ws(content), 2, 2**31 - 1))


def task_articles(tasks, pages):
    """The article of each task; a task whose page never landed gives an ``http_error`` row.

    ``pages`` must hold one page per url. Pages that no task names are dropped by their address before any page is
    parsed, and each of the others is parsed once, however many tasks name it.
    """
    wanted = tasks.select("url").where(F.col("url").isNotNull()).distinct()
    named = pages.join(F.broadcast(wanted) if fits_broadcast(wanted) else wanted, "url", "left_semi")
    parsed = parse_articles(named).withColumnRenamed("article_url", "url")
    found = tasks.join(parsed, "url", "left").withColumnRenamed("url", "article_url")
    missing = F.col("status").isNull()
    return found.withColumn("error", F.when(missing, "no page").otherwise(F.col("error"))).withColumn(
        "status", F.when(missing, "http_error").otherwise(F.col("status")))


def legacy_article(articles):
    """The older single-article shape: header map, body and comments without their time."""
    plain = F.transform("comments", lambda c: F.struct(
        c["comment_tag"].alias("tag"), c["comment_author"].alias("author"), c["comment_content"].alias("content"),
    ))
    return articles.select("article_url", F.col("header").alias("meta"), F.col("content_raw").alias("content"), plain.alias("comment"))


def good_and_bad(parsed):
    """Split parsed rows into articles to write and error rows."""
    good = parsed.where("status = 'ok'")
    bad = parsed.where("status <> 'ok'").select("article_url", "status", "error")
    return good, bad
