"""Quality flags, run totals and row counts."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from hubbub.functions.times import EPOCH_SENTINEL

# Defaults a parsed article carries when its header is missing, and the title an
# older check looked for.
NO_TITLE = "無標題"
NO_AUTHOR = "unknown"
OLD_MISSING_TITLE = "標題讀取失敗"


def missing_meta():
    """Author or title was not found on the page."""
    author, title = F.col("article_author"), F.col("article_title")
    return author.isin(NO_AUTHOR, "") | title.isin(NO_TITLE, OLD_MISSING_TITLE)


def missing_meta_compat():
    """The narrower check: only the 'unknown' author or a title no parser produces."""
    return (F.col("article_author") == NO_AUTHOR) | (F.col("article_title") == OLD_MISSING_TITLE)


def is_sentinel(time_text):
    """A comment time that fell back to 1970."""
    time_text = F.col(time_text) if isinstance(time_text, str) else time_text
    return F.coalesce(time_text.startswith(EPOCH_SENTINEL[:4]), F.lit(False))


def has_invalid_date():
    """Some comment of the article carries the fall-back time."""
    return F.coalesce(F.exists("comments", lambda c: is_sentinel(c["comment_date_format"])), F.lit(False))


def row_audit(articles):
    """One row per problem of an article: error, missing header or invalid comment date."""
    ok = F.col("status") == "ok"
    problems = F.filter(F.array(
        F.when(~ok, F.concat(F.lit("Error: "), F.coalesce("error", "status"))),
        F.when(ok & missing_meta(), F.lit("Missing Meta")),
        F.when(ok & has_invalid_date(), F.lit("Invalid Date")),
    ), lambda p: p.isNotNull())
    return articles.select("article_url", F.explode(problems).alias("problem"))


def listing_totals(tasks):
    """Counts of normal and pinned posts and the last normal post, per board."""
    normal = ~F.col("pinned")
    last = F.when(normal, F.col("seq"))
    return tasks.groupBy("board").agg(
        F.count_if(normal).alias("normal_count"),
        F.count_if("pinned").alias("pinned_count"),
        F.max_by("title", last).alias("last_title"),
        F.max_by("url", last).alias("last_url"),
        F.max(F.when(normal, F.col("page_seq"))).alias("last_page"),
    )


def observed(df, name, **metrics):
    """Attach row metrics that are filled as a side effect of the next action on ``df``.

    Returns (df, observation). Without metrics the row count is recorded.
    """
    watch = Observation(name)
    columns = [m.alias(k) for k, m in metrics.items()] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(watch, *columns), watch
