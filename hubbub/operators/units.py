"""Articles and comments as text units, sentences and tokens."""

from pyspark.sql import functions as F

from hubbub.functions.text import sentences

# Sort key of a token: unit above bit 32, place within the unit below.
_UNIT_STEP = 1 << 32


def explode_comments(articles, keys=("article_url",), where=None):
    """Nested comments to rows with their 0-based position.

    ``where`` (element -> condition) is applied inside the array, so dropped comments never
    become rows. Articles without comments give no rows.
    """
    comments = F.filter("comments", lambda c: c.isNotNull() & where(c)) if where else F.col("comments")
    # The outer form with a filter afterwards: the inner form would add a size test on the array
    # below, and a computed array would be built twice.
    rows = articles.select(*keys, F.posexplode_outer(comments).alias("comment_ix", "comment"))
    return rows.where(F.col("comment").isNotNull()).select(*keys, "comment_ix", "comment.*")


def text_units(articles, keys=("article_url",)):
    """Article body as unit 0, comment i (1-based) as unit i, without grouping any rows."""
    units = F.concat(
        F.array(F.coalesce("content_raw", F.lit(""))),
        F.transform(
            F.coalesce("comments", F.array().cast(articles.schema["comments"].dataType)),
            lambda c: F.coalesce(c["comment_content"], F.lit("")),
        ),
    )
    return articles.select(*keys, F.posexplode(units).alias("unit_ix", "text"))


def long_units(bodies, comments, keys, unit, text="text"):
    """Units from separate body and comment tables; ``unit`` numbers comments from 1."""
    body = bodies.select(*keys, F.lit(0).cast("bigint").alias("unit_ix"), F.col(text).alias("text"))
    rest = comments.select(*keys, F.col(unit).cast("bigint").alias("unit_ix"), F.col(text).alias("text"))
    return body.unionByName(rest)


def sentence_rows(units, by_line=False):
    """One row per sentence, in order within its unit."""
    keep = [c for c in units.columns if c != "text"]
    return units.select(*keep, F.posexplode(sentences("text", by_line)).alias("sent_ix", "sentence"))


def token_rows(units, tokens=None):
    """One row per token with ``tok_ix`` in the unit and a sortable ``pos`` in the article.

    ``tokens`` is an array expression or column; by default the sentence pieces themselves, which
    are the words of blank-separated languages.
    """
    tokens = sentences("text") if tokens is None else tokens
    keep = [c for c in units.columns if c not in ("text", "tokens", "tagged")]
    rows = units.select(*keep, F.posexplode(tokens).alias("tok_ix", "word"))
    return rows.withColumn("pos", F.col("unit_ix").cast("bigint") * F.lit(_UNIT_STEP) + F.col("tok_ix"))
