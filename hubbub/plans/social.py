"""Social posts and API payloads to the canonical article shape."""

from functools import reduce

from pyspark.sql import functions as F

from hubbub.functions.times import date_parts, epoch_wall, iso_offset_wall, iso_utc_wall, parse_wall, wall_text
from hubbub.functions.urls import canonical_url, rewrite_host
from hubbub.operators.audit import NO_TITLE
from hubbub.operators.joins import hot_keys, skewed_join
from hubbub.operators.ranking import first_match
from hubbub.schemas import COMMENT, COMMENT_PAYLOAD, POST_PAYLOAD
from hubbub.sources.html import extract_pages, landed
from hubbub.sources.readers import HEAD_FIELDS, read_head
from pyspark.sql import types as T

# Defaults for absent fields and marks in page titles.
ANONYMOUS, UNKNOWN, NO_HEADING = "匿名", "Unknown", "Unknown Title"
LOGIN_WALLS = ("Login • Instagram", "登入 • Instagram")

_LD = (
    "struct<headline:string,articleBody:string,datePublished:string,author:string,"
    "interactionStatistic:array<struct<interactionType:string,userInteractionCount:bigint>>>"
)
_PERSON = "struct<name:string>"
_NO_COMMENTS = T.ArrayType(COMMENT)
_NO_TERMS = "array<struct<word:string,count:bigint>>"


def _article(df, keep, **fields):
    """Canonical columns from expressions; counts default to 0, texts to NULL."""
    time = fields["time"]
    return df.select(
        *keep,
        F.lit(fields["source"]).alias("article_source"),
        fields["url"].alias("article_url"),
        fields["title"].alias("article_title"),
        fields.get("category", F.lit(None).cast("string")).alias("article_category"),
        fields.get("author", F.lit(None).cast("string")).alias("article_author"),
        wall_text(time).alias("publish_time"),
        *date_parts(time, "date"),
        fields.get("reactions", F.lit(0)).cast("bigint").alias("reaction_count"),
        fields.get("replies", F.lit(0)).cast("bigint").alias("comment_count"),
        fields["content"].alias("content_raw"),
        F.array().cast("array<string>").alias("content_keywords"),
        F.array().cast(_NO_TERMS).alias("content_top_key"),
        fields.get("comments", F.array().cast(_NO_COMMENTS)).alias("comments"),
        F.array().cast(_NO_TERMS).alias("comments_top_key"),
        fields.get("status", F.lit("ok")).alias("status"),
    )


def payload_comments(shown):
    """API comments as canonical structs; the floor becomes the tag."""
    # The time is read once per comment, because lambdas evaluate a repeated expression each time.
    timed = F.transform(shown, lambda c: F.struct(c.alias("c"), iso_utc_wall(c["createdAt"]).alias("time")))
    return F.transform(timed, lambda t: _payload_comment(t["c"], t["time"]))


def _payload_comment(c, time):
    return F.struct(
        F.coalesce(c["school"], F.lit(ANONYMOUS)).alias("comment_author"),
        c["createdAt"].alias("comment_raw_time"),
        wall_text(time).alias("comment_date_format"),
        *date_parts(time, "comment"),
        F.concat(F.lit("B"), F.coalesce(c["floor"], F.lit(0)).cast("string")).alias("comment_tag"),
        F.coalesce(c["content"], F.lit("")).alias("comment_content"),
        F.lit(None).cast("array<string>").alias("comment_keywords"),
    )


def is_visible(c):
    return ~F.coalesce(c["hidden"], F.lit(False))


def payload_articles(payloads, source="Dcard"):
    """Landed payloads (``url``, ``post``, ``comments`` JSON text) to articles.

    An unreadable post has status ``bad_payload``; unreadable comments count as none.
    """
    keep = [c for c in payloads.columns if c not in ("url", "post", "comments")]
    df = payloads.withColumn("post", F.from_json("post", POST_PAYLOAD)).withColumn(
        "comments", F.from_json("comments", T.ArrayType(COMMENT_PAYLOAD))
    )
    p = F.col("post")
    shown = F.filter(F.coalesce("comments", F.array().cast(T.ArrayType(COMMENT_PAYLOAD))), is_visible)
    return _article(
        df, keep, source=source, url=F.col("url"),
        title=F.coalesce(p["title"], F.lit(NO_TITLE)), category=F.coalesce(p["forumAlias"], F.lit(UNKNOWN)),
        author=F.coalesce(p["school"], F.lit(ANONYMOUS)), time=iso_utc_wall(p["createdAt"]),
        reactions=F.coalesce(p["reactionCount"], F.lit(0)), replies=F.coalesce(p["commentCount"], F.lit(0)),
        content=F.coalesce(p["content"], F.lit("")), comments=payload_comments(shown),
        status=F.when(p.isNull() | F.coalesce(p["title"], p["content"], p["createdAt"]).isNull(), "bad_payload").otherwise("ok"),
    )


def payload_listing(payloads):
    """Posts of forum listings (``listing``: a JSON array of posts) as rows in listing order."""
    posts = F.from_json("listing", T.ArrayType(T.StructType([T.StructField("id", T.LongType())] + POST_PAYLOAD.fields)))
    keep = [c for c in payloads.columns if c != "listing"]
    return payloads.select(*keep, F.posexplode(posts).alias("pos", "p")).select(*keep, "pos", "p.*")


def payload_comment_rows(posts, comments, key="post_id"):
    """Visible comments (one JSON object per row) next to their post, as long rows.

    A post with very many comments keeps them spread over tasks: nothing is gathered per post.
    """
    shown = F.filter(F.array(F.from_json("comment", COMMENT_PAYLOAD)), is_visible)
    parsed = comments.select(key, F.explode_outer(payload_comments(shown)).alias("_c"))
    rows = parsed.where(F.col("_c").isNotNull()).select(key, "_c.*")
    heads = posts.withColumn("_p", F.from_json("post", POST_PAYLOAD)).select(
        key, F.coalesce("_p.title", F.lit(NO_TITLE)).alias("article_title"),
        F.coalesce("_p.forumAlias", F.lit(UNKNOWN)).alias("article_category"),
        wall_text(iso_utc_wall("_p.createdAt")).alias("publish_time"),
    )
    return skewed_join(rows, heads, key, how="inner", hot=hot_keys(comments, key))


def _before(text, mark):
    return F.split_part(text, F.lit(mark), F.lit(1))


def linked_objects(blocks):
    """JSON-LD blocks as single objects, in order: lists give their elements, an object is followed by those of its graph."""
    def objects(block):
        parsed = F.try_parse_json(block)
        listed = F.try_variant_get(parsed, "$", "array<variant>")
        graph = F.coalesce(F.try_variant_get(parsed, "$['@graph']", "array<variant>"), F.array().cast("array<variant>"))
        return F.when(listed.isNotNull(), F.transform(listed, lambda o: F.to_json(o))).otherwise(F.concat(F.array(block), F.transform(graph, lambda o: F.to_json(o))))

    # Few blocks are lists or graphs: only these are parsed as such.
    wrapped = lambda b: F.ltrim(b).startswith("[") | b.contains('"@graph"')
    return F.flatten(F.transform(blocks, lambda b: F.when(wrapped(b), objects(b)).otherwise(F.array(b))))


def threads_articles(pages):
    """Pages with JSON-LD: the first object that is an article, otherwise Open Graph tags."""
    found = extract_pages(landed(pages), read_head, HEAD_FIELDS)
    keep = [c for c in pages.columns if c not in ("url", "html")]
    # An article block is a JSON object with one of the two keys; unreadable blocks have no keys.
    block = first_match(linked_objects(F.col("ld_blocks")), lambda b: F.coalesce(
        F.arrays_overlap(F.json_object_keys(b), F.array(F.lit("articleBody"), F.lit("headline"))), F.lit(False)))
    df = found.withColumn("_ld", F.from_json(block, _LD)).withColumn("_has_ld", block.isNotNull())
    ld, has_ld = F.col("_ld"), F.col("_has_ld")
    listed = F.from_json(ld["author"], f"array<{_PERSON}>")
    person = F.when(ld["author"].startswith("["), F.get(listed, F.lit(0))["name"]).otherwise(
        F.from_json(ld["author"], _PERSON)["name"])
    og_title = F.coalesce("og_title", F.lit(NO_TITLE))
    og_author = F.when(og_title.contains(" on Threads"), _before(og_title, " on Threads")).otherwise(UNKNOWN)
    stats = F.coalesce(ld["interactionStatistic"], F.array().cast("array<struct<interactionType:string,userInteractionCount:bigint>>"))
    return _article(
        df, keep, source="Threads", url=rewrite_host("url", "threads.com", "threads.net"),
        title=F.when(has_ld, F.coalesce(ld["headline"], F.lit(NO_TITLE))).otherwise(F.concat(F.lit("Threads Post by "), og_author)),
        category=F.lit("General"),
        author=F.when(has_ld, F.coalesce(person, F.lit(UNKNOWN))).otherwise(og_author),
        time=iso_offset_wall(ld["datePublished"]),
        reactions=interaction_count(stats, "LikeAction"), replies=interaction_count(stats, "CommentAction", "LikeAction"),
        content=F.when(has_ld, F.coalesce(ld["articleBody"], F.lit(""))).otherwise(F.coalesce("og_description", F.lit(""))),
        status=F.when(F.col("_refused"), "http_error").when(F.col("page_error").isNotNull(), "parse_error").otherwise("ok"),
    )


def interaction_count(stats, kind, unless=None):
    """Count of the last statistic of a kind, 0 without one."""
    def of_kind(s):
        match = s["interactionType"].contains(kind)
        return match & ~s["interactionType"].contains(unless) if unless else match

    last = F.get(F.reverse(F.filter(stats, of_kind)), F.lit(0))
    return F.coalesce(last["userInteractionCount"], F.lit(0))


def instagram_articles(pages):
    """Pages with Open Graph tags only; a login page gives status ``login_wall``."""
    walled = pages.withColumn("_wall", reduce(lambda a, b: a | b, [F.col("html").contains(w) for w in LOGIN_WALLS]))
    found = extract_pages(landed(walled), read_head, HEAD_FIELDS)
    keep = [c for c in pages.columns if c not in ("url", "html")]
    title, text = F.coalesce("og_title", F.lit("Instagram Post")), F.coalesce("og_description", F.lit(""))
    quoted = F.instr(text, ': "') > 0
    body = F.rtrim(F.substring(text, F.instr(text, ': "') + 3, F.lit(2**31 - 1)), F.lit('"'))
    author = F.when(quoted & title.contains(" on Instagram"), _before(title, " on Instagram")).otherwise(UNKNOWN)
    return _article(
        found, keep, source="Instagram", url=canonical_url("url"),
        title=F.concat(F.lit("IG Post by "), author), category=F.lit("Post"), author=author,
        time=F.lit(None).cast("timestamp_ntz"), content=F.when(quoted, body).otherwise(text),
        status=F.when(F.col("_refused"), "http_error").when(F.col("_wall"), "login_wall").when(F.col("page_error").isNotNull(), "parse_error").otherwise("ok"),
    )


def news_articles(pages, source="Yahoo", zone="Asia/Taipei"):
    """News pages with a ``messages`` JSON array: heading, body paragraphs, time and comments."""
    messages = F.from_json("messages", "array<struct<user:string,content:string,time:bigint,likes:bigint>>")
    found = extract_pages(landed(pages), read_head, HEAD_FIELDS)
    keep = [c for c in pages.columns if c not in ("url", "html", "messages")]

    def comment(m, time):
        return F.struct(
            m["user"].alias("comment_author"), m["time"].cast("string").alias("comment_raw_time"),
            wall_text(time).alias("comment_date_format"), *date_parts(time, "comment"),
            F.lit(None).cast("string").alias("comment_tag"), m["content"].alias("comment_content"),
            F.lit(None).cast("array<string>").alias("comment_keywords"),
        )

    timed = F.transform(messages, lambda m: F.struct(m.alias("m"), epoch_wall(m["time"], zone).alias("time")))
    comments = F.coalesce(F.transform(timed, lambda t: comment(t["m"], t["time"])), F.array().cast(_NO_COMMENTS))
    time = F.coalesce(iso_utc_wall("time_attr"), iso_offset_wall("time_attr"), parse_wall("time_attr"))
    return _article(
        found, keep, source=source, url=F.col("url"), title=F.coalesce("h1", F.lit(NO_HEADING)),
        time=time, content=F.coalesce(F.array_join("paragraphs", "\n"), F.lit("")),
        replies=F.size(comments), comments=comments,
        status=F.when(F.col("_refused"), "http_error").when(F.col("page_error").isNotNull(), "parse_error").otherwise("ok"),
    )


def news_comments(messages, zone="Asia/Taipei"):
    """News messages in their own shape: user, content, local time, likes, no replies."""
    return messages.select(
        *[c for c in messages.columns if c not in ("user", "content", "time", "likes")],
        F.col("user").alias("user_name"), "content", wall_text(epoch_wall("time", zone)).alias("time"),
        "likes", F.lit(0).cast("bigint").alias("reply_count"),
    )


def one_schema(*sources):
    """Union of per-source article tables; columns a source lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
