"""News lists, link lists and card listings from pages."""

from functools import partial

from pyspark.sql import functions as F

from hubbub.functions.urls import absolute_url
from hubbub.operators.dedup import first_per_key
from hubbub.operators.ranking import first_match
from hubbub.sources.html import extract_pages
from hubbub.sources.readers import CARD_FIELDS, LINK_FIELDS, NEWS_FIELDS, read_cards, read_links, read_news

UNKNOWN = "Unknown"


def news_items(pages, base, scraped_time=None, label_length=20, label_levels=3, time_levels=5, no_label="articles"):
    """Article links of news pages, titles required, first seen per address.

    The source is the first text around the link, up to ``label_levels`` areas out, that is shorter than
    ``label_length``, is not the title, and does not link to ``no_label``; the time is the first one
    up to ``time_levels`` areas out.
    """
    keep = [c for c in pages.columns if c != "html"]
    rows = extract_pages(pages, partial(read_news, levels=max(label_levels, time_levels)), NEWS_FIELDS)
    rows = rows.select(*keep, F.explode("links").alias("l"))

    def is_label(n):
        short = F.char_length(n["text"]).between(1, label_length - 1) & (n["text"] != F.col("l.title"))
        leads_on = F.contains(F.coalesce(n["href"], F.lit("")), F.lit(no_label))
        return (n["level"] <= label_levels) & n["tag"].isin("a", "div") & short & ~leads_on

    label = first_match("l.near", is_label)["text"]
    time = first_match("l.near", lambda n: (n["level"] <= time_levels) & (n["tag"] == "time"))["time_attr"]
    items = rows.where(F.col("l.title") != "").select(
        *keep, "l.pos", "l.title", F.coalesce(label, F.lit(UNKNOWN)).alias("source"),
        absolute_url(base, "l.href").alias("url"), F.coalesce(time, F.lit(UNKNOWN)).alias("publish_time"),
        F.lit(scraped_time).cast("string").alias("scraped_time"),
    )
    return first_per_key(items, ["url"], keep + ["pos"])


def page_links(pages, base):
    """Every titled link of every page with its absolute address."""
    keep = [c for c in pages.columns if c != "html"]
    rows = extract_pages(pages, read_links, LINK_FIELDS).select(*keep, F.explode("links").alias("l"))
    return rows.where(F.col("l.title") != "").select(*keep, "l.pos", "l.title", absolute_url(base, "l.href").alias("link"))


def cards(pages, card_class, reaction_class, comment_class):
    """Cards of listing pages: title, reaction text, comment text."""
    keep = [c for c in pages.columns if c != "html"]
    reader = partial(read_cards, card_class=card_class, reaction_class=reaction_class, comment_class=comment_class)
    rows = extract_pages(pages, reader, CARD_FIELDS).select(*keep, F.explode("cards").alias("c"))
    return rows.select(*keep, "c.*")


def new_cards(found, order):
    """Cards of several scroll passes, each title once, at its first place."""
    return first_per_key(found, ["title"], order)
