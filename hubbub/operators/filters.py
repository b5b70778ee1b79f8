"""Word filters: terms, stop words, parts of speech, dictionary sections."""

from pyspark.sql import functions as F

from hubbub.functions.text import is_term
from hubbub.operators.joins import lookup_join
from hubbub.sources.lexicon import STOP_WORDS

_LITERAL_WORDS = 10_000


def keep_terms(tokens, stop=STOP_WORDS, word="word"):
    """Rows whose word is a term and no stop word. Repeats are kept.

    Up to ``_LITERAL_WORDS`` given words are tested in place by hash set; a table, or a larger
    collection, is an anti join (broadcast if measured small). A missing stop word stops nothing.
    """
    tokens = tokens.where(is_term(word))
    if not hasattr(stop, "join") or isinstance(stop, str):
        stop = [w for w in stop if w is not None]
        if len(stop) <= _LITERAL_WORDS:
            return tokens.where(~F.col(word).isin(*stop)) if stop else tokens
        stop = tokens.sparkSession.createDataFrame([(w,) for w in stop], "word string")
    stop = stop.where(F.col("word").isNotNull()).select(F.col("word").alias(word)).distinct()
    return lookup_join(tokens, stop, [word], "left_anti")


def term_array(words, stop=STOP_WORDS):
    """The same filter inside an array, order and repeats kept."""
    stop = [w for w in stop if w is not None]
    return F.filter(words, lambda w: is_term(w) & ~w.isin(*stop) if stop else is_term(w))


def is_content_tag(tag):
    """Noun or verb tags, of a column or of one tag."""
    return tag.startswith("N") | tag.startswith("V")


def zip_tags(words, tags):
    """Pair words with tags by position, up to the shorter of the two."""
    n = F.least(F.size(words), F.size(tags))
    return F.arrays_zip(F.slice(words, F.lit(1), n).alias("word"), F.slice(tags, F.lit(1), n).alias("pos"))


def content_words(tagged):
    """Words of (word, pos) pairs with a content tag and more than one character."""
    kept = F.filter(tagged, lambda t: is_content_tag(t["pos"]) & (F.char_length(t["word"]) > 1))
    return F.transform(kept, lambda t: t["word"])


def tag_words(tokens, lexicon, default="x", word="word"):
    """Add the dictionary tag and section of each word."""
    table = lexicon.select(F.col("word").alias(word), F.col("tag").alias("pos_tag"), "section")
    tagged = lookup_join(tokens, table, [word], "left")
    return tagged.withColumn("pos_tag", F.coalesce("pos_tag", F.lit(default)))


def gazetteer_hits(tokens, lexicon, sections=None, word="word"):
    """Words listed in a dictionary section (names, places, brands), with that section."""
    table = lexicon.where(F.col("section").isNotNull())
    if sections is not None:
        table = table.where(F.col("section").isin(*sections))
    return lookup_join(tokens, table.select(F.col("word").alias(word), "section"), [word], "inner")
