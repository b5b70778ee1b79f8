"""Word counts, top lists, keyword write-back and pooled frequencies."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from hubbub.functions.text import is_term, sentences
from hubbub.functions.times import in_range, parse_wall
from hubbub.operators.filters import content_words, is_content_tag, term_array
from hubbub.operators.joins import fits_broadcast
from hubbub.operators.ranking import top_per_group
from hubbub.operators.segment import by_join, collected, known_words, one_per_word
from hubbub.operators.units import text_units
from hubbub.session import durable, in_slices
from hubbub.sources.lexicon import STOP_WORDS

TOP_WORDS = 50
CLOUD_WORDS = 80


def term_counts(tokens, keys=("article_url",)):
    """Count each word per article and remember where it was first seen.

    Both aggregates combine before the shuffle, so a frequent word costs one row per task.
    """
    return tokens.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"))


def top_terms(counts, keys=("article_url",), n=TOP_WORDS):
    """The n most frequent words per article, ties in first-seen order."""
    order = [F.col("n").desc(), F.col("first_pos").asc()]
    return top_per_group(counts, list(keys), order, n)


def _counted(docs, key):
    """A row's terms sorted, so that equal words stand together: ``_terms`` holds (n, first_pos, word) of each word.

    Staged, because lambdas evaluate a repeated expression each time."""
    placed = F.transform(sentences("text"), lambda w, i: F.struct(w.alias("word"), i.cast("bigint").alias("pos")))
    rows = docs.select(key, F.sort_array(F.filter(placed, lambda t: is_term(t["word"]))).alias("_sorted"))
    at = lambda i: F.get(F.col("_sorted"), i)
    begins = F.transform("_sorted", lambda t, i: F.when((i == 0) | (t["word"] != at(i - 1)["word"]), i))
    rows = rows.select(key, "_sorted", F.filter(begins, lambda i: i.isNotNull()).alias("_begin"))
    ends = F.slice(F.concat("_begin", F.array(F.size("_sorted"))), F.lit(2), F.size("_begin"))
    terms = F.zip_with("_begin", ends, lambda a, b: F.struct((b - a).cast("bigint").alias("n"), at(a)["pos"].alias("first_pos"), at(a)["word"].alias("word")))
    return rows.select(key, terms.alias("_terms"))


def _by_key(docs, key, alone, together):
    """``alone`` of the texts whose key no other row has, and ``together`` of the tokens of all others."""
    repeated = docs.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col(key).alias("_again"))
    if repeated.isEmpty():
        return alone(docs)
    same = F.col(key).eqNullSafe(F.col("_again"))
    words = docs.join(repeated, same, "left_semi").select(key, F.posexplode(sentences("text")).alias("pos", "word")).where(is_term("word"))
    return alone(docs.join(repeated, same, "left_anti")).unionByName(together(words.withColumn("pos", F.col("pos").cast("bigint"))))


def words_per_text(docs, key="doc_id"):
    """(key, word, n): the terms of each key's ``text``, counted inside the row unless other rows have the same key."""
    def alone(rows):
        # The outer forms keep the optimiser from computing the words again to test them for emptiness.
        return _counted(rows, key).select(key, F.explode_outer("_terms").alias("t")).where("t is not null").select(key, "t.word", "t.n")

    return _by_key(docs, key, alone, lambda tokens: tokens.groupBy(key, "word").agg(F.count(F.lit(1)).alias("n")))


def top_words_per_text(docs, key="doc_id", n=TOP_WORDS):
    """(key, word, n, rank): ``top_terms`` of each key's ``text``, found inside the row unless other rows have the same key."""
    def alone(rows):
        ranked = F.sort_array(F.transform("_terms", lambda t: F.struct((-t["n"]).alias("less"), t["first_pos"].alias("first_pos"), t["word"].alias("word"))))
        top = _counted(rows, key).select(key, F.posexplode_outer(F.slice(ranked, 1, n)).alias("at", "t")).where("t is not null")
        return top.select(key, "t.word", (-F.col("t.less")).alias("n"), (F.col("at") + 1).alias("rank"))

    return _by_key(docs, key, alone, lambda tokens: top_terms(term_counts(tokens, [key]), [key], n).select(key, "word", "n", "rank"))


_DONE = "body_top array<struct<word:string,count:bigint>>, comments_top array<struct<word:string,count:bigint>>"


def enrich(articles, lexicon=None, method="jieba", top_n=TOP_WORDS, stop=STOP_WORDS, segmented=True, small=None):
    """Write keywords back into each article and its comments, with both top lists.

    Everything happens inside the row, so no article is shuffled. ``method='jieba'`` keeps terms
    that are no stop words, ``method='ckip'`` keeps nouns and verbs. ``segmented=False`` takes
    the sentence pieces as words (blank-separated languages). With a dictionary beyond the
    broadcast limit the words are found by join and brought back to their row; the result is the same.
    """
    spark = articles.sparkSession
    if segmented and lexicon is not None:
        lexicon = one_per_word(lexicon)
        small = fits_broadcast(lexicon) if small is None else small
    joined = segmented and lexicon is not None and not small
    shared = None
    if segmented and not joined:
        shared = spark.sparkContext.broadcast([] if lexicon is None else collected(lexicon))

    @F.arrow_udf("array<array<string>>")
    def cut_units(texts: pa.Array) -> pa.Array:
        return in_slices(texts, cut)

    def cut(texts):
        known = known_words(shared)
        words, _, _, counts = known.pieces(texts.flatten().to_pylist(), known.spoken)
        return _lists(_lengths(texts), _lists(counts, words))

    fields = T.StructType.fromDDL(_DONE)
    both = T.StructType(fields.fields + [T.StructField("units", T.ArrayType(T.ArrayType(T.StringType())))])
    kind, both_kind = to_arrow_type(fields), to_arrow_type(both)

    def tops(column):
        units = column.flatten()
        return pa.StructArray.from_arrays(_top_lists(_lengths(column), _lengths(units), units.flatten(), top_n), fields.names).cast(kind)

    @F.arrow_udf(fields)
    def finish(column: pa.Array) -> pa.Array:
        return in_slices(column, tops)

    def cut_and_count(texts):
        known, units = known_words(shared), _lengths(texts)
        words, kinds, sizes, counts = known.pieces(texts.flatten().to_pylist(), known.spoken)
        # As ``content_words`` has it, asked once for each tag.
        kept = np.array([False, *map(is_content_tag, known.kinds)])[kinds] & (sizes > 1)
        words = words.filter(pa.array(kept))
        counts = np.diff(np.concatenate([[0], np.cumsum(kept)])[np.cumsum(counts)], prepend=0)
        out = [*_top_lists(units, counts, words, top_n), _lists(units, _lists(counts, words))]
        return pa.StructArray.from_arrays(out, both.names).cast(both_kind)

    @F.arrow_udf(both)
    def content_units(texts: pa.Array) -> pa.Array:
        return in_slices(texts, cut_and_count)

    no_comments = F.array().cast(articles.schema["comments"].dataType)
    texts = F.concat(
        F.array(F.coalesce("content_raw", F.lit(""))),
        F.transform(F.coalesce("comments", no_comments), lambda c: F.coalesce(c["comment_content"], F.lit(""))),
    )
    if segmented and method == "ckip" and not joined:
        # Most words are dropped, so they are where they are cut, and the others counted.
        done = articles.withColumn("_done", content_units(texts)).withColumn("_units", F.col("_done.units"))
    else:
        if joined:
            tagged = _cut_by_join(articles, lexicon)
            said = lambda unit: F.transform(unit, lambda t: t["word"])
            units = F.transform("_tagged", lambda unit: content_words(unit) if method == "ckip" else term_array(said(unit), stop))
        elif segmented:
            tagged = articles.withColumn("_tagged", cut_units(texts))
            units = F.transform("_tagged", lambda unit: term_array(unit, stop))
        else:
            tagged, units = articles, F.transform(texts, lambda text: term_array(sentences(text), stop))
        done = tagged.withColumn("_units", units)
        done = done.withColumn("_done", finish("_units"))
    comments = F.transform("comments", lambda c, i: c.withField("comment_keywords", F.get(F.col("_units"), i + 1)))
    return (
        done.withColumn("content_keywords", F.get("_units", F.lit(0)))
        .withColumn("content_top_key", F.col("_done.body_top"))
        .withColumn("comments_top_key", F.col("_done.comments_top"))
        .withColumn("comments", comments)
        .withColumn("method", F.lit(method))
        .drop("_tagged", "_done", "_units")
    )


def _cut_by_join(articles, lexicon):
    """Segment every unit by join and bring an article's units, its own text, together."""
    numbered = durable(articles.withColumn("_row", F.monotonically_increasing_id()))
    cut = by_join(durable(text_units(numbered, ["_row"])), lexicon, "x")
    units = cut.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("unit_ix", "tagged"))).alias("_units"))

    return numbered.join(units, "_row", "left").select(*articles.columns, F.transform("_units", lambda u: u["tagged"]).alias("_tagged"))


def _lengths(lists):
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _lists(lengths, values):
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def _top_lists(units, counts, words, n):
    """The n most frequent words of each article's body and of its comments, ties in first-seen order, as Arrow lists of words with
    their counts. ``units`` says how many units an article has, the first being its body, and ``counts`` how many words a unit."""
    article = np.repeat(np.arange(len(units)), units)
    reply = np.arange(len(article)) != (np.cumsum(units) - units)[article]
    coded = words.dictionary_encode(null_encoding="encode")
    each = max(len(coded.dictionary), 1)
    keys = np.repeat(2 * article + reply, counts) * each + coded.indices.to_numpy()
    keys, first, times = np.unique(keys, return_index=True, return_counts=True)
    order = np.lexsort((first, -times, keys // each))
    group, word, times = (keys // each)[order], (keys % each)[order], times[order]
    rank = np.arange(len(group)) - np.searchsorted(group, group)
    out = []
    for part in (0, 1):
        own = (rank < n) & (group % 2 == part)
        top = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(word[own])), pa.array(times[own])], ["word", "count"])
        out.append(_lists(np.bincount(group[own] // 2, minlength=len(units)), top))
    return out


def pooled_words(articles, start, end):
    """All keywords of bodies and of comments, each filtered by its own time, as rows.

    One pass: each text stays with its own time until the rows outside the range are gone. The outer form
    keeps the optimiser from computing the words a second time to test them for emptiness.
    """
    body = F.struct(parse_wall("publish_time").alias("at"), F.col("content_keywords").alias("words"))
    said = F.transform("comments", lambda c: F.struct(parse_wall(c["comment_date_format"]).alias("at"), c["comment_keywords"].alias("words")))
    none = F.array().cast("array<struct<at:timestamp_ntz,words:array<string>>>")
    texts = articles.select(F.explode_outer(F.concat(F.array(body), F.coalesce(said, none))).alias("t"))
    words = texts.where(in_range(F.col("t.at"), start, end)).select(F.explode_outer("t.words").alias("word"))
    return words.where(F.col("word").isNotNull())


def pooled_frequencies(words, n=CLOUD_WORDS):
    """Corpus-wide counts of the n most frequent words with weights relative to the top one."""
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.col("n").desc(), F.col("word").asc()).limit(n)
    # At most n rows are left here, so one unpartitioned window is harmless.
    return top.withColumn("weight", F.col("n") / F.max("n").over(Window.partitionBy()))


def pooled_text(words, keys):
    """Words of each group as blank-joined text, for groups of bounded size such as one article row."""
    return words.select(*keys, F.array_join("words", " ").alias("text"))
