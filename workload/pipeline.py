"""Enrichment, pooled frequencies over time, file round trips and run audit."""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from hubbub.functions.times import time_range
from hubbub.operators import audit, counts, units
from hubbub.schemas import ARTICLE
from hubbub.session import shared_dir
from hubbub.sources import articles as article_files
from workload.base import (
    SQL_LEXICON, SQL_STOP, STOP, benchmark_lexicon, query, sql_is_term, sql_segments, sql_sentences, table, texts,
)


def nested_documents(spark, sf_dir):
    """Documents as nested articles: line 1 is the body, every other line a comment one hour later."""
    docs = texts(spark, sf_dir, "documents", "doc_id")
    lines = F.split("text", "\n")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("doc_id").cast("int"))

    def comment(line, i):
        at = start + F.make_dt_interval(F.lit(0), i + 1)
        return F.struct(
            F.col("source").alias("comment_author"), F.lit(None).cast("string").alias("comment_raw_time"),
            F.left(at.cast("string"), F.lit(19)).alias("comment_date_format"), F.year(at).alias("comment_year"),
            F.month(at).alias("comment_month"), F.dayofmonth(at).alias("comment_day"), F.lit("+").alias("comment_tag"),
            line.alias("comment_content"), F.lit(None).cast("array<string>").alias("comment_keywords"))

    comments = F.transform(F.slice(lines, F.lit(2), F.size(lines)), comment)
    values = {
        "article_source": F.lit("documents"), "article_url": F.concat(F.lit("doc/"), F.col("doc_id")),
        "article_title": F.get(lines, F.lit(0)), "article_category": F.col("lang"), "article_author": F.col("source"),
        "publish_time": F.left(start.cast("string"), F.lit(19)), "date_year": F.year(start), "date_month": F.month(start),
        "date_day": F.dayofmonth(start), "reaction_count": F.size(comments).cast("bigint"), "comment_count": F.size(comments).cast("bigint"),
        "content_raw": F.get(lines, F.lit(0)), "comments": comments,
    }
    return docs.select(*[
        values.get(f.name, F.array()).cast(f.dataType).alias(f.name) for f in ARTICLE.fields
    ])


def _pairs(column):
    return F.array_join(F.transform(column, lambda t: F.concat(t["word"], F.lit(":"), t["count"])), " ")


_TERMS = f"list_filter({sql_sentences('line')}, lambda x: {sql_is_term('x')} and x not in {SQL_STOP})"
SQL_UNITS = f"""
d as (select doc_id, text, string_split(text, chr(10)) as lines from documents),
u as (select doc_id, unnest(lines) as line, unnest(range(len(lines))) as unit_ix from d),
k as (select doc_id, unit_ix, {_TERMS} as words from u),
t as (select doc_id, unit_ix, unnest(words) as word, unnest(range(len(words))) as i from k),
c as (select doc_id, unit_ix > 0 as reply, word, count(*) as n, min((unit_ix, i)) as first_pos from t group by 1, 2, 3),
r as (select *, row_number() over (partition by doc_id, reply order by n desc, first_pos) as rank from c),
tops as (select doc_id, reply, string_agg(word || ':' || n, ' ' order by rank) as top from r where rank <= {counts.TOP_WORDS} group by 1, 2)
"""


@query(f"""with {SQL_UNITS} select 'doc/' || k.doc_id as article_url, array_to_string(words, ' ') as keywords,
  coalesce(a.top, '') as content_top, coalesce(b.top, '') as comments_top,
  coalesce((select string_agg(array_to_string(words, ' '), '|' order by unit_ix) from k q where q.doc_id = k.doc_id and unit_ix > 0), '') as comment_keywords
from k left join tops a on a.doc_id = k.doc_id and not a.reply left join tops b on b.doc_id = k.doc_id and b.reply where unit_ix = 0""")
def enriched_articles(spark, sf_dir):
    """Keywords written back into articles and comments with both top lists, all inside the row."""
    done = counts.enrich(nested_documents(spark, sf_dir), method="pieces", stop=STOP, segmented=False)
    return done.select(
        "article_url", F.array_join("content_keywords", " ").alias("keywords"),
        _pairs("content_top_key").alias("content_top"), _pairs("comments_top_key").alias("comments_top"),
        F.array_join(F.transform("comments", lambda c: F.array_join(c["comment_keywords"], " ")), "|").alias("comment_keywords"))


@query(f"""with recursive {SQL_LEXICON}, {sql_segments('documents')},
u as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as unit_ix from documents),
said as (select doc_id, unit_ix, unnest(b) as block, unnest(range(len(b))) as place
  from (select doc_id, unit_ix, regexp_extract_all(line, '[一-鿕a-zA-Z0-9+#&._%-]+') as b from u)),
kept as (select doc_id, unit_ix, place, i, word from said join cut using (block) where length(word) > 1 and (tag like 'N%' or tag like 'V%')),
c as (select doc_id, unit_ix > 0 as reply, word, count(*) as n, min((unit_ix, place, i)) as first_pos from kept group by 1, 2, 3),
r as (select *, row_number() over (partition by doc_id, reply order by n desc, first_pos) as rank from c),
tops as (select doc_id, reply, string_agg(word || ':' || n, ' ' order by rank) as top from r where rank <= {counts.TOP_WORDS} group by 1, 2),
words as (select doc_id, string_agg(word, ' ' order by place, i) as keywords from kept where unit_ix = 0 group by 1)
select 'doc/' || d.doc_id as article_url, coalesce(keywords, '') as keywords, coalesce(a.top, '') as content_top, coalesce(b.top, '') as comments_top
from documents d left join words w using (doc_id) left join tops a on a.doc_id = d.doc_id and not a.reply left join tops b on b.doc_id = d.doc_id and b.reply""")
def enriched_articles_tagged(spark, sf_dir):
    """Enrichment by dictionary segmentation, nouns and verbs kept."""
    done = counts.enrich(nested_documents(spark, sf_dir), benchmark_lexicon(spark, sf_dir), method="ckip")
    return done.select("article_url", F.array_join("content_keywords", " ").alias("keywords"),
                       _pairs("content_top_key").alias("content_top"), _pairs("comments_top_key").alias("comments_top"))


@query(f"""with {SQL_UNITS}, timed as (select word, timestamp '2024-01-01' + to_minutes(doc_id) + to_hours(unit_ix) as at_time from t),
top as (select word, count(*) as n from timed where at_time between timestamp '2024-01-01' and timestamp '2024-01-01 23:59:59' group by 1 order by n desc, word limit 80)
select word, n, round(n / max(n) over (), 6) as weight from top""")
def pooled_frequencies_in_range(spark, sf_dir):
    """Top words of one day: bodies and comments each by their own time."""
    done = counts.enrich(nested_documents(spark, sf_dir), method="pieces", stop=STOP, segmented=False)
    words = counts.pooled_words(done, *time_range("2024-01-01", "2024-01-01"))
    return counts.pooled_frequencies(words).withColumn("weight", F.round("weight", 6))


@query("""with d as (select doc_id, string_split(text, chr(10)) as lines from documents),
u as (select doc_id, unnest(lines) as text, unnest(range(len(lines))) as unit_ix from d)
select 'doc/' || doc_id as article_url, unit_ix::bigint as unit_ix, text from u""")
def text_units(spark, sf_dir):
    """Body and comments of nested articles as ordered units."""
    return units.text_units(nested_documents(spark, sf_dir)).withColumn("unit_ix", F.col("unit_ix").cast("bigint"))


@query(f"""with {SQL_UNITS} select 'doc/' || doc_id as article_url, array_to_string(flatten(list(words order by unit_ix)), ' ') as text from k group by doc_id""")
def pooled_article_text(spark, sf_dir):
    """All keywords of one article as blank-joined text."""
    done = counts.enrich(nested_documents(spark, sf_dir), method="pieces", stop=STOP, segmented=False)
    words = F.concat("content_keywords", F.flatten(F.transform("comments", lambda c: c["comment_keywords"])))
    return counts.pooled_text(done.select("article_url", words.alias("words")), ["article_url"])


@query("""with d as (select doc_id, lang, source, string_split(text, chr(10)) as lines from documents)
select 'doc/' || doc_id as article_url, lang as article_category, source as article_author, lines[1] as content_raw, len(lines)::bigint - 1 as comment_count,
  case when lang = 'de' then 'rejected' else 'read' end as outcome from d where lang <> 'de'
union all select null, null, null, null, null, 'rejected' from d where lang = 'de'""")
def article_io_roundtrip(spark, sf_dir):
    """Articles written as JSON and read back; German ones are cut in half on the way and must be set aside."""
    path = f"{shared_dir(spark)}/articles-{uuid.uuid4().hex}"
    rows = article_files.article_json(nested_documents(spark, sf_dir))
    text = F.to_json(F.struct(*rows.columns))
    broken = F.left(text, F.floor(F.char_length(text) / 2).cast("int"))
    rows.select(F.when(F.col("article_category") == "de", broken).otherwise(text).alias("value")).write.text(path)
    good, rejected = article_files.read_articles_tolerant(spark, path, lines=True)
    read = good.select("article_url", "article_category", "article_author", "content_raw", "comment_count", F.lit("read").alias("outcome"))
    aside = rejected.select(*[F.lit(None).cast("string").alias(c) for c in ("article_url", "article_category", "article_author", "content_raw")],
                            F.lit(None).cast("bigint").alias("comment_count"), F.lit("rejected").alias("outcome"))
    return read.unionByName(aside)


@query("""with d as (select doc_id, lang, source, string_split(text, chr(10)) as lines from documents)
select 'doc/' || doc_id as article_url, unnest(['file', 'line']) as form, lang as article_category, lines[1] as content_raw,
  len(lines)::bigint - 1 as comment_count, array_to_string(lines[2:], '|') as said, true as named, true as alone from d""")
def article_files_both_forms(spark, sf_dir):
    """Articles written as one object per file and as lines, both read strictly, with the name of their file."""
    path = f"{shared_dir(spark)}/forms-{uuid.uuid4().hex}"
    docs = nested_documents(spark, sf_dir)
    folders = article_files.write_article_files(docs, f"{path}/file")
    article_files.article_json(docs).write.json(f"{path}/line")
    # Files are many and a name is in one of them only, so they are opened once and counted as they meet.
    files = article_files.read_articles(spark, folders).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("source_filename")))
    lines = article_files.read_articles(spark, f"{path}/line", lines=True).withColumn("n", F.lit(1))
    out = [read.select(
        "article_url", F.lit(form).alias("form"), "article_category", "content_raw", "comment_count",
        F.array_join(F.transform("comments", lambda c: c["comment_content"]), "|").alias("said"),
        F.col("source_filename").endswith(".json").alias("named"), (F.col("n") == 1).alias("alone"))
        for form, read in (("file", files), ("line", lines))]
    return out[0].unionByName(out[1])


@query("""select lang as article_category, max(doc_id)::bigint as doc_id, string_split(text, chr(10))[1] as article_title from documents group by lang, string_split(text, chr(10))[1]""")
def article_write_last_wins(spark, sf_dir):
    """Written once per title and category, the last document winning, and read back by partition."""
    path = f"{shared_dir(spark)}/upsert-{uuid.uuid4().hex}"
    docs = nested_documents(spark, sf_dir)
    seq = F.split_part("article_url", F.lit("/"), F.lit(2)).cast("bigint")
    named = docs.withColumn("seq", seq).withColumn("output_name", F.concat_ws("_", "article_category", "article_title"))
    article_files.write_articles(named, path, key="output_name")
    return spark.read.parquet(path).select("article_category", F.col("seq").alias("doc_id"), "article_title")


@query("""with a as (select conv_id, count(*) filter (where turn = 0) as bodies, count(*) filter (where turn > 0) as comments,
    arg_min(role, turn) as author from conversations group by 1)
select author, count(*) as articles, sum(comments)::bigint as comments, max(comments) as most_comments,
  count(*) filter (where author = 'system') as missing_meta from a group by 1""")
def run_audit(spark, sf_dir):
    """Articles, comments and quality flags per author; conversations opened by the system have no author."""
    talks = table(spark, sf_dir, "conversations")
    per = talks.groupBy("conv_id").agg(F.count_if(F.col("turn") > 0).alias("comments"), F.min_by("role", "turn").alias("author"))
    flagged = per.withColumn("article_title", F.lit("talk")).withColumn(
        "article_author", F.when(F.col("author") == "system", audit.NO_AUTHOR).otherwise(F.col("author")))
    return flagged.groupBy("author").agg(
        F.count(F.lit(1)).alias("articles"), F.sum("comments").alias("comments"), F.max("comments").alias("most_comments"),
        F.count_if(audit.missing_meta()).alias("missing_meta"))
