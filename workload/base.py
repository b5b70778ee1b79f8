"""Registry and the views that read the given tables as articles and comments."""

from pyspark.sql import functions as F

from hubbub.functions.text import DIGIT_SET, SENTENCE_BREAK

QUERIES, ORACLES = {}, {}


def query(sql=None, name=None):
    """Register a (spark, sf_dir) -> DataFrame callable, with SQL where SQL can say the same."""
    def register(run):
        key = name or run.__name__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark, sf_dir, name, key=None):
    """A table of long texts, dealt to all cores when its files give fewer splits than that.

    Large inputs have many splits and are read as they are, without a shuffle. Rows are dealt in turn, so no
    key's rows meet in one task.
    """
    rows = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


# --- SQL pieces ---------------------------------------------------------------------------

def sql_sentences(text):
    return f"list_filter(string_split_regex({text}, '{SENTENCE_BREAK}'), lambda x: x <> '')"


def sql_is_term(word):
    return f"(length({word}) > 1 and not regexp_full_match({word}, '[{DIGIT_SET}]+'))"


def sql_tokens(source, keys, text):
    """Rows of (keys, tok_ix from 0, word) for every sentence piece of a text column."""
    return (
        f"select {keys}, unnest({sql_sentences(text)}) as word, "
        f"unnest(range(len({sql_sentences(text)}))) as tok_ix from {source}"
    )


# --- threads: events of a user, the first one being the article -------------------------------

def thread_parts(spark, sf_dir):
    """Articles and comments from events. Rows are told apart by event id, which is unique, so a
    user with very many events is never gathered in one place."""
    events = table(spark, sf_dir, "events")
    first = events.groupBy("user_id").agg(F.min(F.struct("ts", "event_id")).alias("f")).select(F.col("f.event_id").alias("event_id"))
    articles = events.join(first, "event_id", "left_semi").select(
        "user_id", "event_id", F.col("ts").alias("publish_time"), F.col("event_type").alias("content_raw"))
    comments = events.join(first, "event_id", "left_anti").select(
        "user_id", "event_id", F.col("ts").alias("comment_time"), F.col("event_type").alias("comment_content"))
    return articles, comments


SQL_THREADS = """
first_event as (select user_id, arg_min(event_id, (ts, event_id)) as event_id from events group by user_id),
articles as (select e.* from events e semi join first_event f on e.event_id = f.event_id),
comments as (select e.* from events e anti join first_event f on e.event_id = f.event_id)
"""


# --- talks: conversations, turn 0 being the article --------------------------------------------

def talk_units(spark, sf_dir):
    talks = texts(spark, sf_dir, "conversations", "conv_id")
    return talks.select("conv_id", F.col("turn").alias("unit_ix"), "text")


# --- small parameters shared by queries ----------------------------------------------------

STOP = ("the", "and", "of", "to", "de", "la", "le", "les", "et", "que", "die", "der", "und", "el", "los")
SQL_STOP = "(" + ", ".join(f"'{w}'" for w in STOP) + ")"
KEYWORDS = ("click", "purch")
START, END = "2024-01-01", "2024-01-20"


def benchmark_lexicon(spark, sf_dir):
    """Dictionary of the benchmark texts' words: weight from frequency, tag and section from the word."""
    from hubbub.functions.text import is_term, sentences

    words = table(spark, sf_dir, "benchmark").select(F.explode(sentences("text")).alias("word")).where(is_term("word"))
    size = F.char_length("word")
    return words.groupBy("word").agg(F.count(F.lit(1)).cast("double").alias("weight")).select(
        "word", "weight",
        F.when(size < 4, "P").when(size < 7, "VA").otherwise("Na").alias("tag"),
        F.when(F.col("word") < "h", "NAMES").when(F.col("word") < "p", "PLACES").alias("section"),
    )


SQL_LEXICON = f"""
lexicon_words as (select unnest({sql_sentences('text')}) as word from benchmark),
lexicon as (
  select word, count(*)::double as weight,
    case when length(word) < 4 then 'P' when length(word) < 7 then 'VA' else 'Na' end as tag,
    case when word < 'h' then 'NAMES' when word < 'p' then 'PLACES' end as section
  from lexicon_words where {sql_is_term('word')} group by word)
"""


def sql_segments(texts):
    """CTEs that cut every different block of the column ``text`` of ``texts`` along its most probable path: ``cut`` holds
    (block, i, word, tag) with i rising, tag being the dictionary's or 'x'. Needs ``lexicon`` and WITH RECURSIVE."""
    return f"""
blocks as (select distinct unnest(regexp_extract_all(text, '[一-鿕a-zA-Z0-9+#&._%-]+')) as block from {texts}),
scale as (select ln(sum(greatest(weight, 1))) as total, max(length(word)) as longest from lexicon),
starts as (select block, unnest(range(length(block))) as s from blocks),
parts as (select block, s, unnest(range(s + 1, least(length(block), s + longest) + 1)) as e from starts, scale),
found as (select block, s, e, ln(greatest(weight, 1)) - total as score
  from parts join lexicon on word = substring(block, s + 1, e - s), scale),
words_of as (select block, list({{'s': s, 'e': e, 'score': score}}) as hits from found group by block),
path as (
  select b.block, length(b.block) as k, [0.0::double] as best, []::bigint[] as ends, coalesce(hits, []) as hits
  from blocks b left join words_of w on w.block = b.block
  union all
  select block, k - 1, list_prepend(top[1], best), list_prepend(top[2]::bigint, ends), hits from (
    select block, k, best, ends, hits, list_max(list_prepend([best[1] - total, k], list_transform(
      list_filter(hits, lambda h: h.s = k - 1), lambda h: [h.score + best[h.e - k + 1], h.e]))) as top
    from path, scale where k > 0)),
steps as (
  select block, ends, 0::bigint as s, ends[1] as e from path where k = 0
  union all
  select block, ends, e, ends[e + 1] from steps where e < length(block)),
cut as (select block, s as i, substring(block, s + 1, e - s) as word, coalesce(tag, 'x') as tag
  from steps left join lexicon on word = substring(block, s + 1, e - s))
"""
