"""Task lists, dictionaries, enriched areas and cells written as files and read again."""

import uuid

from pyspark.sql import functions as F

from hubbub.functions.text import output_name
from hubbub.operators import audit
from hubbub.session import shared_dir
from hubbub.sources import articles as article_files
from hubbub.sources import lexicon, store, tasks
from workload.base import SQL_LEXICON, benchmark_lexicon, query, table
from workload.pipeline import nested_documents


def _folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("""select (doc_id % 50)::bigint as seq, string_split(text, chr(10))[1] as title, 'doc/' || doc_id as url, ' 1/' || (doc_id % 28 + 1) as date, null::varchar as problem from documents
union all select null, null, null, null, 'not a task list' from documents where doc_id % 50 = 0
union all select null, null, null, null, 'task file not found'""")
def task_list_files(spark, sf_dir):
    """Task files of 50 entries, whose order is their place in the file; each has a broken neighbour, and one
    file that is asked for is missing."""
    path = _folder(spark, "tasks")
    # doc_id is unique, so a file never holds more than 50 entries.
    entry = F.struct(
        F.get(F.split("text", "\n"), F.lit(0)).alias("title"), F.concat(F.lit("doc/"), "doc_id").alias("url"),
        F.concat(F.lit(" 1/"), F.col("doc_id") % 28 + 1).alias("date"))
    files = table(spark, sf_dir, "documents").groupBy(F.floor(F.col("doc_id") / 50).alias("f")).agg(
        F.array_sort(F.collect_list(F.struct("doc_id", entry.alias("e")))).alias("own"))
    whole = F.to_json(F.transform("own", lambda o: o["e"]))
    both = files.select(F.explode(F.array(whole, F.lit('{"title": "no list"'))).alias("value"))
    both.write.option("maxRecordsPerFile", 1).text(path)
    good, bad = tasks.read_tasks(spark, path)
    _, missing = tasks.read_tasks(spark, f"{path}-elsewhere")
    rows = good.select("seq", "title", "url", "date", F.lit(None).cast("string").alias("problem"))
    return rows.unionByName(bad.unionByName(missing).select("problem"), allowMissingColumns=True)


@query("""select o_orderkey % 1000 as seq, o_orderstatus as title, 'order/' || o_orderkey as url, o_orderpriority as date, 'run' as run_ts from orders""")
def task_list_written(spark, sf_dir):
    """Tasks written below their run's folder and read back with their order."""
    path = _folder(spark, "runs")
    rows = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % 1000).alias("seq"), F.col("o_orderstatus").alias("title"), F.concat(F.lit("order/"), "o_orderkey").alias("url"), F.col("o_orderpriority").alias("date"))
    tasks.write_tasks(rows, path, "run")
    return spark.read.schema("seq long, title string, url string, date string").json(path + "/run_ts=run").withColumn("run_ts", F.lit("run"))


@query("""select 'doc/' || doc_id as article_url, unnest(['ckip', 'jieba']) as method, string_split(text, chr(10))[1] as content_raw from documents""")
def method_areas(spark, sf_dir):
    """Articles of two methods written to one area each and read back by area."""
    path = _folder(spark, "methods")
    docs = nested_documents(spark, sf_dir).withColumn("method", F.explode(F.array(F.lit("ckip"), F.lit("jieba"))))
    article_files.write_by_method(docs, path)
    return spark.read.parquet(path).select("article_url", "method", "content_raw")


@query(f"""with {SQL_LEXICON} select word, '【' || left(word, 1) || '】' as section, 1.0::double as weight from lexicon""")
def dictionary_files(spark, sf_dir):
    """A word list for each first letter, under a header, with blank lines and every word twice."""
    path = _folder(spark, "words")
    letter = F.left("word", F.lit(1))
    lists = benchmark_lexicon(spark, sf_dir).groupBy(letter.alias("letter")).agg(F.array_sort(F.collect_set("word")).alias("words"))
    text = F.concat(F.lit("\r\n【"), "letter", F.lit("】\r\n"), F.array_join(F.concat("words", "words"), "\r\n"), F.lit("\r\n"))
    lists.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return lexicon.read_user_dictionary(spark, path).select("word", "section", "weight")


@query("""select strftime(ts::date, '%Y-%m-%d') as date, hour(ts)::bigint as hour, count(*) as n from events group by 1, 2""")
def cell_files(spark, sf_dir):
    """Volume cells written for a renderer as CSV and read back."""
    path = _folder(spark, "cells")
    cells = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("date"), F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    article_files.write_cells(cells, path, form="csv")
    return spark.read.option("header", True).schema("date string, hour bigint, n bigint").csv(path)


@query("""select 'read' as stage, count(*) as rows, 0::bigint as errors from events
union all select 'kept', count(*), count(*) filter (where event_type = 'error') from events where value > 50""")
def stage_counts(spark, sf_dir):
    """Row counts of two stages, observed while one action runs through both."""
    events, read = audit.observed(table(spark, sf_dir, "events"), "read")
    kept, after = audit.observed(events.where("value > 50"), "kept", rows=F.count(F.lit(1)), errors=F.count_if(F.col("event_type") == "error"))
    kept.write.format("noop").mode("overwrite").save()
    rows = [("read", read.get["rows"], 0), ("kept", after.get["rows"], after.get["errors"])]
    return spark.createDataFrame(rows, "stage string, rows bigint, errors bigint")


_NAME = r"""lang || '_' || regexp_replace(string_split(text, chr(10))[1], '[\\/:*?"<>|]', '_', 'g')"""


@query(f"""with said as (select doc_id, {_NAME} as output_name, source, k from documents, (values (1), (2), (3)) as r(k) where doc_id % 3 <> k % 3)
select output_name, max(k)::bigint as run, arg_max(doc_id, (k, doc_id)) as doc_id, arg_max(source, (k, doc_id)) as source from said group by 1""")
def article_store_runs(spark, sf_dir):
    """Three runs with two thirds of the documents each, so that names overlap. The second run's first try was wrong and is
    repeated; a fourth one stopped before it counted."""
    path = _folder(spark, "store")
    name = output_name("lang", F.get(F.split("text", "\n"), F.lit(0)))
    docs = table(spark, sf_dir, "documents").select(name.alias("output_name"), F.col("doc_id").alias("seq"), "source")
    taken = lambda k: docs.where(F.col("seq") % 3 != k % 3).withColumn("run", F.lit(k).cast("long"))
    store.upsert(taken(1), path, "first", buckets=8)
    store.upsert(docs.withColumn("run", F.lit(-1).cast("long")), path, "second")
    store.upsert(taken(3), path, "third")
    store.upsert(taken(2), path, "second")
    store.stage(docs.withColumn("run", F.lit(4).cast("long")), path, "stopped")
    return store.read_store(spark, path).select("output_name", "run", F.col("seq").alias("doc_id"), "source")
