"""Reading and writing article documents."""

import os
import uuid

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hubbub.schemas import ARTICLE_JSON
from hubbub.operators.dedup import last_per_key
from hubbub.session import SLICE_BYTES

CORRUPT = "_corrupt_record"
# Files in one folder of a task, which one task reads.
FILES_EACH = 10_000


class TaskFolders(list):
    """Folders that tasks filled with article files on a mounted file system, and ``places``, the same as paths there."""

    def __init__(self, path, mounted, names):
        super().__init__(f"{path}/{name}" for name in names)
        self.places = [f"{mounted}/{name}" for name in names]


def _with_terms(df):
    """Turn the two-element arrays of the file form into (word, count) structs."""
    def terms(name):
        return F.transform(
            F.col(name),
            lambda p: F.struct(F.get(p, F.lit(0)).alias("word"), F.get(p, F.lit(1)).try_cast("bigint").alias("count")),
        ).alias(name)

    return df.select(*[
        terms(c) if c in ("content_top_key", "comments_top_key") else F.col(c) for c in df.columns
    ])


# Files of either form: one object over many lines, or one object per line. Batch and stream look for the same ones.
GLOBS = {False: "*.json", True: "*.{json,jsonl,txt}"}


def _lines(spark, path, mode, schema):
    return (
        spark.read.schema(schema).option("pathGlobFilter", GLOBS[True]).option("mode", mode)
        .option("columnNameOfCorruptRecord", CORRUPT).json(path).withColumn("source_filename", F.col("_metadata.file_name"))
    )


def _wholes(spark, path, schema):
    """Whole files as ``article``, NULL where a file is not exactly one object.

    The text is read as the only element of a list, so whatever follows the object makes the file malformed
    instead of being left out."""
    if isinstance(path, TaskFolders):
        files = _files_of(spark, path.places)
    else:
        # As bytes, because the reader of whole texts copies the Hadoop configuration for each file, one task at a time.
        files = spark.read.format("binaryFile").option("pathGlobFilter", GLOBS[False]).load(path)
        files = files.select("content", F.col("_metadata.file_name").alias("source_filename"))
    texts = files.select(F.col("content").cast("string").alias("value"), "source_filename")
    asked = T.ArrayType(T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())]))
    found = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), asked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    read = texts.withColumn("_found", found)
    fine = (F.size("_found") == 1) & F.get("_found", F.lit(0)).isNotNull() & F.get("_found", F.lit(0))[CORRUPT].isNull()
    return read.select("value", "source_filename", F.when(fine, F.get("_found", F.lit(0))).alias("article"))


def _files_of(spark, places):
    """(content, source_filename) of the article files in mounted folders. A task lists and reads a folder, so the driver, which
    would hold all files of a scan, holds the folders only."""
    def read(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                contents, names, size = [], [], 0
                for entry in os.scandir(places[k]):
                    if entry.name.endswith(".json") and entry.name[0] not in "._" and entry.is_file():
                        with open(entry.path, "rb") as file:
                            contents.append(file.read())
                        names.append(entry.name)
                        size += len(contents[-1])
                    if size >= SLICE_BYTES:
                        yield packed(contents, names)
                        contents, names, size = [], [], 0
                yield packed(contents, names)

    def packed(contents, names):
        return pa.RecordBatch.from_arrays([pa.array(contents, pa.binary()), pa.array(names, pa.string())], ["content", "source_filename"])

    return spark.range(0, len(places), 1, len(places)).mapInArrow(read, "content binary, source_filename string")


def _articles(wholes):
    return _with_terms(wholes.select(*[F.col(f"article.{f.name}") for f in ARTICLE_JSON.fields], "source_filename"))


def read_articles(spark, path, lines=False):
    """Scan a folder of article files, one JSON object each; any malformed file ends the run.

    ``lines`` reads the bulk form with one article per line, which splits and compacts well and is what
    ``write_articles(form="json")`` writes.
    """
    if lines:
        return _with_terms(_lines(spark, path, "FAILFAST", ARTICLE_JSON))
    wholes = _wholes(spark, path, ARTICLE_JSON)
    message = F.concat(F.lit("not one article object: "), "source_filename")
    return _articles(wholes.withColumn("article", F.when(F.col("article").isNull(), F.raise_error(message)).otherwise(F.col("article"))))


def read_articles_tolerant(spark, path, lines=False):
    """As ``read_articles``, but malformed files (or lines) are set aside.

    Returns (articles, rejected); ``rejected`` holds file name and text.
    """
    if not lines:
        wholes = _wholes(spark, path, ARTICLE_JSON)
        rejected = wholes.where("article is null").select("source_filename", F.col("value").alias("content"))
        return _articles(wholes.where("article is not null")), rejected
    schema = T.StructType(ARTICLE_JSON.fields + [T.StructField(CORRUPT, T.StringType())])
    df = _lines(spark, path, "PERMISSIVE", schema)
    good = _with_terms(df.where(F.col(CORRUPT).isNull()).drop(CORRUPT))
    # A scan may not ask for the text of bad records alone, so the filter also looks at a field.
    looked_at = F.coalesce(F.char_length("article_url"), F.lit(0)) >= 0
    rejected = df.where(F.col(CORRUPT).isNotNull() & looked_at).select("source_filename", F.col(CORRUPT).alias("content"))
    return good, rejected


def article_json(articles):
    """Articles as JSON lines in the file form, top lists as [["word", n], ...]."""
    def pairs(name):
        return F.transform(
            F.col(name), lambda t: F.array(t["word"], t["count"].cast("string"))
        ).alias(name)

    columns = [
        pairs(f.name) if f.name in ("content_top_key", "comments_top_key") else F.col(f.name)
        for f in ARTICLE_JSON.fields if f.name in articles.columns
    ]
    return articles.select(*columns)


def write_articles(articles, path, key="article_url", order="seq", form="parquet"):
    """Write one article per key, the last one in task order winning, in one folder per category.

    ``key='article_url'`` loses nothing; ``key='output_name'`` keeps one article per file name.
    Rows are rebalanced by category before the write: a small category becomes few files, a
    large one is split over many tasks.
    """
    kept = last_per_key(articles, [key], [order])
    out = article_json(kept) if form == "json" else kept
    out.hint("rebalance", F.col("article_category")).write.mode("overwrite").partitionBy("article_category").format(form).save(path)


def write_article_files(articles, path):
    """Write each article as a ``.json`` file of its own and give the folders that hold them.

    On a mounted folder every task fills folders of its own, and only those of attempts that ended are given, so files of a failed
    or repeated attempt are never read. Spark's writer, which other file systems get, starts processes for each file there.
    """
    spark, rows = articles.sparkSession, article_json(articles)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toUri()
    mounted = folder.getPath()

    def write(batches):
        own, n, folders = uuid.uuid4().hex, 0, []
        for batch in batches:
            for value in batch.column(0):
                if n % FILES_EACH == 0:
                    folders.append(f"{own}-{len(folders)}")
                    os.makedirs(f"{mounted}/{folders[-1]}")
                with open(f"{mounted}/{folders[-1]}/part-{own}-{n:09d}.json", "wb") as file:
                    file.write(value.as_py().encode() + b"\n")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(folders, pa.string())], ["folder"])

    if folder.getScheme() == "file":
        texts = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
        done = texts.mapInArrow(write, "folder string").collect()  # one short row for each folder
        if done:
            return TaskFolders(path, mounted, [r.folder for r in done])
    rows.write.option("maxRecordsPerFile", 1).json(path)
    return [path]


def write_by_method(articles, path, form="parquet"):
    """Write enriched articles, one area per segmentation method (column ``method``)."""
    articles.write.mode("overwrite").partitionBy("method").format(form).save(path)


def write_cells(df, path, form="parquet"):
    """Heatmap cells or word frequencies as data files for a renderer."""
    writer = df.write.mode("overwrite")
    if form == "csv":
        writer = writer.option("header", True)
    writer.format(form).save(path)
