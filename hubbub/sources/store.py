"""Articles of many runs in one place: a later run replaces what an earlier one wrote under the same key.

Each run writes a folder of its own and never changes another's. A small manifest lists the folders that count; a new
version of it is created under the next number, which only one writer can do, so readers see a run wholly or not at all. A run
that fails before that leaves a folder nobody reads; a run that is repeated under its name takes the place of its first try.
Files are laid out by hash buckets of the key, so asking for some keys reads only their buckets, and rows are merged
when read: of all rows of a key, that of the latest run, and in it the last in order.
"""

import json
import re
import uuid

from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError

from hubbub.operators.dedup import last_per_key

_RUNS, _VERSIONS = "runs", "versions"


def _files(spark, path):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def manifest(spark, path):
    """(version, content) of the newest complete manifest; (0, None) where there is none."""
    files, folder = _files(spark, f"{path}/{_VERSIONS}")
    if not files.exists(folder):
        return 0, None
    found = sorted((s.getPath().getName() for s in files.listStatus(folder)), reverse=True)
    for name in found:
        stream = files.open(spark._jvm.org.apache.hadoop.fs.Path(folder, name))
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return int(name.split(".")[0]), json.loads(text)
        except ValueError:
            continue  # its writer is at work or was stopped: the version before it counts
    return 0, None


def _commit(spark, path, version, content):
    """Create the next version; it is an error if somebody else has."""
    files, name = _files(spark, f"{path}/{_VERSIONS}/{version:09d}.json")
    try:
        stream = files.create(name, False)
    except Py4JJavaError as problem:
        raise RuntimeError(f"version {version} of {path} exists: another run was faster, repeat this one") from problem
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()


def _next_version(spark, path):
    """One more than any version there is, complete or not."""
    files, folder = _files(spark, f"{path}/{_VERSIONS}")
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    return 1 + max([int(n.split(".")[0]) for n in names if n[0].isdigit()], default=0)


def _bucket(key, buckets):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def stage(articles, path, run, key="output_name", order="seq", buckets=64):
    """Write a run's folder without making it count; gives what ``publish`` needs."""
    spark = articles.sparkSession
    if not re.fullmatch(r"[A-Za-z0-9._-]+", run):
        raise ValueError("a run's name may hold letters, digits, dots, dashes and underscores")
    version = _next_version(spark, path)
    read, content = manifest(spark, path)
    content = content or {"key": key, "order": order, "buckets": buckets, "runs": []}
    if (content["key"], content["order"]) != (key, order):
        raise ValueError(f"this store is kept by {content['key']} in the order of {content['order']}")
    numbers = {r["run"]: r["number"] for r in content["runs"]}
    number = numbers.get(run, max(numbers.values(), default=0) + 1)
    folder = f"{run}-{uuid.uuid4().hex}"
    rows = last_per_key(articles.where(F.col(key).isNotNull()), [key], [order])
    rows = rows.withColumn("_number", F.lit(number).cast("long")).withColumn("_bucket", _bucket(key, content["buckets"]))
    rows.hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(f"{path}/{_RUNS}/_folder={folder}")
    runs = [r for r in content["runs"] if r["run"] != run] + [{"run": run, "number": number, "folder": folder}]
    return read, version, {**content, "runs": runs}


def publish(spark, path, staged):
    """Make a staged run count, unless another one has since been published."""
    read, version, content = staged
    if manifest(spark, path)[0] != read:
        raise RuntimeError(f"{path} has changed since this run was staged, repeat it")
    _commit(spark, path, version, content)


def upsert(articles, path, run, key="output_name", order="seq", buckets=64):
    """Add a run: its articles replace those of earlier runs under the same key; rows without key are left out."""
    publish(articles.sparkSession, path, stage(articles, path, run, key, order, buckets))


def read_store(spark, path, keys=None):
    """The articles that count, one per key; with ``keys`` only these, read from their buckets alone."""
    _, content = manifest(spark, path)
    if not content:
        raise FileNotFoundError(f"no store at {path}")
    folders = [f"{path}/{_RUNS}/_folder={r['folder']}" for r in content["runs"]]
    rows = spark.read.option("basePath", f"{path}/{_RUNS}").option("mergeSchema", True).parquet(*folders)
    key = content["key"]
    if keys is not None:
        rows = rows.where(F.col("_bucket").isin(*[_bucket(F.lit(k), content["buckets"]) for k in keys]) & F.col(key).isin(*keys))
    return last_per_key(rows, [key], ["_number", content["order"]]).drop("_folder", "_bucket", "_number")


def compact(spark, path):
    """Merge all runs into one folder, so that reading has nothing left to merge."""
    version = _next_version(spark, path)
    read, content = manifest(spark, path)
    last = max(r["number"] for r in content["runs"])
    folder = f"merged-{uuid.uuid4().hex}"
    rows = read_store(spark, path).withColumn("_number", F.lit(last).cast("long")).withColumn("_bucket", _bucket(content["key"], content["buckets"]))
    rows.hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(f"{path}/{_RUNS}/_folder={folder}")
    publish(spark, path, (read, version, {**content, "runs": [{"run": folder, "number": last, "folder": folder}]}))
