"""Session settings and durable intermediate results."""

import sys
import tempfile
import types

import pyarrow as pa

# Bytes of an Arrow batch that Python looks at together.
SLICE_BYTES = 1 << 20

# Runtime settings the jobs are designed for. Partition counts are left to the cluster:
# adaptive execution coalesces small shuffles and splits skewed join partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole pages and texts travel in Arrow batches: keep a batch to some tens of megabytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}


def tune(spark):
    """Apply the run-time settings to a session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark):
    """Folder for data that must outlive an executor.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session (tests) may fall
    back to a temporary folder, because elsewhere that folder is not shared.
    """
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="hubbub-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def durable(df):
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def kept_in_worker(name, make):
    """The object last made under ``name`` in this Python worker process, kept for later tasks."""
    store = sys.modules.setdefault("hubbub_kept", types.ModuleType("hubbub_kept"))
    kind, key = name
    if getattr(store, kind, (None, None))[0] != key:
        setattr(store, kind, (key, make()))  # one object of a kind, so memory stays bounded
    return getattr(store, kind)[1]


def in_slices(column, run):
    """``run`` over an Arrow column, about ``SLICE_BYTES`` at a time, so that the Python objects held at once do not grow with
    the batch, which the session sizes by rows."""
    each = max(1, len(column) * SLICE_BYTES // max(column.nbytes, 1))
    return pa.concat_arrays([run(column.slice(at, each)) for at in range(0, max(len(column), 1), each)])
