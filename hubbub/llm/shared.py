"""Helpers shared by the training-text operators."""

import sys
import types

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import functions as F

from hubbub.session import durable  # noqa: F401  (operators cut lineage with it)

# Bytes of text handled at once inside a task; a longer text is handled alone.
SLICE_BYTES = 1 << 19


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(df, name):
    """The column called exactly ``name``, whatever other columns look like."""
    return df["`" + name.replace("`", "``") + "`"]


def kept_in_worker(name, make):
    """One object per Python worker process, made at first use and kept for later tasks."""
    store = sys.modules.setdefault("hubbub_worker_state", types.ModuleType("hubbub_worker_state"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


def slices(batches, text=1, limit=SLICE_BYTES):
    """(batch part, list of its texts, null as empty) of at most ``limit`` bytes, or one row."""
    for batch in batches:
        texts = batch.column(text)
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            part = batch.slice(at, to - at)
            yield part, ["" if t is None else t for t in part.column(text).to_pylist()]
            at = to


def small(df, rows):
    """Collect a table that is small by construction; fail loudly if it is not."""
    got = df.limit(rows + 1).collect()
    if len(got) > rows:
        raise ValueError(f"expected at most {rows} rows")
    return got


def with_nulls_as_text(df, id_col, text_col):
    """Only the two columns an operator works on, under fixed names; null text becomes empty."""
    return df.select(column(df, id_col).alias("doc_id"), F.coalesce(column(df, text_col), F.lit("")).alias("text"))
