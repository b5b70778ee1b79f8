"""Top-n per group, row numbers and global limits."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from hubbub.operators.joins import computed_once, row_hash
from hubbub.session import durable

_GROUP_LIMIT = 1000  # up to this n, Spark prunes ranked rows before the shuffle on its own


def top_per_group(df, keys, order, n, rank="rank", spread=64):
    """First ``n`` rows of each group in ``order``, numbered from 1.

    A group of any size is cut to n rows per task before it is brought together: by Spark's
    window group limit, and for very large n by ranking hash shares of each group first.
    """
    if n > _GROUP_LIMIT:
        share = F.pmod(row_hash(df.columns, df.schema), F.lit(spread))
        part = Window.partitionBy(*keys, "_share").orderBy(*order)
        df = df.withColumn("_share", share).withColumn("_n", F.row_number().over(part)).where(F.col("_n") <= n)
        df = df.drop("_share", "_n")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def cap_comments(comments, key, order, cap, page=None):
    """At most ``cap`` comments per article in ``order``.

    With ``page`` the cap is met page by page: pages are taken until more than ``cap`` rows came.
    """
    n = cap if page is None else (cap // page + 1) * page
    return top_per_group(comments, [key], order, n, rank="_rank").drop("_rank")


def number_rows(df, order, name="number"):
    """Number all rows from 1 in a total order, without one task seeing all rows.

    Rows are range-sorted over the cluster, saved, and each saved partition adds the row count
    of the partitions before it; only those counts (one per partition) are brought together.
    """
    placed = durable(
        df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    )
    # The id holds the partition number above bit 33 and the row's place in it below.
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    part = F.shiftright(F.col("_id"), 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.withColumn(name, F.col("_offset") + place + 1).drop("_part", "_offset", "_id")


def first_match(items, keep):
    """First element of an ordered array that satisfies ``keep``, else NULL."""
    return F.get(F.filter(items, keep), F.lit(0))


def grouped_median(df, keys, value, name="median", tolerance=10_000):
    """Exact median per group without holding a group's values in memory.

    A mergeable quantile sketch brackets the middle, rows below the bracket are only counted, and
    just the rows inside it (about 6/tolerance of a group, or repeats of one value, which are
    counted together) are ranked.
    """
    v, edge = F.col(value), 3.0 / tolerance
    rows = df.where(v.isNotNull())
    sketch = F.percentile_approx(v, [max(0.0, 0.5 - edge), min(1.0, 0.5 + edge)], tolerance)
    ends = rows.groupBy(*keys).agg(sketch.alias("_ends"), F.count(F.lit(1)).alias("_n"))
    # One row per group: where these are few, no value moves before it is counted.
    placed = rows.select(*keys, v.alias("_v")).join(computed_once(ends), keys)
    low, high = F.get("_ends", F.lit(0)), F.get("_ends", F.lit(1))
    # Below the bracket everything collapses to one value per group; above it is not needed.
    # The sketch is only off by 1/tolerance of the rows, but small groups are kept whole.
    inside = (F.col("_v") <= high) | (F.col("_n") < tolerance)
    kept = placed.where(inside).withColumn("_v", F.when(F.col("_v") >= low, F.col("_v")))
    counts = kept.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"))
    upto = Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first())
    ranked = counts.withColumn("_to", F.sum("_c").over(upto)).withColumn("_from", F.col("_to") - F.col("_c"))
    lower, upper = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    def at(rank):
        return F.max(F.when((F.col("_from") < rank) & (F.col("_to") >= rank), F.col("_v")))
    return ranked.groupBy(*keys).agg(((at(lower) + at(upper)) / 2).alias(name))
