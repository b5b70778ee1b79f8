"""Volume at any grain from stored hour cells: sums, distinct members and quantiles without the rows.

A cell holds a count, a sum and two mergeable sketches of fixed size: one of the different members, one of the values.
Days, months and years are merged from cells, so rows are read once, whatever is asked later.
"""

from pyspark.sql import functions as F

# Buckets of the distinct sketch as a power of two (error about 1.04 / sqrt(2^12) = 1.6 %), accuracy of the quantile sketch.
DISTINCT_BITS, QUANTILE_K = 12, 400


def hour_cells(df, time, value, member, keys=()):
    """One row per key and hour: ``cell``, ``n``, ``total`` and the sketches ``members`` and ``spread``. Rows without time count nowhere."""
    rows = df.where(F.col(time).isNotNull()).withColumn("cell", F.date_trunc("hour", F.col(time)))
    return rows.groupBy(*keys, "cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"),
        F.hll_sketch_agg(member, F.lit(DISTINCT_BITS)).alias("members"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(QUANTILE_K)).alias("spread"),
    )


def rolled_up(cells, unit, keys=()):
    """Cells of a larger unit (day, week, month, quarter, year), merged from smaller ones."""
    return cells.withColumn("cell", F.date_trunc(unit, "cell")).groupBy(*keys, "cell").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.hll_union_agg("members").alias("members"), F.kll_merge_agg_double("spread").alias("spread"),
    )


def estimates(cells, quantiles=(0.5,)):
    """Cells with ``distinct`` and one column for each asked quantile, ``q50`` for 0.5, in place of the sketches."""
    found = [F.kll_sketch_get_quantile_double("spread", F.lit(float(q))).alias(f"q{round(100 * q)}") for q in quantiles]
    return cells.select(*[c for c in cells.columns if c not in ("members", "spread")], F.hll_sketch_estimate("members").alias("distinct"), *found)
