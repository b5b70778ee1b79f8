"""One row per key."""

from pyspark.sql import functions as F

from hubbub.operators.ranking import top_per_group


def first_per_key(df, keys, order):
    """Keep the first row of each key in ``order`` (a total order within the key)."""
    return top_per_group(df, keys, [F.col(c).asc() for c in order], 1, rank="_rank").drop("_rank")


def last_per_key(df, keys, order):
    """Keep the last row of each key in ``order``: later writes replace earlier ones."""
    return top_per_group(df, keys, [F.col(c).desc() for c in order], 1, rank="_rank").drop("_rank")
