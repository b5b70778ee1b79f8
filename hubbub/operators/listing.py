"""Order, year repair, stop date, cap and pinned posts of board listings.

Entries carry ``board``, ``page_seq`` (paging order, newest page first), ``pos`` (place on the
page, oldest first), ``pinned``, ``title``, ``url`` and ``date`` text. A board may hold most of
the rows, so boards are summarised by aggregates and joined back, not gathered.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from hubbub.functions.times import post_date, previous_year_if_future
from hubbub.operators.joins import computed_once
from hubbub.operators.ranking import top_per_group


def board_starts(entries):
    """Per board: the place of its first normal entry and the first page with pinned ones."""
    normal = F.when(~F.col("pinned"), F.col("place"))
    starts = entries.groupBy("board").agg(F.min(normal).alias("_first"), F.min(F.when(F.col("pinned"), F.col("page_seq"))).alias("_pinned_page"))
    return computed_once(starts)


def valid_entries(entries):
    """Entries that link to a post, with their newest-first place."""
    place = F.struct(F.col("page_seq").alias("page_seq"), (-F.col("pos")).alias("pos_back"))
    return entries.where(F.col("url").isNotNull()).withColumn("place", place)


def date_entries(entries, year, as_of, starts=None):
    """Add ``parsed_date``: the assumed year, or the year before for a date after ``as_of``.

    The first entry of a board is never moved.
    """
    starts = board_starts(entries) if starts is None else starts
    # Dates are read below the join, so later filters on them do not read them again.
    dated = entries.withColumn("_read", post_date("date", year)).join(starts.drop("_pinned_page"), "board", "left")
    exempt = F.col("pinned") | (F.col("place") == F.col("_first"))
    as_of = F.lit(as_of).cast("timestamp_ntz")
    return dated.withColumn("parsed_date", previous_year_if_future("_read", as_of, exempt)).drop("_first", "_read")


def until_stop_date(entries, stop_date):
    """Entries before the first one older than the stop date, in newest-first order per board.

    Entries without a date never stop the listing.
    """
    old = F.col("parsed_date") < F.lit(stop_date).cast("timestamp_ntz")
    stops = entries.where(old).groupBy("board").agg(F.min("place").alias("_stop"))
    kept = entries.join(computed_once(stops), "board", "left")
    return kept.where(F.col("_stop").isNull() | (F.col("place") < F.col("_stop"))).drop("_stop")


def capped(entries, n):
    """The first n entries per board, numbered from 0 in ``seq``."""
    ranked = top_per_group(entries, ["board"], [F.col("place").asc()], n)
    return ranked.withColumn("seq", F.col("rank").cast("bigint") - 1).drop("rank")


def first_pinned(entries, starts=None):
    """Pinned posts of the first page that has any, per board: later pages repeat them."""
    starts = board_starts(entries) if starts is None else starts
    page = starts.select("board", F.col("_pinned_page").alias("page_seq"))
    return entries.where("pinned").join(page, ["board", "page_seq"], "left_semi")


def append_pinned(normal, pinned):
    """Normal posts followed by pinned ones, the latter numbered on after the last normal post.

    The pinned posts of a board come from one page, so ranking them per board stays small, and so does joining them to
    the boards' sizes.
    """
    sizes = normal.groupBy("board").agg(F.count(F.lit(1)).alias("_size"))
    order = Window.partitionBy("board").orderBy("pos")
    tail = pinned.withColumn("_n", F.row_number().over(order)).join(sizes, "board", "left")
    seq = F.coalesce("_size", F.lit(0)) + F.col("_n") - 1
    return normal.unionByName(tail.withColumn("seq", seq).select(normal.columns))


def task_list(entries, year, as_of, stop_date, max_count):
    """The whole listing job: order, date, stop, cap, then append pinned posts."""
    entries = valid_entries(entries)
    starts = board_starts(entries)
    entries = date_entries(entries, year, as_of, starts)
    normal = capped(until_stop_date(entries.where(~F.col("pinned")), stop_date), max_count)
    return append_pinned(normal, first_pinned(entries, starts))
