"""Joins that hold when one key owns a large share of the rows."""

from functools import reduce

from pyspark.sql import functions as F

from hubbub.session import durable

BROADCAST_ROWS = 500_000
SUMMARY_ROWS = 10_000
BROADCAST_BYTES = 32 << 20
HOT_KEYS = 200
HOT_SHARE = 0.02


def fits_broadcast(df, max_rows=BROADCAST_ROWS, max_bytes=BROADCAST_BYTES):
    """Measure a lookup table: true if its rows and text bytes are within the limits."""
    width = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.to_json(F.struct(f"`{c}`"))), F.lit(0)) for c in df.columns])
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def computed_once(summary, most=SUMMARY_ROWS):
    """A summary of one short row per group, computed here and not again with each join. Up to ``most`` rows are sent to the
    other side, so that it stays in place; more are stored and joined."""
    rows = summary.limit(most + 1).collect()
    if len(rows) > most:
        return durable(summary)
    return F.broadcast(summary.sparkSession.createDataFrame(rows, summary.schema))


def row_hash(columns, schema):
    """Hash of a row's columns; maps, which have no hash, are hashed as JSON text."""
    return F.xxhash64(*[F.to_json(F.struct(f"`{c}`")) if "map<" in schema[c].dataType.simpleString() else F.col(f"`{c}`") for c in columns])


def lookup_join(many, table, on, how="left", salts=32, small=None):
    """Join rows to a lookup table that is unique on ``on``. The result is the same either way:

    A table measured as small is broadcast. A larger one is joined by shuffle. Rows that are nothing but their
    key are counted before they move; otherwise the few keys that hold many rows are spread over
    ``salts`` tasks, and only their lookup rows are copied.
    """
    if small is None:
        small = fits_broadcast(table)
    if small:
        return many.join(F.broadcast(table), on, how)
    others = [c for c in many.columns if c not in on]
    if not others:
        counted = many.groupBy(*on).agg(F.count(F.lit(1)).alias("_times")).join(table, on, how)
        return counted.withColumn("_times", F.explode(F.sequence(F.lit(1).cast("bigint"), "_times"))).drop("_times")
    hot = hot_keys(many, on[0]) if len(on) == 1 else []
    if not hot:
        return many.join(table, on, how)
    is_hot = F.coalesce(F.col(on[0]).isin(*hot), F.lit(False))
    salt = F.when(is_hot, F.pmod(row_hash(others, many.schema), F.lit(salts)).cast("int")).otherwise(0)
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted = table.withColumn("_salt", F.explode(copies))
    return many.withColumn("_salt", salt).join(salted, on + ["_salt"], how).drop("_salt")


def hot_keys(df, key, share=HOT_SHARE):
    """Keys that hold at least about ``share`` of all rows: at most ``HOT_KEYS`` values.

    One pass over the key column with a mergeable frequent-items sketch; no key is shuffled.
    The sketch only steers the join strategy, never the result.
    """
    sketch, rows = df.agg(
        F.expr(f"approx_top_k({key}, {HOT_KEYS}, {HOT_KEYS * 50})"), F.count(F.col(key))
    ).first()
    return [item[0] for item in sketch or [] if item[1] >= max(2, share * rows)]


def skewed_join(many, one, key, how="left", hot=None):
    """Equi-join where ``one`` is unique on ``key`` and ``many`` may be skewed.

    Rows of the few hot keys meet their at most ``HOT_KEYS`` partners by broadcast, if those are measured as small,
    and are never moved; all other rows take the normal shuffle join. Otherwise it is one plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError("inner or left only")
    if hot is None:
        hot = hot_keys(many, key)
    if not hot:
        return many.join(one, key, how)
    is_hot = F.col(key).isin(*hot)
    few = one.where(is_hot)
    if not fits_broadcast(few):
        return many.join(one, key, how)
    spread = many.where(is_hot).join(F.broadcast(few), key, how)
    rest = many.where(~is_hot | F.col(key).isNull()).join(one.where(~is_hot), key, how)
    return spread.unionByName(rest)
