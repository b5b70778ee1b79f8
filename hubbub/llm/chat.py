"""Logged conversations: snapshots that another conversation continues are dropped, the rest is rendered.

A turn's rolling prefix hash covers all turns up to it and their number. A conversation whose last hash is an inner prefix
hash of another one is a snapshot of it; of equal conversations the smallest id stays. Both are decided by joins on hashes.
Positions and hashes are running sums in two levels (inside range partitions, then over the partitions of a
conversation), so a conversation of any length is spread over tasks, and rendered text is cut into parts of bounded length.

Defined results: turns are ordered by turn, role and the digest of the text; repeated rows of one conversation count once;
null roles and texts count as empty; a null conversation id names one conversation, smaller than all others; a
null turn comes first. An empty table gives no rows. Control marks inside roles and texts are broken up with a space.
Only the four named columns are read, so others cannot clash.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from hubbub.llm.shared import column, durable

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
PART_CHARS = 1_000_000
LANE = (1 << 31) - 1


def turns(rows, names):
    """(conv, turn, role, text, tie) of each different turn."""
    conv, turn, role, text = names
    rows = rows.select(
        column(rows, conv).alias("conv"), column(rows, turn).alias("turn"),
        F.coalesce(column(rows, role), F.lit("")).alias("role"), F.coalesce(column(rows, text), F.lit("")).alias("text"),
    )
    return rows.withColumn("tie", F.md5("text"))


def rendered(role, text):
    plain = lambda c: F.replace(F.replace(c, F.lit(OPEN), F.lit("<| im_start |>")), F.lit(CLOSE), F.lit("<| im_end |>"))
    return F.concat(F.lit(OPEN), plain(role), F.lit("\n"), plain(text), F.lit(CLOSE + "\n"))


def running(rows, values):
    """``rows`` with running sums of ``values`` (name -> column) along each conversation, as those names.

    ``rows`` holds ``part``, the range partition of each row; a conversation's parts follow each other."""
    inside = Window.partitionBy("part", "conv").orderBy(*ordered()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select("*", *[v.alias(f"__{n}") for n, v in values.items()])
    totals = rows.groupBy("conv", "part").agg(*[F.sum(f"__{n}").alias(n) for n in values])
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("conv").alias("__conv"), F.col("part").alias("__part"), *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"__b_{n}") for n in values])
    rows = rows.select(*[c for c in rows.columns if c not in values], *[F.sum(f"__{n}").over(inside).alias(f"__s_{n}") for n in values])
    rows = rows.join(totals, F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("part") == F.col("__part")))
    keep = [c for c in rows.columns if not c.startswith("__")]
    return rows.select(*keep, *[(F.col(f"__s_{n}") + F.col(f"__b_{n}")).alias(n) for n in values])


def ordered():
    return [F.asc_nulls_first("turn"), F.col("role"), F.col("tie")]


def prefixes(rows):
    """Every different turn with its position, rolling hash (a, b) and the characters rendered up to it."""
    chars = F.length(rendered(F.col("role"), F.col("text")))
    slim = rows.select("conv", "turn", "role", "tie", chars.cast("long").alias("size")).distinct()
    ranged = slim.repartitionByRange(F.asc_nulls_first("conv"), *ordered())
    ranged = durable(ranged.withColumn("part", F.spark_partition_id()))
    placed = running(ranged, {"pos": F.lit(1).cast("long"), "chars": F.col("size")})
    mark = F.xxhash64("pos", "role", "tie")
    return durable(running(placed, {"a": mark.bitwiseAND(F.lit(LANE)), "b": F.shiftrightunsigned(mark, 31).bitwiseAND(F.lit(LANE))}))


def maximal(marked):
    """(conv, n): the conversations that no other one continues, one of each set of equal ones."""
    ends = marked.groupBy("conv").agg(F.max(F.struct("pos", "a", "b")).alias("last"))
    ends = ends.select("conv", F.col("last.pos").alias("n"), F.col("last.a").alias("a"), F.col("last.b").alias("b"))
    ends = durable(ends)
    inner = marked.join(ends.select(F.col("conv").alias("c"), "n"), F.col("conv").eqNullSafe(F.col("c"))).where(F.col("pos") < F.col("n"))
    inner = inner.select(F.col("pos").alias("n"), "a", "b").distinct()
    first = ends.groupBy("n", "a", "b").agg(F.min(F.struct("conv")).alias("s"))
    return first.join(inner, ["n", "a", "b"], "left_anti").select("s.conv", "n")


def collapse(rows, names=("conv_id", "turn", "role", "text"), part_chars=PART_CHARS):
    """conv_id, part, n_turns, rendered: the kept conversations in parts of about ``part_chars`` characters.

    n_turns counts the turns of the whole conversation; parts hold whole turns and are numbered by where they begin."""
    all_turns = turns(rows, names)
    marked = prefixes(all_turns)
    kept = durable(maximal(marked))
    places = marked.join(kept.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c"))).select(
        "conv", F.col("turn").alias("t"), F.col("role").alias("r"), F.col("tie").alias("m"), "n", "pos", F.floor((F.col("chars") - F.col("size")) / part_chars).cast("int").alias("part"))
    same = F.col("conv").eqNullSafe(F.col("conv_")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("role") == F.col("r")) & (F.col("tie") == F.col("m"))
    said = all_turns.withColumnRenamed("conv", "conv_").join(places, same)
    said = said.select("conv", "part", "n", "pos", rendered(F.col("role"), F.col("text")).alias("text"))
    # Repeated rows give the same position twice; sets keep one.
    whole = said.groupBy("conv", "part", "n").agg(F.array_sort(F.collect_set(F.struct("pos", "text"))).alias("own"))
    return whole.select(F.col("conv").alias("conv_id"), "part", F.col("n").alias("n_turns"), F.array_join(F.transform("own", lambda s: s["text"]), "").alias("rendered"))


SQL = f"""
with t as (select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) as pos, count(*) over (partition by conv_id) as n from t),
p as (select *, string_agg(role || chr(1) || text || chr(2), '') over (partition by conv_id order by pos) as so_far,
  '{OPEN}' || replace(replace(role, '{OPEN}', '<| im_start |>'), '{CLOSE}', '<| im_end |>') || chr(10) || replace(replace(text, '{OPEN}', '<| im_start |>'), '{CLOSE}', '<| im_end |>') || '{CLOSE}' || chr(10) as said from o),
e as (select min(conv_id) as conv_id, so_far from p where pos = n group by so_far),
k as (select conv_id from e where so_far not in (select so_far from p where pos < n)),
c as (select *, coalesce(sum(length(said)) over (partition by conv_id order by pos rows between unbounded preceding and 1 preceding), 0) as ahead from p)
select conv_id, cast(ahead // {PART_CHARS} as integer) as part, n as n_turns, string_agg(said, '' order by pos) as rendered
from c where conv_id in (select conv_id from k) group by conv_id, 2, n
"""
