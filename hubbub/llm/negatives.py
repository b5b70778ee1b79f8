"""Hard negatives by Fagin's threshold algorithm over integer inner products.

Components are scaled and rounded down to integers, so scores are exact. Rows lie in blocks of bounded size, ranged by label
and id. In its block each dimension has a list of the rows sorted by their component; an anchor goes down all lists at once,
from the high end where its own component is positive and from the low end where it is negative, scores each row the
first time any list shows it, and stops as soon as the threshold (the score of a row that would stand at the current place
of every list) falls strictly below the kth score of all it looks for. First it looks for positives, in the blocks that hold its
label; then, once for each positive, for the best rows of other labels inside that positive's score window. A window that is
not yet full is done when the threshold falls strictly below its lower end. What the blocks found is ranked by anchor.

Anchors travel to blocks as rows of a shuffle, each block has a partition of its own, and a block answers with at most as many
rows as are asked for, so equal vectors and frequent labels only make more blocks.

Defined results: rows whose id, label or vector is null, whose vector is empty, of another length than most, holds null or
non-finite components, or components that give integers of 2^24 or more, take no part (sums stay in 64 bits). Zero
vectors take part. Of several rows with one id, the smallest label, then vector, takes part, so repeated rows count once. Ties
go to the smaller id. An anchor without positives, or a positive whose window is empty, gives no rows; so does an empty
table. Only the three named columns are read, so others cannot clash.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from hubbub.llm.ann import runs
from hubbub.llm.shared import column, durable

# Components of a block's vectors, rows read from each list in the first round, largest integer component.
BLOCK_VALUES, FIRST_ROWS, LARGEST = 1 << 19, 16, 1 << 24
MEETING = ["block", "kind", "id", "label", "vec", "asked"]


def taking_part(rows, id_col, label_col, vector_col, scale):
    """(id, label, vec of integers) of the rows that take part, and the vectors' length."""
    rows = rows.select(column(rows, id_col).cast("long").alias("id"), column(rows, label_col).cast("long").alias("label"), column(rows, vector_col).alias("raw"))
    # NaN compares as larger than any number.
    fine = F.forall("raw", lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < LARGEST))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("raw") > 0) & fine)
    rows = rows.select("id", "label", F.transform("raw", lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("vec"))
    usual = rows.groupBy(F.size("vec").alias("length")).count().orderBy(F.desc("count"), "length").first()
    size = usual["length"] if usual else 0
    one = rows.where(F.size("vec") == size).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("own"))
    return one.select("id", "own.label", "own.vec"), size


class Lists:
    """A block's rows with one sorted list for each dimension."""

    def __init__(self, ids, labels, vectors):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.take_along_axis(vectors.T, self.order, axis=1)
        self.floats, self.top = vectors.astype(np.float64), int(np.abs(vectors).max())

    def scores(self, rows, anchor):
        if self.top * int(np.abs(anchor).max()) * len(anchor) < 1 << 53:
            return (self.floats[rows] @ anchor.astype(np.float64)).astype(np.int64)  # exact below 2^53
        return self.vectors[rows] @ anchor

    def rounds(self, anchor):
        """Rows seen for the first time, their scores, and the threshold for all rows not seen yet (None: no such row)."""
        n, done, step = len(self.ids), 0, FIRST_ROWS
        seen = np.zeros(n, bool)
        high, low = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(high) and not len(low):
            high = np.arange(1)  # every score is 0; one list shows all rows
        while done < n:
            to = min(n, done + step)
            shown = np.zeros(n, bool)
            shown[self.order[high, n - to:n - done]] = True
            shown[self.order[low, done:to]] = True
            new = np.flatnonzero(shown & ~seen)
            seen |= shown
            threshold = int(anchor[high] @ self.values[high, n - to] + anchor[low] @ self.values[low, to - 1])
            yield new, self.scores(new, anchor), None if seen.all() else threshold
            if seen.all():
                return
            done, step = to, 2 * step

    def first(self, rows, scores, k):
        """The best k of the given rows."""
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[order], scores[order]

    def positives(self, me, label, anchor, k):
        """The k best other rows of the anchor's label."""
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for new, got, threshold in self.rounds(anchor):
            mine = (self.labels[new] == label) & (self.ids[new] != me)
            rows, scores = self.first(np.concatenate([rows, new[mine]]), np.concatenate([scores, got[mine]]), k)
            if threshold is None or len(rows) == k and threshold < scores[-1]:
                break
        return rows, scores

    def negatives(self, label, anchor, windows, k):
        """For each window (low, high), the k best rows of other labels whose score lies inside."""
        none = np.zeros(0, np.int64)
        found, open_ = [(none, none)] * len(windows), set(range(len(windows)))
        for new, got, threshold in self.rounds(anchor):
            other = self.labels[new] != label
            new, got = new[other], got[other]
            for w in list(open_):
                low, high = windows[w]
                inside = (got >= low) & (got <= high)
                if inside.any():
                    rows, scores = found[w]
                    found[w] = self.first(np.concatenate([rows, new[inside]]), np.concatenate([scores, got[inside]]), k)
                edge = found[w][1][-1] if len(found[w][0]) == k else low
                if threshold is not None and threshold < edge:
                    open_.remove(w)
            if not open_:
                break
        return found


def meetings(batches):
    """(lists of a block, a batch of anchors that visit it), from rows sorted by block and kind."""
    place, held, lists = None, [], None
    for batch in batches:
        block, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
        for a, b in runs(2 * block.astype(np.int64) + kind):
            part = batch.slice(a, b - a)
            if block[a] != place:
                place, held, lists = block[a], [], None
            if kind[a] == 0:
                held.append((part.column("id").to_numpy(), part.column("label").to_numpy(), matrix(part)))
                continue
            if held:
                lists, held = Lists(*(np.concatenate(c) for c in zip(*held))), []
            if lists is not None:
                yield lists, part


def matrix(batch):
    values = batch.column("vec")
    return values.flatten().to_numpy().astype(np.int64).reshape(len(values), -1)


def visit(rows, visits, blocks, run, schema):
    """Bring the visiting anchors to the blocks of rows and let ``run`` answer."""
    asked = "array<struct<positive:bigint,score:bigint>>"
    here = rows.select("block", F.lit(0).alias("kind"), "id", "label", "vec", F.lit(None).cast(asked).alias("asked"))
    coming = visits.select("block", F.lit(1).alias("kind"), "id", "label", "vec", F.col("asked").cast(asked).alias("asked"))
    return here.union(coming).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "kind").mapInArrow(run, schema)


def mine(rows, is_anchor, id_col="vec_id", label_col="label", vector_col="embedding", scale=256, positives=5, negatives=3, low=50, high=95):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id satisfies ``is_anchor``, a function of the id column. A negative's score lies between ``low`` and
    ``high`` per cent of the positive's."""
    rows, size = taking_part(rows, id_col, label_col, vector_col, scale)
    rows = durable(rows)
    blocks = max(1, -(-rows.count() * size // BLOCK_VALUES))
    rows = durable(rows.repartitionByRange(blocks, "label", "id").withColumn("block", F.spark_partition_id()))
    blocks = rows.rdd.getNumPartitions()
    # Blocks are ranges of labels: a label's rows fill the blocks between its first and its last one.
    spans = rows.groupBy("label").agg(F.min("block").alias("first"), F.max("block").alias("last"))
    anchors = durable(rows.where(is_anchor(F.col("id"))).select("id", "label", "vec").join(spans, "label"))

    def find_positives(batches):
        for lists, part in meetings(batches):
            out = []
            for me, label, anchor in zip(part.column("id").to_pylist(), part.column("label").to_pylist(), matrix(part)):
                found, scores = lists.positives(me, label, anchor, positives)
                out += [(me, i, s) for i, s in zip(lists.ids[found].tolist(), scores.tolist())]
            yield batch_of(out, ["id", "positive", "score"])

    def find_negatives(batches):
        for lists, part in meetings(batches):
            out = []
            for me, label, anchor, asked in zip(part.column("id").to_pylist(), part.column("label").to_pylist(), matrix(part), part.column("asked").to_pylist()):
                # 100 x score from low x to high x the positive's score.
                windows = [(-(-low * a["score"] // 100), high * a["score"] // 100) for a in asked]
                for a, (found, scores) in zip(asked, lists.negatives(label, anchor, windows, negatives)):
                    out += [(me, a["positive"], a["score"], i, s) for i, s in zip(lists.ids[found].tolist(), scores.tolist())]
            yield batch_of(out, ["id", "positive", "positive_score", "negative", "score"])

    own = anchors.select("*", F.explode(F.sequence("first", "last")).alias("block"), F.lit(None).alias("asked"))
    order = Window.partitionBy("id").orderBy(F.desc("score"), "positive")
    best = visit(rows, own, blocks, find_positives, "id long, positive long, score long")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    if low < high:
        best = best.where("score >= 0")  # the window of a negative score is empty
    asking = best.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("positive", "score"))).alias("asked"))
    # Between its first and last block there is only the anchor's own label.
    others = F.filter(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: (b <= F.col("first")) | (b >= F.col("last")))
    going = anchors.join(asking, "id").select("*", F.explode(others).alias("block"))
    order = Window.partitionBy("id", "positive").orderBy(F.desc("score"), "negative")
    found = visit(rows, going, blocks, find_negatives, "id long, positive long, positive_score long, negative long, score long")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return found.select(
        F.col("id").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("negative").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def batch_of(lines, names):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*lines)] if lines else [pa.array([], pa.int64())] * len(names), names)


SQL = """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from e a join e b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.vec_id as positive_id, row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id)::integer as rank,
  s.vec_id as negative_id, p.score as positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
qualify rank <= 3
"""
