"""Nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample (``SAMPLE_PER_LEAF`` vectors for each leaf, at most ``MAX_LEAVES`` leaves); every
vector is then put into a leaf. Inner products become distances by one more coordinate, sqrt(M^2 - |x|^2) for vectors and 0
for queries, M being the largest norm. A query walks the tree through a priority queue of bins by distance and visits
leaves until it has seen as many as a calibration asks for, and at least as many candidates as it needs neighbours. The
calibration takes ``CALIBRATION`` queries, their true neighbours from all rows, and widens the visits until these are
found with the wished recall.

Vectors meet queries by shards: neighbouring leaves together, large leaves in several blocks of bounded size. Of equal
vectors only the smallest ids can be among the nearest, so the others leave before anything is shuffled by leaf, and
equal queries are searched once.

Defined results: rows whose id or vector is null, or whose vector is empty, zero, of another length than most, or holds
null or non-finite components, take no part. A query's own id is no candidate, nor are repeated rows of it. Ties go to
the smaller id. With fewer candidates than asked for, all are returned. Empty tables give no rows. Only the two
named columns are read, so others cannot clash.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from hubbub.llm.shared import column, durable

LEAF_ROWS, BRANCH, MAX_LEAVES, SAMPLE_PER_LEAF, ROUNDS, SEED = 64, 16, 1 << 15, 16, 8, 5
CALIBRATION, RECALL = 256, 0.97
SHARD_ROWS = 8192


def taking_part(rows, id_col, vector_col):
    """(id, vec) of the rows that take part."""
    rows = rows.select(column(rows, id_col).cast("long").alias("id"), column(rows, vector_col).alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & (F.size("vec") > 0) & fine)
    usual = rows.groupBy(F.size("vec").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return rows.where(F.size("vec") == (usual["length"] if usual else 0)), usual["length"] if usual else 0


def vectors(batch, name="vec"):
    values = batch.column(name)
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


class Tree:
    """Centres of all nodes, a node's children in a row; leaves are numbered from left to right."""

    def __init__(self, sample, total, norm, leaf_rows=LEAF_ROWS, branch=BRANCH):
        self.norm = norm
        points = self.lifted(sample)
        random = np.random.default_rng(SEED)
        self.centres, self.first, self.many, self.leaf, self.leaves = [points.mean(axis=0) if len(points) else np.zeros(points.shape[1])], [0], [0], [-1], 0
        share = total / max(1, len(points))
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, own = todo.pop()
            k = min(branch, int(len(own) * share / leaf_rows), len(own) // 2)
            parts = self.split(points[own], k, random) if k > 1 else None
            if parts is None or len(parts[0]) < 2:
                self.leaf[node], self.leaves = self.leaves, self.leaves + 1
                continue
            centres, to = parts
            self.first[node], self.many[node] = len(self.centres), len(centres)
            for c, centre in enumerate(centres):
                todo.append((len(self.centres), own[to == c]))
                self.centres.append(centre), self.first.append(0), self.many.append(0), self.leaf.append(-1)
        self.centres = np.array(self.centres)
        self.square = (self.centres * self.centres).sum(axis=1)

    def lifted(self, x):
        rest = np.sqrt(np.maximum(self.norm * self.norm - (x * x).sum(axis=1), 0))
        return np.hstack([x, rest[:, None]])

    @staticmethod
    def split(points, k, random):
        """Lloyd rounds from k random points; centres nobody is nearest to are left out."""
        centres = points[random.choice(len(points), k, replace=False)]
        for _ in range(ROUNDS):
            to = np.argmin((centres * centres).sum(axis=1) - 2 * points @ centres.T, axis=1)
            used, to = np.unique(to, return_inverse=True)
            centres = np.stack([points[to == c].mean(axis=0) for c in range(len(used))])
        to = np.argmin((centres * centres).sum(axis=1) - 2 * points @ centres.T, axis=1)
        used, to = np.unique(to, return_inverse=True)
        return centres[used], to

    def assign(self, x):
        """The leaf of each vector."""
        x, out, todo = self.lifted(x), np.zeros(len(x), np.int32), [(0, np.arange(len(x)))]
        while todo:
            node, own = todo.pop()
            if self.leaf[node] >= 0:
                out[own] = self.leaf[node]
                continue
            kids = slice(self.first[node], self.first[node] + self.many[node])
            to = np.argmin(self.square[kids] - 2 * x[own] @ self.centres[kids].T, axis=1)
            todo += [(self.first[node] + c, own[to == c]) for c in np.unique(to).tolist()]
        return out

    def walk(self, query):
        """Leaves from the nearest bin on."""
        q = np.append(query, 0.0)
        bins = [(0.0, 0)]
        while bins:
            _, node = heapq.heappop(bins)
            if self.leaf[node] >= 0:
                yield self.leaf[node]
                continue
            first, many = self.first[node], self.many[node]
            far = self.square[first:first + many] - 2 * self.centres[first:first + many] @ q
            for c, d in enumerate(far.tolist()):
                heapq.heappush(bins, (d, first + c))


def best(scores_of, ids, x, query, k):
    """The k nearest of the rows x: (score, id), by exact scores; ``scores_of`` are the quick ones."""
    if len(ids) > k:
        edge = np.partition(scores_of, len(ids) - k)[len(ids) - k]
        keep = np.flatnonzero(scores_of >= edge - 1e-9 * (1 + abs(edge)))
        ids, x = ids[keep], x[keep]
    score = (x * query).sum(axis=1)
    order = np.lexsort((ids, -score))[:k]
    return score[order], ids[order]


def nearest_of_all(rows, queries, k):
    """Brute force for a bounded set of queries (numpy rows): (query, id, score, vec) of the k nearest each."""
    def run(batches):
        found = [[] for _ in queries]
        for batch in batches:
            ids, x = batch.column("id").to_numpy(), vectors(batch)
            quick = queries @ x.T
            for q in range(len(queries)):
                at = np.argpartition(quick[q], len(ids) - k)[len(ids) - k:] if len(ids) > k else np.arange(len(ids))
                found[q] = sorted(found[q] + [(-s, i, x[j]) for s, i, j in zip(quick[q][at].tolist(), ids[at].tolist(), at.tolist())], key=lambda f: f[:2])[:k]
        out = [(q, i, -s, v.tolist()) for q, own in enumerate(found) for s, i, v in own]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out]), pa.array([o[3] for o in out], pa.list_(pa.float64()))], ["query", "id", "score", "vec"])

    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    found = rows.mapInArrow(run, "query int, id long, score double, vec array<double>")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def calibrated(tree, rows, queries, k, recall):
    """How many leaves the queries must visit to find that share of their true neighbours."""
    true = nearest_of_all(rows, queries, k).toArrow()
    if not true.num_rows:
        return 1
    true = true.combine_chunks().to_batches()[0]
    leaf, query = tree.assign(vectors(true)), true.column("query").to_numpy()
    place = np.full((len(queries), tree.leaves), tree.leaves)
    for q, vector in enumerate(queries):
        for at, visited in enumerate(tree.walk(vector)):
            place[q, visited] = at
    at, visits = place[query, leaf], 1
    while (at < visits).mean() < recall:
        visits = visits + max(1, visits // 16)
    return visits


def search(rows, is_query, k=20, id_col="vec_id", vector_col="embedding", recall=RECALL):
    """(query_id, rank, vec_id, score): the k nearest of each row whose id satisfies ``is_query``, a function of the id
    column."""
    spark = rows.sparkSession
    rows, size = taking_part(rows, id_col, vector_col)
    # A repeated row is one row, so that a query takes up one place for each vector of its id.
    rows = durable(rows.dropDuplicates(["id", "vec"]))
    total, norm = rows.agg(F.count("*"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x)))).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    leaves = int(min(MAX_LEAVES, max(1, total // LEAF_ROWS)))

    def some(frame, wanted, among, salt):
        """About ``wanted`` rows, chosen by a hash of the id; at most twice as many."""
        one_in = max(1, among // wanted)
        return frame.where(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(one_in)) == 0).limit(2 * wanted)

    def numpy_rows(frame):
        got = frame.select("vec").toArrow().combine_chunks()
        return vectors(got.to_batches()[0]) if got.num_rows else np.zeros((0, size))

    sample = numpy_rows(some(rows, leaves * SAMPLE_PER_LEAF, total, 1))
    tree = Tree(sample, total, norm)
    asked = rows.where(is_query(F.col("id")))
    # Of equal vectors, only the k + 1 smallest ids can be among anyone's nearest.
    twins = Window.partitionBy("vec").orderBy("id")
    once = rows.withColumn("twin", F.row_number().over(twins)).where(F.col("twin") <= k + 1).drop("twin")
    id_leaf = "id long, vec array<double>, leaf int"

    def leafed(batches):
        for batch in batches:
            x = vectors(batch)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), size).cast(pa.list_(pa.float64())), pa.array(tree.assign(x))], ["id", "vec", "leaf"])

    placed = durable(once.select("id", "vec").mapInArrow(leafed, id_leaf))
    counts = np.zeros(tree.leaves, np.int64)
    for r in placed.groupBy("leaf").count().collect():  # one row per leaf of the bounded tree
        counts[r["leaf"]] = r["count"]
    n_asked, own_rows = asked.groupBy("id").count().agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(1))).first()
    places = k + own_rows
    trial = numpy_rows(some(asked, CALIBRATION, n_asked, 2))
    visits = calibrated(tree, placed, trial, places, recall) if len(trial) else 1
    # Shards: leaves in a row up to SHARD_ROWS; a shard beyond that is cut in blocks.
    shard = np.cumsum(counts) // SHARD_ROWS
    shard = np.unique(shard, return_inverse=True)[1]
    blocks = np.maximum(1, -(-np.bincount(shard, counts).astype(np.int64) // (2 * SHARD_ROWS)))
    begin = np.concatenate([[0], np.cumsum(blocks)])
    start_of, blocks_of = F.array(*[F.lit(int(b)) for b in begin[:-1]]), F.array(*[F.lit(int(b)) for b in blocks])
    shard_of = F.array(*[F.lit(int(s)) for s in shard])
    mine = F.get(shard_of, F.col("leaf"))
    here = placed.select((F.get(start_of, mine) + F.pmod(F.xxhash64("id"), F.get(blocks_of, mine))).alias("place"), F.lit(0).alias("kind"), "id", "leaf", F.lit(None).cast("array<int>").alias("leaves"), "vec")
    twin_queries = asked.withColumn("one", F.min("id").over(Window.partitionBy("vec"))).select("id", "one", "vec")
    twin_queries = durable(twin_queries)
    single = twin_queries.where("id = one").dropDuplicates(["id"]).select("id", "vec")

    def visit(batches):
        for batch in batches:
            ids, x = batch.column("id").to_pylist(), vectors(batch)
            place, who, leaves_, row = [], [], [], []
            for i, query in enumerate(x):
                own, seen = {}, 0
                for at, leaf in enumerate(tree.walk(query)):
                    if at >= visits and seen >= places:
                        break
                    seen += counts[leaf]
                    if counts[leaf]:
                        own.setdefault(shard[leaf], []).append(leaf)
                for s, list_ in own.items():
                    for b in range(begin[s], begin[s + 1]):
                        place.append(b), who.append(ids[i]), leaves_.append(list_), row.append(i)
            vec = pa.FixedSizeListArray.from_arrays(pa.array(x[row].ravel()), size).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array([1] * len(place), pa.int32()), pa.array(who, pa.int64()), pa.nulls(len(place), pa.int32()), pa.array(leaves_, pa.list_(pa.int32())), vec], MEETING)

    going = single.mapInArrow(visit, "place long, kind int, id long, leaf int, leaves array<int>, vec array<double>")

    def meet(batches):
        place, held = None, []
        ids = x = leaf = None
        for batch in batches:
            at, kind = batch.column("place").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((at[1:] != at[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
                part = batch.slice(a, b - a)
                if at[a] != place:
                    place, held, ids = at[a], [], None
                if kind[a] == 0:
                    held.append((part.column("id").to_numpy(), vectors(part), part.column("leaf").to_numpy()))
                    continue
                if ids is None and held:
                    ids, x, leaf = (np.concatenate(c) for c in zip(*held))
                    order = np.argsort(leaf, kind="stable")
                    ids, x, leaf, held = ids[order], x[order], leaf[order], []
                if ids is not None:
                    yield from answer(part, ids, x, leaf)

    def answer(part, ids, x, leaf):
        queries, who, lists = vectors(part), part.column("id").to_pylist(), part.column("leaves")
        wanted, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(who)), np.diff(lists.offsets.to_numpy()))
        order = np.argsort(wanted, kind="stable")
        wanted, owner = wanted[order], owner[order]
        got = [[] for _ in who]
        for a, b in runs(wanted):
            lo, hi = np.searchsorted(leaf, [wanted[a], wanted[a] + 1])
            if lo < hi:
                quick = queries[owner[a:b]] @ x[lo:hi].T
                for q, scores in zip(owner[a:b].tolist(), quick):
                    got[q].append((lo, scores))
        one, two, three = [], [], []
        for q, pieces in enumerate(got):
            if pieces:
                rows_ = np.concatenate([np.arange(lo, lo + len(s)) for lo, s in pieces])
                score, near = best(np.concatenate([s for _, s in pieces]), ids[rows_], x[rows_], queries[q], places)
                one += [who[q]] * len(near)
                two.append(near), three.append(score)
        if one:
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(np.concatenate(two)), pa.array(np.concatenate(three))], ["one", "vec_id", "score"])

    met = here.union(going).repartition(max(1, int(begin[-1])), "place").sortWithinPartitions("place", "kind").mapInArrow(meet, "one long, vec_id long, score double")
    order = Window.partitionBy("one").orderBy(F.desc("score"), "vec_id")
    top = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= places).drop("rank")
    own = twin_queries.select(F.col("id").alias("query_id"), "one").distinct().join(top, "one").where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


MEETING = ["place", "kind", "id", "leaf", "leaves", "vec"]


def runs(values):
    """Bounds of runs of equal values."""
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)])
