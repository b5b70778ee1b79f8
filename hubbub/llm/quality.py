"""Document quality: random Fourier features of text statistics, ridge regression, isotonic calibration.

Statistics are computed for every whole text in one pass. Random Fourier features approximate a Gaussian kernel over
them; each partition sums its part of the normal equations, one set per fold, so leaving a fold out is a subtraction.
Out-of-fold scores give the isotonic calibration. What reaches the driver has a fixed size: the sums and one count per
score bin. Fitting uses all labelled rows; nothing is sampled.

Defined results: null text counts as empty, and empty texts are scored like any other; repeated rows are scored each;
a null id is never labelled and not held out. Several labels of one id are averaged; labels that are null or outside 0 to 1
are left out. With no label at all every score is 0.5. Only the named columns are read, so others cannot clash.
"""

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hubbub.llm.shared import column, durable, slices, small, with_nulls_as_text
from hubbub.llm.wordtable import Powers, hash_spans

FEATURES, WIDTH, RIDGE, SEED, THRESHOLD = 256, 0.5, 1e-3, 7, 0.3
FOLDS, ROWS_PER_TASK, BLOCK, BINS = 5, 200_000, 64, 2000

# Byte classes; a character beyond ASCII counts once, by its first byte.
LOWER, UPPER, DIGIT, SPACE, LINE, STOP, SYMBOL, WIDE, REST = range(9)
CLASSES = np.full(256, REST, np.uint8)
CLASSES[33:127] = SYMBOL
CLASSES[ord("a"):ord("z") + 1] = LOWER
CLASSES[ord("A"):ord("Z") + 1] = UPPER
CLASSES[ord("0"):ord("9") + 1] = DIGIT
CLASSES[[9, 11, 12, 13, 32]] = SPACE
CLASSES[10] = LINE
CLASSES[[ord(c) for c in ".,;:'\"?-()"]] = STOP
CLASSES[0xC0:] = WIDE
STATISTICS = 24


def per_text(values, bounds):
    """Sums of ``values`` between successive bounds."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(float)


def statistics(texts, powers):
    """One row of numbers per text, all finite; an empty text has zeros."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    sizes = np.array([len(r) for r in raw])
    bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    kind = CLASSES[data]
    kind[bounds[1:] - 1] = REST  # the joints
    count = np.stack([per_text(kind == k, bounds) for k in range(8)])
    chars = count.sum(axis=0)
    blank = (kind == SPACE) | (kind == LINE)
    blank[bounds[1:] - 1] = True
    before = np.concatenate([[True], blank[:-1]])
    starts = np.flatnonzero(~blank & before)
    ends = np.flatnonzero(blank & ~before)
    first = np.searchsorted(starts, bounds)
    words = np.diff(first).astype(float)
    length = (ends - starts).astype(float)
    hashes = hash_spans(powers, data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    own = np.repeat(np.arange(len(texts)), np.diff(first))

    def share(flag):
        return per_text(flag, first) / np.maximum(words, 1)

    def again(lag):
        same = np.zeros(len(hashes), bool)
        same[lag:] = (hashes[lag:] == hashes[:-lag]) & (own[lag:] == own[:-lag])
        return same

    shift = np.uint64(max(1, len(texts) - 1).bit_length())
    key = (own.astype(np.uint64) << (np.uint64(64) - shift)) | (hashes >> shift)
    key.sort()
    fresh = np.concatenate([[True], key[1:] != key[:-1]])[:len(key)]
    distinct = np.bincount((key[fresh] >> (np.uint64(64) - shift)).astype(np.int64), minlength=len(texts)).astype(float)
    head, tail = kind[starts], kind[ends - 1] if len(ends) else kind[:0]
    # A word's letters, from running counts.
    letters = np.concatenate([[0], np.cumsum((kind == LOWER) | (kind == UPPER) | (kind == WIDE))])
    capitals = np.concatenate([[0], np.cumsum(kind == UPPER)])
    own_letters, own_capitals = letters[ends] - letters[starts], capitals[ends] - capitals[starts]
    some = np.maximum(chars, 1)
    alphabet = count[LOWER] + count[UPPER] + count[WIDE]
    mean = per_text(length.astype(np.int64), first) / np.maximum(words, 1)
    square = per_text((length * length).astype(np.int64), first) / np.maximum(words, 1)
    rows = [
        np.log1p(chars), np.log1p(words), alphabet / some, count[UPPER] / np.maximum(alphabet, 1), count[DIGIT] / some,
        count[SPACE] / some, count[LINE] / some, count[STOP] / some, count[SYMBOL] / some, count[WIDE] / some,
        per_text(data == ord("|"), bounds) / some, per_text(data == ord("!"), bounds) / some,
        np.minimum(mean, 50), np.minimum(np.sqrt(np.maximum(square - mean * mean, 0)), 50), share(length <= 2), share(length >= 12),
        share(again(1)), share(again(2)), distinct / np.maximum(words, 1), share(tail == SYMBOL), share(own_letters == 0),
        share((own_capitals == own_letters) & (own_letters > 1)), share(head == UPPER), np.log1p(chars / (count[LINE] + 1)),
    ]
    return np.where(chars > 0, np.stack(rows), 0).T


def document_statistics(docs, id_col="doc_id", text_col="text"):
    """doc_id and ``stats``, an array of STATISTICS numbers."""
    rows = with_nulls_as_text(docs, id_col, text_col)

    def run(batches):
        powers = Powers()
        for part, texts in slices(batches):
            values = statistics(texts, powers)
            stats = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), STATISTICS).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column(0), stats], ["doc_id", "stats"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, stats array<double>")


@dataclasses.dataclass
class Model:
    """All that scoring needs; a few hundred kilobytes whatever the data."""

    mean: np.ndarray = None
    scale: np.ndarray = None
    weights: np.ndarray = None
    raw: np.ndarray = None
    share: np.ndarray = None
    features: int = FEATURES
    width: float = WIDTH

    def expand(self, stats):
        random = np.random.default_rng(SEED)
        turn = random.normal(0, self.width / np.sqrt(STATISTICS) * 2, (STATISTICS, self.features))
        phase = random.uniform(0, 2 * np.pi, self.features)
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        waves = np.sqrt(2 / self.features) * np.cos(x @ turn + phase)
        return np.hstack([np.ones((len(x), 1)), waves])

    def score(self, stats):
        if self.weights is None:
            return np.full(len(stats), 0.5)
        return np.interp(self.expand(stats) @ self.weights, self.raw, self.share)


def fold(id_column):
    """The remainder that decides who is held out (0) and which part of the rest a row belongs to."""
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(FOLDS))


def matrix(batch, name="stats"):
    values = batch.column(name)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), STATISTICS)


def pooled(raw, share, weight):
    """Pool adjacent violators: centres and values of the rising steps."""
    steps = []
    for r, s, w in zip(raw, share, weight):
        steps.append([r * w, s * w, w])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last)]
    return np.array([r / w for r, s, w in steps]), np.array([s / w for r, s, w in steps])


def fit(stats, labels, id_col="doc_id", label_col="quality", features=FEATURES, width=WIDTH, ridge=RIDGE):
    """Train on the labelled rows whose remainder is not 0. ``stats`` should be a stored table."""
    marks = labels.select(column(labels, id_col).alias("doc_id"), column(labels, label_col).cast("double").alias("label"))
    marks = marks.where("doc_id is not null and label between 0 and 1").groupBy("doc_id").agg(F.avg("label").alias("label"))
    known = stats.join(marks, "doc_id").withColumn("fold", fold(F.col("doc_id"))).where("fold <> 0").select("fold", "label", "stats")
    known = durable(known)
    n = known.count()
    if not n:
        return Model()
    known = known.coalesce(max(1, -(-n // ROWS_PER_TASK)))
    sums = [f(F.get("stats", F.lit(i))).alias(f"{f.__name__}_{i}") for i in range(STATISTICS) for f in (F.avg, F.stddev_pop)]
    first = known.agg(*sums).first()
    model = Model(features=features, width=width)
    model.mean = np.array([first[2 * i] for i in range(STATISTICS)])
    scale = np.array([first[2 * i + 1] for i in range(STATISTICS)])
    model.scale = np.where(scale > 1e-9, scale, 1.0)
    size = features + 1

    def equations(batches):
        total = np.zeros((FOLDS, size, size + 1))
        for batch in batches:
            x, y, f = model.expand(matrix(batch)), batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            for k in range(1, FOLDS):
                own = f == k
                total[k] += x[own].T @ np.hstack([x[own], y[own, None]])
        keys = [(k, b) for k in range(1, FOLDS) for b in range(0, size, BLOCK)]
        yield pa.RecordBatch.from_pydict({"fold": pa.array([k for k, _ in keys], pa.int32()), "block": pa.array([b for _, b in keys], pa.int32()), "data": [total[k, b:b + BLOCK].tobytes() for k, b in keys]})

    def added(batches):
        total = {}
        for batch in batches:
            for k, b, data in zip(*(c.to_pylist() for c in batch.columns)):
                value = np.frombuffer(data)
                total[k, b] = total[k, b] + value if (k, b) in total else value
        if total:
            yield pa.RecordBatch.from_pydict({"fold": pa.array([k for k, _ in total], pa.int32()), "block": pa.array([b for _, b in total], pa.int32()), "data": [v.tobytes() for v in total.values()]})

    schema = "fold int, block int, data binary"
    parts = known.mapInArrow(equations, schema).repartition("fold", "block").mapInArrow(added, schema)
    total = np.zeros((FOLDS, size, size + 1))
    for row in small(parts, FOLDS * (size // BLOCK + 1)):
        value = np.frombuffer(row["data"]).reshape(-1, size + 1)
        total[row["fold"], row["block"]:row["block"] + len(value)] = value

    def solve(part):
        rows = max(part[0, 0], 1.0)
        penalty = ridge * rows * np.eye(size)
        penalty[0, 0] = 0
        return np.linalg.solve(part[:, :size] + penalty + 1e-9 * np.eye(size), part[:, size])

    whole = total.sum(axis=0)
    model.weights = solve(whole)
    left_out = np.stack([model.weights if k == 0 or not total[k].any() else solve(whole - total[k]) if (whole - total[k]).any() else model.weights for k in range(FOLDS)])

    def binned(batches):
        for batch in batches:
            f = batch.column("fold").to_numpy().astype(int)
            raw = np.einsum("ij,ij->i", model.expand(matrix(batch)), left_out[f])
            yield pa.RecordBatch.from_pydict({"bin": np.clip((raw + 1) / 3 * BINS, 0, BINS - 1).astype(np.int32), "raw": raw, "label": batch.column("label")})

    bins = known.mapInArrow(binned, "bin int, raw double, label double").groupBy("bin").agg(F.avg("raw").alias("raw"), F.avg("label").alias("label"), F.count("*").alias("n"))
    got = sorted(small(bins, BINS), key=lambda r: r["bin"])
    model.raw, model.share = pooled([r["raw"] for r in got], [r["label"] for r in got], [r["n"] for r in got])
    return model


def score(stats, model, threshold=THRESHOLD):
    """doc_id, held_out, score, predicted."""
    def run(batches):
        for batch in batches:
            value = np.clip(model.score(matrix(batch)), 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(value)], ["doc_id", "score"])

    scored = stats.mapInArrow(run, f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, score double")
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def classify(docs, labels, id_col="doc_id", text_col="text"):
    """Train on ``labels`` and score all of ``docs``."""
    stats = durable(document_statistics(docs, id_col, text_col))
    return score(stats, fit(stats, labels, id_col))


def keep_good(docs, labels, id_col="doc_id", text_col="text", threshold=THRESHOLD):
    """The documents, all columns, that score at least ``threshold``. The fitted model goes to the rows, so no text is shuffled."""
    stats = durable(document_statistics(docs, id_col, text_col))
    model = fit(stats, labels, id_col)
    at = docs.columns.index(text_col)

    def run(batches):
        powers = Powers()
        for part, texts in slices(batches, at):
            good = np.clip(model.score(statistics(texts, powers)), 0, 1) >= threshold
            yield part.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
