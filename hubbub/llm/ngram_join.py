"""Exact Jaccard self-join on word shingles by prefix filters under several token orders, and the groups it links.

1. Equal shingle sets are one set from the start, known by a 64-bit digest, so exact copies cost one.
2. A sketch of fixed size counts all shingles. It gives the token orders: rare classes first, then a hash that
   differs from order to order. Any order known to all sets is valid, so the sketch only decides speed.
3. Sets whose similarity reaches the limit share a token among the first ones of every order. Under the first
   order, sets meet by such tokens, with size and position bounds. Small meetings give their pairs. In large ones
   everybody is paired with the set that meets most often; once links are known, only pairs between different
   components are left to look at, in blocks of bounded size.
4. Parities of token groups, two to four groups for each token, bound the difference of two sets from below and drop
   candidates that differ too much. The leading tokens of what is left, under the other orders and as 32-bit hashes, are joined
   to the pairs: a pair stays that shares one under every order. Only then whole sets travel, and are compared.

Components come from minimum labels with pointer jumping. No step gathers a group, links or components in one place;
the driver holds the sketch and a Bloom filter, both of fixed size.

Defined results: a text without words (null, empty, blank) has an empty set, is linked with nothing and is its own
component; repeated rows are copies of each other; a null id is ignored as a component's smallest id. Only the
id and text columns are read, so others cannot clash.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from hubbub.llm.shared import column, durable, slices, small, with_nulls_as_text
from hubbub.llm.wordtable import Powers, hash_spans, mix

WORDS, PERCENT, ORDERS = 5, 80, 3
# Sketch counters and chunks they travel in; bits of the Bloom filter over candidates.
COUNTERS, CHUNK, BLOOM_BITS = 1 << 22, 1 << 16, 1 << 26
# The fewest token groups whose parity is kept for a set.
PARITY_BITS = 1024
# Members of a meeting that gives all its pairs; rows of a task; members of a block of a larger meeting.
SMALL, TASK_ROWS, BLOCK = 16, 600_000, 1024
FACTORS = mix(np.arange(101, 101 + 64, dtype=np.uint64)) | np.uint64(1)
SALTS = mix(np.arange(11, 11 + 16, dtype=np.uint64))
RECORD = np.dtype([("key", "<u4"), ("id", "<i8"), ("n", "<u4"), ("pos", "<u2"), ("salt", "<u2")])

LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def shingle_sets(texts, powers, words=WORDS):
    """One sorted array of distinct 64-bit shingle hashes per text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    data = LOWERED[np.frombuffer(b"\n".join([*raw, b""]), np.uint8)]
    blank = BLANK[data]
    before = np.concatenate([[True], blank[:-1]])
    starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
    hashes = hash_spans(powers, data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    first = np.searchsorted(starts, bounds)
    full = np.zeros(len(hashes), np.uint64)
    if len(hashes) >= words:
        for k in range(words):
            full[:len(hashes) - words + 1] += hashes[k:len(hashes) - words + 1 + k] * FACTORS[k]
        full = mix(full + np.uint64(words))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(full[a:b - words + 1]))
        elif b > a:
            out.append(mix((hashes[a:b] * FACTORS[:b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(full[:0])
    return out


def digest(tokens):
    return int(mix(mix(tokens ^ SALTS[-1]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(tokens))).view(np.int64)[0])


def bucket_of(tokens):
    return (mix(tokens ^ SALTS[-2]) >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def parities(tokens):
    """Of each token group, whether an odd number of tokens is in the set, as packed bits."""
    bits = max(PARITY_BITS.bit_length() - 1, (2 * len(tokens) - 1).bit_length())
    at = (mix(tokens ^ SALTS[-3]) >> np.uint64(64 - bits)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=1 << bits) & 1).astype(np.uint8))


def shortened(marks):
    """(a, short): the parities of each set (id, data) folded to PARITY_BITS groups."""
    def fold(batches):
        for batch in batches:
            short = []
            for data in batch.column("data"):
                bits = np.unpackbits(np.frombuffer(data.as_buffer(), np.uint8)).reshape(PARITY_BITS, -1)
                short.append(np.packbits(np.bitwise_xor.reduce(bits, axis=1)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(short, pa.binary())], ["a", "short"])

    return marks.select("id", "data").mapInArrow(fold, "a long, short binary")


def differing(x, y):
    """The least number of tokens that two sets with these parities differ by."""
    x, y = np.unpackbits(np.frombuffer(x, np.uint8)), np.unpackbits(np.frombuffer(y, np.uint8))
    # Twice as many groups are halves of the fewer ones.
    x, y = (np.bitwise_xor.reduce(v.reshape(min(len(x), len(y)), -1), axis=1) for v in (x, y))
    return int((x ^ y).sum(dtype=np.int64))


def lead(n, percent=PERCENT):
    """How many first tokens of a set of n must hold one in common with any set similar enough."""
    return n - -(-n * percent // 100) + 1


def prefix(tokens, order, classes, percent=PERCENT):
    """The first tokens under an order: class in the top byte, then a hash of the order's own."""
    keys = (classes[bucket_of(tokens)].astype(np.uint64) << np.uint64(56)) | (mix(tokens ^ SALTS[order]) >> np.uint64(8))
    keys.sort()
    return keys[:lead(len(keys), percent)]


# --- pass 1: sizes, digests and the sketch ------------------------------------------------------

def profile(rows, words):
    """Rows (doc_id, n, id, parities as data) of all documents, and counter chunks of each task."""
    def run(batches):
        powers, count = Powers(), np.zeros(COUNTERS, np.uint16)
        for part, texts in slices(batches):
            sets = shingle_sets(texts, powers, words)
            tokens = np.concatenate(sets)
            if len(tokens):
                at, many = np.unique(bucket_of(tokens), return_counts=True)
                count[at] = np.minimum(count[at].astype(np.int64) + many, 65535)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s) for s in sets], pa.int64()), pa.nulls(len(sets), pa.int32()), pa.array([parities(s).tobytes() for s in sets])],
                ["doc_id", "n", "id", "chunk", "data"])
        for c in range(COUNTERS // CHUNK):
            own = count[c * CHUNK:(c + 1) * CHUNK]
            if own.any():
                own = own.astype(np.uint8) if own.max() < 256 else own
                yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([c], pa.int32()), pa.array([own.tobytes()])], ["doc_id", "n", "id", "chunk", "data"])

    name = rows.schema["doc_id"].dataType
    id_type = to_arrow_type(name)
    return rows.mapInArrow(run, f"doc_id {name.simpleString()}, n long, id long, chunk int, data binary")


def usual_load(total):
    """Twice the mean of a counter: more marks a frequent shingle."""
    return 2 * max(1.0, total / COUNTERS)


def token_classes(profiled, total):
    """Class of each counter: 0 up to twice the mean load, one more with each doubling."""
    def add(batches):
        sums = {}
        for batch in batches:
            for c, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(data.as_buffer(), np.uint8 if len(data.as_buffer()) == CHUNK else np.uint16)
                sums.setdefault(c, np.zeros(CHUNK, np.int64))
                sums[c] += own
        for c, counts in sums.items():
            kind = np.clip(np.floor(np.log2(np.maximum(counts, 1) / usual)), 0, 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([kind.tobytes()])], ["chunk", "data"])

    usual = usual_load(total)
    parts = profiled.where("chunk is not null").select("chunk", "data").repartition("chunk").mapInArrow(add, "chunk int, data binary")
    classes = np.zeros(COUNTERS, np.uint8)
    for row in small(parts, COUNTERS // CHUNK):
        classes[row["chunk"] * CHUNK:(row["chunk"] + 1) * CHUNK] = np.frombuffer(row["data"], np.uint8)
    return classes


# --- pass 2: meetings by leading tokens -----------------------------------------------------------

def similar(inter, a, b, percent):
    return 100 * inter >= percent * (a + b - inter)


def meetings(rows, classes, usual, buckets, words, percent):
    """Under the first order: pairs (kind 0: a, b), members of large meetings (kind 1: key, a, n, pos), and a line for each of
    these meetings (kind 2: key, digest of its members as a, their number as n, sum of their places as pos).

    A token that the sketch expects to bring more than TASK_ROWS sets together is dealt over several tasks by the sets' ids;
    its meeting then counts as large wherever a part of it lands."""
    def send(batches):
        powers, seen = Powers(), set()
        for _, texts in slices(batches):
            keys, owner, size, place = [], [], [], []
            for tokens in shingle_sets(texts, powers, words):
                who = digest(tokens)
                if not len(tokens) or who in seen:
                    continue
                seen.add(who)
                if len(seen) > 1_000_000:
                    seen.clear()
                own = prefix(tokens, 0, classes, percent)
                keys.append(own), place.append(np.minimum(np.arange(len(own)), 65535))
                owner.append(np.full(len(own), who)), size.append(np.full(len(own), len(tokens)))
            if not keys:
                continue
            keys, owner = np.concatenate(keys), np.concatenate(owner)
            kind = (keys >> np.uint64(56)).astype(np.int64)
            tasks = np.where(kind > 0, np.minimum(np.ceil(usual * 2.0 ** (kind + 1) / TASK_ROWS), 60_000), 1).astype(np.int64)
            salt = np.where(tasks > 1, 1 + (owner & 0x7FFFFFFF) % tasks, 0)
            keys = mix(keys)
            bucket = ((keys >> np.uint64(32)).astype(np.int64) + salt) % buckets
            records = np.empty(len(keys), RECORD)
            records["key"], records["id"], records["n"], records["pos"] = keys & np.uint64(0xFFFFFFFF), owner, np.concatenate(size), np.concatenate(place)
            records["salt"] = salt
            order = np.argsort(bucket, kind="stable")
            records, bucket = records[order], bucket[order]
            at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            ends = np.append(at[1:], len(bucket))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[at], pa.int64()), pa.array([records[s:e].tobytes() for s, e in zip(at.tolist(), ends.tolist())])], ["bucket", "data"])

    def meet(batches):
        got, own = [], []
        for batch in batches:
            for b, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                got.append(np.frombuffer(data.as_buffer(), RECORD)), own.append(np.full(len(got[-1]), b))
        if not got:
            return
        records = np.concatenate(got)
        keys = (((np.concatenate(own) - records["salt"]) % buckets).astype(np.uint64) << np.uint64(32)) | records["key"]
        del got, own
        order = np.lexsort((records["id"], keys))
        records, keys = records[order], keys[order]
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (records["id"][1:] != records["id"][:-1])])
        records, keys = records[new], keys[new]
        bounds = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        size = np.repeat(np.diff(bounds), np.diff(bounds))
        large = (size > SMALL) | (records["salt"] > 0)
        records_, keys_ = records[(size > 1) & ~large], keys[(size > 1) & ~large]
        pairs = []
        for lag in range(1, SMALL):
            i = np.flatnonzero(keys_[lag:] == keys_[:-lag]) if len(keys_) > lag else []
            if not len(i):
                break
            x, y = records_[i], records_[i + lag]
            ok = possible(x["n"].astype(np.int64), x["pos"].astype(np.int64), y["n"].astype(np.int64), y["pos"].astype(np.int64), percent)
            pairs.append(np.stack([x["id"][ok], y["id"][ok]], axis=1))
        pairs = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        for s in range(0, len(pairs), 100_000):
            own = pairs[s:s + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(own), np.int32)), pa.nulls(len(own), pa.int64()), pa.array(own[:, 0]), pa.array(own[:, 1]), pa.nulls(len(own), pa.int64()), pa.nulls(len(own), pa.int64())], MET)
        big, key = records[large], keys[large]
        if len(big):
            # Of meetings with the same members, the earliest in the token order says all: it is told by the smallest places.
            at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            count = np.diff(np.append(at, len(key)))
            who = mix(np.add.reduceat(mix(np.ascontiguousarray(big["id"]).view(np.uint64)), at) + count.astype(np.uint64))
            alone = big["salt"][at] > 0  # a part of a meeting that is dealt over tasks stands for itself
            who = np.where(alone, mix(key[at]), who)
            places = np.add.reduceat(big["pos"].astype(np.int64), at)
            for s in range(0, len(at), 100_000):
                e = slice(s, s + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at[e]), 2, np.int32)), pa.array(key[at[e]].view(np.int64)), pa.array(who[e].view(np.int64)), pa.nulls(len(at[e]), pa.int64()), pa.array(count[e].astype(np.int64)), pa.array(places[e])], MET)
        for s in range(0, len(big), 100_000):
            own = big[s:s + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(own), np.int32)), pa.array(key[s:s + 100_000].view(np.int64)), pa.array(own["id"]), pa.nulls(len(own), pa.int64()), pa.array(own["n"].astype(np.int64)), pa.array(own["pos"].astype(np.int64))], MET)

    sent = rows.select("text").withColumn("id", F.lit(0)).select("id", "text").mapInArrow(send, "bucket long, data binary")
    return sent.repartition(buckets, "bucket").mapInArrow(meet, "kind int, key long, a long, b long, n long, pos long")


MET = ["kind", "key", "a", "b", "n", "pos"]


def possible(n, pos, m, at, percent):
    """Two sets of n and m tokens whose first shared token is at these positions may still be similar enough."""
    top = np.minimum(n - pos, m - at)
    return similar(top, n, m, percent)


def possible_column(n, pos, m, at, percent):
    top = F.least(n - pos, m - at)
    return 100 * top >= percent * (n + m - top)


def close_enough(pairs, marks, percent):
    """The pairs (a, b) that the parities of their sets do not rule out. ``marks`` has id, n, data."""
    side = lambda p: marks.select(F.col("id").alias(p), F.col("n").alias(f"n{p}"), F.col("data").alias(f"d{p}"))

    def check(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            least = np.array([differing(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column("da"), batch.column("db"))])
            ok = least * (100 + percent) <= n * (100 - percent)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "da", "db")
    return both.mapInArrow(check, "a long, b long")


# --- verification -------------------------------------------------------------------------------

def bloom(ids):
    """Bits of a fixed-size Bloom filter over a column of ids, or None for none."""
    def run(batches):
        bits = np.zeros(BLOOM_BITS // 8, np.uint8)
        for batch in batches:
            mark(bits, batch.column(0).to_numpy())
        for c in range(0, len(bits), CHUNK):
            if bits[c:c + CHUNK].any():
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([bits[c:c + CHUNK].tobytes()])], ["chunk", "data"])

    def either(batches):
        sums = {}
        for batch in batches:
            for c, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(data.as_buffer(), np.uint8)
                sums[c] = sums[c] | own if c in sums else own
        for c, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([own.tobytes()])], ["chunk", "data"])

    bits = np.zeros(BLOOM_BITS // 8, np.uint8)
    schema = "chunk int, data binary"
    for row in small(ids.mapInArrow(run, schema).repartition("chunk").mapInArrow(either, schema), len(bits) // CHUNK):
        bits[row["chunk"]:row["chunk"] + CHUNK] = np.frombuffer(row["data"], np.uint8)
    return bits


def bit_places(ids):
    ids = np.ascontiguousarray(ids).view(np.uint64)
    return [(mix(ids ^ SALTS[9 + k]) >> np.uint64(64 - BLOOM_BITS.bit_length() + 1)).astype(np.int64) for k in range(3)]


def mark(bits, ids):
    for at in bit_places(ids):
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))


def marked(bits, ids):
    return np.logical_and.reduce([(bits[at >> 3] >> (at & 7)) & 1 == 1 for at in bit_places(ids)])


def wanted_sets(rows, pairs, words, make):
    """(id, data): ``make(tokens)`` as bytes, once for each set that the pairs name and each task that meets it."""
    wanted = bloom(pairs.select("a").union(pairs.select("b")).distinct())

    def run(batches):
        powers, seen = Powers(), set()
        for _, texts in slices(batches):
            found = shingle_sets(texts, powers, words)
            ids = np.array([digest(s) for s in found], np.int64)
            keep = [i for i in np.flatnonzero(marked(wanted, ids)).tolist() if len(found[i]) and ids[i] not in seen]
            seen.update(ids[keep].tolist())
            if len(seen) > 1_000_000:
                seen.clear()
            keep = list({ids[i]: i for i in keep}.values())
            yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array([make(found[i]) for i in keep], pa.binary())], ["id", "data"])

    return rows.select(F.lit(0).alias("id"), "text").mapInArrow(run, "id long, data binary")


def leads_of(tokens, classes, percent):
    """The leading tokens under the orders behind the first one, equally many of each, as sorted 32-bit hashes."""
    return b"".join(np.sort((mix(prefix(tokens, order, classes, percent)) >> np.uint64(32)).astype(np.uint32)).tobytes() for order in range(1, ORDERS))


def share_leads(x, y):
    """Whether two sets share a leading token under each of these orders; two tokens with one hash only let a pair pass."""
    x, y = (np.frombuffer(v, np.uint32).reshape(ORDERS - 1, -1) for v in (x, y))
    return all(len(np.intersect1d(a, b)) for a, b in zip(x, y))


def sharing_leads(rows, pairs, classes, words, percent):
    """The pairs (a, b) that share leading tokens under every order behind the first. ``pairs`` is a stored table."""
    leads = wanted_sets(rows, pairs, words, lambda tokens: leads_of(tokens, classes, percent)).dropDuplicates(["id"])
    leads = durable(leads)
    side = lambda p: leads.select(F.col("id").alias(p), F.col("data").alias(f"d{p}"))

    def check(batches):
        for batch in batches:
            ok = [share_leads(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column("da"), batch.column("db"))]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "da", "db").mapInArrow(check, "a long, b long")


def verified(rows, pairs, classes, words, percent):
    """The pairs (a, b) of set digests that are similar enough. ``pairs`` is a stored table."""
    pairs = durable(sharing_leads(rows, pairs, classes, words, percent))
    ends = pairs.select(F.col("a").alias("id"), "a", "b").union(pairs.select(F.col("b").alias("id"), "a", "b"))

    def compare(batches):
        pair = first = None  # the pair at hand, and its set that came first until the other one comes
        for batch in batches:
            good = []
            for who, a, b, data in zip(*(batch.column(c) for c in ("id", "a", "b", "data"))):
                who, here = who.as_py(), (a.as_py(), b.as_py())
                if here != pair:
                    pair, first = here, (who, np.frombuffer(data.as_py(), np.uint64))
                elif first and first[0] != who:
                    tokens = np.frombuffer(data.as_buffer(), np.uint64)
                    if similar(len(np.intersect1d(first[1], tokens, assume_unique=True)), len(first[1]), len(tokens), percent):
                        good.append(here)
                    first = None  # decided; more copies of either set may still come
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in good], pa.int64()) for k in (0, 1)], ["a", "b"])

    count = pairs.count()
    both = ends.join(wanted_sets(rows, pairs, words, lambda tokens: tokens.tobytes()).hint("merge"), "id").select("id", "a", "b", "data")
    return durable(both.repartition(max(1, count // 2000), "a", "b").sortWithinPartitions("a", "b").mapInArrow(compare, "a long, b long"))


def components(links):
    """(id, label): the smallest id reachable, for every id that has a link."""
    both = links.select(F.col("a").alias("x"), F.col("b").alias("y"))
    both = durable(both.union(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = both.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("id"), F.least("x", "y").alias("label"))
    labels = durable(labels)
    while True:
        near = both.join(labels, both["x"] == labels["id"]).groupBy("y").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["id"] == near["y"]).select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("next"))
        labels_ = durable(step.join(jump, "label").select("id", "old", F.least("label", "next").alias("label")))
        labels = labels_.select("id", "label")
        if labels_.where("old <> label").isEmpty():
            return labels


def left_over(members, labels, marks, percent):
    """Pairs of members of one large meeting that lie in different components and may be similar enough.

    ``marks`` has id and data, the parities of each set; their short form is looked at before a pair leaves its block."""
    named = members.join(labels.withColumnRenamed("id", "a"), "a", "left").select("key", "a", "n", "pos", F.coalesce("label", "a").alias("label"))
    named = durable(named)
    mixed = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("many")).where("low <> high")
    rest = named.join(mixed.select("key", F.ceil(F.col("many") / BLOCK).cast("int").alias("blocks")), "key")
    # Each block of members meets each other block once; a member goes to as many places as there are blocks.
    rest = rest.withColumn("own", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.select("key", "a", "n", "pos", "label", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    rest = rest.join(shortened(marks), "a")

    def across(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in ("key", "i", "j", "own", "a", "n", "pos", "label")]
            columns.append(np.frombuffer(b"".join(batch.column("short").to_pylist()), np.uint64).reshape(batch.num_rows, -1))
            if held is not None:
                columns = [np.concatenate(c) for c in zip(held, columns)]
            key, i, j = columns[:3]
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            bounds = [0, *cuts.tolist()]
            yield found([meeting([c[s:e] for c in columns]) for s, e in zip(bounds, bounds[1:])])
            held = [c[bounds[-1]:] for c in columns]  # its end may be in the next batch
        if held is not None:
            yield found([meeting(held)])

    def found(pairs):
        pairs = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def meeting(columns):
        _, i, j, own, a, n, pos, label, short = columns
        left, right = (slice(None), slice(None)) if i[0] == j[0] else (own == i[0], own == j[0])
        ok = label[left][:, None] != label[right][None, :]
        ok &= possible(n[left][:, None], pos[left][:, None], n[right][None, :], pos[right][None, :], percent)
        x, y = np.nonzero(ok)
        x, y, near = np.arange(len(a))[left][x], np.arange(len(a))[right][y], np.zeros(len(x), bool)
        for s in range(0, len(x), 100_000):
            e, f = x[s:s + 100_000], y[s:s + 100_000]
            near[s:s + 100_000] = np.bitwise_count(short[e] ^ short[f]).sum(axis=1, dtype=np.int64) * (100 + percent) <= (n[e] + n[f]) * (100 - percent)
        x, y = a[x[near]], a[y[near]]
        return np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1)

    # Blocks lie in tasks as their number asks for; rows of one block follow each other.
    dealt = rest.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").select("key", "i", "j", "own", "a", "n", "pos", "label", "short")
    return dealt.mapInArrow(across, "a long, b long").distinct()


def join(docs, id_col="doc_id", text_col="text", words=WORDS, percent=PERCENT):
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) for every document."""
    rows = with_nulls_as_text(docs, id_col, text_col)
    profiled = durable(profile(rows, words))
    slim = profiled.where("chunk is null").select("doc_id", "n", "id")
    sets = slim.where("n > 0").groupBy("id").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"))
    marks = profiled.where("chunk is null and n > 0").select("id", "n", "data").dropDuplicates(["id"])
    total, leads = sets.agg(F.sum("n"), F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).first()
    alone = F.col("doc_id").alias("component_id")
    if not total:
        return slim.select("doc_id", F.col("n").alias("n_shingles"), alone)
    classes = token_classes(profiled, total)
    met = durable(meetings(rows, classes, usual_load(total), max(1, -(-int(leads) // TASK_ROWS)), words, percent))
    told = met.where("kind = 2").groupBy("a", "n").agg(F.min_by("key", F.struct("pos", "key")).alias("key")).select("key")
    members = durable(met.where("kind = 1").select("key", "a", "n", "pos").join(told, "key", "left_semi"))
    pairs = met.where("kind = 0").select("a", "b")
    often = members.withColumn("often", F.count("*").over(Window.partitionBy("a")))
    lead_ = often.groupBy("key").agg(F.max(F.struct("often", F.col("a").alias("b"), F.col("n").alias("m"), F.col("pos").alias("at"))).alias("l")).select("key", "l.*")
    star = members.join(lead_, "key").where("a <> b").where(possible_column(F.col("n"), F.col("pos"), F.col("m"), F.col("at"), percent))
    pairs = pairs.union(star.select(F.least("a", "b"), F.greatest("a", "b"))).distinct()
    pairs = durable(close_enough(pairs, marks, percent))
    links = verified(rows, pairs, classes, words, percent)
    labels = components(links)
    rest = left_over(members, labels, marks, percent).join(pairs, ["a", "b"], "left_anti")
    rest = durable(close_enough(rest, marks, percent))
    if not rest.isEmpty():
        links = links.union(verified(rows, rest, classes, words, percent))
        labels = components(links)
    # From digests to the smallest doc_id of each component, then to every document.
    named = sets.join(labels, "id", "left").select("id", F.coalesce("label", "id").alias("label"), "rep")
    least = named.join(named.groupBy("label").agg(F.min("rep").alias("component_id")), "label").select("id", "component_id")
    return slim.join(least, "id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs, id_col="doc_id", text_col="text", words=WORDS, percent=PERCENT):
    """One document of each group stays: the one with the smallest id, null ids last; of repeated rows of that id and text, one.

    Documents are told apart by id and text, so a row does not stay because another row of its id does. Texts without words
    are linked with nothing: one row for each id and text stays, and all those without an id."""
    key = lambda frame: (column(frame, id_col), F.xxhash64(F.coalesce(column(frame, text_col), F.lit(""))))
    id_, text = key(docs)
    rows = docs.select(F.struct(id_.isNull().alias("no"), id_.alias("id"), text.alias("text")).alias("doc_id"), column(docs, text_col).alias("text"))
    found = join(rows, "doc_id", "text", words, percent).where("doc_id = component_id")
    stay = found.groupBy("doc_id").agg(F.max("n_shingles").alias("n"), F.count("*").alias("many"))
    stay = durable(stay.select(F.col("doc_id.id").alias("__id"), F.col("doc_id.text").alias("__text"), F.expr("many > 1 and not (n = 0 and doc_id.no)").alias("__again")))
    chosen = lambda part: docs.join(part, id_.eqNullSafe(part["__id"]) & (text == part["__text"]), "left_semi")
    again = stay.where("__again")
    if again.isEmpty():
        return chosen(stay)
    free = max(len(c) for c in docs.columns) * "_"  # longer than any column's name once a letter is added
    keyed = chosen(again).withColumns({f"i{free}": id_, f"t{free}": text})
    once = keyed.dropDuplicates([f"i{free}", f"t{free}"]).drop(f"i{free}", f"t{free}")
    return chosen(stay.where("not __again")).union(once)


# The same by comparing every two documents that share a shingle.
SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') as words from documents),
s as (select distinct doc_id, case when len(words) < 5 then words else words[i:i + 4] end as shingle
  from (select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i from w where len(words) > 0)),
n as (select doc_id, count(*) as size from s group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as inter from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where 100 * inter >= 80 * (x.size + y.size - inter)),
both_ways as (select a, b from links union all select b, a from links),
reach as (select doc_id as a, doc_id as b from documents union select r.a, e.b from reach r join both_ways e on r.b = e.a)
select doc_id, coalesce(size, 0)::bigint as n_shingles, least_id as component_id
from (select a as doc_id, min(b) as least_id from reach group by 1) left join n using (doc_id)
"""
