"""SimHash fingerprints and search within a Hamming radius, in built-in expressions only.

Terms are runs of three words (fewer at a text's end), each occurrence weighing 1. A term's 128 hash bits vote on the
bits of the fingerprint; a bit is set when more than half of the weight is for it. Votes for two bits travel in one
long, so a text's 128 counters are 64 sums.

``classes`` finds all fingerprints within a radius of each other through tables that each put other blocks of bits in front: of
radius + 2 blocks, two are equal in any such pair, so the two meet in a table that puts these in front. A meeting of at most ``SMALL``
fingerprints is compared in full, and of its links those are kept that connect it. In a larger one each member is held against the
members just before it and, if they differ in class, the leader (the member of most such meetings); then only members that are still
in another class than most of their meeting are held against the rest of it. So a group of n near copies gives rows in proportion
to n, and no link between two classes is lost. All places are shuffled and sorted once; rows of one meeting stream through one task.

Defined results: null text counts as empty; an empty or blank text has no votes and the zero fingerprint; equal texts
have equal fingerprints; repeated rows are kept, ordered by id and then text; null ids come after all others and are
passed over where a class takes its smallest id. All empty texts are one class. Only the id and text columns are read, so
others cannot clash.
"""

import functools
import itertools
import json
import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from hubbub.llm.ngram_join import components
from hubbub.llm.shared import durable, with_nulls_as_text
from hubbub.operators.joins import lookup_join

TERM_WORDS, BITS, RADIUS = 3, 128, 10
# The most tables that a search keeps each fingerprint in.
MAX_TABLES = 66
# Rows that follow each other in one task, as far as STEPS x STEPS quantiles place them; members of a meeting that gives its pairs.
BLOCK_ROWS, STEPS, SMALL = 256, 256, 16
BLANK = "[ \\t\\n\\x0B\\f\\r]+"
LANES = 0x0000000100000001


def words_of(text):
    return F.filter(F.split(text, BLANK, -1), lambda w: w != "")


def hashes_of(words):
    return F.transform(F.col(words), lambda w, i: F.xxhash64(w, *[F.get(F.col(words), i + k) for k in range(1, TERM_WORDS)]))


def votes(rows, keys, hashes):
    """For each row, told apart by ``keys``: the two halves of the fingerprint of an array of term hashes.

    Rows already spread by one of the keys stay where they are."""
    terms = rows.select(*keys, F.explode_outer(hashes).alias("h"))
    terms = terms.select(*keys, "h", F.when(F.col("h").isNotNull(), F.xxhash64("h")).alias("g"))
    lane = lambda c, j: F.sum(F.shiftrightunsigned(c, j).bitwiseAND(F.lit(LANES))).alias(f"{c}{j}")
    sums = terms.groupBy(*keys).agg(F.count("h").alias("terms"), *[lane(c, j) for c in "hg" for j in range(32)])

    def half(c):
        bit = lambda votes_, j: F.when(2 * votes_ > F.col("terms"), F.lit(1 << j if j < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long"))
        out = F.lit(0).cast("long")
        for j in range(32):
            both = F.coalesce(F.col(f"{c}{j}"), F.lit(0).cast("long"))
            out = out.bitwiseOR(bit(both.bitwiseAND(F.lit(0xFFFFFFFF)), j)).bitwiseOR(bit(F.shiftrightunsigned(both, 32), j + 32))
        return out

    return sums.select(*keys, half("h").alias("high"), half("g").alias("low"))


def text_of(high, low):
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def distance(a, b, c, d):
    """Differing bits of the fingerprints (a, b) and (c, d)."""
    return F.bit_count(F.col(a).bitwiseXOR(F.col(c))) + F.bit_count(F.col(b).bitwiseXOR(F.col(d)))


def quantiles(parts):
    """The ends of ``parts`` equal shares of doc_id."""
    return F.percentile_approx("doc_id", [k / parts for k in range(1, parts + 1)], 10000).alias("cuts")


def below(cuts):
    """How many of the ends lie below doc_id."""
    return F.size(F.filter(cuts, lambda c: c < F.col("doc_id")))


def blocked(rows):
    """``rows`` with ``block``: ranges of doc_id of about BLOCK_ROWS rows each, rising with the id; nulls lie below all.

    Quantiles cut the ids into steps and quantiles of each step cut these, so ranges hold about equally many rows however
    the ids lie. The cuts are at most STEPS x STEPS numbers; beyond as many blocks, blocks grow."""
    n = rows.agg(F.count("doc_id")).first()[0]
    if not n:
        return rows.withColumn("block", F.lit(-1).cast("long"))
    steps = max(1, min(STEPS, n // BLOCK_ROWS))
    first = F.array(*[F.lit(c) for c in rows.agg(quantiles(steps)).first()[0]])
    rows = rows.withColumn("step", F.least(below(first), F.lit(steps - 1)))
    parts = max(1, min(STEPS, n // steps // BLOCK_ROWS))
    if parts == 1:
        return rows.withColumn("block", F.when(F.col("doc_id").isNull(), -1).otherwise(F.col("step")).cast("long")).drop("step")
    inner = {r["step"]: r["cuts"] for r in rows.where("doc_id is not null").groupBy("step").agg(quantiles(parts)).collect()}  # at most STEPS rows
    # One constant, so that every use of these rows has the same plan and their texts are shuffled once.
    cuts = F.get(F.from_json(F.lit(json.dumps([inner.get(k, []) for k in range(steps)])), "array<array<bigint>>"), F.col("step"))
    block = F.col("step") * parts + F.least(below(cuts), F.lit(parts - 1))
    return rows.withColumn("block", F.when(F.col("doc_id").isNull(), -1).otherwise(block).cast("long")).drop("step")


def next_blocks(firsts):
    """(block, after): the next lower block that has rows; after the lowest, the highest."""
    order = Window.orderBy(F.desc("block"))
    ahead = firsts.select("block", F.lead("block").over(order).alias("after"), F.first("block").over(order).alias("top"))
    return ahead.select("block", F.coalesce("after", "top").alias("after"))


def fingerprint_edited(docs, id_col="doc_id", text_col="text", radius=RADIUS):
    """Each document's fingerprint, that of its edited text (the last third replaced by the beginning of the next
    document, ids descending), the likeness of both and of the next document's fingerprint, and the smallest doc_id of its class:
    the documents that links between fingerprints within the radius connect.

    Texts move once, to their block; everything up to the votes stays there."""
    rows = blocked(with_nulls_as_text(docs, id_col, text_col))
    order = Window.partitionBy("block").orderBy(F.desc_nulls_last("doc_id"), "text")
    rows = rows.select("block", "doc_id", "text", F.row_number().over(order).alias("at"), F.lead("text").over(order).alias("following"))
    firsts = rows.where("at = 1").select("block", "text")
    after = next_blocks(firsts.select("block"))
    heads = firsts.select(F.col("block").alias("after"), F.col("text").alias("head")).join(after, "after").select("block", "head")
    rows = rows.join(heads.hint("merge"), "block", "left")
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    rows = rows.select("block", "at", "doc_id", "text", n.alias("n"), cut.alias("cut"), F.coalesce("following", "head").alias("following"))
    edited = F.when(F.col("cut") == 0, F.col("text")).otherwise(F.concat(F.substring("text", F.lit(1), F.col("n") - F.col("cut")), F.substring("following", F.lit(1), F.col("cut"))))
    rows = rows.select("block", "at", "doc_id", "n", "text", edited.alias("edited"))
    rows = rows.select("block", "at", "doc_id", "n", F.sha2("edited", 256).alias("sha"), words_of(F.col("text")).alias("w"), words_of(F.col("edited")).alias("v"))
    rows = rows.select("block", "at", "doc_id", "n", "sha", F.explode(F.array(F.struct(F.lit(0).alias("edit"), hashes_of("w").alias("hashes")), F.struct(F.lit(1).alias("edit"), hashes_of("v").alias("hashes")))).alias("side"))
    voted = votes(rows.select("*", F.col("side.edit").alias("edit")), ["block", "at", "doc_id", "n", "sha", "edit"], F.col("side.hashes"))
    own = lambda c, e: F.max(F.when(F.col("edit") == e, F.col(c)))
    prints = durable(voted.groupBy("block", "at", "doc_id", "n", "sha").agg(own("high", 0).alias("high"), own("low", 0).alias("low"), own("high", 1).alias("high_e"), own("low", 1).alias("low_e")))
    order = Window.partitionBy("block").orderBy("at")
    ahead = prints.select("*", F.lead("high").over(order).alias("high_n"), F.lead("low").over(order).alias("low_n"))
    firsts = prints.where("at = 1").select(F.col("block").alias("after"), F.col("high").alias("high_f"), F.col("low").alias("low_f"))
    heads = firsts.join(next_blocks(firsts.select(F.col("after").alias("block"))), "after").drop("after")
    ahead = ahead.join(heads, "block", "left").withColumn("high_n", F.coalesce("high_n", "high_f")).withColumn("low_n", F.coalesce("low_n", "low_f"))
    ahead = ahead.withColumn("fingerprint", text_of("high", "low"))
    ids = ahead.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    ids = ids.join(classes(ahead, radius), "fingerprint", "left").withColumn("class", F.coalesce("class", "fingerprint"))
    least = ids.groupBy("class").agg(F.min("least").alias("class_id"))
    # A frequent fingerprint's documents are spread over tasks.
    whole = lookup_join(ahead, ids.join(least, "class").select("fingerprint", "class_id"), ["fingerprint"], small=False)
    return whole.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        "fingerprint", text_of("high_e", "low_e").alias("edited_fingerprint"),
        (1 - distance("high", "low", "high_e", "low_e") / BITS).alias("near_edited"),
        (1 - distance("high", "low", "high_n", "low_n") / BITS).alias("near_next"),
        "class_id",
    )


def masks(radius):
    """Blocks of neighbouring bits as masks of the two halves, and how many of them stand together in a front.

    A pair within the radius differs in at most ``radius`` blocks, so with radius + c blocks at least c are equal: each c of
    them make a table. c is the largest that needs no more than MAX_TABLES tables, for the longest fronts."""
    together = max([1] + [c for c in range(1, BITS - radius + 1) if math.comb(radius + c, c) <= MAX_TABLES])
    cuts = [round(k * BITS / (radius + together)) for k in range(radius + together + 1)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    whole = [((1 << b) - (1 << a)) for a, b in zip(cuts, cuts[1:])]
    return [(signed(m >> 64), signed(m & (1 << 64) - 1)) for m in whole], together


def classes(prints, radius=RADIUS):
    """(fingerprint, class): the smallest fingerprint that links of at most ``radius`` bits reach, for every linked fingerprint.

    ``prints`` holds a column ``fingerprint``; equal ones are one fingerprint."""
    values = prints.select("fingerprint").where("fingerprint is not null").distinct()
    values = durable(values.select(*[F.conv(F.substring("fingerprint", at, 16), 16, -10).cast("long").alias(c) for c, at in (("h", 1), ("l", 17))]))
    # Kept rows are members of large meetings, and those that have somebody near among the rows before them.
    met = durable(meetings(values, radius).where(F.col("large") | (F.size("near") > 0)))
    links = met.select(F.struct("h", "l").alias("a"), F.explode("near").alias("b")).groupBy("a").agg(F.sort_array(F.collect_set("b")).alias("near"))
    links = durable(links.select("a", F.explode(thinned(F.col("near"), radius)).alias("b")))
    members = met.where("large").select("front", "h", "l")
    found = components(links) if members.isEmpty() else in_large_meetings(members, links, radius)
    return found.select(text_of("id.h", "id.l").alias("fingerprint"), text_of("label.h", "label.l").alias("class"))


def meetings(values, radius):
    """(front, h, l, large, near) for every place of a fingerprint where it is not alone: whether the meeting has more than SMALL members,
    and those of the SMALL - 1 members before it, in the order of h and l, that it is to be linked with.

    The places are shuffled and sorted once: members of a meeting follow each other."""
    blocks, together = masks(radius)
    whole = lambda chosen, half: sum(blocks[k][half] for k in chosen)
    chosen = list(itertools.combinations(range(len(blocks)), together))
    signed = lambda v: (v & 0xFFFFFFFF ^ 1 << 31) - (1 << 31)
    # A front is the number of its table and 25 bits of a hash: two under one hash only meet in vain.
    front = lambda at, own: F.hash(F.col("h").bitwiseAND(F.lit(whole(own, 0))), F.col("l").bitwiseAND(F.lit(whole(own, 1)))).bitwiseAND(F.lit((1 << 25) - 1)).bitwiseOR(F.lit(signed(at << 25)))
    places = values.select(F.explode(F.array(*[front(at, own) for at, own in enumerate(chosen)])).alias("front"), "h", "l")
    order = Window.partitionBy("front").orderBy("h", "l")
    many = F.count("*").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = places.withColumn("many", many).where("many > 1")
    rows = rows.select("front", "h", "l", (F.col("many") > SMALL).alias("large"), F.collect_list(F.struct("h", "l")).over(order.rowsBetween(1 - SMALL, -1)).alias("before"))
    near = F.filter("before", lambda b: apart(F.struct("h", "l"), b) <= radius)
    if len(blocks) < 63:  # a table is then its blocks as bits of a long
        differs = lambda b, k: F.col("h").bitwiseXOR(b["h"]).bitwiseAND(F.lit(blocks[k][0])).bitwiseOR(F.col("l").bitwiseXOR(b["l"]).bitwiseAND(F.lit(blocks[k][1])))
        equal = lambda b: functools.reduce(lambda x, y: x + y, [F.when(differs(b, k) == 0, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")) for k in range(len(blocks))])
        # The lowest bits of ``equal``, as many as stand together, are those that taking the lowest away so often removes: of
        # the tables where two meet, the one of their first equal blocks gives the pair.
        rest = lambda e: F.aggregate(F.array(*[F.lit(k) for k in range(together)]), e, lambda left, _: left.bitwiseAND(left - 1))
        table = F.get(F.array(*[F.lit(sum(1 << k for k in own)).cast("long") for own in chosen]), F.shiftrightunsigned("front", 25))
        near = F.filter(near, lambda b: F.col("large") | F.exists(F.array(equal(b)), lambda e: e.bitwiseXOR(rest(e)) == table))
    return rows.select("front", "h", "l", "large", thinned(near, radius).alias("near"))


def apart(a, b):
    """Differing bits of two structs of h and l."""
    return F.bit_count(a["h"].bitwiseXOR(b["h"])) + F.bit_count(a["l"].bitwiseXOR(b["l"]))


def thinned(near, radius):
    """The fingerprints of a sorted array, without those that are within the radius of one that stays before them.

    All of the array are near one fingerprint that comes after them in the order. Of two that are near each other the later one may
    go: it is linked with the earlier one by links among smaller fingerprints, so no class falls apart."""
    none = F.lit(None).cast("struct<h:bigint,l:bigint>")
    add = lambda kept, b: F.when(F.exists(kept, lambda e: apart(e, b) <= radius), kept).otherwise(F.concat(kept, F.array(b)))
    return F.aggregate(near, F.filter(F.array(none), lambda e: e.isNotNull()), add)


def in_large_meetings(members, links, radius):
    """(id, label) as of ``components``, where ``links`` and all members of large meetings that are within the radius are connected.

    Further links are looked for between classes only, and only classes are connected again."""
    side = lambda rows, p: rows.select("front", *[F.col(c).alias(p + c) for c in rows.columns if c != "front"])
    near = distance("ah", "al", "bh", "bl") <= radius
    between = lambda rows: durable(rows.where("alabel <> blabel").where(near).select(F.col("alabel").alias("a"), F.col("blabel").alias("b")).distinct())

    def mixed(labels):
        """Members of meetings that have several classes, with their class and the main one of the meeting."""
        labels = labels.select("id.h", "id.l", "label")
        classed = members.join(labels, ["h", "l"], "left").withColumn("label", F.coalesce("label", F.struct("h", "l")))
        shares = classed.groupBy("front", "label").agg(F.count("*").alias("many")).groupBy("front")
        shares = shares.agg(F.max_by("label", F.struct("many", "label")).alias("main"), F.count("*").alias("labels")).where("labels > 1")
        return durable(classed.join(shares.select("front", "main"), "front"))

    def merged(labels, links):
        """``labels`` after links between classes; a member that had no link was a class of its own."""
        more = components(links)
        old = labels.union(more.select("id", F.col("id").alias("label"))).distinct()
        return durable(old.join(more.select(F.col("id").alias("label"), F.col("label").alias("least")), "label", "left").select("id", F.coalesce("least", "label").alias("label")))

    labels = components(links)
    rows = mixed(labels)
    often = rows.groupBy("h", "l").agg(F.count("*").alias("often"))
    leaders = rows.join(often, ["h", "l"]).groupBy("front").agg(F.max(F.struct("often", "h", "l", "label")).alias("b"))
    leaders = leaders.select("front", F.col("b.h").alias("bh"), F.col("b.l").alias("bl"), F.col("b.label").alias("blabel"))
    stars = between(side(rows, "a").join(leaders, "front"))
    if not stars.isEmpty():
        labels = merged(labels, stars)
        rows = mixed(labels)
    # Of two members with different labels, at least one is not of the meeting's main class.
    minor = side(rows.where("label <> main").drop("main"), "a")
    rest = between(minor.join(side(rows.drop("main"), "b"), "front"))
    return labels if rest.isEmpty() else merged(labels, rest)
