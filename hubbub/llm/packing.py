"""Best-fit-decreasing packing of token pieces into sequences of a fixed capacity.

Only a piece's length decides where best-fit decreasing puts it, so the plan is made once for counts per length
(at most ``capacity`` of them, whatever the corpus holds) and every piece then looks up its place by its number
among the pieces of its length. A segment tree over remaining capacities finds the tightest open bin in
logarithmic time; pieces of one length that meet equal bins move together. The plan is the one the
piece-by-piece method makes.

Defined results: null text counts as empty and still yields one piece (the closing id); repeated rows and repeated
or null ids give one set of pieces per row; an empty table gives no rows. Only the id and text columns are read.
"""

import bisect
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hubbub.llm.shared import durable, kept_in_worker, slices, small, with_nulls_as_text
from hubbub.llm.wordtable import WordTable

VOCABULARY = "word_bpe_49k.json"
# Pieces of one length that are numbered together.
GROUP_ROWS = 500


# --- tokens -----------------------------------------------------------------------------------

LETTER, DIGIT, SPACE, OTHER, ODD = range(5)
# Class of each byte of a lower-cased text. ODD bytes send the whole text to the tokenizer itself: control
# characters, and whatever lies beyond the Latin letters of two bytes, where its own normaliser must decide.
CLASSES = np.full(256, ODD, np.uint8)
CLASSES[33:127] = OTHER
CLASSES[[9, 10, 11, 12, 13, 32]] = SPACE
CLASSES[ord("0"):ord("9") + 1] = DIGIT
CLASSES[ord("a"):ord("z") + 1] = LETTER
CLASSES[0x80:0xC0] = LETTER
CLASSES[0xC3:0xC6] = LETTER
# Two-byte characters in that range that are no letters or have their own lower-case rules.
EXCEPT = {0xC3: (0x97, 0xB7), 0xC4: (0xB0, 0xB1), 0xC5: (0x89, 0xBF)}


def byte_letters():
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class Encoder:
    """Ids of whole texts, equal to those of the tokenizer in the vocabulary file."""

    def __init__(self, path):
        self.tokenizer = Tokenizer.from_file(path)
        model, letters = self.tokenizer.model, byte_letters()
        # One character per byte: a word's bytes, read as Latin-1, map to it.
        self.map = {b: c for b, c in letters.items() if chr(b) != c}
        self.words = WordTable(lambda words: [[t.id for t in model.tokenize(w.decode("latin-1").translate(self.map))] for w in words])

    def encode(self, texts):
        """One array of ids per text."""
        out, plain = [None] * len(texts), []
        for i, t in enumerate(texts):
            plain.append("" if "\0" in t or "<|" in t else t)
        data = np.frombuffer("\0".join([*plain, ""]).lower().encode("utf-8", "replace"), np.uint8)
        kind = CLASSES[data]
        stops = np.flatnonzero(data == 0)
        kind[stops] = SPACE
        odd = np.flatnonzero(kind == ODD)
        for lead, seconds in EXCEPT.items():
            at = np.flatnonzero(data[:-1] == lead) if len(data) else np.zeros(0, np.int64)
            odd = np.concatenate([odd, at[np.isin(data[at + 1], seconds)]])
        whole = {i for i, t in enumerate(texts) if plain[i] is not t} | set(np.searchsorted(stops, odd).tolist())
        starts, ends = word_bounds(data, kind)
        inside = np.searchsorted(starts, stops)  # words before each text's end
        if whole:
            keep = np.ones(len(starts), bool)
            for i in whole:
                keep[(inside[i - 1] if i else 0):inside[i]] = False
            starts, ends = starts[keep], ends[keep]
            inside = np.searchsorted(starts, stops)
        ids, lengths = self.words.joined(self.words.lookup(data, starts, ends)) if len(starts) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        until = np.concatenate([[0], np.cumsum(lengths)])[inside]
        before = 0
        for i, end in enumerate(until.tolist()):
            out[i] = ids[before:end]
            before = end
        if whole:
            order = sorted(whole)
            for i, e in zip(order, self.tokenizer.encode_batch_fast([texts[i] for i in order], add_special_tokens=False)):
                out[i] = np.array(e.ids, np.uint32)
        return out


def word_bounds(data, kind):
    """Where the vocabulary's pre-tokens start and end: letter runs, single digits, runs of other characters, and
    the short English endings after an apostrophe that opens a run."""
    before = np.concatenate([[SPACE], kind[:-1]]) if len(kind) else kind
    begins = (kind != SPACE) & ((kind != before) | (kind == DIGIT))
    marks = np.flatnonzero((data == 39) & begins)
    if len(marks):
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        one, two = padded[marks + 1], padded[marks + 2]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for chosen, size in ((marks[single], 2), (marks[double], 3)):
            begins[chosen + 1] = False
            after = chosen + size
            after = after[after < len(kind)]
            begins[after[kind[after] != SPACE]] = True
    starts = np.flatnonzero(begins)
    # A word ends where the next one starts or where white space does.
    stops = np.flatnonzero((kind == SPACE) & (before != SPACE)) if len(kind) else starts
    following = np.append(starts[1:], len(data))
    blank = np.append(stops, len(data))
    ends = np.minimum(following, blank[np.searchsorted(blank, starts)])
    return starts, ends


PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


def pieces(docs, path=None, capacity=2048, id_col="doc_id", text_col="text", with_ids=False):
    """The token pieces of each document: its ids and a closing 0, cut every ``capacity`` tokens.

    ``with_ids`` adds the ids themselves."""
    path = path or public_tokenizers.path(VOCABULARY)
    rows = with_nulls_as_text(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType
    schema = PIECES.format(id=id_type.simpleString()) + (", ids array<int>" if with_ids else "")

    def cut(batches):
        encoder = kept_in_worker(f"packing {path}", lambda: Encoder(path))
        for part, texts in slices(batches):
            row, index, start, length, crc, ids = [], [], [], [], [], []
            for i, tokens in enumerate(encoder.encode(texts)):
                tokens = np.append(tokens, np.uint32(0)).astype("<u4")
                for p, at in enumerate(range(0, len(tokens), capacity)):
                    own = tokens[at:at + capacity]
                    row.append(i), index.append(p), start.append(at), length.append(len(own)), crc.append(zlib.crc32(own))
                    if with_ids:
                        ids.append(own.astype(np.int32))
            columns = [part.column(0).take(pa.array(row, pa.int64())), pa.array(index, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(cut, schema)


# --- plan -------------------------------------------------------------------------------------

class OpenBins:
    """Segment tree over remaining capacities: which hold an open bin."""

    def __init__(self, capacity):
        self.size = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.size)

    def set(self, room, is_open):
        i = room + self.size
        self.any[i] = is_open
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, room):
        """The smallest remaining capacity of at least ``room`` that an open bin has, or None."""
        i = room + self.size
        while not self.any[i]:
            while i & 1:  # no open bin below this node: go on to the right
                i //= 2
            if i == 0:
                return None
            i += 1
        while i < self.size:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.size


def plan(counts, capacity):
    """Best-fit decreasing over {length: count}: rows (length, first number, pieces per bin, first bin, offset).

    Pieces of one length, by number from ``first number``, fill bins from ``first bin`` on, each bin taking
    ``pieces per bin`` of them from ``offset``. Bins of equal content are kept as ranges (first bin, how many).
    """
    tree, room, made, rows = OpenBins(capacity), {}, 0, []

    def put(left, first, many):
        if left:
            room.setdefault(left, []).append((first, many))
            tree.set(left, True)

    for length in sorted(counts, reverse=True):
        number, waiting = 0, counts[length]
        while waiting:
            left = tree.tightest(length)
            if left is None:
                per = capacity // length
                left, first, many, fresh = capacity, made, -(-waiting // per), True
                made += many
            else:
                per = left // length
                first, many = room[left].pop()
                if not room[left]:
                    tree.set(left, False)
                fresh = False
            full = min(many, waiting // per)
            if full:
                rows.append((length, number, per, first, capacity - left))
                number, waiting = number + full * per, waiting - full * per
                put(left - per * length, first, full)
            if full < many:
                if waiting and (waiting < per):
                    rows.append((length, number, waiting, first + full, capacity - left))
                    put(left - waiting * length, first + full, 1)
                    number, waiting, full = number + waiting, 0, full + 1
                if full < many and not fresh:
                    put(left, first + full, many - full)
    return rows, made


def pack(rows, capacity=2048):
    """``rows`` (any columns, with a long ``length`` of 1 to ``capacity``) with sequence_id and offset.

    ``rows`` must give the same rows each time it is read: pass a checkpoint or a stored table.
    """
    counts = {r["length"]: r["n"] for r in small(rows.groupBy("length").agg(F.count("*").alias("n")), capacity)}
    # A frequent length is numbered in as many groups as its count asks for.
    groups = F.array(*[F.lit(-(-counts.get(n, 0) // GROUP_ROWS) or 1) for n in range(capacity + 1)])
    spread = rows.withColumn("__seed", F.xxhash64(*[F.col("`" + c + "`") for c in rows.columns]))
    spread = spread.withColumn("__group", F.pmod("__seed", F.get(groups, F.col("length").cast("int"))).cast("int"))
    sizes = durable(spread.groupBy("length", "__group").agg(F.count("*").alias("n")))
    made, _ = plan(counts, capacity)
    # A group's numbers within its length start after those of the groups before it.
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1))
    begin = sizes.select("length", "__group", F.coalesce(earlier, F.lit(0)).alias("__begin"))
    inside = F.row_number().over(Window.partitionBy("length", "__group").orderBy("__seed"))
    numbered = spread.withColumn("__inside", inside).join(begin, ["length", "__group"])
    table = np.array(made, np.int64).reshape(-1, 5)
    order = np.lexsort((table[:, 1], table[:, 0]))
    table = table[order]
    keys = (table[:, 0] << 45) + table[:, 1]

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        n, num = length.to_numpy(np.int64), number.to_numpy(np.int64)
        at = table[np.searchsorted(keys, (n << 45) + num, side="right") - 1]
        ahead = num - at[:, 1]
        return pd.DataFrame({"sequence_id": at[:, 3] + ahead // at[:, 2], "offset": at[:, 4] + ahead % at[:, 2] * n})

    placed = numbered.withColumn("__place", place("length", F.col("__begin") + F.col("__inside") - 1))
    return placed.select(*rows.columns, "__place.sequence_id", "__place.offset")


def pack_documents(docs, capacity=2048, path=None, id_col="doc_id", text_col="text"):
    """Documents to placed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(durable(pieces(docs, path, capacity, id_col, text_col)), capacity)


def best_fit_decreasing(lengths, capacity):
    """The plain method, one piece at a time: remaining capacities of the bins. For small inputs and tests."""
    open_bins = []
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(open_bins, length)
        left = open_bins.pop(at) if at < len(open_bins) else capacity
        bisect.insort(open_bins, left - length)
    return open_bins

