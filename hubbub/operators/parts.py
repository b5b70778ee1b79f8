"""Which parts of texts may be words of a dictionary that is too large to send.

The tasks get a bitmap of the words' hashes, whose size is bounded whatever the dictionary holds. Every part of a text that has
the length of some word is hashed from running sums, all places together, and only parts whose bit is set travel to the join
with the dictionary, which is exact. Words beyond ``_LONG`` characters are looked for only where their first ``_LONG`` are.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hubbub.operators.blocks import BLOCK, Numbers, kinds_of_characters, stretches, tokens
from hubbub.operators.trie import code_points

_LONG = 64
# Bits of the bitmap for each word, so that few parts pass by chance, and of all: at most 16 MB.
_BITS_EACH, _FEWEST, _MOST = 512, 15, 27
# Bits in a row of the engine's bitmaps.
_ROW = 1 << 15
# Characters looked at together.
_SLICE = 1 << 19
# Different blocks of neighbouring texts that are kept in mind.
_SEEN = 1 << 20
# An odd number and its inverse modulo 2^64, and one that mixes.
_BASE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


class Powers:
    """Powers of the base and of its inverse, made once for as many characters as are looked at together."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n):
        if len(self.up) <= n:
            up, down = np.full(n + n // 4 + 1, _BASE, np.uint64), np.full(n + n // 4 + 1, _INVERSE, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up[:n], self.down


class Hashes:
    """Hashes of any part of a sequence of characters."""

    def __init__(self, codes, powers=None):
        up, self.down = (powers or Powers()).to(len(codes))
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes + 1).view(np.uint64) * up, out=self.sums[1:])

    def whole(self, starts, ends):
        h = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(_MIX)
        return (h ^ (h >> np.uint64(29))) * np.uint64(_MIX)

    def of(self, starts, ends, bits):
        """Places in a bitmap of 2^bits."""
        return (self.whole(starts, ends) >> np.uint64(64 - bits)).astype(np.int64)


def is_latin(codes):
    """Which characters are ASCII letters or digits."""
    return (codes < 128) & ((codes - 48 < 10) & (codes >= 48) | ((codes | 32) - 97 < 26) & ((codes | 32) >= 97))


def places(texts, bits):
    """The place of each whole text."""
    stops = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    return Hashes(code_points("".join(texts))).of(np.concatenate([[0], stops])[:-1], stops, bits)


def bitmap(words, bits):
    """The bits of a table's words, and of the beginnings of long ones, as bytes."""
    @F.arrow_udf("bigint")
    def place(column: pa.Array) -> pa.Array:
        return pa.array(places(column.to_pylist(), bits) + 1)

    both = F.explode(F.array(F.col("word"), F.substring("word", 1, _LONG)))
    at = words.select(both.alias("word")).distinct().select(place("word").alias("at"))
    rows = at.groupBy(F.bitmap_bucket_number("at").alias("row")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("own")).collect()  # bounded
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row, own in rows:
        out[(row - 1) * _ROW // 8:row * _ROW // 8] = np.frombuffer(own, np.uint8)
    return out


def likely(codes, lengths, hashes, known, bits, sizes, alone=False):
    """(starts, size) of the parts of blocks that may be words, for each size."""
    stops = np.cumsum(lengths)
    stop, block = np.repeat(stops, lengths), np.repeat(np.arange(len(lengths)), lengths)
    starts = np.arange(len(codes))
    if alone:
        letter = is_latin(codes)
        touched = np.concatenate([[False], letter[1:] & letter[:-1] & (block[1:] == block[:-1]), [False]])
        starts = starts[~touched[:-1]]

    def passing(starts, size, whole=True):
        if alone and whole:
            starts = starts[~touched[starts + size]]
        at = hashes.of(starts, starts + size, bits)
        return starts[known[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1]

    begun = False
    for size in sizes:
        if size > _LONG and not begun:
            begun, starts = True, starts[starts + _LONG <= stop[starts]]
            starts = passing(starts, _LONG, whole=False)
        # Sizes rise, so what has no room now has none later.
        starts = starts[starts + size <= stop[starts]]
        yield passing(starts, size), size


def parts_in(blocks, known, bits, sizes, alone):
    """For each of distinct blocks, its different parts that may be words."""
    text = "".join(blocks)
    codes, lengths = code_points(text), np.fromiter(map(len, blocks), np.int64, len(blocks))
    block, out = np.repeat(np.arange(len(blocks)), lengths), [set() for _ in blocks]
    for hits, size in likely(codes, lengths, Hashes(codes), known, bits, sizes, alone):
        for k, a in zip(block[hits].tolist(), hits.tolist()):
            out[k].add(text[a:a + size])
    return out


def _bitmap_of(words):
    """The bitmap of a table's words as a broadcast, its bits, and the words' lengths."""
    n, sizes = words.agg(F.count(F.lit(1)), F.sort_array(F.collect_set(F.char_length("word")))).first()
    bits = min(max((n * _BITS_EACH).bit_length(), _FEWEST), _MOST)
    return words.sparkSession.sparkContext.broadcast(bitmap(words, bits).tobytes()), bits, sizes


class Among:
    """The parts that may be words in the blocks of neighbouring texts, each one told once."""

    def __init__(self, known, bits, sizes):
        self.known, self.bits, self.sizes, self.kinds, self.powers, self.place = known, bits, sizes, kinds_of_characters(), Powers(), None

    def new_in(self, place, texts):
        if place != self.place or len(self.blocks) > _SEEN:
            # Told again at most.
            self.place, self.blocks, self.told = place, Numbers(), Numbers()
        stops = np.cumsum([len(t) if t else 0 for t in texts], dtype=np.int64)
        codes = code_points("".join(t for t in texts if t))
        starts, ends, _ = tokens(codes, stops, self.kinds)
        block = self.kinds[np.minimum(codes[starts], len(self.kinds) - 1)] == BLOCK
        starts, ends = starts[block], ends[block]
        hashes = Hashes(codes, self.powers).whole(starts, ends)
        new = np.flatnonzero(self.blocks.find(hashes) < 0)
        fresh, first = np.unique(hashes[new], return_index=True)
        self.blocks.put(fresh)
        starts, ends = starts[new[first]], ends[new[first]]
        codes = codes[stretches(starts, ends - starts)]
        hashes = Hashes(codes, self.powers)
        found = [(hits, hits + size) for hits, size in likely(codes, ends - starts, hashes, self.known, self.bits, self.sizes)]
        if not found:
            return []
        a, b = (np.concatenate(c) for c in zip(*found))
        fresh, first = np.unique(hashes.whole(a, b), return_index=True)
        new = self.told.find(fresh) < 0
        self.told.put(fresh[new])
        text = codes.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
        return [text[x:y] for x, y in zip(a[first[new]].tolist(), b[first[new]].tolist())]


def parts_near(rows, words):
    """(_near, word): the different parts of blocks in the ``text`` of rows with the same ``_near`` that may be words of ``words``.
    None is missing; where such rows do not follow one another, or are very many, a part may come again."""
    shared, bits, sizes = _bitmap_of(words)

    @F.arrow_udf("array<string>")
    def run(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        among = Among(np.frombuffer(shared.value, np.uint8), bits, sizes)
        for places, texts in columns:
            numbers, out, own, size = places.to_pylist(), [], [], 0
            for k, text in enumerate(texts.to_pylist()):
                own.append(text)
                size += len(text) if text else 0
                # The last of a slice gives what is new in it.
                last = size >= _SLICE or k + 1 == len(numbers) or numbers[k + 1] != numbers[k]
                out.append(among.new_in(numbers[k], own) if last else [])
                if last:
                    own, size = [], 0
            yield pa.array(out, pa.list_(pa.string()))

    # Not deterministic, because what it gives depends on the rows before.
    found = rows.withColumn("_parts", run.asNondeterministic()("_near", "text")).select("_near", F.explode_outer("_parts").alias("word"))
    return found.where(F.col("word").isNotNull())


def parts_like(rows, words, row_key, text="text", blocks=None, alone=False):
    """(row key, word): the different parts of each row's text that may be words of ``words``, none of which is missing.

    ``blocks`` is a compiled pattern of the stretches that words lie in. ``alone`` leaves out parts that begin or end
    inside a run of ASCII letters and digits."""
    shared, bits, sizes = _bitmap_of(words)

    @F.arrow_udf("array<string>")
    def run(texts: pa.Array) -> pa.Array:
        known, out, waiting, size = np.frombuffer(shared.value, np.uint8), [], [], 0

        def done():
            number = {}
            for own in waiting:
                for b in own:
                    number.setdefault(b, len(number))
            found = dict(zip(number, parts_in(list(number), known, bits, sizes, alone)))
            out.append(pa.array([list(set().union(*(found[b] for b in own))) for own in waiting], pa.list_(pa.string())))

        for one in texts:
            value = one.as_py() or ""
            waiting.append(set(blocks.findall(value)) if blocks else {value})
            size += len(value)
            if size >= _SLICE:
                done()
                waiting, size = [], 0
        done()
        return pa.concat_arrays(out)

    return rows.select(*row_key, F.explode(run(text)).alias("word"))
