"""Dictionary word segmentation: the most probable path through the dictionary words of a sentence."""

import re
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hubbub.operators.blocks import BLOCK_SET, Grown, Numbers, kinds_of_characters, stretches, tokens
from hubbub.operators.joins import fits_broadcast
from hubbub.operators.parts import Hashes, Powers, is_latin, parts_near
from hubbub.operators.trie import Trie, code_points
from hubbub.session import durable, in_slices, kept_in_worker

_TAGGED = "array<struct<word:string,pos:string>>"

# Han characters, and Latin or digit runs.
_HAN_FIRST, _HAN_LAST = ord("一"), ord("鿕")
_HAN = re.compile(r"([一-鿕]+)")
_RUN = re.compile(r"([a-zA-Z0-9]+(?:\.\d+)?%?)")
_OUTSIDE = re.compile(f"[^{BLOCK_SET}]")
# Blocks and their words remembered by a worker, about 32 and 8 bytes each; longer blocks are cut each time.
_REMEMBERED, _SHORT = 1 << 21, 64
# Characters looked at together, up to the end of a block: few enough for a core's own cache.
_WINDOW = 1 << 18
# Rows that are neighbours, as a power of two, and words of earlier neighbours that a task keeps.
_NEAR_BITS, _LISTED = 10, 1 << 17
# A word of a block in one number: its kind of tag, and its length below.
_LENGTH_BITS = 32


class Dictionary:
    """Word weights and tags over a trie. Each different block of a text is cut once and remembered, by 64-bit hash.

    Words of a block follow one another without gaps, so a block's cut is the lengths of its words and their kinds of tag."""

    def __init__(self, rows, log_total=None, before=None):
        """``before`` is a dictionary that holds all words that stand in the blocks it remembers, with the same weights and tags."""
        own = {word: (max(weight or 1.0, 1.0), tag) for word, weight, tag in rows}
        log_total = log(sum(weight for weight, _ in own.values()) or 1.0) if log_total is None else log_total
        self.trie, self.loose = Trie(list(own)), -log_total
        self.scores = np.array([log(weight) - log_total for weight, _ in own.values()])
        self.tags = {word: tag for word, (_, tag) in own.items() if tag}
        # Kind 0 is that of words without a tag.
        self.kinds = before.kinds if before else {}
        self.kind = np.array([self.kinds.setdefault(tag, len(self.kinds) + 1) if tag else 0 for _, tag in own.values()], np.int64)
        self.spoken, self.every, self.powers = kinds_of_characters(), kinds_of_characters(breaks=""), Powers()
        self.forget()
        if before:
            self.numbers, self.cuts, self.words = before.numbers, before.cuts, before.words

    def forget(self):
        """``cuts`` holds where the words of each remembered block begin in ``words``, and how many they are."""
        self.numbers, self.cuts, self.words = Numbers(), Grown(np.int64), Grown(np.int64)

    def cut(self, sentence):
        """Words of a sentence: dictionary words on the most probable path.

        Characters in no dictionary word stay single, but Latin and digit runs are kept whole;
        characters that cannot be part of a word stand alone.
        """
        return self.pieces([sentence], self.every)[0].to_pylist()

    def tag(self, word, default):
        return self.tags.get(word, default)

    def tagged(self, texts, default):
        """Words and tags of each text's sentences, as Arrow lists."""
        words, kinds, _, counts = self.pieces(texts, self.spoken)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        tags = pa.array([default, *self.kinds], pa.string()).take(pa.array(kinds))
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([words, tags], ["word", "pos"]))

    def pieces(self, texts, characters):
        """(words, kinds, sizes, counts): the words of all texts one after another as an Arrow array, the kind and the number of
        characters of each, and how many each text has."""
        stops = np.cumsum([len(t) if t else 0 for t in texts], dtype=np.int64)
        text, done, counts, at = "".join(t for t in texts if t), [], np.zeros(len(texts), np.int64), 0
        while at < len(text) or not done:
            stop = _OUTSIDE.search(text, at + _WINDOW) if at + _WINDOW < len(text) else None
            end = stop.end() if stop else len(text)
            *own, few = self.window(text[at:end], np.clip(stops - at, 0, end - at), characters)
            done.append(own)
            counts += few
            at = end
        words, kinds, sizes = zip(*done)
        return pa.concat_arrays(words), np.concatenate(kinds), np.concatenate(sizes), counts

    def window(self, text, stops, characters):
        """As ``pieces``, for texts that end at ``stops``."""
        codes = code_points(text)
        starts, ends, kept = tokens(codes, stops, characters)
        number = self.numbered(codes, starts, ends)
        cut = self.cuts.own[number]
        begin, count = cut >> _LENGTH_BITS, cut & ((1 << _LENGTH_BITS) - 1)
        words = self.words.own[stretches(begin, count)]
        sizes = words & ((1 << _LENGTH_BITS) - 1)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        if text.isascii():
            data = np.frombuffer(text.encode(), np.uint8)[kept]
        else:
            codes = codes[kept]
            more = (codes >= 0x80).view(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
            offsets += np.concatenate([[0], np.cumsum(more, dtype=np.int32)])[offsets]
            data = codes.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass").encode()
        spoken = pa.StringArray.from_buffers(len(words), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
        before = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(starts, stops)]
        return spoken, words >> _LENGTH_BITS, sizes, np.diff(before, prepend=0)

    def numbered(self, codes, starts, ends):
        """The place in ``cuts`` of the words of each token."""
        sizes = ends - starts
        hashes = Hashes(codes, self.powers).whole(starts, ends)
        short = sizes <= _SHORT
        number = np.where(short, self.numbers.find(hashes), -1).astype(np.int64)
        new = np.flatnonzero(number < 0)
        if not len(new):
            return number
        long = new[~short[new]]
        new = new[short[new]]
        fresh, first, place = np.unique(hashes[new], return_index=True, return_inverse=True)
        some = np.concatenate([new[first], long])
        lengths = sizes[some]
        count, words = self.cut_blocks(codes[stretches(starts[some], lengths)], lengths)
        short_words = int(count[:len(fresh)].sum())
        if len(self.cuts) + len(self.words) + len(fresh) + short_words <= _REMEMBERED:
            keep = (len(fresh), short_words)
            self.numbers.put(fresh)
        elif len(self.cuts):
            # Numbers given before mean nothing afterwards.
            self.forget()
            return self.numbered(codes, starts, ends)
        else:
            keep = (0, 0)
        at = len(self.cuts)
        number[new], number[long] = at + place, at + len(fresh) + np.arange(len(long))
        self.cuts.put((len(self.words) + np.cumsum(count) - count) << _LENGTH_BITS | count, keep[0])
        self.words.put(words, keep[1])
        return number

    def cut_blocks(self, codes, sizes):
        """How many words each block has, and all of them: dictionary words on the best path, and between them Latin and digit
        runs, single Han characters and stretches of other ones."""
        best, (start, end, word) = self.best_ends(codes, sizes)
        stops = np.cumsum(sizes)
        begins = stops - sizes
        begun = np.zeros(len(codes) + 1, bool)
        begun[begins] = True
        on_path, at = np.zeros(len(codes), bool), begins
        while len(at):
            on_path[at] = True
            at = best[at]
            at = at[~begun[at] & (at < len(codes))]  # a path ends where the next block begins
        alone = on_path & (best - np.arange(len(codes)) == 1)
        first = on_path & ~alone
        # Characters on their own that follow one another, of one kind, are one word.
        goes_on = alone.copy()
        goes_on[1:] &= alone[:-1] & ~begun[1:-1]
        goes_on[:1] = False
        han, latin = (codes >= _HAN_FIRST) & (codes <= _HAN_LAST), is_latin(codes)
        same = goes_on & ~han
        same[1:] &= ~han[:-1] & (latin[1:] == latin[:-1])
        first |= alone & ~same
        # Numbers with a point or a percent sign are told apart one by one.
        digit, after = (codes >= 48) & (codes < 58), np.append(goes_on[1:], False)
        marked = goes_on & ((codes == ord("%")) | (codes == ord(".")) & after & np.append(digit[1:], False))
        marked[1:] &= latin[:-1]
        if marked.any():
            heads = np.flatnonzero(alone & ~goes_on)
            for head in np.unique(heads[np.searchsorted(heads, np.flatnonzero(marked), side="right") - 1]).tolist():
                tail = head + 1
                while tail < len(codes) and goes_on[tail]:
                    tail += 1
                first[head:tail] = False
                for part in _loose_parts("".join(map(chr, codes[head:tail].tolist()))):
                    first[head] = True
                    head += len(part)
        starts = np.flatnonzero(first)
        length = np.diff(starts, append=len(codes))
        kind = np.zeros(len(starts), np.int64)
        if len(start):
            keys, asked = start << _LENGTH_BITS | end, starts << _LENGTH_BITS | starts + length
            at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            kind = np.where(keys[at] == asked, self.kind[word[at]], 0)
        count = np.diff(np.searchsorted(starts, np.append(begins, len(codes))))
        return count, kind << _LENGTH_BITS | length

    def best_ends(self, codes, sizes):
        """For each place, the end of the first word on the best path to its block's end, and all words (start, end, number).

        Paths are found from the ends backwards, one place of all blocks at a time. Of equal paths the longest word wins."""
        stop = np.cumsum(sizes)
        best = np.arange(1, len(codes) + 1)
        found = start, end, word = self.trie.matches(codes, np.repeat(stop, sizes))
        if not len(start):
            return best, found
        # Each block has one more place, behind its last character.
        shift = np.repeat(np.arange(len(sizes)), sizes)
        path = np.zeros(len(codes) + len(sizes))
        left = np.repeat(stop, sizes)[start] - start
        order = np.lexsort((end, start, left))
        start, end, score, left = start[order], end[order], self.scores[word[order]], left[order]
        by_size = np.argsort(-sizes, kind="stable")
        longest = sizes[by_size]
        for k in range(1, int(longest[0]) + 1):
            at = stop[by_size[:np.searchsorted(-longest, -k, side="right")]] - k
            path[at + shift[at]] = self.loose + path[at + shift[at] + 1]
            a, b = np.searchsorted(left, [k, k + 1])
            if a < b:
                own, to = start[a:b], end[a:b]
                ways = score[a:b] + path[to + shift[own]]
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                most = np.maximum.reduceat(ways, first)
                group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(own))))
                last = np.zeros(len(first), np.int64)
                top = np.flatnonzero(ways == most[group])
                last[group[top]] = top  # ends rise, so the longest is kept
                at, better = own[first], most >= path[own[first] + shift[own[first]]]
                path[at[better] + shift[at[better]]], best[at[better]] = most[better], to[last[better]]
        return best, found


def _loose_parts(text):
    for part in _HAN.split(text):
        if _HAN.match(part):
            yield from part
        else:
            yield from (p for p in _RUN.split(part) if p)


def one_per_word(lexicon):
    """One row per word, before any way of using the dictionary: the largest weight, and its last tag in order."""
    weight = F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(1.0)), F.lit(1.0))
    rows = lexicon.where(F.col("word") != "").groupBy("word").agg(F.max(F.struct(weight.alias("weight"), "tag")).alias("e"))
    return rows.select("word", "e.weight", "e.tag")


def segment(units, lexicon=None, keys=("article_url",), default_tag="x", small=None):
    """Add ``tagged``: the (word, pos) pairs of each text unit, sentence by sentence.

    A dictionary measured as small is sent to every worker once. A larger one never leaves the
    executors: parts of neighbouring texts that may be words by length and hash are joined to it, and the
    matches feed the same path search where these texts are. Either way gives the same rows.
    """
    if lexicon is None:
        return _by_broadcast(units, [], default_tag)
    lexicon = one_per_word(lexicon)
    if small is None:
        small = fits_broadcast(lexicon)
    if small:
        return _by_broadcast(units, collected(lexicon), default_tag)
    numbered = durable(units.withColumn("_row", F.monotonically_increasing_id()))
    return by_join(numbered, lexicon, default_tag).drop("_row")


def collected(lexicon):
    return [tuple(r) for r in lexicon.collect()]  # measured before


def known_words(shared):
    """The dictionary of broadcast rows, built once per worker process. Plain rows travel, so workers need no package."""
    return kept_in_worker(("dictionary", id(shared.value)), lambda: (shared.value, Dictionary(shared.value)))[1]


def _by_broadcast(units, rows, default_tag):
    shared = units.sparkSession.sparkContext.broadcast(rows)

    @F.arrow_udf(_TAGGED)
    def run(texts: pa.Array) -> pa.Array:
        return in_slices(texts, lambda part: known_words(shared).tagged(part.to_pylist(), default_tag))

    return units.withColumn("tagged", run("text"))


class Nearby:
    """The dictionary words that stand in some neighbouring texts, told before these texts come."""

    def __init__(self, log_total):
        self.log_total, self.place, self.rows, self.known, self.new = log_total, None, {}, None, True

    def learn(self, place, words, weights, tags):
        # All words of a new place come with it, and cuts that are remembered stay right, so the others may go.
        if place != self.place and len(self.rows) > _LISTED:
            self.rows = {}
        before = len(self.rows)
        self.rows.update(zip(words, zip(weights, tags)))
        self.place, self.new = place, self.new or len(self.rows) > before

    def dictionary(self):
        if self.new:
            self.known, self.new = Dictionary([(w, *row) for w, row in self.rows.items()], self.log_total, self.known), False
        return self.known


def by_join(units, lexicon, default_tag):
    """As ``segment``, for a stored table of units, whose ``_row`` rises in each of its partitions.

    Texts whose ``_row`` lies in the same range are neighbours. The words found among them travel to them as rows, once for all
    of them, and stand before them in one task."""
    log_total = log(lexicon.agg(F.sum("weight")).first()[0] or 1.0)
    near = F.shiftright("_row", _NEAR_BITS).alias("_near")
    found = parts_near(units.select(near, "text"), lexicon).join(lexicon, "word")
    none = lambda name: F.lit(None).cast(units.schema[name].dataType).alias(name)
    words = found.select(*[F.col("word").alias("text") if c == "text" else none(c) for c in units.columns], "_near", "weight", "tag", F.lit(True))
    said = units.select("*", near, *[F.lit(None).cast(lexicon.schema[c].dataType).alias(f"_{c}") for c in ("weight", "tag")], F.lit(False).alias("_listed"))
    rows = said.union(words).repartition("_near").sortWithinPartitions("_near", F.desc("_listed"))

    @F.arrow_udf(_TAGGED)
    def run(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        nearby = Nearby(log_total)
        for texts, places, listed, weights, tags in columns:
            places, listed, out = places.to_numpy(), listed.to_numpy(zero_copy_only=False), []
            edges = np.flatnonzero((places[1:] != places[:-1]) | (listed[1:] != listed[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(places)]):
                own = texts.slice(a, b - a)
                if b > a and listed[a]:
                    nearby.learn(places[a], *(c.slice(a, b - a).to_pylist() for c in (texts, weights, tags)))
                    own = pa.nulls(b - a, pa.string())
                out.append(in_slices(own, lambda part: nearby.dictionary().tagged(part.to_pylist(), default_tag)))
            yield pa.concat_arrays(out)

    # Not deterministic, because what it gives depends on the rows before: no filter may pass below it.
    tagged = run.asNondeterministic()("text", "_near", "_listed", "_weight", "_tag")
    return rows.withColumn("tagged", tagged).where(~F.col("_listed")).select(*units.columns, "tagged")


def estimated(units, lexicon, small=None):
    """The dictionary with weights from a corpus: how often each word stands on the best path while all weigh the same.

    Words are counted before they move, so a frequent one costs one row per task."""
    cut = segment(units, lexicon.withColumn("weight", F.lit(1.0)), small=small)
    found = cut.select(F.explode_outer(words()).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("_n"))
    weight = F.greatest(F.coalesce("_n", F.lit(1)), F.lit(1)).cast("double")
    return lexicon.drop("weight").join(found, "word", "left").withColumn("weight", weight).drop("_n")


def words(tagged="tagged"):
    return F.transform(F.col(tagged), lambda t: t["word"])
