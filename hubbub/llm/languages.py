"""Language of a text: words first, shorter and shorter character n-grams for words never seen.

A word that the training texts hold scores each language by the negative decimal logarithm of its frequency there, or
``PENALTY`` where the language lacks it. A word that no language holds backs off to its n-grams of ``ORDERS`` characters (a
blank on either side of the word), or of fewer until one of them is known in some language, and scores the mean over its
known ones. The language with the lowest mean over the text's words is predicted.

Counts cover all training texts: words are counted in the tasks that read them and added up by a shuffle of one row for
each word of a task; n-grams are counted from the words. The model keeps the most frequent words and n-grams, as many of each
order and language as share out ``ENTRIES``, so what is sent to the tasks has a fixed size whatever the corpus; frequencies
are of all that was counted. Words are runs of letters and marks that hold a letter, lower-cased; a run of more than ``LONGEST``
characters is taken in pieces of that length, so whole texts count and no key grows. The words of a slice of text are found
and hashed (64 bits) as arrays; each worker looks only at words it has not met, in a table of bounded size.

Defined results: a text that is null or without a letter is ``und`` with score 0, as is every text when nothing was
learned. Rows whose id is null are not held out and not learned from; null languages are not learned; an empty one is a
language like others. Ties go to the smallest language. Repeated rows are learned and scored each. Empty tables give
no rows. Only the named columns are read, so others cannot clash.

The score is the best language's share when each language weighs 10 to the minus its mean, so it does not grow with the text.
"""

import collections
import itertools
import unicodedata
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from hubbub.llm.shared import column, durable, kept_in_worker, slices, small
from hubbub.llm.wordtable import WordTable
from hubbub.session import kept_in_worker as kept_for_model

ORDERS, LONGEST, PENALTY, FOLDS = 5, 40, 7.0, 5
ENTRIES, MAX_LANGUAGES = 600_000, 10_000
# Words a task's table holds, partial counts it holds, scores it keeps, parts that a language's units are first ranked in.
TABLE_WORDS, HELD, SCORES, PARTS = 1 << 20, 1 << 20, 1 << 22, 16
UNKNOWN = "und"
MARK, LETTER = 1, 2


def letter_table():
    """For each code point: 2 for a letter, 1 for a mark, 0 for others."""
    return np.array([{"L": LETTER, "M": MARK}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


def kinds(data):
    """The code of every byte of UTF-8 text: that of the character it belongs to."""
    table = kept_in_worker("letter table", letter_table)
    kind = table[:256][data] * (data < 128)
    lead = np.flatnonzero(data >= 0xC0)
    size = 2 + (data[lead] >= 0xE0).astype(int) + (data[lead] >= 0xF0)
    point = data[lead].astype(np.int64) & (0xFF >> (size + 1))
    for k in range(1, 4):
        more = size > k
        point[more] = point[more] << 6 | data[lead[more] + k] & 0x3F
    own = table[np.minimum(point, 0x10FFFF)]
    kind[lead] = own
    for k in range(1, 4):
        kind[lead[size > k] + k] = own[size > k]
    return kind


def word_spans(texts):
    """(bytes, starts, ends, number of the text) of all words of the texts, those of one text in a row."""
    data = np.frombuffer("\0".join([*(t.replace("\0", " ") for t in texts), ""]).lower().encode("utf-8", "replace"), np.uint8)
    kind = kinds(data)
    inside = (kind > 0).astype(np.int8)
    edge = np.diff(inside, prepend=0, append=0)
    starts, ends = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
    letters = np.concatenate([[0], np.cumsum(kind == LETTER)])
    real = letters[ends] > letters[starts]
    starts, ends = starts[real], ends[real]
    long = np.flatnonzero(ends - starts > LONGEST)
    if len(long):
        cuts = [list(itertools.accumulate((len(word[a:a + LONGEST].encode()) for a in range(0, len(word), LONGEST)), initial=s))
                for s, word in ((s, bytes(data[s:e]).decode()) for s, e in zip(starts[long].tolist(), ends[long].tolist()))]
        starts = np.sort(np.concatenate([np.delete(starts, long), *[c[:-1] for c in cuts]]))
        ends = np.sort(np.concatenate([np.delete(ends, long), *[c[1:] for c in cuts]]))
    return data, starts, ends, np.searchsorted(np.flatnonzero(data == 0), starts)


def held_out(id_column):
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(FOLDS)) == 0


# --- training -----------------------------------------------------------------------------------

class Counts(WordTable):
    """Counts of (language, word); what no longer fits is set out."""

    def __init__(self):
        self.words, self.keys_, self.times, self.languages, self.out = [], [], [], {}, []
        super().__init__(self.number, TABLE_WORDS)

    def number(self, words):
        self.words += words
        return [()] * len(words)

    def clear(self):
        self.set_out()
        self.words = []
        super().clear()

    def pooled(self):
        if self.keys_:
            keys, to = np.unique(np.concatenate(self.keys_), return_inverse=True)
            self.keys_, self.times = [keys], [np.bincount(to, np.concatenate(self.times)).astype(np.int64)]

    def set_out(self):
        self.pooled()
        if self.keys_:
            names, keys = list(self.languages), self.keys_[0]
            self.out.append(pa.RecordBatch.from_arrays([
                pa.array([names[k] for k in (keys >> 32).tolist()]), pa.array([self.words[k].decode() for k in (keys & 0xFFFFFFFF).tolist()]), pa.array(self.times[0]),
            ], ["lang", "unit", "n"]))
        self.keys_, self.times = [], []

    def add_texts(self, languages, texts):
        data, starts, ends, text = word_spans(texts)
        if len(starts):
            language = np.array([self.languages.setdefault(l, len(self.languages)) for l in languages], np.int64)
            keys, times = np.unique(language[text] << 32 | self.lookup(data, starts, ends), return_counts=True)
            self.keys_.append(keys)
            self.times.append(times)
            if sum(map(len, self.keys_)) > HELD:
                self.pooled()
                if len(self.keys_[0]) > HELD // 2:
                    self.set_out()

    def taken(self):
        out, self.out = self.out, []
        return out


def counted_words(rows):
    """(lang, unit, n): each word of the texts of ``rows`` (lang, text)."""
    def run(batches):
        counts = Counts()
        for part, texts in slices(batches):
            counts.add_texts(part.column(0).to_pylist(), texts)
            yield from counts.taken()
        counts.set_out()
        yield from counts.taken()

    return rows.mapInArrow(run, "lang string, unit string, n long").groupBy("lang", "unit").agg(F.sum("n").alias("n"))


def grams(word, size):
    padded = f" {word} "
    return [padded[i:i + size] for i in range(len(padded) - size + 1)]


def counted_grams(words):
    """(lang, size, unit, n): the n-grams of all words, ``size`` being their number of characters."""
    def run(batches):
        held, size = {}, 0

        def out():
            for lang, own in held.items():
                keys = list(own)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(list(map(len, keys)), pa.int32()), pa.array(keys), pa.array(list(own.values()), pa.int64())], ["lang", "size", "unit", "n"])

        for batch in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                own = held.setdefault(lang, collections.defaultdict(int))
                size -= len(own)
                for length in range(1, ORDERS + 1):
                    for g in grams(word, length):
                        own[g] += n
                size += len(own)
                if size > HELD:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    return words.select("lang", "unit", "n").mapInArrow(run, "lang string, size int, unit string, n long").groupBy("lang", "size", "unit").agg(F.sum("n").alias("n"))


def fit(docs, id_col="doc_id", text_col="text", lang_col="lang", entries=ENTRIES):
    """Learn from the rows that are not held out and name their language.

    A model is (languages in order; for each size, 0 being words, the numbers of the units; where each unit's lines start;
    each line's language and value): plain values of bounded size."""
    rows = docs.where(~held_out(column(docs, id_col))).select(column(docs, lang_col).cast("string").alias("lang"), column(docs, text_col).alias("text"))
    words = durable(counted_words(rows.where("lang is not null and text is not null")))
    counted = durable(words.select("lang", F.lit(0).alias("size"), "unit", "n").union(counted_grams(words)))
    totals = small(counted.groupBy("lang", "size").agg(F.sum("n").alias("n")), MAX_LANGUAGES * (ORDERS + 1))
    languages = sorted({r["lang"] for r in totals})
    total = {(r["lang"], r["size"]): r["n"] for r in totals}
    keep = max(1, entries // ((ORDERS + 1) * max(1, len(languages))))
    # Ranked in parts first, so that a language with most of the rows is not sorted by one task.
    part = F.pmod(F.xxhash64("unit"), F.lit(PARTS))
    among = Window.partitionBy("lang", "size", part).orderBy(F.desc("n"), "unit")
    overall = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "unit")
    best = counted.withColumn("rank", F.row_number().over(among)).where(F.col("rank") <= keep)
    best = best.withColumn("rank", F.row_number().over(overall)).where(F.col("rank") <= keep)
    got = best.select("size", "unit", "lang", "n").toArrow().to_pydict()  # at most ``entries`` rows
    lines = sorted(zip(got["size"], got["unit"], got["lang"], got["n"]))
    numbers, start, number_of = [{} for _ in range(ORDERS + 1)], [], {l: k for k, l in enumerate(languages)}
    for at, (size, unit, _, _) in enumerate(lines):
        if unit not in numbers[size]:
            numbers[size][unit] = len(start)
            start.append(at)
    share = np.array([n / total[lang, size] for size, _, lang, n in lines])
    return languages, numbers, np.array([*start, len(lines)]), np.array([number_of[l] for _, _, l, _ in lines], np.int64), -np.log10(share) if len(share) else share


# --- prediction -------------------------------------------------------------------------------

class Scorer(WordTable):
    """Scores words once, as long as the table holds them."""

    def __init__(self, model):
        self.languages, self.numbers_of, self.start, self.language, self.value = model
        self.scores = np.zeros((0, len(self.languages)))
        super().__init__(self.score, max(1 << 12, min(TABLE_WORDS, SCORES // max(1, len(self.languages)))))

    def clear(self):
        self.scores = self.scores[:0]
        super().clear()

    def score(self, words):
        """Add the scores of new words: their own values, or the mean of the longest known n-grams'."""
        row, unit, hits = [], [], np.ones(len(words))
        for k, word in enumerate(words):
            word = word.decode()
            at = self.numbers_of[0].get(word)
            found = [at] if at is not None else next(filter(None, ([known[g] for g in grams(word, size) if g in known] for size, known in zip(range(ORDERS, 0, -1), self.numbers_of[:0:-1]))), [])
            row += [k] * len(found)
            unit += found
            hits[k] = max(1, len(found))
        row, unit, many = np.array(row, np.int64), np.array(unit, np.int64), len(self.languages)
        lines = self.start[unit + 1] - self.start[unit]
        at = np.repeat(self.start[unit] - np.cumsum(lines) + lines, lines) + np.arange(lines.sum())
        less = np.bincount(np.repeat(row, lines) * many + self.language[at], self.value[at] - PENALTY, minlength=len(words) * many)
        self.scores = np.concatenate([self.scores, PENALTY + less.reshape(len(words), many) / hits[:, None]])
        return [()] * len(words)

    def predict(self, texts):
        """(languages, scores) of the texts."""
        data, starts, ends, text = word_spans(texts)
        if not len(starts) or not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        words = np.bincount(text, minlength=len(texts))
        number = self.lookup(data, starts, ends)
        mean = np.stack([np.bincount(text, self.scores[number, l], minlength=len(texts)) for l in range(len(self.languages))]) / np.maximum(words, 1)
        best = mean.argmin(axis=0)
        share = 1 / (10.0 ** (mean.min(axis=0) - mean)).sum(axis=0)
        return [self.languages[b] if n else UNKNOWN for b, n in zip(best.tolist(), words.tolist())], np.where(words > 0, share, 0.0)


def predict(docs, model, id_col="doc_id", text_col="text"):
    """doc_id, held_out, lang_pred, score of every row."""
    rows = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    sent, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches):
        scorer = kept_for_model(("language scorer", key), lambda: Scorer(sent.value))
        for part, texts in slices(batches):
            languages, scores = scorer.predict(texts)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(languages, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    scored = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


def identify(docs, id_col="doc_id", text_col="text", lang_col="lang"):
    """Learn from the rows not held out, then predict every row."""
    return predict(docs, fit(docs, id_col, text_col, lang_col), id_col, text_col)
