"""Words of many texts at once: found, hashed and looked up as arrays, so only new words reach the tokenizer."""

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h):
    """Spread 64-bit values over all bits (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class Powers:
    """Powers of an odd number and of its inverse, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n):
        if len(self.up) < n:
            m = max(n, 2 * len(self.up))
            factors = np.full(m, ODD, np.uint64)
            factors[0] = 1
            self.up = np.multiply.accumulate(factors)
            factors[1:] = INVERSE
            self.down = np.multiply.accumulate(factors)
        return self.up[:n], self.down


def hash_spans(powers, data, starts, ends):
    """64-bit hash of each data[start:end], from one running sum over the bytes."""
    up, down = powers.to(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up, out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64))


class WordTable:
    """Numbers of known words by hash, with the ids of each. Forgets everything when full, so memory is bounded."""

    def __init__(self, encode, words=1 << 20):
        self.encode, self.limit, self.bits, self.powers = encode, words, (2 * words - 1).bit_length(), Powers()
        self.clear()

    def clear(self):
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.numbers = np.full(1 << self.bits, -1, np.int32)
        self.count, self.used = 0, 0
        self.offsets, self.lengths = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)
        self.ids = np.zeros(1 << 14, np.uint32)

    def find(self, hashes):
        """Word numbers, -1 where unknown."""
        mask = np.int64((1 << self.bits) - 1)
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        found = self.numbers[slot]
        wrong = np.flatnonzero((found >= 0) & (self.keys[slot] != hashes))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & mask
            found[wrong] = self.numbers[slot[wrong]]
            wrong = wrong[(found[wrong] >= 0) & (self.keys[slot[wrong]] != hashes[wrong])]
        return found

    def add(self, hashes, words):
        """Enter new words under distinct hashes."""
        ids = self.encode(words)
        lengths = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.fromiter((x for w in ids for x in w), np.uint32, int(lengths.sum()))
        n, used = self.count + len(words), self.used + len(flat)
        if n > len(self.offsets):
            self.offsets = np.resize(self.offsets, 2 * n)
            self.lengths = np.resize(self.lengths, 2 * n)
        if used > len(self.ids):
            self.ids = np.resize(self.ids, 2 * used)
        self.offsets[self.count:n] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.count:n] = lengths
        self.ids[self.used:used] = flat
        mask = np.int64((1 << self.bits) - 1)
        slot, waiting, numbers = (hashes >> np.uint64(64 - self.bits)).astype(np.int64), np.arange(len(words)), np.arange(self.count, n, dtype=np.int32)
        while len(waiting):
            free = waiting[self.numbers[slot[waiting]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.numbers[slot[put]] = hashes[put], numbers[put]
            waiting = np.setdiff1d(waiting, put, assume_unique=True)
            taken = waiting[self.keys[slot[waiting]] != hashes[waiting]]
            slot[taken] = (slot[taken] + 1) & mask
        self.count, self.used = n, used

    def lookup(self, data, starts, ends):
        """Word number of each data[start:end]."""
        hashes = hash_spans(self.powers, data, starts, ends)
        found = self.find(hashes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            if self.count + len(new) > self.limit:
                if self.count:
                    self.clear()
                    return self.lookup(data, starts, ends)
                self.bits = (4 * len(new) - 1).bit_length()
                self.limit = 2 * len(new)
                self.clear()
            at, raw = missing[first], data.tobytes()
            self.add(new, [raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            found[missing] = self.find(hashes[missing])
        return found

    def joined(self, numbers):
        """The ids of a sequence of words, one after another, and each word's count."""
        lengths = self.lengths[numbers].astype(np.int64)
        ends = np.cumsum(lengths)
        at = np.repeat(self.offsets[numbers] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        return self.ids[at], lengths
