"""Words of many texts at once, as numpy arrays over one buffer of UTF-8 bytes."""

from __future__ import annotations

import numpy as np

PAD = 16
WHITE = (9, 10, 11, 12, 13, 32)
LOW_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def loadable(buffer: np.ndarray) -> np.ndarray:
    """For each position of a buffer that ends in eight bytes of padding the eight bytes from there, as an integer."""
    return np.ndarray((len(buffer) - 8,), "<u8", np.ascontiguousarray(buffer), strides=(1,))


def span_hashes(eight: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, taken eight at a time."""
    result = mix(lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    active, done = np.arange(len(starts)), 0
    while len(active):
        rest = np.minimum(lengths[active] - done, 8)
        block = eight[starts[active] + done] & LOW_BYTES[rest]
        result[active] = mix(result[active] * np.uint64(0x9E3779B97F4A7C15) ^ block)
        done += 8
        active = active[lengths[active] > done]
    return result


def gathered(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The spans of ``pool``, one behind the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class SpanCache:
    """Ids of spans by a 64-bit key, up to ``limit`` spans: those that came first, as frequent ones mostly do."""

    def __init__(self, limit: int, dtype=np.int32):
        self.limit = limit
        self.keys = np.zeros(0, np.uint64)  # ascending
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, dtype)

    def resolve(self, keys: np.ndarray, produce) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and where those of each of the distinct ``keys`` start and how many they are.

        ``produce`` makes ids and counts for the indexes of keys that aren't held.
        """
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        held = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        missing = np.flatnonzero(~held)
        starts, lengths = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        starts[held], lengths[held] = self.starts[at[held]], self.lengths[at[held]]
        if not len(missing):
            return self.pool, starts, lengths
        ids, counts = produce(missing)
        pool = np.concatenate([self.pool, ids.astype(self.pool.dtype)])
        starts[missing], lengths[missing] = len(self.pool) + np.cumsum(counts) - counts, counts
        if len(self.keys) + len(missing) <= self.limit:
            order = missing[np.argsort(keys[missing])]
            where = np.searchsorted(self.keys, keys[order])
            self.keys = np.insert(self.keys, where, keys[order])
            self.starts = np.insert(self.starts, where, starts[order])
            self.lengths = np.insert(self.lengths, where, lengths[order])
            self.pool = pool
        return pool, starts, lengths


class Words:
    """Words of ``texts``: maximal runs of bytes other than ``separators``.

    ``starts`` and ``lengths`` hold byte positions in ``buffer``; text ``i`` has the
    words from ``bounds[i]`` to ``bounds[i + 1]``. None counts as an empty text.
    """

    def __init__(self, texts: list[bytes | None], separators=WHITE, lower: bool = True):
        texts = [t or b"" for t in texts]
        self.buffer = np.frombuffer(b"\n".join(texts) + b"\n" * PAD, np.uint8)
        if lower:
            fold = np.arange(256, dtype=np.uint8)
            fold[65:91] += 32
            self.buffer = fold[self.buffer]
        is_word = np.ones(256, bool)
        is_word[list(separators)] = False
        inside = is_word[self.buffer].view(np.int8)
        edges = np.flatnonzero(np.diff(inside, prepend=np.int8(0)))
        self.starts, self.lengths = edges[::2], edges[1::2] - edges[::2]
        text_starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.bounds = np.searchsorted(self.starts, text_starts)
        self.text_starts = text_starts
        self.eight = loadable(self.buffer)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.eight, self.starts, self.lengths)

    def prefixes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the words of at least ``size`` bytes (8 at most) and a hash of their beginnings."""
        which = np.flatnonzero(self.lengths >= size)
        return which, mix((self.eight[self.starts[which]] & LOW_BYTES[size]) ^ np.uint64(size << 56))

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
