"""SentencePiece encoding by merges, some of which a keyed hash skips, and decoding.

The vocabulary of a merge-type model is read from a file whose path is a
parameter. A text becomes its characters with a space before it; then the best
scored pair of neighbours that forms a piece is merged, the leftmost of equals,
until none is left. A candidate merge is skipped for good if a hash of the seed,
the document's id, the segment, its place in the text and the merge's place and
piece falls below ``alpha``: each occurrence of a segment draws for itself, a seed
always gives the same segmentation and another seed another one. What is no piece
in the end is written as byte pieces.

No piece holds a space behind another character, so segments from one run of
spaces to the next are encoded on their own: many short ones at once as arrays,
long ones by an agenda (a heap of candidates). Both give the same result. A task
remembers for a segment and the merges skipped in it which others are made and what
they lead to. An occurrence draws for the merges made; if some are skipped, it goes
on with the run without them, until none of a run's is. Only a merge that would be
made next has any effect, so this skips as if all candidates were drawn for.

Decoding is exact: the character that models show for a space is encoded as
bytes where the text has it. Defined cases: a null or empty text has no ids; rows
that repeat an id and a text have equal ids, as have equal texts without an id; an
empty table gives no rows.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from despacho.llm.arrow import chunks, fresh, text_bytes, without
from despacho.llm.words import PAD, gathered, loadable, mix, span_hashes

ALPHA = 0.1  # share of the candidate merges that are skipped
LONG = 48  # characters from which a segment goes to the agenda
KEPT = 1_500_000  # runs a task remembers
CHUNK_BYTES = 1 << 18  # text encoded at once: the arrays of its merges take some hundred bytes for each of its own
NEVER = np.iinfo(np.int64).max
SHOWN_SPACE = "▁"
STEP = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def mix_one(x: int) -> int:
    """``words.mix`` of one Python integer."""
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def candidate_codes(start: np.ndarray, end: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """A hash of the place and piece of each candidate merge."""
    place = (start.astype(np.uint64) << np.uint64(42)) ^ (end.astype(np.uint64) << np.uint64(21)) ^ piece.astype(np.uint64)
    return mix(place * np.uint64(STEP))


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id as bytes with plain spaces, and every pair of pieces that forms a third."""

    piece_bytes: list[bytes]
    byte_ids: np.ndarray  # id of the piece of each byte
    chars: np.ndarray  # code points that are pieces, ascending
    char_ids: np.ndarray
    pair_keys: np.ndarray  # left id * size + right id, ascending
    pair_ids: np.ndarray
    pair_ranks: np.ndarray  # 0 for the best score

    @cached_property
    def pool(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(p) for p in self.piece_bytes])
        return np.frombuffer(b"".join(self.piece_bytes), np.uint8), np.cumsum(lengths) - lengths, lengths

    @cached_property
    def pairs(self) -> dict[int, tuple[int, int]]:
        return {k: (r, i) for k, r, i in zip(self.pair_keys.tolist(), self.pair_ranks.tolist(), self.pair_ids.tolist())}

    @cached_property
    def hashed(self) -> tuple[np.ndarray, np.uint64, int]:
        """Indexes of the pairs by a hash of their keys (-1: none), the shift of the hash, and the most slots one is off its own."""
        bits = max(int(len(self.pair_keys)).bit_length() + 3, 8)
        shift = np.uint64(64 - bits)
        slots = ((self.pair_keys.astype(np.uint64) * np.uint64(STEP)) >> shift).astype(np.int64)
        table = np.full((1 << bits) + len(slots) + 2, -1, np.int32)
        left, step = np.arange(len(slots)), 0
        while len(left):
            # Of those that want a free slot one gets it; the others look one further.
            at = slots[left] + step
            free = table[at] < 0
            table[at[free]] = left[free]
            left = left[table[at] != left]
            step += 1
        return table, shift, step

    def find_pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the piece that each pair forms; NEVER and 0 if none. Characters that are no piece are -1."""
        keys = np.where((left >= 0) & (right >= 0), left * len(self.piece_bytes) + right, -1)
        table, shift, most = self.hashed
        slot = ((keys.astype(np.uint64) * np.uint64(STEP)) >> shift).astype(np.int64)
        found = table[slot]
        hit = self.pair_keys[found] == keys
        open_ = np.flatnonzero(~hit & (found >= 0))
        for step in range(1, most + 1):
            if not len(open_):
                break
            now = table[slot[open_] + step]
            same = (now >= 0) & (self.pair_keys[now] == keys[open_])
            found[open_[same]], hit[open_[same]] = now[same], True
            open_ = open_[~same & (now >= 0)]
        hit &= found >= 0
        return np.where(hit, self.pair_ranks[found], NEVER), np.where(hit, self.pair_ids[found], 0)

    def initial(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        return np.where(self.chars[at] == points, self.char_ids[at], -1)


def load_vocabulary(path: str) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    normal = {}
    byte_ids = np.full(256, -1)
    piece_bytes = []
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value] = i
            piece_bytes.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i):
            piece_bytes.append(b"")
        else:
            normal[piece] = i
            piece_bytes.append(piece.replace(SHOWN_SPACE, " ").encode())
    if (byte_ids < 0).any():
        raise ValueError("the model needs a piece for every byte")
    if any(SHOWN_SPACE in p.lstrip(SHOWN_SPACE) for p in normal):
        raise ValueError("pieces with a space behind another character are not supported")
    scores = sorted({model.get_score(i) for i in normal.values()}, reverse=True)
    rank = {s: r for r, s in enumerate(scores)}
    found = sorted(
        (normal[p[:cut]] * size + normal[p[cut:]], i, rank[model.get_score(i)])
        for p, i in normal.items()
        for cut in range(1, len(p))
        if p[:cut] in normal and p[cut:] in normal
    )
    keys, ids, ranks = (np.array(x, np.int64) for x in zip(*found))
    chars = sorted((32 if p == SHOWN_SPACE else ord(p), i) for p, i in normal.items() if len(p) == 1)
    points, char_ids = (np.array(x, np.int64) for x in zip(*chars))
    return Vocabulary(piece_bytes, byte_ids, points, char_ids, keys, ids, ranks)


class Runs:
    """Runs by a 64-bit key, up to ``limit``: those that came first.

    A run stands in ``pool`` as the number of its merges, that of its ids, the
    merges' codes and the ids.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.keys, self.starts = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # ascending keys
        self.pool, self.used = np.zeros(1 << 16, np.uint64), 0

    def resolve(self, keys: np.ndarray, produce) -> np.ndarray:
        """Where in the pool the run of each of the distinct, ascending ``keys`` starts, until the next call.

        ``produce`` makes the runs for the indexes of keys that aren't held, one
        behind the other, and their lengths.
        """
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        held = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        starts = np.zeros(len(keys), np.int64)
        starts[held] = self.starts[at[held]]
        missing = np.flatnonzero(~held)
        if len(missing):
            runs, lengths = produce(missing)
            end = self.used + len(runs)
            if end > len(self.pool):
                # Zeros that nothing is written to take no memory.
                grown = np.zeros(end + self.used // 2, np.uint64)
                grown[: self.used] = self.pool[: self.used]
                self.pool = grown
            self.pool[self.used : end] = runs
            starts[missing] = self.used + np.cumsum(lengths) - lengths
            kept = max(min(len(missing), self.limit - len(self.keys)), 0)
            if kept:
                where = np.searchsorted(self.keys, keys[missing[:kept]])
                self.keys = np.insert(self.keys, where, keys[missing[:kept]])
                self.starts = np.insert(self.starts, where, starts[missing[:kept]])
                self.used += int(lengths[:kept].sum())
        return starts


@dataclass
class Encoder:
    vocabulary: Vocabulary
    alpha: float = ALPHA
    seed: int = 0
    cache: Runs = field(default_factory=lambda: Runs(KEPT))

    @property
    def bar(self) -> int:
        return int(self.alpha * (1 << 53))

    def _skipped(self, key: np.ndarray, code: np.ndarray) -> np.ndarray:
        return (mix(key ^ code) >> np.uint64(11)).astype(np.int64) < self.bar

    def _skipped_one(self, key: int, start: int, end: int, piece: int) -> bool:
        place = ((start << 42) ^ (end << 21) ^ piece) & MASK
        return mix_one(key ^ mix_one((place * STEP) & MASK)) >> 11 < self.bar

    def agenda(self, text: str, key: int) -> list[tuple[int, int, int]]:
        """(start, end, id) of the final symbols of one segment."""
        symbols = self.vocabulary.initial(text).tolist()
        n, size, pairs = len(symbols), len(self.vocabulary.piece_bytes), self.vocabulary.pairs
        ends, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(left: int) -> None:
            if left < 0 or after[left] >= n:
                return
            right = after[left]
            if symbols[left] < 0 or symbols[right] < 0:
                return
            merge = pairs.get(symbols[left] * size + symbols[right])
            if merge and not self._skipped_one(key, left, ends[right], merge[1]):
                heapq.heappush(heap, (merge[0], left, ends[right], merge[1]))

        for i in range(n - 1):
            offer(i)
        gone = [False] * n
        while heap:
            _, left, end, piece = heapq.heappop(heap)
            if gone[left] or after[left] >= n:
                continue
            right = after[left]
            if ends[right] != end or pairs.get(symbols[left] * size + symbols[right], (0, -1))[1] != piece:
                continue
            symbols[left], ends[left], gone[right] = piece, end, True
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return [(i, ends[i], symbols[i]) for i in range(n) if not gone[i]]

    def _rounds(self, symbols: np.ndarray, words: np.ndarray, starts: np.ndarray, skipped, made: list | None = None):
        """Final (word, start, end, id) arrays of short segments: in each round every segment makes its best merge.

        ``skipped`` tells of words and codes of candidates which are; words and codes of the merges made go to ``made``.
        """
        ends = starts + 1
        done = []

        def offers(left: np.ndarray):
            rank, piece = self.vocabulary.find_pairs(symbols[left], symbols[left + 1])
            rank[words[left] != words[left + 1]] = NEVER
            live = np.flatnonzero(rank != NEVER)
            i = left[live]
            code = candidate_codes(starts[i], ends[i + 1], piece[live])
            rank[live[skipped(words[i], code)]] = NEVER
            return rank, piece

        ranks, pieces = np.full(len(symbols), NEVER), np.zeros(len(symbols), np.int64)
        if len(symbols) > 1:
            ranks[:-1], pieces[:-1] = offers(np.arange(len(symbols) - 1))
        while len(symbols):
            heads = np.flatnonzero(np.diff(words, prepend=-1))
            best = np.minimum.reduceat(ranks, heads)
            size = np.diff(np.append(heads, len(words)))
            finished = np.repeat(best == NEVER, size)
            if finished.any():
                done.append((words[finished], starts[finished], ends[finished], symbols[finished]))
                stay = ~finished
                symbols, words, starts, ends, ranks, pieces = (x[stay] for x in (symbols, words, starts, ends, ranks, pieces))
                size, best = size[best != NEVER], best[best != NEVER]
                if not len(symbols):
                    break
                heads = np.cumsum(size) - size
            # The leftmost of the best candidates of each segment.
            hits = np.flatnonzero(ranks == np.repeat(best, size))
            at = hits[np.flatnonzero(np.diff(words[hits], prepend=-1))]
            if made is not None:
                made.append((words[at], candidate_codes(starts[at], ends[at + 1], pieces[at])))
            symbols[at], ends[at] = pieces[at], ends[at + 1]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            at = at - np.arange(len(at))
            symbols, words, starts, ends, ranks, pieces = (x[stay] for x in (symbols, words, starts, ends, ranks, pieces))
            ranks[at] = NEVER
            changed = np.concatenate([at[at + 1 < len(symbols)], at[at > 0] - 1])
            ranks[changed], pieces[changed] = offers(changed)
        if not done:
            return [np.zeros(0, np.int64)] * 4
        word, start, end, symbol = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return word[order], start[order], end[order], symbol[order]

    def _short(self, strings: list[str], skipped, made: list | None = None):
        """``_rounds`` of short segments."""
        symbols = self.vocabulary.initial("".join(strings))
        lengths = np.array([len(s) for s in strings], np.int64)
        words = np.repeat(np.arange(len(strings)), lengths)
        starts = np.arange(len(symbols)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return self._rounds(symbols, words, starts, skipped, made)

    def _spelt(self, strings: list[str], word, start, end, symbol) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each segment; characters that are no piece are written as bytes."""
        unknown = np.flatnonzero(symbol < 0)
        if not len(unknown):
            return symbol.astype(np.int32), np.bincount(word, minlength=len(strings))
        as_bytes = [strings[word[i]][start[i] : end[i]].encode() for i in unknown]
        counts = np.ones(len(symbol), np.int64)
        counts[unknown] = [len(b) for b in as_bytes]
        ids = np.repeat(symbol, counts)
        ids[ids < 0] = self.vocabulary.byte_ids[np.frombuffer(b"".join(as_bytes), np.uint8)]
        return ids.astype(np.int32), np.bincount(np.repeat(word, counts), minlength=len(strings))

    def segments(self, texts: list[bytes], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every segment, one behind the other, and how many each has; all by themselves, nothing is remembered."""
        strings = [t.decode() for t in texts]
        sizes = np.array([len(s) for s in strings], np.int64)
        short = np.flatnonzero(sizes <= LONG)
        of_short = keys[short]
        word, start, end, symbol = self._short([strings[i] for i in short], lambda w, code: self._skipped(of_short[w], code))
        word = short[word]
        long = [(i, *found) for i in np.flatnonzero(sizes > LONG) for found in self.agenda(strings[i], int(keys[i]))]
        if long:
            more = np.array(long, np.int64)
            word, start, end, symbol = (np.concatenate([x, more[:, k]]) for k, x in enumerate((word, start, end, symbol)))
            order = np.lexsort((start, word))
            word, start, end, symbol = word[order], start[order], end[order], symbol[order]
        return self._spelt(strings, word, start, end, symbol)

    def _runs_without(self, texts: list[bytes], own: np.ndarray, gone_word: np.ndarray, gone_code: np.ndarray):
        """The runs, as ``Runs`` has them, of short segments that skip just those merges, and their lengths."""
        strings = [t.decode() for t in texts]
        salt = mix(np.arange(1, len(texts) + 1).astype(np.uint64) * np.uint64(STEP))
        gone = np.sort(salt[gone_word] ^ gone_code)

        def skipped(word, code):
            result = np.zeros(len(word), bool)
            if len(gone):
                # Those to be skipped are among those that ``own`` draws.
                drawn = np.flatnonzero(self._skipped(own[word], code))
                codes = salt[word[drawn]] ^ code[drawn]
                result[drawn] = gone[np.minimum(np.searchsorted(gone, codes), len(gone) - 1)] == codes
            return result

        made: list = []
        ids, n_ids = self._spelt(strings, *self._short(strings, skipped, made))
        word, code = (np.concatenate(x) for x in zip(*made)) if made else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        code = code[np.argsort(word, kind="stable")]
        n_made = np.bincount(word, minlength=len(texts))
        lengths = 2 + n_made + n_ids
        starts = np.cumsum(lengths) - lengths
        runs = np.zeros(int(lengths.sum()), np.uint64)
        runs[starts], runs[starts + 1] = n_made, n_ids
        runs[np.repeat(starts + 2 - (np.cumsum(n_made) - n_made), n_made) + np.arange(len(code))] = code
        runs[np.repeat(starts + 2 + n_made - (np.cumsum(n_ids) - n_ids), n_ids) + np.arange(len(ids))] = ids
        return runs, lengths

    def _remembered(self, joined: bytes, starts: np.ndarray, lengths: np.ndarray, spans: np.ndarray, own: np.ndarray):
        """Ids of short segments, one behind the other in an order of their own; from where they go, and how many they are."""
        states = spans.copy()
        open_ = np.arange(len(starts))
        gone_at, gone_code = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        flats, from_, sizes, total = [], np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), 0
        while len(open_):
            unique, first, inverse = np.unique(states[open_], return_index=True, return_inverse=True)

            def produce(missing):
                which = open_[first[missing]]
                number = np.full(len(starts), -1)
                number[which] = np.arange(len(which))
                word = number[gone_at]
                texts = [joined[s : s + n] for s, n in zip(starts[which].tolist(), lengths[which].tolist())]
                return self._runs_without(texts, own[which], word[word >= 0], gone_code[word >= 0])

            run = self.cache.resolve(unique, produce)[inverse]
            pool = self.cache.pool
            n_made, n_ids = pool[run].astype(np.int64), pool[run + 1].astype(np.int64)
            at = np.zeros(0, np.int64)
            if self.bar:
                at = np.repeat(np.arange(len(open_)), n_made)
                code = gathered(pool, run + 2, n_made)
                hit = np.flatnonzero(self._skipped(own[open_[at]], code))
                at, code = at[hit], code[hit]
                np.add.at(states, open_[at], mix(code))
                gone_at, gone_code = np.concatenate([gone_at, open_[at]]), np.concatenate([gone_code, code])
            over = np.ones(len(open_), bool)
            over[at] = False
            ready = open_[over]
            sizes[ready] = n_ids[over]
            from_[ready] = total + np.cumsum(n_ids[over]) - n_ids[over]
            flats.append(gathered(pool, run[over] + 2 + n_made[over], n_ids[over]).astype(np.int32))
            total += len(flats[-1])
            open_ = open_[~over]
        return np.concatenate([np.zeros(0, np.int32), *flats]), from_, sizes

    def encode(self, texts: list[bytes | None], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and from where to where each text's go; ``keys`` tell the documents apart."""
        # A space goes before each text that isn't empty.
        spaced = [b" " + t if t else b"" for t in texts]
        sizes = np.array([len(t) for t in spaced], np.int64)
        text_starts = np.cumsum(sizes) - sizes
        joined = b"".join(spaced)
        buffer = np.frombuffer(joined + bytes(PAD), np.uint8)
        space = buffer[: len(joined)] == 32
        begins = space & ~np.concatenate([[False], space[:-1]]) if len(joined) else space
        begins[text_starts[sizes > 0]] = True
        starts = np.flatnonzero(begins)
        lengths = np.diff(np.append(starts, len(joined)))
        owner = np.searchsorted(text_starts, starts, side="right") - 1
        # Empty texts share their start with the text behind them, which is the last of equals.
        salt = mix(np.array(keys, np.int64).astype(np.uint64) + np.uint64((self.seed * STEP) & MASK))
        spans = span_hashes(loadable(buffer), starts, lengths)
        place = (starts - text_starts[owner]).astype(np.uint64)
        own = mix(spans ^ mix(salt[owner] + place * np.uint64(STEP)))
        chars = np.concatenate([[0], np.cumsum((buffer[: len(joined)] & 0xC0) != 0x80)])
        is_long = chars[starts + lengths] - chars[starts] > LONG
        short, long = np.flatnonzero(~is_long), np.flatnonzero(is_long)
        from_, size = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        flat, from_[short], size[short] = self._remembered(joined, starts[short], lengths[short], spans[short], own[short])
        if len(long):
            ids, counts = self.segments([joined[s : s + n] for s, n in zip(starts[long].tolist(), lengths[long].tolist())], own[long])
            from_[long], size[long] = len(flat) + np.cumsum(counts) - counts, counts
            flat = np.concatenate([flat, ids])
        per_text = np.bincount(owner, size, minlength=len(texts)).astype(np.int64)
        return gathered(flat, from_, size), np.concatenate([[0], np.cumsum(per_text)])

    def encode_checked(self, texts: list[bytes | None], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``; a text that doesn't decode to itself (two segments with one hash) is encoded anew by itself."""
        flat, bounds = self.encode(texts, keys)
        decoded = decode(self.vocabulary, flat, bounds)
        wrong = [i for i, t in enumerate(texts) if decoded[i] != (t or b"")]
        if not wrong:
            return flat, bounds
        parts = [flat[s:e] for s, e in zip(bounds[:-1], bounds[1:])]
        for i in wrong:
            alone = Encoder(self.vocabulary, self.alpha, self.seed)
            parts[i] = alone.encode([texts[i]], [keys[i]])[0]
        return np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])


def decode(vocabulary: Vocabulary, flat: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The text of each run of ids, without the space that was put before it."""
    pool, starts, lengths = vocabulary.pool
    sizes = lengths[flat]
    data = gathered(pool, starts[flat], sizes).tobytes()
    ends = np.concatenate([[0], np.cumsum(sizes)])[bounds]
    return [data[s + 1 : e] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]


def encoded(docs: DataFrame, model: str, seed: int = 0, alpha: float = ALPHA, key: str = "doc_id") -> DataFrame:
    """The documents with ``ids`` and whether these decode to the text as ``lossless``; columns so named give way."""
    vocabulary = load_vocabulary(model)
    kept = without(docs, ["ids", "lossless"])
    own, hidden = fresh(docs, "own"), fresh(docs, "text_")
    # Rows without an id draw by their text.
    by = [F.lit(seed), F.col(key), F.when(F.col(key).isNull(), F.col("text"))]
    # The text travels once: under its own name if the rows keep it.
    texts_as = next((c for c in kept if c.lower() == "text"), hidden)
    source = docs.select(
        *[f"`{c}`" for c in kept],
        F.xxhash64(*by).alias(own),
        *([] if texts_as in kept else [F.col("text").alias(hidden)]),
    )
    schema = StructType([docs.schema[c] for c in kept] + StructType.fromDDL("ids array<int>, lossless boolean").fields)

    def run(batches):
        encoder = Encoder(vocabulary, alpha, seed)
        for batch in chunks(batches, texts_as, CHUNK_BYTES):
            texts = text_bytes(batch, texts_as)
            flat, bounds = encoder.encode_checked(texts, batch.column(own).to_pylist())
            same = [a == (b or b"") for a, b in zip(decode(vocabulary, flat, bounds), texts)]
            ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), ids, pa.array(same)], schema.names)

    return source.mapInArrow(run, schema)


def decoded(rows: DataFrame, model: str, into: str = "text") -> DataFrame:
    """The rows with the text of their ``ids``; a column named ``into`` gives way. Null ids give a null text."""
    vocabulary = load_vocabulary(model)
    kept = without(rows, [into])
    schema = StructType([rows.schema[c] for c in kept] + StructType.fromDDL(f"`{into}` string").fields)

    def run(batches):
        for batch in batches:
            texts = []
            for ids in batch.column("ids"):
                flat = np.array(ids.as_py() or [], np.int64)
                texts.append(decode(vocabulary, flat, np.array([0, len(flat)]))[0].decode() if ids.is_valid else None)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], schema.names)

    return rows.select(*[f"`{c}`" for c in kept]).mapInArrow(run, schema)


def document_pieces(docs: DataFrame, model: str) -> DataFrame:
    rows = encoded(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "lossless")
