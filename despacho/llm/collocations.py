"""Phrase collocations, counted on a prefix-free parse of the corpus.

Texts fall into pieces at punctuation and pieces into words. Each piece is parsed
into chunks: a chunk begins where a piece does or where the hash of the next words
(one fewer than the longest phrase has) is a multiple of ``ONE_IN``, and reaches
over all those words of the chunk behind it. Where a chunk begins depends on those
words alone, so what repeats in the corpus is parsed alike, and the parse is a
dictionary of distinct chunks, each with its frequency. A phrase is counted in the
chunk in which it begins, weighted with that chunk's frequency; one that begins in
an overlap is left to the chunk that the overlap begins, so every occurrence counts
once. No phrase reaches beyond its chunk.

Words are counted first. Rare phrases are kept out by counting hashes of the pairs of
frequent words: a hash counts for all pairs that have it, so no frequent pair is
missed. The last pass counts phrases themselves, by their texts: pairs that may be
frequent, and longer phrases all of whose pairs may be. What a pass knows of the one
before it is a bit table of at most ``MOST_BITS``, which may let more phrases through;
these are counted and dropped, and the result is the same.

Defined cases: a null text is empty, a null language is ``und``; repeated rows and
ids count each; a language without a frequent phrase gives no rows, nor does an
empty table; further columns are not read. A text fits into a task's memory.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from despacho.llm.arrow import chunks, text_bytes, written
from despacho.llm.words import LOW_BYTES, PAD, Words, gathered, loadable, mix

BLANKS = (9, 32)
BREAKS = (10, 11, 12, 13, *b".,;:!?")
LONGEST = 4  # words of a phrase
ONE_IN = 16  # windows of words begin a chunk
BATCH_BYTES = 2 << 20
MOST_BITS = 1 << 28  # 32 MB
BITS_EACH = 16
RANGE = 500_000  # pairs of a range of hashes, at most
HELD = 1_000_000  # pairs that a task holds before it deals them out
UNKNOWN = "und"

CHUNKS = "lang string, chunk string, own int, n long"
COUNTS = "lang string, phrase string, n long"
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each word on; the last ones run short."""
    result = hashes.copy()
    for j in range(1, size):
        result[: len(hashes) - j] = mix(result[: len(hashes) - j] * FACTOR ^ hashes[j:])
    return result


def _array(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Texts that stand one behind the other."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(data))


def _strings(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return _array(gathered(pool, starts, lengths), lengths)


def _summed(keys: dict[str, pa.Array], amounts: np.ndarray) -> pa.RecordBatch:
    """One row for each key with the sum of its amounts, as a batch with the column ``n`` behind the keys."""
    table = pa.table({**keys, "n": pa.array(amounts.astype(np.int64))})
    table = table.group_by(list(keys), use_threads=False).aggregate([("n", "sum")])
    table = table.rename_columns([c.removesuffix("_sum") for c in table.column_names]).select([*keys, "n"])
    return table.combine_chunks().to_batches()[0] if table.num_rows else pa.RecordBatch.from_pylist([], table.schema)


def parse(texts: list[bytes | None], longest: int = LONGEST) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The chunks of some texts: for each its text's number, its words with single spaces and a line end, and how many are its own."""
    words = Words(texts, BLANKS + BREAKS)
    count, overlap = len(words.starts), longest - 1
    if not count:
        return np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, np.int32)
    is_break = np.zeros(256, bool)
    is_break[list(BREAKS)] = True
    piece = np.cumsum(is_break[words.buffer])[words.starts]
    opens = np.diff(piece, prepend=-1) != 0
    piece_ends = np.append(np.flatnonzero(opens)[1:], count)[np.cumsum(opens) - 1]
    begins = opens
    if overlap:
        window = np.arange(count) + overlap <= piece_ends
        begins = opens | window & (_grams(words.hashes(), overlap) % np.uint64(ONE_IN) == 0)
    first = np.flatnonzero(begins)
    own_ends = np.append(first[1:], count)
    ends = np.minimum(own_ends + overlap, piece_ends[first])
    pool = gathered(words.buffer, words.starts, words.lengths + 1)
    at = np.cumsum(words.lengths + 1)
    pool[at - 1] = 32  # whatever stood behind a word
    starts = (at - words.lengths - 1)[first]
    lengths = at[ends - 1] - starts
    data = gathered(pool, starts, lengths)
    data[np.cumsum(lengths) - 1] = 10
    return words.text_of_word()[first], _array(data, lengths), (own_ends - first).astype(np.int32)


def dictionary(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Distinct chunks (lang, chunk, own, n) of documents (lang, text): the first ``own`` words begin phrases, ``n`` is the frequency."""

    def run(batches):
        for batch in chunks(batches, "text", BATCH_BYTES):
            text, chunk, own = parse(text_bytes(batch, "text"), longest)
            keys = {"lang": batch.column("lang").take(pa.array(text)), "chunk": chunk, "own": pa.array(own)}
            yield _summed(keys, np.ones(len(own)))

    known = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    return known.mapInArrow(run, CHUNKS).groupBy("lang", "chunk", "own").agg(F.sum("n").alias("n"))


def _merged(batches, column: str, limit: int):
    """Small batches joined up to ``limit`` bytes of text, so that more repeats meet in one; large ones cut."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= limit:
            yield from chunks(pa.Table.from_batches(held).combine_chunks().to_batches(), column, limit)
            held, size = [], 0
    if held:
        yield from chunks(pa.Table.from_batches(held).combine_chunks().to_batches(), column, limit)


class LineWords(Words):
    """Words of a column of texts that have single spaces and end with a line end each."""

    def __init__(self, lines: pa.StringArray):
        offsets = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset : lines.offset + len(lines) + 1].astype(np.int64)
        data = np.frombuffer(lines.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        self.buffer = np.concatenate([data, np.full(PAD, 10, np.uint8)])
        ends = np.flatnonzero((data == 32) | (data == 10))
        self.starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        self.lengths = ends - self.starts
        self.text_starts = offsets - offsets[0]
        self.bounds = np.searchsorted(self.starts, self.text_starts)
        self.eight = loadable(self.buffer)


def _word_hashes(words: Words, langs: pa.Array) -> np.ndarray:
    """Hashes of words with their texts' language."""
    langs = langs.dictionary_encode()
    digests = [hashlib.blake2b(s.as_py().encode(), digest_size=8).digest() for s in langs.dictionary]
    of_lang = np.frombuffer(b"".join(digests), np.uint64)[langs.indices.to_numpy(zero_copy_only=False)]
    return mix(words.hashes() ^ np.repeat(of_lang, np.diff(words.bounds)))


def _equal_spans(words: Words, some: np.ndarray, others: np.ndarray) -> bool:
    """Whether the words ``some`` are, byte by byte, the words ``others``."""
    lengths = words.lengths[some]
    if not np.array_equal(lengths, words.lengths[others]):
        return False
    a, b, done = words.starts[some], words.starts[others], 0
    while len(a):
        mask = LOW_BYTES[np.minimum(lengths - done, 8)]
        if ((words.eight[a + done] ^ words.eight[b + done]) & mask).any():
            return False
        done += 8
        longer = lengths > done
        a, b, lengths = a[longer], b[longer], lengths[longer]
    return True


class BitTable:
    """A set of hashes as bits: what was put in is found, and little else if it is large enough."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(size - 1)
        return hashes & mask, mix(hashes) & mask

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in self.places(hashes, 64 * len(self.bits)):
            found &= (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0
        return found


def bit_table(hashes: DataFrame) -> BitTable:
    """The bit table of a column ``hash``."""
    bits = 1 << 12
    while bits < min(MOST_BITS, BITS_EACH * hashes.count()):
        bits *= 2

    def run(batches):
        for batch in batches:
            place = np.concatenate(BitTable.places(batch.column("hash").to_numpy().view(np.uint64), bits))
            values = (np.uint64(1) << (place & np.uint64(63))).view(np.int64)
            slots = (place >> np.uint64(6)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(values)], ["slot", "bits"])

    # One row for each 64 bits of a table of bounded size.
    slots = hashes.select("hash").mapInArrow(run, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    rows = slots.toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[rows.column("slot").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return BitTable(table)


class Grams:
    """The phrases of a batch of chunks: words, hashes, and the pairs of words that a table holds."""

    def __init__(self, batch: pa.RecordBatch):
        self.batch, self.words = batch, LineWords(batch.column("chunk"))
        self.hashes = _word_hashes(self.words, batch.column("lang"))
        self.count, self.row = len(self.words.starts), self.words.text_of_word()
        self.at, self.ends = np.arange(self.count), self.words.bounds[self.row + 1]
        self.begins = self.at - self.words.bounds[self.row] < batch.column("own").to_numpy()[self.row]
        self.n = batch.column("n").to_numpy()

    def starts_of(self, size: int, part: int = 0, held: np.ndarray | None = None) -> np.ndarray:
        """Where phrases of ``size`` words begin all of whose parts of ``part`` words are held."""
        takes = self.begins & (self.at + size <= self.ends)
        for j in range(size - part + 1 if part else 0):
            takes[: self.count - j] &= held[j:]
        return np.flatnonzero(takes)

    def counts(self, first: np.ndarray, size: int) -> pa.RecordBatch:
        """The phrases of ``size`` words from ``first`` on, as (lang, phrase, n)."""
        last = first + size - 1
        starts, ends = self.words.starts[first], self.words.starts[last] + self.words.lengths[last]
        row = self.row[first]
        keys = {"lang": self.batch.column("lang").take(pa.array(row)), "phrase": _strings(self.words.buffer, starts, ends - starts)}
        return _summed(keys, self.n[row])

    def word_counts(self) -> pa.RecordBatch:
        """All words, as (lang, phrase, n)."""
        first = self.starts_of(1)
        _, one, which = np.unique(self.hashes[first], return_index=True, return_inverse=True)
        one, row = first[one], self.row[first]
        langs = self.batch.column("lang").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        if not np.array_equal(langs[row], langs[self.row[one]][which]) or not _equal_spans(self.words, first, one[which]):
            return self.counts(first, 1)  # two words of one hash
        sums = np.zeros(len(one), np.int64)
        np.add.at(sums, which, self.n[row])
        texts = _strings(self.words.buffer, self.words.starts[one], self.words.lengths[one])
        return pa.RecordBatch.from_arrays([self.batch.column("lang").take(pa.array(self.row[one])), texts, pa.array(sums)], ["lang", "phrase", "n"])


def _batches(batches):
    return map(Grams, _merged(batches, "chunk", BATCH_BYTES))


def frequent_words(chunked: DataFrame, least: int) -> DataFrame:
    """Words (lang, phrase, n) that occur ``least`` times."""

    def run(batches):
        for grams in _batches(batches):
            yield grams.word_counts()

    counts = chunked.mapInArrow(run, COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least)


def word_table(words: DataFrame) -> BitTable:
    """The bit table of words (lang, phrase)."""

    def run(batches):
        for batch in batches:
            hashes = _word_hashes(LineWords(batch.column("line")), batch.column("lang"))
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], ["hash"])

    lines = words.select("lang", F.concat("phrase", F.lit("\n")).alias("line"))
    return bit_table(lines.mapInArrow(run, "hash long"))


def _sums(hashes: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes, ascending, and the sum of each one's amounts."""
    order = np.argsort(hashes)
    hashes, amounts = hashes[order], amounts[order]
    first = np.flatnonzero(np.diff(hashes, prepend=hashes[:1] + np.uint64(1))) if len(hashes) else np.zeros(0, np.int64)
    return hashes[first], np.add.reduceat(amounts, first) if len(first) else amounts[:0]


def pair_table(chunked: DataFrame, n_words: int, least: int, words: BitTable) -> BitTable:
    """A table that holds all pairs of held words that occur ``least`` times.

    Hashes are dealt into ranges of so many pairs at most; what a task finds of a range
    is one row, and a range is summed up at once.
    """
    ranges = max(1, -(-n_words // RANGE))
    shared = chunked.sparkSession.sparkContext.broadcast(words.bits)

    def dealt_out(parts):
        hashes, sums = _sums(*map(np.concatenate, zip(*parts)))
        of = (hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
        found, low = np.unique(of, return_index=True)
        bounds = list(zip(low.tolist(), [*low[1:].tolist(), len(of)]))
        columns = [pa.array([values[a:b].tobytes() for a, b in bounds], pa.binary()) for values in (hashes, sums)]
        return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), *columns], ["range", "hashes", "sums"])

    def find(batches):
        held, size = [], 0
        for grams in _batches(batches):
            first = grams.starts_of(2, 1, BitTable(shared.value).holds(grams.hashes))
            held.append((_grams(grams.hashes, 2)[first], grams.n[grams.row[first]]))
            size += len(first)
            if size >= HELD:
                yield dealt_out(held)
                held, size = [], 0
        if held:
            yield dealt_out(held)

    def add(batches):
        held, hashes, sums = None, [], []

        def frequent():
            found, total = _sums(np.concatenate(hashes), np.concatenate(sums))
            return pa.RecordBatch.from_arrays([pa.array(found[total >= least].view(np.int64))], ["hash"])

        for batch in batches:
            for number, some, amounts in zip(*(batch.column(c).to_pylist() for c in ("range", "hashes", "sums"))):
                if held != number:
                    if hashes:
                        yield frequent()
                    held, hashes, sums = number, [], []
                hashes.append(np.frombuffer(some, np.uint64))
                sums.append(np.frombuffer(amounts, np.int64))
        if hashes:
            yield frequent()

    dealt = chunked.mapInArrow(find, "range long, hashes binary, sums binary").repartition("range").sortWithinPartitions("range")
    return bit_table(written(dealt.mapInArrow(add, "hash long"), "pairs"))


def frequent_longer(chunked: DataFrame, longest: int, least: int, pairs: BitTable) -> DataFrame:
    """Phrases of two words and more (lang, phrase, n) that occur ``least`` times; ``pairs`` holds all such pairs."""
    shared = chunked.sparkSession.sparkContext.broadcast(pairs.bits)

    def run(batches):
        for grams in _batches(batches):
            held = BitTable(shared.value).holds(_grams(grams.hashes, 2)) & (grams.at + 2 <= grams.ends)
            for size in range(2, longest + 1):
                yield grams.counts(grams.starts_of(size, 2, held), size)

    counts = chunked.mapInArrow(run, COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least)


def frequent_phrases(docs: DataFrame, least: int, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """All phrases (lang, phrase, n, size) that occur ``least`` times, and all words (lang, n) of each language."""
    chunked = written(dictionary(docs, longest), "parse")
    totals = chunked.groupBy("lang").agg(F.sum(F.col("own") * F.col("n")).alias("n"))
    found = written(frequent_words(chunked, least), "phrases")
    if longest > 1:
        words = chunked.agg(F.sum("own")).head()[0] or 0
        pairs = pair_table(chunked, words, least, word_table(found))
        found = found.unionAll(written(frequent_longer(chunked, longest, least, pairs), "phrases"))
    return found.withColumn("size", F.size(F.split("phrase", " "))), totals


def _exact(value: Column, factor: int) -> Column:
    return value.cast("decimal(20,0)") * F.lit(factor).cast("decimal(8,0)")


def _part(first: Column | int, count: Column | int) -> Column:
    return F.array_join(F.slice("words", first, count), " ")


SCALE = 2_000_000


def scored(found: DataFrame) -> DataFrame:
    """Phrases of two words and more with their lowest-scoring cut: a, l, r, score and the words before the cut."""
    words = F.split("phrase", " ").alias("words")
    longer = found.filter("size > 1").select("lang", "phrase", F.col("n").alias("a"), "size", words)
    cuts = longer.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "size", "k", _part(F.lit(1), F.col("k")).alias("head"), _part(F.col("k") + 1, F.col("size")).alias("tail")
    )
    # A part of a phrase occurs as often as the phrase at least, so it is among those found.
    for part, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(found.select("lang", F.col("phrase").alias(part), F.col("n").alias(name)), ["lang", part])
    sums = F.col("l").cast("decimal(20,0)") + F.col("r").cast("decimal(20,0)")
    cuts = cuts.withColumn("product", _exact(F.col("a"), SCALE)).withColumn("sums", sums)
    cuts = cuts.withColumn("score", F.expr("product div sums"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "a", "size").agg(best).select("lang", "phrase", "a", "size", "best.*")


def not_within_longer(candidates: DataFrame, percent: int) -> DataFrame:
    """Candidates without a longer one around them that occurs at least ``percent`` of a hundred times as often."""
    words = candidates.filter("size > 2").select("lang", "a", "size", F.split("phrase", " ").alias("words"))
    spans = words.select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("count"))
    spans = spans.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("count") + 1)).alias("first"))
    around = spans.groupBy("lang", _part(F.col("first"), F.col("count")).alias("phrase")).agg(F.max("a").alias("around"))
    kept = candidates.join(around, ["lang", "phrase"], "left")
    return kept.filter(F.col("around").isNull() | (_exact(F.col("around"), 100) < _exact(F.col("a"), percent))).drop("around")


def first_of_each(rows: DataFrame, by: str, order: list[Column], count: int) -> DataFrame:
    """The first ``count`` rows of each ``by`` with their ``rank``.

    Rows are sorted over all tasks; a row's rank is its place in its part, behind
    those of its group in earlier parts, so no task holds a whole group.
    """
    placed = rows.repartitionByRange(by, *order).sortWithinPartitions(by, *order)
    placed = written(placed.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "ranked")
    parts = placed.groupBy(by, "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(by, "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")).filter(F.col("ahead") < count)
    ranked = placed.join(parts, [by, "part"]).withColumn("rank", F.col("ahead") + F.col("place") - F.col("first") + 1)
    return ranked.filter(F.col("rank") <= count).drop("part", "place", "first", "ahead")


def collocations(docs: DataFrame, least: int = 30, percent: int = 80, count: int = 2000, longest: int = LONGEST) -> DataFrame:
    """The ``count`` best phrases of each language of documents (lang, text)."""
    found, totals = frequent_phrases(docs.select("lang", "text"), least, longest)
    rows = not_within_longer(scored(found), percent)
    best = first_of_each(rows, "lang", [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], count)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def document_collocations(docs: DataFrame) -> DataFrame:
    return collocations(docs, least=30, percent=80, count=2000)


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = f"""
with pieces as (
    select coalesce(lang, 'und') as lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) as piece
    from documents
), worded as (
    select lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda w: w <> '') as words from pieces
), totals as (
    select lang, sum(len(words))::bigint as n from worded group by lang
), found as materialized (
    select lang, list_aggregate(words[i:i + size - 1], 'string_agg', ' ') as phrase, size, count(*) as f
    from worded, unnest(generate_series(1, len(words))) p(i), unnest([1, 2, 3, 4]) s(size)
    where i + size - 1 <= len(words)
    group by all having count(*) >= 30
), candidates as (
    select lang, phrase, size, f as a, string_split(phrase, ' ') as words from found where size > 1
), split as (
    select lang, phrase, size, a, k, list_aggregate(words[1:k], 'string_agg', ' ') as head,
        list_aggregate(words[k + 1:size], 'string_agg', ' ') as tail
    from candidates, unnest([1, 2, 3]) t(k)
    where k < size
), cuts as (
    select s.*, x.f as l, y.f as r, ((2000000::hugeint * s.a) // (x.f + y.f))::bigint as score
    from split s
    join found x on x.lang = s.lang and x.phrase = s.head
    join found y on y.lang = s.lang and y.phrase = s.tail
), scored as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), parts as (
    select lang, list_aggregate(words[i:i + n - 1], 'string_agg', ' ') as phrase, max(a) as around
    from candidates, unnest([2, 3]) s(n), unnest([1, 2, 3]) p(i)
    where n < size and i + n - 1 <= size
    group by all
), ranked as (
    select s.*, row_number() over (partition by s.lang order by score desc, s.a desc, s.phrase) as rank
    from scored s left join parts p on p.lang = s.lang and p.phrase = s.phrase
    where p.around is null or 100::hugeint * p.around < 80::hugeint * s.a
)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""
