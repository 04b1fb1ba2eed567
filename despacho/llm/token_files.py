"""Token ids as Arrow files of equal-length sequences.

Documents in ascending order of their ids make one stream of ids, each ended by
an end id. The stream is cut by ranges of ids into files in Arrow's IPC file
format, and each file into sequences of ``length`` ids: record batches of the
fixed-size lists ``ids``, ``mask`` (false where the last sequence is filled up)
and ``last`` (true at the end id of a document). A reader maps a file into memory
and reaches any sequence without copying.

A task writes under a name of its own and moves the file to its place at the end,
so a repeated task leaves one whole file. The index has a row per document, as
(part, doc_id, first id in the part, number of ids).

Defined cases: a null or empty text has the end id alone; a null id comes first;
documents that share an id are ordered by a hash of their texts, then the texts;
an empty table leaves an empty index and no files.
"""

from __future__ import annotations

import os
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from despacho.llm.arrow import chunks, text_bytes
from despacho.llm.words import SpanCache, Words, gathered
from despacho.session import shared_folder

LENGTH = 2048
SEQUENCES = 256  # in a record batch
FILE_TEXT = 64 << 20  # bytes of text that a file is made of, if there is enough for all cores
LEAST_TEXT = 8 << 20
KEPT = 1_500_000  # words a task remembers
JOINED = 20_000  # characters of words that the tokenizer gets at once


SENTENCE_ENDS = b".,"
ASCII_WORD = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _is_in(values: bytes) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[list(values)] = True
    return marks


def _without_sentence_ends(words: Words) -> None:
    """Make a full stop or comma behind an ASCII letter or digit a word of its own, so that fewer words differ."""
    ends = words.starts + words.lengths
    cut = (words.lengths > 1) & _is_in(SENTENCE_ENDS)[words.buffer[ends - 1]] & _is_in(ASCII_WORD)[words.buffer[ends - 2]]
    at = np.flatnonzero(cut)
    lengths = words.lengths - cut
    words.starts = np.insert(words.starts, at + 1, ends[at] - 1)
    words.lengths = np.insert(lengths, at + 1, 1)
    words.bounds = np.searchsorted(words.starts, words.text_starts)


class WordEncoder:
    """Ids of whole texts by a tokenizer that drops white space and never joins what a space or line end parts.

    Each distinct word is given to the tokenizer once. Words of letters go
    between spaces, and a piece with the model's word end closes each; others go
    between special tokens, which the tokenizer takes out before anything else.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        specials = {t.content.encode(): i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        if not specials:
            raise ValueError("the tokenizer has no special token to part words by")
        self.specials = list(specials)
        self.opening = os.path.commonprefix(self.specials)[:2]
        self.lowers = len(self.opening) > 1 and not self.opening.isalpha() and self._plain(["Aa"]) == self._plain(["aa"])
        self.mark, self.mark_id = next(iter(specials.items()))
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.uint16 if size <= 1 << 16 else np.uint32
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closes = np.array([bool(suffix) and (self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)])
        self.cache = SpanCache(KEPT, self.dtype)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, words: list[str], mark: str) -> np.ndarray:
        """Ids of the words, each with ``mark`` behind it, given to the tokenizer in groups."""
        groups, size = [[]], 0
        for w in words:
            if size > JOINED:
                groups.append([])
                size = 0
            groups[-1].append(w)
            size += len(w)
        found = [np.zeros(0, np.int64)]
        for g in groups:
            # One group at a time: what the tokenizer returns is many times the size of the ids.
            found += [np.array(ids, np.int64) for ids in self._plain([mark.join(g) + mark] if g else [])]
        return np.concatenate(found)

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that hold no space, one behind the other, and how many each has."""
        strings = [w.decode() for w in words]
        special = {i for i, w in enumerate(words) if any(s in w for s in self.specials)}
        letters = [i for i, w in enumerate(strings) if w.isalpha() and w.lower().isalpha()]
        flat = self._joined([strings[i] for i in letters], " ")
        counts = np.diff(np.flatnonzero(self.closes[flat]), prepend=-1)
        if len(counts) != len(letters):
            letters, flat, counts = [], flat[:0], counts[:0]
        parts = [(letters, flat, counts)]
        taken = special.union(letters)
        marked = [i for i in range(len(words)) if i not in taken]
        flat = self._joined([strings[i] for i in marked], self.mark.decode())
        marks = np.flatnonzero(flat == self.mark_id)
        parts.append((marked, flat[flat != self.mark_id], np.diff(marks, prepend=-1) - 1))
        special = sorted(special)
        alone = self._plain([strings[i] for i in special])
        parts.append((special, np.array([x for ids in alone for x in ids], np.int64), np.array([len(x) for x in alone], np.int64)))
        order = np.concatenate([np.array(p[0], np.int64) for p in parts])
        pool = np.concatenate([p[1] for p in parts])
        sizes = np.concatenate([p[2] for p in parts])
        starts, lengths = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        starts[order], lengths[order] = np.cumsum(sizes) - sizes, sizes
        return gathered(pool, starts, lengths), lengths

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and from where to where each text's go."""
        # The tokenizer lowers case too, but after it took special tokens out and joined letters with
        # combining marks (from U+0300, UTF-8 lead bytes CC and CD).
        unlike = (self.opening, b"\xcc", b"\xcd")
        words = Words(texts, (10, 32), lower=self.lowers and not any(u in t for t in texts if t for u in unlike))
        if not len(words.starts):
            return np.zeros(0, self.dtype), np.zeros(len(texts) + 1, np.int64)
        _without_sentence_ends(words)
        keys = words.hashes()
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        data = words.buffer.tobytes()

        def produce(missing):
            at = first[missing]
            return self.words([data[s : s + n] for s, n in zip(words.starts[at].tolist(), words.lengths[at].tolist())])

        pool, starts, lengths = self.cache.resolve(unique, produce)
        sizes = lengths[inverse]
        per_text = np.bincount(words.text_of_word(), sizes, minlength=len(texts)).astype(np.int64)
        return gathered(pool, starts[inverse], sizes), np.concatenate([[0], np.cumsum(per_text)])


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _schema(length: int, ids: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length)), ("last", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Cuts a stream of ids into sequences and writes them batch by batch."""

    def __init__(self, sink, length: int, dtype):
        self.length, self.dtype = length, dtype
        self.schema = _schema(length, pa.from_numpy_dtype(dtype))
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.ids, self.last, self.waiting = [], [], 0

    def add(self, ids: np.ndarray, last: np.ndarray) -> None:
        self.ids.append(ids.astype(self.dtype))
        self.last.append(last)
        self.waiting += len(ids)
        if self.waiting >= self.length * SEQUENCES:
            self._flush(self.waiting // (self.length * SEQUENCES) * self.length * SEQUENCES)

    def _flush(self, count: int) -> None:
        ids, last = np.concatenate(self.ids), np.concatenate(self.last)
        for start in range(0, count, self.length * SEQUENCES):
            part = slice(start, min(start + self.length * SEQUENCES, count))
            used = part.stop - start
            filled = -(-used // self.length) * self.length
            columns = [np.zeros(filled, self.dtype), np.zeros(filled, bool), np.zeros(filled, bool)]
            columns[0][:used], columns[1][:used], columns[2][:used] = ids[part], True, last[part]
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(c), self.length) for c in columns]
            self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.ids, self.last, self.waiting = [ids[count:]], [last[count:]], len(ids) - count

    def close(self) -> None:
        if self.waiting:
            self._flush(self.waiting)
        self.writer.close()


@dataclass
class SequenceReader:
    """Random access to the ids of one file; batches are taken from the mapped file without a copy."""

    source: pa.NativeFile

    def __post_init__(self):
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.batch_ids = self.length * SEQUENCES

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of the i-th sequence."""
        batch, row = self.file.get_batch(i // SEQUENCES), i % SEQUENCES
        return batch.column("ids")[row].values.to_numpy(), batch.column("mask")[row].values.to_numpy(zero_copy_only=False)

    def span(self, start: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and document ends from the ``start``-th id of the file."""
        ids, last = [], []
        while count > 0:
            number, at = divmod(start, self.batch_ids)
            if getattr(self, "held", None) is None or self.held[0] != number:
                batch = self.file.get_batch(number)
                ends = batch.column("last").flatten().to_numpy(zero_copy_only=False)
                self.held = (number, batch.column("ids").flatten().to_numpy(), ends)
            take = min(count, self.batch_ids - at)
            ids.append(self.held[1][at : at + take])
            last.append(self.held[2][at : at + take])
            start, count = start + take, count - take
        return np.concatenate(ids), np.concatenate(last)


def open_part(folder: str, part: int) -> SequenceReader:
    from pyarrow import fs

    system, path = _file_system(folder)
    name = f"{path}/part-{part:05d}.arrow"
    return SequenceReader(pa.memory_map(name) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(name))


INDEX = "part int, doc_id long, first long, n_tokens long"


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int, length: int = LENGTH) -> DataFrame:
    """Write the files of all documents (doc_id, text) into ``folder``; the index, which is kept there too."""
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    files = max(1, -(-size // FILE_TEXT), min(cores, -(-size // LEAST_TEXT)))
    ordered = docs.select(F.col("doc_id").cast("long"), "text").withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange(int(files), "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")

    def write(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        system, path = _file_system(folder)
        part = task.partitionId()
        own = f"{path}/.part-{part:05d}-{task.taskAttemptId()}"
        encoder, writer, sink, first = WordEncoder(tokenizer), None, None, 0
        for batch in chunks(batches, "text"):
            if writer is None:
                system.create_dir(path, recursive=True)
                sink = system.open_output_stream(own)
                writer = SequenceWriter(sink, length, encoder.dtype)
            flat, bounds = encoder.encode(text_bytes(batch, "text"))
            # The end id goes behind the ids of each text.
            counts = np.diff(bounds) + 1
            ends = np.cumsum(counts)
            ids = np.full(int(ends[-1]), end_id, np.int64)
            last = np.zeros(len(ids), bool)
            last[ends - 1] = True
            ids[~last] = flat
            writer.add(ids, last)
            columns = [pa.array(np.full(len(counts), part, np.int32)), batch.column("doc_id"), pa.array(first + ends - counts), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "first", "n_tokens"])
            first += int(ends[-1])
        if writer is not None:
            writer.close()
            sink.close()
            system.move(own, f"{path}/part-{part:05d}.arrow")

    index = f"{folder}/index"
    ordered.mapInArrow(write, INDEX).write.parquet(index)
    return docs.sparkSession.read.schema(INDEX).parquet(index)


def read_documents(index: DataFrame, folder: str) -> DataFrame:
    """Per document its place in the whole stream and a checksum of its ids, both read from the files."""
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    rows = index.repartition("part").sortWithinPartitions("part", "first")

    def read(batches):
        held, reader = None, None
        for batch in batches:
            sums = []
            places = zip(*(batch.column(c).to_pylist() for c in ("part", "first", "n_tokens")))
            for part, first, count in places:
                if part != held:
                    held, reader = part, open_part(folder, part)
                ids, last = reader.span(first, count)
                if not last[-1] or last[:-1].any():
                    raise ValueError(f"part {part} has no document of {count} ids from {first}")
                sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("part", "doc_id", "first", "n_tokens")), pa.array(sums, pa.int64())],
                ["part", "doc_id", "first", "n_tokens", "ids_crc32"],
            )

    read_back = rows.mapInArrow(read, f"{INDEX}, ids_crc32 long")
    placed = read_back.join(F.broadcast(offsets), "part")
    return placed.select("doc_id", (F.col("offset") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def document_tokens(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    folder = f"{shared_folder(docs.sparkSession)}/despacho-llm/tokens-{uuid.uuid4().hex}"
    return read_documents(write_token_files(docs, tokenizer, folder, end_id), folder)
