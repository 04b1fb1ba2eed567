"""Packing of documents into windows of tokens by multiway differencing.

A document is its ids and an end id. Whole windows are cut off its beginning; what
remains is an item, or two if it is over half a window (items that fill a window by
themselves can't be balanced). A task takes its items in blocks and
parts each block into windows of nearly equal sums (Karmarkar and Karp): partial
partitions of the block, at first one for each item, are merged two at a time,
those of the largest differences first, the fullest part of one with the emptiest
of the other. There are as many windows as the sum needs at least, and one more
for as long as the fullest of them exceeds the capacity.

Documents are read, cut and packed where they lie, so nothing is shuffled, and a
key, document or group of copies of any size is only more blocks; a block is short
of whole windows by less than one. A document's ids fit into a task's memory.

Defined cases: a null or empty text is the end id alone; a null id stays null;
repeated rows are packed each; an empty table gives no windows; further columns
are not read.
"""

from __future__ import annotations

import bisect
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from despacho.llm.arrow import chunks, text_bytes, written
from despacho.llm.byte_pairs import ByteEncoder

CAPACITY = 1024
BLOCK = 4096  # items of a block
ROWS = 1024  # windows in an Arrow batch


def _merged(a: tuple[list, list], b: tuple[list, list], windows: int, join) -> tuple[list, list]:
    """Two partial partitions as one: the fullest parts of one with the emptiest of the other."""
    (sums, trees), (more, more_trees) = (a, b) if len(a[0]) >= len(b[0]) else (b, a)
    shared = len(sums) + len(more) - windows
    if len(more) == 1:  # into its place in the long list
        size, tree = more[0], more_trees[0]
        if shared == 1:
            size, tree = size + sums.pop(0), join(trees.pop(0), tree)
        at = bisect.bisect(sums, size)
        sums.insert(at, size)
        trees.insert(at, tree)
        return sums, trees
    shared = max(0, shared)
    both = [(x + y, join(s, t)) for x, y, s, t in zip(sums, reversed(more[:shared]), trees, reversed(more_trees[:shared]))]
    both += [*zip(sums[shared:], trees[shared:]), *zip(more[shared:], more_trees[shared:])]
    both.sort()
    return [s for s, _ in both], [t for _, t in both]


def differenced(sizes: list[int], windows: int) -> list[int]:
    """The window of each item, for windows of nearly equal sums.

    A partial partition is the sums of its parts that aren't empty, ascending, and
    the tree of items of each part. Where two of them have more parts than there are
    windows, the least parts of one meet the least of the other in opposite order;
    each of the rest meets an empty part.
    """
    count = len(sizes)
    children: list[tuple[int, int]] = []

    def join(tree: int, other: int) -> int:
        children.append((tree, other))
        return count + len(children) - 1

    partial = {i: ([size], [i]) for i, size in enumerate(sizes)}
    heap = [(-size if windows > 1 else 0, i) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        key = heapq.heappop(heap)[1]
        sums, trees = partial[key] = _merged(partial.pop(key), partial.pop(heapq.heappop(heap)[1]), windows, join)
        least = sums[0] if len(sums) == windows else 0
        heapq.heappush(heap, (least - sums[-1], key))
    window = [0] * (count + len(children))
    for _, trees in partial.values():
        for number, tree in enumerate(trees):
            window[tree] = number
    for tree in range(len(children) - 1, -1, -1):
        for child in children[tree]:
            window[child] = window[count + tree]
    return window[:count]


def packed(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """The window of each item and the number of windows, none of which exceeds the capacity.

    The first number is the least that could do; as long as a window exceeds the
    capacity there are as many more as make them smaller by the excess on average.
    """
    if sizes and max(sizes) > capacity:
        raise ValueError("an item exceeds the capacity")
    total = sum(sizes)
    windows = -(-total // capacity)
    while True:
        window = differenced(sizes, windows)
        sums = [0] * windows
        for w, size in zip(window, sizes):
            sums[w] += size
        excess = max(sums, default=0) - capacity
        if excess <= 0:
            return window, windows
        windows = min(len(sizes), max(windows + 1, -(-total * windows // max(total - excess * windows, 1))))


PIECE = pa.struct(
    [(name, pa.int64()) for name in ("doc_id", "start", "length", "doc_tokens", "offset")]
)
PIECES = "array<struct<doc_id: bigint, start: bigint, length: bigint, doc_tokens: bigint, offset: bigint>>"
SEQUENCES = f"sequence_id long, ids array<int>, pieces {PIECES}"


class Packer:
    """Collects documents and yields batches of full windows; ``rest`` yields the last ones."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.ready: list[tuple[np.ndarray, list[dict]]] = []
        self.items: list[tuple[np.ndarray, dict]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        total, whole, half = len(ids), len(ids) // self.capacity * self.capacity, max(1, self.capacity // 2)
        starts = [*range(0, whole, self.capacity), *range(whole, total, half)]
        for start, end in zip(starts, [*starts[1:], total]):
            piece = ids[start:end]
            place = {"doc_id": doc_id, "start": start, "length": len(piece), "doc_tokens": total, "offset": 0}
            if len(piece) == self.capacity:
                self.ready.append((piece, [place]))
            else:
                self.items.append((piece, place))
        if len(self.items) >= BLOCK:
            self._pack()
        while len(self.ready) >= ROWS:
            yield self._batch(ROWS)

    def _pack(self) -> None:
        window, count = packed([len(ids) for ids, _ in self.items], self.capacity)
        members: list[list[int]] = [[] for _ in range(count)]
        for i, w in enumerate(window):
            members[w].append(i)
        for group in filter(None, members):
            pieces, offset = [], 0
            for i in group:
                pieces.append(self.items[i][1] | {"offset": offset})
                offset += len(self.items[i][0])
            self.ready.append((np.concatenate([self.items[i][0] for i in group]), pieces))
        self.items = []

    def _batch(self, count: int) -> pa.RecordBatch:
        rows, self.ready = self.ready[:count], self.ready[count:]
        bounds = np.cumsum([0] + [len(ids) for ids, _ in rows])
        ids = pa.ListArray.from_arrays(
            pa.array(bounds, pa.int32()), pa.array(np.concatenate([ids for ids, _ in rows]).astype(np.int32))
        )
        numbers = pa.array(np.arange(self.next_id, self.next_id + len(rows)))
        self.next_id += len(rows)
        return pa.RecordBatch.from_arrays(
            [numbers, ids, pa.array([p for _, p in rows], pa.list_(PIECE))], ["sequence_id", "ids", "pieces"]
        )

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.items:
            self._pack()
        while self.ready:
            yield self._batch(ROWS)


def packed_sequences(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Windows of at most ``capacity`` ids of all documents (doc_id, text), as a table in the shared folder.

    ``ids`` are a window's ids without padding, ``pieces`` where they come from: a
    document's id and number of ids, the piece's first id in it, its length and its
    place in the window. Window ids are unique, not gapless.
    """

    def run(batches):
        from pyspark import TaskContext

        encoder = ByteEncoder(tokenizer)
        packer = Packer(capacity, TaskContext.get().partitionId() << 33)
        for batch in chunks(batches, "text"):
            flat, bounds = encoder.encode(text_bytes(batch, "text"))
            for doc_id, low, high in zip(batch.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                yield from packer.add(doc_id, np.append(flat[low:high], end_id))
        yield from packer.rest()

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SEQUENCES)
    return written(rows, "windows", shuffled=False)


PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def placed_pieces(sequences: DataFrame) -> DataFrame:
    """A row for each piece, with a checksum of its ids as the window holds them."""

    def run(batches):
        for batch in batches:
            lists, pieces = batch.column("ids"), batch.column("pieces")
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            window = pieces.value_parent_indices().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            inner = pieces.flatten()
            field = {PIECE[i].name: inner.field(i) for i in range(PIECE.num_fields)}
            first = starts[window] + field["offset"].to_numpy(zero_copy_only=False)
            last = first + field["length"].to_numpy(zero_copy_only=False)
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(first.tolist(), last.tolist())]
            field["ids_crc32"] = pa.array(sums, pa.int64())
            field["sequence_id"] = batch.column("sequence_id").take(pa.array(window, pa.int64()))
            names = [n.split()[0] for n in PLACED.split(", ")]
            yield pa.RecordBatch.from_arrays([field[n] for n in names], names)

    return sequences.mapInArrow(run, PLACED)


def document_packing(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    return placed_pieces(packed_sequences(docs, tokenizer, end_id))
