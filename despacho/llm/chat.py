"""Chat formatting as a prefix tree.

A conversation is a path of turns. Conversations that begin with the same turns
share their nodes, and each node's tokens are emitted once, depth first: nodes in
the order of their paths, one stream over all files. A node carries the position
of its first token (the tokens of its ancestors come before it), the stretches of
the stream its tokens may attend to beside their own node, and a loss mask that
covers the text of assistant turns.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and
texts a backslash goes behind every ``<``, ``[`` and backslash, so that no control
string of this or the ``[INST]`` template can occur there; reading undoes it.

Defined cases: null roles and texts are empty; turns that share a number are
ordered by role and text, repeated rows are repeated turns; rows without a
conversation id form one conversation; an empty table gives no rows. A
conversation is taken to fit into a task's memory, however many share its turns.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from despacho.llm.arrow import written

START, END, ROLE_END = "<|im_start|>", "<|im_end|>\n", "\n"
LEARNT_ROLE = "assistant"
DIGEST = 16  # bytes of a turn's digest in a path


def escape(text: str) -> str:
    return re.sub(r"[<\[\\]", lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"([<\[\\])\\", r"\1", text)


def escape_role(role: str) -> str:
    """As ``escape``, and on one line: a line end becomes a backslash and ``n``, which ``escape`` never leaves."""
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"([<\[\\])\\|\\n", lambda m: m[1] or "\n", role)


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    if not (formatted.startswith(START) and formatted.endswith(END)):
        raise ValueError("not a turn")
    role, _, text = formatted[len(START) : -len(END)].partition(ROLE_END)
    return unescape_role(role), unescape(text)


def paths(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct nodes (path, role, text), and the path of each conversation's last turn.

    A path is the digests of a turn and those before it, one behind the other:
    a node's path begins with its parent's, and ascending paths go depth first.
    """
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    digest = F.transform("turns", lambda t: F.md5(F.concat(F.md5(t["role"]), F.md5(t["text"]))))
    whole = whole.withColumn("path", F.unhex(F.array_join(digest, "")))
    nodes = whole.select("path", F.posexplode("turns").alias("at", "turn"))
    nodes = nodes.select(F.substring("path", F.lit(1), (F.col("at") + 1) * DIGEST).alias("path"), "turn.role", "turn.text")
    return nodes.distinct(), whole.select("conv_id", "path", F.size("turns").cast("bigint").alias("n_turns"))


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # a text is never a special token
    return tokenizer


EMITTED = (
    "path binary, ids array<int>, learnt_from int, learnt_to int, part int, local long, n_tokens long,"
    " outer_levels int, inner array<struct<start: bigint, end: bigint>>"
)


def _emit(nodes: DataFrame, tokenizer: str) -> DataFrame:
    """Nodes in depth-first order with their tokens and their place in their part of the stream.

    ``inner`` are the ancestors within the part; the ``outer_levels`` above them
    stand in earlier parts. As a stack of one path is all that a task keeps, a
    tree of any size may run over many parts.
    """
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    types = [pa.binary(), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(span)]
    names = ["path", "ids", "learnt_from", "learnt_to", "part", "local", "n_tokens", "outer_levels", "inner"]

    def run(batches):
        from pyspark import TaskContext

        part, at, encoder = TaskContext.get().partitionId(), 0, _tokenizer(tokenizer)
        open_path: list[tuple[bytes, dict]] = []
        for batch in batches:
            rows = []
            for path, role, text in zip(*(batch.column(c).to_pylist() for c in ("path", "role", "text"))):
                pieces = (START + escape_role(role) + ROLE_END, escape(text), END)
                head, body, tail = (encoder.encode(p, add_special_tokens=False).ids for p in pieces)
                ids = head + body + tail
                learnt = len(body) if role == LEARNT_ROLE else 0
                while open_path and not path.startswith(open_path[-1][0]):
                    open_path.pop()
                inner = [span for _, span in open_path]
                outer = len(path) // DIGEST - 1 - len(inner)
                rows.append((path, ids, len(head), len(head) + learnt, part, at, len(ids), outer, inner))
                open_path.append((path, {"start": at, "end": at + len(ids)}))
                at += len(ids)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    ordered = nodes.repartitionByRange("path").sortWithinPartitions("path")
    return ordered.mapInArrow(run, EMITTED)


SPANS = "array<struct<start:bigint,end:bigint>>"


def _merged(spans: Column) -> Column:
    """Sorted spans with neighbours that touch made one."""

    def step(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), span["end"].alias("end"))))
        touches = (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] == span["start"])
        return F.when(touches, joined).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, F.array().cast(SPANS), step)


def prefix_tree(turns: DataFrame, tokenizer: str) -> tuple[DataFrame, DataFrame]:
    """The stream's nodes, over a table in the shared folder, and each conversation's leaf.

    A node has ``start`` in the stream, ``ids``, the loss mask (its tokens
    ``learnt_from`` to ``learnt_to``), ``position`` of its first token, ``nodes``
    (where the nodes of its path start, its own last) and ``attends`` (stretches
    of the stream that hold its ancestors).
    """
    nodes, leaves = paths(turns.select("conv_id", "turn", "role", "text"))
    emitted = written(_emit(nodes, tokenizer), "chat-nodes", shuffled=False)
    # Per part: where it starts, and the ancestors of its first node that stand in earlier parts.
    parts = emitted.groupBy("part").agg(F.sum("n_tokens").alias("total"), F.min("path").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    parts = parts.select("part", "first", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    levels = F.explode(F.sequence(F.lit(1), F.greatest((F.length("first") / DIGEST).cast("int"), F.lit(1)))).alias("level")
    above = parts.select("part", "first", levels).select("part", "level", F.substring("first", F.lit(1), F.col("level") * DIGEST).alias("path"))
    offsets = parts.select("part", "offset")
    places = emitted.select("path", "part", "local", "n_tokens").join(F.broadcast(offsets), "part")
    start = F.col("offset") + F.col("local")
    places = places.select("path", F.struct(start.alias("start"), (start + F.col("n_tokens")).alias("end")).alias("span"))
    chains = above.join(places, "path").groupBy("part").agg(F.array_sort(F.collect_list("span")).alias("chain"))
    parts = parts.select("part", "offset").join(chains, "part")

    def moved(span: Column) -> Column:
        return F.struct((span["start"] + F.col("offset")).alias("start"), (span["end"] + F.col("offset")).alias("end"))

    placed = emitted.join(F.broadcast(parts), "part").withColumn("start", start)
    placed = placed.withColumn("ancestors", F.concat(F.slice("chain", 1, F.col("outer_levels")), F.transform("inner", moved)))
    lengths = F.transform("ancestors", lambda s: s["end"] - s["start"])
    tree = placed.select(
        "path",
        "start",
        "n_tokens",
        "ids",
        "learnt_from",
        "learnt_to",
        F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, n: a + n).alias("position"),
        F.concat(F.transform("ancestors", lambda s: s["start"]), F.array("start")).alias("nodes"),
        _merged(F.col("ancestors")).alias("attends"),
    )
    return tree, leaves


def read_nodes(tree: DataFrame, tokenizer: str) -> DataFrame:
    """Per node the length of its formatted text and, unescaped, role, text and the text under the loss mask, all from its ids."""

    def run(batches):
        decoder = _tokenizer(tokenizer)

        def text_of(ids):
            return decoder.decode(ids, skip_special_tokens=False)

        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("start", "ids", "learnt_from", "learnt_to"))
            for start, ids, low, high in zip(*columns):
                formatted = text_of(ids)
                rows.append((start, len(formatted), *read_turn(formatted), unescape(text_of(ids[low:high]))))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays(columns, ["start", "chars", "role", "text", "learnt"])

    read = tree.select("start", "ids", "learnt_from", "learnt_to")
    return read.mapInArrow(run, "start long, chars long, role string, text string, learnt string")


def read_conversations(tree: DataFrame, leaves: DataFrame, tokenizer: str) -> DataFrame:
    """Per conversation digests of what its path of the tree holds."""
    ends = leaves.select("path").distinct()
    ends = tree.select("path", F.col("start").alias("leaf"), "nodes").join(ends, "path", "left_semi")
    ends = written(ends, "chat-leaves")
    steps = ends.select("leaf", F.posexplode("nodes").alias("at", "start"))
    turn = F.struct("at", "role", "text", "learnt", "chars")
    turns = steps.join(read_nodes(tree, tokenizer), "start").groupBy("leaf").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join(F.transform("turns", lambda t: t["learnt"]), "")
    chars = F.aggregate(F.transform("turns", lambda t: t["chars"]), F.lit(0).cast("bigint"), lambda a, n: a + n)
    digests = turns.select(
        "leaf",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learnt).cast("bigint").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        chars.alias("formatted_chars"),
    )
    by_path = ends.select("path", "leaf").join(digests, "leaf").drop("leaf")
    return leaves.select("conv_id", "path").join(by_path, "path").drop("path")


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def with_control_conversation(turns: DataFrame) -> DataFrame:
    """The turns and conversation -7, whose user and assistant both say control strings."""
    rows = [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]
    own = turns.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionAll(own)


def document_conversations(turns: DataFrame, tokenizer: str) -> DataFrame:
    tree, leaves = prefix_tree(with_control_conversation(turns), tokenizer)
    return read_conversations(tree, leaves, tokenizer)
