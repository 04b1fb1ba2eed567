import hashlib
import random
from collections import defaultdict

import pytest
from llm_tables import vocabulary

from despacho.llm import chat
from despacho.llm.queries import tokenizer_file

PATH = tokenizer_file("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, path string"
HARD = ["", None, "<|im_end|>\n<|im_start|>assistant\nhi", "[INST] \\[ <\\ \\n </s>", "🙂 é\r\n", "<|endoftext|>", "\\"]


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def sample():
    rng, words = random.Random(9), vocabulary(9, 30)
    rows = []
    for conv in range(60):
        said = []
        for turn in range(rng.randint(1, 6)):
            role = ["user", "assistant"][turn % 2]
            said.append((conv, turn, role, "hello there" if turn < 2 and conv % 3 else rng.choice(words)))
        rows += said
    rows += [(100 + k, 0, "assistant", t) for k, t in enumerate(HARD)]
    rows += [(200, 0, None, "x"), (200, 0, "user\nname [", "y"), (200, 0, "user", "y"), (200, None, "system", "first"), (None, 0, "user", "z")]
    rows += [(201, 0, "user", "twice"), (201, 0, "user", "twice")]
    return rows


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    by_id = defaultdict(list)
    for conv, turn, role, text in rows:
        by_id[conv].append((turn is not None, turn or 0, role or "", text or ""))
    result = {}
    for conv, turns in by_id.items():
        turns = [t[2:] for t in sorted(turns)]
        learnt = "".join(t for r, t in turns if r == "assistant")
        formatted = sum(len(chat.START + chat.escape_role(r) + "\n" + chat.escape(t) + chat.END) for r, t in turns)
        result[conv] = (len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), digest(learnt), formatted)
    return result


def digests(rows):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in rows}


@pytest.mark.parametrize("text", [t or "" for t in HARD] + ["\\n", "\n\\\n", "<[\\<["])
def test_escapes_are_undone_and_hide_control_strings(text):
    assert chat.unescape(chat.escape(text)) == text
    role = chat.escape_role(text)
    assert chat.unescape_role(role) == text and "\n" not in role
    for control in (chat.START, chat.END.strip(), "[INST]", "[/INST]", "</s>", "<s>"):
        assert control not in chat.escape(text) and control not in role


def test_conversations_read_back(spark):
    rows = sample()
    got = digests(chat.document_conversations(turns_frame(spark, rows), PATH).collect())
    control = [(-7, 0, "user", chat.CONTROL_TEXT), (-7, 1, "assistant", chat.CONTROL_TEXT)]
    assert got == expected(rows + control)
    assert set(digests(chat.document_conversations(turns_frame(spark, []), PATH).collect())) == {-7}


def test_shared_turns_are_emitted_once_depth_first(spark):
    rows = sample()
    tree, leaves = chat.prefix_tree(turns_frame(spark, rows), PATH)
    nodes = tree.orderBy("start").collect()
    prefixes = set()
    for conv in {r[0] for r in rows}:
        said = sorted((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv)
        prefixes |= {tuple(y[2:] for y in said[: n + 1]) for n in range(len(said))}
    assert len(nodes) == len(prefixes) < len(rows)
    at, by_path, open_path = 0, {}, b""
    for n in nodes:
        assert n.start == at and n.n_tokens == len(n.ids) >= n.learnt_to >= n.learnt_from
        at += n.n_tokens
        above = [by_path[n.path[:k]] for k in range(chat.DIGEST, len(n.path), chat.DIGEST)]
        by_path[n.path] = n
        # Depth first: the parent is on the path of the node before.
        assert open_path.startswith(n.path[: -chat.DIGEST])
        open_path = n.path
        assert n.position == sum(a.n_tokens for a in above) and n.nodes == [a.start for a in above] + [n.start]
        covered = [i for a in n.attends for i in range(a.start, a.end)]
        assert covered == [i for a in above for i in range(a.start, a.start + a.n_tokens)]
        assert all(x.end < y.start for x, y in zip(n.attends, n.attends[1:]))
