import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from despacho.llm import trie
from despacho.llm.trie import document_trie, node_turns, prefix_trie, trie_nodes

TURNS = "conv_id long, turn long, role string, text string, part string, place string, head string, top string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], TURNS)


def remainder(c, n):
    return c - n * int(c / n)  # towards zero, as SQL


def rebuilt(rows):
    """The turns of each rebuilt conversation, by the definition."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            both = f"{role}\n{text}"
            key = (turn is not None, turn or 0, both[:96].encode(), hashlib.md5(both.encode()).hexdigest())
            own.setdefault(conv, []).append((key, (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    result = {}
    for c, turns in own.items():
        head = zlib.crc32(str(c).encode()) % 9
        result[c] = own.get(c - remainder(c, 5), [])[:head] + turns[head:]
    return result


def brute(rows):
    paths = rebuilt(rows)
    nodes = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    result = {}
    for path, members in nodes.items():
        below = {p: m for p, m in nodes.items() if p[: len(path)] == path}
        ends = sorted(c for c in members if len(paths[c]) == len(path))
        result[(min(members), len(path))] = (
            min(nodes[path[:-1]]) if path else None,
            len(members),
            sum(len(p) == len(path) + 1 for p in below),
            sum(not any(q[:-1] == p for q in below if q) for p in below),
            sum((len(m) - 1) * len(p[-1][1].encode()) for p, m in below.items() if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return result


def found(spark, rows):
    got = document_trie(frame(spark, rows))
    assert got.dtypes == [
        ("conv_id", "bigint"),
        ("depth", "bigint"),
        ("parent_conv_id", "bigint"),
        ("n_convs", "bigint"),
        ("n_children", "bigint"),
        ("n_leaves", "bigint"),
        ("saved_tokens", "bigint"),
        ("ends_sha256", "string"),
    ]
    got = got.collect()
    assert len({(r.conv_id, r.depth) for r in got}) == len(got)
    return {(r.conv_id, r.depth): tuple(r)[2:] for r in got}


def conversation(c, texts, role="user"):
    return [(c, i, role if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]


AWKWARD = [
    *conversation(0, ["hello", "hi", "more", "so"]),
    *conversation(5, ["hello", "hi", "more", "so"]),  # equal to another group's
    *[(1, None, None, None), (1, None, "user", ""), (1, 3, "user", "later"), (1, 2, "user", "sooner")],
    *[(2, 1, "b", "tie"), (2, 1, "a", "tie"), (2, 1, "a", "tie"), (2, 0, "user", "x" * 5000)],
    *conversation(3, ["ünï 🙂", "çödé"] * 8),
    (None, 0, "user", "no conversation"),
    *conversation(17, ["no base"]),  # turnless unless its head is 0
    *conversation(23, [f"t{i}" for i in range(12)]),  # its base isn't there
    *conversation(-7, ["negative", "id"] * 6),
    *conversation(-5, ["negative", "base"]),
    *conversation(10**15, ["large id"] * 10),
]


def test_awkward_rows(spark):
    assert found(spark, AWKWARD) == brute(AWKWARD)


def test_no_rows(spark):
    assert found(spark, []) == {}
    assert found(spark, [(None, 1, "user", "x")]) == {}


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations_with_common_beginnings(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(300), 90):
        length = rng.choice([1, 2, 3, 5, 9, 14])
        rows += conversation(c, [rng.choice(["yes", "no", "é"]) if i < 11 else f"own {rng.random()}" for i in range(length)])
    rows += conversation(300, ["long"] * 150) + conversation(301, ["long"] * 149 + ["end"])
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_hot_conversations_over_many_parts(spark, conf):
    """One conversation holds most rows, and copies of another make a large group of ends."""
    rows = conversation(40, [f"turn {i % 7}" for i in range(2500)])
    rows += [r for c in range(100, 500) for r in conversation(c, ["same", "words"])]
    conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="13")
    got = found(spark, rows)
    paths = rebuilt(rows)
    assert got[(40, 0)][1] == 401
    assert max(d for _, d in got) == max(map(len, paths.values()))
    deep = (40, len(paths[40]))
    assert got[deep] == (40, 1, 0, 1, 0, hashlib.sha256(b"40").hexdigest())
    assert sum(v[1] for v in got.values()) == sum(len(p) + 1 for p in paths.values())
    small = [r for r in rows if r[0] != 40]
    assert found(spark, small) == brute(small)


def test_ends_are_joined_from_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 20)
    rows = [r for c in range(60) for r in conversation(c, ["one"])]
    assert found(spark, rows) == brute(rows)


def test_equal_fingerprints_of_different_turns_are_noticed(spark, monkeypatch):
    """With a poor modulus prefixes collide; the comparison of stored turns finds it, and other constants are taken."""
    good, salts = trie.PRIMES, []
    plain = trie.prefixes

    def prefixes(stored, salt):
        salts.append(salt)
        monkeypatch.setattr(trie, "PRIMES", (5, 5, 5) if salt == 0 else good)
        return plain(stored, salt)

    monkeypatch.setattr(trie, "prefixes", prefixes)
    rows = [r for c in range(30) for r in conversation(c, [f"a{c}", f"b{c}", *["c"] * 9])]
    assert found(spark, rows) == brute(rows)
    assert salts == [0, 1]


def test_powers_and_inverses(spark):
    m = trie.moduli(7)[1]
    exponents = [0, 1, 15, 16, 255, 4096, 10**6 + 3, 2**32 - 1]
    rows = spark.createDataFrame([(e,) for e in exponents], "e long")
    got = rows.select("e", m.power(F.col("e")).alias("p"), m.power(F.col("e"), inverse=True).alias("q")).collect()
    for e, p, q in got:
        assert p == pow(m.base, e, m.prime) and p * q % m.prime == 1


def test_other_rules_and_texts_of_nodes(spark):
    rows = conversation(1, ["a", "b"]) + conversation(2, ["c", "d", "e"])
    built = prefix_trie(frame(spark, rows), F.lit(1), F.lit(1), 1)
    nodes = node_turns(built, trie_nodes(built)).select("conv_id", "depth", "text").collect()
    assert {(r.conv_id, r.depth): r.text for r in nodes} == {(1, 0): None, (1, 1): "a", (1, 2): "b", (2, 2): "d", (2, 3): "e"}
