import hashlib
import random
import re
from collections import Counter

import numpy as np
from llm_tables import EDGE, LONG, STORY, edge, empty, frame, lower_ascii, prose, vocabulary

from despacho.llm import dedup
from despacho.llm.components import components
from despacho.llm.dedup import deduplicated, duplicate_groups, least_matches, plausible, shingles, signatures


def sets_of(rows):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return sets


def brute(rows):
    sets = sets_of(rows)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed=3):
    """Texts, chains of ever more edited copies, groups of equal texts, and pairs just around the threshold."""
    rng, words = random.Random(seed), vocabulary(seed)
    rows = []

    def add(text):
        rows.append((len(rows) * 7 % 100_003, text))

    for _ in range(60):
        add(prose(rng, words, rng.randint(1, 80)))
    for _ in range(6):
        text = prose(rng, words, 120).split()
        for step in range(25):
            add(" ".join(text))
            for _ in range(rng.randint(1, 3)):
                text[rng.randrange(len(text))] = rng.choice(words)
    for _ in range(40):
        add(rows[5][1])
    return rows


def test_components_equal_brute_force(spark):
    rows = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in duplicate_groups(frame(spark, rows)).collect()}
    want = brute(rows)
    assert got == want
    assert len({c for _, c in want.values()}) < len(rows) - 100


def test_edge_rows(spark):
    rows = duplicate_groups(edge(spark)).collect()
    assert len(rows) == len(EDGE)
    want = brute([x for x in EDGE if x[0] is not None])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == want
    [alone] = [r for r in rows if r.doc_id is None]
    assert alone.component_id is None and alone.kept
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows if r.doc_id is not None)
    assert duplicate_groups(empty(spark)).collect() == []


def test_the_stage_keeps_one_row_of_each_group(spark):
    docs = edge(spark)
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    # 9 and 11 equal 8; 10 differs in a word of twenty-one; the row of 12 was there twice.
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(i) for i in {i for i, _ in EDGE} if i is None or brute([x for x in EDGE if x[0] is not None])[i][1] == i
    )
    assert deduplicated(empty(spark)).collect() == []


def test_texts_that_share_an_id_are_kept_each(spark):
    near = STORY + " at night"
    other = "a wholly different text that nobody else has written down so far in here"
    rows = [(5, STORY), (5, other), (3, near), (None, other), (None, STORY), (None, "only here and nowhere else at all"), (7, STORY), (7, STORY)]
    rows += [(8, None), (8, ""), (None, None), (9, LONG), (9, LONG + " end"), (2, other.upper())]
    kept = Counter((r.doc_id, r.text) for r in deduplicated(frame(spark, rows)).select("doc_id", "text").collect())
    assert kept == Counter(
        [(3, near), (2, other.upper()), (None, "only here and nowhere else at all"), (8, None), (8, ""), (None, None)]
        + [(9, min((t for i, t in rows if i == 9), key=lambda t: hashlib.md5(t.encode()).hexdigest()))]
    )


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(2000, 2000), (500, 600)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)} | {500: 500, 600: 500}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    members = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = np.unique(members[:2000]), np.unique(members[500:])
    left, right = signatures([a, b])
    assert abs((left == right).mean() - 0.5) < 0.15


def test_sequential_pruning_keeps_what_may_be_similar():
    rng = np.random.default_rng(5)
    n = 4000
    for similarity, kept in ((0.75, 0.999), (0.9, 1.0)):
        same = rng.random((n, 128)) < similarity
        assert plausible(np.zeros((n, 128)), np.where(same, 0, 1)).mean() >= kept
    same = rng.random((n, 128)) < 0.3
    assert plausible(np.zeros((n, 128)), np.where(same, 0, 1)).mean() < 0.01
    assert [least_matches(n) for n in (16, 128)] == sorted(least_matches(n) for n in (16, 128))


def test_shingles_of_short_texts():
    got = shingles([b"a b c d e", b"A B C D E", b"a b", b"a  b", b"b a", b"", None, b"a b c d e f"])
    assert [len(s) for s in got] == [1, 1, 1, 1, 1, 0, 0, 2]
    assert got[0] == got[1] and got[2] == got[3] != got[4] and got[0] in got[7]


def test_large_buckets_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SMALL", 2)
    monkeypatch.setattr(dedup, "BLOCK", 300)
    rows = near_copies(11)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in duplicate_groups(frame(spark, rows)).collect()}
    assert got == brute(rows)
