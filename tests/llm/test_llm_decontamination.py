import hashlib
import random
import re

import pytest
from llm_tables import EDGE, STORY, edge, empty, frame, lower_ascii, prose, vocabulary

from despacho.llm.decontamination import contamination, decontaminated, document_contamination


def items_frame(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, digest string")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))


def brute(docs, items, window=10):
    windows = []
    for item, text in items:
        w = words_of(text)
        windows += [(item, tuple(w[i : i + window])) for i in range(max(len(w) - window, 0) + 1)] if w else []
    result = []
    for doc, text in docs:
        w, hit, found = words_of(text), set(), set()
        for item, x in windows:
            for i in range(len(w) - len(x) + 1):
                if tuple(w[i : i + len(x)]) == x:
                    hit |= set(range(i, i + len(x)))
                    found |= {str(item)} if item is not None else set()
        listed = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        result.append((str(doc), len(w), len(hit), len(found), listed, bool(hit)))
    return sorted(result)


def rows_of(df):
    return sorted((str(r.doc_id), *r[1:6]) for r in df.collect())


ITEMS = [(1, STORY), (2, "Four words"), (3, "word"), (30, "WORD!"), (4, None), (5, ""), (None, "seven wizards"), (6, "it"), (1, STORY)]


def test_edge_rows(spark):
    got = document_contamination(edge(spark), items_frame(spark, [(*x, "y") for x in ITEMS]))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert rows_of(got) == brute(EDGE, ITEMS)
    assert document_contamination(empty(spark), items_frame(spark, [(1, "a", "")])).collect() == []
    none = document_contamination(edge(spark), items_frame(spark, []))
    assert rows_of(none) == brute(EDGE, [])


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_random_passages_with_and_without_broadcast(spark, limit):
    rng, words = random.Random(5), vocabulary(5, 60)
    items = [(i, prose(rng, words, rng.choice([1, 2, 5, 9, 10, 11, 25]))) for i in range(25)]
    docs = []
    for i in range(60):
        text = prose(rng, words, rng.randint(0, 40))
        for _ in range(rng.randint(0, 2)):
            part = rng.choice(items)[1].split()
            cut = rng.randint(0, max(0, len(part) - 10))
            text += rng.choice([" ", ". ", "\n"]) + " ".join(part[cut:]).title() + " " + prose(rng, words, 3)
        docs.append((i, text))
    docs.append(docs[3])
    got = contamination(frame(spark, docs), items_frame(spark, [(*x, "") for x in items]), limit=limit)
    assert rows_of(got.drop("digest")) == brute(docs, items)


def test_the_stage_keeps_columns_and_clean_rows(spark):
    docs = edge(spark)
    kept = decontaminated(docs, items_frame(spark, [(1, STORY, "")]))
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(EDGE) - 4 and not {8, 9, 10, 11} & set(ids) and None in ids


def test_no_python_in_the_plan(spark):
    plan = contamination(edge(spark), items_frame(spark, [(1, STORY, "")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan.replace("ArrowHead", "")
