import random

import numpy as np
import pytest
import sentencepiece
from llm_tables import EDGE, edge, empty, vocabulary

from despacho.llm.pieces import NEVER, Encoder, Runs, decode, decoded, document_pieces, encoded, load_vocabulary
from despacho.llm.queries import tokenizer_file

MODEL = tokenizer_file("piece_bpe_32k.model")
TEXTS = [t or "" for _, t in EDGE] + ["  two  spaces ", "日本語 テキスト", "x" * 300, "the " * 80, "<s><0x0A></s>", "a\x00b"]


@pytest.fixture(scope="module")
def pieces():
    return load_vocabulary(MODEL)


def runs(flat, bounds):
    return [flat[s:e].tolist() for s, e in zip(bounds[:-1], bounds[1:])]


def test_without_dropout_ids_are_the_library_s(pieces):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = runs(*Encoder(pieces, 0.0).encode([t.encode() for t in TEXTS], [0] * len(TEXTS)))
    for text, ids in zip(TEXTS, got):
        if "▁" not in text:  # the library reads this character as a space
            assert ids == library.encode(text)


@pytest.mark.parametrize("alpha", [0.0, 0.1, 0.5, 1.0])
def test_every_segmentation_decodes_to_the_text(pieces, alpha):
    texts = [t.encode() for t in TEXTS]
    flat, bounds = Encoder(pieces, alpha, 3).encode(texts, [i % 4 for i in range(len(texts))])
    assert decode(pieces, flat, bounds) == texts


def test_seeds_and_variants_vary_the_segmentation(pieces):
    text = [b"the international conversation continues throughout everything"] * 2
    a = runs(*Encoder(pieces, 0.3, 1).encode(text, [0, 1]))
    assert a == runs(*Encoder(pieces, 0.3, 1).encode(text, [0, 1]))
    assert a[0] != a[1]
    assert a != runs(*Encoder(pieces, 0.3, 2).encode(text, [0, 1]))


def test_dropout_makes_more_pieces(pieces):
    text = [TEXTS[6].encode(), TEXTS[7].encode()]
    counts = [len(Encoder(pieces, alpha, 5).encode(text, [0, 0])[0]) for alpha in (0.0, 0.1, 0.4, 1.0)]
    assert counts == sorted(counts) and len(set(counts)) == 4


@pytest.mark.parametrize("alpha", [0.0, 0.1, 0.6])
def test_arrays_and_agenda_merge_alike(pieces, alpha):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abtheion é日") for _ in range(rng.randint(1, 40))) for _ in range(300)] + vocabulary(6)
    keys = np.arange(len(texts), dtype=np.uint64) * np.uint64(977)
    encoder = Encoder(pieces, alpha, 3)
    ids, counts = encoder.segments([t.encode() for t in texts], keys)
    for text, key, got in zip(texts, keys.tolist(), np.split(ids, np.cumsum(counts)[:-1])):
        want = []
        for start, end, piece in encoder.agenda(text, key):
            want += [piece] if piece >= 0 else pieces.byte_ids[list(text[start:end].encode())].tolist()
        assert want == got.tolist()


def test_edge_rows(spark):
    rows = document_pieces(edge(spark), MODEL).collect()
    assert len(rows) == len(EDGE) and all(r.lossless and r.n_tokens == len(r.ids) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    assert document_pieces(empty(spark), MODEL).collect() == []


def test_columns_stay_and_decoding_gives_the_texts(spark):
    docs = edge(spark)
    rows = encoded(docs, MODEL, alpha=0.2)
    assert rows.columns == [c for c in docs.columns if c not in ("ids", "lossless")] + ["ids", "lossless"]
    back = decoded(rows.select("doc_id", "ids"), MODEL).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in EDGE)


def test_every_occurrence_draws_for_itself(spark):
    # A word that many documents hold in many places has far more than a handful of segmentations.
    word = "internationalization"
    docs = spark.createDataFrame([(i, " ".join([word] * 50)) for i in range(40)], "doc_id long, text string")
    rows = {r.doc_id: r.ids for r in encoded(docs, MODEL, alpha=0.3).collect()}
    by_id = load_vocabulary(MODEL).piece_bytes

    def cuts(ids):
        found, one = [], ()
        for i in ids:
            if by_id[i].startswith(b" ") and one:
                found.append(one)
                one = ()
            one += (i,)
        return [*found, one]

    inside = [len(set(cuts(ids))) for ids in rows.values()]
    assert min(inside) > 4
    assert len({tuple(ids) for ids in rows.values()}) == 40
    assert len({c for ids in rows.values() for c in cuts(ids)}) > 40
    again = {r.doc_id: r.ids for r in encoded(docs.repartition(3), MODEL, alpha=0.3).collect()}
    assert again == rows


@pytest.mark.parametrize("alpha", [0.0, 0.1, 0.3, 0.9, 1.0])
@pytest.mark.parametrize("kept", [0, 50, 1 << 19])
def test_remembered_runs_equal_direct_ones(pieces, alpha, kept):
    rng, words = random.Random(8), vocabulary(8, 60) + ["é日", "x" * 60, "a▁b"]
    encoder, seen = Encoder(pieces, alpha, 5, Runs(kept)), []
    direct = encoder.segments

    class Direct(Encoder):
        def _remembered(self, joined, starts, lengths, spans, own):
            ids, counts = direct([joined[s : s + n] for s, n in zip(starts.tolist(), lengths.tolist())], own)
            seen.append(len(counts))
            return ids, np.cumsum(counts) - counts, counts

    for _ in range(3):
        texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))).encode() for _ in range(20)]
        keys = [rng.randrange(1 << 60) for _ in texts]
        got, want = encoder.encode(texts, keys), Direct(pieces, alpha, 5).encode(texts, keys)
        assert runs(*got) == runs(*want)
    assert seen


def test_the_share_of_skipped_candidates_is_alpha(pieces):
    pair = pieces.initial("ab")
    assert pieces.find_pairs(pair[:1], pair[1:])[0][0] < NEVER
    keys = np.arange(20_000, dtype=np.uint64) * np.uint64(977)
    _, counts = Encoder(pieces, 0.3, 1).segments([b"ab"] * len(keys), keys)
    assert abs((counts == 2).mean() - 0.3) < 0.02


def test_the_text_travels_once(spark):
    docs = spark.createDataFrame([(1, "the text"), (2, None)], "doc_id long, text string")
    for kept, names in ((docs, {"doc_id", "text", "own"}), (docs.withColumnRenamed("text", "TEXT"), {"doc_id", "TEXT", "own"})):
        rows = encoded(kept, MODEL)
        sent = rows._jdf.queryExecution().analyzed().children().head().output()
        assert {sent.apply(i).name() for i in range(sent.size())} == names
        assert [r[1] for r in rows.orderBy("doc_id").collect()] == ["the text", None]
