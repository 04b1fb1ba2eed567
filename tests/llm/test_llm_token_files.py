import uuid
import zlib

import numpy as np
from llm_tables import EDGE, edge, empty, frame
from tokenizers import Tokenizer

from despacho.llm.queries import tokenizer_file
from despacho.llm.token_files import WordEncoder, document_tokens, open_part, read_documents, write_token_files

PATH = tokenizer_file("word_bpe_49k.json")
END = 2
ODD = [
    "<|startoftext|> a<|endoftext|>b don't <|startoftext|>",
    "H̱ T̈ Abc <|ENDOFTEXT|>",
    "É́  x\tY\x1cz w, end. 3. a.b.",
    "ΣΑΣ ΟΔΟΣ İI K",
    "a" * 3000,
    "日本語テキスト12345 a_b__c ﬁ ２ ​ x",
]


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    start, result = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [END]
        result.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return result


def test_words_make_the_ids_of_whole_texts():
    tokenizer, encoder = Tokenizer.from_file(PATH), WordEncoder(PATH)
    texts = ODD + [t or "" for _, t in EDGE]
    for group in [texts, *[[t] for t in texts]]:
        flat, bounds = encoder.encode([t.encode() for t in group])
        for text, start, end in zip(group, bounds[:-1], bounds[1:]):
            assert flat[start:end].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_files_read_back_in_order(spark):
    rows = document_tokens(edge(spark), PATH, END).collect()
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows), key=lambda r: r[1])
    assert got == expected(EDGE)
    assert document_tokens(empty(spark), PATH, END).collect() == []


def test_sequences_have_equal_length_and_masks(spark, tmp_path):
    folder = f"{tmp_path}/{uuid.uuid4().hex}"
    rows = [(i, f"word {i} " * (i % 50)) for i in range(400)]
    index = write_token_files(frame(spark, rows), PATH, folder, END, length=16)
    total = 0
    for part in [r.part for r in index.select("part").distinct().collect()]:
        reader = open_part(folder, part)
        batches = reader.file.num_record_batches
        assert reader.file.schema.field("ids").type.list_size == 16
        for b in range(batches):
            batch = reader.file.get_batch(b)
            mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
            batch.column("ids").flatten().to_numpy(zero_copy_only=True)
            assert mask.all() or b == batches - 1
            total += int(mask.sum())
        ids, mask = reader.sequence(0)
        assert len(ids) == len(mask) == 16
    assert total == sum(n for _, _, n, _ in expected(rows))
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in read_documents(index, folder).collect())
    assert got == expected(rows)
