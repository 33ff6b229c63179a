import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from reelforge.llm import packing, token_files
from reelforge.llm.tokens import VOCABULARY, WordTokenizer
from reelforge.operators.durable import staging_path

from .conftest import LONG, with_clashing_columns

PLAIN = Tokenizer.from_file(VOCABULARY)


def ids_of(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_tokenizer_equals_the_tokenizer(corpus):
    odd = [None, "", "It's O'Neil's we'll", "naïve Ünïcode ÀÉß ÷ ×", "a1b22 <|endoftext|> x", "漢字 かな", "x\x01y", "!!!'s --'t", "éa  \n\tq",
           "12 345 ___ a_b", "İstanbul", " nb", "é", LONG, "'", "a'", "'S", "<|", "ÿÞþ"]
    texts = odd + [r.text for r in corpus.select("text").limit(60).collect()]
    encoder = WordTokenizer()
    for _ in range(2):  # with an empty and with a filled store
        ids, limits = encoder.encode(pa.array(texts, pa.string()))
        for i, text in enumerate(texts):
            assert ids[limits[i] : limits[i + 1]].tolist() == ids_of(text)[:-1], text


def test_token_files_round_trip(spark, odd_docs):
    docs = with_clashing_columns(odd_docs)
    files = token_files.write_token_files(docs, staging_path(spark, "tokens"), partitions=3)
    rows = token_files.read_token_files(files).orderBy("start").collect()
    expected = sorted(((r.doc_id is not None, r.doc_id or 0), crc(ids_of(r.text))) for r in odd_docs.collect())
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.ids_crc32) for r in rows) == expected
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for row in rows:
        assert row.start == start
        start += row.n_tokens
    place = files.orderBy("file_no").collect()[-1]
    in_order = list(token_files.read_records(place.file, 2))
    for number in reversed(range(place.records)):
        doc_id, ids = token_files.read_record(place.file, number, 2)
        assert doc_id == in_order[number][0] and ids.tolist() == in_order[number][1].tolist()


def test_damage_is_found(spark, odd_docs):
    file = token_files.write_token_files(odd_docs, staging_path(spark, "tokens"), partitions=1).first().file
    name = file.removeprefix("file:")
    data = bytearray(open(name, "rb").read())
    data[len(data) // 2] ^= 1
    open(name, "wb").write(data)
    with pytest.raises(ValueError, match="damaged"):
        list(token_files.read_records(file, 2))


def test_token_files_of_no_rows(spark, no_docs):
    assert token_files.read_token_files(token_files.write_token_files(no_docs, staging_path(spark, "tokens"))).count() == 0


def check_packed(rows, docs, capacity):
    by_doc, by_sequence = {}, {}
    for row in rows:
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
        by_doc.setdefault(row.doc_id, []).append((row.piece, row.start, row.length, row.ids_crc32))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    expected = {}
    for row in docs:
        ids = ids_of(row.text)
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            expected.setdefault(row.doc_id, []).append((piece, start, len(part), crc(part)))
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in expected.items()}
    tokens = sum(length for places in by_sequence.values() for _, length in places)
    return len(by_sequence), -(-tokens // capacity)


def test_packing_odd_documents(odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_AT_ONCE", 2)
    docs = with_clashing_columns(odd_docs)
    for capacity in (64, 4096):
        used, least = check_packed(packing.pack(docs, capacity).collect(), odd_docs.collect(), capacity)
        assert used <= least + 1
    assert packing.pack(no_docs).count() == 0


def test_packing_a_corpus(corpus):
    used, least = check_packed(packing.pack(corpus, 1024).collect(), corpus.collect(), 1024)
    assert used <= 1.02 * least + 1


def test_best_fit_takes_the_successor():
    runs = packing.best_fit({60: 1, 50: 1, 40: 1, 50 - 1: 1}, 100)
    place = {(length, first): sequence for length, first, _, sequence, _ in runs}
    assert place[(40, 0)] == place[(60, 0)] and place[(49, 0)] == place[(50, 0)]


def test_ids_are_carried_on_request(odd_docs):
    for row in packing.pack(odd_docs, 64, with_ids=True).collect():
        assert len(row.ids) == row.length and crc(row.ids) == row.ids_crc32
