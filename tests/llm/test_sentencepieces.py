from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from corpus import edge_documents, edge_table, empty_table, sf_documents
from models import unigram_model

from skymeter.llm import pieces, sentencepieces
from skymeter.llm.sentencepieces import Codec, build, decoded, encoded, verified

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  a  b ", "a\nb\n\n c", "日本語 テスト", "\n", "é 🎉\ta", "</s> <s> <unk> <0x0A>", "x" * 300,
    "İ\x00\x01  z", "é ﬁ", "a b", "-- == 123,456.78 $%^",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_and_texts_equal_the_library(spark, library):
    texts = ODD + ["▁x ▁ y"] + [r.text for r in sf_documents(spark).collect()]
    expected = library.encode(texts)
    for cached in (10**6, 40):
        codec = Codec(PATH, cached)
        got = [codec.encode(texts[i : i + 9]) for i in range(0, len(texts), 9)]
        ids = [list(x) for part, _ in got for x in part]
        assert ids == expected and not any(n for _, differing in got for n in differing)
        assert [codec.decode(np.array(i, np.int32)) for i in ids] == library.decode(expected)


def test_whole_texts_through_the_tokeniser_equal_the_library(library):
    tokenizer = build(pieces.read(PATH))
    for text in ODD:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == library.encode(text)
        assert tokenizer.decode(ids) == library.decode(ids)


def test_unigram_models_equal_the_library():
    """The same pieces, scored as a unigram model."""
    data, _ = unigram_model(PATH)
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    model = pieces.parse(data)
    assert model.model_type == pieces.UNIGRAM
    tokenizer = build(model)
    # Runs of one letter have several best splits.
    texts = [t for t in ODD if "<0x" not in t and "xxx" not in t] + ["the house by the river", "walking and running", "</s> <s> <unk>"]
    for text in texts:
        assert tokenizer.encode(text, add_special_tokens=False).ids == library.encode(text)


def test_the_protobuf_is_read_like_the_library_reads_it(library):
    model = pieces.read(PATH)
    n = library.get_piece_size()
    assert model.pieces == [library.id_to_piece(i) for i in range(n)]
    assert np.allclose(model.scores, [library.get_score(i) for i in range(n)])
    assert [k == pieces.CONTROL for k in model.kinds] == [library.is_control(i) for i in range(n)]
    assert [k == pieces.BYTE for k in model.kinds] == [library.is_byte(i) for i in range(n)]
    assert model.unknown == library.unk_id()


def test_bytes_that_are_no_text_are_decoded_by_the_tokeniser():
    codec = Codec(PATH)
    ids = np.array([codec.model.pieces.index("<0xFF>"), codec.model.pieces.index("▁the")], np.int32)
    assert "the" in codec.decode(ids)


def test_differing_parts_are_counted():
    """Against a library that lacks a piece."""
    codec = Codec(PATH)
    data = Path(PATH).read_bytes()
    assert b"\x0a\x06" + "▁the".encode() in data
    data = data.replace(b"\x0a\x06" + "▁the".encode(), b"\x0a\x06" + "▁~~~".encode(), 1)
    codec.library = sentencepiece.SentencePieceProcessor(model_proto=data)
    _, differing = codec.encode(["the end of the day", "xyz"])
    assert differing == [2, 0]


def test_round_trip_of_documents(spark, library):
    rows = verified(sf_documents(spark), PATH).collect()
    texts = {r.doc_id: r.text for r in sf_documents(spark).collect()}
    assert len(rows) == len(texts) and all(r.restored and r.differing_parts == 0 for r in rows)
    for r in rows:
        ids = np.array(library.encode(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_edge_cases(spark):
    rows = verified(edge_table(spark), PATH).collect()
    assert len(rows) == len(edge_documents())
    assert {(r.n_tokens, r.restored) for r in rows if r.doc_id in (3, 4)} == {(0, True)}
    assert all(r.restored and r.differing_parts == 0 for r in rows)
    assert verified(empty_table(spark), PATH).count() == encoded(empty_table(spark), PATH).count() == 0
    both = decoded(encoded(edge_table(spark), PATH), PATH).collect()
    expected = sorted((str(d[0]), d[1] or "") for d in edge_documents())
    assert sorted((str(r.doc_id), r.text) for r in both) == expected


def test_models_with_spaces_inside_pieces_are_refused(monkeypatch):
    monkeypatch.setattr(pieces.PieceModel, "is_cut_at_spaces", lambda self: False)
    with pytest.raises(ValueError, match="whole texts"):
        sentencepieces.Codec(PATH)
