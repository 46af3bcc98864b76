from __future__ import annotations

import math
import random

import public_tokenizers
import pytest
import sentencepiece
from corpus import edge_documents, edge_table, empty_table, sf_documents
from models import unigram_model

from skymeter.llm import pieces
from skymeter.llm import token_counts as token_counts_module
from skymeter.llm.token_counts import UNKNOWN_PENALTY, CountTrie, token_counts, unigram_scores

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.read(PATH)


@pytest.fixture(scope="module")
def trie(model):
    return CountTrie(model)


def plain_count(text, scores, model):
    """The best split of the whole text, over all pieces at all places."""
    text = pieces.normalized(text, model)
    unknown = min(scores.values()) - UNKNOWN_PENALTY
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(text)
    for end in range(1, len(text) + 1):
        for begin in range(max(0, end - 20), end):
            score = scores.get(text[begin:end])
            if score is not None and best[begin][0] + score > best[end][0]:
                best[end] = (best[begin][0] + score, best[begin][1] + 1)
        if text[end - 1] not in scores and best[end - 1][0] + unknown > best[end][0]:
            best[end] = (best[end - 1][0] + unknown, best[end - 1][1] + len(text[end - 1].encode()))
    return best[-1][1]


def test_counts_equal_the_library_as_a_unigram_model(spark, trie):
    data, _ = unigram_model(PATH)
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["", " ", "  a  b ", "a\nb\n\n c", "日本語 テスト", "é 🎉\ta", "x" * 200, "hello world, this is a test"]
    texts += [r.text[:2000] for r in sf_documents(spark).limit(80).collect()]
    assert [trie.count(t)[1] for t in texts] == [len(library.encode(t)) for t in texts]


def test_counts_equal_dynamic_programming_over_whole_texts(model, trie):
    rng = random.Random(3)
    scores = unigram_scores(model)
    for _ in range(150):
        text = "".join(rng.choice("theinga  .,\nxé日") for _ in range(rng.randint(0, 60)))
        assert trie.count(text)[1] == plain_count(text, scores, model), text


def test_prefixes_are_scored_once_and_forgetting_changes_nothing(model):
    trie = CountTrie(model)
    trie.count("walk walks walking walked")
    assert len(trie.forward) == 1 + len({"▁walking"[:i] for i in range(1, 9)} | {"▁walks", "▁walke", "▁walked"})
    small = CountTrie(model, most_nodes=10)
    texts = ["walk walks walking", "the river", "walk walks walking"] * 3
    assert [small.count(t) for t in texts] == [trie.count(t) for t in texts]


def test_long_parts_take_no_nodes(model, monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choice("theinga日é") for _ in range(n)) for n in (199, 201, 900)] + ["x" * 3_000, "the" * 500]
    short = CountTrie(model)
    counts = [short.count(t) for t in texts]
    nodes = len(short.forward)
    assert nodes <= 201 and len(short.counts) == 1
    assert short.count("ab" * 150_000)[1] > 0 and len(short.forward) == nodes
    scores = unigram_scores(model)
    assert [n for _, n in counts] == [plain_count(t, scores, model) for t in texts]
    monkeypatch.setattr(token_counts_module, "LONG_PART", 10**9)
    assert [CountTrie(model).count(t) for t in texts] == counts


def test_documents_and_edge_cases(spark, model):
    scores = unigram_scores(model)
    documents = sf_documents(spark).limit(25)
    for r in documents.join(token_counts(documents, PATH), "doc_id").collect():
        assert r.n_tokens == plain_count(r.text, scores, model)
    rows = token_counts(edge_table(spark), PATH).collect()
    assert len(rows) == len(edge_documents())
    assert {(r.n_parts, r.n_tokens) for r in rows if r.doc_id in (3, 4)} == {(0, 0)}
    short = {str(d[0]): d[1] for d in edge_documents() if d[1] and len(d[1]) < 3000 and d[0] not in (1, None)}
    for r in rows:
        if str(r.doc_id) in short:
            assert r.n_tokens == plain_count(short[str(r.doc_id)], scores, model)
    assert token_counts(empty_table(spark), PATH).count() == 0
