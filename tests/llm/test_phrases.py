from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from corpus import edge_documents, edge_table, empty_table, prose, sf_documents

from skymeter.llm import phrases


def plain_collocations(documents, least=30, longest=4, most=2000):
    """The same from one dictionary of all phrases; ``documents`` are texts with their language."""
    counts, totals = Counter(), Counter()
    for text, lang in documents:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: n for p, n in counts.items() if n >= least and len(p) > 2}
    dropped = set()
    for (lang, *words), n in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                inner = (lang, *words[i : i + k])
                if 100 * n >= 80 * candidates[inner]:
                    dropped.add(inner)
    found = {}
    for phrase, a in candidates.items():
        if phrase in dropped:
            continue
        lang, *words = phrase
        cuts = [(counts[lang, *words[:k]], counts[lang, *words[k:]]) for k in range(1, len(words))]
        score, k = min((2_000_000 * a // (l + r), k) for k, (l, r) in enumerate(cuts))
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), *cuts[k]))
    return sorted(
        (lang, i, p.decode(), -a, l, r, totals[lang], -score)
        for lang, rows in found.items()
        for i, (score, a, p, l, r) in enumerate(sorted(rows)[:most], 1)
    )


def checked(df, **options):
    names = {"least": "least_count"}
    found = phrases.collocations(df, **{names.get(k, k): v for k, v in options.items()})
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = sorted(map(tuple, found.collect()))
    assert got == plain_collocations([(r.text, r.lang) for r in df.collect()], **options)
    return got


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(4)
    rows = [(prose(rng, 200, lang), lang) for lang in ("en", "de", "fr") for _ in range(15)]
    rows += [("New York City is big, new york city; NEW YORK! São Paulo é. a\tb\x0bc\x1cd", None)] * 40
    rows += [("x y " * 50 + "x . y x", "und"), ("", "en"), (None, "en"), ("...", "xx"), ("a b c d e " * 31, "rep")]
    return spark.createDataFrame(rows, "text string, lang string")


@pytest.mark.parametrize("options", [{}, {"least": 2}, {"least": 5, "longest": 3}, {"least": 5, "longest": 2, "most": 7}])
def test_equals_a_plain_version(texts, options):
    assert checked(texts, **options)


def test_small_buffers_slices_and_tables_change_nothing(texts, monkeypatch):
    expected = checked(texts, least=3)
    monkeypatch.setattr(phrases, "HELD", 500)
    monkeypatch.setattr(phrases, "SLICE", 7)
    monkeypatch.setattr(phrases, "HOT_SHARE", 10)
    assert checked(texts, least=3) == expected


def test_bundles_of_a_task():
    counter = phrases.Counter(2, phrases.Known(None, np.zeros(0, np.uint64), 2))
    assert list(counter.add("en", "One two three, one two. " * 3)) == []
    rows = [r for batch in counter.bundles() for r in batch.to_pylist()]
    assert list(counter.bundles()) == []
    assert len(rows) == len({r["bucket"] for r in rows}) <= 2
    counted = {}
    for line in (line for row in rows for line in row["stripes"].split("\n")):
        prefix, words, counts = line.split("\t")
        counted |= {(prefix, w): int(n) for w, n in zip(words.split(" "), counts.split(" "))}
    assert counted == {("one", "two"): 6, ("two", "three"): 3}


@pytest.mark.parametrize("text", ["one twenty, three.four  five\nsix" * 20, "no end " * 20, "...", "", " ", "\t. x\x1cy\x85z \u00a0"])
def test_parts_keep_pieces_whole(monkeypatch, text):
    expected = [w for piece in re.split("[.,;:!?\x0a-\x0d]", text) for w in [*re.findall("[^ \t]+", piece), "."]]
    for size in (10**6, 3):
        monkeypatch.setattr(phrases, "SLICE", size)
        got = phrases.words_of(list(phrases.pieces(text))).to_pylist()
        # Ends of pieces without words between them are one end.
        joined = [w for i, w in enumerate(got) if w != "." or (i and got[i - 1] != ".")]
        assert joined == [w for i, w in enumerate(expected) if w != "." or (i and expected[i - 1] != ".")]


def test_a_full_bit_table_only_costs_more(texts, monkeypatch):
    expected = checked(texts, least=3)
    full = phrases.FrequentPhrases(np.full(phrases.TABLE_BITS // 64, 2**64 - 1, np.uint64))
    monkeypatch.setattr(phrases, "frequent_phrases", lambda spark, found: full)
    assert checked(texts, least=3) == expected


def test_given_documents(spark):
    assert checked(sf_documents(spark).select("text", "lang"), least=10)


def test_edge_cases(spark):
    got = sorted(map(tuple, phrases.collocations(edge_table(spark), least_count=4).collect()))
    assert got == plain_collocations([(d[1], d[2]) for d in edge_documents()], least=4)
    assert phrases.collocations(empty_table(spark)).collect() == []
    with pytest.raises(ValueError):
        phrases.collocations(edge_table(spark), longest=5)


def test_a_hot_prefix_is_split(spark):
    rows = spark.range(20_000).selectExpr("concat('the w', id % 5000, ' . the w', id % 5000) AS text", "'en' AS lang")
    hot = phrases._mixed([phrases._hashes([b"en"]), phrases._hashes([b"the"])])
    for known, least in ((hot, 40), (hot[:0], 1)):
        sent = phrases.stripes(rows, 2, phrases.Known(None, known, 1024)).select("bucket").distinct().count()
        assert sent >= least
