from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from corpus import SCHEMA, WORDS, edge_documents, edge_table, empty_table, prose, sf_documents

from skymeter.llm import languages
from skymeter.llm.languages import Model, fit, held_out, keep_identified, predict, trigrams


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(6)
    rows = []
    for i in range(160):
        lang = rng.choice(["en", "de", "fr"])
        rows.append((i, prose(rng, rng.randint(20, 80), lang), lang if i % 9 else None, "s", 1))
    return spark.createDataFrame(rows, SCHEMA), {r[0]: r for r in rows}


def test_held_out_accuracy(spark, table):
    df, _ = table
    for documents in (df, sf_documents(spark)):
        rows = {r.doc_id: r for r in documents.collect()}
        found = predict(documents, fit(documents)).withColumn("held_out", held_out()).collect()
        tested = [r for r in found if r.held_out and rows[r.doc_id].lang is not None]
        assert len(tested) > 20 and all(is_held_out(r.doc_id) == r.held_out for r in found)
        assert np.mean([r.lang_pred == rows[r.doc_id].lang for r in tested]) >= 0.97
        assert all(0 <= r.score <= 1 for r in found)


def test_only_the_learning_part_is_learned_from(spark, table):
    """Labels that are held out, or of rows without an id, change nothing."""
    _, rows = table
    changed = [(i, t, "xx" if is_held_out(i) else lang, s, n) for i, t, lang, s, n in rows.values()]
    changed.append((None, "some text of no use", "yy", "s", 1))
    first, second = (fit(spark.createDataFrame(r, SCHEMA)) for r in (list(rows.values()), changed))
    assert first.languages == second.languages == ["de", "en", "fr"]
    assert np.array_equal(first.table, second.table)


def test_trigrams_equal_plain_counts():
    def plain(text):
        shown = "".join(c if c.isalpha() else " " for c in text.lower())
        return len(" ".join(["", *shown.split(), ""])) - 2 if shown.split() else 0

    for text in ["", "a", "Ab, c", "é1ü", " x  y ", "日本語"]:
        assert len(trigrams(text)) == max(0, plain(text)), text
    assert np.array_equal(trigrams("Ab--c"), trigrams("aB c"))


def test_mixtures_list_their_languages(table):
    df, _ = table
    model = fit(df)
    rng = random.Random(1)
    lang, share, names, background = model.predict(prose(rng, 120, "en") + " " + prose(rng, 60, "fr"))
    assert lang == "en" and set(names) == {"en", "fr"} and 0.5 < share < 0.8 and background < 0.1
    assert model.predict(prose(rng, 100, "de"))[2] == ["de"]


def test_shares_reach_the_best_likelihood(table):
    """Expectation-maximisation against a grid of mixtures."""
    df, _ = table
    model = fit(df)
    rng = random.Random(2)
    counts = np.bincount(trigrams(prose(rng, 40, "en") + " " + prose(rng, 40, "de")), minlength=1 << 15)
    seen = np.flatnonzero(counts)
    likelihood, counts = model.table[seen][:, :2], counts[seen].astype(float)
    _, fit_value = model.shares(likelihood, counts)
    grid = [counts @ np.log(likelihood @ np.array([p, 1 - p])) for p in np.linspace(0.001, 0.999, 999)]
    assert fit_value >= max(grid) - 0.05


def test_edge_cases(spark, table):
    model = fit(table[0])
    found = predict(edge_table(spark), model).collect()
    assert len(found) == len(edge_documents())
    by_id = {r.doc_id: r for r in found}
    for doc_id in (3, 4, 5, 6):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score, by_id[doc_id].rejected) == ("und", 0.0, True)
    assert by_id[10].lang_pred == "fr" and by_id[11].lang_pred == "de" and by_id[7].lang_pred == "en"
    assert by_id[8].rejected and not by_id[7].rejected and not by_id[1].rejected
    kept = keep_identified(edge_table(spark), model)
    assert kept.columns == edge_table(spark).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(r.doc_id or 0 for r in found if not r.rejected)


def test_without_labels_everything_is_undetermined(spark):
    model = fit(empty_table(spark))
    assert model.languages == [] and predict(empty_table(spark), model).count() == 0
    unlabelled = spark.createDataFrame([(1, "some words", None, "s", 1)], SCHEMA)
    assert predict(unlabelled, fit(unlabelled)).first().lang_pred == "und"


def test_too_many_labels_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(languages, "MOST_LANGUAGES", 3)
    rows = [(i, "text", f"l{i}", "s", 1) for i in range(40)]
    with pytest.raises(ValueError, match="labels"):
        fit(spark.createDataFrame(rows, SCHEMA))


def test_the_sample_is_bounded_for_each_language(spark):
    rng = random.Random(9)
    rows = [(i, WORDS["en"][i % 20] + " " + prose(rng, 5), "en", "s", 1) for i in range(3000)]
    rows += [(10_000 + i, prose(rng, 30, "fr"), "fr", "s", 1) for i in range(8)]
    small = fit(spark.createDataFrame(rows, SCHEMA), sample=100)
    whole = fit(spark.createDataFrame(rows, SCHEMA))
    assert isinstance(small, Model) and small.languages == ["en", "fr"]
    assert small.predict(prose(rng, 40, "fr"))[0] == whole.predict(prose(rng, 40, "fr"))[0] == "fr"
