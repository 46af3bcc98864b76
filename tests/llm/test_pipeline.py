from __future__ import annotations

import random

import corpus_pipeline
import pytest
from corpus import SCHEMA, edge_table, empty_table, prose, sf_documents
from test_lines import plain_removed
from test_simhash import plain_components, plain_fingerprint

from skymeter.llm import secrets
from skymeter.session import materialize


def chained(spark, docs):
    """The stages as the pipeline applies them, with the documents after each but the last."""
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, ""), "stage")
        kept[name] = docs
    return kept, corpus_pipeline.STAGES[-1][1](spark, docs, "")


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(12)
    run = "\n".join(prose(rng, 20) for _ in range(4))
    texts = [prose(rng, rng.randint(40, 120), rng.choice(["en", "de", "fr"])) for _ in range(40)]
    texts += [f"{prose(rng, 30)}\n{run}\n{prose(rng, 30)}" for _ in range(3)]
    texts += [texts[0], texts[1] + " \n"] + [" ".join(texts[2].split())]
    texts += [f"{prose(rng, 60)} token = \"{'0123456789abcdef' * 2}\" {prose(rng, 20)}", "12 34", "", run]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(len(texts), None, None, "s", None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_stages_equal_plain_versions(spark, documents):
    given = {r.doc_id: r.text for r in documents.collect()}
    kept, packed = chained(spark, documents)
    assert list(kept) == ["language ID", "line dedup", "SimHash near-dedup", "secret scans"]
    after = {name: {r.doc_id: r.text for r in df.collect()} for name, df in kept.items()}

    # Only documents without a letter go.
    assert after["language ID"] == {i: t for i, t in given.items() if t and any(c.isalpha() for c in t)}

    removed = plain_removed(list(after["language ID"].items()), 50)
    cut = {
        i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone) for (i, t), gone in removed.items()
    }
    emptied = {i for (i, t), gone in removed.items() if gone and not cut[i].split()}
    assert emptied and after["line dedup"] == {i: t for i, t in cut.items() if i not in emptied}

    prints = {i: plain_fingerprint(t) for i, t in after["line dedup"].items()}
    label = plain_components(sorted(set(prints.values())))
    first = {}
    for i in sorted(prints):
        first.setdefault(label[prints[i]], i)
    assert after["SimHash near-dedup"] == {i: after["line dedup"][i] for i in first.values()}

    assert set(after["secret scans"]) == set(after["SimHash near-dedup"])
    for i, text in after["SimHash near-dedup"].items():
        if secrets.rule_findings(text):
            assert secrets.REDACTED in after["secret scans"][i] and "0123456789abcdef" not in after["secret scans"][i]
        else:
            assert after["secret scans"][i] == text
    assert all(r.n_chars == len(r.text) for df in kept.values() for r in df.collect())
    assert {r.doc_id for r in packed.collect()} == set(after["secret scans"])


def test_run_equals_the_stages(spark, tmp_path, documents):
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    _, packed = chained(spark, documents)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, str(tmp_path)).select(*columns).collect()
    assert sorted(got) == sorted(packed.select(*columns).collect())


def test_columns_stay_and_edge_cases_run(spark):
    table = edge_table(spark)
    kept, packed = chained(spark, table)
    assert all(df.columns == table.columns for df in kept.values()) and packed.count() > 0
    kept, packed = chained(spark, empty_table(spark))
    assert packed.count() == 0


def test_clean_documents_of_the_given_table_stay(spark):
    documents = sf_documents(spark)
    kept, _ = chained(spark, documents)
    assert kept["language ID"].count() >= 0.99 * documents.count()
