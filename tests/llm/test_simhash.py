from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from corpus import SCHEMA, edge_documents, edge_table, empty_table, prose, sf_documents

from skymeter.llm.components import components
from skymeter.llm.simhash import fingerprint, golay_keys, golay_patterns, keep_one, near_duplicates, near_links

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    counts = [0] * 64
    for shingle in shingles:
        value = xxhash.xxh64_intdigest(shingle.encode(), 42)
        for bit in range(64):
            counts[bit] += value >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def plain_components(keys):
    """Smallest key reachable over pairs at most two bits apart, by comparing all."""
    label = {k: k for k in keys}
    changed = True
    while changed:
        changed = False
        for a in keys:
            for b in keys:
                if (a ^ b).bit_count() <= 2 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def plain_result(documents):
    prints = [plain_fingerprint(text) for _, text in documents]
    label = plain_components(sorted(set(prints)))
    ids = defaultdict(list)
    for (doc_id, _), p in zip(documents, prints, strict=True):
        if doc_id is not None:
            ids[label[p]].append(doc_id)
    return Counter(
        (doc_id, f"{p:016x}", min(ids[label[p]], default=None))
        for (doc_id, _), p in zip(documents, prints, strict=True)
    )


def result(df):
    return Counter((r.doc_id, f"{r.fingerprint & (2**64 - 1):016x}", r.component_id) for r in df.collect())


def test_vectors_two_bits_apart_share_a_golay_key():
    patterns = golay_patterns()
    assert Counter((patterns >= 0).sum(axis=1).tolist()) == {1: 277, 6: 1771}
    rng = np.random.default_rng(5)
    # The code is linear, so error patterns of every kind around random vectors stand for all.
    vectors = rng.integers(0, 1 << 23, 200)
    flips = [0] + [1 << i for i in range(23)] + [1 << i | 1 << j for i in range(23) for j in range(i)]
    keys = golay_keys(vectors, patterns)
    for flip in flips:
        other = golay_keys(vectors ^ flip, patterns)
        shared = ((keys[:, :, None] == other[:, None, :]) & (keys >= 0)[:, :, None]).any(axis=(1, 2))
        assert shared.all()


def test_fingerprint_equals_the_plain_one(spark):
    texts = [t for _, t, *_ in edge_documents()] + [r.text for r in sf_documents(spark).limit(30).collect()]
    for text in texts + ["A b", "a  B\x0bc\x0cD", "a\x1cb", " x"]:
        assert fingerprint(text) & (2**64 - 1) == plain_fingerprint(text)


@pytest.mark.parametrize("paired", [1000, 1])
def test_links_connect_all_near_fingerprints(spark, paired):
    """Near, chained and far fingerprints, with and without midpoints."""
    rng = random.Random(2)
    keys = set()
    for _ in range(12):
        key = rng.getrandbits(64)
        for _ in range(8):
            keys.add(key)
            key ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 2, 3])))
    keys |= {0, 2**64 - 1, 2**63, 2**63 | 1}
    signed = [k - (k >> 63 << 64) for k in keys]
    table = spark.createDataFrame([(k,) for k in signed], "fingerprint long")
    links = near_links(table, paired)
    assert all((r.a ^ r.b) & (2**64 - 1) and ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 for r in links.collect())
    label = {k: k for k in signed} | {r.node: r.label for r in components(links).collect()}
    groups, expected = defaultdict(set), defaultdict(set)
    for k in signed:
        groups[label[k]].add(k)
    for k, l in plain_components([k & (2**64 - 1) for k in signed]).items():
        expected[l].add(k - (k >> 63 << 64))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(7, 8), (8, 9), (9, 7), (3, 3)]
    rng.shuffle(edges)
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {i: 100 for i in range(101, 161)} | {i: 500 for i in range(501, 540)} | {8: 7, 9: 7}
    assert found == expected


def test_documents_against_comparing_all(spark):
    documents = sf_documents(spark)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(near_duplicates(documents)) == plain_result(rows)


def test_edge_cases(spark):
    assert result(near_duplicates(edge_table(spark))) == plain_result([d[:2] for d in edge_documents()])
    assert near_duplicates(empty_table(spark)).count() == 0
    only_null = spark.createDataFrame([(None, "a b c d")] * 2, "doc_id long, text string")
    assert {r.component_id for r in near_duplicates(only_null).collect()} == {None}


def test_one_of_each_component_stays(spark):
    rng = random.Random(8)
    text, other = prose(rng, 300), prose(rng, 300)
    rows = [(5, text), (3, text), (3, text), (3, other), (None, text + "\n"), (None, "alone"), (9, None), (8, "")]
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    kept = [(r.doc_id, r.text) for r in keep_one(table).collect()]
    assert sorted(kept, key=str) == sorted([(3, text), (3, other), (None, "alone"), (8, "")], key=str)
    edge = keep_one(edge_table(spark))
    assert edge.columns == edge_table(spark).columns
    assert edge.count() == len({c for _, _, c in plain_result([d[:2] for d in edge_documents()])})
    assert keep_one(empty_table(spark)).count() == 0
