from __future__ import annotations

import random
from pathlib import Path

import pytest
from corpus import SCHEMA, edge_documents, edge_table, empty_table, prose

from skymeter.llm import lines
from skymeter.llm.lines import remove_repeated_lines
from skymeter.session import work_root

FAR_AWAY = (1 << 63) - 1


def plain_removed(documents, least_words):
    """Lines of later copies, from the longest earlier match at every line."""
    distinct = sorted({(FAR_AWAY if i is None else i, i is None, t) for i, t in documents if t is not None})
    places = [(d, n, line) for d, (_, _, t) in enumerate(distinct) for n, line in enumerate(t.split("\n")) if line.encode().split()]
    removed = [set() for _ in distinct]
    for p in range(len(places)):
        longest = 0
        for q in range(p):
            k = 0
            while (
                p + k < len(places)
                and places[p + k][2] == places[q + k][2]
                and places[p + k][0] == places[p][0]
                and places[q + k][0] == places[q][0]
            ):
                k += 1
            longest = max(longest, k)
        if longest and sum(len(places[p + i][2].encode().split()) for i in range(longest)) >= least_words:
            removed[places[p][0]] |= set(range(places[p][1], places[p + longest - 1][1] + 1))
    return {(None if null else i, t): sorted(r) for (i, null, t), r in zip(distinct, removed, strict=True)}


def check(df, documents, least_words):
    expected = plain_removed(documents, least_words)
    rows = remove_repeated_lines(df.withColumn("before", df["text"]), least_words=least_words).collect()
    assert len(rows) == len(documents)
    for r in rows:
        if r.before is None:
            assert r.text is None and r.removed_lines == []
            continue
        gone = expected[r.doc_id, r.before]
        assert r.removed_lines == gone
        assert r.text == "\n".join(x for n, x in enumerate(r.before.split("\n")) if n not in gone)


@pytest.mark.parametrize(("seed", "range_lines"), [(0, 4096), (1, 4096), (2, 3), (3, 4), (0, 1), (1, 2)])
def test_random_documents_equal_the_longest_earlier_matches(spark, monkeypatch, seed, range_lines):
    """Few distinct lines of few words: many overlapping and nested repeats, also within documents."""
    monkeypatch.setattr(lines, "RANGE_LINES", range_lines)
    rng = random.Random(seed)
    known = ["a", "b b", "c c c", "", "d", "  ", "e e e e e"][: rng.randint(3, 7)]
    documents = [(i, "\n".join(rng.choices(known, k=rng.randint(0, 14)))) for i in range(12)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in documents], SCHEMA)
    check(df, documents, rng.choice([3, 6, 10]))


def test_long_runs_and_copies(spark):
    rng = random.Random(5)
    run = "\n".join(prose(rng, rng.randint(1, 12)) for _ in range(30))
    documents = [(i, f"{prose(rng, 9)}\n{run}\n{prose(rng, 7)}") for i in range(4)]
    documents += [(20 + i, documents[0][1]) for i in range(3)]
    documents += [(40, "\n".join(run.split("\n")[5:9]) + "\n" + prose(rng, 5)), (41, "\n".join(["x y"] * 70))]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in documents], SCHEMA)
    check(df, documents, 50)


def test_white_space_is_that_of_ascii(spark):
    """Lines of no-break spaces count, with a word each; those of tabs and form feeds do not."""
    odd = "\n".join(["\u00a0", "\x1c \x85", "\t\x0b\x0c", "a\u00a0b \u2003"] * 3)
    documents = [(1, f"x\n{odd}\ny"), (2, f"z\n{odd}\nw"), (3, "\u00a0")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in documents], SCHEMA)
    check(df, documents, 14)
    rows = {r.doc_id: r.removed_lines for r in remove_repeated_lines(df, least_words=14).collect()}
    assert rows[2] == list(range(1, 13))


def test_a_document_of_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(lines, "RANGE_LINES", 64)
    rng = random.Random(8)
    part = [prose(rng, rng.randint(1, 3)) for _ in range(180)]
    documents = [(1, "\n".join(part)), (2, "\n".join(["x", *part[20:150], "y", *part[100:]]))]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in documents], SCHEMA)
    check(df, documents, 40)


def test_only_the_runs_stay_stored(spark):
    folder = Path(work_root(spark).removeprefix("file://")) / "skymeter"
    before = {p.name for p in folder.iterdir()} if folder.is_dir() else set()
    remove_repeated_lines(edge_table(spark), removed="gone").count()
    left = {p.name for p in folder.iterdir()} - before
    assert {n.rsplit("-", 1)[0] for n in left} == {"runs", "kept-runs"}


def test_short_repeats_stay(spark):
    rng = random.Random(6)
    shared = prose(rng, 49)
    documents = [(i, f"{shared}\n{prose(rng, 20)}") for i in range(5)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in documents], SCHEMA)
    assert all(r.removed_lines == [] for r in remove_repeated_lines(df).collect())


def test_edge_cases(spark):
    df = edge_table(spark).drop("removed_lines")
    check(df, [d[:2] for d in edge_documents()], 50)
    kept = remove_repeated_lines(edge_table(spark), removed="gone")
    assert kept.columns == [*edge_table(spark).columns, "gone"]
    assert remove_repeated_lines(empty_table(spark), removed="gone").count() == 0


def test_repeated_and_null_id_rows_count_once(spark):
    """Runs of five and more lines in rows that are there again, and very often."""
    rng = random.Random(7)
    run = "\n".join(prose(rng, 11) for _ in range(7))
    texts = [f"{prose(rng, 9)}\n{run}\n{prose(rng, 7)}" for _ in range(3)]
    documents = [(1, texts[0])] * 2 + [(2, texts[1])] * 3 + [(None, texts[2])] * 2 + [(3, run + "\n" + prose(rng, 4))]
    documents += [(4, f"{run}\nx\n{run}")] * 30
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in documents], SCHEMA)
    check(df, documents, 50)
