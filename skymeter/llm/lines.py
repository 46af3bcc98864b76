"""Removal of repeated runs of lines by a suffix array over line ids.

A run is a sequence of consecutive non-blank lines. A run of at least ``least_words``
words that occurs again, in another document or the same one, is kept where it occurs
first (by document id, then line) and deleted wherever it occurs later.

Lines that occur again get dense ids in the order of their hash. Suffixes of the line-id
sequences are then ranked by prefix doubling: the rank of a suffix by its first ``2k``
lines is the dense rank of the pair of ranks by ``k`` lines here and ``k`` lines further
on, where only pairs that occur again are ranked. A run of any length is an interval of
the suffix array, named by the ranks of the two overlapping power-of-two runs it consists
of; the interval's first suffix in document order is kept.

A run with enough words is covered by its shortest parts with enough words: those from
each of its lines onwards, and those up to each of its lines. So it is enough to look at
such shortest runs, and the array has to be refined only up to their length: at most
``least_words`` lines, whatever the length of copies.

Defined cases: a NULL text stays NULL; blank lines never count, and go if they lie inside
a deleted shortest run (between two of them they stay); NULL ids come last in the order of documents; rows with equal id and text
are one document and treated alike; a document all of whose lines are deleted keeps an
empty text; overlapping repeats within a document count as later copies. Lines are equal
if their 128-bit hashes are. Words are what stands between ASCII white space, so a line of
no-break spaces has one. Very long documents are looked at in ranges of lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from skymeter.llm.batches import give_back, in_text_batches, map_texts
from skymeter.llm.columns import unused
from skymeter.operators.graph import dense_ids
from skymeter.session import load, materialize, scratch, store, stored_for_join

LEAST_WORDS = 50
NO_ID = (1 << 63) - 1
# Lines of a document whose runs are looked for at once.
RANGE_LINES = 4_096

LINES = "doc long, body long, seq int, line int, words long, before long, high long, low long"


def _identity(doc_id: str, text: str) -> list[Column]:
    """Two keys that identify a document, of which the first is its place in the order."""
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(F.col(doc_id).isNull(), F.col(text)).alias("body"),
    ]


def document_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The non-blank lines: place among them and in the text, words, words before, hash."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in LINES.split(", ")]
        for batch in batches:
            rows: list[int] = []
            seqs, numbers, counts, befores, digests = [], [], [], [], []
            for row, value in enumerate(batch.column(2)):
                before, seq = 0, 0
                # Bytes have only ASCII white space.
                for number, line in enumerate(value.as_py().encode().split(b"\n")):
                    words = len(line.split())
                    if words:
                        rows.append(row)
                        seqs.append(seq)
                        numbers.append(number)
                        counts.append(words)
                        befores.append(before)
                        digests.append(xxhash.xxh3_128_digest(line))
                        seq, before = seq + 1, before + words
            halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array(seqs, pa.int32()),
                    pa.array(numbers, pa.int32()),
                    pa.array(counts, pa.int64()),
                    pa.array(befores, pa.int64()),
                    pa.array(np.ascontiguousarray(halves[:, 0])),
                    pa.array(np.ascontiguousarray(halves[:, 1])),
                ],
                names,
            )

    chosen = documents.filter(F.col(text).isNotNull()).select(*_identity(doc_id, text), F.col(text).alias("text"))
    return map_texts(_one_row_each(chosen), split, LINES)


def _one_row_each(chosen: DataFrame) -> DataFrame:
    """``doc, body, text`` without the further rows of repeated documents.

    As long as the keys of repeated documents can be broadcast, only their texts are moved.
    """
    counts = chosen.groupBy("doc", "body").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").drop("rows")
    repeated = stored_for_join(counts, "repeated")
    once = chosen.join(repeated, ["doc", "body"], "left_anti")
    merged = chosen.join(repeated, ["doc", "body"], "left_semi").groupBy("doc", "body").agg(F.min("text").alias("text"))
    return once.union(merged)


def _ranked(rows: DataFrame, first: str, second: str) -> DataFrame:
    """``rows`` whose pair of values occurs again, with the pair's dense rank as ``rank``."""
    pairs = rows.groupBy(first, second).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    ranks = dense_ids(pairs.select(F.struct(first, second).alias("pair")), "pair", "rank")
    ranks = ranks.select(F.col(f"pair.{first}").alias(first), F.col(f"pair.{second}").alias(second), "rank")
    return rows.join(ranks, [first, second]).drop(first, second)


def suffix_ranks(lines: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc, body, seq, level, rank, ...``: ranks of suffixes by their first 2^level lines.

    Only runs that occur again have a rank, and only as far as shortest runs with enough
    words are made of them: a run that has enough words without its first and without its
    last line lies in none.
    """
    start = lines.select(
        "doc",
        "body",
        "seq",
        F.lit(0).alias("level"),
        "line",
        F.col("words").alias("first_words"),
        F.col("words").alias("last_words"),
        "before",
        (F.col("before") + F.col("words")).alias("after"),
        "high",
        "low",
    )
    columns = [c for c in start.columns if c not in ("high", "low")] + ["rank"]
    spark = lines.sparkSession
    rows, levels = _ranked(start, "high", "low").select(*columns), []
    while True:
        seen = Observation()
        path = store(rows, "ranks", seen, [F.count(F.lit(1)).alias("rows")])
        current = load(spark, path, rows.schema)
        if not seen.get["rows"]:
            break
        levels.append(current)
        # A run of 2^level lines has at least as many words.
        step = 1 << (len(levels) - 1)
        if step >= least_words:
            break
        further = current.select(
            "doc",
            "body",
            (F.col("seq") - step).alias("seq"),
            F.col("last_words").alias("end_words"),
            F.col("after").alias("end"),
            F.col("rank").alias("second"),
        )
        words = F.col("end") - F.col("before")
        inside = (words - F.col("first_words") < least_words) | (words - F.col("end_words") < least_words)
        paired = current.join(further, ["doc", "body", "seq"]).filter(inside)
        paired = paired.select(
            "doc",
            "body",
            "seq",
            F.lit(len(levels)).alias("level"),
            "line",
            "first_words",
            F.col("end_words").alias("last_words"),
            "before",
            F.col("end").alias("after"),
            F.col("rank").alias("first"),
            "second",
        )
        rows = _ranked(paired, "first", "second").select(*columns)
    found = levels[0] if levels else current
    for level in levels[1:]:
        found = found.union(level)
    return found


WINDOWS = "doc long, body long, seq int, from_line int, to_line int, lines int, first long, second long"


def shortest_runs(ranks: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The shortest runs with enough words that may occur again, named by two ranks.

    A run has at most ``least_words`` lines, so those that begin in one range of lines
    need only that many lines beyond it.
    """
    fields = ["level", "seq", "line", "before", "after", "rank"]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in WINDOWS.split(", ")]
        for batch in batches:
            found = []
            for doc, body, number, places in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                found += [(doc, body, *w) for w in windows(places) if w[0] // RANGE_LINES == number]
            columns = list(zip(*found, strict=True)) if found else [()] * len(names)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    def windows(places: list[dict]) -> Iterator[tuple]:
        by_level: dict[int, dict[int, int]] = {}
        for p in places:
            by_level.setdefault(p["level"], {})[p["seq"]] = p["rank"]
        lines = sorted((p for p in places if p["level"] == 0), key=lambda p: p["seq"])
        seqs = np.array([p["seq"] for p in lines])
        for part in np.split(np.arange(len(lines)), np.flatnonzero(np.diff(seqs) != 1) + 1):
            yield from segment([lines[i] for i in part], by_level)

    def segment(lines: list[dict], by_level: dict[int, dict[int, int]]) -> Iterator[tuple]:
        words = np.array([p["before"] for p in lines] + [lines[-1]["after"]])
        # The shortest run from each line onwards, and up to each line.
        ends = np.searchsorted(words, words[:-1] + least_words)
        begins = np.searchsorted(words, words[1:] - least_words, "right") - 1
        spans = {(i, int(e)) for i, e in enumerate(ends) if e < len(words)}
        spans |= {(int(b), i + 1) for i, b in enumerate(begins) if b >= 0}
        for begin, end in sorted(spans):
            level = (end - begin).bit_length() - 1
            ranked = by_level.get(level, {})
            first = ranked.get(lines[begin]["seq"])
            second = ranked.get(lines[end - (1 << level)]["seq"])
            if first is not None and second is not None:
                yield lines[begin]["seq"], lines[begin]["line"], lines[end - 1]["line"], end - begin, first, second

    furthest = F.greatest(F.col("seq") - least_words + 1, F.lit(0))
    numbers = F.sequence(*[F.floor(seq / RANGE_LINES).cast("int") for seq in (furthest, F.col("seq"))])
    ranged = ranks.withColumn("range", F.explode(numbers))
    places = ranged.groupBy("doc", "body", "range").agg(F.collect_list(F.struct(*fields)).alias("places"))
    return map_texts(places, runs, WINDOWS)


def later_copies(documents: DataFrame, doc_id: str, text: str, least_words: int) -> DataFrame:
    """``doc, body, runs``: the ranges of lines to delete, one row per document that has any."""
    with scratch(documents.sparkSession) as area:
        lines = materialize(document_lines(documents, doc_id, text), "lines")
        runs = area.result(shortest_runs(suffix_ranks(lines, least_words), least_words), "runs")
    names = ["lines", "first", "second"]
    place = F.struct("doc", "body", "seq")
    kept = runs.groupBy(*names).agg(F.min(place).alias("kept"), F.count(F.lit(1)).alias("copies"))
    # Stored, so that the places of a run with very many are split in the join.
    kept = materialize(kept.filter("copies > 1").drop("copies"), "kept-runs")
    copies = runs.join(kept, names).filter(place != F.col("kept"))
    span = F.struct(F.col("from_line").alias("from"), F.col("to_line").alias("to"))
    return copies.groupBy("doc", "body").agg(F.collect_list(span).alias("runs"))


CUT = StructType([StructField("text", StringType()), StructField("removed", ArrayType(IntegerType()))])


def covered_lines(spans: list[dict] | None) -> list[int]:
    """The numbers of all lines in any of the runs, in order."""
    if not spans:
        return []
    bounds = np.array([(s["from"], s["to"] + 1) for s in spans])
    edges = np.zeros(bounds.max() + 1, np.int32)
    np.add.at(edges, bounds[:, 0], 1)
    np.add.at(edges, bounds[:, 1], -1)
    return np.flatnonzero(np.cumsum(edges) > 0).tolist()


@F.arrow_udf(CUT)
def _cut(texts: pa.Array, runs: pa.Array) -> pa.Array:
    """The texts without the lines of their runs, and the numbers of these lines."""
    rest, numbers = [], []
    for text, spans in zip(texts, runs, strict=True):
        text, removed = text.as_py(), covered_lines(spans.as_py())
        if text is not None and removed:
            gone = set(removed)
            text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
        rest.append(text)
        numbers.append(removed)
    columns = [pa.array(rest, pa.string()), pa.array(numbers, pa.list_(pa.int32()))]
    give_back()
    return pa.StructArray.from_arrays(columns, ["text", "removed"])


def remove_repeated_lines(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_words: int = LEAST_WORDS,
    removed: str = "removed_lines",
) -> DataFrame:
    """The documents with later copies of runs cut from their texts, and the cut lines' numbers.

    All columns of the input stay; ``removed`` is added, an array of line numbers from 0.
    """
    doc, body, runs, cut = (unused(documents, f"_{c}") for c in ("doc", "body", "runs", "cut"))
    found = later_copies(documents, doc_id, text, least_words)
    found = found.select(F.col("doc").alias(doc), F.col("body").alias(body), F.col("runs").alias(runs))
    place, content = _identity(doc_id, text)
    keyed = in_text_batches(documents).withColumns({doc: place, body: content}).join(found, [doc, body], "left")
    found = keyed.withColumn(cut, _cut(F.col(text), F.col(runs)))
    columns = [F.col(f"{cut}.text").alias(c) if c == text else F.col(c) for c in documents.columns]
    return found.select(*columns, F.col(f"{cut}.removed").alias(removed))
