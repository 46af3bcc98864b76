"""Near-duplicates by SimHash fingerprints, found through Golay-code fuzzy hashing.

The binary Golay code has 4096 words of 23 bits, any two of them at least 7 bits apart,
and every 23-bit vector is within 3 bits of exactly one. A vector within 2 bits of its
code word has that word as its only key. One at 3 bits also gets the five words at 4
bits, six keys in all. Then any two vectors at most 2 bits apart share a key.

A 64-bit fingerprint is cut into three segments (21, 21 and 22 bits). If two
fingerprints differ in at most 2 bits, one segment is equal, and the next one differs in
at most 2 bits, so they agree in a key made of the equal segment and a Golay key of the
next: about 16 keys of 33 bits a fingerprint, joined and verified.

Defined cases: a NULL or empty text, or one of white space, has fingerprint 0 and is
linked like any other; repeated rows are documents of their own with one fingerprint;
NULL ids take part and are never the smallest; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skymeter.llm.batches import map_texts
from skymeter.llm.columns import unused
from skymeter.llm.components import components
from skymeter.session import materialize, scratch

SHINGLE_WORDS = 3
SEED = 42
MOST_BITS = 2
# Distinct fingerprints of a key that are compared pair by pair.
PAIRED_FINGERPRINTS = 1000

# The code's length, message length and generator polynomial
# x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
CODE_BITS = 23
MESSAGE_BITS = 12
GENERATOR = 0b110001110101

SEGMENTS = ((0, 21), (21, 21), (42, 22))


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of the word shingles of a text, as a signed 64-bit integer."""
    # Bytes have only ASCII case and ASCII white space.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle_words)))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have, as a signed 64-bit integer."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    common = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(common).view(">i8")[0])


def fingerprints(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    row_key: Column | None = None,
) -> DataFrame:
    """``doc_id, fingerprint`` of every document, and ``row_key`` if one is given."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (fingerprint(t.as_py(), shingle_words) for t in batch.column(1))
            values = pa.array(np.fromiter(found, np.int64, batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column(0), values, *batch.columns[2:]], names)

    keys = [] if row_key is None else [row_key.alias("row_key")]
    chosen = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *keys)
    names = ["doc_id", "fingerprint"] + ["row_key"] * len(keys)
    return map_texts(chosen, hashed, "doc_id long, fingerprint long" + ", row_key string" * len(keys))


def _remainder(vectors: np.ndarray) -> np.ndarray:
    """Syndromes: the vectors, as polynomials, modulo the generator."""
    rest = vectors.copy()
    for bit in range(CODE_BITS - 1, CODE_BITS - MESSAGE_BITS - 1, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - (CODE_BITS - MESSAGE_BITS)), 0)
    return rest


def golay_patterns() -> np.ndarray:
    """For each syndrome the differences to the words that are its keys: 1 or 6, then -1."""
    table = np.full((1 << (CODE_BITS - MESSAGE_BITS), 6), -1, np.int64)
    filled = np.zeros(len(table), np.int64)
    single = 1 << np.arange(CODE_BITS)
    by_weight = [np.zeros(1, np.int64)]
    for _ in range(4):
        longer = (by_weight[-1][:, None] | single)[by_weight[-1][:, None] < single]
        by_weight.append(longer)
    for weight, patterns in enumerate(by_weight):
        for pattern, syndrome in zip(patterns, _remainder(patterns), strict=True):
            # Words at 4 bits are keys only of vectors that are 3 bits from their own.
            if weight < 4 or table[syndrome, 0].bit_count() == 3:
                table[syndrome, filled[syndrome]] = pattern
                filled[syndrome] += 1
    return table


def golay_keys(vectors: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """The 12-bit keys of 23-bit vectors: one row each, six columns, -1 where none."""
    differences = patterns[_remainder(vectors)]
    return np.where(differences < 0, -1, (vectors[:, None] ^ differences) >> (CODE_BITS - MESSAGE_BITS))


def fuzzy_keys(fingerprint_table: DataFrame) -> DataFrame:
    """``key, fingerprint``: the keys under which each fingerprint meets its neighbours."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = golay_patterns()
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            parts = [(values >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
            for i, exact in enumerate(parts):
                fuzzy = golay_keys(parts[(i + 1) % len(parts)], patterns)
                row, column = np.nonzero(fuzzy >= 0)
                keys = ((exact[row] << MESSAGE_BITS | fuzzy[row, column]) << 2) | i
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(values[row].view(np.int64))], ["key", "fingerprint"]
                )

    return fingerprint_table.select("fingerprint").mapInArrow(keyed, "key long, fingerprint long")


def _differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def near_links(distinct: DataFrame, paired: int = PAIRED_FINGERPRINTS) -> DataFrame:
    """Links ``a, b`` that connect all distinct fingerprints at most 2 bits apart.

    Keys with up to ``paired`` fingerprints are joined pair by pair. Fingerprints under
    a fuller key are linked through midpoints instead: two of them at most 2 bits apart
    have a common neighbour within 1 bit of both, and the at most 65 fingerprints around
    a midpoint are all near each other, so each is linked to the smallest of them.
    """
    keys = fuzzy_keys(distinct)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    # Stored, so that the fingerprints of a full key are split in the join.
    shared = materialize(shared, "simhash-shared")
    met = materialize(keys.join(shared, "key"), "simhash-keys")

    few = met.filter(F.col("members") <= paired)
    left = few.select("key", F.col("fingerprint").alias("a"))
    right = few.select("key", F.col("fingerprint").alias("b"))
    near = (F.col("a") < F.col("b")) & (_differing("a", "b") <= MOST_BITS)
    pairs = left.join(right, "key").filter(near).select("a", "b")

    many = met.filter(F.col("members") > paired).select("fingerprint").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    around = many.select("fingerprint", F.explode(flips).alias("flip")).select(
        F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("midpoint"), "fingerprint"
    )
    balls = around.groupBy("midpoint").agg(F.collect_list("fingerprint").alias("near")).filter(F.size("near") > 1)
    stars = balls.select(F.array_min("near").alias("a"), F.explode("near").alias("b")).filter("a <> b")
    return pairs.union(stars)


def near_duplicates(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    paired: int = PAIRED_FINGERPRINTS,
    row_key: Column | None = None,
) -> DataFrame:
    """``doc_id, fingerprint, component, component_id`` of every document.

    ``component`` is the smallest fingerprint of the component, ``component_id`` its
    smallest document id; a ``row_key`` is carried along. Copies share a fingerprint, so
    only distinct fingerprints are linked; the documents come back by one join at the
    end, in which a fingerprint with very many documents is split.
    """
    with scratch(documents.sparkSession) as area:
        hashed = area.result(fingerprints(documents, doc_id, text, shingle_words, row_key), "fingerprints")
        known = area.result(_known_components(hashed, paired), "known")
    return hashed.join(known, "fingerprint").select(*hashed.columns, "component", "component_id")


def _known_components(hashed: DataFrame, paired: int) -> DataFrame:
    """``fingerprint, component, component_id`` of every distinct fingerprint."""
    distinct = materialize(hashed.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct")
    labels = components(near_links(distinct, paired)).withColumnRenamed("node", "fingerprint")
    labelled = distinct.join(labels, "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("label", "fingerprint").alias("component")
    )
    smallest = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    return labelled.join(smallest, "component").select("fingerprint", "component", "component_id")


def keep_one(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near-duplicates: one of each component, with all columns.

    It is the one with the smallest id, then the smallest fingerprint, then the smallest
    MD5 of its text; of rows that are equal in all that, any one stays.
    """
    return one_of_each(documents, near_duplicates(documents, doc_id, text, row_key=row_keys(doc_id, text)), doc_id, text)


def row_keys(doc_id: str, text: str) -> Column:
    """Id and MD5 of the text."""
    return F.concat_ws(":", F.col(doc_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit(""))))


def one_of_each(documents: DataFrame, found: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The first document of each component in ``doc_id, fingerprint, row_key, component``."""
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "fingerprint", "row_key")
    first = found.groupBy("component").agg(F.min(order).alias("first"))
    key, row = unused(documents, "_row_key"), unused(documents, "_row")
    kept = materialize(first.select(F.col("first.row_key").alias(key)), "kept")
    rows = documents.withColumn(key, row_keys(doc_id, text)).join(kept, key)
    same = Window.partitionBy(key).orderBy(key)
    return rows.withColumn(row, F.row_number().over(same)).filter(F.col(row) == 1).select(*documents.columns)
