"""Document fingerprints by spot signatures (SpotSigs).

Wherever a common word stands, it anchors a spot: the chain of the second and the fourth
content word after it. The set of a text's spots, hashed to 32 bits each, is its
fingerprint; the likeness of two texts is the Jaccard index of their sets. Where no
common word is near (tables, lists), every word is an anchor.

Sets are partitioned by length: a set can reach likeness ``t`` only with sets whose
length is at least ``t`` times its own, so sets two or more partitions apart never do.
Comparisons are pruned by the lengths, and by what is left to read. Documents that are
alike meet within neighbouring partitions under a rare spot they share.

Defined cases: a NULL text counts as empty; a text without a spot has the hash of the
whole text as its only spot, so it is like equal texts only; NULL ids come last in the
order of documents, rows of one id go by their texts' first bytes and then a hash, so
repeated rows follow each other; a single document is its own next
one; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymeter.llm.batches import map_texts
from skymeter.session import materialize, scratch

# Common words of the languages at hand; fixed values.
ANCHORS = frozenset(
    """
    a an and are as at be by for from in is it of on or that the this to was were with
    als auf das dem den der des die ein eine im ist mit nicht sich und von zu
    au avec ce dans du en est et la le les ou par pas pour qui que sur un une
    al como con del el las lo los no para por se su y
    """.split()
)
CHAIN_WORDS = 2
DISTANCE = 2
# Words with no common word within so many on either side are anchors themselves.
FAR = 6
LIKENESS = 0.8
# Products with a likeness are rounded; bounds give way by this much.
SLACK = 1e-9

WORDS = re.compile(r"[^\W_]+")
CACHED_WORDS = 1_000_000


class _Hashes(dict):
    """Word hashes; the lowest bit tells anchors from content words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = xxhash.xxh64_intdigest(word) & ~1 | (word in ANCHORS)
        self[word] = value
        return value


_hashes = _Hashes()


def spots(text: str) -> np.ndarray:
    """The sorted distinct spot hashes of a text."""
    words = WORDS.findall(text.lower())
    hashes = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    is_anchor = hashes & np.uint64(1) == 1
    content = np.flatnonzero(~is_anchor)
    before = np.append(0, np.cumsum(is_anchor))
    place = np.arange(len(words))
    near = before[np.minimum(place + FAR + 1, len(words))] - before[np.maximum(place - FAR, 0)]
    anchors = np.flatnonzero(is_anchor | (near == 0))
    following = np.searchsorted(content, anchors, "right")
    complete = following + CHAIN_WORDS * DISTANCE <= len(content)
    anchors, following = anchors[complete], following[complete]
    if not len(anchors):
        return np.array([xxhash.xxh32_intdigest(text.encode("utf-8", "replace"))], np.uint32)
    mixed = hashes[anchors]
    for i in range(1, CHAIN_WORDS + 1):
        mixed = (mixed * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[content[following + i * DISTANCE - 1]]
    mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
    return np.unique((mixed >> np.uint64(32)).astype(np.uint32))


def written(found: np.ndarray) -> str:
    """A spot set as text: its little-endian hashes in Base64."""
    return base64.b64encode(found.astype("<u4").tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def length_partition(size: int, likeness: float = LIKENESS) -> int:
    """Sets that can be as alike as ``likeness`` are at most one partition apart."""
    return math.floor(math.log(size) / math.log(1 / likeness))


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """The Jaccard index of two spot sets, or 0.0 where it is below ``least``.

    Pruned by length first, then by the part of the sets that share a range of hashes.
    """
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    low, high = max(a[0], b[0]), min(a[-1], b[-1])
    inner_a = a[np.searchsorted(a, low) : np.searchsorted(a, high, "right")]
    inner_b = b[np.searchsorted(b, low) : np.searchsorted(b, high, "right")]
    most = min(len(inner_a), len(inner_b))
    if not most or most < least * (len(a) + len(b) - most):
        return 0.0
    both = np.concatenate([inner_a, inner_b])
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    found = shared / (len(a) + len(b) - shared)
    return found if found >= least else 0.0


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of the following one."""
    replaced = len(text) // 3
    return text[: len(text) - replaced] + following[:replaced]


def text_place(text: str) -> tuple[int, int]:
    """The place of a text among those of one id: by its first eight bytes, then by a hash."""
    data = text.encode("utf-8", "replace")
    return int.from_bytes(data[:8].ljust(8, b"\0"), "big") - (1 << 63), xxhash.xxh64_intdigest(data) - (1 << 63)


class Ranges:
    """Ranges of documents in descending order of ids, of which ids with very many rows have several.

    ``bounds`` are the largest ids of the ranges but the first, ascending; ``inner`` has
    the first bytes at which the texts of an id with a range of its own are parted.
    """

    def __init__(self, bounds: list[int], inner: dict[int | None, list[int]]):
        self.inner = {i: np.array(places, np.int64) for i, places in inner.items()}
        alone = [i - 1 for i in inner if i is not None and i > -(1 << 63)]
        self.bounds = np.array(sorted({*bounds, *[i for i in inner if i is not None], *alone}), np.int64)
        # Ranges from the largest ids down, rows without an id last.
        tops = [None, *self.bounds[::-1].tolist()]
        sizes = [len(inner.get(top, ())) + 1 if top is not None else 1 for top in tops] + [len(inner.get(None, ())) + 1]
        self.starts = np.append(0, np.cumsum(sizes))
        self.count = int(self.starts[-1])

    def of(self, ids: pa.Array, texts: pa.Array) -> np.ndarray:
        """The number of each row's range."""
        known = np.asarray(ids.fill_null(0))
        at = np.where(np.asarray(ids.is_null()), len(self.bounds) + 1, len(self.bounds) - np.searchsorted(self.bounds, known))
        found = self.starts[at]
        for key, places in self.inner.items():
            rows = np.flatnonzero(np.asarray(ids.is_null()) if key is None else np.asarray(ids.is_valid()) & (known == key))
            found[rows] += np.searchsorted(places, [text_place(texts[int(i)].as_py())[0] for i in rows])
        return found


def ranges_of(chosen: DataFrame, count: int) -> Ranges:
    """About ``count`` ranges of ``doc_id, text`` with as many rows each, from quantiles."""
    parts = [i / count for i in range(1, count)] or [0.5]
    exact = max(10_000, 20 * count)
    quantiles = F.percentile_approx("doc_id", parts, exact)
    found, nulls, rows = chosen.agg(quantiles, F.count_if(F.col("doc_id").isNull()), F.count(F.lit(1))).first()
    often = {i: n for i, n in Counter(found or []).items() if n > 1}
    if rows and nulls * count // rows > 1:
        often[None] = nulls * count // rows
    inner = {}
    if often:

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                places = [text_place(t)[0] for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(places, pa.int64())], ["doc_id", "place"])

        known = [i for i in often if i is not None]
        hot = chosen.filter(F.col("doc_id").isin(known) | (F.col("doc_id").isNull() & F.lit(None in often)))
        places = map_texts(hot, placed, "doc_id long, place long")
        spread = places.groupBy("doc_id").agg(F.percentile_approx("place", parts, exact)).collect()
        # As many of the quantiles as the id has of all rows.
        for key, quantile in spread:
            step = max(1, len(quantile) // often[key])
            inner[key] = sorted(set(quantile[step - 1 :: step]))
    return Ranges(sorted(set(found or [])), inner)


def by_neighbours(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``bucket, guest, doc_id, text``: documents in ranges of descending ids.

    Each partition is sorted, and the first document of the next range follows the last
    one of its own as a guest. Ranges come from quantiles of the ids, one for each shuffle
    partition; an id with more rows than that, or rows without an id, have several, parted
    by their texts. So only the quantiles and the ranges' first keys pass through the driver.
    """
    spark = documents.sparkSession
    chosen = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    ranges = ranges_of(chosen, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def head(key: int | None, content: str) -> tuple[int, ...]:
        """The first of these comes first in a range. An id's text only counts where it has several."""
        return (*((1, 0) if key is None else (0, -key)), *(text_place(content) if key in ranges.inner else (0, 0)))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        for batch in batches:
            buckets = ranges.of(batch.column(0), batch.column(1)).tolist()
            for i, (number, key) in enumerate(zip(buckets, batch.column(0).to_pylist(), strict=True)):
                place = head(key, batch.column(1)[i].as_py() if key in ranges.inner else "")
                if number not in found or place < found[number]:
                    found[number] = place
        columns = [list(found), *zip(*found.values())] if found else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["bucket", "none", "id", "place", "hash"])

    # Texts are only read here where an id has several ranges.
    read_for = chosen if ranges.inner else chosen.select("doc_id", F.lit("").alias("text"))
    heads = map_texts(read_for, first, "bucket long, none long, id long, place long, hash long")
    least = F.min(F.struct("none", "id", "place", "hash"))
    known = sorted((r[0], tuple(r[1])) for r in heads.groupBy("bucket").agg(least).collect())
    # The range before a head's own, and the last range for the first head.
    host = {place: known[i - 1][0] for i, (_, place) in enumerate(known)}
    head_ids = {None if place[0] else -place[1] for _, place in known}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "guest", "doc_id", "text", "place", "hash"]
        sent: set[tuple] = set()
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            places = [text_place(t) for t in texts.to_pylist()]
            order = [pa.array([p[i] for p in places], pa.int64()) for i in (0, 1)]
            own = pa.array(ranges.of(batch.column(0), texts))
            guest = pa.array(np.zeros(batch.num_rows, bool))
            yield pa.RecordBatch.from_arrays([own, guest, *batch.columns, *order], names)
            rows, to = [], []
            for i, key in enumerate(keys):
                if key in head_ids:
                    place = head(key, texts[i].as_py() if key in ranges.inner else "")
                    if place in host and place not in sent:
                        rows.append(i)
                        to.append(host[place])
                        # Equal texts follow each other in any order, so one of a task will do.
                        if key in ranges.inner:
                            sent.add(place)
            if rows:
                taken = pa.RecordBatch.from_arrays([*batch.columns, *order], names[2:]).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array([True] * len(rows)), *taken.columns], names)

    dealt = map_texts(chosen, deal, "bucket long, guest boolean, doc_id long, text string, place long, hash long")
    order = ["bucket", "guest", F.col("doc_id").desc_nulls_last(), "place", "hash", "text"]
    placed = dealt.repartitionById(ranges.count, F.col("bucket").cast("int"))
    return placed.sortWithinPartitions(*order).drop("place", "hash")


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, length_partition int"
)


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The fingerprint of every document and of its edited text, and how near they are."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None
        for batch in batches:
            rows = []
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for i, (bucket, guest, key) in enumerate(zip(*columns, strict=True)):
                if guest and (before is None or before[0] != bucket or before[1]):
                    continue  # a second guest, of a repeated id
                content = batch.column(3)[i].as_py()
                found = spots(content)
                if before is not None and before[0] == bucket and not before[1]:
                    rows.append(result(*before[2:], content, found))
                before = (bucket, guest, key, content, found)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names
                )

    def result(key: int | None, content: str, found: np.ndarray, following: str, theirs: np.ndarray) -> tuple:
        changed = edited(content, following)
        of_changed = spots(changed)
        return (
            key,
            len(content),
            hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
            written(found),
            written(of_changed),
            jaccard(found, of_changed),
            jaccard(found, theirs),
            length_partition(len(found)),
        )

    names = [f.split()[0] for f in RESULT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32()]
    return by_neighbours(documents, doc_id, text).mapInArrow(compare, RESULT)


SETS = "class long, size int, spots array<long>"


def spot_classes(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``doc_id, class`` of every document, and ``class, size, spots`` of every distinct spot set.

    Documents with equal sets are one class, so copies are compared once.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [spots(t or "") for t in batch.column(1).to_pylist()]
            names = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            sizes = np.array([len(s) for s in sets], np.int32)
            offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
            flat = np.concatenate([np.zeros(0, np.uint32), *sets]).astype(np.int64)
            lists = pa.ListArray.from_arrays(offsets, pa.array(flat))
            columns = [batch.column(0), pa.array(names), pa.array(sizes), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "class", "size", "spots"])

    chosen = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    stored = materialize(map_texts(chosen, found, f"doc_id long, {SETS}"), "spot-sets")
    return stored.select("doc_id", "class"), stored.select("class", "size", "spots").dropDuplicates(["class"])


def similar_classes(sets: DataFrame, likeness: float = LIKENESS) -> DataFrame:
    """``a, b, likeness``: all pairs of classes, ``a < b``, that are at least so alike.

    Sets are partitioned by length and meet those of their own and the next partition.
    Two sets that are alike share one of the first spots of each, in an order that puts
    the rarest first: counted over all sets, so that few meet under a spot. Pairs are
    pruned by their lengths and by what is left behind the spot they share before the
    sets are read and compared.
    """
    partition = F.floor(F.ln("size") / F.lit(math.log(1 / likeness)) + SLACK).cast("int")
    sets = materialize(sets.withColumn("part", partition), "spot-classes")
    each = sets.select("class", "size", "part", F.explode("spots").alias("spot"))
    often = each.groupBy("spot").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    # Spots of one set alone come first in its order, and are only counted.
    shared = each.join(materialize(often, "shared-spots"), "spot").groupBy("class", "size", "part").agg(
        F.array_sort(F.collect_list(F.struct("sets", "spot"))).alias("order")
    )
    alone = F.col("size") - F.size("order")
    first = F.col("size") - F.ceil(F.lit(likeness) * F.col("size") - SLACK).cast("int") + 1
    keys = shared.select(
        "class", "size", "part", alone.alias("alone"),
        F.posexplode(F.slice("order", F.lit(1), F.greatest(first - alone, F.lit(0)))).alias("at", "key"),
    )
    # How many of the spots from this one on.
    rest = (F.col("size") - F.col("alone") - F.col("at")).alias("rest")
    keys = materialize(keys.select("class", "size", "part", F.col("key.spot").alias("spot"), rest), "spot-keys")

    def side(name: str, parts: Column) -> DataFrame:
        columns = [F.col(c).alias(f"{name}_{c}") for c in ("class", "size", "rest", "part")]
        return keys.select("spot", *columns, parts.alias("part"))

    met = side("a", F.col("part")).join(side("b", F.explode(F.array(F.col("part"), F.col("part") - 1))), ["spot", "part"])
    own = (F.col("a_part") < F.col("b_part")) | (F.col("a_class") < F.col("b_class"))
    sizes = F.col("a_size"), F.col("b_size")
    least = F.lit(likeness / (1 + likeness)) * (sizes[0] + sizes[1]) - SLACK
    near = (F.least(*sizes) >= F.lit(likeness) * F.greatest(*sizes) - SLACK) & (F.least("a_rest", "b_rest") >= least)
    pairs = met.filter(own & near).select(
        F.least("a_class", "b_class").alias("a"), F.greatest("a_class", "b_class").alias("b")
    )
    pairs = materialize(pairs.distinct(), "spot-pairs")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                jaccard(*(c[i].values.to_numpy(zero_copy_only=False) for c in batch.columns[2:]), likeness - SLACK)
                for i in range(batch.num_rows)
            ]
            columns = [*batch.columns[:2], pa.array(found, pa.float64())]
            alike = pa.RecordBatch.from_arrays(columns, ["a", "b", "likeness"])
            yield alike.filter(pa.array([f > 0 for f in found], pa.bool_()))

    one = sets.select(F.col("class").alias("a"), F.col("spots").alias("a_spots"))
    other = sets.select(F.col("class").alias("b"), F.col("spots").alias("b_spots"))
    joined = pairs.join(one, "a").join(other, "b").select("a", "b", "a_spots", "b_spots")
    return map_texts(joined, compared, "a long, b long, likeness double")


def similar_documents(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", likeness: float = LIKENESS
) -> tuple[DataFrame, DataFrame]:
    """``doc_id, class`` of every document, and ``a, b, likeness`` of all classes that are alike.

    A text without a spot is like equal texts only. Rows are kept as they are, NULL ids and
    repeated ones too; an empty table gives two without rows.
    """
    with scratch(documents.sparkSession) as area:
        members, sets = spot_classes(documents, doc_id, text)
        pairs = area.result(similar_classes(sets, likeness), "similar-classes")
        return area.result(members, "spot-members"), pairs
