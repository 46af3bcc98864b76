"""Phrase collocations by stripes: each prefix of words keys a counter of the words that follow it.

A task counts the stripes of its texts and sends them in bundles, one for each bucket of
prefixes; the stripes of one prefix are merged word by word. The stripe of the empty prefix has the words. The
merged entries ``prefix, word, count`` of all lengths are the one structure behind the
result: an entry is an extension of its prefix, the count of a phrase is its own entry in
the stripe of its first words, and the largest entry of a stripe and the largest one that
ends in a phrase tell whether a longer phrase stands for it.

Stripes are counted length by length, and only of phrases whose two shorter parts reached
the least count. Which did, tasks know from a bit table of fixed size; a phrase it takes
wrongly is counted too and dropped after the merge, so the counts are exact and the table
does not grow with the corpus.

The stripes of the few prefixes that hold a thousandth of all words each, and that of the
empty prefix, are spread over buckets by their following words; tasks send bundles after
every ``HELD`` bytes, and the merge is a hash aggregation that spills. A word that
follows or precedes very many others makes no large group.

Defined cases: a NULL text counts as empty, a NULL language as ``und``; texts without words
count for nothing; NULL ids and repeated rows count as texts each; a language without
candidates has no rows; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skymeter.llm.batches import map_texts
from skymeter.session import materialize, scratch

LONGEST = 4
LEAST_COUNT = 30
# Fixed values of the score: its scale, and the per cent of a phrase's count at which a longer one stands for it.
SCALE = 2_000_000
SUBSUMED_PER_CENT = 80
PHRASES_PER_LANGUAGE = 2_000
UNDETERMINED = "und"

# Bytes of text a task counts before it sends its stripes: about 200 MB with the arrays to count them.
HELD = 10_000_000
# Bytes from which on a text is cut at the next end of a piece.
SLICE = 1_000_000
# A prefix with one word in so many is hot: there are no more than that. Its stripe has this many parts.
HOT_SHARE, PARTS = 1_000, 64
# Buckets of prefixes, and as many for each shuffle partition at least.
BUCKETS, BUCKETS_PER_PARTITION = 1_024, 4
# Bits of the table of frequent phrases: 4 MB.
TABLE_BITS = 1 << 25

SEED = 42
# Stripes of a bundle stand in lines: prefix, words and counts, each with a character between that no word holds.
BUNDLES = "lang string, bucket int, stripes string"

# ASCII letters in lower case, ends of pieces as full stops, tabs as spaces.
_END = b"."
_TRANSLATED = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + _END * 9 + b" "
)


def pieces(text: str) -> Iterator[bytes]:
    """A text in lower case, in parts of whole pieces, with a full stop of its own at the end of each piece."""
    data = text.encode().translate(_TRANSLATED)
    begin = 0
    while begin < len(data):
        end = data.find(_END, begin + SLICE)
        end = len(data) if end < 0 else end
        yield data[begin:end].replace(_END, b" . ") + b" . "
        begin = end + 1


def words_of(parts: list[bytes]) -> pa.DictionaryArray:
    """The words of parts one after another, with the ends of pieces."""
    whole = pa.array([p.strip() for p in parts], pa.binary()).cast(pa.large_string())
    return pc.ascii_split_whitespace(whole).flatten().dictionary_encode()


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))


def _mixed(hashes: list[np.ndarray]) -> np.ndarray:
    """A hash of a sequence, from the hashes of its items."""
    mixed = np.zeros(len(hashes[0]), np.uint64)
    for item in hashes:
        mixed = (mixed ^ item) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


class FrequentPhrases:
    """Bits of the phrases that reached the least count; two bits each, taken from their hash."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @staticmethod
    def places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        last = np.uint64(TABLE_BITS - 1)
        return hashes & last, (hashes >> np.uint64(32)) & last

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        held = np.ones(len(hashes), bool)
        for place in self.places(hashes):
            word = self.table[(place >> np.uint64(6)).astype(np.int64)]
            held &= (word >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return held


def frequent_phrases(spark: SparkSession, phrases: DataFrame) -> FrequentPhrases:
    """The bit table of ``lang, phrase``. Its words are united by Spark; the driver gets no more than the table."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, words = batch.column(0).to_pylist(), [p.encode().split(b" ") for p in batch.column(1).to_pylist()]
            if not words:
                continue
            items = [_hashes([x.encode() for x in langs])]
            items += [_hashes([w[i] for w in words]) for i in range(len(words[0]))]
            place = np.concatenate(FrequentPhrases.places(_mixed(items)))
            slots, at = np.unique(place >> np.uint64(6), return_inverse=True)
            masks = np.zeros(len(slots), np.uint64)
            np.bitwise_or.at(masks, at, np.uint64(1) << (place & np.uint64(63)))
            columns = [pa.array(slots.astype(np.int32)), pa.array(masks.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["slot", "mask"])

    found = map_texts(phrases.select("lang", "phrase"), marked, "slot int, mask long")
    united = found.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros(TABLE_BITS // 64, np.uint64)
    table[united["slot"].to_numpy()] = united["mask"].to_numpy().view(np.uint64)
    return FrequentPhrases(table)


@dataclass
class Known:
    """What the tasks of a length know of the shorter phrases; its size does not depend on the corpus."""

    # None: of the empty phrase.
    frequent: FrequentPhrases | None
    # Hashes of the hot prefixes, ascending.
    hot: np.ndarray
    buckets: int


class Counter:
    """Counts the stripes of one phrase length over some texts."""

    def __init__(self, length: int, known: Known):
        self.length, self.known = length, known
        self.clear()

    def clear(self) -> None:
        self.held, self.bytes = {}, 0

    def add(self, lang: str, text: str) -> Iterator[pa.RecordBatch]:
        """Counts a text; gives the stripes so far where they are enough."""
        for part in pieces(text):
            self.held.setdefault(lang, []).append(part)
            self.bytes += len(part)
            if self.bytes >= HELD:
                yield from self.bundles()

    def _phrases(self, named: np.ndarray, ids: np.ndarray, is_word: np.ndarray, hashes: np.ndarray) -> list[np.ndarray]:
        """Word numbers of all phrases of the length, one array per place in the phrase."""
        at = np.flatnonzero(is_word[ids])
        for i in range(1, self.length):
            at = at[at + i < len(ids)]
            at = at[is_word[ids[at + i]]]
        if self.known.frequent is not None:
            # Both parts with one word less.
            for begin in (0, 1):
                items = [hashes[ids[at + begin + i]] for i in range(self.length - 1)]
                at = at[self.known.frequent.holds(_mixed([np.repeat(named, len(at)), *items]))]
        return [ids[at + i].astype(np.int64) for i in range(self.length)]

    def bundles(self) -> Iterator[pa.RecordBatch]:
        """The stripes counted so far, one row for each language and bucket; starts anew."""
        held = self.held
        self.clear()
        for lang, parts in held.items():
            words = words_of(parts)
            named, vocabulary = _hashes([lang.encode()]), words.dictionary.cast(pa.large_binary()).to_pylist()
            is_word = np.array([w != _END for w in vocabulary], bool)
            hashes = _hashes(vocabulary)
            phrases = self._phrases(named, words.indices.to_numpy(), is_word, hashes)
            if len(phrases[0]):
                yield self._bundled(lang, named, phrases, hashes, words.dictionary.cast(pa.string()))

    def _bundled(self, lang, named, phrases, hashes, texts) -> pa.RecordBatch:
        size = len(texts)
        # Numbers of the prefixes: those of the words, paired and numbered anew word by word.
        prefix, first = np.zeros(len(phrases[0]), np.int64), []
        for words in phrases[:-1]:
            pairs, prefix = np.unique(prefix * size + words, return_inverse=True)
            first = [f[pairs // size] for f in first] + [pairs % size]
        entries, counts = np.unique(prefix * size + phrases[-1], return_counts=True)
        prefix, word = entries // size, entries % size

        if first:
            hashed = _mixed([np.repeat(named, len(first[0])), *[hashes[f] for f in first]])
            salts = np.where(np.isin(hashed, self.known.hot)[prefix], hashes[word] % np.uint64(PARTS), np.uint64(0))
            hashed = hashed[prefix]
            prefixes = pc.binary_join_element_wise(*[texts.take(pa.array(f)) for f in first], " ")
        else:
            hashed, salts, prefixes = np.repeat(named, len(word)), hashes[word], pa.array([""])
        bucket = (_mixed([hashed, salts]) >> np.uint64(8)) % np.uint64(self.known.buckets)

        order = np.lexsort((word, prefix, bucket))
        bucket, prefix, word, counts = bucket[order], prefix[order], word[order], counts[order]
        new_bucket = np.append(True, np.diff(bucket) != 0)
        stripe = np.flatnonzero(new_bucket | np.append(True, np.diff(prefix) != 0))
        offsets = pa.array(np.append(stripe, len(word)), pa.int32())
        joined = [
            pc.binary_join(pa.ListArray.from_arrays(offsets, column), " ")
            for column in (texts.take(pa.array(word)), pa.array(counts).cast(pa.string()))
        ]
        lines = pc.binary_join_element_wise(prefixes.take(pa.array(prefix[stripe])), *joined, "\t")
        ends = np.append(np.flatnonzero(new_bucket[stripe]), len(stripe))
        bundles = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lines), "\n")
        numbers = pa.array(bucket[new_bucket].astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(bundles)), numbers, bundles], ["lang", "bucket", "stripes"])


def stripes(texts: DataFrame, length: int, known: Known) -> DataFrame:
    """``lang, bucket, stripes``: the stripes of ``lang, text``, as tasks have counted them."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(length, shared.value)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from counter.add(lang, text)
        yield from counter.bundles()

    return map_texts(texts.select("lang", "text"), counted, BUNDLES)


def merged(bundles: DataFrame) -> DataFrame:
    """``lang, prefix, word, count``: stripes of one prefix added word by word."""
    dealt = bundles.repartition("lang", "bucket")
    line = F.explode(F.split("stripes", "\n")).alias("line")
    parts = dealt.select("lang", "bucket", line).select("lang", "bucket", F.split("line", "\t").alias("parts"))
    following = F.arrays_zip(F.split(F.get("parts", 1), " ").alias("word"), F.split(F.get("parts", 2), " ").alias("n"))
    entries = parts.select("lang", "bucket", F.get("parts", 0).alias("prefix"), F.inline(following))
    # All entries of a bucket are in one partition already, so they are not moved again.
    counts = entries.toDF("lang", "bucket", "prefix", "word", "n").groupBy("lang", "bucket", "prefix", "word")
    return counts.agg(F.sum(F.col("n").cast("long")).alias("count")).drop("bucket")


def hot_prefixes(entries: DataFrame, words: int) -> np.ndarray:
    """Hashes of the phrases with one of ``HOT_SHARE`` words each; counts of one length add up to ``words``."""
    rows = entries.filter(F.col("count") * HOT_SHARE >= words).select("lang", "phrase").collect()
    found = [_mixed([_hashes([r.lang.encode()]), *[_hashes([w]) for w in r.phrase.encode().split(b" ")]]) for r in rows]
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *found]))


def _phrase(prefix: str, word: str) -> Column:
    return F.when(F.col(prefix) == "", F.col(word)).otherwise(F.concat_ws(" ", prefix, word))


def frequent_entries(texts: DataFrame, least_count: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """``lang, n``, and ``lang, phrase, words, prefix, count`` of all phrases with the least count."""
    spark = texts.sparkSession
    buckets = max(BUCKETS, BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    levels, known = [], Known(None, np.zeros(0, np.uint64), buckets)
    for length in range(1, longest + 1):
        entries = merged(stripes(texts, length, known))
        if length == 1:
            entries = materialize(entries, "phrase-words")
            totals = materialize(entries.groupBy("lang").agg(F.sum("count").alias("n")), "phrase-totals")
            words = totals.agg(F.sum("n")).first()[0] or 0
        kept = entries.filter(F.col("count") >= least_count).select(
            "lang", _phrase("prefix", "word").alias("phrase"), F.lit(length).alias("words"), "prefix", "count"
        )
        levels.append(materialize(kept, "phrase-entries"))
        if length < longest:
            known = Known(frequent_phrases(spark, levels[-1]), hot_prefixes(levels[-1], words), buckets)
    found = levels[0]
    for level in levels[1:]:
        found = found.union(level)
    return totals, found


def _without_first(phrase: str) -> Column:
    return F.expr(f"substring({phrase}, instr({phrase}, ' ') + 1)")


def _maxima(entries: DataFrame) -> DataFrame:
    """``lang, phrase, longer``: the count of the most frequent phrase with one more word before or after.

    A phrase with more words than that is never more frequent than the parts of it that
    still hold the shorter phrase, so these decide.
    """
    longer = entries.filter("words > 2")
    inside = F.explode(F.array("prefix", _without_first("phrase"))).alias("phrase")
    return longer.select("lang", inside, "count").groupBy("lang", "phrase").agg(F.max("count").alias("longer"))


def _cuts(candidates: DataFrame) -> DataFrame:
    """``lang, phrase, a, k, first, rest``: every cut of each candidate."""
    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    at = candidates.select("lang", "phrase", F.col("count").alias("a"), cut, words.alias("split"))
    return at.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.concat_ws(" ", F.slice("split", 1, F.col("k"))).alias("first"),
        F.concat_ws(" ", F.slice("split", F.col("k") + 1, F.lit(LONGEST))).alias("rest"),
    )


def collocations(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least_count: int = LEAST_COUNT,
    longest: int = LONGEST,
    most: int = PHRASES_PER_LANGUAGE,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    with scratch(documents.sparkSession) as area:
        named = F.coalesce(F.col(lang), F.lit(UNDETERMINED)).alias("lang")
        texts = documents.select(named, F.col(text).alias("text")).filter("text IS NOT NULL AND text <> ''")
        totals, entries = frequent_entries(texts, least_count, longest)

        percent = F.col("count").cast("decimal(20,0)") * SUBSUMED_PER_CENT
        candidates = entries.filter("words > 1").join(_maxima(entries), ["lang", "phrase"], "left")
        kept = candidates.filter(
            F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < percent)
        )
        # Stored, so that parts of very many phrases are split in the joins.
        cuts = materialize(_cuts(kept), "phrase-cuts")
        counts = entries.select("lang", "phrase", "count")
        first = counts.select("lang", F.col("phrase").alias("first"), F.col("count").alias("l"))
        rest = counts.select("lang", F.col("phrase").alias("rest"), F.col("count").alias("r"))
        scored = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"])
        score = F.expr(f"CAST(a AS DECIMAL(20,0)) * {SCALE} DIV (CAST(l AS DECIMAL(20,0)) + r)")
        lowest = scored.groupBy("lang", "phrase").agg(
            F.min(F.struct(score.alias("score"), "k", "a", "l", "r")).alias("cut")
        )
        flat = lowest.select("lang", "phrase", *[F.col(f"cut.{c}").alias(c) for c in ("a", "l", "r", "score")])
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        best = flat.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= most)
        columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        return area.result(best.join(totals, "lang").select(*columns), "collocations")
