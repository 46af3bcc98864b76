"""Language identification by a mixture of languages fitted to each document.

Every language is a distribution of hashed character trigrams, learned from labelled
documents. A document is taken as a mixture: expectation-maximisation finds the share
of each language, and of a uniform background that no language explains, from the
likelihoods of its trigrams. Of the languages, as many as pay for a penalty on the
likelihood are kept, and the one with the largest share is predicted.

Learning uses a bounded sample: of each language about ``SAMPLE_PER_LANGUAGE``
documents, chosen by a hash of their id. Rare languages are used whole.

Defined cases: a NULL text, or one without a letter, is ``und`` with score 0 and
rejected; NULL ids are predicted but never learned from; NULL labels are not learned
from; without any labelled document everything is ``und``; more than ``MOST_LANGUAGES``
labels are an error, since the counts of all of them are held at once (262 MB at most);
repeated rows are predicted once each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from skymeter.llm.batches import give_back, in_text_batches, map_texts

BUCKET_BITS = 15
SAMPLE_PER_LANGUAGE = 5_000
MOST_LANGUAGES = 1_000
UNDETERMINED = "und"
# Added to every trigram count of a language.
SMOOTHING = 0.1
ROUNDS = 25
# Log-likelihood a further language must gain, in units of half the log of the number of
# trigrams: neighbouring trigrams share letters, so each counts for less than one.
PENALTY = 3.0
# Share of the background above which a document is rejected.
MOST_BACKGROUND = 0.5


@cache
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(text: str) -> np.ndarray:
    """Buckets of the trigrams of the lower-cased text; what is no letter counts as a gap."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    points = np.concatenate([[0], np.where(_is_letter()[points], points, 0), [0]]).astype(np.uint64)
    points = points[np.append(True, (points[1:] != 0) | (points[:-1] != 0))]
    if len(points) < 3:
        return np.zeros(0, np.int64)
    mixed = points[:-2] * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= points[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= points[2:] * np.uint64(0x165667B19E3779F9)
    mixed *= np.uint64(0x9FB21C651E98DF25)
    return (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


class Model:
    """Trigram probabilities of each language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smoothed = counts + SMOOTHING
        probability = smoothed / smoothed.sum(axis=1, keepdims=True)
        background = np.full((1, 1 << BUCKET_BITS), 1.0 / (1 << BUCKET_BITS))
        # One row per trigram, the background last.
        self.table = np.ascontiguousarray(np.concatenate([probability, background]).T)

    def shares(self, likelihood: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
        """Mixture shares of the columns by expectation-maximisation, and the log-likelihood."""
        share = np.full(likelihood.shape[1], 1.0 / likelihood.shape[1])
        total = counts.sum()
        for _ in range(ROUNDS):
            new = share * ((counts / (likelihood @ share)) @ likelihood) / total
            change = np.abs(new - share).max()
            share = new
            if change < 1e-3:
                break
        return share, float(counts @ np.log(likelihood @ share))

    def predict(self, text: str | None) -> tuple[str, float, list[str], float]:
        """Language, its share, all languages of the mixture, and the share of the background."""
        found = trigrams(text or "")
        if not len(found) or not self.languages:
            return UNDETERMINED, 0.0, [], 1.0
        counts = np.bincount(found, minlength=1 << BUCKET_BITS)
        seen = np.flatnonzero(counts)
        counts = counts[seen].astype(np.float64)
        likelihood = self.table[seen]
        background = len(self.languages)
        first, _ = self.shares(likelihood, counts)
        order = np.argsort(-first[:-1], kind="stable")
        price = PENALTY * 0.5 * np.log(len(found))
        best: tuple[float, np.ndarray, np.ndarray] | None = None
        for size in range(1, len(order) + 1):
            chosen = np.append(order[:size], background)
            share, fit = self.shares(likelihood[:, chosen], counts)
            value = fit - price * size
            if best is not None and value <= best[0]:
                break
            best = value, chosen[:-1], share
        _, chosen, share = best
        top = int(np.argmax(share[:-1]))
        names = [self.languages[i] for i in chosen]
        return names[top], float(min(1.0, share[top])), names, float(share[-1])


def fit(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample: int = SAMPLE_PER_LANGUAGE,
) -> Model:
    """Trigram counts of each language over a bounded sample of its labelled documents."""
    chosen = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    labelled = chosen.filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").filter(~held_out())
    sizes = labelled.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} labels")
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return Model([], np.zeros((0, 1 << BUCKET_BITS)))
    # A part of every language by the hash of the id, out of 2^30.
    parts = F.create_map(
        *[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1 << 30, sample * (1 << 30) // r["count"])))]
    )
    sampled = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < parts[F.col("lang")])
    number = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), 1 << BUCKET_BITS), np.int64)
        for batch in batches:
            for content, name in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                counts[number[name]] += np.bincount(trigrams(content.as_py()), minlength=1 << BUCKET_BITS)
        row, bucket = np.nonzero(counts)
        columns = [pa.array(row), pa.array(bucket), pa.array(counts[row, bucket])]
        yield pa.RecordBatch.from_arrays(columns, ["row", "bucket", "n"])

    counted = map_texts(sampled.select("text", "lang"), count, "row long, bucket long, n long")
    summed = counted.groupBy("row", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(languages), 1 << BUCKET_BITS))
    counts[summed["row"], summed["bucket"]] = summed["n"]
    return Model(languages, counts)


def predict(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, languages, background, rejected`` of every document.

    Rejected are documents without a language, or mostly of what no language explains.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(1)]
            lang, score, languages, background = (list(x) for x in zip(*found, strict=True)) if found else [[]] * 4
            columns = [
                batch.column(0),
                pa.array(lang, pa.string()),
                pa.array(score, pa.float64()),
                pa.array(languages, pa.list_(pa.string())),
                pa.array(background, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "lang_pred", "score", "languages", "background"]
    schema = "doc_id long, lang_pred string, score double, languages array<string>, background double"
    chosen = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = map_texts(chosen, identify, schema)
    rejected = (F.col("lang_pred") == UNDETERMINED) | (F.col("background") > MOST_BACKGROUND)
    return found.withColumn("rejected", rejected)


def keep_identified(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents that ``predict`` does not reject, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(BooleanType())
    def identified(texts: pa.Array) -> pa.Array:
        found = [shared.value.predict(t.as_py()) for t in texts]
        kept = [lang != UNDETERMINED and background <= MOST_BACKGROUND for lang, _, _, background in found]
        give_back()
        return pa.array(kept, pa.bool_())

    return in_text_batches(documents).filter(identified(F.col(text)))
