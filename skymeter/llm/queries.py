"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skymeter.llm import (
    languages,
    lines,
    nearest,
    personal,
    phrases,
    secrets,
    sentencepieces,
    spots,
    token_counts,
    warc,
    whitening,
)
from skymeter.llm.oracles import OP11_SQL, OP12_SQL
from skymeter.llm.packing import packed_documents
from skymeter.llm.simhash import near_duplicates
from skymeter.sources import load_table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document, by rules and by a network trained on their findings."""
    documents = load_table(spark, folder, "documents")
    found = secrets.findings(documents, secrets.train(documents))

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    by_rule = F.filter("findings", lambda s: s["kind"] != "model")
    return found.select(
        "doc_id",
        *map(count, secrets.KINDS[:3]),
        F.sha2(secrets.written(by_rule), 256).alias("base_sha256"),
        secrets.written(F.col("findings")).alias("spans"),
        count("model"),
    )


def op2_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Spot fingerprints of every document and its edited text, and their likeness."""
    return spots.fingerprints(load_table(spark, folder, "documents"))


def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded, compared with the library and decoded again."""
    return sentencepieces.verified(load_table(spark, folder, "documents"), PIECE_MODEL)


def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(load_table(spark, folder, "documents"))
    written = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", written.alias("fingerprint"), "component_id")


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens, one row per piece."""
    return packed_documents(load_table(spark, folder, "documents"), WORD_TOKENIZER)


def op6_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best inner products of every hundredth vector with all others."""
    return nearest.top_k(load_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without later copies of line runs of at least 50 words."""
    cut = lines.remove_repeated_lines(load_table(spark, folder, "documents"))
    return cut.select("doc_id", F.array_join("removed_lines", ",").alias("removed_lines"), "text")


# Every shortest run of at least 50 words, from each line and up to each line.
OP7_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS n
  FROM documents WHERE text IS NOT NULL),
w AS (
  SELECT *, len(regexp_extract_all(line, '[^\s\x0b]+')) AS words FROM l),
o AS (
  SELECT *, row_number() OVER d AS seq, sum(words) OVER d AS after
  FROM w WHERE words > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY n)),
fwd AS (
  SELECT a.doc_id, a.seq AS s, min(b.seq) AS e
  FROM o a JOIN o b ON b.doc_id = a.doc_id AND b.seq >= a.seq AND b.after - a.after + a.words >= 50 GROUP BY ALL),
bwd AS (
  SELECT b.doc_id, max(a.seq) AS s, b.seq AS e
  FROM o a JOIN o b ON b.doc_id = a.doc_id AND b.seq >= a.seq AND b.after - a.after + a.words >= 50
  GROUP BY b.doc_id, b.seq),
runs AS (
  SELECT r.doc_id, s, min(o.n) AS lo, max(o.n) AS hi, string_agg(line, chr(10) ORDER BY o.n) AS body
  FROM (SELECT * FROM fwd UNION SELECT * FROM bwd) r JOIN o ON o.doc_id = r.doc_id AND o.seq BETWEEN s AND e
  GROUP BY r.doc_id, s, e),
later AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) AS k FROM runs),
gone AS (
  SELECT DISTINCT w.doc_id, w.n FROM w JOIN later r ON r.doc_id = w.doc_id AND k > 1 AND w.n BETWEEN lo AND hi),
kept AS (
  SELECT w.doc_id, string_agg(w.line, chr(10) ORDER BY w.n) FILTER (g.n IS NULL) AS text,
         string_agg(w.n::VARCHAR, ',' ORDER BY w.n) FILTER (g.n IS NOT NULL) AS removed
  FROM w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.n = w.n GROUP BY w.doc_id)
SELECT d.doc_id, coalesce(removed, '') AS removed_lines,
       CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts and unigram tokens of every document."""
    return token_counts.token_counts(load_table(spark, folder, "documents"), PIECE_MODEL)


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, by a model of those that are not held out."""
    documents = load_table(spark, folder, "documents")
    found = languages.predict(documents, languages.fit(documents))
    return found.select("doc_id", languages.held_out().alias("held_out"), "lang_pred", "score", "languages", "rejected")


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    return warc.archived_pages(spark, warc.archive_pages(load_table(spark, folder, "pages")))


OP10_SQL = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
k AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS largest FROM p)
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(h, CAST((i // 4) * 5 + 1 AS INT), 5))::BIGINT >> CAST(15 - (i % 4) * 5 AS INT)) & 31), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to, url AS target_uri
FROM k
"""


def op11_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document, found by patterns, checksums and context."""
    found = personal.findings(load_table(spark, folder, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda s: s["kind"].isin(*personal.BASE))
    return found.select(
        "doc_id",
        *map(count, personal.BASE),
        F.sha2(personal.written(base), 256).alias("base_sha256"),
        personal.written(F.col("findings")).alias("spans"),
        F.array_join(F.transform("findings", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best phrases of two to four words of each language."""
    return phrases.collocations(load_table(spark, folder, "documents"))


def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector on the 32 leading components, whitened."""
    return whitening.whitened(load_table(spark, folder, "embeddings"))


QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_line_dedup": op7_line_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_language_id": op9_language_id,
    "op10_warc": op10_warc,
    "op11_pii": op11_pii,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLE = {
    "op6_exact_top_k": OP6_SQL,
    "op7_line_dedup": OP7_SQL,
    "op10_warc": OP10_SQL,
    "op11_pii": OP11_SQL,
    "op12_phrase_collocations": OP12_SQL,
}
