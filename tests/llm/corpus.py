"""Small corpora for the tests of the corpus operators."""

from __future__ import annotations

import random

WORDS = {
    "en": "the of and to in is that it for was on are with they be at this from have not by house river green walk".split(),
    "de": "der die und das ist nicht ein mit auf für von sich dem haus fluss grün gehen über straße".split(),
    "fr": "le la les et des est dans pour que qui sur une pas maison rivière vert marcher été être".split(),
}
# Names that operators use themselves.
CLASHING = ("fingerprint", "row_key", "component", "doc", "body", "runs", "removed_lines", "piece", "_row", "rejected")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING_SCHEMA = ", ".join([SCHEMA, *(f"{c} string" for c in CLASHING)])


def prose(rng: random.Random, words: int, lang: str = "en") -> str:
    return " ".join(rng.choice(WORDS[lang]) + (rng.choice(["", "", "s", "ing", "er"])) for _ in range(words))


def document(doc_id, text, lang="en"):
    return (doc_id, text, lang, "src0", None if text is None else len(text), *("x" for _ in CLASHING))


def edge_documents():
    """NULLs, empty and long texts, ties, repeated rows, in a table with clashing column names."""
    rng = random.Random(3)
    text = prose(rng, 80)
    rows = [
        document(1, text),
        document(1, text),
        document(2, text),
        document(None, text),
        document(None, None, None),
        document(3, None),
        document(4, ""),
        document(4, ""),
        document(5, " \n\t\n "),
        document(6, "12 345 -- 67", None),
        document(7, prose(rng, 40_000)),
        document(8, "x" * 200_000),
        document(-9, "é Ünï 日本語 🎉\u0000 \x1c\x85\xa0 <|endoftext|> Σ"),
        document(10, prose(rng, 60, "fr"), "fr"),
        document(11, prose(rng, 60, "de"), "de"),
    ]
    return rows


def edge_table(spark):
    return spark.createDataFrame(edge_documents(), CLASHING_SCHEMA)


def empty_table(spark):
    return spark.createDataFrame([], CLASHING_SCHEMA)


def sf_documents(spark):
    """The smallest of the given tables, as rows."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
