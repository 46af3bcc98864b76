from __future__ import annotations

import random
import re

import pytest
from corpus import CLASHING_SCHEMA, document, edge_documents, edge_table, empty_table, prose, sf_documents
from pyspark.sql import functions as F

from skymeter.llm import personal, queries

PLAIN = {"email": personal.EMAIL, "ip": personal.ADDRESS, "card": personal.CARD, "phone": personal.PHONE}
SCHEMA = "doc_id long, text string"


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(number))) % 10 == 0


def mod_97(account):
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97


def alone(before, after):
    return not re.search("[A-Za-z0-9]$", before) and not re.match("[A-Za-z0-9]", after)


def confirmed(kind, m, before, after):
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 13 <= len(digits(m)) <= 19 and luhn(digits(m))
    if kind == "phone":
        return 9 <= len(digits(m)) <= 15
    if kind == "iban":
        plain = m.replace(" ", "")
        return alone(before, after) and 15 <= len(plain) <= 34 and mod_97(plain) == 1
    if kind == "national_phone":
        return alone(before, after) and not re.search(r"\+[0-9]{0,4}[ .-]?[(]?$", before[-8:])
    if kind == "international_phone":
        return alone(before, after) and bool(re.match("[ ().-]+[0-9]", after[: personal.AFTER]))
    if kind == "social_security":
        return alone(before, after) and not re.search("^(000|666|9)|-00-|0000$", m) and not before.endswith("-")
    return True


def plain_findings(text):
    """Kind, start, end and score, match by match."""
    text, found = text or "", []
    for kind in personal.KINDS:
        matches = list(re.finditer(PLAIN.get(kind.name, kind.pattern), text))
        for i, m in enumerate(matches):
            before = text[matches[i - 1].end() if i else 0 : m.start()]
            after = text[m.end() : matches[i + 1].start() if i + 1 < len(matches) else None]
            near = f"{before[-personal.BEFORE :]} {after[: personal.AFTER]}"
            near = re.sub("[A-Z]", lambda c: c[0].lower(), near)
            score = kind.score
            score += personal.RAISED * bool(re.search(f"(^|[^a-z])({kind.words})([^a-z]|$)", near))
            score -= personal.LOWERED * bool(re.search(f"(^|[^a-z])({kind.against})([^a-z]|$)", near))
            if confirmed(kind.name, m[0], before, after) and (kind.base or score >= personal.LEAST_SCORE):
                found.append((kind.name, m.start(), m.end(), score))
    return found


def found_in(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    rows = personal.findings(df).orderBy("doc_id").collect()
    return [[tuple(s) for s in r.findings] for r in rows]


TEXTS = [
    "write to a.b+c@mail.example.org now, or x@y, @z.w, a@b.c_d@e.f",
    "hosts 10.0.0.1, 256.1.1.1, 1.2.3.4.5.6.7.8, 007.08.9.255 and 1.2.3",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112, 0000000000000, 1234567890123456789012",
    "call +1 (017) 555-7713 or +49 30 1234567. +1 (017) 555-7713 129.38.82.176",
    "IBAN GB82 WEST 1234 5698 7654 32, XGB82WEST12345698765432, DE89370400440532013000 DE88370400440532013000",
    "phone 555-123-4567, (555) 123-4567 alone; order 555 123 4567",
    "SSN 123-45-6789, 000-45-6789, nothing near here for a long while, so that the word is out of reach 123-45-6789",
    "日本語 🎉 a@b.cd é 4111111111111111 \U0001f600+123456789",
    "a@b.cd" * 3 + " " + "1 " * 50,
]


def test_findings_equal_a_plain_version(spark):
    rng = random.Random(5)
    alphabet = ["@", ".", "+", "-", " ", "(", ")", "1", "42", "255", "4111111111111111", "ab", "x.y", "a@b.cd", "phone ", "555-123-4567"]
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(400)]
    texts += [f"{prose(rng, 30)} {''.join(rng.choices('0123456789 -', k=24))} {prose(rng, 5)}" for _ in range(100)]
    assert found_in(spark, texts) == [plain_findings(t) for t in texts]


def test_examples(spark):
    mail, hosts, cards, phones, accounts, national, social, *_ = found_in(spark, TEXTS)
    assert [s[0] for s in mail] == ["email"] * 3 and TEXTS[0][mail[0][1] : mail[0][2]] == "a.b+c@mail.example.org"
    assert [TEXTS[1][s:e] for _, s, e, _ in hosts] == ["10.0.0.1", "1.2.3.4", "5.6.7.8", "007.08.9.255"]
    assert {TEXTS[2][s:e] for k, s, e, _ in cards if k == "card"} == {"4111 1111 1111 1111", "0000000000000"}
    assert ("international_phone", "+1 (017) 555-7713") in [(k, TEXTS[3][s:e]) for k, s, e, _ in phones]
    assert [TEXTS[4][s:e] for k, s, e, _ in accounts if k == "iban"] == [
        "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"
    ]
    assert [TEXTS[5][s:e] for k, s, e, _ in national] == ["555-123-4567"]
    assert [(k, s) for k, s, _, _ in social] == [("social_security", 4)]


def test_given_documents(spark):
    documents = sf_documents(spark)
    given = {r.doc_id: plain_findings(r.text) for r in documents.collect()}
    got = {r.doc_id: [tuple(s) for s in r.findings] for r in personal.findings(documents).collect()}
    assert got == given and any(got.values())


def test_texts_with_more_matches_than_a_block(spark):
    texts = ["x a@b.cd " * (2 * personal.BLOCK + 3), "1.2.3.4 " * personal.BLOCK, "12 " * 1000 + "a@b.cd"]
    assert found_in(spark, texts) == [plain_findings(t) for t in texts]


@pytest.mark.parametrize("text", ["x" * 300_000, "1" * 300_000, "a@b" + ".c" * 100_000, "+1" + " " * 300_000, "1 " * 200_000])
def test_long_runs_neither_recurse_nor_take_long(spark, text):
    assert found_in(spark, [text]) == [plain_findings(text) if len(text) < 300_000 else []]


def test_edge_cases_and_clashing_columns(spark):
    table = edge_table(spark)
    found = personal.findings(table)
    assert found.columns == [*table.columns, "findings"]
    got = sorted((str(r.doc_id), r.text or "", [tuple(s) for s in r.findings]) for r in found.collect())
    assert got == sorted((str(d[0]), d[1] or "", plain_findings(d[1])) for d in edge_documents())
    assert personal.findings(empty_table(spark)).collect() == []
    named = spark.createDataFrame([(*document(1, "a@b.cd"), "x", "y")], f"{CLASHING_SCHEMA}, findings string, _text string")
    row = personal.findings(named).first()
    assert row["findings"] == "x" and row["_findings"][0]["kind"] == "email"


def test_the_query_runs_no_python(spark):
    plan = queries.op11_pii(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_counts_and_digest(spark):
    import hashlib

    row = queries.op11_pii(spark, "/root/testdata/sf0.001").filter(F.length("spans") > 0).orderBy("doc_id").first()
    spans = [s.split(":") for s in row.spans.split(",")]
    assert row.n_email + row.n_ip + row.n_card + row.n_phone == sum(k in personal.BASE for k, *_ in spans)
    base = ",".join(":".join(s) for s in spans if s[0] in personal.BASE)
    assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert len(row.scores.split(",")) == len(spans)
