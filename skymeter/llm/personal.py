"""Personal data in texts, found with DataFrame functions alone.

For every kind a regular expression proposes spans, a check confirms them (number of
digits, Luhn, mod 97, parts of an address), and words close by raise or lower the score.
Kinds of the base set stay whatever their score; the others stay from ``LEAST_SCORE`` on.

A text is cut at the matches of a pattern, so positions are sums of lengths of what lies
between: both arrays come from one expression each, and nothing is searched again. The
context of a match is the end of the gap before it and the beginning of the one after.
Patterns are written so that Java neither backtracks over long runs nor recurses:
possessive repeats, and a match of a run only from its beginning.

Defined cases: a NULL text counts as empty and has no findings; NULL ids and repeated
rows are kept, one result each; further columns stay, whatever their names; an empty
table gives no rows. Positions are code points, the end is exclusive. Kinds are searched
one by one, so spans of different kinds may overlap; those of one kind do not.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymeter.llm.columns import unused

# Code points of context, and the points that its words add or take.
BEFORE, AFTER = 48, 24
RAISED, LOWERED = 25, 30
LEAST_SCORE = 50
# Matches that are summed up in one array; a text with more has several.
BLOCK = 128

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FINDINGS = "array<struct<kind:string,start:bigint,end:bigint,score:int>>"

# What a match is held against: itself, the gap before it, the gap after it.
Check = Callable[[Column, Column, Column], Column]


def _digits(value: Column) -> Column:
    """The digits of a number written with spaces, signs and brackets."""
    return F.translate(value, "+ ().-", "")


def _digit_count(least: int, most: int) -> Check:
    return lambda m, before, after: F.length(_digits(m)).between(least, most)


def is_address(value: Column) -> Column:
    """Whether no part of a dotted number is beyond 255."""
    return value.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")


def is_card(value: Column) -> Column:
    """Whether a number has 13 to 19 digits that pass Luhn."""
    digits = _digits(value)
    return F.when(F.length(digits).between(13, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False))


def remainder_97(account: Column) -> Column:
    """An account number, its first four characters last and letters as 10 to 35, modulo 97."""
    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))

    def added(rest: Column, character: Column) -> Column:
        code = F.ascii(character)
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), added)


def is_account(value: Column) -> Column:
    """Whether an international account number has 15 to 34 characters and the right check digits."""
    plain = F.translate(value, " ", "")
    return F.when(F.length(plain).between(15, 34), remainder_97(plain) == 1).otherwise(F.lit(False))


def _alone(before: Column, after: Column) -> Column:
    """Whether the gaps do not go on with a letter or digit at the match."""
    return ~F.right(before, F.lit(1)).rlike("[A-Za-z0-9]") & ~F.left(after, F.lit(1)).rlike("[A-Za-z0-9]")


def _national(m: Column, before: Column, after: Column) -> Column:
    """Not the rest of an international number."""
    return _alone(before, after) & ~F.right(before, F.lit(8)).rlike(r"\+[0-9]{0,4}[ .-]?[(]?$")


def _run_on(m: Column, before: Column, after: Column) -> Column:
    """A number with more digits behind it: the base pattern takes both as one, often too long."""
    return _alone(before, after) & F.left(after, F.lit(AFTER)).rlike("^[ ().-]+[0-9]")


def _social(m: Column, before: Column, after: Column) -> Column:
    return _alone(before, after) & ~m.rlike("^(000|666|9)|-00-|0000$") & ~F.right(before, F.lit(1)).rlike("-")


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: what proposes it, what confirms it, and what its score depends on."""

    name: str
    pattern: str
    confirmed: Check
    score: int
    words: str
    against: str = "order|invoice|isbn|serial|version|tracking"
    # A text without this has no match.
    needs: str = ""
    base: bool = True


# The base patterns, as they are given.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
ADDRESS = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

ACCOUNT = r"[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4}){2,7}(\x20?[A-Z0-9]{1,3})?"
NATIONAL = r"[(]?[0-9]{3}[)]?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"
INTERNATIONAL = r"\+[0-9]{1,3}[\x20.-]?[(]?[0-9]{3}[)]?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"
SOCIAL = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"

PHONE_WORDS = "call|phone|tel|telephone|mobile|cell|fax|contact|anruf|telefon|handy|mobil|portable|llame|telefono"

# The same matches, for Java: a run of a pattern's first characters is tried once, at its
# beginning or where the last match ended.
KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m, before, after: F.lit(True),
        75,
        "mail|email|e-mail|contact|write|correo|courriel|kontakt",
        "example|version",
        needs="@",
    ),
    Kind(
        "ip",
        r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m, before, after: is_address(m),
        60,
        "ip|ipv4|address|host|server|client|login|adresse",
        needs=".",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda m, before, after: is_card(m),
        70,
        "card|credit|debit|visa|mastercard|amex|payment|karte|kreditkarte|carte|tarjeta",
    ),
    Kind("phone", PHONE, _digit_count(9, 15), 70, PHONE_WORDS, needs="+"),
    Kind(
        "iban",
        ACCOUNT,
        lambda m, before, after: _alone(before, after) & is_account(m),
        80,
        "iban|account|bank|transfer|konto|compte|cuenta",
        base=False,
    ),
    Kind("national_phone", NATIONAL, _national, 40, PHONE_WORDS, base=False),
    Kind("international_phone", INTERNATIONAL, _run_on, 60, PHONE_WORDS, needs="+", base=False),
    Kind("social_security", SOCIAL, _social, 40, "ssn|social|security|taxpayer", needs="-", base=False),
)
BASE = tuple(k.name for k in KINDS if k.base)


def _told(window: Column, words: str) -> Column:
    """Whether one of the words stands in a window, whatever its ASCII case."""
    return F.translate(window, UPPER, LOWER).rlike(f"(^|[^a-z])({words})([^a-z]|$)")


def _score(kind: Kind, m: Column, before: Column, after: Column) -> Column:
    """Points of a confirmed match; NULL if it is not, or has too few and no place in the base set."""
    window = F.concat(F.right(before, F.lit(BEFORE)), F.lit(" "), F.left(after, F.lit(AFTER)))
    raised = F.when(_told(window, kind.words), RAISED).otherwise(0)
    lowered = F.when(_told(window, kind.against), LOWERED).otherwise(0)
    score = (F.lit(kind.score) + raised - lowered).cast("int")
    if not kind.base:
        score = F.when(score >= LEAST_SCORE, score)
    return F.when(kind.confirmed(m, before, after), score)


def _measured(kind: Kind, found: str, gaps: str) -> Column:
    """Of each match: the length of the gap before it, its own, and its score."""

    def measure(m: Column, i: Column) -> Column:
        before, after = F.get(F.col(gaps), i), F.get(F.col(gaps), i + 1)
        return F.struct(
            F.length(before).cast("long").alias("gap"),
            F.length(m).cast("long").alias("length"),
            _score(kind, m, before, after).alias("score"),
        )

    return F.transform(found, measure)


def _located(kind: Kind, measured: str) -> Column:
    """The matches with a score, at their positions.

    Blocks of matches are summed up one after another: an array to which findings are
    added one by one is never longer than a block.
    """
    nothing = F.lit(None).cast(FINDINGS)
    empty = F.coalesce(nothing, F.array().cast(FINDINGS))

    def one(state: Column, m: Column) -> Column:
        start = state["at"] + m["gap"]
        end = start + m["length"]
        finding = F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), m["score"].alias("score"))
        found = F.when(m["score"].isNotNull(), F.concat(state["found"], F.array(finding))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.cast(FINDINGS).alias("found"))

    def block(states: Column, b: Column) -> Column:
        begin = F.struct(F.element_at(states, -1)["at"].alias("at"), empty.alias("found"))
        return F.concat(states, F.array(F.aggregate(F.slice(F.col(measured), b * BLOCK + 1, F.lit(BLOCK)), begin, one)))

    start = F.array(F.struct(F.lit(0).cast("long").alias("at"), empty.alias("found")))
    blocks = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(measured) - 1) / BLOCK).cast("int")))
    return F.flatten(F.transform(F.aggregate(blocks, start, block), lambda s: s["found"]))


def findings(documents: DataFrame, text: str = "text", output: str = "findings") -> DataFrame:
    """Adds the findings of each text: by kind as listed, then by position."""
    whole, spans = unused(documents, "_text"), unused(documents, output)
    helpers = {k.name: [unused(documents, f"_{k.name}_{part}") for part in ("found", "gaps", "measured")] for k in KINDS}
    none = F.array().cast("array<string>")

    def matches(kind: Kind) -> Column:
        found = F.regexp_extract_all(F.col(whole), F.lit(kind.pattern), F.lit(0))
        return F.when(F.contains(F.col(whole), F.lit(kind.needs)), found).otherwise(none) if kind.needs else found

    def gaps(kind: Kind) -> Column:
        return F.when(F.size(helpers[kind.name][0]) > 0, F.split(F.col(whole), kind.pattern, -1)).otherwise(none)

    out = documents.withColumn(whole, F.coalesce(F.col(text), F.lit("")))
    out = out.withColumns({helpers[k.name][0]: matches(k) for k in KINDS})
    out = out.withColumns({helpers[k.name][1]: gaps(k) for k in KINDS})
    out = out.withColumns({helpers[k.name][2]: _measured(k, *helpers[k.name][:2]) for k in KINDS})
    located = F.concat(*[_located(k, helpers[k.name][2]) for k in KINDS])
    return out.withColumn(spans, located).select(*documents.columns, spans)


def written(spans: Column) -> Column:
    """``kind:start:end`` of findings, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
