"""Secrets in texts: rules, and a character convolutional network for what they miss.

Rules find assignments to telling names, access keys and long hexadecimal runs. Further
candidates are runs of token characters that hold a digit, and values of any characters
after an assignment sign or a telling name. The network sees each
candidate inside its surrounding text: embedded characters and a mark of the candidate,
one convolution, the maximum over all places, and a logistic output. It is trained on
labelled findings: those of the rules in a bounded sample of documents against the other
candidates there, and generated ones of public token formats and passwords against
look-alikes (times, paths, versions, identifiers, words). Candidates are split three ways,
all pieces of one together: one part trains, one calibrates the output (Platt), and on one
each group of candidates gets the highest threshold that still reaches the wanted recall,
counted by candidates. Those above it are added as kind ``model``, unless the rules' findings cover them.
Of a long candidate the network sees overlapping pieces, and the highest score counts.

Defined cases: a NULL text counts as empty and has no findings; NULL ids and repeated
rows are kept, one result each; an empty table gives no rows. Positions are code points,
the end is exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymeter.llm.batches import give_back, in_text_batches, map_texts
from skymeter.llm.columns import unused
from skymeter.session import materialize, scratch

# The rules and their shortest findings.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED = 6
LEAST_ACCESS = 20
KINDS = ("assign", "access", "hex", "model")

LEAST_CANDIDATE = 12
TOKEN_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.~-")
FROM_DIGIT = re.compile(r"[0-9][A-Za-z0-9+/_=.~-]*")
LEAST_VALUE = 6
VALUE = re.compile(
    r"""(?:\b(?:password|passphrase|passwd|pwd|pass|secret|token|key|auth|bearer|credentials?)(?![A-Za-z0-9_])["']?\x20{0,2}[:=]?|[:=])"""
    r"""\x20{0,2}["']?([^\s"':=][^\s"']*)""",
    re.ASCII | re.IGNORECASE,
)
# What may follow a value without being part of it.
VALUE_END = ".,;:!?)]}>"

SAMPLE_DOCUMENTS = 20_000
LABELLED_OF_EACH = 1_200
GENERATED_OF_EACH = 4_000
RECALL = 0.98
SEED = 7

LEFT, INSIDE, RIGHT = 32, 56, 16
WINDOW = LEFT + INSIDE + RIGHT
PIECE_STEP = INSIDE // 2
EMBEDDED, WIDTH, FILTERS = 8, 5, 24
EPOCHS, BATCH, RATE = 12, 64, 0.004
OTHER_CHARACTER = 1

REDACTED = "[SECRET]"
FINDINGS = "array<struct<kind:string,start:int,end:int,score:double>>"


def rule_findings(text: str) -> list[tuple[int, int, str]]:
    """``start, end, kind`` of the rules, by start and then kind as listed."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[2])))


def token_runs(text: str) -> list[tuple[int, int]]:
    """Runs of token characters with a digit, in one pass: from the first digit both ways."""
    runs, last = [], 0
    for match in FROM_DIGIT.finditer(text):
        start = match.start()
        while start > last and text[start - 1] in TOKEN_CHARACTERS:
            start -= 1
        last = match.end()
        if last - start >= LEAST_CANDIDATE:
            runs.append((start, last))
    return runs


def named_values(text: str) -> list[tuple[int, int]]:
    """Values after an assignment sign or a telling name, whatever their characters."""
    values = []
    for match in VALUE.finditer(text):
        start = match.start(1)
        end = start + len(match[1].rstrip(VALUE_END))
        if end - start >= LEAST_VALUE:
            values.append((start, end))
    return values


def candidates(text: str) -> list[tuple[int, int]]:
    """Token runs and named values by their start, without those that lie inside another."""
    found, reached = [], -1
    for start, end in sorted({*token_runs(text), *named_values(text)}, key=lambda c: (c[0], -c[1])):
        if end > reached:
            found.append((start, end))
            reached = end
    return found


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """The candidate, or overlapping parts that cover a long one."""
    if end - start <= INSIDE:
        return [(start, end)]
    return [(s, s + INSIDE) for s in [*range(start, end - INSIDE, PIECE_STEP), end - INSIDE]]


def window(text: str, start: int, end: int) -> str:
    """A piece of a candidate in its context.

    Padded with NUL to a fixed length, so that the piece starts at ``LEFT``.
    """
    left = text[max(0, start - LEFT) : start].rjust(LEFT, "\0")
    inside = text[start:end]
    right = text[end : end + RIGHT]
    return (left + inside + "\1" + right).ljust(WINDOW + 1, "\0")


def group(text: str, start: int) -> int:
    """Candidates after an assignment sign have a threshold of their own."""
    return int(text[max(0, start - LEFT) : start].rstrip(" \"'").endswith((":", "=")))


class Labelled(NamedTuple):
    """Pieces of candidates in their context."""

    windows: list[str]
    labels: np.ndarray
    # The candidate that a piece belongs to.
    owners: np.ndarray
    groups: np.ndarray

    def __add__(self, other: Labelled) -> Labelled:
        arrays = (np.concatenate([a, b]) for a, b in zip(self[1:], other[1:], strict=True))
        return Labelled(self.windows + other.windows, *arrays)


def _best_of_each(owners: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first piece of each candidate, and the highest score of its pieces."""
    _, first, at = np.unique(owners, return_index=True, return_inverse=True)
    best = np.full(len(first), -np.inf)
    np.maximum.at(best, at, scores)
    return first, best


def encode(windows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character numbers and the mark of the candidate, one row per window."""
    points = np.array([np.frombuffer(w.encode("utf-32-le", "replace"), "<u4") for w in windows])
    ends = (points == 1).argmax(axis=1)
    place = np.arange(WINDOW + 1)
    mark = (place >= LEFT) & (place < ends[:, None])
    return np.where(points < 128, points, OTHER_CHARACTER), mark.astype(np.float32)


class Network:
    """One convolution over embedded characters, its maximum over all places, and a logit."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        depth = EMBEDDED + 1
        self.weights = {
            "characters": rng.normal(0, 0.5, (128, EMBEDDED)).astype(np.float32),
            "filters": rng.normal(0, (2 / (WIDTH * depth)) ** 0.5, (WIDTH * depth, FILTERS)).astype(np.float32),
            "shift": np.zeros(FILTERS, np.float32),
            "out": rng.normal(0, FILTERS**-0.5, FILTERS).astype(np.float32),
            "bias": np.zeros(1, np.float32),
        }
        self.calibration = (1.0, 0.0)
        self.thresholds = (0.5, 0.5)

    def _columns(self, characters: np.ndarray, mark: np.ndarray) -> np.ndarray:
        seen = np.concatenate([self.weights["characters"][characters], mark[:, :, None]], axis=2)
        slid = np.lib.stride_tricks.sliding_window_view(seen, WIDTH, axis=1)
        return slid.transpose(0, 1, 3, 2).reshape(len(seen), -1, WIDTH * seen.shape[2])

    def logits(self, characters: np.ndarray, mark: np.ndarray) -> np.ndarray:
        w = self.weights
        peak = (self._columns(characters, mark) @ w["filters"]).max(axis=1) + w["shift"]
        return np.maximum(peak, 0) @ w["out"] + w["bias"]

    def _gradients(self, characters: np.ndarray, mark: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        w, rows = self.weights, np.arange(len(labels))[:, None]
        columns = self._columns(characters, mark)
        places = columns @ w["filters"]
        top = places.argmax(axis=1)
        peak = places[rows, top, np.arange(FILTERS)] + w["shift"]
        hidden = np.maximum(peak, 0)
        logit = hidden @ w["out"] + w["bias"]
        error = ((1 / (1 + np.exp(-logit))) - labels).astype(np.float32) / len(labels)
        back = error[:, None] * w["out"] * (peak > 0)
        chosen = columns[rows, top]
        to_columns = back[:, :, None] * w["filters"].T
        to_seen = to_columns.reshape(len(labels), FILTERS, WIDTH, -1)[..., :EMBEDDED]
        at = characters[rows[:, :, None], top[:, :, None] + np.arange(WIDTH)]
        to_characters = np.zeros_like(w["characters"])
        np.add.at(to_characters, at.ravel(), to_seen.reshape(-1, EMBEDDED))
        return {
            "characters": to_characters,
            "filters": np.einsum("nfk,nf->kf", chosen, back),
            "shift": back.sum(axis=0),
            "out": hidden.T @ error,
            "bias": error.sum(keepdims=True),
        }

    def train(self, given: Labelled, seed: int = SEED) -> None:
        """Adam on the logistic loss, on three fifths of the candidates; one calibrates, one sets thresholds."""
        rng = np.random.default_rng(seed)
        windows, labels, owners, groups = given
        names, at = np.unique(owners, return_inverse=True)
        part = rng.permutation(np.arange(len(names)) % 5)[at]
        used, held, last = np.flatnonzero(part >= 2), np.flatnonzero(part == 0), np.flatnonzero(part == 1)
        characters, mark = encode(windows)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(EPOCHS):
            shuffled = rng.permutation(used)
            for begin in range(0, len(shuffled), BATCH):
                rows = shuffled[begin : begin + BATCH]
                step += 1
                for k, g in self._gradients(characters[rows], mark[rows], labels[rows]).items():
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.001 * (g * g - square[k])
                    corrected = mean[k] / (1 - 0.9**step)
                    self.weights[k] -= RATE * corrected / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
        self._calibrate(self.logits(characters[held], mark[held]), labels[held])
        score = self.probability(self.logits(characters[last], mark[last]))
        first, best = _best_of_each(owners[last], score)
        positive, grouped = labels[last][first] == 1, groups[last][first]
        self.thresholds = tuple(self._threshold(best[positive & (grouped == g)]) for g in (0, 1))

    def hits(self, given: Labelled) -> tuple[np.ndarray, np.ndarray]:
        """Whether each candidate is found, and its label."""
        first, best = _best_of_each(given.owners, self.scores(given.windows))
        return best >= np.array(self.thresholds)[given.groups[first]], given.labels[first]

    def _calibrate(self, logit: np.ndarray, labels: np.ndarray) -> None:
        """Slope and shift of the logit by Newton's method, with labels off 0 and 1 (Platt)."""
        positive, negative = labels.sum(), len(labels) - labels.sum()
        target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
        design = np.stack([logit, np.ones_like(logit)], axis=1).astype(np.float64)
        fit = np.array([1.0, 0.0])
        for _ in range(20):
            p = 1 / (1 + np.exp(-np.clip(design @ fit, -30, 30)))
            curve = design.T @ (design * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
            fit -= np.linalg.solve(curve, design.T @ (p - target))
        self.calibration = (float(fit[0]), float(fit[1]))

    @staticmethod
    def _threshold(scores: np.ndarray) -> float:
        """The highest threshold that at least ``RECALL`` of these positives reach."""
        if not len(scores):
            return 0.5
        return float(np.sort(scores)[int(np.floor((1 - RECALL) * len(scores)))])

    def probability(self, logit: np.ndarray) -> np.ndarray:
        slope, shift = self.calibration
        return 1 / (1 + np.exp(-np.clip(slope * logit + shift, -30, 30)))

    def scores(self, windows: list[str]) -> np.ndarray:
        """Calibrated probabilities."""
        parts = [encode(windows[i : i + 500]) for i in range(0, len(windows), 500)]
        return self.probability(np.concatenate([self.logits(*p) for p in parts])) if parts else np.zeros(0)


FORMATS = (
    "ghp", "glpat", "xoxb", "sk_live", "AIza", "jwt", "AKIA", "base64", "mixed", "hex", "uuid", "base32", "dashed",
    "password", "letters", "passphrase", "word", "words",
)


def generated_findings(count: int, seed: int = SEED, formats: Sequence[str] = FORMATS) -> Labelled:
    """Made-up secrets of public formats and passwords (label 1), and as many look-alikes (0)."""
    rng = np.random.default_rng(seed)
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    mixed, hexadecimal = upper + lower + digits, digits + "abcdef"

    def pick(alphabet: str, n: int) -> str:
        return "".join(alphabet[i] for i in rng.integers(len(alphabet), size=n))

    def one(values: Sequence[str]) -> str:
        return values[rng.integers(len(values))]

    def word() -> str:
        return pick(lower, int(rng.integers(2, 9)))

    def prose(n: int) -> str:
        return " ".join(word() for _ in range(n))

    def number(n: int) -> str:
        return str(rng.integers(1, 10**n))

    def spoken() -> str:
        """A word as in a language: consonants and vowels in turn."""
        return "".join(one("bcdfghlmnprst") + one("aeiou") for _ in range(rng.integers(2, 5)))

    def secret(form: str) -> str:
        return {
            "ghp": lambda: "ghp_" + pick(mixed, 36),
            "glpat": lambda: "glpat-" + pick(mixed + "_-", 20),
            "xoxb": lambda: "xoxb-" + pick(digits, 11) + "-" + pick(digits, 12) + "-" + pick(mixed, 24),
            "sk_live": lambda: "sk_live_" + pick(mixed, 24),
            "AIza": lambda: "AIza" + pick(mixed + "_-", 35),
            "jwt": lambda: "eyJ" + pick(mixed, 33) + "." + pick(mixed, 60) + "." + pick(mixed + "_-", 43),
            "AKIA": lambda: "AKIA" + pick(upper + digits, 16),
            "base64": lambda: pick(mixed + "+/", 40),
            "mixed": lambda: pick(mixed, int(rng.integers(20, 48))),
            "hex": lambda: pick(hexadecimal, int(rng.integers(16, 64))),
            "uuid": lambda: "-".join(pick(hexadecimal, n) for n in (8, 4, 4, 4, 12)),
            "base32": lambda: pick(upper + "234567", int(rng.integers(16, 52))),
            "dashed": lambda: pick(lower, 3) + "-" + "-".join(pick(digits + lower, int(rng.integers(8, 20))) for _ in range(3)),
            "password": lambda: pick(mixed + "!@#$%^&*?", int(rng.integers(8, 20))),
            "letters": lambda: pick(upper + lower, int(rng.integers(12, 32))),
            "passphrase": lambda: one("-_.").join(spoken() for _ in range(4)) + one(["", number(2)]),
            "word": lambda: spoken() + one("!_-.@") + number(4),
            "words": lambda: spoken().title() + spoken().title() + one(["", spoken().title(), number(2)]),
        }[form]()

    # Of these no look alone tells; they come after a telling name only.
    wordy = {"passphrase", "word", "words"}
    named = {"password", "letters", *wordy}

    def ordinary() -> str:
        return one(
            [
                f"{rng.integers(1990, 2030)}-{rng.integers(1, 13):02}-{rng.integers(1, 29):02}T10:{rng.integers(60):02}",
                f"www.{word()}{number(2)}.example.com/{word()}",
                f"mail{number(1)}.example.com",
                f"{word()}/{word()}_{number(3)}/{word()}.txt",
                f"{word()}-{number(1)}.{number(1)}.{number(2)}.tar.gz",
                f"{number(3)}-{number(3)}-{number(4)}-{number(3)}",
                f"{number(3)}.{number(3)}.{number(3)}.{number(3)}",
                f"{word()}{word()}{word()}{number(2)}",
                f"{word().upper()}-{number(4)}-{word().upper()}",
                f"----------{number(2)}----------",
                f"{pick(digits, int(rng.integers(12, 20)))}",
                "/".join(word() for _ in range(rng.integers(8, 20))) + f"_{number(3)}.txt",
                "-".join(word() for _ in range(rng.integers(8, 20))) + f".{number(2)}",
            ]
        )

    telling = ["auth", "pwd", "credential", "private_key", "access_key", "bearer", "client_secret", "token", "password"]
    plain = ["date", "file", "see", "page", "version", "id", "name", "host", "time", "order", "ref", "note", "re"]
    windows, labels, owners, groups = [], [], [], []
    for i in range(2 * count):
        label = i % 2
        form = one(formats)
        if label:
            value = secret(form)
        elif form in wordy and rng.random() < 0.7:
            value = secret(form)  # only its name would tell
        elif rng.random() < 0.3:
            value = one(["", "/", "-", " ", "_"]).join(spoken() for _ in range(rng.integers(1, 6))) + one(["", "!", "?"])
        else:
            value = ordinary()
        least = LEAST_VALUE if form in named or not label else LEAST_CANDIDATE
        while len(value) < least:
            value += number(6) if label else spoken()
        name, sign = one(telling if label else plain), one([": ", "=", ' = "', "='", ":"])
        after_name = rng.random() < 0.5 or (label and form in named)
        before = f"{prose(6)} {name}{sign}" if after_name else f"{prose(6)} "
        text = f"{before}{value}{one(['', chr(34), ';', ',', '.'])} {prose(4)}"
        for piece in pieces(len(before), len(before) + len(value)):
            windows.append(window(text, *piece))
            labels.append(label)
            owners.append(i)
            groups.append(group(text, len(before)))
    return Labelled(windows, np.array(labels), np.array(owners), np.array(groups))


def marked_candidates(text: str, spans: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, bool]]:
    """The candidates, and whether one of the rules' findings, given by start, overlaps them."""
    at = 0
    for start, end in candidates(text):
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        yield start, end, any(s[0] < end and s[1] > start for s in spans[at : at + 3])


def open_candidates(text: str, spans: list[tuple[int, int, str]]) -> Iterator[tuple[int, int]]:
    """The candidates that do not lie wholly inside the rules' findings, given by start."""
    at = 0
    for start, end in candidates(text):
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        covered, i = start, at
        while i < len(spans) and spans[i][0] <= covered < end:
            covered = max(covered, spans[i][1])
            i += 1
        if covered < end:
            yield start, end


def labelled_findings(
    documents: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    sample: int = SAMPLE_DOCUMENTS,
    most: int = LABELLED_OF_EACH,
) -> Labelled:
    """Distinct candidate windows of sampled documents, labelled by whether a rule finds them."""
    rows = documents.count()
    if not rows:
        return Labelled([], *(np.zeros(0, int) for _ in range(3)))
    part = min(1 << 30, sample * (1 << 30) // rows)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value in batch.column(0):
                content = value.as_py() or ""
                for start, end, known in marked_candidates(content, rule_findings(content)):
                    owner = xxhash.xxh64_intdigest(content[start:end].encode("utf-8", "replace")) >> 1
                    about = int(known), owner, group(content, start)
                    found += [(window(content, *piece), *about) for piece in pieces(start, end)]
            columns = list(zip(*found, strict=True)) or [()] * 4
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    names = ["window", "label", "owner", "grouped"]
    chosen = documents.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < part).select(F.col(text).alias("text"))
    schema = "window string, label long, owner long, grouped long"
    with scratch(documents.sparkSession):
        labelled = materialize(map_texts(chosen, label, schema).distinct(), "labelled")
        order = F.xxhash64("window")
        found = [labelled.filter(F.col("label") == v).orderBy(order, "window").limit(most).collect() for v in (0, 1)]
    rows = [r for part in found for r in part]
    return Labelled([r[0] for r in rows], *(np.array([r[i] for r in rows], int) for i in (1, 2, 3)))


def train(documents: DataFrame, text: str = "text", key: str = "doc_id") -> Network:
    """A network trained on the corpus' labelled findings and on generated ones."""
    made = generated_findings(GENERATED_OF_EACH)
    network = Network()
    # Numbers of made-up candidates are negative, so they meet no hash.
    network.train(labelled_findings(documents, text, key) + made._replace(owners=-1 - made.owners))
    return network


def all_findings(texts: list[str], network: Network) -> list[list[tuple[str, int, int, float]]]:
    """``kind, start, end, score`` of each text, by start and then kind."""
    found = [rule_findings(t) for t in texts]
    open_to_model = []
    for i, text in enumerate(texts):
        open_to_model += [(i, *c, p) for c in open_candidates(text, found[i]) for p in pieces(*c)]
    windows = [window(texts[i], *piece) for i, _, _, piece in open_to_model]
    out = [[(kind, start, end, 1.0) for start, end, kind in spans] for spans in found]
    # A candidate has the highest score of its pieces.
    best: dict[tuple[int, int, int], float] = {}
    for (*place, _), score in zip(open_to_model, network.scores(windows), strict=True):
        best[tuple(place)] = max(float(score), best.get(tuple(place), 0.0))
    for (i, start, end), score in best.items():
        if score >= network.thresholds[group(texts[i], start)]:
            out[i].append(("model", start, end, score))
    return [sorted(spans, key=lambda f: (f[1], KINDS.index(f[0]))) for spans in out]


def findings(documents: DataFrame, network: Network, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, findings``: the secrets of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(network)

    fields = {"kind": pa.string(), "start": pa.int32(), "end": pa.int32(), "score": pa.float64()}

    @F.arrow_udf(FINDINGS)
    def find(texts: pa.Array) -> pa.Array:
        found = all_findings([t or "" for t in texts.to_pylist()], shared.value)
        rows = [[dict(zip(fields, f, strict=True)) for f in spans] for spans in found]
        give_back()
        return pa.array(rows, pa.list_(pa.struct(list(fields.items()))))

    return in_text_batches(documents).select(F.col(doc_id).alias("doc_id"), find(F.col(text)).alias("findings"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of the findings, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(documents: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """The documents with a mark in place of every secret; NULL texts stay NULL."""
    shared = documents.sparkSession.sparkContext.broadcast(network)

    @F.arrow_udf("string")
    def cover(texts: pa.Array) -> pa.Array:
        known = [t or "" for t in texts.to_pylist()]
        out: list[str | None] = []
        for given, content, spans in zip(texts.is_valid(), known, all_findings(known, shared.value), strict=True):
            parts, last = [], 0
            for _, start, end, _ in spans:
                if start >= last:
                    parts += [content[last:start], REDACTED]
                last = max(last, end)
            out.append("".join([*parts, content[last:]]) if given.as_py() else None)
        give_back()
        return pa.array(out, pa.string())

    covered = unused(documents, "_covered")
    changed = in_text_batches(documents).withColumn(covered, cover(F.col(text)))
    return changed.withColumn(text, F.col(covered)).drop(covered)
