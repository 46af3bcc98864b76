"""Packing of tokenised documents into sequences by bounded-space online best-fit.

Every document becomes its token ids plus one end id; only documents longer than a
sequence are cut, into full pieces and a last shorter one. Pieces are then packed by an
online best-fit with a fixed number of open bins. The open bins are kept by free space,
and a bitset has a bit for each free space in use, so the best bin for a piece (the
lowest set bit at or above its length) and the fullest bin (the lowest set bit) are one
shift away. When all bins are open and a piece fits in none, the fullest is closed.

Defined cases: a NULL text counts as empty; an empty document is its end id alone; NULL
ids are kept as they are; repeated rows are packed once each; an empty table gives no
rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skymeter.llm.batches import map_texts
from skymeter.session import load, store

SEQUENCE_TOKENS = 2048
END_ID = 0
OPEN_BINS = 1024
# Pieces packed by one task: some MB, and some thousand sequences, of which the last
# open bins stay partly empty.
PIECES_PER_TASK = 50_000
# Distinct words a worker remembers, over all its tasks: below 80 MB.
CACHED_WORDS = 300_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"

# What the lower-casing pre-tokeniser makes of a word of characters below U+0250, where
# every letter and digit can be listed: contractions, letters, single digits, the rest.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGITS = "0-9²³¹¼-¾"
_UNITS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}]+")
_BEYOND = "\u024f"
_OTHER = frozenset("\x1c\x1d\x1e\x1f\u0130")


def _is_plain(text: str) -> bool:
    """Of the text and of what it becomes in lower case: some letters leave the listed range there."""
    seen = set(text)
    seen |= set("".join(seen).lower())
    return max(seen, default="") <= _BEYOND and _OTHER.isdisjoint(seen) and "<|" not in text


class WordEncoder:
    """Token ids of whole texts by a word-level tokeniser, each distinct word encoded once.

    The tokeniser cuts a text at white space and then into units (letters, single digits,
    other characters), and encodes every unit by itself; the last token of a unit is
    marked as such. So a text's ids are those of its words one after another, and many
    words can be encoded in one call. Texts with characters beyond U+024F, in lower case
    too, separators that are white space to one side only, or the mark of a special token
    are handed to the tokeniser whole; so are all texts of a call whose units are not as
    many as counted.

    Words are remembered. If there are too many, those seen only once go.
    """

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        self.tokenizer = Tokenizer.from_file(path)
        self.cached_words = cached_words
        self.is_end = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.is_end[number] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        """Starts without known words."""
        self._know([], np.zeros(0, np.int64), np.zeros(0, np.uint32))

    def _know(self, words: list[str], lengths: np.ndarray, flat: np.ndarray) -> None:
        """Starts with these words, of which each has so many of the ids."""
        new: list[str] = []

        class Numbers(dict):
            def __missing__(self, word: str) -> int:
                number = self[word] = len(self)
                new.append(word)
                return number

        self.numbers, self.new = Numbers(zip(words, range(len(words)))), new
        self.starts, self.lengths, self.flat = np.cumsum(lengths) - lengths, lengths, flat
        self.seen = np.zeros(len(words), np.int64)

    def _ids(self, words: np.ndarray) -> np.ndarray:
        """The ids of known words, one after another."""
        lengths = self.lengths[words]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[words] - (ends - lengths), lengths)
        at += np.arange(len(at))
        return self.flat[at]

    def _keep_repeated(self) -> None:
        """Forgets words seen once, and all but the most frequent if that is not enough."""
        kept = np.flatnonzero(self.seen > 1)
        kept = np.sort(kept[np.argsort(-self.seen[kept], kind="stable")][: self.cached_words // 2])
        words = list(self.numbers)
        self._know([words[i] for i in kept], self.lengths[kept], self._ids(kept))

    def _learn(self) -> bool:
        """Encodes the new words; False if their units are not those the tokeniser sees."""
        if not self.new:
            return True
        joined = [" ".join(self.new[i : i + 500]) for i in range(0, len(self.new), 500)]
        parts = []
        for i in range(0, len(joined), 8):  # encodings are large: tokens, places, masks
            encoded = self.tokenizer.encode_batch_fast(joined[i : i + 8], add_special_tokens=False)
            parts += [np.array(e.ids, np.uint32) for e in encoded]
        ids = np.concatenate(parts)
        units = np.fromiter((len(_UNITS.findall(w)) for w in self.new), np.int64, len(self.new))
        unit_ends = np.flatnonzero(self.is_end[ids]) + 1
        if units.sum() != len(unit_ends):
            return False
        ends = np.append(0, unit_ends)[np.cumsum(units)]
        begins = np.append(0, ends[:-1])
        self.starts = np.concatenate([self.starts, len(self.flat) + begins])
        self.lengths = np.concatenate([self.lengths, ends - begins])
        self.flat = np.concatenate([self.flat, ids])
        self.seen = np.concatenate([self.seen, np.zeros(len(self.new), np.int64)])
        self.new.clear()
        return True

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.numbers) > self.cached_words:
            self._keep_repeated()
        plain = [_is_plain(t) for t in texts]
        number = self.numbers.__getitem__
        found = []
        for text, is_plain in zip(texts, plain, strict=True):
            words = text.lower().split() if is_plain else []
            found.append(np.fromiter(map(number, words), np.int64, len(words)))
        if not self._learn():
            self.forget()
            plain = [False] * len(texts)
        others = iter(
            self.tokenizer.encode_batch_fast(
                [t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False
            )
        )
        out = []
        for words, is_plain in zip(found, plain, strict=True):
            out.append(self._ids(words) if is_plain else np.array(next(others).ids, np.uint32))
        used = [words for words, is_plain in zip(found, plain, strict=True) if is_plain]
        self.seen += np.bincount(np.concatenate([np.zeros(0, np.int64), *used]), minlength=len(self.seen))
        return out


# The library does not free a tokeniser, so a worker keeps one for all its tasks.
_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


@contextmanager
def _one_thread() -> Iterator[None]:
    """Within it, the library encodes on the task's own core only."""
    name = "TOKENIZERS_PARALLELISM"
    before = os.environ.get(name)
    os.environ[name] = "false"
    try:
        yield
    finally:
        os.environ.pop(name)
        if before is not None:
            os.environ[name] = before


def slices(column: list, most_chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive rows with at most so many characters, one row at least."""
    begin, chars = 0, 0
    for i, text in enumerate(column):
        if chars and chars + len(text) > most_chars:
            yield begin, i
            begin, chars = i, 0
        chars += len(text)
    if begin < len(column):
        yield begin, len(column)


def token_pieces(
    documents: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    sequence_tokens: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces ``doc_id, piece, start, length, ids_crc32`` of the tokenised documents.

    ``with_ids`` adds the ids themselves (``ids array<int>``).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for batch in batches:
            keys, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for begin, end in slices(texts):
                with _one_thread():
                    encoded = encoder.encode(texts[begin:end])
                rows: list[tuple] = []
                for row, ids in enumerate(encoded, begin):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), sequence_tokens)):
                        part = ids[start : start + sequence_tokens]
                        rows.append((row, piece, start, len(part), zlib.crc32(part.tobytes()), part))
                row, piece, start, length, crc, parts = zip(*rows, strict=True)
                columns = [
                    keys.take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([p.astype("int32") for p in parts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = PIECES + ", ids array<int>" * with_ids
    chosen = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_texts(chosen, cut, schema)


class OpenBins:
    """A fixed number of open bins, found by free space through a bitset."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits, self.open, self.next_bin = 0, 0, 0
        self.by_free: dict[int, list[int]] = {}

    def _put(self, free: int, number: int) -> None:
        self.by_free.setdefault(free, []).append(number)
        self.bits |= 1 << free
        self.open += 1

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset for a piece: the fullest open bin it fits in, else a new one."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, number = self.capacity, self.next_bin
            self.next_bin += 1
        if free > length:
            self._put(free - length, number)
        return number, self.capacity - free


def pack(
    pieces: DataFrame,
    rows: int,
    sequence_tokens: int = SEQUENCE_TOKENS,
    open_bins: int = OPEN_BINS,
    pieces_per_task: int = PIECES_PER_TASK,
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces with a ``length``, in place of ``deal``.

    ``rows``, the number of pieces, sets the number of tasks. ``deal``, a hash of a row
    number, deals the pieces out evenly, equal ones too; each task packs its share by
    itself in the order of that hash, so that one that runs again gives the same sequences.
    """
    tasks = max(1, -(-rows // pieces_per_task))
    names = [c for c in pieces.columns if c != "deal"] + ["sequence_id", "offset"]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(sequence_tokens, open_bins)
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            at = [bins.place(n) for n in batch.column(length_at).to_pylist()]
            sequence = pa.array([first + b for b, _ in at], pa.int64())
            offset = pa.array([o for _, o in at], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sequence, offset], names)

    length_at = names.index("length")
    schema = pieces.drop("deal").schema.add("sequence_id", "long").add("offset", "long")
    dealt = pieces.repartition(tasks, "deal").sortWithinPartitions("deal", "length").drop("deal")
    return dealt.mapInArrow(fill, schema)


def packed_documents(
    documents: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    sequence_tokens: int = SEQUENCE_TOKENS,
    open_bins: int = OPEN_BINS,
    with_ids: bool = False,
    pieces_per_task: int = PIECES_PER_TASK,
) -> DataFrame:
    """Documents tokenised, cut and packed; one row per piece.

    The pieces are stored once in the shared folder, so that texts are tokenised once
    and their number is known before they are dealt out.
    """
    pieces = token_pieces(documents, tokenizer_path, doc_id, text, sequence_tokens, END_ID, with_ids)
    pieces = pieces.withColumn("deal", F.xxhash64(F.monotonically_increasing_id()))
    seen = Observation()
    path = store(pieces, "pieces", seen, [F.count(F.lit(1)).alias("rows")])
    stored = load(documents.sparkSession, path, pieces.schema)
    return pack(stored, seen.get["rows"], sequence_tokens, open_bins, pieces_per_task)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids``: the sequences of packed pieces that carry their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"),
    )
