"""SentencePiece encoding and decoding by the tokenizers library.

The tokeniser is rebuilt from the model's protobuf: the normaliser with its character map
and the mark for spaces, pieces with unigram scores or, for BPE models, merges in the
order of the scores, and bytes for what has no piece. No piece goes on after a space or a
line end, so a text's ids are those of its parts (a word with the spaces before it); each
distinct part is encoded once, many together in multithreaded batches, and its ids are
compared with those of the sentencepiece library. That verifies every text.

Defined cases: a NULL text counts as empty, an empty text has no ids; NULL ids of
documents and repeated rows are kept, one result each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from skymeter.llm.packing import slices
from skymeter.llm.pieces import BPE, BYTE, NORMAL, PARTS, SPACE, USER_DEFINED, PieceModel, normalized, read

# Distinct parts a Python worker remembers, and parts of one call.
CACHED_PARTS = 800_000
PARTS_PER_CALL = 200
# A code point that Unicode will never assign.
NO_TEXT = "\ufdd0"


def merges(model: PieceModel) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece: better scores first, then smaller ids."""
    number = {p: i for i, p in model.with_id(NORMAL, USER_DEFINED)}
    found = []
    for piece, made in number.items():
        for cut in range(1, len(piece)):
            left, right = number.get(piece[:cut]), number.get(piece[cut:])
            if left is not None and right is not None:
                found.append((-model.scores[made], left, right))
    found.sort()
    return [(model.pieces[left], model.pieces[right]) for _, left, right in found]


def build(model: PieceModel) -> Tokenizer:
    """The tokeniser of a model, for whole texts.

    For unigram models the library keeps bytes under names such as ``<0x0A>``, so texts
    that spell such a name out get the byte; ``differing_parts`` counts them.
    """
    unknown = model.pieces[model.unknown]
    if model.model_type == BPE:
        vocabulary = {p: i for i, p in enumerate(model.pieces)}
        backend = models.BPE(
            vocabulary, merges(model), unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback
        )
    else:
        # Other pieces are never made from text, not even from their names.
        text_kinds = (NORMAL, USER_DEFINED, BYTE)
        names = [p if k in text_kinds else f"{NO_TEXT}{p}" for p, k in zip(model.pieces, model.kinds, strict=True)]
        scored = list(zip(names, model.scores, strict=True))
        backend = models.Unigram(scored, model.unknown, model.byte_fallback)
    tokenizer = Tokenizer(backend)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra_spaces:
        steps += [normalizers.Replace(Regex(" +"), " "), normalizers.Replace(Regex("^ | $"), "")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", SPACE)])
    if model.is_cut_at_spaces():
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(PARTS.pattern), "isolated")
    tokenizer.decoder = decoders.Sequence(
        [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
        + ([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else [])
    )
    return tokenizer


class Codec:
    """Encodes and decodes texts, and compares the ids of all parts with the library's."""

    def __init__(self, path: str, cached_parts: int = CACHED_PARTS):
        self.model = read(path)
        if not self.model.is_cut_at_spaces():
            raise ValueError("pieces go on after spaces: use build() on whole texts")
        self.cached_parts = cached_parts
        self.tokenizer = build(self.model)
        # For parts, which have their spaces marked already.
        self.of_parts = build(self.model)
        self.of_parts.normalizer = normalizers.Sequence([])
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.library_prefix = len(self.library.encode("\n"))
        self.character_map = normalizers.Precompiled(self.model.charsmap) if self.model.charsmap else None
        self.line_end = self.model.pieces.index("<0x0A>")
        self.as_bytes = [b""] * len(self.model.pieces)
        for i, piece in self.model.with_id(NORMAL, USER_DEFINED):
            self.as_bytes[i] = piece.replace(SPACE, " ").encode()
        for i, piece in self.model.with_id(BYTE):
            self.as_bytes[i] = bytes([int(piece[3:-1], 16)])
        self._clear()

    def _clear(self) -> None:
        new: list[str] = []

        class Numbers(dict):
            def __missing__(self, part: str) -> int:
                number = self[part] = len(self)
                new.append(part)
                return number

        self.numbers, self.new = Numbers(), new
        # A line end is its byte; it is known from the start, since it separates new parts.
        self.numbers["\n"] = 0
        self.starts = np.zeros(1, np.int64)
        self.lengths = np.ones(1, np.int64)
        self.differs = np.zeros(1, bool)
        self.flat = np.array([self.line_end], np.int32)

    def _learn(self) -> None:
        """Encodes new parts, many in one text, by both libraries."""
        if not self.new:
            return
        calls = [self.new[i : i + PARTS_PER_CALL] for i in range(0, len(self.new), PARTS_PER_CALL)]
        ours = self.of_parts.encode_batch_fast(["\n".join(c) for c in calls], add_special_tokens=False)
        # The library puts a space before a text; a line end keeps it apart from the first part.
        theirs = self.library.encode(["\n" + "\n".join(c).replace(SPACE, " ") for c in calls])
        all_lengths, all_ids, all_differs = [], [], []
        for parts, mine, other in zip(calls, ours, theirs, strict=True):
            ids, lengths = self._cut(np.array(mine.ids, np.int32), len(parts))
            their_ids, their_lengths = self._cut(np.array(other[self.library_prefix :], np.int32), len(parts))
            differs = lengths != their_lengths
            if differs.any() or (ids != their_ids).any():
                ends, their_ends = np.cumsum(lengths), np.cumsum(their_lengths)
                for i in np.flatnonzero(~differs):
                    a, b = ends[i], their_ends[i]
                    differs[i] = (ids[a - lengths[i] : a] != their_ids[b - lengths[i] : b]).any()
            all_lengths.append(lengths)
            all_ids.append(ids)
            all_differs.append(differs)
        lengths = np.concatenate(all_lengths)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.differs = np.concatenate([self.differs, *all_differs])
        self.flat = np.concatenate([self.flat, *all_ids])
        self.new.clear()

    def _cut(self, ids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids without the line ends that join parts, and how many each part has."""
        ends = np.append(np.flatnonzero(ids == self.line_end), len(ids))
        if len(ends) != count:
            raise ValueError("parts and line ends do not agree")
        return ids[ids != self.line_end], np.diff(ends, prepend=-1) - 1

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[int]]:
        """The ids of each text, and how many of its parts the library encodes otherwise."""
        if len(self.numbers) > self.cached_parts:
            self._clear()
        number = self.numbers.__getitem__
        found = []
        for text in texts:
            if self.character_map:
                text = self.character_map.normalize_str(text)
            parts = PARTS.findall(normalized(text, self.model))
            found.append(np.fromiter(map(number, parts), np.int64, len(parts)))
        self._learn()
        out = []
        for parts in found:
            lengths = self.lengths[parts]
            ends = np.cumsum(lengths)
            at = np.repeat(self.starts[parts] - (ends - lengths), lengths)
            at += np.arange(len(at))
            out.append(self.flat[at])
        return out, [int(self.differs[parts].sum()) for parts in found]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no text are left to the tokeniser's decoder."""
        numbers = ids.tolist()
        try:
            text = b"".join(map(self.as_bytes.__getitem__, numbers)).decode()
        except UnicodeDecodeError:
            return self.tokenizer.decode(numbers, skip_special_tokens=True)
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encoded(documents: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, differing_parts`` of every document."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _texts(batches):
            ids, differing = codec(model_path).encode(texts)
            columns = [keys, pa.array(ids, pa.list_(pa.int32())), pa.array(differing, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "differing_parts"])

    return _chosen(documents, doc_id, text).mapInArrow(encode, "doc_id long, ids array<int>, differing_parts long")


def decoded(encodings: DataFrame, model_path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, text`` of every list of ids."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [codec(model_path).decode(np.array(i.as_py() or [], np.int32)) for i in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    chosen = encodings.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    return chosen.mapInArrow(decode, "doc_id long, text string")


def verified(documents: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, differing_parts, restored``: every document there and back.

    ``ids_crc32`` is that of the ids as little-endian 32-bit numbers, ``restored`` whether
    decoding gives the text again.
    """

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_tokens", "ids_crc32", "differing_parts", "restored"]
        for keys, texts in _texts(batches):
            coder = codec(model_path)
            ids, differing = coder.encode(texts)
            columns = [
                keys,
                pa.array([len(i) for i in ids], pa.int64()),
                pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()),
                pa.array(differing, pa.int64()),
                pa.array([coder.decode(i) == t for i, t in zip(ids, texts, strict=True)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_crc32 long, differing_parts long, restored boolean"
    return _chosen(documents, doc_id, text).mapInArrow(verify, schema)


def _chosen(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for begin, end in slices(texts):
            yield batch.column(0).slice(begin, end - begin), texts[begin:end]
