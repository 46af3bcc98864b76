"""SentencePiece models: the parts of the protobuf that encoding and decoding need."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

# Fixed values of the format: kinds of models and of pieces, and the mark of a space.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE = "▁"


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""

    def varint() -> int:
        nonlocal at
        value, shift = 0, 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    at = 0
    while at < len(data):
        key = varint()
        number, wire = key >> 3, key & 7
        if wire == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(wire) or varint()
        yield number, data[at : at + size]
        at += size


@dataclass
class PieceModel:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra_spaces: bool = True

    @property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)

    def with_id(self, *kinds: int) -> Iterator[tuple[int, str]]:
        return ((i, p) for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k in kinds)

    def is_cut_at_spaces(self) -> bool:
        """Whether no piece goes on with a space or a line end, so that texts can be encoded in parts."""
        inside = re.compile(f"[^{SPACE}]{SPACE}|\n")
        return self.byte_fallback and not any(inside.search(p) for _, p in self.with_id(NORMAL, USER_DEFINED))


def parse(data: bytes) -> PieceModel:
    model = PieceModel()
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            model.pieces.append(piece.get(1, b"").decode())
            model.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            model.kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            trainer = dict(fields(value))
            model.model_type = trainer.get(3, UNIGRAM)
            model.byte_fallback = bool(trainer.get(35, 0))
        elif number == 3:
            normalizer = dict(fields(value))
            model.charsmap = normalizer.get(2, b"")
            model.dummy_prefix = bool(normalizer.get(3, 1))
            model.remove_extra_spaces = bool(normalizer.get(4, 1))
    return model


def read(path: str) -> PieceModel:
    return parse(Path(path).read_bytes())


# Parts of a normalised text, of which no piece spans two: a word with the spaces before
# it, spaces at the end, a line end.
PARTS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


def normalized(text: str, model: PieceModel) -> str:
    """The text with its spaces marked, for models without a character map."""
    if model.remove_extra_spaces:
        text = " ".join(w for w in text.split(" ") if w)
    if not text:
        return ""
    return ((" " if model.dummy_prefix else "") + text).replace(" ", SPACE)
