"""A unigram variant of a SentencePiece model, for comparison with the library."""

from __future__ import annotations

import struct
from pathlib import Path

from skymeter.llm import pieces
from skymeter.llm.token_counts import unigram_scores


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _field(number: int, data: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def unigram_model(path: str) -> tuple[bytes, dict[str, float]]:
    """The model's protobuf with the type unigram and log-probabilities as scores, and these."""
    data = Path(path).read_bytes()
    scores = unigram_scores(pieces.parse(data))
    out = b""
    for number, value in pieces.fields(data):
        if number == 1:
            piece = dict(pieces.fields(value))
            score = scores.get(piece[1].decode(), 0.0)
            value = _field(1, piece[1]) + _varint(2 << 3 | 5) + struct.pack("<f", score)
            if 3 in piece:
                value += _varint(3 << 3) + _varint(piece[3])
        elif number == 2:
            value += _varint(3 << 3) + _varint(pieces.UNIGRAM)
        out += _field(number, value)
    return out, scores
