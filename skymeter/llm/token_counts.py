"""Token counts of documents under a unigram vocabulary, by dynamic programming on a trie.

The best split of a text into scored pieces is that of its parts (a word with the spaces
before it), since no piece goes on after a space or a line end. Distinct parts go into a
trie of characters. A node holds the forward score of its prefix, the best sum of piece
scores over all ways to build it, and the number of pieces of that way; both depend on
the nodes above only, so prefixes that parts share are computed once. The count at a
part's last node is stored, and a document's count is the sum over its parts. Parts too
long to be likely to come again are scored without nodes, through a window as long as the
longest piece.

Pieces come from a SentencePiece model. A character without a piece costs
less than any piece, and counts as its UTF-8 bytes. Equal scores go to the longer last
piece.

Defined cases: a NULL text counts as empty and has no tokens; NULL ids and repeated rows
are kept, one result each; an empty table gives no rows.
"""

from __future__ import annotations

import math
from array import array
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymeter.llm.packing import slices
from skymeter.llm.pieces import NORMAL, PARTS, UNIGRAM, USER_DEFINED, PieceModel, normalized, read

# Nodes a Python worker keeps before it starts a new trie: below 300 MB.
MOST_NODES = 1_000_000
# Characters from which on a part gets no nodes.
LONG_PART = 200
# How much less than the worst piece a character without one scores.
UNKNOWN_PENALTY = 10.0


def unigram_scores(model: PieceModel) -> dict[str, float]:
    """Log-probabilities of the pieces.

    Those of a unigram model are in the model. A BPE model only has the order in which
    its pieces were made; they then follow Zipf's law.
    """
    known = list(model.with_id(NORMAL, USER_DEFINED))
    if model.model_type == UNIGRAM:
        return {p: model.scores[i] for i, p in known}
    return {p: -math.log(rank + 2) for rank, (_, p) in enumerate(known)}


class CountTrie:
    """Token counts of parts, with forward scores shared along common prefixes."""

    def __init__(self, model: PieceModel, most_nodes: int = MOST_NODES):
        if model.charsmap or not model.is_cut_at_spaces():
            raise ValueError("the model's texts cannot be counted in parts")
        self.model, self.most_nodes = model, most_nodes
        self.scores = unigram_scores(model)
        # Ends of pieces: where a prefix ends in none, no longer piece ends there either.
        self.endings = {p[i:] for p in self.scores for i in range(len(p))}
        self.longest = max(map(len, self.scores))
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY
        self._clear()

    def _clear(self) -> None:
        insert = self.insert

        class Counts(dict):
            def __missing__(self, part: str) -> int:
                count = self[part] = insert(part)
                return count

        self.counts = Counts()
        # Node 0 is the empty prefix; an edge is its node and character in one number.
        self.edges: dict[int, int] = {}
        self.forward = array("d", [0.0])
        self.tokens = array("i", [0])

    def insert(self, part: str) -> int:
        """Adds the part's path, computing the nodes that are new; the count at its end."""
        node, path, edges = 0, [0], self.edges
        for depth, character in enumerate(part, 1):
            edge = node << 21 | ord(character)
            node = edges.get(edge)
            if node is None:
                node = edges[edge] = len(self.forward)
                self._score(part, depth, path)
            path.append(node)
        return self.tokens[node]

    def _score(self, part: str, depth: int, path: list[int]) -> None:
        scores, forward, endings = self.scores, self.forward, self.endings
        character = part[depth - 1]
        best, tokens = -math.inf, 0
        if character not in scores:
            best = forward[path[depth - 1]] + self.unknown
            tokens = self.tokens[path[depth - 1]] + len(character.encode("utf-8", "replace"))
        for begin in range(depth - 1, -1, -1):
            ending = part[begin:depth]
            if ending not in endings:
                break
            score = scores.get(ending)
            if score is not None and forward[path[begin]] + score >= best:
                best = forward[path[begin]] + score
                tokens = self.tokens[path[begin]] + 1
        forward.append(best)
        self.tokens.append(tokens)

    def _windowed(self, part: str) -> int:
        """The count of a part, with no more than the longest piece's prefixes in memory."""
        scores = self.scores
        forward, tokens = deque([0.0], self.longest), deque([0], self.longest)
        for depth in range(1, len(part) + 1):
            best, count = -math.inf, 0
            if part[depth - 1] not in scores:
                best = forward[-1] + self.unknown
                count = tokens[-1] + len(part[depth - 1].encode("utf-8", "replace"))
            for back in range(1, len(forward) + 1):
                ending = part[depth - back : depth]
                if ending not in self.endings:
                    break
                if ending in scores and forward[-back] + scores[ending] >= best:
                    best, count = forward[-back] + scores[ending], tokens[-back] + 1
            forward.append(best)
            tokens.append(count)
        return tokens[-1]

    def count(self, text: str) -> tuple[int, int]:
        """Parts and tokens of a text."""
        if len(self.forward) > self.most_nodes:
            self._clear()
        parts = PARTS.findall(normalized(text, self.model))
        counts = self.counts
        return len(parts), sum(counts[p] if len(p) <= LONG_PART else self._windowed(p) for p in parts)


_tries: dict[str, CountTrie] = {}


def _trie(path: str) -> CountTrie:
    if path not in _tries:
        _tries[path] = CountTrie(read(path))
    return _tries[path]


def token_counts(documents: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_parts, n_tokens`` of every document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(model_path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for begin, end in slices(texts):
                found = [trie.count(t) for t in texts[begin:end]]
                columns = [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)]
                keys = batch.column(0).slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([keys, *columns], ["doc_id", "n_parts", "n_tokens"])

    chosen = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(count, "doc_id long, n_parts long, n_tokens long")
