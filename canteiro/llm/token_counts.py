"""Token counts by a unigram model, with dynamic programming shared in a trie of pre-tokens.

A pre-token is a word with the word mark before it. Its best segmentation has the highest sum of piece scores. The
forward score of a prefix does not depend on what follows, so the distinct pre-tokens of a task are inserted in a trie
and each node gets its forward score once, from its ancestors; the count at a pre-token's last node is its result. Only pieces that can end
with a prefix's last characters are looked up for it.
Documents sum the counts of their pre-tokens. The trie starts anew when it has ``max_nodes`` nodes, and the known words
when they are as many; counts do not depend on that, and no document or table of pre-tokens is moved.

The vocabulary file holds pieces by rank. A piece's score is the logarithm of its share under Zipf's law of that rank.
A character that is no piece costs its UTF-8 bytes, each with a score below that of every piece. Of segmentations with
equal scores the one whose last piece is longer is taken, at every place.

Defined cases: a NULL or empty text has no words and no tokens; a very long word is counted outside the trie, by the
same scores; repeated rows are counted like any others; other
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canteiro.llm.common import in_tasks

WORD_MARK = "▁"
MAX_NODES = 500_000
# an unknown byte scores this much below the rarest piece
BYTE_PENALTY = 10.0

_COUNTERS: dict[tuple[str, int], "PretokenCounts"] = {}


def piece_scores(path: str) -> dict[str, float]:
    """Score of each piece of a vocabulary file; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranked = [
        (-model.get_score(i), model.id_to_piece(i))
        for i in range(model.vocab_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    ranked.sort()
    total = math.log(sum(1 / rank for rank in range(1, len(ranked) + 1)))
    return {piece: -math.log(rank) - total for rank, (_, piece) in enumerate(ranked, 1)}


# letters of a word that goes into the trie; longer ones are counted by themselves
LONGEST_IN_TRIE = 4096


# characters by which the pieces that may end at a place are known
TAIL = 3


class _Endings(dict):
    """By the last characters before a place: the lengths that a longer piece may have there, the pieces that are no
    longer than these characters, and the bytes of the last character with their score. Longest first."""

    def __init__(self, scores: dict[str, float], byte_score: float):
        super().__init__()
        self._scores, self._byte_score = scores, byte_score
        longer: dict[str, set[int]] = {}
        for piece in scores:
            if len(piece) > TAIL:
                longer.setdefault(piece[-TAIL:], set()).add(len(piece))
        self._longer = {tail: tuple(sorted(lengths, reverse=True)) for tail, lengths in longer.items()}

    def __missing__(self, tail: str) -> tuple:
        ends = ((length, self._scores.get(tail[-length:])) for length in range(len(tail), 0, -1))
        unknown = len(tail[-1].encode())
        short = tuple((length, score) for length, score in ends if score is not None)
        self[tail] = found = self._longer.get(tail, ()), short, unknown, unknown * self._byte_score
        return found


CHARACTERS = 0x110000


class PretokenCounts(dict):
    """Token count of each word met so far; a missing word is inserted in the trie when it is asked for."""

    def __init__(self, scores: dict[str, float], max_nodes: int = MAX_NODES):
        super().__init__()
        self._scores = scores
        self._longest = max(map(len, scores), default=1)
        self._byte_score = min(scores.values(), default=0.0) - BYTE_PENALTY
        self._max_nodes = max_nodes
        self._endings = _Endings(scores, self._byte_score)
        self._restart()

    def _restart(self) -> None:
        if len(self._endings) > self._max_nodes:
            self._endings.clear()
        # by node and character as one number: numbers are no work for the garbage collector
        self._children: dict[int, int] = {}
        self._best, self._count = [0.0], [0]

    def __missing__(self, word: bytes) -> int:
        if len(self._best) > self._max_nodes:
            self._restart()
            # known words need no node; they are kept until they are as many
            if len(self) > self._max_nodes:
                self.clear()
        pretoken = WORD_MARK + word.decode()
        if len(pretoken) > LONGEST_IN_TRIE:
            return self._alone(pretoken)
        following, node, path = self._children.get, 0, [0]
        for character in map(ord, pretoken):
            node = following(node * CHARACTERS + character)
            if node is None:
                self._extend(pretoken, path)
                break
            path.append(node)
        self[word] = count = self._count[path[-1]]
        return count

    def _alone(self, pretoken: str) -> int:
        """Count of a very long word, which shares little with others: the same scores, of which only the last few
        are kept."""
        recent = deque([(0.0, 0)], maxlen=self._longest)
        for end in range(1, len(pretoken) + 1):
            score, count = None, 0
            for length in range(min(self._longest, end), 0, -1):
                piece = self._scores.get(pretoken[end - length : end])
                if piece is not None:
                    best, n = recent[-length]
                    if score is None or best + piece > score:
                        score, count = best + piece, n + 1
            unknown = len(pretoken[end - 1].encode())
            best, n = recent[-1]
            if score is None or best + unknown * self._byte_score > score:
                score, count = best + unknown * self._byte_score, n + unknown
            recent.append((score, count))
        return recent[-1][1]

    def _extend(self, pretoken: str, path: list[int]) -> None:
        """New nodes for the prefixes beyond the path, each with its forward score from its ancestors."""
        get, endings, children = self._scores.get, self._endings, self._children
        bests, counts, node = self._best, self._count, path[-1]
        for end in range(len(path), len(pretoken) + 1):
            longer, short, unknown, unknown_score = endings[pretoken[end - TAIL if end > TAIL else 0 : end]]
            score, count = None, 0
            for length in longer:
                if length <= end:
                    piece = get(pretoken[end - length : end])
                    if piece is not None:
                        before = path[end - length]
                        best = bests[before] + piece
                        if score is None or best > score:
                            score, count = best, counts[before] + 1
            for length, piece in short:
                before = path[end - length]
                best = bests[before] + piece
                if score is None or best > score:
                    score, count = best, counts[before] + 1
            best = bests[node] + unknown_score
            if score is None or best > score:
                score, count = best, counts[node] + unknown
            children[node * CHARACTERS + ord(pretoken[end - 1])] = node = len(bests)
            bests.append(score)
            counts.append(count)
            path.append(node)


def counter(vocabulary: str, max_nodes: int = MAX_NODES) -> PretokenCounts:
    """The worker's counts for a vocabulary; they serve all tasks of the worker."""
    key = (vocabulary, max_nodes)
    if key not in _COUNTERS:
        _COUNTERS[key] = PretokenCounts(piece_scores(vocabulary), max_nodes)
    return _COUNTERS[key]


def counted(
    documents: DataFrame,
    vocabulary: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    max_nodes: int = MAX_NODES,
) -> DataFrame:
    """One row per document: its id, n_words and n_tokens."""
    texts = documents.select(F.col(id_column).alias("doc"), F.col(text_column).alias("text"))
    kind = texts.schema["doc"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(vocabulary, max_nodes)
        for batch in batches:
            n_words, n_tokens = [], []
            for text in batch.column("text"):
                # bytes are split at the six ASCII white-space characters only
                words = (text.as_py() or "").encode().split()
                n_words.append(len(words))
                n_tokens.append(sum(map(counts.__getitem__, words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(n_words, type=pa.int64()), pa.array(n_tokens, type=pa.int64())],
                names=["doc", "n_words", "n_tokens"],
            )

    return in_tasks(texts, count, f"doc {kind}, n_words long, n_tokens long").withColumnRenamed("doc", id_column)
