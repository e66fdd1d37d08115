"""Token counts without tokens: a Viterbi pass that carries best score and piece count only."""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import Memo, pick, text_slices
from tidegrid.llm.lattice import GAP, SPACE, Vocabulary, automaton, build

SLICE_BYTES = 4 << 20
#: Longer words are walked one by one in the memory of the longest piece.
LONG_WORD = 2_048
#: Below the least score, as the tokenizer has it.
UNKNOWN_PENALTY = 10.0
FIRST, SECOND = itemgetter(0), itemgetter(1)


class Counter:
    """Piece count and best score of words under a unigram vocabulary.

    The tokenizer's rules: a piece replaces what was found for its end only if its score is strictly
    better, and pieces are tried from the earliest start on, so of equal ones the longest wins; scores
    are added from the left in doubles; a character that is no piece of its own may be unknown, at the
    least score less ``UNKNOWN_PENALTY``, and counts as its UTF-8 bytes. Control pieces match their own
    spelling, as in the tokenizer, at a score that always loses against single characters.
    """

    def __init__(self, vocabulary: Vocabulary):
        n = len(vocabulary.pieces)
        usable = {p: i for i, p in enumerate(vocabulary.pieces) if p and GAP not in p}
        self.machine = automaton(usable)
        self.single = {p for p in usable if len(p) == 1}
        self.scores = np.append(vocabulary.scores, vocabulary.scores.min() - UNKNOWN_PENALTY)
        self.lengths = np.append(np.fromiter(map(len, vocabulary.pieces), np.int64, n), 1)
        self.unknown = n
        self.longest = int(self.lengths.max())

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        long = [i for i, w in enumerate(words) if len(w) > LONG_WORD]
        if not long:
            return self._together(words)
        count, best = np.empty(len(words), np.int64), np.empty(len(words))
        if short := sorted(set(range(len(words))).difference(long)):
            count[short], best[short] = self._together([words[i] for i in short])
        for i in long:
            count[i], best[i] = self._alone(words[i])
        return count, best

    def _alone(self, word: str) -> tuple[int, float]:
        """Count and score of one word, character by character: only the nodes that a piece can still begin at are held, so
        memory doesn't grow with the word. Order of trials and sums are those of ``_together``."""
        ring, lengths, scores, strange = self.longest + 1, self.lengths.tolist(), self.scores.tolist(), set(word) - self.single
        best, count = [-math.inf] * ring, [0] * ring
        best[0] = 0.0
        hits = self.machine.iter(word)
        last, piece = next(hits, (-1, -1))
        for i, c in enumerate(word):
            top, n = -math.inf, 0
            while last == i:
                tail = (i + 1 - lengths[piece]) % ring
                value = best[tail] + scores[piece]
                if value > top:
                    top, n = value, count[tail] + 1
                last, piece = next(hits, (-1, -1))
            if c in strange:
                value = best[i % ring] + scores[self.unknown]
                if value > top:
                    top, n = value, count[i % ring] + len(c.encode("utf-8", "surrogatepass"))
            best[(i + 1) % ring], count[(i + 1) % ring] = top, n
        return count[len(word) % ring], best[len(word) % ring]

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All words at once, a layer of the lattice a step."""
        strange = np.array(sorted({ord(c) for c in set("".join(words)) - self.single}), np.uint32)
        lattice = build(words, self.machine, self.lengths, (strange, self.unknown))
        layout = GAP.join(words) + GAP
        points = np.frombuffer(layout.encode("utf-32-le"), np.uint32)
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        best, count = np.full(len(points) + 1, -np.inf), np.zeros(len(points) + 1, np.int64)
        best[lattice.starts] = 0.0
        for layer in range(len(lattice.layers) - 1):
            at, first = lattice.groups(layer)
            if not len(first):
                continue
            tail, piece = lattice.tail[at], lattice.piece[at]
            value = best[tail] + self.scores[piece]
            top = np.maximum.reduceat(value, first)
            sizes = np.diff(np.append(first, len(value)))
            place = np.where(value == np.repeat(top, sizes), np.arange(len(value)), len(value))
            won = np.minimum.reduceat(place, first)
            node = lattice.head[at][first]
            pieces = np.where(piece[won] == self.unknown, width[tail[won]], 1)
            best[node], count[node] = top, count[tail[won]] + pieces
        return count[lattice.ends], best[lattice.ends]


def count_tokens(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_tokens, score) per row: the number of pieces of the best segmentation of the whole text.

    Spaces become U+2581, one is put before the text, and every U+2581 starts a word (splitting is
    on U+0020 only; other white space is part of words). A null text counts as empty, and an empty text
    has no tokens. Words are counted once per task's memo; repeated rows get equal counts.
    """
    plain = pick(docs, key, text).toDF("key", "text").select("key", F.coalesce("text", F.lit("")).alias("text"))
    kind = plain.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(Vocabulary.load(vocabulary))

        def learn(words: list[str]) -> Iterator[tuple[int, float]]:
            # GAP lays words out, so a word with that character is counted under a stand-in no piece has
            counts, scores = counter([SPACE + w.replace(GAP, "\x00") for w in words])
            return zip(counts.tolist(), scores.tolist(), strict=True)

        memo = Memo(learn, 300_000)
        for batch in batches:
            for a, b in text_slices(batch, 1, SLICE_BYTES):
                part = batch.slice(a, b - a)
                split = [(SPACE + t.replace(" ", SPACE)[t.startswith((" ", SPACE)) :]).split(SPACE)[1:] if t else [] for t in part.column(1).to_pylist()]
                known = memo.of(set().union(*split))
                found = [list(map(known.__getitem__, ws)) for ws in split]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([len(ws) for ws in split], pa.int64()), pa.array([int(sum(map(FIRST, f))) for f in found], pa.int64()),
                        pa.array([float(sum(map(SECOND, f))) for f in found], pa.float64()),
                    ],
                    names=["key", "n_words", "n_tokens", "score"],
                )

    return plain.mapInArrow(run, f"key {kind}, n_words long, n_tokens long, score double").withColumnRenamed("key", key)
