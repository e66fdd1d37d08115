"""Piece lattices of many words at once: Aho-Corasick matches, and dynamic programs over them."""

from __future__ import annotations

from dataclasses import dataclass

import ahocorasick
import numpy as np

SPACE = "▁"
#: Words are laid out one after another, each followed by this character, which no piece has.
GAP = "\n"


@dataclass
class Vocabulary:
    """Pieces of a public SentencePiece model with unigram weights.

    The public model holds merge ranks, not probabilities, and nothing is trained here: a piece of rank
    r gets the weight of Zipf's law, -ln(r + 1). Control pieces and the 256 byte pieces can't be part
    of a text; they get ``CONTROL``.
    """

    pieces: list[str]
    scores: np.ndarray
    byte_ids: np.ndarray
    control: np.ndarray

    CONTROL = -10_000.0

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        control = np.array([model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(n)])
        ranks = np.array([-model.get_score(i) for i in range(n)])
        scores = np.where(control, cls.CONTROL, -np.log(np.maximum(ranks, 0) + 1.0))
        bytes_ = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        return cls(pieces, scores, bytes_, control)


def automaton(pieces: dict[str, int]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for piece, number in pieces.items():
        found.add_word(piece, number)
    found.make_automaton()
    return found


@dataclass
class Lattice:
    """Edges over the characters of all words; node i is the place before character i of the layout.
    Edges are sorted by the distance of their end from the word's start, then by end, longest first."""

    tail: np.ndarray
    head: np.ndarray
    piece: np.ndarray
    #: edges[layers[k]:layers[k+1]] end k + 1 characters into their words
    layers: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    #: where each edge stands when all are sorted by end, longest first
    order: np.ndarray

    def groups(self, layer: int) -> tuple[slice, np.ndarray]:
        """The edges of a layer, and where each end's edges begin in it."""
        at = slice(self.layers[layer], self.layers[layer + 1])
        head = self.head[at]
        return at, np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]])) if len(head) else np.empty(0, np.int64)


def build(words: list[str], machine: ahocorasick.Automaton, lengths: np.ndarray, extra: tuple[np.ndarray, int] | None = None) -> Lattice:
    """The lattice of ``words``; ``extra`` adds one-character edges (code points, piece number)."""
    layout = GAP.join(words) + GAP
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    hits = np.fromiter(machine.iter(layout), np.dtype([("last", np.int64), ("piece", np.int64)]))
    head, piece = hits["last"] + 1, hits["piece"]
    if extra is not None:
        points = np.frombuffer(layout.encode("utf-32-le"), np.uint32)
        unknown = np.flatnonzero(np.isin(points, extra[0]))
        head, piece = np.concatenate([head, unknown + 1]), np.concatenate([piece, np.full(len(unknown), extra[1])])
        order = np.argsort(head, kind="stable")
        head, piece = head[order], piece[order]
    # the automaton tells hits by their end, longest first, which a stable sort by distance keeps
    sizes_at = np.repeat(starts, sizes + 1)[np.minimum(head, len(layout) - 1)] if len(head) else head
    into = head - sizes_at
    deepest = int(sizes.max(initial=0))
    order = np.argsort(into.astype(np.int16) if deepest < 1 << 15 else into, kind="stable")
    by_layer = into[order]
    return Lattice(
        (head - lengths[piece])[order], head[order], piece[order], np.searchsorted(by_layer, np.arange(1, deepest + 2)), starts, ends, order
    )
