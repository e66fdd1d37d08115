"""SentencePiece segmentations sampled by forward filtering and backward sampling, and lossless decoding."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import pick, text_slices
from tidegrid.llm.lattice import SPACE, Vocabulary, automaton, build

#: No piece crosses into a space from the left or contains a line break, so the lattice of a text is
#: that of these chunks one after another, and they can be sampled independently. Where no piece mixes
#: letters and digits with other characters either, chunks end there too, and more of them are alike.
COARSE = re.compile(" *[^ \n]+| +|\n")
FINE = re.compile(r" *[^\W_]+| *(?:[^\w \n]|_)+| +|\n")
#: Stand-ins for bytes that are written as byte pieces: private-use characters, which no piece has.
BYTE_BASE = 0xF0000
SLICE_BYTES = 4 << 20
#: Chunks whose sampling tables a task keeps; it starts afresh beyond.
TABLE_CHUNKS = 500_000
#: Shares of a node's edges are counted in units of one over this.
SHARES = float(1 << 40)

#: Longer chunks are walked in windows of ``WINDOW`` characters, whose tables are dropped after use.
LONG_CHUNK = 4_096
WINDOW = 1 << 16
DRAWS = 1 << 12

_STEP = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sampler:
    """Samples segmentations with P(segmentation) proportional to exp(alpha * sum of scores).

    For every new chunk the forward pass gives each node the log of the summed weight of all ways to
    reach it, and each edge into a node its share of that. A segmentation is then drawn from the chunk's
    end backwards, one edge a step, for all chunks of many rows at once. The random numbers are hashes
    of row seed, chunk number and step, so a row's segmentation doesn't depend on batches, tasks or reruns.
    A character that is no piece of its own, and U+2581 itself, is written as byte pieces.

    Chunks of over ``LONG_CHUNK`` characters (unbroken runs) aren't kept as tables: a first pass keeps what the next window
    needs of each window's end, and the draw goes back window by window with that window's table made again. Memory is
    that of one window and of the ids, whatever the length.
    """

    def __init__(self, vocabulary: Vocabulary, alpha: float):
        usable = {p: i for i, p in enumerate(vocabulary.pieces) if p and not vocabulary.control[i]}
        self.single = {p for p in usable if len(p) == 1} - {SPACE}
        usable = {p: i for p, i in usable.items() if all(c == SPACE or c in self.single for c in p)}
        usable |= {chr(BYTE_BASE + b): int(i) for b, i in enumerate(vocabulary.byte_ids)}
        mixed = any(len({c.isalnum() for c in p.lstrip(SPACE)}) > 1 for p in usable)
        self.chunks = (COARSE if mixed else FINE).findall
        self.machine = automaton(usable)
        self.lengths = np.ones(len(vocabulary.pieces), np.int64)
        for p, i in usable.items():
            self.lengths[i] = len(p)
        self.longest = max(map(len, usable))
        self.weights = np.where(vocabulary.control, 0.0, vocabulary.scores * alpha)
        self.reset()

    def reset(self) -> None:
        self.place: dict[str, int] = {}
        self.nodes = 0
        #: per node its first edge; per edge the share of the node's edges up to it, and its piece
        self.first, self.upto, self.piece = np.empty(0, np.int32), np.empty(0, np.float32), np.empty(0, np.int32)
        self.end, self.start = np.empty(0, np.int64), np.empty(0, np.int64)

    def _spell(self, chunk: str, strange: set[str]) -> str:
        if not strange.isdisjoint(chunk):
            chunk = "".join("".join(chr(BYTE_BASE + b) for b in c.encode()) if c in strange else c for c in chunk)
        return chunk.replace(" ", SPACE)

    def learn(self, chunks: list[str]) -> None:
        strange = set("".join(chunks)) - self.single - {" "}
        lattice = build([self._spell(c, strange) for c in chunks], self.machine, self.lengths)
        n = int(lattice.ends[-1]) + 2
        reach, share = np.full(n, -np.inf), np.empty(len(lattice.head))
        reach[lattice.starts] = 0.0
        for layer in range(len(lattice.layers) - 1):
            at, first = lattice.groups(layer)
            if not len(first):
                continue
            value = reach[lattice.tail[at]] + self.weights[lattice.piece[at]]
            total = np.logaddexp.reduceat(value, first)
            reach[lattice.head[at][first]] = total
            share[at] = np.exp(value - np.repeat(total, np.diff(np.append(first, len(value)))))
        # by end, longest first: mostly the likeliest edge is tried first
        # shares are summed as whole numbers, so a node's sums don't depend on the nodes before it
        by_end = np.empty(len(share), np.int64)
        by_end[lattice.order] = np.rint(share * SHARES)
        head, piece = np.empty_like(lattice.head), np.empty(len(share), np.int32)
        head[lattice.order], piece[lattice.order] = lattice.head, lattice.piece
        first = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]]))
        sizes = np.diff(np.append(first, len(head)))
        running = np.cumsum(by_end)
        upto = ((running - np.repeat(running[first] - by_end[first], sizes)) / SHARES).astype(np.float32)
        upto[first + sizes - 1] = 2.0  # the last edge takes what is left, whatever was lost in summing
        edges = np.zeros(n, np.int32)
        edges[head[first]] = len(self.piece) + first
        self.first, self.upto, self.piece = np.concatenate([self.first, edges]), np.concatenate([self.upto, upto]), np.concatenate([self.piece, piece])
        self.place.update(zip(chunks, range(len(self.end), len(self.end) + len(chunks)), strict=True))
        self.end = np.concatenate([self.end, self.nodes + lattice.ends])
        self.start = np.concatenate([self.start, self.nodes + lattice.starts])
        self.nodes += n

    def _window(self, text: str, begin: int, end: int, before: list[float]) -> tuple[list[float], list[int], list[float], list[int]]:
        """The nodes after ``begin`` up to ``end``: what the next window needs, then each node's first edge, the edges' running
        shares and their pieces. ``before`` has the log weights of the last nodes up to ``begin``, relative to that of ``begin``."""
        base, lengths, weights = begin + 1 - len(before), self.lengths.tolist(), self.weights.tolist()
        reach, first, running, piece, at = list(before), [], [], [], []

        def close(start: int) -> None:
            top = max(at)
            total = top + math.log(sum([math.exp(v - top) for v in at]))
            reach.append(total)
            first.append(start)
            upto = 0
            for v in at:
                upto += round(math.exp(v - total) * SHARES)
                running.append(upto)

        node = begin
        for last, p in self.machine.iter(text, base, end):
            if last < begin:
                continue
            if last != node:
                close(len(running))
                node, at = last, []
            at.append(reach[last + 1 - lengths[p] - base] + weights[p])
            piece.append(p)
        close(len(running))
        upto = (np.array(running, np.float64) / SHARES).astype(np.float32)
        upto[np.array([*first[1:], len(upto)]) - 1] = 2.0
        return [v - reach[-1] for v in reach[-self.longest :]], first, upto.tolist(), piece

    def sample_long(self, chunk: str, key: int) -> np.ndarray:
        """The piece ids of one long chunk, with the draws that ``key`` gives."""
        text, lengths = self._spell(chunk, set(chunk) - self.single - {" "}), self.lengths.tolist()
        begins, marks = range(0, len(text), WINDOW), [[0.0]]
        for begin in begins[:-1]:
            marks.append(self._window(text, begin, begin + WINDOW, marks[-1])[0])
        ids, at, draws = np.empty(len(text), np.int32), len(text), iter(())
        n, step = 0, 0
        for begin, before in zip(reversed(begins), reversed(marks), strict=True):
            _, first, upto, piece = self._window(text, begin, min(begin + WINDOW, len(text)), before)
            while at > begin:
                u = next(draws, None)
                if u is None:
                    steps = np.arange(step, step + DRAWS, dtype=np.uint64) * np.uint64(_STEP)
                    draws = iter(((_mixed(np.uint64(key) + steps) >> np.uint64(12)).astype(np.float64) * 2.0**-52).tolist())
                    step, u = step + DRAWS, next(draws)
                edge = first[at - begin - 1]
                while upto[edge] <= u:
                    edge += 1
                ids[n] = piece[edge]
                at, n = at - lengths[piece[edge]], n + 1
        return ids[:n][::-1]

    def sample(self, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece ids of all texts one after another, and how many each text has."""
        split = [self.chunks(" " + t) if t else [] for t in texts]
        wanted = set().union(*split)
        missing = list(wanted.difference(self.place.keys()))
        if missing:
            if len(self.place) + len(missing) > TABLE_CHUNKS:
                self.reset()
                missing = list(wanted)
            long = [c for c in missing if len(c) > LONG_CHUNK]
            if short := [c for c in missing if len(c) <= LONG_CHUNK] if long else missing:
                self.learn(short)
        else:
            long = []
        self.place.update(dict.fromkeys(long, -1))
        per_row = np.fromiter(map(len, split), np.int64, len(split))
        chunk = np.fromiter(map(self.place.__getitem__, chain.from_iterable(split)), np.int64, int(per_row.sum()))
        number = np.arange(len(chunk)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        key = _mixed(np.repeat(seeds, per_row) ^ _mixed(number.astype(np.uint64) + np.uint64(1)))
        for c in long:
            del self.place[c]
        live, step, drawn = np.flatnonzero(chunk >= 0), 0, []
        count, walked = np.zeros(len(chunk), np.int64), {}
        if len(live) < len(chunk):
            pieces = list(chain.from_iterable(split))
            walked = {i: self.sample_long(pieces[i], int(key[i])) for i in np.flatnonzero(chunk < 0).tolist()}
            for i, found in walked.items():
                count[i] = len(found)
        node, start = np.zeros(len(chunk), np.int64), np.zeros(len(chunk), np.int64)
        node[live], start[live] = self.end[chunk[live]], self.start[chunk[live]]
        while len(live):
            u = (_mixed(key[live] + np.uint64(step * _STEP % (1 << 64))) >> np.uint64(12)).astype(np.float64) * 2.0**-52
            edge = self.first[node[live]]
            short = np.flatnonzero(self.upto[edge] <= u)
            while len(short):  # on to the edge where the running share passes u
                edge[short] += 1
                short = short[self.upto[edge[short]] <= u[short]]
            piece = self.piece[edge]
            drawn.append((live, piece))
            count[live] += 1
            node[live] -= self.lengths[piece]
            live, step = live[node[live] > start[live]], step + 1
        last = np.cumsum(count)
        ids = np.empty(int(count.sum()), np.int32)
        for step, (which, piece) in enumerate(drawn):
            ids[last[which] - 1 - step] = piece
        for i, found in walked.items():
            ids[last[i] - len(found) : last[i]] = found
        total = np.add.reduceat(np.append(count, 0), np.cumsum(per_row) - per_row) if len(per_row) else per_row
        return ids, np.where(per_row > 0, total, 0)


class Decoder:
    """Ids to text: pieces' characters with spaces for U+2581, byte pieces as bytes, and without the
    space that encoding puts before a text. Every segmentation of a text decodes to that text."""

    def __init__(self, vocabulary: Vocabulary):
        self.table = [b"" if c else p.replace(SPACE, " ").encode() for p, c in zip(vocabulary.pieces, vocabulary.control, strict=True)]
        for b, i in enumerate(vocabulary.byte_ids):
            self.table[int(i)] = bytes([b])

    def __call__(self, ids: np.ndarray) -> str:
        return b"".join(map(self.table.__getitem__, ids.tolist()))[1:].decode()


def row_seeds(keys: list, seed: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(repr(k).encode(), seed) for k in keys], np.uint64)


def sample_pieces(docs: DataFrame, vocabulary: str, alpha: float = 0.5, seed: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_pieces, pieces, lossless) per row: one sampled segmentation of the whole text as an array
    of ids, and whether its decoding is the text again. A null text counts as empty, and an empty text
    has no pieces. Rows with one key and text get one segmentation; a null key is a key of its own."""
    plain = pick(docs, key, text).toDF("key", "text").select("key", F.coalesce("text", F.lit("")).alias("text"))
    kind = plain.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = Vocabulary.load(vocabulary)
        sampler, decode = Sampler(loaded, alpha), Decoder(loaded)
        for batch in batches:
            for a, b in text_slices(batch, 1, SLICE_BYTES):
                part = batch.slice(a, b - a)
                texts = part.column(1).to_pylist()
                ids, count = sampler.sample(texts, row_seeds(part.column(0).to_pylist(), seed))
                ends = np.cumsum(count)
                back = [decode(ids[e - n : e]) for e, n in zip(ends.tolist(), count.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(count, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids, pa.int32())),
                        pa.array([x == t for x, t in zip(back, texts, strict=True)]),
                    ],
                    names=["key", "n_pieces", "pieces", "lossless"],
                )

    return plain.mapInArrow(run, f"key {kind}, n_pieces long, pieces array<int>, lossless boolean").withColumnRenamed("key", key)


def decode_pieces(rows: DataFrame, vocabulary: str, key: str = "doc_id", pieces: str = "pieces") -> DataFrame:
    """(key, text) from (key, pieces); null pieces give an empty text."""
    plain = pick(rows, key, pieces).toDF("key", "pieces")
    kind = plain.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Decoder(Vocabulary.load(vocabulary))
        for batch in batches:
            texts = [decode(np.array(p or [], np.int64)) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["key", "text"])

    return plain.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)
