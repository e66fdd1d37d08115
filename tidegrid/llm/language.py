"""Language identification: a linear-chain conditional random field that labels the words of a text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import pick, text_slices

LETTERS = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
SLICE_BYTES = 4 << 20
ROWS = 1 << 16
#: Training bounds: documents of all languages together, but so many of each at least, and words of one.
SAMPLE_DOCS, LEAST_DOCS, SAMPLE_WORDS = 1600, 25, 200
LENGTH, EPOCHS, BATCH = 24, 4, 128
#: Numbers in the table of words' emissions that a task keeps (words times languages).
TABLE_CELLS = 300_000 * 64
#: Words in it however few the languages are, and new ones whose features are made at a time.
TABLE_WORDS, NEW_WORDS = 300_000, 8192

_MIX = np.uint64(0xFF51AFD7ED558CCD)


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each word, one after another, and where each word's begin: characters, their
    pairs and triples with marks at both ends (so affixes of one and two letters), prefix and suffix of
    three letters, and the word itself, which stands for an entry of the lexicon."""
    layout = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    start = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(layout)) - start[owner]
    left = sizes[owner] - at
    rolled = np.zeros(len(layout), np.uint64)
    values, owners = [], []
    padded = np.concatenate([layout, np.zeros(4, np.uint64)])
    for n in range(1, 5):
        rolled = (rolled ^ padded[n - 1 : n - 1 + len(layout)]) * _MIX + np.uint64(n)
        rolled ^= rolled >> np.uint64(29)
        fits = left >= n
        if n == 4:
            fits &= (at == 0) | (left == 4)
        values.append(rolled[fits])
        owners.append(owner[fits])
    values.append(np.fromiter((xxhash.xxh64_intdigest(w.encode(), 1) for w in words), np.uint64, len(words)))
    owners.append(np.arange(len(words)))
    value, owner = np.concatenate(values), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    count = np.bincount(owner, minlength=len(words))
    return (value[order] % np.uint64(ROWS)).astype(np.int64), np.cumsum(count) - count


@dataclass
class Model:
    """Weights of features, of the first label and of label pairs, for ``languages``; the lexicon gives
    the language of words that the sample shows, three times or more, almost only in one."""

    languages: list[str]
    features: np.ndarray
    lexicon: dict[str, int]
    in_lexicon: np.ndarray
    first: np.ndarray
    pair: np.ndarray

    @property
    def slice_bytes(self) -> int:
        """Text to label at a time: the more languages, the less."""
        return max(1 << 16, SLICE_BYTES * 8 // max(8, len(self.languages)))

    def emissions(self, words: list[str]) -> np.ndarray:
        at, start = word_features(words)
        counts = np.diff(np.append(start, len(at)))[:, None]
        out = np.add.reduceat(self.features[at], start) / np.sqrt(counts)
        for i, w in enumerate(words):
            if (k := self.lexicon.get(w)) is not None:
                out[i] += self.in_lexicon[k]
        return out


def forward_backward(emission: np.ndarray, lengths: np.ndarray, first: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Posterior label probabilities of every word; sequences lie one after another in ``emission``.

    All sequences go a step at a time together, longest first, so those still running are the first
    rows; each step is scaled to sum 1.
    """
    out = np.empty(emission.shape)
    if not len(emission):
        return out
    order = np.argsort(-lengths, kind="stable")
    start, size = (np.cumsum(lengths) - lengths)[order], lengths[order]
    steps = int(size[0])
    running = len(size) - np.searchsorted(size[::-1], np.arange(steps), "right")
    local = np.exp(emission - emission.max(axis=1, keepdims=True))
    move = np.exp(pair - pair.max())
    now = local[start[: running[0]]] * np.exp(first - first.max())
    now /= now.sum(axis=1, keepdims=True)
    out[start[: running[0]]] = now
    for t in range(1, steps):
        rows = start[: running[t]] + t
        now = (now[: running[t]] @ move) * local[rows]
        now /= now.sum(axis=1, keepdims=True)
        out[rows] = now
    back = np.ones((0, emission.shape[1]))
    for t in range(steps - 1, -1, -1):
        rows = start[: running[t]] + t
        more = running[t] - len(back)
        if more:  # sequences whose last word this is
            back = np.concatenate([back, np.ones((more, emission.shape[1]))])
        out[rows] *= back
        back = (local[rows] * back) @ move.T
        back /= back.sum(axis=1, keepdims=True)
    return out / out.sum(axis=1, keepdims=True)


def _pair_expectation(emission: np.ndarray, first: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors (sequence, step, label) and expected label pairs of equally long sequences."""
    n, length, k = emission.shape
    local, move = np.exp(emission - emission.max(axis=2, keepdims=True)), np.exp(pair)
    alpha, beta = np.empty((length, n, k)), np.ones((length, n, k))
    for t in range(length):
        alpha[t] = local[:, t] * (np.exp(first) if t == 0 else alpha[t - 1] @ move)
        alpha[t] /= alpha[t].sum(axis=1, keepdims=True)
    pairs = np.zeros((k, k))
    for t in range(length - 1, 0, -1):
        into = local[:, t] * beta[t]
        # a product of matrices, so no table of all label pairs is made for each sequence
        total = ((alpha[t - 1] @ move) * into).sum(axis=1, keepdims=True)
        pairs += move * ((alpha[t - 1] / total).T @ into)
        beta[t - 1] = into @ move.T
        beta[t - 1] /= beta[t - 1].sum(axis=1, keepdims=True)
    post = alpha * beta
    return (post / post.sum(axis=2, keepdims=True)).transpose(1, 0, 2), pairs


def fit(samples: list[tuple[str, list[str]]], languages: list[str], seed: int = 0) -> Model:
    """Fit by AdaGrad on the conditional likelihood of labelled sequences of ``LENGTH`` words. Documents
    carry one language, so code-switched sequences are made by joining spans of different documents; that is
    also what the transitions are learned from."""
    rng, k = np.random.default_rng(seed), len(languages)
    number = {l: i for i, l in enumerate(languages)}
    samples = [(number[l], ws) for l, ws in samples if ws]
    vocabulary = sorted({w for _, ws in samples for w in ws})
    index = {w: i for i, w in enumerate(vocabulary)}
    seen: dict[str, Counter] = {}
    for l, ws in samples:
        for w in ws:
            seen.setdefault(w, Counter())[l] += 1
    lexicon = {w: c.most_common(1)[0][0] for w, c in seen.items() if c.total() >= 3 and c.most_common(1)[0][1] >= 0.9 * c.total()}
    model = Model(languages, np.zeros((ROWS, k)), lexicon, np.zeros((k, k)), np.zeros(k), np.zeros((k, k)))
    if not samples or k < 2:
        return model
    at, start = word_features(vocabulary)
    counts = np.diff(np.append(start, len(at)))
    entry = np.fromiter((lexicon.get(w, -1) for w in vocabulary), np.int64, len(vocabulary))
    # spans of 4 to 24 words, shuffled, then joined and cut into sequences
    words, labels = [], []
    by_language = [[np.array([index[w] for w in ws]) for l, ws in samples if l == j] for j in range(k)]
    total = sum(len(ws) for _, ws in samples)
    while sum(map(len, words)) < total:
        j = int(rng.integers(k))
        if not by_language[j]:
            continue
        doc = by_language[j][int(rng.integers(len(by_language[j])))]
        a = int(rng.integers(len(doc)))
        span = doc[a : a + int(rng.integers(4, 25))]
        words.append(span)
        labels.append(np.full(len(span), j))
    n = sum(map(len, words)) // LENGTH
    if not n:
        words, labels, n = words * LENGTH, labels * LENGTH, sum(map(len, words)) * LENGTH // LENGTH
    x = np.concatenate(words)[: n * LENGTH].reshape(n, LENGTH)
    y = np.concatenate(labels)[: n * LENGTH].reshape(n, LENGTH)
    parts = {"features": model.features, "in_lexicon": model.in_lexicon, "first": model.first, "pair": model.pair}
    squares = {p: np.full(v.shape, 1e-6) for p, v in parts.items()}
    for _ in range(EPOCHS):
        shuffled = rng.permutation(n)
        for b in range(0, n, BATCH):
            pick_ = shuffled[b : b + BATCH]
            wx, wy = x[pick_], y[pick_]
            used, place = np.unique(wx, return_inverse=True)
            place = place.reshape(wx.shape)
            rows = np.concatenate([at[start[u] : start[u] + counts[u]] for u in used])
            owner = np.repeat(np.arange(len(used)), counts[used])
            scale = 1 / np.sqrt(counts[used])
            first_of = np.cumsum(counts[used]) - counts[used]
            word_score = np.add.reduceat(model.features[rows], first_of) * scale[:, None]
            known = entry[used] >= 0
            word_score[known] += model.in_lexicon[entry[used][known]]
            post, pairs = _pair_expectation(word_score[place], model.first, model.pair)
            truth = np.eye(k)[wy]
            slope = (truth - post) / len(pick_)
            per_word = np.zeros((len(used), k))
            np.add.at(per_word, place.ravel(), slope.reshape(-1, k))
            real = np.zeros((k, k))
            np.add.at(real, (wy[:, :-1].ravel(), wy[:, 1:].ravel()), 1.0)
            touched, to = np.unique(rows, return_inverse=True)
            grown = np.zeros((len(touched), k))
            np.add.at(grown, to, per_word[owner] * scale[owner][:, None])
            squares["features"][touched] += grown**2
            model.features[touched] += 0.3 * grown / np.sqrt(squares["features"][touched])
            lex = np.zeros((k, k))
            np.add.at(lex, entry[used][known], per_word[known])
            for name, g in (("in_lexicon", lex), ("first", slope[:, 0].sum(axis=0)), ("pair", (real - pairs) / len(pick_))):
                squares[name] += g**2
                parts[name] += 0.1 * g / np.sqrt(squares[name])
    model.features = model.features.astype(np.float32)
    return model


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", seed: int = 0) -> Model:
    """A model from the labelled rows that aren't held out. It is fitted on the driver on a bounded
    sample: about ``SAMPLE_DOCS`` documents, as many of each language but ``LEAST_DOCS`` at least (or all it
    has), so every language gets a place in the model. They are chosen by a hash of their key, and of each at most ``SAMPLE_WORDS`` consecutive words from a place that the hash gives."""
    plain = pick(docs, key, text, lang).toDF("key", "text", "lang")
    rows = plain.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("key")))
    found = rows.groupBy("lang").count().collect()
    languages = sorted(r["lang"] for r in found)
    if not languages:
        return fit([], [], seed)
    each = max(LEAST_DOCS, SAMPLE_DOCS // len(languages))
    share = F.create_map(*(F.lit(v) for r in found for v in (r["lang"], min(1.0, each / r["count"]))))
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.col("key")), F.lit(1 << 30))
    sample = rows.withColumn("drawn", drawn).where(drawn < share[F.col("lang")] * F.lit(1 << 30)).select("drawn", "text", "lang")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for place, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ws = LETTERS.findall(t.lower())
                a = place % max(1, len(ws) - SAMPLE_WORDS + 1)
                out.append([w for w in ws[a : a + SAMPLE_WORDS] if len(w) <= 64])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string())), batch.column(2)], names=["drawn", "words", "lang"])

    # the draw is bounded in expectation; the limit bounds it in any case, in a fixed order
    got = sample.mapInArrow(cut, "drawn long, words array<string>, lang string").orderBy("drawn", "lang", "words").limit(3 * each * len(languages)).collect()
    return fit([(r["lang"], r["words"]) for r in got], languages, seed)


@dataclass
class Labelled:
    """What a model says of some texts. ``certainty`` is the mean, over a text's words, of the largest posterior;
    ``spans`` (SPANS) are the runs of words with one label."""

    languages: list[str]
    scores: list[float]
    certainty: list[float]
    spans: pa.Array


SPAN = pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()), ("lang", pa.string()), ("posterior", pa.float64())])
SPANS = "array<struct<first_word:int,n_words:int,lang:string,posterior:double>>"


class Predictor:
    """Labels of the words of texts under a model, and what they say of each text."""

    def __init__(self, model: Model):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.place: dict[str, int] = {}
        self.table = np.empty((0, max(1, len(self.model.languages))))

    def _rows_of(self, split: list[list[str]], n: int) -> np.ndarray:
        """The emission table's row of every word; the table starts afresh beyond ``TABLE_WORDS`` or ``TABLE_CELLS``."""
        wanted = set().union(*split)
        missing = list(wanted.difference(self.place.keys()))
        if len(self.place) + len(missing) > min(TABLE_WORDS, TABLE_CELLS // len(self.model.languages)):
            self.reset()
            missing = list(wanted)
        if missing:
            self.place.update(zip(missing, range(len(self.table), len(self.table) + len(missing)), strict=True))
            new = (self.model.emissions(missing[i : i + NEW_WORDS]) for i in range(0, len(missing), NEW_WORDS))
            self.table = np.concatenate([self.table, *new])
        return np.fromiter(map(self.place.__getitem__, chain.from_iterable(split)), np.int64, n)

    def __call__(self, texts: list[str | None]) -> Labelled:
        split = [LETTERS.findall(t.lower()) if t else [] for t in texts]
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        languages, n = self.model.languages, len(texts)
        predicted, score, certainty = [UNDETERMINED] * n, [0.0] * n, [0.0] * n
        if not languages or not lengths.sum():
            return Labelled(predicted, score, certainty, pa.array([[]] * n, pa.list_(SPAN)))
        rows = self._rows_of(split, int(lengths.sum()))
        full = np.flatnonzero(lengths)
        sizes = lengths[full]
        starts = np.cumsum(sizes) - sizes
        post = forward_backward(self.table[rows], sizes, self.model.first, self.model.pair)
        mean = np.add.reduceat(post, starts) / sizes[:, None]
        top, label = post.max(axis=1), post.argmax(axis=1)
        sure = np.add.reduceat(top, starts) / sizes
        for i, j, s, c in zip(full.tolist(), mean.argmax(axis=1).tolist(), mean.max(axis=1).tolist(), sure.tolist(), strict=True):
            predicted[i], score[i], certainty[i] = languages[j], min(1.0, s), min(1.0, c)
        # a span begins with a text or another label
        begins = np.append(True, label[1:] != label[:-1])
        begins[starts] = True
        at = np.flatnonzero(begins)
        owner = np.repeat(full, sizes)[at]
        run = np.diff(np.append(at, len(label)))
        flat = pa.StructArray.from_arrays(
            [
                pa.array(at - np.repeat(starts, sizes)[at], pa.int32()), pa.array(run, pa.int32()),
                pa.array(languages, pa.string()).take(pa.array(label[at])), pa.array(np.minimum(1.0, np.add.reduceat(top, at) / run)),
            ],
            fields=list(SPAN),
        )
        ends = np.cumsum(np.bincount(owner, minlength=n))
        return Labelled(predicted, score, certainty, pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), flat))


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, lang_pred, score, certainty, spans) per row. ``spans`` label the words (runs of letters of
    the lower-cased text, numbered from 0): runs of words whose largest posterior is of one language, with its
    mean. ``lang_pred`` has the largest mean posterior over all words of the text, ``score`` is that mean, and
    ``certainty`` the mean of each word's largest posterior, however many languages the text has. A text
    that is null or has no letter is ``und`` at 0 without spans, as is everything if no language was
    learned; ties go to the language first in order."""
    plain = pick(docs, key, text).toDF("key", "text")
    kind = plain.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = Predictor(model)
        for batch in batches:
            for a, b in text_slices(batch, 1, model.slice_bytes):
                part = batch.slice(a, b - a)
                said = predict(part.column(1).to_pylist())
                columns = [part.column(0), pa.array(said.languages), pa.array(said.scores, pa.float64()), pa.array(said.certainty, pa.float64()), said.spans]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "lang_pred", "score", "certainty", "spans"])

    out = plain.mapInArrow(run, f"key {kind}, lang_pred string, score double, certainty double, spans {SPANS}")
    return out.select(F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "lang_pred", "score", "certainty", "spans")


def keep_identified(docs: DataFrame, model: Model, least_certainty: float = 0.35, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose words the model labels with at least ``least_certainty``; into how
    many languages doesn't matter."""
    at = docs.columns.index(text)
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = Predictor(model)
        for batch in batches:
            for a, b in text_slices(batch, at, model.slice_bytes):
                part = batch.slice(a, b - a)
                said = predict(part.column(at).to_pylist())
                yield part.filter(pa.array([bool(len(x)) and c >= least_certainty for x, c in zip(said.spans, said.certainty, strict=True)]))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
