"""Importance resampling towards a target distribution: hashed word-run features, Gumbel scores, exact selection."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import Memo, checkpoint, numbered, pick, utf8

BUCKETS = 10_000
#: Runs of one to so many consecutive words are features.
MOST_WORDS = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: Bytes of a text whose words are held at once.
WINDOW_BYTES = 1 << 20
#: So few remaining keys are sorted at once instead of halved further.
FINISH = 4096

_SPACE, _LETTERS = ord(" "), b"abcdefghijklmnopqrstuvwxyz"
#: A-Z to lower case; every other ASCII byte that is no letter or digit to a space.
_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or b in _LETTERS else _SPACE for b in range(256)
)
_GAP = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")


def _memo() -> Memo:
    return Memo(lambda fs: (zlib.crc32(f) % BUCKETS for f in fs), 400_000)


def feature_buckets(text: bytes, memo: Memo, most_words: int = MOST_WORDS) -> tuple[int, np.ndarray]:
    """The number of words of a text, and the buckets of its features, repeats included, in any order. A
    long text is walked in windows cut between words."""
    n, start, carried, parts = 0, 0, [], []
    while start < len(text):
        gap = _GAP.search(text, start + WINDOW_BYTES)
        end = gap.start() if gap else len(text)
        words = text[start:end].translate(_WORDS).split()
        start, n = end, n + len(words)
        features = words
        if most_words > 1:
            run = carried + words
            ends = range(len(carried) + 1, len(run) + 1)
            features = [b" ".join(run[e - k : e]) for e in ends for k in range(1, min(most_words, e) + 1)]
            carried = run[-(most_words - 1) :]
        known = memo.of(set(features))
        parts.append(np.fromiter(map(known.__getitem__, features), np.uint32, len(features)))
    return n, np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def with_buckets(texts: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """(doc_id, n_words, buckets) of (doc_id, text); buckets as an array of unsigned 16-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo()
        for batch in batches:
            found = [feature_buckets(t, memo, most_words) for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([b.astype("<u2").tobytes() for _, b in found], pa.binary())],
                ["doc_id", "n_words", "buckets"],
            )

    return texts.mapInArrow(run, "doc_id long, n_words long, buckets binary")


def bucket_counts(bucketed: DataFrame) -> np.ndarray:
    """Features per bucket: one row per bucket and partition is shuffled, ``BUCKETS`` rows are collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer(), "<u2"), minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in bucketed.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed target and raw frequencies, rounded down, per bucket."""
    s, t = raw.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """Thousandths of a Gumbel variate from a hash of the id, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return int(np.floor(-1000 * np.log(-np.log((h + 0.5) / 4294967296))))


def with_scores(bucketed: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score): a weight is the sum of the array ``gain`` over a row's buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.frombuffer(v.as_buffer(), "<u2") for v in batch.column(2)]
            weights = np.array([int(gain[b].sum()) for b in held], np.int64)
            noise = np.array([gumbel(i, seed) for i in batch.column(0).to_pylist()], np.int64)
            sizes = pa.array([len(b) for b in held], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, pa.array(weights), pa.array(weights + noise)], ["doc_id", "n_words", "n_features", "weight", "score"])

    return bucketed.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


KEY = ("k0", "k1", "k2", "k3")


def with_key(rows: DataFrame) -> DataFrame:
    """Rows (checkpointed) with the four numbers that order them without ties: falling score, doc_id (null last),
    n_features, and the row's number."""
    last = F.lit((1 << 63) - 1)
    return rows.withColumns(dict(zip(KEY, (-F.col("score"), F.coalesce("doc_id", last), F.col("n_features"), F.monotonically_increasing_id()))))


def _below(key: tuple[int, ...]) -> Column:
    return F.struct(*KEY) < F.struct(*(F.lit(k).cast("long").alias(n) for n, k in zip(KEY, key)))


def _equal(key: tuple[int, ...]) -> Column:
    return F.struct(*KEY) == F.struct(*(F.lit(k).cast("long").alias(n) for n, k in zip(KEY, key)))


def _medians(keys: DataFrame) -> list[tuple[int, tuple[int, ...]]]:
    """(remaining keys, their lower median) of every partition that holds any; one short row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.stack([np.asarray(c) for c in b.columns]) for b in batches if b.num_rows]
        if held:
            k = np.concatenate(held, axis=1)
            at = np.lexsort(k[::-1])[(k.shape[1] - 1) // 2]
            yield pa.RecordBatch.from_arrays([pa.array([k.shape[1]]), *(pa.array([int(x)]) for x in k[:, at])], ["n", *KEY])

    rows = keys.select(*KEY).mapInArrow(run, "n long, k0 long, k1 long, k2 long, k3 long").collect()
    return [(r["n"], tuple(r[c] for c in KEY)) for r in rows]


def nth_key(keys: DataFrame, nth: int) -> tuple[int, ...]:
    """The ``nth`` least key (from 1) of distinct keys, by weighted medians of medians.

    Every round takes the partitions' medians, weighted by the keys they still hold; the weighted median
    of those has at least a quarter of the remaining keys on either side, so comparing its exact
    rank with ``nth`` discards a quarter at least, whatever the data. The rest is written anew, so all rounds
    together read a few times the keys. The driver sees one row per partition.
    """
    left = keys.select(*KEY)
    while True:
        medians = sorted(_medians(left), key=lambda m: m[1])
        total = sum(n for n, _ in medians)
        if total <= FINISH:
            return sorted(tuple(r) for r in left.collect())[nth - 1]
        half = 0
        for n, pivot in medians:
            half += n
            if 2 * half >= total:
                break
        below = left.where(_below(pivot)).count()
        if nth == below + 1:
            return pivot
        if nth <= below:
            left = checkpoint(left.where(_below(pivot)))
        else:
            nth -= below + 1
            left = checkpoint(left.where(~_below(pivot) & ~_equal(pivot)))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, most_words: int = MOST_WORDS, seed: int = SEED,
    key: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """(key, n_features, weight, score, rank) per row: ``percent`` of the rows with ``least_words`` words or more are
    drawn without replacement, likelier the more their words are like the texts of ``target``.

    Features are runs of up to ``most_words`` words (runs of ASCII letters and digits and other characters, A-Z in lower
    case), hashed into ``BUCKETS`` buckets. Both tables' features are counted by bucket; the log ratios are an array
    that every row's buckets index, and a Gumbel variate from a hash of the id turns weights into a draw: the highest scores
    win, on ties the smaller id (null last), then fewer features. The cutoff is selected, not sorted for; only
    the winners are sorted, and numbered from 1 as ``rank``. Others have no rank.

    Null and empty texts have no features, weight 0 and are not drawn; long texts are walked in windows. Repeated rows
    have equal scores and places of their own; if the cutoff falls among them, any of them win. Rows without
    an id share one variate. Without enough rows nothing is drawn; an empty table gives no rows. Other columns don't matter.
    """
    plain = pick(docs, key, text).toDF("doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = pick(target, target_text).toDF("text").select(F.lit(None).cast("long").alias("doc_id"), "text")
    bucketed = checkpoint(with_buckets(plain, most_words))
    gain = gains(bucket_counts(bucketed), bucket_counts(with_buckets(wanted, most_words)))
    rows = checkpoint(with_key(checkpoint(with_scores(bucketed, gain, seed))))
    eligible = rows.where(F.col("n_words") >= least_words)
    drawn = percent * eligible.count() // 100
    shown = [F.col("doc_id").alias(key), "n_features", "weight", "score"]
    if not drawn:
        return rows.select(*shown, F.lit(None).cast("long").alias("rank"))
    cut = nth_key(eligible, drawn)
    wins = (F.col("n_words") >= least_words) & (_below(cut) | _equal(cut))
    winners = checkpoint(rows.where(wins).withColumn("all", F.lit(0)))
    ranked = numbered(winners, "all", list(KEY)).select(*shown, (F.col("pos") + 1).alias("rank"))
    return ranked.unionByName(rows.where(~wins).select(*shown, F.lit(None).cast("long").alias("rank")))
