"""Exact quantiles of whole columns without sorting or collecting them.

One pass brackets every requested rank with a mergeable sketch; each further pass histograms only
the rows inside the brackets and narrows to the bin that holds the rank, until the bin is a single
value. Every pass is a map-side-combined aggregate of at most ``BINS`` rows per target, so neither a
task nor the driver ever holds more than that, whatever the row count or the skew of the values.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096
SKETCH_ACCURACY = 10_000
OUTSIDE = -1  # bin number of rows on the counted side of a bracket


@dataclass
class _Target:
    """One order statistic being narrowed: the ``rank``-th smallest lies within [lo, hi]."""

    column: str
    rank: int
    lo: float
    hi: float
    finite: tuple[float, float] = (0.0, 0.0)  # extremes of the column's finite values
    from_top: bool = False  # count the rows outside the bracket on this, smaller, side
    below: int | None = None  # rows known to be smaller than lo

    @property
    def done(self) -> bool:
        return self.below is not None and self.lo == self.hi


def _usable(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _bin(value: Column, lo: float, hi: float) -> Column:
    """Equal-width bins over the finite values of a bracket; the infinities have the end bins to
    themselves. Halves keep the width finite, whatever the extremes are."""
    width = hi / 2 - lo / 2
    inner = BINS - 2
    place = F.floor((value / 2 - F.lit(lo / 2)) / F.lit(width) * F.lit(inner)) if width > 0 else F.lit(0)
    if width == 0 and hi > lo:  # so narrow that halving lost it
        place = F.floor((value - F.lit(lo)) / F.lit(hi - lo) * F.lit(inner))
    bounded = F.greatest(F.least(place, F.lit(inner - 1)), F.lit(0)) + F.lit(1)
    return (
        F.when(value == F.lit(float("-inf")), F.lit(0)).when(value == F.lit(float("inf")), F.lit(BINS - 1)).otherwise(bounded).cast("int")
    )


def _bracket(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, tuple]:
    """Row count, extremes and sketch brackets of every column, in one pass."""
    margin = 2.0 / SKETCH_ACCURACY
    aggs = []
    for i, (column, probs) in enumerate(wanted.items()):
        value = _usable(column)
        edges = [e for p in probs for e in (max(0.0, p - margin), min(1.0, p + margin))]
        aggs += [
            F.count(value).alias(f"n{i}"),
            F.min(value).alias(f"min{i}"),
            F.max(value).alias(f"max{i}"),
            F.percentile_approx(value, edges, SKETCH_ACCURACY).alias(f"edges{i}"),
        ]
    row = df.agg(*aggs).first()
    return {c: (row[f"n{i}"], row[f"min{i}"], row[f"max{i}"], row[f"edges{i}"]) for i, c in enumerate(wanted)}


def _finite(df: DataFrame, extremes: dict[str, tuple]) -> dict[str, tuple[float, float]]:
    """Extremes of the finite values; a pass of its own only for columns that hold infinite ones."""
    found = {c: (low, high) for c, (low, high) in extremes.items() if low is not None}
    wild = [c for c, pair in found.items() if any(math.isinf(x) for x in pair)]
    if wild:
        calm = [F.when(F.abs(_usable(c)) < float("inf"), _usable(c)) for c in wild]
        row = df.agg(*(f(v).alias(f"{f.__name__}{i}") for i, v in enumerate(calm) for f in (F.min, F.max))).first()
        found |= {c: (row[f"min{i}"] or 0.0, row[f"max{i}"] or 0.0) for i, c in enumerate(wild)}
    return found


def _histograms(df: DataFrame, targets: list[_Target]) -> dict[int, list]:
    """(bin, rows, min, max) of every open target, in one pass over the bracketed rows."""
    entries, reach = [], F.lit(False)
    for i, t in enumerate(targets):
        value = _usable(t.column)
        inside = value.between(F.lit(t.lo), F.lit(t.hi))
        bin_no = F.when(inside, _bin(value, max(t.lo, t.finite[0]), min(t.hi, t.finite[1])))
        if t.below is None:  # first histogram: rows on the shorter side of the bracket are counted too
            outside = value > F.lit(t.hi) if t.from_top else value < F.lit(t.lo)
            bin_no = F.when(outside, F.lit(OUTSIDE)).otherwise(bin_no)
            inside = value >= F.lit(t.lo) if t.from_top else value <= F.lit(t.hi)
        entries.append(F.struct(F.lit(i).alias("target"), bin_no.alias("bin"), value.alias("value")))
        reach = reach | inside
    rows = (
        df.filter(reach)
        .select(F.explode(F.array(*entries)).alias("e"))
        .select("e.*")
        .filter(F.col("bin").isNotNull())
        .groupBy("target", "bin")
        .agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .collect()  # at most BINS + 1 rows per target
    )
    found: dict[int, list] = {i: [] for i in range(len(targets))}
    for r in rows:
        found[r["target"]].append((r["bin"], r["n"], r["lo"], r["hi"]))
    return {i: sorted(v) for i, v in found.items()}


def _narrow(target: _Target, bins: list, total: int, extremes: tuple[float, float]) -> None:
    inside = [b for b in bins if b[0] != OUTSIDE]
    seen = target.below
    if seen is None:
        outside = sum(n for b, n, _, _ in bins if b == OUTSIDE)
        seen = total - outside - sum(n for _, n, _, _ in inside) if target.from_top else outside
    if seen < target.rank:
        for _, n, lo, hi in inside:
            if seen + n >= target.rank:
                target.below, target.lo, target.hi = seen, lo, hi
                return
            seen += n
    # The sketch bracket missed the rank: fall back to the full range and histogram again.
    target.below, (target.lo, target.hi) = 0, extremes


def _order_statistics(df: DataFrame, wanted: dict[str, list[float]], ranks) -> tuple[dict, dict]:
    """Row counts per column and exact values at ``ranks(p, n)`` (nulls and NaN ignored)."""
    info = _bracket(df, wanted)
    finite = _finite(df, {c: info[c][1:3] for c in wanted})
    targets: dict[tuple[str, int], _Target] = {}
    for column, probs in wanted.items():
        n, _, _, edges = info[column]
        for j, p in enumerate(probs if n else []):
            for rank in ranks(p, n):
                bracket = edges[2 * j], edges[2 * j + 1]
                targets.setdefault((column, rank), _Target(column, rank, *bracket, finite.get(column, (0.0, 0.0)), from_top=p > 0.5))
    while pending := [t for t in targets.values() if not t.done]:
        histograms = _histograms(df, pending)
        for i, t in enumerate(pending):
            n, low, high, _ = info[t.column]
            before = t.lo, t.hi, t.below
            _narrow(t, histograms[i], n, (low, high))
            if (t.lo, t.hi, t.below) == before:
                raise ArithmeticError(f"quantile of {t.column}: no progress within [{t.lo}, {t.hi}]")
    return {c: info[c][0] for c in wanted}, {key: t.lo for key, t in targets.items()}


def _disc_ranks(p: float, n: int) -> list[int]:
    return [max(1, math.ceil(p * n))]


def _cont_ranks(p: float, n: int) -> list[int]:
    position = p * (n - 1)
    return [math.floor(position) + 1, math.ceil(position) + 1]


def discrete_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """Smallest value whose cumulative share reaches p; ``None`` for a column without values."""
    counts, values = _order_statistics(df, wanted, _disc_ranks)
    return {
        c: [values[c, _disc_ranks(p, counts[c])[0]] if counts[c] else None for p in probs]
        for c, probs in wanted.items()
    }


def interpolated_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """Linear interpolation between the two neighbouring order statistics."""
    counts, values = _order_statistics(df, wanted, _cont_ranks)
    out: dict[str, list[float | None]] = {}
    for c, probs in wanted.items():
        out[c] = []
        for p in probs:
            if not counts[c]:
                out[c].append(None)
                continue
            lower, upper = (values[c, r] for r in _cont_ranks(p, counts[c]))
            position = p * (counts[c] - 1)
            share = position - math.floor(position)
            out[c].append(lower if lower == upper or share == 0 else lower + (upper - lower) * share)
    return out
