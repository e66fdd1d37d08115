"""Parameter search by tree-structured Parzen estimators: densities of good and bad trials, proposals by their ratio."""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from dataclasses import dataclass

#: Trials drawn from the whole space before densities are used.
STARTUP = 10
#: Trials proposed together once densities are used; they run side by side.
BATCH = 5
#: Candidates drawn from the density of good trials for each proposal.
CANDIDATES = 24
#: Share and largest number of trials that count as good.
GOOD_SHARE, MOST_GOOD = 0.1, 25


def draw(spec: tuple, rng: random.Random):
    """One seeded draw from a dimension."""
    kind, *args = spec
    if kind == "choice":
        return rng.choice(args[0])
    if kind == "int":
        low, high, step = args
        return rng.randrange(low, high + 1, step)
    if kind == "log":
        return math.exp(rng.uniform(math.log(args[0]), math.log(args[1])))
    return rng.uniform(*args)


def draw_parameters(space: dict[str, tuple], rng: random.Random) -> dict:
    """One seeded draw from a search space."""
    return {name: draw(spec, rng) for name, spec in space.items()}


@dataclass(frozen=True)
class _Axis:
    """A numeric dimension on the axis where its density lives: log values for ``log``, half a step of room for ``int``."""

    kind: str
    low: float
    high: float
    step: float

    @classmethod
    def of(cls, spec: tuple) -> _Axis:
        kind, *args = spec
        if kind == "log":
            return cls(kind, math.log(args[0]), math.log(args[1]), 0.0)
        if kind == "int":
            return cls(kind, args[0] - args[2] / 2, args[1] + args[2] / 2, args[2])
        return cls(kind, args[0], args[1], 0.0)

    def place(self, value: float) -> float:
        return math.log(value) if self.kind == "log" else float(value)

    def value(self, place: float):
        if self.kind == "log":
            return math.exp(place)
        if self.kind == "int":
            first = self.low + self.step / 2
            last = math.floor((self.high - self.low) / self.step - 1 + 1e-9)
            return int(first + self.step * min(last, max(0, round((place - first) / self.step))))
        return place


def _phi(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


class _Parzen:
    """Equal mixture of normals cut to the axis: one about each observation, as wide as the larger gap to its
    neighbours, and one over the whole axis."""

    def __init__(self, axis: _Axis, values: list[float]):
        self.axis = axis
        low, high = axis.low, axis.high
        span = high - low
        least = span / min(100.0, 1.0 + len(values))
        places = sorted(axis.place(v) for v in values)
        edges = [low, *places, high]
        self.parts = [((low + high) / 2, span)]
        for i, p in enumerate(places, start=1):
            self.parts.append((p, min(span, max(least, p - edges[i - 1], edges[i + 1] - p))))

    def _mass(self, mean: float, width: float, a: float, b: float) -> float:
        return _phi((b - mean) / width) - _phi((a - mean) / width)

    def sample(self, rng: random.Random):
        mean, width = rng.choice(self.parts)
        while True:
            place = rng.gauss(mean, width)
            if self.axis.low <= place <= self.axis.high:
                return self.axis.value(place)

    def log_density(self, value) -> float:
        place, axis = self.axis.place(value), self.axis
        total = 0.0
        for mean, width in self.parts:
            whole = self._mass(mean, width, axis.low, axis.high)
            if axis.step:
                total += self._mass(mean, width, place - axis.step / 2, place + axis.step / 2) / whole
            else:
                total += math.exp(-0.5 * ((place - mean) / width) ** 2) / (width * math.sqrt(2 * math.pi)) / whole
        return math.log(max(total / len(self.parts), 1e-300))


class _Counts:
    """Shares of the choices among observations, each seen once more than it was."""

    def __init__(self, choices: list, values: list):
        self.choices = choices
        self.weights = [1 + sum(v == c for v in values) for c in choices]

    def sample(self, rng: random.Random):
        return rng.choices(self.choices, self.weights)[0]

    def log_density(self, value) -> float:
        return math.log(self.weights[self.choices.index(value)] / sum(self.weights))


def propose(space: dict[str, tuple], seen: list[tuple[dict, float]], rng: random.Random) -> dict:
    """The next trial: in every dimension, the candidate from the density of good trials whose ratio to that of
    the others is largest. Good are the least losses, a tenth of all, rounded up."""
    ranked = sorted(range(len(seen)), key=lambda i: (seen[i][1], i))
    n_good = min(MOST_GOOD, math.ceil(GOOD_SHARE * len(seen)))
    good, bad = ([seen[i][0] for i in part] for part in (ranked[:n_good], ranked[n_good:]))
    out = {}
    for name, spec in space.items():
        values = [[p[name] for p in side] for side in (good, bad)]
        below, above = (_Counts(spec[1], v) if spec[0] == "choice" else _Parzen(_Axis.of(spec), v) for v in values)
        candidates = [below.sample(rng) for _ in range(CANDIDATES)]
        out[name] = max(candidates, key=lambda c: below.log_density(c) - above.log_density(c))
    return out


def minimise(space: dict[str, tuple], losses: Callable[[list[dict]], list[float]], trials: int, seed: int, startup: int = STARTUP, batch: int = BATCH) -> list[tuple[dict, float]]:
    """All (parameters, loss) in order of proposal. ``losses`` evaluates a batch at once.

    The first ``startup`` trials are draws from the space. Then batches are proposed one trial after the other,
    where a trial still to run counts as bad as the worst one seen, so a batch spreads out.
    """
    rng, seen = random.Random(seed), []
    while len(seen) < trials:
        if len(seen) < startup:
            wanted = [draw_parameters(space, rng) for _ in range(min(startup, trials) - len(seen))]
        else:
            wanted, known = [], list(seen)
            worst = max(loss for _, loss in seen)
            for _ in range(min(batch, trials - len(seen))):
                wanted.append(propose(space, known, rng))
                known.append((wanted[-1], worst))
        seen += list(zip(wanted, losses(wanted), strict=True))
    return seen
