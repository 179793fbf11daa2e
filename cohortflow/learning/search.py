"""Sequential model-based search over the booster's settings: a Parzen density-ratio sampler on one fixed split."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from cohortflow.learning.train import BoosterParams, FeatureColumns, evaluate_splits, params_as_text, train_gbt

#: Budget. 32 trials, of which 5 at random, and an end after 20 without a better one.
TRIALS, STARTUP, STALE = 32, 5, 20
#: Share of the trials that count as good, and points among which the next one is picked.
GOOD, CANDIDATES = 0.25, 24


@dataclass(frozen=True)
class Axis:
    """One setting: bounds, whether its logarithm is searched, and its step (0 for any number)."""

    low: float
    high: float
    log: bool = False
    step: float = 0

    def value(self, unit: float) -> float:
        """The setting at a place from 0 to 1."""
        low, high = (math.log(self.low), math.log(self.high)) if self.log else (self.low, self.high)
        if self.step:  # every value has an equal share of the places
            return self.low + self.step * min(int(unit * ((self.high - self.low) // self.step + 1)), (self.high - self.low) // self.step)
        found = low + unit * (high - low)
        return min(max(math.exp(found) if self.log else found, self.low), self.high)


@dataclass(frozen=True)
class SearchSpace:
    """Bounds of the search. The ranges; min_gain is the learner's only regulariser."""

    leaves: tuple[int, int] = (15, 63)
    max_depth: tuple[int, int] = (3, 12)
    learning_rate: tuple[float, float] = (0.01, 0.3)  # its logarithm
    trees: tuple[int, int, int] = (50, 500, 25)  # in steps
    min_rows: tuple[int, int] = (5, 50)
    row_share: tuple[float, float] = (0.6, 1.0)
    column_share: tuple[float, float] = (0.6, 1.0)
    min_gain: tuple[float, float] = (1e-8, 1e-2)  # its logarithm

    @property
    def axes(self) -> dict[str, Axis]:
        whole = {"leaves", "max_depth", "min_rows"}
        return {
            name: Axis(bounds[0], bounds[1], log=name in ("learning_rate", "min_gain"), step=bounds[2] if len(bounds) > 2 else int(name in whole))
            for name, bounds in vars(self).items()
        }

    def draw(self, trials: int, seed: int = 42) -> list[BoosterParams]:
        """Settings at random."""
        places = np.random.default_rng(seed).uniform(size=(trials, len(self.axes)))
        return [self.params(place, seed) for place in places]

    def params(self, place: Sequence[float], seed: int) -> BoosterParams:
        """The settings at a place of the unit cube."""
        values = {name: axis.value(u) for (name, axis), u in zip(self.axes.items(), place, strict=True)}
        return BoosterParams(**{n: int(v) if self.axes[n].step else v for n, v in values.items()}, seed=seed)


@dataclass(frozen=True)
class Trial:
    number: int
    place: tuple[float, ...]
    value: float | None

    @property
    def rank(self) -> tuple:
        """Larger is better; without a value comes last, and of equals the first trial counts."""
        known = self.value is not None and self.value == self.value
        return known, self.value if known else 0.0, -self.number


class _Parzen:
    """A density on 0..1: a mixture of normals around the points, as wide as the gaps next to them, and one broad one."""

    def __init__(self, points: np.ndarray):
        order = np.sort(points)
        gaps = np.diff(np.concatenate(([0.0], order, [1.0])))
        wide = np.clip(np.maximum(gaps[:-1], gaps[1:]), 1 / min(100, 1 + len(points)), 1.0)
        self.centres, self.widths = np.append(order, 0.5), np.append(wide, 1.0)

    def draw(self, rng: np.random.Generator, n: int) -> np.ndarray:
        which = rng.integers(0, len(self.centres), n)
        out = rng.normal(self.centres[which], self.widths[which])
        while (outside := (out < 0) | (out > 1)).any():
            out[outside] = rng.normal(self.centres[which[outside]], self.widths[which[outside]])
        return out

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x[:, None] - self.centres) / self.widths
        upper, lower = ((edge - self.centres) / (self.widths * math.sqrt(2)) for edge in (1, 0))
        inside = np.array([(math.erf(b) - math.erf(a)) / 2 for a, b in zip(lower, upper, strict=True)])  # the normals are cut at 0 and 1
        return np.log(np.mean(np.exp(-(z**2) / 2) / (self.widths * inside), axis=1) + 1e-300)


def next_place(trials: Sequence[Trial], axes: int, seed: int, number: int | None = None) -> tuple[float, ...]:
    """Where trial ``number`` looks: a random place at first, later the candidate whose density among the good trials most exceeds that among the
    others.

    It depends on nothing but the stored trials, the number and the seed, so a search can go on from its run table.
    """
    number = len(trials) if number is None else number
    rng = np.random.default_rng([seed, number])
    if number < STARTUP or len(trials) < 2:
        return tuple(rng.uniform(size=axes).tolist())
    ranked = sorted(trials, key=lambda t: t.rank, reverse=True)
    cut = max(1, math.ceil(GOOD * len(ranked)))
    place = []
    for axis in range(axes):
        good, other = (_Parzen(np.array([t.place[axis] for t in part])) for part in (ranked[:cut], ranked[cut:]))
        points = good.draw(rng, CANDIDATES)
        place.append(float(points[np.argmax(good.log_density(points) - other.log_density(points))]))
    return tuple(place)


def search(
    objective: Callable[[Sequence[float], int], float | None], axes: int, trials: int = TRIALS, seed: int = 42, stale: int = STALE, parallelism: int = 1
) -> list[Trial]:
    """Trials one after the other, each after what the earlier ones gave; larger values are better. It ends early once ``stale`` trials
    in a row brought no better value. With ``parallelism`` so many are placed and run together."""
    done: list[Trial] = []
    with ThreadPool(max(1, parallelism)) as pool:
        while len(done) < trials:
            numbers = range(len(done), min(len(done) + max(1, parallelism), trials))
            places = [next_place(done, axes, seed, n) for n in numbers]
            values = pool.starmap(objective, zip(places, numbers, strict=True))
            done += [Trial(n, p, v) for n, p, v in zip(numbers, places, values, strict=True)]
            if len(done) - 1 - max(done, key=lambda t: t.rank).number >= stale:
                break
    return done


def param_search(
    split_rows: DataFrame,
    label: str,
    features: FeatureColumns,
    trials: int = TRIALS,
    space: SearchSpace = SearchSpace(),
    seed: int = 42,
    parallelism: int = 1,
    stale: int = STALE,
) -> DataFrame:
    """trial, params, metrics, one row per trial; the best has the largest ``validation_roc_auc``.

    ``split_rows`` is read once per trial, so pass materialised rows. Every trial is a distributed fit that knows the earlier results.
    """
    rows = []

    def objective(place: Sequence[float], number: int) -> float | None:
        params = space.params(place, seed)
        found = evaluate_splits(train_gbt(split_rows, label, features, params), split_rows, label, ("validation",))
        rows.append((number, params_as_text(params), found))
        return found.get("validation_roc_auc")

    search(inheritable_thread_target(split_rows.sparkSession)(objective), len(space.axes), trials, seed, stale, parallelism)
    return split_rows.sparkSession.createDataFrame(sorted(rows, key=lambda r: r[0]), "trial int, params map<string,string>, metrics map<string,double>")


def params_of(row) -> BoosterParams:
    """The settings of a row of ``param_search``."""
    kinds = {k: type(v) for k, v in vars(BoosterParams()).items()}
    return BoosterParams(**{k: kinds[k](v) for k, v in row["params"].items()})
