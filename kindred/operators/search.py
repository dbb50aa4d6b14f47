"""Parameter search that learns from its trials.

Each dimension of a ``SearchSpace`` is mapped to the unit interval. Once
there are enough trials, they are cut into good and bad ones; each side gives
a density per dimension (a mixture of truncated normal kernels at its trials
and a uniform one), points are drawn from the good density, and the one with
the largest sum of log density ratios is tried next. A proposal depends on
the seed, its number and the trials before it only, so a search that resumes
from its stored history goes on as if it had never stopped.

A trial is a few numbers: they live on the driver, the work of a trial (a
cross-validation) on the cluster.
"""

from __future__ import annotations

import json
import math
import os
import random
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from kindred.operators.learn import Cuts, SearchSpace, TreeParams, cross_validate, cut_points

STARTUP = 10       # random trials before densities are used
CANDIDATES = 24    # points compared for a proposal
DIMENSIONS = ("pos_weight", "step_size", "max_iter", "max_depth", "row_tenths", "feature_tenths", "min_info_gain")


@dataclass(frozen=True)
class Trial:
    number: int
    point: tuple          # a place in the unit interval by dimension
    value: float          # larger is better


def to_params(point: tuple, space: SearchSpace) -> TreeParams:
    """The parameters at a point."""
    def whole(i, ends):
        lo, hi = ends
        return min(hi, lo + int(point[i] * (hi - lo + 1)))

    low, high = map(math.log, space.step_size)
    return TreeParams(pos_weight=whole(0, space.pos_weight), step_size=math.exp(low + point[1] * (high - low)),
                      max_iter=whole(2, space.max_iter), max_depth=whole(3, space.max_depth),
                      subsampling_rate=whole(4, space.row_tenths) / 10, feature_subset=whole(5, space.feature_tenths) / 10,
                      min_info_gain=float(whole(6, space.min_info_gain)))


class Density:
    """A mixture on the unit interval: a kernel at each place, and a uniform
    one that keeps every place possible."""

    def __init__(self, places: list[float]):
        self.places = places
        n = len(places)
        mean = sum(places) / n if n else 0.5
        spread = math.sqrt(sum((x - mean) ** 2 for x in places) / n) if n else 0.0
        self.width = min(0.5, max(0.05, 1.06 * spread * max(1, n) ** -0.2))

    def _mass(self, c: float) -> float:
        cdf = lambda x: 0.5 * (1 + math.erf((x - c) / (self.width * math.sqrt(2))))
        return cdf(1.0) - cdf(0.0)

    def draw(self, rng: random.Random) -> float:
        k = rng.randrange(len(self.places) + 1)
        if k == len(self.places):
            return rng.random()
        while True:
            x = rng.gauss(self.places[k], self.width)
            if 0.0 <= x <= 1.0:
                return x

    def log(self, x: float) -> float:
        each = [math.exp(-((x - c) / self.width) ** 2 / 2) / (self.width * math.sqrt(2 * math.pi) * self._mass(c)) for c in self.places]
        return math.log((1.0 + sum(each)) / (len(self.places) + 1))


def propose(trials: list[Trial], number: int, seed: int, dims: int = len(DIMENSIONS), startup: int = STARTUP) -> tuple:
    """The point of trial ``number`` after ``trials``."""
    rng = random.Random(f"{seed}/{number}")
    if len(trials) < startup:
        return tuple(rng.random() for _ in range(dims))
    ranked = sorted(trials, key=lambda t: (-t.value, t.number))
    n_good = max(2, math.ceil(0.2 * len(ranked)))
    good = [Density([t.point[i] for t in ranked[:n_good]]) for i in range(dims)]
    bad = [Density([t.point[i] for t in ranked[n_good:]]) for i in range(dims)]
    drawn = [tuple(d.draw(rng) for d in good) for _ in range(CANDIDATES)]
    return max(drawn, key=lambda p: sum(good[i].log(x) - bad[i].log(x) for i, x in enumerate(p)))


# ---- history ---------------------------------------------------------------------

def stored_trials(spark: SparkSession, path: str) -> list[Trial]:
    """The trials stored at ``path`` in order; one of each number."""
    if not _exists(spark, path):
        return []
    rows = spark.read.schema("number int, point array<double>, value double, setting string").parquet(os.path.join(path, "*"))
    found = {r["number"]: Trial(r["number"], tuple(r["point"]), r["value"]) for r in rows.collect()}  # a row a trial
    return [found[k] for k in sorted(found)]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def store_trial(spark: SparkSession, path: str, trial: Trial, setting: str) -> None:
    """Each trial has a folder of its own number: a repeated write replaces it."""
    row = [(trial.number, list(trial.point), trial.value, setting)]
    spark.createDataFrame(row, "number int, point array<double>, value double, setting string").coalesce(1) \
        .write.mode("overwrite").parquet(os.path.join(path, f"trial={trial.number:06d}"))


def search(evaluate: Callable[[list[tuple]], list[float]], n: int, seed: int, dims: int = len(DIMENSIONS), batch: int = 1,
           load: Callable[[], list[Trial]] = list, store: Callable[[Trial], None] = lambda t: None) -> list[Trial]:
    """Trials 0 to ``n - 1``: those that ``load`` gives, and new ones.
    ``batch`` points are proposed from the same history and evaluated
    together; batches start at multiples of ``batch``, so that a resumed
    search proposes what an unbroken one would."""
    known = {t.number: t for t in load() if t.number < n}
    for start in range(0, n, batch):
        numbers = range(start, min(n, start + batch))
        before = [known[k] for k in range(start)]
        todo = [(k, propose(before, k, seed, dims)) for k in numbers if k not in known]
        for (k, p), v in zip(todo, evaluate([p for _, p in todo]) if todo else []):
            known[k] = Trial(k, p, v if not math.isnan(v) else -math.inf)
            store(known[k])
    return [known[k] for k in range(n)]


def sequential_search(train: DataFrame, features: list[str], trials: int, seed: int = 4222, space: SearchSpace = SearchSpace(),
                      parallelism: int = 2, folds: int = 5, path: str | None = None, cuts: Cuts | None = None) -> tuple[TreeParams, list[float]]:
    """The best parameters of ``trials`` cross-validated ones and all mean
    scores. With ``path`` every trial is stored there and taken from there
    when the search runs again. Trees split at ``cuts``, if not given those
    of all rows of ``train``."""
    spark = train.sparkSession
    cuts = cuts or cut_points(train, features)

    def evaluate(points):
        return cross_validate(train, features, [to_params(p, space) for p in points], seed, parallelism, folds, cuts)[1]

    def keep(t: Trial):
        if path:
            store_trial(spark, path, t, json.dumps(asdict(to_params(t.point, space))))

    done = search(evaluate, trials, seed, batch=max(1, parallelism), load=lambda: stored_trials(spark, path) if path else [], store=keep)
    best = max(done, key=lambda t: (t.value, -t.number))
    return to_params(best.point, space), [t.value for t in done]
