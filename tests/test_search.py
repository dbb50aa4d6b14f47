"""The sequential search on planted objectives, and stopped and resumed."""

import math
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from kindred.operators import learn as ln
from kindred.operators import search as se
from test_learn import _table


def planted(point):
    """Best at one place; two of the dimensions do not matter."""
    goal = (0.8, 0.3, 0.55, 0.1, 0.65)
    return -sum((x - g) ** 2 for x, g in zip(point, goal))


def random_best(seed, n):
    rng = random.Random(seed)
    return max(planted([rng.random() for _ in range(7)]) for _ in range(n))


def test_learns_from_trials():
    ours = [max(t.value for t in se.search(lambda ps: [planted(p) for p in ps], 60, s)) for s in range(20)]
    blind = [random_best(s, 60) for s in range(20)]
    assert sum(a >= b for a, b in zip(ours, blind)) >= 18
    assert sum(ours) / 20 > 0.5 * sum(blind) / 20  # values are negative: the mean distance is less than half


@pytest.mark.parametrize("batch", [1, 4])
def test_resumes_with_the_same_draws(batch):
    def evaluate(ps):
        return [planted(p) for p in ps]

    whole = se.search(evaluate, 30, 5, batch=batch)
    kept, asked = [], []

    def stopping(ps):
        if len(asked) >= 17:
            raise RuntimeError("stopped")
        asked.extend(ps)
        return evaluate(ps)

    with pytest.raises(RuntimeError):
        se.search(stopping, 30, 5, batch=batch, store=kept.append)
    assert 0 < len(kept) < 30
    again = se.search(evaluate, 30, 5, batch=batch, load=lambda: kept[: len(kept) - 1])
    assert again == whole
    nan = se.search(lambda ps: [math.nan] * len(ps), 12, 5)
    assert all(t.value == -math.inf for t in nan)


def test_points_cover_the_space_and_stay_in_it():
    space = ln.SearchSpace()
    rng = random.Random(1)
    drawn = [se.to_params([rng.random() for _ in range(7)], space) for _ in range(400)]
    assert {p.max_depth for p in drawn} == set(range(2, 14)) and {p.pos_weight for p in drawn} == set(range(1, 6))
    ends = [se.to_params([e] * 7, space) for e in (0.0, 1.0)]
    assert (ends[0].max_iter, ends[1].max_iter) == space.max_iter
    assert math.isclose(ends[0].step_size, 1e-9) and math.isclose(ends[1].step_size, 1.0)


def test_cross_validated_search_with_history(spark):
    df = ln.stratify(_table(spark, 200), seed=1).where(~F.col("holdout")).checkpoint()
    path = os.path.join(tempfile.mkdtemp(prefix="kindred-search-"), "trials")
    space = ln.SearchSpace(max_iter=(2, 4), max_depth=(2, 3), step_size=(0.1, 1.0))
    best, means = se.sequential_search(df, ["s", "n1"], 2, 3, space, path=path)
    assert len(means) == 2 and max(means) > 0.8
    more, longer = se.sequential_search(df, ["s", "n1"], 4, 3, space, path=path)
    assert longer[:2] == means and len(se.stored_trials(spark, path)) == 4
    assert max(longer) >= max(means)
