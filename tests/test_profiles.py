"""Breaks of profiles against numpy."""

import random

import numpy as np
import pytest

from larder.operators.profiles import breaks, nearest_break, outermost_break


@pytest.fixture(scope="module")
def series():
    r = random.Random(6)
    out = {}
    for k in [*range(60), None]:
        level, n = 100, r.choice([1, 2, 3, 20, 61])
        levels = []
        for _ in range(n):
            level += r.choice([0, 1, -1, 1, -2, 40, -35]) if r.random() < 0.5 else 0
            levels.append(level)
        out[k] = levels
    return out


@pytest.fixture(scope="module")
def rows(spark, series):
    some = [(k, i, x) for k, levels in series.items() for i, x in enumerate(levels)]
    return spark.createDataFrame([*some, (1, 1000, None)], "s int, place int, level int").repartition(4)


@pytest.mark.parametrize("how", [{"percentile": 0.95}, {"percentile": 0.5}, {"deviations": 2.0}])
def test_breaks_as_numpy(rows, series, how):
    got = sorted((-1 if r["s"] is None else r["s"], r["place"], r["jump"], r["n"]) for r in breaks(rows, "s", "place", "level", **how).collect())
    want = []
    for k, levels in series.items():
        jumps = np.abs(np.diff(levels))
        if len(jumps):
            most = np.percentile(jumps, 100 * how["percentile"]) if "percentile" in how else np.std(jumps) * how["deviations"]
            want += [(-1 if k is None else k, int(i), int(jumps[i]), len(levels)) for i in np.where(jumps > most)[0]]
    assert got == sorted(want)


def test_nearest_and_outermost(rows, series):
    found = breaks(rows, "s", "place", "level", percentile=0.5).persist()
    by = {}
    for r in found.collect():
        by.setdefault(r["s"], []).append(r["place"])
    near, first, last = {}, {}, {}
    for k, places in by.items():
        n = len(series[k])
        close = [p for p in places if abs(p - int(n * 0.3)) <= int(n * 0.1)]
        if close:
            near[k] = min(close, key=lambda p: (abs(p - int(n * 0.3)), p))
        if inner := [p for p in places if p > n * 0.05]:
            first[k] = min(inner)
        if inner := [p for p in places if p < n * 0.95]:
            last[k] = max(inner)
    assert {r["s"]: r["place"] for r in nearest_break(found, "s", "place", 0.3, 0.1).collect()} == near
    assert {r["s"]: r["place"] for r in outermost_break(found, "s", "place", "place > n * 0.05").collect()} == first
    assert {r["s"]: r["place"] for r in outermost_break(found, "s", "place", "place < n * 0.95", first=False).collect()} == last


def test_one_threshold_must_be_named(rows):
    with pytest.raises(ValueError, match="percentile or deviations"):
        breaks(rows, "s", "place", "level")
