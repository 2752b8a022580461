"""Screen sections and layouts against plain Python over the smallest tables."""

from collections import defaultdict

from larder.plans import rules
from larder.plans import views as v


def test_section_ranges_hold_each_tile_once(spark, small):
    tiles = defaultdict(list)
    for r in v.box(spark, small).collect():
        tiles[r["screen"]].append((r["y"], r["ord"]))
    want = set()
    for screen, some in tiles.items():
        ys = sorted(y for y, _ in some)
        border = max(((b - a, -b) for a, b in zip(ys, ys[1:])), default=(0, 0)) if len(ys) >= 3 else None
        border = -border[1] if border else 450
        for k, (a, b) in enumerate(((0, border), (border, 900))):
            inside = [o for y, o in some if a <= y < b]
            want.add((screen, k, a, b, len(inside), min(inside, default=None)))
    got = {tuple(r) for r in rules.section_ranges(spark, small).collect()}
    assert got == want
    assert sum(x[4] for x in got) == sum(map(len, tiles.values()))


def test_hard_failure_ends_the_checks(spark, small):
    rows = rules.header_geometry(spark, small).collect()
    hard = [r for r in rows if r["hard"]]
    assert hard and all(not r["compatible"] and r["issues"].endswith("Incompatible content position") for r in hard)
    assert any(r["compatible"] for r in rows) and any(r["critical"] and not r["hard"] for r in rows)
