"""Convex hulls against all triples of points, on shapes whose hull is known, and on clouds without a volume."""

import itertools
import math
import random

import numpy as np
import pytest

from fieldspark.operators import hull
from fieldspark.session import ready

SCHEMA = "pid bigint, x double, y double, z double"


@pytest.fixture(autouse=True)
def _ready(spark):
    ready(spark)


def brute(rows):
    at, out = {r[0]: np.array(r[1:]) for r in rows}, set()
    for a, b, c in itertools.combinations(at, 3):
        n = np.cross(at[b] - at[a], at[c] - at[a])
        side = [float(n @ (at[p] - at[a])) for p in at if p not in (a, b, c)]
        if all(s > 0 for s in side) or all(s < 0 for s in side):
            out.add(frozenset((a, b, c)))
    return out


def closed(faces, rows, near=1e-7):
    """Each edge once in each direction, and all points inside."""
    edges = [(f[f"v{i}"], f[f"v{(i + 1) % 3}"]) for f in faces for i in range(3)]
    assert len(set(edges)) == len(edges) and {(b, a) for a, b in edges} == set(edges)
    for f in faces:
        n = np.array([f["nx"], f["ny"], f["nz"]])
        assert abs(float(n @ n) - 1) < 1e-9
        assert all(float(n @ np.array(r[1:])) <= f["offset"] + near for r in rows)


def test_against_all_triples(spark):
    r = random.Random(1)
    rows = [(i, *[r.gauss(0, s) for s in (1, 2, 0.1)]) for i in range(60)]
    faces = hull.convex_hull(spark.createDataFrame(rows, SCHEMA), 1000)
    got = faces.collect()
    assert {frozenset((f["v0"], f["v1"], f["v2"])) for f in got} == brute(rows)
    assert all(f["beyond"] == 0 for f in got)
    closed(got, rows)
    degree = {c["pid"]: c["n_edges"] for c in hull.corners(faces).collect()}
    assert sum(degree.values()) == 3 * len(got) and len(degree) == 2 + len(got) // 2


def test_a_grid_has_the_corners_of_its_box(spark):
    rows = [(i, float(x), float(y), float(z)) for i, (x, y, z) in enumerate(itertools.product(range(5), range(4), range(3)))]
    rows += [(1000 + r[0], *r[1:]) for r in rows]  # each place twice: the least pid counts
    faces = hull.convex_hull(spark.createDataFrame(rows, SCHEMA))
    got = faces.collect()
    at = {r[0]: r[1:] for r in rows}
    assert {at[f[v]] for f in got for v in ("v0", "v1", "v2")} == set(itertools.product((0.0, 4.0), (0.0, 3.0), (0.0, 2.0)))
    assert all(f[v] < 1000 for f in got for v in ("v0", "v1", "v2")) and len(got) == 12
    closed(got, rows)
    inside = {r["pid"]: r["d"] for r in hull.depth(spark.createDataFrame([(1, 2.0, 1.5, 1.0), (2, 2.0, 1.5, 3.0), (3, None, 0.0, 0.0)], SCHEMA), faces).collect()}
    assert abs(inside[1] + 1) < 1e-9 and abs(inside[2] - 1) < 1e-9 and inside[3] is None


def test_most_bounds_the_corners(spark):
    r = random.Random(2)
    rows = []
    for i in range(800):
        v = [r.gauss(0, 1) for _ in range(3)]
        rows.append((i, *[c / math.sqrt(sum(x * x for x in v)) for c in v]))
    cloud = spark.createDataFrame(rows, SCHEMA)
    whole, part = hull.convex_hull(cloud, 4096).collect(), hull.convex_hull(cloud, 40)
    assert len(whole) == 2 * 800 - 4
    closed(whole, rows)
    got = part.collect()
    assert len({f[v] for f in got for v in ("v0", "v1", "v2")}) == 40 and len(got) == 76
    far = max(r["d"] for r in hull.depth(cloud, part).collect())
    assert abs(far - got[0]["beyond"]) < 1e-6 and 0 < far < 0.5


def test_clouds_without_a_volume(spark):
    for rows in ([], [(1, 0.0, 0.0, 0.0)] * 5, [(i, float(i), 2.0 * i, 0.0) for i in range(6)], [(i, float(i % 3), float(i // 3), 1.0) for i in range(9)], [(1, None, 0.0, 0.0), (2, float("nan"), 1.0, 1.0), (None, 1.0, 2.0, 3.0)]):
        faces = hull.convex_hull(spark.createDataFrame(rows, SCHEMA))
        assert faces.collect() == [] and hull.edges(faces).collect() == []


def test_unknown_places_and_other_columns(spark):
    rows = [(i, *map(float, c)) for i, c in enumerate(itertools.product((0, 1), repeat=3))]
    df = spark.createDataFrame([(*r, "a", 1) for r in rows] + [(99, None, 5.0, 5.0, "b", 2), (98, float("inf"), 0.0, 0.0, "c", 3)], SCHEMA + ", face string, far int")
    got = hull.convex_hull(df).collect()
    assert len(got) == 12
    closed(got, rows)
