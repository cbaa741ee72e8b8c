"""Orientation of normals, occupancy by rays and neighbours in one place, against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldspark.operators import occupancy, orientation, spatial
from fieldspark.session import ready


@pytest.fixture(autouse=True)
def _ready(spark):
    ready(spark)


def kruskal(points, k):
    """pid -> turned normal: k nearest others as edges, sorted, joined one after the other."""
    where = {p[0]: np.array(p[1:4]) for p in points}
    normal = {p[0]: np.array(p[4:7]) for p in points}
    edges = set()
    for q in where:
        near = sorted((float(((where[q] - where[n]) ** 2).sum()), n) for n in where)[: k + 1]
        edges |= {(min(q, n), max(q, n)) for _, n in near if n != q}
    cost = lambda u, v: 1.0 - abs(normal[u] @ normal[v]) / (math.sqrt(normal[u] @ normal[u]) * math.sqrt(normal[v] @ normal[v]))
    part, sign = {p: p for p in where}, dict.fromkeys(where, 1)
    for _, u, v in sorted((cost(u, v), u, v) for u, v in edges):
        if part[u] != part[v]:
            f, old = sign[u] * (-1 if normal[u] @ normal[v] < 0 else 1) * sign[v], part[v]
            for p in where:
                if part[p] == old:
                    part[p], sign[p] = part[u], sign[p] * f
    out = {}
    for name in set(part.values()):
        own = [p for p in where if part[p] == name]
        top = max(own, key=lambda p: (where[p][2], -p))
        n = normal[top] * sign[top]
        turn = -1 if (n[2], n[1], n[0]) < (0, 0, 0) else 1
        out |= {p: normal[p] * sign[p] * turn for p in own}
    return out


CLOUD = "pid bigint, x double, y double, z double, nx double, ny double, nz double, p string"


def test_orientation_equals_kruskal(spark):
    r = random.Random(4)
    rows = [(i, *[r.uniform(0, 1) + (5 if i > 40 else 0) for _ in range(3)], *[r.gauss(0, 1) for _ in range(3)], "a") for i in range(60)]
    odd = [(100, 0.5, 0.5, 0.5, None, 1.0, 0.0, "a"), (101, 0.5, None, 0.5, 1.0, 1.0, 0.0, "a"), (102, 0.1, 0.2, 0.3, 0.0, 0.0, 0.0, None), (None, 0.1, 0.2, 0.3, 1.0, 0.0, 0.0, None), (103, 0.1, 0.2, 0.3, float("nan"), 0.0, 0.0, None)]
    got = orientation.consistent(spark.createDataFrame(rows + odd, CLOUD), k=4, edge=0.2)
    assert got.columns == [c.split(" ")[0] for c in CLOUD.split(", ")]
    out = {x["pid"]: x for x in got.collect()}
    assert len(out) == len(rows) + len(odd)
    for pid, n in kruskal(rows, 4).items():
        assert (out[pid]["nx"], out[pid]["ny"], out[pid]["nz"]) == tuple(n)
    for x in odd:
        assert repr(tuple(out[x[0]])) == repr(x)  # what has no normal or place stays as it is


def test_a_sphere_turns_outward(spark):
    i = np.arange(400) + 0.5
    up, round_ = np.arccos(1 - 2 * i / 400), np.pi * (1 + 5**0.5) * i
    xyz = np.stack([np.cos(round_) * np.sin(up), np.sin(round_) * np.sin(up), np.cos(up)], 1)
    signs = np.random.default_rng(2).choice([-1.0, 1.0], 400)
    rows = [(k, *p, *(p * s), None) for k, (p, s) in enumerate(zip(xyz.tolist(), signs.tolist())) for p in [np.array(p)]]
    rows = [tuple(v if v is None or isinstance(v, int) else float(v) for v in r) for r in rows]
    for r in orientation.consistent(spark.createDataFrame(rows, CLOUD), k=8, edge=0.1).collect():
        assert r["nx"] * r["x"] + r["ny"] * r["y"] + r["nz"] * r["z"] > 0.99


def test_a_chain_takes_few_rounds(spark):
    """Each point's only neighbours are the next ones: signs come through a path of 200 edges."""
    rows = [(i, float(i), 0.0, float(i == 150), 0.01 * i, 1.0, -1.0 if i % 3 else 1.0, None) for i in range(200)]
    edges = spark.createDataFrame([(i, i + 1, float((i * 7919) % 200), -1 if i % 3 == 0 else 1) for i in range(199)], "u bigint, v bigint, w double, s int")
    got = {r["c"]: (r["p"], r["s"]) for r in orientation.tree_signs(edges).collect()}
    sign = [1]
    for i in range(199):
        sign.append(sign[-1] * (-1 if i % 3 == 0 else 1))
    name = got[0][0]
    assert all(got[i] == (name, sign[i] * sign[name]) for i in range(200)) and len(rows) == 200


@pytest.mark.parametrize("rows", [[], [(7, 1.0, 2.0, 3.0, 0.0, 0.0, -2.0, "a")], [(1, 0.0, 0.0, 0.0, 0.0, -1.0, 0.0, "a"), (2, 0.0, 0.0, 0.0, -1.0, 0.0, 0.0, "b")]])
def test_tiny_clouds(spark, rows):
    got = sorted(orientation.consistent(spark.createDataFrame(rows, CLOUD)).collect())
    assert [(r["pid"], r["nx"], r["ny"], r["nz"]) for r in got] == {0: [], 1: [(7, 0.0, 0.0, 2.0)], 2: [(1, 0.0, 1.0, 0.0), (2, 1.0, 0.0, 0.0)]}[len(rows)]


def stepped(o, p, edge, most):
    """Cells of a ray by stepping to the next plane, one after the other."""
    d = [b - a for a, b in zip(o, p)]
    stop = min(1.0, most / math.sqrt(sum(x * x for x in d))) if any(d) else 1.0
    t, out = 0.0, []
    while t < stop:
        nxt = stop
        for a, x in zip(o, d):
            if x:
                for i in range(math.floor((a + x * t) / edge) - 1, math.floor((a + x * t) / edge) + 3):
                    at = (i * edge - a) / x
                    if t < at < nxt:
                        nxt = at
        out.append(tuple(math.floor((a + x * (t + nxt) / 2) / edge) for a, x in zip(o, d)))
        t = nxt
    return out


RAYS = "scan int, ox double, oy double, oz double, x double, y double, z double"


def test_rays_pass_the_cells_between(spark):
    r = random.Random(9)
    rows = [(i % 3 or None, *[r.uniform(-0.2, 0.2) for _ in range(3)], *[r.uniform(-1, 1) for _ in range(3)]) for i in range(80)]
    rows += [(1, 0.05, 0.05, 0.05, 0.95, 0.05, 0.05), (1, 0.05, 0.05, 0.05, 0.05, 0.05, 0.05), (2, 0.05, 0.05, 0.05, 0.05, -0.95, 0.05), rows[0], (2, None, 0.0, 0.0, 1.0, 1.0, 1.0), (2, 0.0, 0.0, 0.0, float("nan"), 1.0, 1.0)]
    want, cells = {}, {}
    for scan, *c in rows[:-2]:
        o, p = c[:3], c[3:]
        length = math.dist(o, p)
        end = tuple(math.floor(v / 0.1) for v in p)
        for q in stepped(o, p, 0.1, 0.8):
            if length > 0.8 or q != end:
                want.setdefault((scan, q), 0)
        if length <= 0.8:
            want[scan, end] = 1
    for (_, q), hit in want.items():
        h, m = cells.get(q, (0, 0))
        cells[q] = (h + hit, m + 1 - hit)
    got = occupancy.grid(spark.createDataFrame(rows, RAYS), 0.1, most=0.8).collect()
    assert {(g["cx"], g["cy"], g["cz"]): (g["hits"], g["misses"]) for g in got} == cells
    for g in got:
        total = g["hits"] * math.log(0.7 / 0.3) + g["misses"] * math.log(0.4 / 0.6)
        assert abs(g["log_odds"] - max(math.log(0.1192 / 0.8808), min(math.log(0.971 / 0.029), total))) < 1e-9 and g["occupied"] == (g["log_odds"] > 0)


def test_short_rays_and_empty_clouds(spark):
    rows = spark.createDataFrame([(1, 0.0, 0.0, 0.0, 0.05, 0.0, 0.0)], RAYS)
    assert occupancy.grid(rows, 0.1, least=0.1).collect() == []
    assert occupancy.grid(rows.where("scan > 5"), 0.1).collect() == []


def test_a_ray_is_one_expression(spark):
    """One shuffle for each of the two counts, none to find cells, and no Python."""
    plan = occupancy.grid(spark.createDataFrame([(1, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0)], RAYS), 0.1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "Python" not in plan and "Join" not in plan


def test_points_in_one_place(spark):
    """Neighbours among many equal points: the right ones, from few pairs."""
    rows = [(i, 1.0, 1.0, -0.0 if i % 2 else 0.0) for i in range(600)] + [(1000 + i, 2.0 + i, 0.0, 0.0) for i in range(5)]
    points = spark.createDataFrame(rows, "pid bigint, x double, y double, z double")
    got = {}
    for r in spatial.knn(points, points, 3, 0.5).collect():
        got.setdefault(r["q"], []).append((r["rank"], r["n"], r["d2"]))
    where = {r[0]: np.array(r[1:]) for r in rows}
    for q in (0, 17, 599, 1000, 1004):
        want = sorted((float(((where[q] - where[n]) ** 2).sum()), n) for n in where)[:3]
        assert sorted(got[q]) == [(k + 1, n, d) for k, (d, n) in enumerate(want)]
    assert len(got) == 605 and all(len(v) == 3 for v in got.values())
    places = spatial._near(points.groupBy("x", "y", "z").agg(F.min("pid").alias("pid")), points.where("pid < 3 OR pid >= 1000"), 0.5)
    assert places.count() < 20
    assert sorted(r["pid"] for r in spatial.radius_outliers(points, 0.5, 599).collect()) == list(range(600))
    assert spatial.radius_outliers(points, 0.5, 600).count() == 0


@pytest.mark.parametrize("within", [None, 0.4])
def test_neighbours_leave_a_task_as_the_nearest_few(spark, within):
    rng = np.random.default_rng(8)
    places = np.concatenate([rng.integers(0, 9, (300, 3)) / 8, rng.random((40, 3)) * 20])  # many ties, places twice, and a thin part
    rows = [(int(i), *map(float, p)) for i, p in zip(rng.permutation(1000)[: len(places)], places)]
    cloud = spark.createDataFrame(rows, "pid bigint, x double, y double, z double")
    want = []
    for i, *p in rows:
        d = sorted(((p[0] - x) * (p[0] - x) + (p[1] - y) * (p[1] - y) + (p[2] - z) * (p[2] - z), n) for n, x, y, z in rows)
        want += [(i, n, d2, r + 1) for r, (d2, n) in enumerate(d[:6]) if within is None or d2 <= within * within]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # cells go over batches
    try:
        assert sorted(map(tuple, spatial.knn(cloud, cloud, 6, 0.1, within=within).collect())) == sorted(want)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    plan = spatial._near_k(cloud, cloud, 6, 0.2, within)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.index("MapInArrow") < plan.index("Exchange")  # pairs aren't shuffled or sorted
