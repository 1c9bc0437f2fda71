"""Spatial index of geometries: coverings and searches against plain arithmetic."""

import json
import random

import pytest
from pyspark.sql import functions as F

from doclake.operators import geometry as Geo
from doclake.operators.shape import parse_docs
from doclake.runtime import stored


def shapes_of(spark, geometries, strict=True):
    texts = [(i, json.dumps({"g": g} if g is not ... else {})) for i, g in enumerate(geometries)]
    return Geo.shapes(parse_docs(spark.createDataFrame(texts, "id bigint, doc string")), "g", strict)


def geo(kind, coordinates):
    return {"type": kind, "coordinates": coordinates}


SQUARE = [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]
HOLE = [[2, 2], [8, 2], [8, 8], [2, 8], [2, 2]]


def test_every_kind_of_geometry(spark):
    line = [[1, 1], [2.5, 3]]
    collection = {"type": "GeometryCollection", "geometries": [geo("Point", [5, 5]), geo("Polygon", [SQUARE])]}
    given = [
        geo("Point", [1, 2, 99]), geo("MultiPoint", [[1, 2], [3, 4]]), geo("LineString", line),
        geo("MultiLineString", [line, [[7, 7], [8, 8], [9, 9]]]), geo("Polygon", [SQUARE, HOLE]),
        geo("MultiPolygon", [[SQUARE], [HOLE]]), collection,
    ]
    rows = shapes_of(spark, given).select("id", "part", "dim", F.size("edges").alias("n")).collect()
    assert sorted(map(tuple, rows)) == [
        (0, 0, 0, 1), (1, 0, 0, 2), (2, 0, 1, 1), (3, 0, 1, 1), (3, 1, 1, 2), (4, 0, 2, 8), (5, 0, 2, 4), (5, 1, 2, 4),
        (6, 0, 0, 1), (6, 1, 2, 4),
    ]


def test_nothing_to_index(spark):
    given = [..., None, geo("Point", []), geo("LineString", []), geo("Polygon", []), geo("MultiPolygon", [[]]),
             {"type": "GeometryCollection", "geometries": []}]
    parts = shapes_of(spark, given)
    assert parts.count() == 0 and Geo.covering(parts).count() == 0
    assert Geo.intersecting(Geo.covering(parts), parts, Geo.box_query(spark, -180, -90, 180, 90)).count() == 0


WRONG = [
    "text", 5, {"type": "Circle", "coordinates": [1, 2]}, geo("Point", [181, 0]), geo("Point", ["1", "x"]), geo("Point", [1]),
    geo("LineString", [[1, 1]]), geo("Polygon", [SQUARE[:4]]), geo("Polygon", [[[0, 0], [1, 1], [0, 0]]]),
    {"type": "GeometryCollection", "geometries": [{"type": "GeometryCollection", "geometries": []}]},
]


def test_wrong_shapes(spark):
    assert shapes_of(spark, [*WRONG, geo("Point", [1, 2])], strict=False).select("id").collect()[0][0] == len(WRONG)
    for wrong in WRONG[:3]:
        with pytest.raises(Exception, match="not a GeoJSON geometry"):
            shapes_of(spark, [wrong]).collect()


def test_long_lines_have_few_rows_and_points_one(spark):
    line = [[-170 + 0.01 * i, 60 * ((i * 7919) % 1000) / 1000 - 30] for i in range(30_000)]
    given = [geo("LineString", [[-179, -80], [-1, 80], [179, 10]]), geo("Point", [12.5, -3]), geo("LineString", line)]
    cells = Geo.covering(shapes_of(spark, given)).groupBy("id").count().collect()
    counts = {r["id"]: r["count"] for r in cells}
    assert counts[1] == 1 and counts[0] < 25 and counts[2] <= 64


def test_siblings_become_their_parent(spark):
    whole = [[-180, -90], [-90, -90], [0, -90], [90, -90], [180, -90], [180, 90], [90, 90], [0, 90], [-90, 90], [-180, 90], [-180, -90]]
    cells = Geo.covering(shapes_of(spark, [geo("Polygon", [whole])])).collect()
    assert [(c.lo, c.hi) for c in cells] == [(0, 4**20 - 1)]


def test_date_line(spark):
    given = [
        geo("LineString", [[179, 0], [-179, 2]]), geo("LineString", [[-179, 2], [179, 0]]), geo("LineString", [[170, 0], [160, 0]]),
        geo("Polygon", [[[175, -5], [-175, -5], [-175, 5], [175, 5], [175, -5]]]),
    ]
    parts = shapes_of(spark, given)
    assert {(r.west, r.east) for r in parts.filter("id < 2").collect()} <= {(179.0, 181.0), (-181.0, -179.0)}
    index = Geo.covering(parts)

    def found(west, south, east, north):
        return sorted(r.id for r in Geo.intersecting(index, parts, Geo.box_query(spark, west, south, east, north)).collect())

    assert found(179.5, -1, -179.5, 3) == [0, 1, 3]
    assert found(-180, 0.5, -179.9, 1.5) == [0, 1, 3]
    assert found(179.9, 0.5, 180, 1.5) == [0, 1, 3]
    assert found(-1, -90, 1, 90) == []
    assert found(176, -4, 177, -3) == [3]  # wholly inside the area
    assert found(-180, -90, 180, 90) == [0, 1, 2, 3]


# --- random shapes against an independent test ------------------------------------------


def cross(o, a, b):
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def on(a, b, p):
    return cross(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])


def segments_meet(a, b, c, d):
    if any((on(a, b, c), on(a, b, d), on(c, d, a), on(c, d, b))):
        return True
    return (cross(a, b, c) > 0) != (cross(a, b, d) > 0) and (cross(c, d, a) > 0) != (cross(c, d, b) > 0) and 0 not in (
        cross(a, b, c), cross(a, b, d), cross(c, d, a), cross(c, d, b)
    )


def inside(rings, p):
    odd = False
    for ring in rings:
        for a, b in zip(ring, ring[1:]):
            if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (p[1] - a[1]) * (b[0] - a[0]) / (b[1] - a[1]):
                odd = not odd
    return odd


def pieces(g):
    kind, c = g["type"], g["coordinates"]
    if kind == "Point":
        return [(c, c)], None
    if kind == "LineString":
        return list(zip(c, c[1:])), None
    return [e for ring in c for e in zip(ring, ring[1:])], c


def meet(g, h):
    (a, rings), (b, others) = pieces(g), pieces(h)
    return any(segments_meet(*e, *f) for e in a for f in b) or (
        rings is not None and inside(rings, b[0][0])) or (others is not None and inside(others, a[0][0]))


def some_shape(rnd):
    x, y = rnd.randrange(-100, 100), rnd.randrange(-60, 60)
    far = rnd.choice([1, 5, 30])

    def near():
        return [x + rnd.randrange(-far, far + 1), y + rnd.randrange(-min(far, 25), min(far, 25) + 1)]

    kind = rnd.randrange(3)
    if kind == 0:
        return geo("Point", [x + 0.25, y + 0.5])
    if kind == 1:
        return geo("LineString", [near() for _ in range(rnd.randrange(2, 6))])
    w, h = rnd.randrange(1, far + 2), rnd.randrange(1, min(far, 25) + 2)
    ring = [[x, y], [x + w, y], [x + w + 0.5, y + h], [x, y + h], [x, y]]
    hole = [[x + w / 4, y + h / 4], [x + w / 2, y + h / 4], [x + w / 2, y + h / 2], [x + w / 4, y + h / 2], [x + w / 4, y + h / 4]]
    return geo("Polygon", [ring, hole] if rnd.random() < 0.5 else [ring])


def test_searches_find_what_meets(spark):
    rnd = random.Random(8)
    given = [some_shape(rnd) for _ in range(400)]
    parts = stored(shapes_of(spark, given), "shapes")
    index = stored(Geo.spatial_shape_index(parts), "cells")
    for _ in range(10):
        query = some_shape(rnd)
        got = Geo.intersecting(index, parts, Geo.geometry_query(spark, json.dumps(query))).collect()
        assert sorted(r.id for r in got) == [i for i, g in enumerate(given) if meet(g, query)]


def test_candidates_are_read_by_code_range(spark):
    parts = stored(shapes_of(spark, [geo("Point", [i % 180, i % 90]) for i in range(500)]), "shapes")
    index = stored(Geo.spatial_shape_index(parts), "cells")
    near = Geo.candidates(index, Geo.box_query(spark, 10, 10, 11, 11))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(lo," in plan
    assert near.count() < 30


def test_a_block_without_one_of_its_cells_stays_apart(spark):
    # The line touches three of the four cells of its last block
    cells = Geo.covering(shapes_of(spark, [geo("LineString", [[75.0, 14.75], [66.0, 4.75], [80.0, -1.25]])])).collect()
    assert {(854698491904, 854966927359), (854966927360, 855235362815), (855503798272, 855772233727)} <= {(r.lo, r.hi) for r in cells}


def test_portions_do_not_change_a_covering(monkeypatch):
    import numpy as np
    import pyarrow as pa

    rnd = np.random.default_rng(5)
    edge = pa.struct([(name, pa.float64()) for name in ("x1", "y1", "x2", "y2")])
    rows = []
    for i in range(60):
        x, y, wide = rnd.uniform(-170, 160), rnd.uniform(-80, 70), rnd.uniform(0.01, 9)
        corners = [(x, y), (x + wide, y + wide / 3), (x + wide / 2, y + wide), (x, y)]
        rows.append([dict(zip(("x1", "y1", "x2", "y2"), (*a, *b))) for a, b in zip(corners, corners[1:])])
    ends = [[e[name] for e in r for name in pair] for pair in (("x1", "x2"), ("y1", "y2")) for r in rows]
    boxes = {"west": map(min, ends[:60]), "east": map(max, ends[:60]), "south": map(min, ends[60:]), "north": map(max, ends[60:])}
    batch = pa.RecordBatch.from_pydict({
        "id": [f"d{i}" for i in range(60)], "part": pa.array([0] * 60, pa.int32()), "dim": pa.array([1 + i % 2 for i in range(60)], pa.int32()),
        "edges": pa.array(rows, pa.list_(edge)), **{side: pa.array(list(x)) for side, x in boxes.items()},
    })

    def covered(portion, given):
        monkeypatch.setattr(Geo, "PORTION", portion)
        return sorted(tuple(r.values()) for b in Geo._cover(iter(given)) for r in b.to_pylist())

    whole = covered(1 << 15, [batch])
    assert len({r[2] for r in whole}) == 60
    assert covered(2, [batch]) == covered(7, [batch]) == whole
    assert covered(1 << 15, [batch.slice(0, 23), batch.slice(23)]) == whole
