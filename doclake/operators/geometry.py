"""Spatial index of any GeoJSON geometry: coverings of quad-tree cells, candidates by code range, exact refinement.

A geometry is a series of parts, each of dimension 0 (points), 1 (a line) or 2 (a polygon with its rings), and a part is
its edges; a point is an edge of no length. Longitude and latitude are plane coordinates. An edge whose ends are more
than 180 degrees apart takes the short way across the date line; its second end is then moved by 360 degrees.

The plane is a square of 2^20 x 2^20 finest cells, numbered along a Z curve, so that a cell of any level is a range of
numbers. A part is covered by the cells its edges touch at a level where it is 4 to 8 cells wide, and by those inside;
four sibling cells become their parent. A long line so gets a few large cells, a point one small one.

Defined cases: a missing or null value, and a geometry without coordinates, has no parts and no rows; a value that is no
geometry, a position outside the globe, a line of one position, an open ring and a collection within a collection raise
(``strict``) or have no rows. Holes are honoured. Edges touching count as meeting. Poles are ordinary edges of the plane:
a polygon around a pole must be drawn along it. Everything is one projection per document: no shuffle but for sorting.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from doclake.functions.variants import field
from doclake.runtime import ship_package

LEVELS = 20  # of the finest cells
WIDE = 8  # a part is at most so many cells wide
MERGES = 4  # 2^4 cells are more than a part is wide
PORTION = 1 << 15  # edges that are worked on at a time
SLACK = 1e-9  # degrees by which a clipped edge is lengthened, against rounding

RINGS = "array<array<array<double>>>"
PARTS = f"array<struct<dim:int,rings:{RINGS}>>"
EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"


def _part(dim: int, rings: Column) -> Column:
    return F.struct(F.lit(dim).alias("dim"), rings.cast(RINGS).alias("rings"))


def _simple_parts(v: Column) -> Column:
    """Parts of a geometry that is no collection; null for anything else."""
    kind = F.try_variant_get(v, "$.type", "string")

    def at(depth: int) -> Column:
        return F.try_variant_get(v, "$.coordinates", "array<" * depth + "double" + ">" * depth)

    none = F.array().cast(PARTS)
    point = F.when(F.size(at(1)) == 0, none).when(at(1).isNotNull(), F.array(_part(0, F.array(F.array(at(1))))))
    return (
        F.when(kind == "Point", point)
        .when((kind == "MultiPoint") & at(2).isNotNull(), F.array(_part(0, F.array(at(2)))))
        .when((kind == "LineString") & at(2).isNotNull(), F.array(_part(1, F.array(at(2)))))
        .when(kind == "MultiLineString", F.transform(at(3), lambda line: _part(1, F.array(line))))
        .when((kind == "Polygon") & at(3).isNotNull(), F.array(_part(2, at(3))))
        .when(kind == "MultiPolygon", F.transform(at(4), lambda rings: _part(2, rings)))
    )


def _good(part: Column) -> Column:
    def on_globe(p: Column) -> Column:
        return (F.size(p) >= 2) & p[0].between(-180, 180) & p[1].between(-90, 90)

    rings = part["rings"]
    closed = F.forall(rings, lambda r: (F.size(r) >= 4) & (F.element_at(r, 1) == F.element_at(r, -1)))
    shaped = (part["dim"] == 0) | ((part["dim"] == 1) & (F.size(rings[0]) >= 2)) | ((part["dim"] == 2) & closed)
    return F.coalesce(F.forall(rings, lambda r: F.forall(r, on_globe)) & shaped, F.lit(False))


def _parts(v: Column) -> Column:
    """Parts with coordinates of any geometry; null for what is none."""
    members = F.try_variant_get(v, "$.geometries", "array<variant>")
    several = F.transform(members, _simple_parts)
    collected = F.when(F.forall(several, lambda p: p.isNotNull()), F.flatten(several))
    parts = F.when(F.try_variant_get(v, "$.type", "string") == "GeometryCollection", collected).otherwise(_simple_parts(v))
    return F.filter(parts, lambda p: (F.size(p["rings"]) > 0) & (F.size(p["rings"][0]) > 0))


def is_geometry(v: Column) -> Column:
    """Whether a value is a GeoJSON geometry, an empty one included."""
    return F.coalesce(F.forall(_parts(v), _good), F.lit(False))


def geometry_parts(v: Column, dotted: str, strict: bool = True) -> Column:
    """The parts of a GeoJSON value; none for null, empty geometries and, unless ``strict``, for what is no geometry."""
    filled, none = _parts(v), F.array().cast(PARTS)
    wrong = F.raise_error(F.lit(f"value at '{dotted}' is not a GeoJSON geometry")).cast(PARTS) if strict else none
    return (
        F.when(v.isNull() | F.is_variant_null(v), none)
        .when(F.coalesce(F.forall(filled, _good), F.lit(False)), filled).otherwise(wrong)
    )


def _edge(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    short = F.when(x2 - x1 > 180, x2 - 360).when(x2 - x1 < -180, x2 + 360).otherwise(x2)
    return F.struct(x1.alias("x1"), y1.alias("y1"), short.alias("x2"), y2.alias("y2"))


def _edges(part: Column) -> Column:
    def along(ring: Column) -> Column:
        n = F.size(ring)
        pairs = F.arrays_zip(F.slice(ring, 1, n - 1).alias("a"), F.slice(ring, 2, n - 1).alias("b"))
        return F.transform(pairs, lambda p: _edge(p["a"][0], p["a"][1], p["b"][0], p["b"][1]))

    def alone(ring: Column) -> Column:
        return F.transform(ring, lambda p: _edge(p[0], p[1], p[0], p[1]))

    return F.flatten(F.transform(part["rings"], lambda r: F.when(part["dim"] == 0, alone(r)).otherwise(along(r))))


def _ends(edges: Column, axis: str, frame: int) -> Column:
    """All x or y of the edges; in frame 1 edges of the west are moved behind the date line."""
    if axis == "y":
        return F.concat(F.transform(edges, lambda e: e["y1"]), F.transform(edges, lambda e: e["y2"]))

    def moved(e: Column, name: str) -> Column:
        return F.when(e["x1"] < 0, e[name] + 360).otherwise(e[name]) if frame else e[name]

    return F.concat(F.transform(edges, lambda e: moved(e, "x1")), F.transform(edges, lambda e: moved(e, "x2")))


def shapes(df: DataFrame, dotted: str, strict: bool = True) -> DataFrame:
    """One row per part of the geometry at a path: ``id, part, dim, edges, west, east, south, north``.

    ``west`` to ``east`` is the narrower of the two ways to see the part; across the date line ``east`` is beyond 180.
    """
    values = df.select("id", field(F.col("data"), dotted).alias("v"))
    # Through generators, which nothing is pushed below: the document is parsed once
    placed = values.select("id", F.posexplode_outer(geometry_parts(F.col("v"), dotted, strict)).alias("part", "p"))
    return _boxed(placed.filter("p IS NOT NULL").select("id", "part", F.col("p.dim").alias("dim"), _edges(F.col("p")).alias("edges")))


def _boxed(parts: DataFrame) -> DataFrame:
    edges = F.col("edges")
    bounds = {f"{side}{frame}": f(_ends(edges, "x", frame)) for frame in (0, 1) for side, f in (("lo", F.array_min), ("hi", F.array_max))}
    whole = parts.withColumns(bounds | {"south": F.array_min(_ends(edges, "y", 0)), "north": F.array_max(_ends(edges, "y", 0))})
    plain = F.col("hi0") - F.col("lo0") <= F.col("hi1") - F.col("lo1")
    return whole.withColumns({
        "west": F.when(plain, F.col("lo0")).otherwise(F.col("lo1")), "east": F.when(plain, F.col("hi0")).otherwise(F.col("hi1")),
    }).drop(*bounds)


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of numbers of up to 32 bits, with a gap behind each."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << shift)) & mask
    return x


def z_code(column: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Places of cells along the Z curve of their level."""
    return _spread(column) | (_spread(row) << 1)


def _row(y: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.minimum(np.maximum(np.floor((y + 90) / 180 * n), 0), n - 1).astype(np.int64)


def _column(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.floor((x + 180) / 360 * n).astype(np.int64)


def _runs(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(i, x)`` for every number ``x`` from ``first[i]`` to ``last[i]``."""
    counts = last - first + 1
    i = np.repeat(np.arange(len(first)), counts)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(counts) - counts, counts) + first[i]


def _height(e: dict, i: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Where edges ``i``, none of them upright, are at ``x``."""
    return e["y1"][i] + (x - e["x1"][i]) * (e["y2"][i] - e["y1"][i]) / (e["x2"][i] - e["x1"][i])


def _touched(e: dict, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(edge, code)`` of the cells that edges touch, each on the ``n`` by ``n`` grid of its part."""
    left, right = np.minimum(e["x1"], e["x2"]), np.maximum(e["x1"], e["x2"])
    i, c = _runs(_column(left, n), _column(right, n))
    upright = e["x1"][i] == e["x2"][i]
    with np.errstate(divide="ignore", invalid="ignore"):
        ya = np.where(upright, e["y1"][i], _height(e, i, np.maximum(left[i], c * 360 / n[i] - 180)))
        yb = np.where(upright, e["y2"][i], _height(e, i, np.minimum(right[i], (c + 1) * 360 / n[i] - 180)))
    j, r = _runs(_row(np.minimum(ya, yb) - SLACK, n[i]), _row(np.maximum(ya, yb) + SLACK, n[i]))
    return i[j], z_code(c[j] % n[i][j], r)


def contains(edges: Column, x: Column, y: Column) -> Column:
    """Whether a polygon's edges enclose a point: an odd number of them crosses the meridian above it."""

    def above(e: Column, at: Column) -> Column:
        spans = ((e["x1"] <= at) & (at < e["x2"])) | ((e["x2"] <= at) & (at < e["x1"]))
        return spans & (e["y1"] + (at - e["x1"]) * (e["y2"] - e["y1"]) / (e["x2"] - e["x1"]) > y)

    crossed = F.filter(edges, lambda e: above(e, x) | above(e, x - 360) | above(e, x + 360))
    return F.size(crossed) % 2 == 1


class _Boxes:
    """The cells of the boxes of polygons, counted through in one series; which of them have their middle inside.

    A middle is inside if an odd number of edges crosses the meridian above it, so edges may come in any portions.
    """

    def __init__(self, boxes: dict, n: np.ndarray):
        self.n, self.west, self.south = n, _column(boxes["west"], n), _row(boxes["south"], n)
        self.east, self.wide = _column(boxes["east"], n), _row(boxes["north"], n) - self.south + 1
        counts = (self.east - self.west + 1) * self.wide
        self.first = np.cumsum(counts) - counts
        self.above = np.zeros(counts.sum(), bool)

    def cross(self, e: dict, polygon: np.ndarray) -> None:
        i, c = _runs(self.west[polygon], self.east[polygon])
        p = polygon[i]
        x = np.fmod((c + 0.5) * 360 / self.n[p], 360.0)
        x = np.where(x < 0, np.fmod(x + 360.0, 360.0), x) - 180
        crossed = []
        for at in (x, x - 360, x + 360):
            x1, x2 = e["x1"][i], e["x2"][i]
            hit = np.flatnonzero(((x1 <= at) & (at < x2)) | ((x2 <= at) & (at < x1)))
            q, h = p[hit], _height(e, i[hit], at[hit])
            j, r = _runs(self.south[q], self.south[q] + self.wide[q] - 1)
            over = h[j] > (r + 0.5) * 180 / self.n[q][j] - 90
            k, r = q[j][over], r[over]
            crossed.append(self.first[k] + (c[hit][j][over] - self.west[k]) * self.wide[k] + r - self.south[k])
        self.above ^= np.bincount(np.concatenate(crossed), minlength=len(self.above)) % 2 == 1

    def inside(self) -> tuple[np.ndarray, np.ndarray]:
        """``(polygon, code)`` of the cells that are inside."""
        cell = np.flatnonzero(self.above)
        p = np.searchsorted(self.first, cell, "right") - 1
        at = cell - self.first[p]
        return p, z_code((self.west[p] + at // self.wide[p]) % self.n[p], self.south[p] + at % self.wide[p])


def _ranges(offsets: np.ndarray, edges: dict, dim: np.ndarray, boxes: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(part, lo, hi)``: the ranges of finest cells that cover parts, given one after the other."""
    extent = np.maximum((boxes["east"] - boxes["west"]) / 360, (boxes["north"] - boxes["south"]) / 180)
    level = sum((extent * 2.0**k <= WIDE).astype(np.int64) for k in range(1, LEVELS + 1))
    n = np.int64(1) << level
    areas = np.flatnonzero(dim == 2)
    within = _Boxes({side: x[areas] for side, x in boxes.items()}, n[areas])
    part_of = np.repeat(np.arange(len(dim)), np.diff(offsets))
    cells = []
    for start in range(0, len(part_of), PORTION):
        part, e = part_of[start:start + PORTION], {name: x[start:start + PORTION] for name, x in edges.items()}
        i, code = _touched(e, n[part])
        cells.append(np.unique(part[i] << 2 * LEVELS | code))
        area = np.flatnonzero(dim[part] == 2)
        within.cross({name: x[area] for name, x in e.items()}, np.searchsorted(areas, part[area]))
    p, code = within.inside()
    cells = np.unique(np.concatenate([*cells, areas[p] << 2 * LEVELS | code]))
    lo, hi = cells, cells
    for k in range(1, MERGES + 1):
        first = cells >> 2 * k << 2 * k
        at = np.searchsorted(cells, first)  # of the first itself, or of a later one of its block
        end = at + 4**k - 1
        last = cells[np.minimum(end, len(cells) - 1)]
        # Cells are sorted and distinct: with the first and, as many places on, the last one there, all are
        whole = (cells[at] == first) & (end < len(cells)) & (last == first + 4**k - 1)
        lo, hi = np.where(whole, first, lo), np.where(whole, last, hi)
    block = lo == cells
    part, mask = cells[block] >> 2 * LEVELS, (1 << 2 * LEVELS) - 1
    up = 2 * (LEVELS - level[part])
    return part, (lo[block] & mask) << up, (((hi[block] & mask) + 1) << up) - 1


def _cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = dict(zip(batch.schema.names, batch.columns))
        every = column["edges"].offsets.to_numpy().astype(np.int64)
        start = 0
        while start < len(batch):
            # So many parts that they have about as many edges as one portion, or one with more
            stop = max(start + 1, int(np.searchsorted(every, every[start] + PORTION, "right")) - 1)
            flat = column["edges"].values.slice(every[start], every[stop] - every[start])
            edges = {name: flat.field(name).to_numpy(zero_copy_only=False) for name in ("x1", "y1", "x2", "y2")}
            boxes = {side: column[side].slice(start, stop - start).to_numpy(zero_copy_only=False) for side in ("west", "east", "south", "north")}
            dim = column["dim"].slice(start, stop - start).to_numpy(zero_copy_only=False)
            part, lo, hi = _ranges(every[start:stop + 1] - every[start], edges, dim, boxes)
            rows = pa.array(part + start)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lo), pa.array(hi), column["id"].take(rows), column["part"].take(rows)], ["lo", "hi", "id", "part"]
            )
            start = stop


def covering(parts: DataFrame) -> DataFrame:
    """``lo, hi, id, part``: the ranges of finest cells that cover the parts, ``hi`` included."""
    ship_package(parts.sparkSession)
    schema = StructType([StructField("lo", LongType()), StructField("hi", LongType()), parts.schema["id"], parts.schema["part"]])
    return parts.select("id", "part", "dim", "edges", "west", "east", "south", "north").mapInArrow(_cover, schema)


def spatial_shape_index(parts: DataFrame) -> DataFrame:
    """The covering in code order, each id beside its neighbours in the plane."""
    cells = covering(parts)
    by = ["lo", "hi", "id", "part"]
    return cells.repartitionByRange(*by).sortWithinPartitions(*by)


# --- queries ---------------------------------------------------------------------------


def geometry_query(spark: SparkSession, geojson: str) -> DataFrame:
    """A GeoJSON text as parts to look for."""
    one = spark.range(1).select("id", F.parse_json(F.lit(json.dumps({"q": json.loads(geojson)}))).alias("data"))
    return shapes(one, "q")


def box_query(spark: SparkSession, west: float, south: float, east: float, north: float) -> DataFrame:
    """A box as a part to look for; ``west`` beyond ``east`` runs across the date line."""
    west, south, east, north = (float(x) for x in (west, south, east, north))
    if west > east:
        east += 360
    stops = [west + (east - west) * i / 4 for i in range(5)]  # short edges: none is taken for one across the date line
    corners = [(x, south) for x in stops] + [(x, north) for x in reversed(stops)] + [(west, south)]
    edges = [(*a, *b) for a, b in zip(corners, corners[1:])]
    one = spark.createDataFrame([(0, 0, 2, edges)], f"id long, part int, dim int, edges array<{EDGE}>")
    return _boxed(one).withColumns({"west": F.lit(west), "east": F.lit(east)})


def candidates(index: DataFrame, query: DataFrame) -> DataFrame:
    """``id, part`` of indexed parts that share a cell with the query.

    The covering of one query is a few ranges; they and the cells around them become a filter on ``lo``, which is what the
    index is sorted by, so Parquet reads only those stretches.
    """
    ranges = sorted({(r["lo"], r["hi"]) for r in covering(query).collect()})
    around = {(lo >> 2 * k) << 2 * k for lo, _ in ranges for k in range(LEVELS + 1)}
    inside, meets = F.lit(False), F.lit(False)
    for lo, hi in _joined(ranges):
        inside = inside | F.col("lo").between(lo, hi)
        meets = meets | ((F.col("lo") <= hi) & (F.col("hi") >= lo))
    return index.filter((inside | F.col("lo").isin(sorted(around))) & meets).select("id", "part").distinct()


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in ranges:
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _side(ax: Column, ay: Column, e: Column) -> Column:
    """On which side of an edge's line a point lies: -1, 0 or 1."""
    return F.signum((e["x2"] - e["x1"]) * (ay - e["y1"]) - (e["y2"] - e["y1"]) * (ax - e["x1"]))


def _meet(e: Column, q: Column) -> Column:
    """Whether two edges have a point in common."""
    apart = (
        (F.greatest(e["x1"], e["x2"]) < F.least(q["x1"], q["x2"])) | (F.greatest(q["x1"], q["x2"]) < F.least(e["x1"], e["x2"]))
        | (F.greatest(e["y1"], e["y2"]) < F.least(q["y1"], q["y2"])) | (F.greatest(q["y1"], q["y2"]) < F.least(e["y1"], e["y2"]))
    )
    crossed = (
        (_side(q["x1"], q["y1"], e) * _side(q["x2"], q["y2"], e) <= 0) & (_side(e["x1"], e["y1"], q) * _side(e["x2"], e["y2"], q) <= 0)
    )
    return ~apart & crossed


def intersects(edges: Column, dim: Column, part: dict) -> Column:
    """Whether a part meets the part of a query (``dim``, ``edges``): edges meet, or one polygon holds the other part."""
    text = json.dumps([dict(zip(("x1", "y1", "x2", "y2"), e)) for e in part["edges"]])
    wanted = F.from_json(F.lit(text), f"array<{EDGE}>")

    def moved(q: Column, by: int) -> Column:
        return F.struct((q["x1"] + by).alias("x1"), q["y1"].alias("y1"), (q["x2"] + by).alias("x2"), q["y2"].alias("y2"))

    touching = F.exists(edges, lambda e: F.exists(wanted, lambda q: _meet(e, q) | _meet(e, moved(q, 360)) | _meet(e, moved(q, -360))))
    first = part["edges"][0]
    holds = (dim == 2) & contains(edges, F.lit(_home(first[0])), F.lit(first[1]))
    held = contains(wanted, F.col("edges")[0]["x1"], F.col("edges")[0]["y1"]) if part["dim"] == 2 else F.lit(False)
    return touching | holds | held


def _home(x: float) -> float:
    return (x + 180) % 360 - 180


def intersecting(index: DataFrame, parts: DataFrame, query: DataFrame) -> DataFrame:
    """``id`` of the indexed geometries that meet the query's, exactly: candidates by cells, then by edges."""
    wanted = [r.asDict(recursive=True) for r in query.select("dim", "edges").collect()]  # one query's own geometry
    if not wanted:
        return parts.select("id").limit(0)
    wanted = [{"dim": w["dim"], "edges": [tuple(e.values()) for e in w["edges"]]} for w in wanted]
    found = parts.join(candidates(index, query), ["id", "part"], "left_semi")
    meets = F.lit(False)
    for w in wanted:
        meets = meets | intersects(F.col("edges"), F.col("dim"), w)
    return found.filter(meets).select("id").distinct()
