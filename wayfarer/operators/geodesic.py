"""Zones whose edges are geodesics (great-circle arcs), anywhere on the globe.

Every edge is turned to run eastwards from (x1, y1) to (x2, y2), cut at the
antimeridian, and carries the normal of its great circle; a point lies below the
edge if its unit vector has a negative product with that normal (an orientation
test of three vectors).  Along a meridian an edge is met at most once, so the
index works by columns of the grid: in each column an edge goes to the
cells between its lowest and highest latitude there (the arc's summit included), and
the edges that cross the column's reference meridian give, from south to north, the
intervals inside the zone.  A ring that winds round a pole holds the pole on whose
side of the equator it mostly lies; with the south pole inside, the first interval starts there.

The cell side is 180 / 2^m degrees, so that cell borders meet the antimeridian and
the poles exactly.  Lookups are those of ``spatial`` (``assign_zone``, ``join_zones``):
the path from a cell's reference point follows a parallel, then a meridian.

Zones with longitudes beyond 180 degrees are refused, or clipped to the globe (``off_globe``).

On the boundary are the vertices, the points of meridional edges and those with a product of exactly 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import once
from ..session import checkpoint_dir
from . import spatial

EDGE = "struct<x1:double,y1:double,x2:double,y2:double,nx:double,ny:double,nz:double>"
_PAD = 1e-9  # degrees


def _vector(lon: Column, lat: Column) -> tuple[Column, Column, Column]:
    a, b = F.radians(lon), F.radians(lat)
    return F.cos(b) * F.cos(a), F.cos(b) * F.sin(a), F.sin(b)


def _latitude(e: Column, lon: Column) -> Column:
    """Where the edge's great circle meets a meridian."""
    a = F.radians(lon)
    return F.degrees(F.atan2(-(e["nx"] * F.cos(a) + e["ny"] * F.sin(a)), e["nz"]))


def _turned(e: Column) -> Column:
    """Longitude step of a raw edge, the short way round: in (-180, 180]."""
    d = e["x2"] - e["x1"]
    return F.when(d > 180, d - 360).when(d <= -180, d + 360).otherwise(d)


def _pieces(e: Column) -> Column:
    """A raw edge as eastward pieces inside [-180, 180]; over a pole, as two meridional ones."""
    west = _turned(e) < 0
    east = F.struct(_turned(e).alias("d"), *[F.when(west, e[b]).otherwise(e[a]).alias(a) for a, b in
                                             (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))])

    def normal(e: Column) -> Column:
        a, b = _vector(e["x1"], e["y1"]), _vector(e["x2"], e["y2"])
        return F.struct((a[1] * b[2] - a[2] * b[1]).alias("nx"), (a[2] * b[0] - a[0] * b[2]).alias("ny"), (a[0] * b[1] - a[1] * b[0]).alias("nz"))

    def cut(e: Column, n: Column) -> Column:
        def piece(x1, y1, x2, y2) -> Column:
            return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), *[n[k].alias(k) for k in ("nx", "ny", "nz")])
        pole, seam = F.signum(e["y1"] + e["y2"]) * 90.0, _latitude(n, F.lit(180.0))
        return (F.when(e["d"] == 180, F.array(piece(e["x1"], e["y1"], e["x1"], pole), piece(e["x2"], pole, e["x2"], e["y2"])))
                .when(e["x1"] > e["x2"], F.array(piece(e["x1"], e["y1"], F.lit(180.0), seam), piece(F.lit(-180.0), seam, e["x2"], e["y2"])))
                .otherwise(F.array(piece(e["x1"], e["y1"], e["x2"], e["y2"]))))
    return once(east, lambda e: once(normal(e), lambda n: cut(e, n)))


def _holds_south_pole(rings: Column) -> Column:
    """Whether an odd number of rings (arrays of raw edges) hold the south pole."""
    def south(ring):
        turned = F.aggregate(ring, F.lit(0.0), lambda s, e: s + _turned(e))
        lean = F.aggregate(ring, F.lit(0.0), lambda s, e: s + F.abs(_turned(e)) * (F.sin(F.radians(e["y1"])) + F.sin(F.radians(e["y2"]))))
        return ((F.abs(turned) > 180) & (lean < 0)).cast("int")
    return F.aggregate(F.transform(rings, south), F.lit(0), lambda n, s: n + s) % 2 == 1


def _north(e: Column, x: Column, y: Column, v: Column) -> Column:
    """Whether the edge passes north of (x, y), with unit vector ``v``; at its ends the vertex itself decides."""
    return F.when(x == e["x1"], e["y1"] > y).when(x == e["x2"], e["y2"] > y).otherwise(
        e["nx"] * v["x"] + e["ny"] * v["y"] + e["nz"] * v["z"] < 0)


def _steps_cross(e: Column, q: Column) -> Column:
    """Crossings (mod 2) of the edge with the path (px, py) - (rx, py) - (rx, ry) of ``q``."""
    west, east = F.least(q["px"], q["rx"]), F.greatest(q["px"], q["rx"])
    at_p, at_r = _north(e, q["px"], q["py"], q["p"]), _north(e, q["rx"], q["py"], q["r"])
    first = F.when(e["x1"] >= west, e["y1"] > q["py"]).when(q["px"] <= q["rx"], at_p).otherwise(at_r)
    last = F.when(e["x2"] <= east, e["y2"] > q["py"]).when(q["px"] <= q["rx"], at_r).otherwise(at_p)
    along = F.when(e["x1"] == e["x2"], (west < e["x1"]) & (e["x1"] <= east) & ((e["y1"] > q["py"]) != (e["y2"] > q["py"]))).otherwise(
        (F.greatest(e["x1"], west) < F.least(e["x2"], east)) & (first != last))
    up = (e["x1"] <= q["rx"]) & (q["rx"] < e["x2"]) & (at_r != _north(e, q["rx"], q["ry"], q["o"]))
    return along.cast("int") + up.cast("int")


def _on_edge(e: Column, px: Column, py: Column, v: Column) -> Column:
    flat = e["x1"] == e["x2"]
    return ((px == e["x1"]) & (py == e["y1"])) | ((px == e["x2"]) & (py == e["y2"])) | F.when(
        flat, (px == e["x1"]) & py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))).otherwise(
        px.between(e["x1"], e["x2"]) & (e["nx"] * v["x"] + e["ny"] * v["y"] + e["nz"] * v["z"] == 0))


def _located(px: Column, py: Column, cell: float) -> Column:
    """A point (longitude 180 as -180) and its cell's reference point, with the unit vectors of the path between them."""
    def vector(x: Column, y: Column) -> Column:
        return F.struct(*[c.alias(k) for k, c in zip("xyz", _vector(x, y))])
    cx, cy = cell_of(px, py, cell)
    ends = F.struct(F.when(px == 180, F.lit(-180.0)).otherwise(px).alias("px"), py.alias("py"),
                    ((cx + spatial.REF_X) * cell).alias("rx"), ((cy + spatial.REF_Y) * cell).alias("ry"))
    return once(ends, lambda q: F.struct(q["px"].alias("px"), q["py"].alias("py"), q["rx"].alias("rx"), q["ry"].alias("ry"),
                                         vector(q["px"], q["py"]).alias("p"), vector(q["rx"], q["py"]).alias("r"), vector(q["rx"], q["ry"]).alias("o")))


def matches(zs: Column, px: Column, py: Column, cell: float, predicate: str) -> Column:
    """The candidates of a point's cell that hold the point, by the even-odd rule."""
    def holds(z: Column, q: Column) -> Column:
        odd = F.aggregate(z["edges"], F.lit(0), lambda n, e: n + F.coalesce(_steps_cross(e, q), F.lit(0))) % 2 == 1
        inside = z["inside"] != odd
        edge = F.exists(z["edges"], lambda e: _on_edge(e, q["px"], q["py"], q["p"])
                        | ((q["px"] == -180) & _on_edge(e, F.lit(180.0), q["py"], q["p"])))
        return F.when(F.size(z["edges"]) == 0, z["inside"]).otherwise(inside | edge if predicate == "intersects" else inside & ~edge)
    return once(_located(px, py, cell), lambda q: F.filter(zs, lambda z: holds(z, q)))


def cell_of(lon: Column, lat: Column, cell: float) -> tuple[Column, Column]:
    """Grid cell of a point; longitude 180 is -180, the north pole belongs to the last row."""
    top = round(90 / cell) - 1
    return (F.floor(F.when(lon == 180, F.lit(-180.0)).otherwise(lon) / cell),
            F.least(F.floor(lat / cell), F.lit(top).cast("long")))


def build_geodesic_index(zones: DataFrame, id_col: str, attrs=(), geometry_col: str = "geometry", cell_size: float | str = "auto",
                         max_broadcast_bytes: int | None = None, materialize: bool = False, off_globe: str = "raise") -> spatial.ZoneIndex:
    """Grid index of ``zones`` with geodesic edges, for ``spatial.assign_zone`` and ``spatial.join_zones``.

    Vertices must be on the globe (|lon| <= 180, |lat| <= 90) and no edge may join
    antipodes; the job fails otherwise.  ``cell_size`` is rounded down to 180 / 2^m.
    ``off_globe="clip"``: what lies beyond 180 degrees of longitude holds no point, as in the planar
    index; the rest of the zone stands.  Latitudes beyond 90 degrees fail the job in any case.
    """
    if off_globe not in ("raise", "clip"):
        raise ValueError(f"off_globe must be 'raise' or 'clip', not {off_globe!r}")
    attrs = [id_col, *[a for a in attrs if a != id_col]]
    zones = spatial.spread(zones)
    rings = F.transform(F.col(geometry_col), lambda r: spatial.checked_edges(F.array(r)))
    z = (zones.select(*attrs, rings.alias("_r")).withColumn("_south", _holds_south_pole(F.col("_r")))
         .withColumn("_e", F.flatten(F.transform(F.flatten("_r"), _pieces))).drop("_r"))
    far = lambda e: (F.abs(e["x1"]) > 180) | (F.abs(e["x2"]) > 180) if off_globe == "raise" else F.lit(False)
    wrong = lambda e: (far(e) | (F.abs(e["y1"]) > 90) | (F.abs(e["y2"]) > 90)
                       | ((e["x1"] == e["x2"]) & (e["y1"] == e["y2"]) & (F.abs(e["y1"]) == 0) & (F.abs(e["nx"]) > 0)))
    z = z.withColumn("_e", F.when(F.exists("_e", wrong), F.raise_error(F.concat(
        F.lit("zone off the globe or with antipodal vertices: "), F.col(id_col).cast("string")))).otherwise(F.col("_e")))
    if off_globe == "clip":     # edges are cut at the border columns below
        z = z.withColumn("_e", F.filter("_e", lambda e: (e["x1"] <= 180) & (e["x2"] >= -180)))
    if materialize:
        checkpoint_dir(zones.sparkSession)
        z = z.checkpoint(eager=True)
    z = z.where(F.size("_e") > 0)   # behind the checkpoint: before it, Spark moves it to the few tasks that read the file
    if cell_size == "auto":
        def ends(side: str, keep) -> Column:
            return F.transform(F.filter("_e", keep), lambda e: e[side])
        # a zone over the antimeridian reaches from its westernmost eastern longitude on to its easternmost western one
        over = F.array_contains(ends("x2", lambda e: F.lit(True)), 180.0) & F.array_contains(ends("x1", lambda e: F.lit(True)), -180.0)
        wide = F.coalesce(F.array_max(ends("x2", lambda e: e["x2"] <= 0)), F.lit(0.0)) - F.coalesce(
            F.array_min(ends("x1", lambda e: e["x1"] >= 0)), F.lit(0.0)) + 360
        cell_size = spatial._auto_cell_size(z.select(
            F.when(over, F.lit(0.0)).otherwise(F.array_min(F.transform("_e", lambda e: e["x1"]))).alias("_minx"),
            F.when(over, wide).otherwise(F.array_max(F.transform("_e", lambda e: e["x2"]))).alias("_maxx"),
            F.array_min(F.transform("_e", lambda e: F.least(e["y1"], e["y2"]))).alias("_miny"),
            F.array_max(F.transform("_e", lambda e: F.greatest(e["y1"], e["y2"]))).alias("_maxy")))
    level = max(1, math.ceil(math.log2(180 / float(cell_size))))
    G, last_col, last_row = 180 / 2 ** level, 2 ** level - 1, 2 ** (level - 1) - 1

    zone = ["_z", "_south", *attrs]
    edges = z.withColumn("_z", F.monotonically_increasing_id()).select(*zone, F.explode("_e").alias("e"))
    e = F.col("e")
    columns = F.sequence(F.greatest(F.floor((e["x1"] - _PAD) / G), F.lit(-last_col - 1).cast("long")),
                         F.least(F.floor((e["x2"] + _PAD) / G), F.lit(last_col).cast("long")))
    parts = edges.withColumn("cx", F.explode(columns))
    flat = e["x1"] == e["x2"]
    left, right = F.greatest(e["x1"], F.col("cx") * G - _PAD), F.least(e["x2"], (F.col("cx") + 1) * G + _PAD)
    at_left = F.when(flat | (left <= e["x1"]), e["y1"]).otherwise(_latitude(e, left))
    at_right = F.when(flat | (right >= e["x2"]), e["y2"]).otherwise(_latitude(e, right))
    summit = F.degrees(F.atan2(F.sqrt(e["nx"] * e["nx"] + e["ny"] * e["ny"]), e["nz"]))
    lowest = F.degrees(F.atan2(e["ny"], e["nx"]))     # longitude of the circle's lowest point
    highest = F.when(lowest > 0, lowest - 180).otherwise(lowest + 180)
    low = F.when(~flat & lowest.between(left, right), -summit).otherwise(F.least(at_left, at_right))
    high = F.when(~flat & highest.between(left, right), summit).otherwise(F.greatest(at_left, at_right))
    ref_x = (F.col("cx") + spatial.REF_X) * G
    row = lambda y: F.least(F.greatest(F.floor(y / G), F.lit(-last_row - 1).cast("long")), F.lit(last_row).cast("long"))
    parts = parts.select(*zone, "cx", F.struct(e.alias("e"), row(low - _PAD).alias("from"), row(high + _PAD).alias("to")).alias("part"),
                         F.when((e["x1"] <= ref_x) & (ref_x < e["x2"]), _latitude(e, ref_x)).alias("y"))
    by_column = parts.groupBy(*zone, "cx").agg(F.collect_list("part").alias("parts"), F.sort_array(F.collect_list("y")).alias("ys"))
    by_column = by_column.withColumn("ys", F.concat(F.when(F.col("_south"), F.array(F.lit(-91.0))).otherwise(F.array().cast("array<double>")), "ys"))
    by_column = by_column.withColumn("ys", F.when(F.size("ys") % 2 == 1, F.concat("ys", F.array(F.lit(91.0)))).otherwise(F.col("ys")))

    touched = F.flatten(F.transform("parts", lambda p: F.transform(F.sequence(p["from"], p["to"]), lambda c: F.struct(
        c.alias("cy"), p["e"].alias("e")))))
    spans = F.filter(F.arrays_zip(F.col("ys").alias("a"), F.slice("ys", 2, F.size("ys")).alias("b")), lambda s: s["b"].isNotNull())
    inner = F.flatten(F.transform(
        F.filter(spans, lambda s, i: i % 2 == 0),
        lambda s: F.transform(F.filter(F.sequence(row(s["a"]), row(s["b"])), lambda c: (
            ((c + spatial.REF_Y) * G >= s["a"]) & ((c + spatial.REF_Y) * G < s["b"]))),
            lambda c: F.struct(c.alias("cy"), F.lit(None).cast(EDGE).alias("e")))))
    cells = (by_column.select(*zone, "cx", F.explode(F.concat(touched, inner)).alias("c"))
             .groupBy(*zone, "cx", F.col("c.cy").alias("cy"))
             .agg(F.collect_list("c.e").alias("edges"), F.max(F.col("c.e").isNull()).alias("inside")))
    return spatial.finish_index(zones, cells, attrs, G, max_broadcast_bytes, materialize, edge_bytes=80, geodesic=True)
