"""Point-in-zone joins without a nested-loop join.

Zones are polygons stored as rings: ``array<array<struct<lon:double,lat:double>>>``
(all rings of a zone together; the even-odd rule handles holes and multiple
parts).  Edges are planar segments between consecutive vertices.

Index (built per zone table, on Spark, edge by edge):

* the plane is cut into square grid cells of side ``G``; every edge goes to the
  rows of cells it meets, and inside a row to the cells it touches, so a zone
  with very many vertices is spread over rows, and no task tests a zone's cells
  against all of its edges;
* in every row of a zone the edges that cross the row's reference line give, in
  order of x, the intervals inside the zone: the cells whose reference point
  lies in one are marked inside (parity of the reference point);
* pairs are grouped per cell: ``(cx, cy, zones: array<struct<...>>)``, each zone
  with the parity of the cell's reference point and the edges that touch the
  cell (none: the whole cell is inside, and needs no test at lookup time).

Lookup is row-local: each point computes its cell, one equi-join (left outer)
attaches the cell's candidate list, and higher-order functions run the
even-odd / on-edge test: from the reference point to the point, along one
vertical and one horizontal step, each crossing of an edge flips the parity.  The point table is never shuffled when the cell
table is broadcast; the broadcast happens only after its size has been
measured against a limit.  Beyond the limit the cells that hold no point are left
out and the rest is measured (``ZoneIndex.near``), and the zones near points get a
grid of their own, as fine as the limit allows, if that of all zones is coarser; if
neither fits, the join is a shuffled one on (cx, cy), with hot cells salted, and Spark's own estimate never turns
it into a broadcast.

Predicates: ``intersects`` = inside or on an edge; ``within`` = inside and not
on an edge.  Points with a NULL, NaN or out-of-range coordinate match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

DEFAULT_CELL_SIZE = "auto"
CELLS_PER_ZONE_SIDE = 8          # auto: cell side = median zone extent / this
MAX_CELLS = 4_000_000            # auto: coarsen until zones span at most this many cells beyond their first,
CELLS_PER_ZONE = 2               # or this many a zone (a fixed number alone would crowd the cells of very many zones)
BYTES_PER_CELL = 256             # about what a zone takes in a cell: a grid for a broadcast has at most limit / this cells
REF_X, REF_Y = 0.5137, 0.4871    # reference point of a cell, in units of G (off the middle, where few edges pass)
DEFAULT_MAX_BROADCAST_BYTES = 128 * 1024 * 1024
_CONF_MAX_BROADCAST = "wayfarer.spatial.maxBroadcastBytes"
_SLACK = 1e-9          # padding of rows and cells when edges are clipped, in units of G

_ids = count()


@dataclass
class ZoneIndex:
    cells: DataFrame          # cx, cy, zones, exact, first, _bytes
    cell_size: float
    attrs: list               # attribute names carried per zone (zone id first)
    est_bytes: int
    broadcast: bool
    geodesic: bool = False    # edges are great-circle arcs (see ``geodesic``) instead of planar segments
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES
    reduced: bool = False     # ``near`` has been asked already
    zones: DataFrame | None = None   # _z, attributes and edges (_e) of the zones, if they are stored

    def cell_of(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        if self.geodesic:
            from . import geodesic
            return geodesic.cell_of(lon, lat, self.cell_size)
        return F.floor(lon / self.cell_size), F.floor(lat / self.cell_size)

    def near(self, points: DataFrame, coordinates: Sequence[tuple[str, str]]) -> ZoneIndex:
        """This index for lookups of ``points``: broadcast without the cells that hold none of them, if that fits the limit.

        ``coordinates``: the (lon, lat) columns that are looked up; one pass over them lists their
        cells.  An index that is broadcast anyway, or does not fit even so, is returned whole.
        """
        if self.broadcast or self.reduced:
            return self
        cell = [F.when(_valid(lon, lat), F.struct(*[c.alias(k) for k, c in zip(("cx", "cy"), self.cell_of(F.col(lon), F.col(lat)))]))
                for lon, lat in coordinates]
        checkpoint_dir(points.sparkSession)
        held = points.select(F.explode(F.array(*cell)).alias("c")).where(F.col("c").isNotNull()).select("c.*").distinct().checkpoint(eager=True)
        cells = self.cells.join(held.hint("merge"), ["cx", "cy"], "left_semi")
        est = _measured(cells)
        fits = est <= self.max_broadcast_bytes
        finer = self._finer(held, fits)
        if finer is not None:
            return finer
        if not fits:
            return replace(self, reduced=True)
        return replace(self, cells=cells, est_bytes=est, broadcast=True, reduced=True)

    def _finer(self, held: DataFrame, fits: bool) -> ZoneIndex | None:
        """A broadcast index of the zones whose extent meets the ``held`` cells alone; None if it would not fit,
        or if this index fits without its empty cells and its grid is about as fine.

        The cells of very many zones are coarse, and each of them lists several zones to be
        tested for every point in it, however few of the zones are near any point.
        """
        if self.zones is None:
            return None
        G = self.cell_size
        def span(low: str, high: str) -> Column:
            return F.explode(F.sequence(F.floor(F.col(low) / G - _SLACK), F.floor(F.col(high) / G + _SLACK)))
        at = (_extents(self.zones, "_z").select("_z", "_miny", "_maxy", span("_minx", "_maxx").alias("cx"))
              .select("_z", "cx", span("_miny", "_maxy").alias("cy")))
        ids = at.join(held.hint("merge"), ["cx", "cy"], "left_semi").select("_z").distinct()
        used = self.zones.join(ids.hint("merge"), "_z", "left_semi").checkpoint(eager=True)
        most = self.max_broadcast_bytes // BYTES_PER_CELL
        n = used.count()
        if not n or n > most:
            return None
        side = _auto_cell_size(_extents(used), most)
        if fits and side > 0.75 * G:
            return None
        for _ in range(3):
            finer = finish_index(used, _grid_cells(used, self.attrs, side), self.attrs, side, self.max_broadcast_bytes, True)
            if finer.broadcast:
                return replace(finer, reduced=True)
            side *= 1.5
        return None


def _measured(cells: DataFrame) -> int:
    return int(cells.agg(F.coalesce(F.sum(F.col("_bytes") + 80), F.lit(0))).first()[0])


# ---------------------------------------------------------------- geometry helpers
def quad_geometry(x0, y0, x1, y1, x2, y2, x3, y3) -> Column:
    """One closed ring from four vertex coordinates (test zones)."""
    pts = [(x0, y0), (x1, y1), (x2, y2), (x3, y3), (x0, y0)]
    ring = F.array(*[F.struct(F.col(x).alias("lon"), F.col(y).alias("lat")) for x, y in pts])
    return F.array(ring)


def _closed(ring: Column) -> Column:
    first, last = F.element_at(ring, 1), F.element_at(ring, -1)
    return F.when(first == last, ring).otherwise(F.concat(ring, F.array(first)))


def edges_of(geometry: Column) -> Column:
    """Flatten rings into ``array<struct<x1,y1,x2,y2>>``."""
    def ring_edges(ring):
        # consecutive vertices by zipping the ring with itself, one step on: linear in the ring
        closed = _closed(ring)
        pairs = F.arrays_zip(closed, F.slice(closed, 2, F.size(closed)))
        return F.transform(F.filter(pairs, lambda p: p["1"].isNotNull()), lambda p: F.struct(
            p["0"]["lon"].alias("x1"), p["0"]["lat"].alias("y1"), p["1"]["lon"].alias("x2"), p["1"]["lat"].alias("y2")))
    return F.flatten(F.transform(geometry, ring_edges))


def checked_edges(geometry: Column) -> Column:
    """The edges, or an error where a vertex is NULL or NaN: a zone without it would have another shape."""
    bad = F.exists(geometry, lambda r: F.exists(r, lambda p: p.isNull() | p["lon"].isNull() | p["lat"].isNull()
                                                | F.isnan(p["lon"]) | F.isnan(p["lat"])))
    return F.when(bad, F.raise_error(F.lit("zone with a NULL or NaN vertex (see zones.zone_problems)"))).otherwise(edges_of(geometry))


def _x_at(e, y: Column) -> Column:
    return (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]


def _y_at(e, x: Column) -> Column:
    return (e["y2"] - e["y1"]) * (x - e["x1"]) / F.nullif(e["x2"] - e["x1"], F.lit(0.0)) + e["y1"]


def _steps_cross(e, px: Column, py: Column, rx: Column, ry: Column) -> Column:
    """How often the path (px, py) - (rx, py) - (rx, ry) crosses edge ``e`` (half-open rules)."""
    along = ((e["y1"] > py) != (e["y2"] > py)) & ((px < _x_at(e, py)) != (rx < _x_at(e, py)))
    up = ((e["x1"] > rx) != (e["x2"] > rx)) & ((py < _y_at(e, rx)) != (ry < _y_at(e, rx)))
    return along.cast("int") + up.cast("int")


def _on_edge(e, px: Column, py: Column) -> Column:
    cross = (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])
    return ((cross == 0)
            & px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))


def inside_even_odd(ref_inside: Column, edges: Column, px: Column, py: Column, rx: Column, ry: Column) -> Column:
    """Parity of (px, py), given the parity of the reference point and all edges that touch the cell."""
    odd = F.aggregate(edges, F.lit(0), lambda n, e: n + F.coalesce(_steps_cross(e, px, py, rx, ry), F.lit(0))) % 2 == 1
    return ref_inside != odd


def on_boundary(edges: Column, px: Column, py: Column) -> Column:
    return F.exists(edges, lambda e: _on_edge(e, px, py))


# ---------------------------------------------------------------- index
def _extents(z: DataFrame, *keep: str) -> DataFrame:
    return z.select(
        *keep,
        F.array_min(F.transform("_e", lambda e: F.least(e["x1"], e["x2"]))).alias("_minx"),
        F.array_max(F.transform("_e", lambda e: F.greatest(e["x1"], e["x2"]))).alias("_maxx"),
        F.array_min(F.transform("_e", lambda e: F.least(e["y1"], e["y2"]))).alias("_miny"),
        F.array_max(F.transform("_e", lambda e: F.greatest(e["y1"], e["y2"]))).alias("_maxy"))


def _auto_cell_size(z: DataFrame, most: int | None = None) -> float:
    """Cell side from the zones' own extents (one small aggregate over the zone table).

    About ``CELLS_PER_ZONE_SIDE`` cells across a median zone, so most cells of
    a zone are interior (no edge test); coarsened if the cover would exceed
    ``most`` cells (default: ``MAX_CELLS`` cells and ``CELLS_PER_ZONE`` cells a zone)
    beyond the zones' first ones.
    """
    ext = F.greatest(F.col("_maxx") - F.col("_minx"), F.col("_maxy") - F.col("_miny"))
    row = z.agg(F.percentile_approx(ext, 0.5).alias("med"),
                F.sum((F.col("_maxx") - F.col("_minx")) * (F.col("_maxy") - F.col("_miny"))).alias("area"),
                F.sum(F.col("_maxx") - F.col("_minx") + F.col("_maxy") - F.col("_miny")).alias("perim"),
                F.count("*").alias("n")).first()
    if not row or not row["med"]:
        return 1.0
    G = float(row["med"]) / CELLS_PER_ZONE_SIDE
    # cells ~ area/G^2 + perimeter/G (+ one per zone, whatever G): both terms vanish as G grows
    most = max(MAX_CELLS, CELLS_PER_ZONE * row["n"]) if most is None else max(most - row["n"], row["n"] / 8)
    while row["area"] / G ** 2 + row["perim"] / G > most:
        G *= 1.5
    return G


def _value_bytes(df: DataFrame, c: str) -> Column:
    if dict(df.dtypes)[c] in ("string", "binary"):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    return F.lit(16)


def spread(df: DataFrame) -> DataFrame:
    """``df`` on all cores: the rows of a small file arrive in one task, and what an index makes of them is many times as much."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def build_zone_index(zones: DataFrame, id_col: str, attrs=(), geometry_col: str = "geometry",
                     cell_size: float | str = DEFAULT_CELL_SIZE,
                     max_broadcast_bytes: int | None = None,
                     materialize: bool = False) -> ZoneIndex:
    """Grid index of ``zones``; ``attrs`` are carried to every match.

    Two small jobs measure the zone table (cell size, index bytes) at every
    build, so a replaced table is never judged by an old measurement.
    ``materialize``: store the index with a reliable checkpoint in the
    session's ``spark.checkpoint.dir`` (shared storage on a cluster), for an
    index used by several queries.
    """
    attrs = [id_col, *[a for a in attrs if a != id_col]]
    zones = spread(zones)

    z = zones.select(*[F.col(a) for a in attrs], checked_edges(F.col(geometry_col)).alias("_e"))
    z = z.withColumn("_z", F.monotonically_increasing_id())
    if materialize:
        checkpoint_dir(zones.sparkSession)
        z = z.checkpoint(eager=True)
    z = z.where(F.size("_e") > 0)   # behind the checkpoint: before it, Spark moves it to the few tasks that read the file
    G = float(cell_size) if cell_size != "auto" else _auto_cell_size(_extents(z))
    index = finish_index(zones, _grid_cells(z, attrs, G), attrs, G, max_broadcast_bytes, materialize)
    return replace(index, zones=z) if materialize and cell_size == "auto" else index


def _grid_cells(z: DataFrame, attrs: list, G: float) -> DataFrame:
    """One row per zone and cell of side ``G``, with the edges that touch the cell and its reference point's parity."""
    pad = G * _SLACK

    # edges to rows; per row the part of the edge inside it, and where it crosses the reference line
    zone = ["_z", *attrs]
    edges = z.select(*zone, F.explode("_e").alias("e"))
    low, high = F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2")
    rows = edges.withColumn("cy", F.explode(F.sequence(F.floor((low - pad) / G), F.floor((high + pad) / G))))
    e = F.col("e")

    def x_on(y: Column) -> Column:   # x of the edge at y, y clipped to the edge
        t = (F.least(F.greatest(y, low), high) - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
        return e["x1"] + t * (e["x2"] - e["x1"])

    below, above = x_on(F.col("cy") * G - pad), x_on((F.col("cy") + 1) * G + pad)
    ref_y = (F.col("cy") + REF_Y) * G
    rows = rows.select(*zone, "cy", F.struct(
        e.alias("e"),
        F.floor((F.coalesce(F.least(below, above), F.least(e["x1"], e["x2"])) - pad) / G).alias("from"),
        F.floor((F.coalesce(F.greatest(below, above), F.greatest(e["x1"], e["x2"])) + pad) / G).alias("to")).alias("part"),
        F.when((e["y1"] > ref_y) != (e["y2"] > ref_y), _x_at(e, ref_y)).alias("x"))
    by_row = rows.groupBy(*zone, "cy").agg(F.collect_list("part").alias("parts"), F.sort_array(F.collect_list("x")).alias("xs"))

    edge_type = "struct<x1:double,y1:double,x2:double,y2:double>"
    touched = F.flatten(F.transform("parts", lambda p: F.transform(F.sequence(p["from"], p["to"]), lambda c: F.struct(
        c.alias("cx"), p["e"].alias("e")))))
    spans = F.filter(F.arrays_zip(F.col("xs").alias("a"), F.slice("xs", 2, F.size("xs")).alias("b")),
                     lambda s: s["b"].isNotNull())
    inner = F.flatten(F.transform(
        F.filter(spans, lambda s, i: i % 2 == 0),
        lambda s: F.transform(F.filter(F.sequence(F.floor(s["a"] / G) - 1, F.floor(s["b"] / G) + 1), lambda c: (
            ((c + REF_X) * G >= s["a"]) & ((c + REF_X) * G < s["b"]))),
            lambda c: F.struct(c.alias("cx"), F.lit(None).cast(edge_type).alias("e")))))
    return (by_row.select(*zone, "cy", F.explode(F.concat(touched, inner)).alias("c"))
            .groupBy(*zone, F.col("c.cx").alias("cx"), "cy")
            .agg(F.collect_list("c.e").alias("edges"), F.max(F.col("c.e").isNull()).alias("inside")))


def finish_index(zones: DataFrame, cells: DataFrame, attrs: list, G: float, max_broadcast_bytes: int | None, materialize: bool,
                 edge_bytes: int = 56, geodesic: bool = False) -> ZoneIndex:
    """The index from ``cells``, one row per zone and cell: grouped by cell, and measured."""
    spark = zones.sparkSession
    size = F.lit(40)
    for a in attrs:
        size = size + _value_bytes(zones, a)
    # ``exact``: every candidate covers the whole cell, so any point of the cell
    # is in all of them and the pick is known in advance (``first``)
    index = cells.groupBy("cx", "cy").agg(
        F.collect_list(F.struct(*[F.col(a) for a in attrs], "inside", "edges")).alias("zones"),
        F.bool_and(F.size("edges") == 0).alias("exact"),
        F.min(F.struct(*[F.col(a) for a in attrs])).alias("first"),
        F.sum(size + edge_bytes * F.size("edges")).alias("_bytes"))

    if materialize:
        # one small job: the index is computed once for all later queries
        # (within one query, lookups on one index already share one
        # broadcast: their exchanges are identical and Spark reuses them)
        checkpoint_dir(spark)
        index = index.checkpoint(eager=True)
    if max_broadcast_bytes is None:
        max_broadcast_bytes = int(spark.conf.get(_CONF_MAX_BROADCAST, str(DEFAULT_MAX_BROADCAST_BYTES)))
    # size check: one small aggregate over the zone table
    est = _measured(index)
    return ZoneIndex(index, G, attrs, est, est <= max_broadcast_bytes, geodesic, max_broadcast_bytes)


# ---------------------------------------------------------------- lookups
def _attach_candidates(points: DataFrame, lon: str, lat: str, index: ZoneIndex, tag: str,
                       source: DataFrame | None = None) -> DataFrame:
    """Left join each point's cell candidates as column ``__<tag>_zones``, and the cell's reference point as ``__<tag>_rx``, ``_ry``.

    ``source``: a cheaper table that holds all the same coordinates, to list the
    points' cells and to count dense ones on if the index is too large to broadcast whole.

    The index side is used unchanged (same plan for every lookup on it), so
    several lookups against one zone table share one broadcast.
    """
    reserved = ("__cx", "__cy", "__zones", "__exact", "__first", "__rx", "__ry")
    for c in reserved:
        if c in points.columns:
            raise ValueError(f"reserved column {c} present")
    counted = points if source is None else source
    cells = index.cells.select(F.col("cx").alias("__cx"), F.col("cy").alias("__cy"), F.col("zones").alias("__zones"),
                               F.col("exact").alias("__exact"), F.col("first").alias("__first"),
                               ((F.col("cx") + REF_X) * index.cell_size).alias("__rx"),
                               ((F.col("cy") + REF_Y) * index.cell_size).alias("__ry"))
    ok = _valid(lon, lat)
    cx, cy = index.cell_of(F.col(lon), F.col(lat))
    pts = points.withColumns({"__cx": F.when(ok, cx), "__cy": F.when(ok, cy)})
    if index.broadcast:
        joined = pts.join(F.broadcast(cells), ["__cx", "__cy"], "left")
    else:
        # shuffled on the cell: a dense cell (or a mass of NULL coordinates)
        # would be one task, so such cells are salted (their index rows copied
        # once per salt value) - the same exact salting as the trip match
        from .relational import SaltedKeys
        salt = SaltedKeys.detect(counted.select(F.when(ok, cx).alias("__cx"), F.when(ok, cy).alias("__cy")), ["__cx", "__cy"])
        # the hint keeps Spark from a broadcast by its own estimate, which knows nothing of the exploded cells
        cells = salt.salt_right(cells, "__salt").hint("merge")
        # deterministic per row; all columns, so many trips from one exact spot still spread
        pts = salt.salt_left(pts, F.xxhash64(*[F.col(f"`{c}`") for c in points.columns]), "__salt")
        joined = pts.join(cells, ["__cx", "__cy", "__salt"], "left").drop("__salt")
    return (joined.drop("__cx", "__cy")
            .withColumnsRenamed({"__zones": f"__{tag}_zones", "__exact": f"__{tag}_exact",
                                 "__first": f"__{tag}_first", "__rx": f"__{tag}_rx", "__ry": f"__{tag}_ry"}))


def _valid(lon: str, lat: str) -> Column:
    """A point on the globe: neither NULL nor NaN nor out of range."""
    return ((F.abs(F.col(lon)) <= 180) & (F.abs(F.col(lat)) <= 90)
            & ~F.isnan(F.col(lon).cast("double")) & ~F.isnan(F.col(lat).cast("double")))


def _matches(tag: str, lon: str, lat: str, predicate: str, index: ZoneIndex) -> Column:
    zs, px, py = F.col(f"__{tag}_zones"), F.col(lon), F.col(lat)
    # a column of the index: as an expression of the point it would be computed for every edge anew
    rx, ry = F.col(f"__{tag}_rx"), F.col(f"__{tag}_ry")

    def test(z):
        inside = inside_even_odd(z["inside"], z["edges"], px, py, rx, ry)
        edge = on_boundary(z["edges"], px, py)
        hit = inside | edge if predicate == "intersects" else inside & ~edge
        return F.when(F.size(z["edges"]) == 0, z["inside"]).otherwise(hit)

    if predicate not in ("intersects", "within"):
        raise ValueError(f"unknown predicate {predicate!r}")
    if index.geodesic:
        from . import geodesic
        return geodesic.matches(zs, px, py, index.cell_size, predicate)
    return F.filter(zs, test)


def _check_coordinates(points: DataFrame, lon: str, lat: str, on_bad: str) -> DataFrame:
    """``on_bad="null"``: NaN and out-of-range points match nothing; ``"raise"``: fail the job."""
    if on_bad == "null":
        return points
    if on_bad != "raise":
        raise ValueError(f"on_bad must be 'null' or 'raise', not {on_bad!r}")
    bad = F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~_valid(lon, lat)
    return points.withColumn(lat, F.when(bad, F.raise_error(
        F.concat(F.lit("coordinate out of range: "), F.col(lon).cast("string"), F.lit(", "),
                 F.col(lat).cast("string")))).otherwise(F.col(lat)))


def assign_zone(points: DataFrame, lon: str, lat: str, index: ZoneIndex, outputs: dict,
                predicate: str = "intersects", on_bad: str = "null", id_col: str | None = None,
                source: DataFrame | None = None) -> DataFrame:
    """Add one zone per point: the matching zone with the lowest id.

    ``outputs`` maps index attribute -> output column name.  All outputs come
    from the same zone.  Rows are never added or removed.  ``on_bad``: what a
    point outside |lat| <= 90, |lon| <= 180 does ("null": no zone; "raise").
    ``id_col``: rows whose id is NULL get no zone (a zone belongs to an id;
    ids are unique, which ``run_pipeline`` checks).
    """
    points = _check_coordinates(points, lon, lat, on_bad)
    index = index.near(points if source is None else source, [(lon, lat)])  # its cells may be of another size
    tag = f"z{next(_ids)}"
    zs, exact, first = f"__{tag}_zones", f"__{tag}_exact", f"__{tag}_first"
    df = _attach_candidates(points, lon, lat, index, tag, source)
    picked = f"__{tag}_pick"
    hit = _matches(tag, lon, lat, predicate, index)
    tested = F.array_min(F.transform(hit, lambda z: F.struct(*[z[a].alias(a) for a in index.attrs])))
    # cells wholly inside their candidates skip the per-point test (CASE is lazy)
    pick = F.when(F.col(exact) & F.col(lon).isNotNull() & F.col(lat).isNotNull(), F.col(first)).otherwise(tested)
    if id_col is not None:
        pick = F.when(F.col(id_col).isNotNull(), pick)
    df = df.withColumn(picked, pick).drop(zs, exact, first, f"__{tag}_rx", f"__{tag}_ry")
    return df.withColumns({out: F.col(picked)[a] for a, out in outputs.items()}).drop(picked)


def join_zones(points: DataFrame, lon: str, lat: str, index: ZoneIndex, outputs: dict,
               predicate: str = "within", on_bad: str = "null", source: DataFrame | None = None) -> DataFrame:
    """Left join every matching zone: a point in two zones gives two rows, none gives NULLs."""
    points = _check_coordinates(points, lon, lat, on_bad)
    index = index.near(points if source is None else source, [(lon, lat)])  # its cells may be of another size
    tag = f"z{next(_ids)}"
    zs, exact, first = f"__{tag}_zones", f"__{tag}_exact", f"__{tag}_first"
    df = _attach_candidates(points, lon, lat, index, tag, source)
    one = f"__{tag}_one"
    hit = F.when(F.col(exact), F.col(zs)).otherwise(_matches(tag, lon, lat, predicate, index))
    df = df.withColumn(one, F.explode_outer(F.transform(hit, lambda z: F.struct(*[z[a].alias(a) for a in index.attrs]))))
    return df.drop(zs, exact, first, f"__{tag}_rx", f"__{tag}_ry").withColumns({out: F.col(one)[a] for a, out in outputs.items()}).drop(one)


def one_zone_per_id(points: DataFrame, id_col: str, outputs: list[str]) -> DataFrame:
    """Give all rows of a repeated id one zone: the lowest any of them has, with its other ``outputs`` (the zone id first).

    Rows of unique and NULL ids stay as they are and where they are: only the ids are
    counted (partially before the shuffle), and only repeated ones are
    aggregated and joined back.  A repeated id without any zone keeps none.
    """
    key = F.col(f"`{id_col}`")
    repeated = points.where(key.isNotNull()).groupBy(key.alias("__id")).agg(F.count("*").alias("__n")).where("__n > 1").select("__id")
    if repeated.isEmpty():
        return points
    hit = points.join(repeated, key == F.col("__id"), "left_semi").where(F.col(outputs[0]).isNotNull())
    picks = hit.groupBy(key.alias("__id")).agg(F.min(F.struct(*[F.col(c) for c in outputs])).alias("__pick"))
    joined = points.join(picks, key == F.col("__id"), "left")
    return joined.select(*[(F.when(F.col("__pick").isNotNull(), F.col("__pick")[c]).otherwise(F.col(c)).alias(c)
                            if c in outputs else F.col(f"`{c}`")) for c in points.columns])
