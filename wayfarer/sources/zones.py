"""Zone polygon sources.

Zones carry ``CO_TAZID``, ``CO_FIPS``, ``SUBAREAID`` and a ``geometry`` column
of rings (``array<array<struct<lon,lat>>>``).  Zone tables hold rings as such,
GeoJSON text (Polygon, MultiPolygon, or a Feature with one of them), WKT text
(POLYGON, MULTIPOLYGON), or eight vertex columns of a quadrilateral (the test zones).
``zone_problems`` lists what is wrong with a zone table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import once
from ..operators.geodesic import build_geodesic_index
from ..operators.spatial import DEFAULT_CELL_SIZE, ZoneIndex, build_zone_index, edges_of, quad_geometry
from . import fixtures

ZONE_ATTRS = ["CO_TAZID", "CO_FIPS", "SUBAREAID"]


def zones_from_quads(df: DataFrame) -> DataFrame:
    return df.select(*ZONE_ATTRS, quad_geometry("x0", "y0", "x1", "y1", "x2", "y2", "x3", "y3").alias("geometry"))


def rings_from_geojson(text: Column) -> Column:
    """Rings of a GeoJSON polygon or multipolygon, holes included; NULL for other or broken text."""
    kind = F.get_json_object(text, "$.type")
    geometry = F.when(kind == "Feature", F.get_json_object(text, "$.geometry")).otherwise(text)
    kind = F.get_json_object(geometry, "$.type")
    one = F.from_json(geometry, "coordinates array<array<array<double>>>")["coordinates"]
    many = F.from_json(geometry, "coordinates array<array<array<array<double>>>>")["coordinates"]
    rings = F.when(kind == "Polygon", one).when(kind == "MultiPolygon", F.flatten(many))
    return F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(
        F.get(p, 0).alias("lon"), F.get(p, 1).alias("lat"))))


def rings_from_wkt(text: Column) -> Column:
    """Rings of a WKT polygon or multipolygon, holes included; NULL for other or broken text.

    An SRID in front and further coordinates (``Z``, ``M``, ``ZM``) are read over;
    EMPTY has no rings.  The brackets are checked on a skeleton of the text, the
    numbers by casting, so nothing recurses however long a ring is.
    """
    clean = F.trim(F.regexp_replace(F.regexp_replace(text, r"^\s*(?i:SRID\s*=\s*\d+\s*;)", ""), r"\s+", " "))
    return once(clean, lambda clean: once(F.struct(
        F.upper(F.regexp_extract(clean, r"^([A-Za-z]+) ?(?i:ZM|Z|M)? ?(?:\(|(?i:EMPTY)$)", 1)).alias("kind"),
        F.upper(clean).endswith("EMPTY").alias("empty"),
        F.regexp_replace(F.regexp_replace(clean, r"^[A-Za-z ]+", ""), r" ?([(),]) ?", "$1").alias("body")), _wkt_rings))


def _wkt_rings(t: Column) -> Column:
    def brackets_fit(shape: Column) -> Column:
        rings, opened, closed = (F.length(F.regexp_replace(shape, f"[^{c}]", "")) for c in ("r", "(", ")"))
        polygon = shape == F.concat(F.lit("("), F.array_join(F.array_repeat(F.lit("r"), rings), ","), F.lit(")"))
        # no two brackets or rings without a comma between them, no comma beside an opening or closing one
        multi = (~shape.rlike(r"rr|r\(|\)\(|\)r|,,|\(,|,\)|\(\)|^\([^(]|[^)]\)$|\),r|r,\(|\(\(\(|\)\)\)")
                 & shape.startswith("((") & shape.endswith("))") & (opened == closed))
        return ((t["kind"] == "POLYGON") & polygon) | ((t["kind"] == "MULTIPOLYGON") & multi)

    def numbers(ring: Column) -> Column:
        return F.transform(F.split(ring, ","), lambda p: F.transform(F.split(p, " "), lambda v: F.when(
            v.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"), v.cast("double"))))

    shape = F.regexp_replace(F.regexp_replace(t["body"], r"[^(),]", ""), r"\(,*+\)", "r")
    rings = F.transform(F.split(F.regexp_replace(F.regexp_replace(t["body"], r"\)+,\(+", ";"), r"[()]", ""), ";"), numbers)
    sound = lambda p: F.size(p).between(2, 4) & F.forall(p, lambda v: v.isNotNull())
    read = once(rings, lambda rings: F.when(F.forall(rings, lambda r: F.forall(r, sound)), F.transform(rings, lambda r: F.transform(
        r, lambda p: F.struct(F.get(p, 0).alias("lon"), F.get(p, 1).alias("lat"))))))
    none = F.array().cast("array<array<struct<lon:double,lat:double>>>")
    return (F.when(t["empty"] & t["kind"].isin("POLYGON", "MULTIPOLYGON"), none)
            .when(~t["empty"] & once(shape, brackets_fit), read))


def rings_from_text(text: Column) -> Column:
    """Rings of GeoJSON or WKT."""
    return F.when(F.ltrim(text).startswith("{"), rings_from_geojson(text)).otherwise(rings_from_wkt(text))


def with_rings(df: DataFrame) -> DataFrame:
    """A zone table in any of the four forms with its ``geometry`` as rings."""
    if "geometry" not in df.columns:
        return zones_from_quads(df)
    if dict(df.dtypes)["geometry"] == "string":
        return df.withColumn("geometry", rings_from_text(F.col("geometry")))
    return df


#: Problems that keep a zone from having a shape; the others (repeated vertices) do no harm.
FATAL = ("no geometry", "vertex without a number", "vertex off the globe", "fewer than three vertices", "edges cross")


def zone_problems(zones: DataFrame, id_col: str = "CO_TAZID", geometry_col: str = "geometry") -> DataFrame:
    """(id, ring, problem, n): what is wrong with the zones of a table with rings; ``ring`` counts from 0, null for the whole zone.

    Checks: no geometry; a NULL or NaN vertex; one off the globe (|lon| > 180 or |lat| > 90); fewer than three
    distinct vertices; a vertex repeated by its successor; two edges of a zone that cross inside both (found on
    a grid of the edges' median extent: only edges of one zone that meet in a cell are compared).  Rings
    that lack their closing vertex are in order, as every reader closes them.
    """
    z = zones.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{geometry_col}`").alias("rings")).withColumn("zone", F.monotonically_increasing_id())
    none = z.where(F.col("rings").isNull() | (F.size("rings") == 0)).select("id", F.lit(None).cast("int").alias("ring"), F.lit("no geometry").alias("problem"), F.lit(1).cast("long").alias("n"))
    rings = z.select("id", "zone", F.posexplode("rings").alias("ring", "points"))
    vague = lambda p: p.isNull() | p["lon"].isNull() | p["lat"].isNull() | F.isnan(p["lon"]) | F.isnan(p["lat"])
    good = F.filter("points", lambda p: ~vague(p))
    following = F.arrays_zip(F.slice("points", 1, F.greatest(F.size("points") - 1, F.lit(0))).alias("a"), F.slice("points", 2, F.size("points")).alias("b"))
    found = F.array(*[F.struct(F.lit(name).alias("problem"), n.cast("long").alias("n")) for name, n in (
        ("vertex without a number", F.size(F.filter("points", vague))),
        ("vertex off the globe", F.size(F.filter(good, lambda p: (F.abs(p["lon"]) > 180) | (F.abs(p["lat"]) > 90)))),
        ("fewer than three vertices", (F.size(F.array_distinct(good)) < 3).cast("int")),
        ("repeated vertex", F.size(F.filter(following, lambda p: p["a"] == p["b"]))))])
    listed = rings.select("id", "ring", F.explode(F.filter(found, lambda f: f["n"] > 0)).alias("f")).select("id", "ring", "f.*")

    edges = rings.select("id", "zone", "ring", F.posexplode(edges_of(F.array(F.filter("points", lambda p: ~vague(p))))).alias("i", "e"))
    edges = edges.where("e.x1 <> e.x2 or e.y1 <> e.y2")
    extent = F.greatest(F.abs(F.col("e.x1") - F.col("e.x2")), F.abs(F.col("e.y1") - F.col("e.y2")))
    side = edges.agg(F.percentile_approx(extent, 0.5)).first()[0] or 1.0
    span = lambda a, b: F.explode(F.sequence(F.floor(F.least(a, b) / side), F.floor(F.greatest(a, b) / side)))
    placed = edges.withColumn("cx", span(F.col("e.x1"), F.col("e.x2"))).withColumn("cy", span(F.col("e.y1"), F.col("e.y2")))
    a, b = (placed.select("zone", "cx", "cy", F.struct("ring", "i").alias(f"{k}k"), F.col("e").alias(k), *more) for k, more in (("a", ["id", "ring"]), ("b", [])))

    def side_of(e: str, x: str, y: str) -> Column:
        return F.signum((F.col(f"{e}.x2") - F.col(f"{e}.x1")) * (F.col(y) - F.col(f"{e}.y1")) - (F.col(f"{e}.y2") - F.col(f"{e}.y1")) * (F.col(x) - F.col(f"{e}.x1")))
    crossing = ((side_of("a", "b.x1", "b.y1") * side_of("a", "b.x2", "b.y2") < 0) & (side_of("b", "a.x1", "a.y1") * side_of("b", "a.x2", "a.y2") < 0))
    pairs = a.join(b, ["zone", "cx", "cy"]).where((F.col("ak") < F.col("bk")) & crossing).select("id", "zone", "ring", "ak", "bk").distinct()
    crossed = pairs.groupBy("zone", "id", "ring").agg(F.count("*").alias("n")).select("id", "ring", F.lit("edges cross").alias("problem"), "n")
    return none.unionByName(listed).unionByName(crossed)


def check_zones(zones: DataFrame, id_col: str = "CO_TAZID", geometry_col: str = "geometry") -> DataFrame:
    """``zones`` unchanged, or a ValueError that names the first ten zones with a fatal problem."""
    bad = zone_problems(zones, id_col, geometry_col).where(F.col("problem").isin(*FATAL)).orderBy("id", "ring", "problem").limit(10).collect()
    if bad:
        raise ValueError("zones without a proper shape: " + "; ".join(f"{r.id}: {r.problem}" for r in bad))
    return zones


def load_zones(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Zone table ``taz_v3`` / ``taz_v4`` with a ring geometry."""
    return zones_from_quads(fixtures.load(spark, sf_dir, name))


def zone_index(zones: DataFrame, cell_size: float | str = DEFAULT_CELL_SIZE, materialize: bool = False, geodesic: bool = False,
               off_globe: str = "raise") -> ZoneIndex:
    """Index of a zone table; ``geodesic``: edges are great-circle arcs instead of segments in the plane of degrees.

    ``off_globe``: what ``build_geodesic_index`` does with longitudes beyond 180 degrees (planar zones may have any).
    """
    if geodesic:
        return build_geodesic_index(zones, "CO_TAZID", ZONE_ATTRS, "geometry", cell_size=cell_size, materialize=materialize, off_globe=off_globe)
    return build_zone_index(zones, "CO_TAZID", ZONE_ATTRS, "geometry", cell_size=cell_size, materialize=materialize)
