"""Geometry tables and the grid join between points and features.

Features are segment rows: feature_id, part, seq, a_lon, a_lat, b_lon, b_lat (b is NULL for a
single vertex). Points fall into one cell; segments are listed in every cell their padded course
touches, so a point meets a segment at most once and only when it is close.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.functions import geo
from wakeline.functions.text import present
from wakeline.session import cut_lineage

GEOMETRY = "struct<type:string,coordinates:string>"
_PATH = "array<double>"


def geometry_parts(geometry: str) -> Column:
    """GeoJSON geometry text to an array of parts, each an array of [lon, lat]; all six types."""
    kind = F.get_json_object(geometry, "$.type")
    coords = F.get_json_object(geometry, "$.coordinates")
    point = F.array(F.array(F.from_json(coords, _PATH)))
    line = F.array(F.from_json(coords, f"array<{_PATH}>"))
    lines = F.from_json(coords, f"array<array<{_PATH}>>")
    polys = F.flatten(F.from_json(coords, f"array<array<array<{_PATH}>>>"))
    return (F.when(kind == "Point", point).when(kind.isin("MultiPoint", "LineString"), line)
            .when(kind.isin("MultiLineString", "Polygon"), lines).when(kind == "MultiPolygon", polys))


def vertices(features: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Vertex rows (part, seq, lon, lat) of GeoJSON features."""
    out = features.withColumn("geometry_type", F.get_json_object(geometry, "$.type"))
    out = out.select("*", F.posexplode(geometry_parts(geometry)).alias("part", "_p"))
    out = out.select("*", F.posexplode("_p").alias("seq", "_xy"))
    return (out.where(F.size("_xy") >= 2).withColumn("lon", F.col("_xy")[0]).withColumn("lat", F.col("_xy")[1])
            .drop("_p", "_xy"))


def geometry_segments(features: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Segment rows straight from the geometry arrays, without a shuffle."""
    out = features.select("*", F.posexplode(geometry_parts(geometry)).alias("part", "_p")).where(F.size("_p") > 0)
    ends = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("_p") - 2)), lambda i: F.struct(
        F.get("_p", i).alias("a"), F.get("_p", i + 1).alias("b")))
    out = out.select("*", F.posexplode(ends).alias("seq", "_e"))
    return (out.withColumn("a_lon", F.col("_e.a")[0]).withColumn("a_lat", F.col("_e.a")[1])
            .withColumn("b_lon", F.col("_e.b")[0]).withColumn("b_lat", F.col("_e.b")[1]).drop("_p", "_e"))


def segments(verts: DataFrame, feature: str = "feature_id") -> DataFrame:
    """Vertex rows to segment rows; a one-vertex part becomes a point segment."""
    w = Window.partitionBy(feature, "part").orderBy("seq")
    whole = Window.partitionBy(feature, "part")
    out = (verts.withColumn("a_lon", F.col("lon")).withColumn("a_lat", F.col("lat"))
           .withColumn("b_lon", F.lead("lon").over(w)).withColumn("b_lat", F.lead("lat").over(w))
           .withColumn("_n", F.count("*").over(whole)))
    return out.where(F.col("b_lon").isNotNull() | (F.col("_n") == 1)).drop("lon", "lat", "_n")


def extents(verts: DataFrame, feature: str = "feature_id") -> DataFrame:
    return verts.groupBy(feature).agg(F.min("lon").alias("west"), F.min("lat").alias("south"),
                                      F.max("lon").alias("east"), F.max("lat").alias("north"))


def overlaps_box(west: float, south: float, east: float, north: float) -> Column:
    return ~((F.col("east") < west) | (F.col("west") > east) | (F.col("north") < south) | (F.col("south") > north))


def _pads(radius_nm: float) -> tuple[float, Column]:
    """The radius in degrees of latitude and, at a segment's latitude farthest from the equator, of longitude."""
    pad = radius_nm / 60.0 * 1.001 + 1e-9
    worst = F.greatest(F.abs(F.col("a_lat")), F.abs(F.coalesce("b_lat", "a_lat"))) + pad
    return pad, radius_nm / F.greatest(F.lit(10.0), 60.0 * F.cos(F.radians(F.least(F.lit(90.0), worst)))) * 1.001 + 1e-9


def cover_cells(segs: DataFrame, radius_nm: float, size: float) -> DataFrame:
    """Segments listed once per grid cell their radius-padded course touches (``cx``, ``cy``)."""
    b_lon, b_lat = F.coalesce("b_lon", "a_lon"), F.coalesce("b_lat", "a_lat")
    pad, lon_pad = _pads(radius_nm)
    df = (segs.withColumn("_lp", lon_pad).withColumn("_dy", b_lat - F.col("a_lat"))
          .withColumn("_dx", b_lon - F.col("a_lon"))
          .withColumn("cy", F.explode(F.sequence(
              geo.cell(F.least(F.col("a_lat"), b_lat) - pad, size),
              geo.cell(F.greatest(F.col("a_lat"), b_lat) + pad, size)))))
    # The part of the segment that lies in this row of cells (padded), as a t-range.
    low, high = F.col("cy") * size - pad, (F.col("cy") + 1) * size + pad
    flat = F.abs(F.col("_dy")) < 1e-12
    t1 = (low - F.col("a_lat")) / F.nullif(F.col("_dy"), F.lit(0.0))
    t2 = (high - F.col("a_lat")) / F.nullif(F.col("_dy"), F.lit(0.0))
    clamp = lambda t: F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    ta = F.when(flat, 0.0).otherwise(clamp(F.least(t1, t2)))
    tb = F.when(flat, 1.0).otherwise(clamp(F.greatest(t1, t2)))
    xa, xb = F.col("a_lon") + ta * F.col("_dx"), F.col("a_lon") + tb * F.col("_dx")
    return df.withColumn("cx", F.explode(F.sequence(
        geo.cell(F.least(xa, xb) - F.col("_lp"), size),
        geo.cell(F.greatest(xa, xb) + F.col("_lp"), size)))).drop("_lp", "_dy", "_dx")


def shapes(segs: DataFrame, feature: str = "feature_id", carry=()) -> tuple[DataFrame, DataFrame]:
    """(members, lines) of features that are drawn alike: ``members`` has feature, ``carry`` and shape, ``lines`` the
    segments of each shape once. Whatever depends on the course alone is worked out for a shape and then joined with
    its members, so copies of a feature add to the rows that are asked for, not to the work before them."""
    ends = F.sort_array(F.collect_list(F.struct("a_lon", "a_lat", "b_lon", "b_lat"))).alias("_lines")
    drawn = segs.groupBy(feature, *carry).agg(ends).withColumn("shape", F.sha2(F.to_json(F.struct("_lines")), 256))
    lines = drawn.groupBy("shape").agg(F.first("_lines").alias("_lines")).select("shape", F.explode("_lines").alias("_l"))
    return drawn.drop("_lines"), lines.select("shape", "_l.*")


def near_lines(points: DataFrame, segs: DataFrame, radius_nm: float, size: float, point_cols, feature: str = "shape",
               feature_cols=()) -> DataFrame:
    """(point, feature, distance_nm) for every pair within the radius. An equi-join on the cell.

    A crowded cell is a skewed join key whose point side Spark splits; the segment side of a cell
    is limited by how many courses cross it.
    """
    hits = _beside(points, segs, radius_nm, size, [feature, *feature_cols])
    keys = [*point_cols, *dict.fromkeys([feature, *feature_cols])]
    # The radius is applied to the least distance: a filter below the groups would work it out twice, part by part.
    return hits.groupBy(*keys).agg(F.min(_segment_nm()).alias("distance_nm")).where(F.col("distance_nm") <= radius_nm)


def _segment_nm() -> Column:
    return geo.point_segment_nm(F.col("longitude"), F.col("latitude"), F.col("a_lon"), F.col("a_lat"), F.col("b_lon"), F.col("b_lat"))


def _beside(points: DataFrame, segs: DataFrame, radius_nm: float, size: float, carry) -> DataFrame:
    """Points with the segments whose padded box they lie in, joined on the cell: most lines of a cell are ruled out
    without their distance."""
    p = points.withColumn("cx", geo.cell(F.col("longitude"), size)).withColumn("cy", geo.cell(F.col("latitude"), size))
    pad, lon_pad = _pads(radius_nm)
    b_lon, b_lat = F.coalesce("b_lon", "a_lon"), F.coalesce("b_lat", "a_lat")
    box = {"_west": F.least("a_lon", b_lon) - lon_pad, "_east": F.greatest("a_lon", b_lon) + lon_pad,
           "_south": F.least("a_lat", b_lat) - pad, "_north": F.greatest("a_lat", b_lat) + pad}
    s = cover_cells(segs, radius_nm, size).withColumns(box).select(*dict.fromkeys(carry), "a_lon", "a_lat", "b_lon", "b_lat", "cx", "cy", *box)
    return p.join(s, ["cx", "cy"]).where(F.col("latitude").between(F.col("_south"), F.col("_north"))
                                         & F.col("longitude").between(F.col("_west"), F.col("_east"))).drop(*box)


def near_pairs(points: DataFrame, segs: DataFrame, radius_nm: float, size: float, point_cols, feature_cols,
               feature: str = "feature_id", places: int | None = None) -> DataFrame:
    """(point, feature, distance_nm) for every pair within the radius: points meet shapes, and shapes their members.
    With ``places`` distances are rounded, once for a shape."""
    carry = [c for c in dict.fromkeys(feature_cols) if c != feature]
    members, lines = shapes(segs, feature, carry)
    near = near_lines(points, lines, radius_nm, size, point_cols)
    near = near if places is None else near.withColumn("distance_nm", F.round("distance_nm", places))
    return near.join(members, "shape").select(*point_cols, feature, *carry, "distance_nm")


def drawn_once(segs: DataFrame, feature: str, carry=()) -> DataFrame:
    """Each segment once, with the smallest of the features that hold it."""
    first = F.min(F.struct(feature, *carry)).alias("_f")
    return segs.groupBy("a_lon", "a_lat", "b_lon", "b_lat").agg(first).select("_f.*", "a_lon", "a_lat", "b_lon", "b_lat")


def nearest_feature(points: DataFrame, segs: DataFrame, radius_nm: float, size: float, point_id: str,
                    feature: str = "feature_id") -> DataFrame:
    """Per point the nearest feature within the radius."""
    hits = _beside(points, drawn_once(segs, feature), radius_nm, size, [feature])
    best = F.min(F.struct(_segment_nm().alias("distance_nm"), F.col(feature))).alias("_b")
    return hits.groupBy(point_id).agg(best).select(point_id, f"_b.{feature}", "_b.distance_nm").where(F.col("distance_nm") <= radius_nm)


#: Cells of the tree of features: 0.1 degrees at level 0, four times as wide with each level; one cell at TOP.
LEAF_DEGREES, TOP = 0.1, 6
#: Levels from this one up have at most 57 x 29 cells, whatever the data, and may be broadcast.
BOUNDED_LEVEL = 3


def _leaf(value: Column, offset: float) -> Column:
    """Number of the leaf cell along one axis, 0 to 4095."""
    last = 4 ** TOP - 1
    return F.greatest(F.lit(0), F.least(F.lit(last), F.floor((value + offset) / LEAF_DEGREES).cast("int")))


def _up(number: Column, levels: int) -> Column:
    return F.shiftright(number, 2 * levels)


def _box_nm() -> Column:
    """No segment of a node is nearer than this: in the point's local plane its ends lie beyond the nearest edges of the box."""
    gap = F.greatest(F.col("west") - F.col("longitude"), F.col("longitude") - F.col("east"), F.lit(0.0))
    narrowest = F.least(*[F.cos(F.radians((F.col(c) + F.col("latitude")) / 2)) for c in ("south", "north")])
    x = gap * 60.0 * F.greatest(narrowest, F.lit(0.0))
    y = F.greatest(F.col("south") - F.col("latitude"), F.col("latitude") - F.col("north"), F.lit(0.0)) * 60.0
    return F.sqrt(x * x + y * y) * (1 - 1e-9) - 1e-9


def nearest_at_any_distance(points: DataFrame, segs: DataFrame, point_id: str, feature: str = "feature_id",
                            carry: tuple[str, ...] = (), radius_nm: float = 2.0, size: float = 0.1) -> DataFrame:
    """(point_id, feature, ``carry`` columns of the segment, distance_nm): the nearest feature of every point, however far.

    Points with a feature within ``radius_nm`` are answered by the grid. The others go down a tree of cells: a node
    has the extent of its segments, which bounds their distance from below, and one vertex, which bounds it from
    above; nodes beyond a point's least upper bound are left. So a point meets a few nodes a level, wherever it is.
    Equal distances (to 1e-9 nm) go to the smaller feature. Points without a position, or with an id of NULL, give no
    row; points that share an id count as one with several places. Without features there are no rows.
    """
    placed = points.where(geo.valid_position(F.col("latitude"), F.col("longitude")) & F.col(point_id).isNotNull()).select(
        point_id, "latitude", "longitude")
    lines = cut_lineage(drawn_once(segs.where(F.col("a_lon").isNotNull() & F.col("a_lat").isNotNull()).withColumns(
        {"b_lon": F.coalesce("b_lon", "a_lon"), "b_lat": F.coalesce("b_lat", "a_lat")}), feature, carry))
    distance = geo.point_segment_nm(F.col("longitude"), F.col("latitude"), F.col("a_lon"), F.col("a_lat"), F.col("b_lon"), F.col("b_lat"))
    best = F.min(F.struct(F.round("_d", 9).alias("distance_nm"), F.col(feature), *carry)).alias("_b")
    shown = [point_id, f"_b.{feature}", *[f"_b.{c}" for c in carry], "_b.distance_nm"]

    cells = placed.withColumn("cx", geo.cell(F.col("longitude"), size)).withColumn("cy", geo.cell(F.col("latitude"), size))
    close = cut_lineage(cells.join(cover_cells(lines, radius_nm, size), ["cx", "cy"]).withColumn("_d", distance)
                        .where(F.col("_d") <= radius_nm).groupBy(point_id).agg(best))

    leaves = lines.withColumn("ix", _leaf(F.col("a_lon"), 180.0)).withColumn("iy", _leaf(F.col("a_lat"), 90.0))
    nodes = cut_lineage(leaves.groupBy("ix", "iy").agg(
        F.min(F.least("a_lon", "b_lon")).alias("west"), F.max(F.greatest("a_lon", "b_lon")).alias("east"),
        F.min(F.least("a_lat", "b_lat")).alias("south"), F.max(F.greatest("a_lat", "b_lat")).alias("north"),
        F.min(F.struct("a_lon", "a_lat")).alias("vertex")))
    found = placed.join(close.select(point_id), point_id, "left_anti").withColumn("cx", F.lit(0)).withColumn("cy", F.lit(0))
    by_point = Window.partitionBy(point_id, "longitude", "latitude")
    for level in range(TOP - 1, -1, -1):
        under = nodes.groupBy(_up(F.col("ix"), level).alias("nx"), _up(F.col("iy"), level).alias("ny")).agg(
            F.min("west").alias("west"), F.max("east").alias("east"), F.min("south").alias("south"), F.max("north").alias("north"),
            F.min("vertex").alias("vertex")).withColumn("cx", _up(F.col("nx"), 1)).withColumn("cy", _up(F.col("ny"), 1))
        met = found.join(F.broadcast(under) if level >= BOUNDED_LEVEL else under, ["cx", "cy"])
        most = geo.point_segment_nm(F.col("longitude"), F.col("latitude"), F.col("vertex.a_lon"), F.col("vertex.a_lat"),
                                    F.col("vertex.a_lon"), F.col("vertex.a_lat"))
        found = met.withColumn("_least", _box_nm()).withColumn("_most", F.min(most).over(by_point)).where(
            F.col("_least") <= F.col("_most")).select(
            point_id, "latitude", "longitude", F.col("nx").alias("cx"), F.col("ny").alias("cy"))
    far = (found.join(leaves.withColumnsRenamed({"ix": "cx", "iy": "cy"}), ["cx", "cy"]).withColumn("_d", distance)
           .groupBy(point_id).agg(best))
    return close.select(*shown).unionByName(far.select(*shown))


def infrastructure_context(points: DataFrame, segs: DataFrame, point_id: str, search_nm: float, review_nm: float,
                           feature: str = "feature_id", kind: str = "infrastructure_type", name: str = "name") -> DataFrame:
    """Every point with its nearest feature: id, type ('unknown' where it has none), name (the id, or 'unnamed reference',
    where it has none), distance, whether that is within the search radius, and whether it is near enough for review.
    Points without a position, and all points where there is no feature, have NULLs and two times false."""
    here = segs.withColumns({kind: F.coalesce(present(kind), F.lit("unknown")),
                             name: F.coalesce(present(name), present(feature), F.lit("unnamed reference"))})
    near = nearest_at_any_distance(points, here, point_id, feature, (kind, name), search_nm, max(LEAF_DEGREES, search_nm / 20))
    flag = lambda within: F.coalesce(F.col("distance_nm") <= within, F.lit(False))
    return points.select(point_id).join(near, point_id, "left").select(
        point_id, F.col(feature).alias("nearest_reference_id"), F.col(kind).alias("nearest_type"), F.col(name).alias("nearest_name"),
        F.col("distance_nm").alias("nearest_distance_nm"), flag(search_nm).alias("found_within_search_radius"),
        flag(review_nm).alias("near_infrastructure_reference"))


def feature_distance(points: DataFrame, segs: DataFrame, point_cols, feature: str = "feature_id") -> DataFrame:
    """Distance from each row's point to the feature named in the row; equi-join on the feature."""
    s = segs.select(F.col(feature), "a_lon", "a_lat", "b_lon", "b_lat")
    distance = geo.point_segment_nm(F.col("longitude"), F.col("latitude"), F.col("a_lon"), F.col("a_lat"),
                                    F.col("b_lon"), F.col("b_lat"))
    return points.join(s, feature).groupBy(*point_cols, feature).agg(F.min(distance).alias("distance_nm"))


#: A polygon's cells are about this many of its edges long; sizes are powers of two of the asked size, up to 2^8 either way.
CELL_EDGES, MOST_POWER = 16, 8

#: Blocks of 8^level cells of a row; a row of 8^5 cells goes round the earth at any size used.
BLOCK_LEVELS = 5


def ring_sizes(rings: DataFrame, cell: float, feature: str = "feature_id") -> DataFrame:
    """Per polygon the power of two that its cells are of ``cell``: from its mean edge, so that the number of edges in a
    cell does not grow with the length of the ring."""
    length = F.avg(F.hypot(F.col("b_lon") - F.col("a_lon"), F.col("b_lat") - F.col("a_lat")))
    power = F.round(F.log2(F.greatest(length, F.lit(1e-12)) * CELL_EDGES / cell))
    return rings.where("b_lon IS NOT NULL").groupBy(feature).agg(F.least(F.lit(MOST_POWER), F.greatest(F.lit(-MOST_POWER), power)).cast("int").alias("z"))


def polygon_cover(rings: DataFrame, cell: float, feature: str = "feature_id") -> DataFrame:
    """Cells that polygons cover: (feature, z, level, cy, kx, odd, edges).

    Border cells (level 0) carry the edges that touch them, and whether the middle of their east side is inside.
    What lies between two border cells of a row is inside or outside as a whole; inside, it is listed as blocks of
    8^level cells without edges, at most 14 of a level. Crossings are added along a row of border cells.
    """
    size = F.lit(cell) * F.pow(F.lit(2.0), F.col("z"))
    edges = rings.where("b_lon IS NOT NULL").select(feature, "a_lon", "a_lat", "b_lon", "b_lat")
    listed = cover_cells(edges.join(ring_sizes(rings, cell, feature), feature), 0.0, size)
    middle = (F.col("cy") + 0.5) * size
    at = _cross_lon(F.col, middle)
    crosses = ((F.col("a_lat") > middle) != (F.col("b_lat") > middle)) & (at > F.col("cx") * size) & (at <= (F.col("cx") + 1) * size)
    cells = listed.groupBy(feature, "z", "cy", "cx").agg(
        F.sum(F.coalesce(crosses, F.lit(False)).cast("int")).alias("n"), F.collect_list(F.struct("a_lon", "a_lat", "b_lon", "b_lat")).alias("edges"))
    row = Window.partitionBy(feature, "z", "cy").orderBy(F.col("cx").desc())
    east = F.coalesce(F.sum("n").over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.withColumns({"odd": east % 2 == 1, "next": F.lag("cx").over(row)})
    border = cells.select(feature, "z", F.lit(0).alias("level"), "cy", F.col("cx").alias("kx"), "odd", "edges")
    runs = cells.where(F.col("odd") & (F.col("next") > F.col("cx") + 1)).select(
        feature, "z", "cy", (F.col("cx") + 1).alias("_a"), F.col("next").alias("_b"))

    def first(level):
        return F.ceil(F.col("_a") / F.pow(F.lit(8.0), level))

    def end(level):  # behind the last block inside
        return F.floor(F.col("_b") / F.pow(F.lit(8.0), level))

    def blocks(level: Column) -> Column:
        """Blocks of a level inside the run that no larger block holds."""
        larger = (first(level + 1) < end(level + 1)) & (level < BLOCK_LEVELS - 1)
        left_end = F.when(larger, first(level + 1) * 8).otherwise(end(level))
        right = F.when(larger, _count_up(end(level + 1) * 8, end(level)))
        return F.concat(_count_up(first(level), left_end), F.coalesce(right, F.array().cast("array<bigint>")))

    inner = runs.select("*", F.explode(F.sequence(F.lit(0), F.lit(BLOCK_LEVELS - 1))).alias("level")).select(
        feature, "z", "level", "cy", F.explode(blocks(F.col("level"))).alias("kx"), F.lit(True).alias("odd"),
        F.lit(None).cast(border.schema["edges"].dataType).alias("edges"))
    return border.unionByName(inner)


def _count_up(start: Column, stop: Column) -> Column:
    """start, start + 1, ... before stop; empty if there is none."""
    return F.when(start < stop, F.sequence(start, stop - 1)).otherwise(F.array().cast("array<bigint>"))


def _cross_lon(of, lat: Column) -> Column:
    """Where an edge crosses a latitude."""
    return of("a_lon") + (lat - of("a_lat")) * (of("b_lon") - of("a_lon")) / F.nullif(of("b_lat") - of("a_lat"), F.lit(0.0))


def inside_polygon(points: DataFrame, rings: DataFrame, point_cols, cell: float, feature: str = "feature_id") -> DataFrame:
    """(point, feature) for points inside a polygon, holes excluded (even-odd).

    An equi-join of points with the cells of ``polygon_cover``. A point in an inner block is inside without a look at
    an edge. In a border cell the way from the point to the middle of the cell's east side, first along its
    latitude, then along the side, crosses only edges of the cell; an odd number of them changes the side's answer.
    So the work of a point depends on the edges of one cell, not on the ring. Polygons with the same edges are one shape
    until the end.
    """
    members, rings = shapes(rings.where("b_lon IS NOT NULL"), feature)
    members, rings = cut_lineage(members), cut_lineage(rings)
    used = [r.z for r in ring_sizes(rings, cell, "shape").select("z").distinct().collect()]  # at most 17 numbers
    if not used:
        return points.join(members.select(feature), F.lit(False)).select(*point_cols, feature)
    keys = []
    for z in used:
        size = cell * 2.0 ** z
        cx, cy = geo.cell(F.col("longitude"), size).cast("bigint"), geo.cell(F.col("latitude"), size).cast("bigint")
        keys += [F.struct(F.lit(z).alias("z"), F.lit(level).alias("level"), cy.alias("cy"), F.floor(cx / 8 ** level).alias("kx")) for level in range(BLOCK_LEVELS)]
    located = points.where("longitude IS NOT NULL AND latitude IS NOT NULL").select(
        *point_cols, F.col("longitude").alias("_lon"), F.col("latitude").alias("_lat"), F.explode(F.array(*keys)).alias("_k")).select(
        *point_cols, "_lon", "_lat", "_k.*")
    size = F.lit(cell) * F.pow(F.lit(2.0), F.col("z"))
    lon, lat, side, middle = F.col("_lon"), F.col("_lat"), (F.col("kx") + 1) * size, (F.col("cy") + 0.5) * size

    def changes(edge: Column) -> Column:
        of = edge.getField
        at = _cross_lon(of, lat)
        along = ((of("a_lat") > lat) != (of("b_lat") > lat)) & (at > lon) & (at <= side)
        y = of("a_lat") + (side - of("a_lon")) * (of("b_lat") - of("a_lat")) / F.nullif(of("b_lon") - of("a_lon"), F.lit(0.0))
        up = ((of("a_lon") > side) != (of("b_lon") > side)) & ((y > middle) != (y > lat))
        return F.coalesce(along, F.lit(False)).cast("int") + F.coalesce(up, F.lit(False)).cast("int")

    met = located.join(polygon_cover(rings, cell, "shape"), ["z", "level", "cy", "kx"])
    crossed = F.aggregate(F.coalesce("edges", F.array()), F.lit(0), lambda n, edge: n + changes(edge))
    inside = met.where((crossed + F.col("odd").cast("int")) % 2 == 1).select(*point_cols, "shape")
    return inside.join(members, "shape").select(*point_cols, feature)
