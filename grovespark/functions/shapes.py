"""Polygons as nested arrays: polygons, rings, points (x, y). A Polygon is first promoted to a MultiPolygon."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS = "array<array<array<double>>>"
POLYGONS = f"array<{RINGS}>"
SHORTEST = 0.000001


def parse(text: Column) -> Column:
    """The polygons of a GeoJSON Polygon or MultiPolygon; null for anything else."""
    kind = F.get_json_object(text, "$.type")
    coordinates = F.get_json_object(text, "$.coordinates")
    return F.when(kind == "MultiPolygon", F.from_json(coordinates, POLYGONS)).when(kind == "Polygon", F.array(F.from_json(coordinates, RINGS)))


def exterior_rings(polygons: Column) -> Column:
    return F.filter(F.transform(polygons, lambda p: F.get(p, 0)), lambda r: r.isNotNull())


def exterior_points(polygons: Column) -> Column:
    return F.flatten(exterior_rings(polygons))


def bounds(polygons: Column) -> Column:
    points = exterior_points(polygons)
    x, y = F.transform(points, lambda p: F.get(p, 0)), F.transform(points, lambda p: F.get(p, 1))
    return F.struct(F.array_min(x).alias("min_x"), F.array_min(y).alias("min_y"), F.array_max(x).alias("max_x"), F.array_max(y).alias("max_y"))


def _ring_area(ring: Column) -> Column:
    """Half the sum of cross products, with its sign."""
    steps = F.zip_with(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), lambda a, b: F.get(a, 0) * F.get(b, 1) - F.get(b, 0) * F.get(a, 1))
    return F.aggregate(steps, F.lit(0.0), lambda s, x: s + x) / 2


def area(polygons: Column) -> Column:
    """Exterior areas less holes."""
    by_polygon = F.transform(polygons, lambda p: F.aggregate(F.transform(p, lambda r: F.abs(_ring_area(r))), F.lit(0.0), lambda s, x: s - x) + 2 * F.coalesce(F.abs(_ring_area(F.get(p, 0))), F.lit(0.0)))
    return F.aggregate(by_polygon, F.lit(0.0), lambda s, x: s + x)


def projected(x: Column, y: Column, box: Column, width: float, height: float, padding: float) -> tuple[Column, Column]:
    """A point in a picture of the box, which keeps its shape and is centred; y grows downwards."""
    span_x, span_y = F.greatest(box["max_x"] - box["min_x"], F.lit(SHORTEST)), F.greatest(box["max_y"] - box["min_y"], F.lit(SHORTEST))
    scale = F.least((width - 2 * padding) / span_x, (height - 2 * padding) / span_y)
    return (width - span_x * scale) / 2 + (x - box["min_x"]) * scale, height - ((height - span_y * scale) / 2 + (y - box["min_y"]) * scale)


def svg_path(polygons: Column, box: Column, width: float, height: float, padding: float = 18) -> Column:
    def point(p: Column, i: Column) -> Column:
        px, py = projected(F.get(p, 0), F.get(p, 1), box, width, height, padding)
        return F.concat(F.when(i == 0, "M").otherwise("L"), F.format_string("%.2f,%.2f", px, py))

    return F.array_join(F.transform(exterior_rings(polygons), lambda r: F.concat(F.array_join(F.transform(r, point), " "), F.lit(" Z"))), " ")


def label_point(polygons: Column, box: Column, width: float, height: float, padding: float = 18) -> Column:
    """The mean of the exterior points in the picture; its centre if there are none."""
    points = exterior_points(polygons)
    n = F.size(points)
    mean_x, mean_y = (F.aggregate(F.transform(points, axis), F.lit(0.0), lambda s, x: s + x) / n for axis in (lambda p: F.get(p, 0), lambda p: F.get(p, 1)))
    x, y = projected(mean_x, mean_y, box, width, height, padding)
    return F.struct(F.when(n > 0, x).otherwise(F.lit(width / 2)).alias("x"), F.when(n > 0, y).otherwise(F.lit(height / 2)).alias("y"))


def cell(x: Column, y: Column) -> Column:
    """The unit square with its lower left corner at (x, y), as polygons."""
    corner = lambda dx, dy: F.array((x + dx).cast("double"), (y + dy).cast("double"))
    return F.array(F.array(F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1), corner(0, 0))))


def directed_edges(polygons: Column) -> Column:
    """Edges (x1, y1, x2, y2) of all rings, exteriors counterclockwise and holes clockwise."""

    def steps(ring: Column, hole: Column) -> Column:
        n = F.greatest(F.size(ring) - 1, F.lit(0))
        turned = F.when((_ring_area(ring) > 0) == hole, F.reverse(ring)).otherwise(ring)
        point = lambda p, x, y: (F.get(p, 0).alias(x), F.get(p, 1).alias(y))
        return F.zip_with(F.slice(turned, 1, n), F.slice(turned, 2, n), lambda a, b: F.struct(*point(a, "x1", "y1"), *point(b, "x2", "y2")))

    return F.flatten(F.flatten(F.transform(polygons, lambda p: F.transform(p, lambda ring, i: steps(ring, i > 0)))))
