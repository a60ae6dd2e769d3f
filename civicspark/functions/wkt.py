"""Well-known text from nested coordinate arrays, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _number(x: Column) -> Column:
    """Whole numbers without a fraction, others as Spark prints them."""
    return F.when((x == F.floor(x)) & (F.abs(x) < 1e15), x.cast("bigint").cast("string")).otherwise(x.cast("string"))


def _ring(ring: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(ring, lambda p: F.concat_ws(" ", _number(p[0]), _number(p[1]))), ", "), F.lit(")"))


def multipolygon(coordinates: Column) -> Column:
    """MULTIPOLYGON text of coordinates[polygon][ring][point][x, y]; null stays null."""
    polygons = F.transform(coordinates, lambda polygon: F.concat(F.lit("("), F.array_join(F.transform(polygon, _ring), ", "), F.lit(")")))
    return F.when(coordinates.isNotNull(), F.concat(F.lit("MULTIPOLYGON ("), F.array_join(polygons, ", "), F.lit(")")))


#: Types of one position, and of lists of these of one, two or three levels, with the levels of their coordinates.
_TYPES = {"Point": 1, "LineString": 2, "MultiPoint": 2, "Polygon": 3, "MultiLineString": 3, "MultiPolygon": 4}
_COLLECTION = "GeometryCollection"
#: Collections within collections are followed so deep.
DEPTH = 3


def _position(p: Column) -> Column:
    return F.array_join(F.transform(p, _number), " ")


def _listed(coordinates: Column, levels: int) -> Column:
    """Nested lists in parentheses, positions bare."""
    inner = _position if levels == 2 else lambda x: _listed(x, levels - 1)
    return F.concat(F.lit("("), F.array_join(F.transform(coordinates, inner), ", "), F.lit(")"))


def _numbers(coordinates: Column, levels: int) -> Column:
    """Whether all that is listed at the lowest level is there."""
    return F.forall(coordinates, (lambda x: x.isNotNull()) if levels == 1 else (lambda x: _numbers(x, levels - 1)))


def geometry(value: Column, depth: int = DEPTH) -> Column:
    """Well-known text of a geometry of any type, given as a variant that holds a GeoJSON object.

    Points, lines, polygons, their multiples, and collections of these, which may hold collections. Positions of three
    numbers are marked Z; a geometry without positions is EMPTY. What is no geometry, or has coordinates of the wrong
    depth, is null, and so is a collection that holds such a one.
    """
    kind, out = F.try_variant_get(value, "$.type", "string"), None
    for name, levels in _TYPES.items():
        coordinates = F.try_variant_get(value, "$.coordinates", "array<" * levels + "double" + ">" * levels)
        first = coordinates
        for _ in range(levels - 1):
            first = F.get(first, F.lit(0))
        if name == "Point":
            text = F.concat(F.lit("("), _position(coordinates), F.lit(")"))
        else:
            text = _listed(coordinates, levels)
        tag = F.concat(F.lit(name.upper()), F.when(F.size(first) > 2, " Z ").otherwise(" "))
        whole = F.when(F.size(coordinates) == 0, F.lit(f"{name.upper()} EMPTY")).when(_numbers(coordinates, levels), F.concat(tag, text))
        out = F.when(kind == name, whole) if out is None else out.when(kind == name, whole)
    if depth:
        members = F.try_variant_get(value, "$.geometries", "array<variant>")
        texts = F.transform(members, lambda v: geometry(v, depth - 1))
        whole = F.concat(F.lit(f"{_COLLECTION.upper()} ("), F.array_join(texts, ", "), F.lit(")"))
        listed = F.when(F.size(members) == 0, F.lit(f"{_COLLECTION.upper()} EMPTY")).when(F.forall(texts, lambda t: t.isNotNull()), whole)
        out = out.when(kind == _COLLECTION, listed)
    return out


def geometry_json(text: Column, depth: int = DEPTH) -> Column:
    """The GeoJSON text of well-known text as ``geometry`` writes it; null for anything else.

    Positions become arrays and parentheses brackets, then geometries become objects: simple ones by the levels of their
    lists, and collections from the inside out, each a flat list of objects.
    """
    number = r"-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?"
    out = F.regexp_replace(F.regexp_replace(text, r" Z \(", " ("), r", ", ",")
    out = F.regexp_replace(out, rf"({number}(?: {number})+)", "[$1]")
    out = F.translate(F.regexp_replace(out, r"(?<=\d) (?=[-\d])", ","), "()", "[]")
    position = rf"\[{number}(?:,{number})+\]"
    for name, levels in sorted(_TYPES.items(), key=lambda x: -len(x[0])):  # "Point" ends "MultiPoint"
        lists = position
        for _ in range(levels - 1):
            lists = rf"\[{lists}(?:,{lists})*\]"
        found = rf"{name.upper()} \[({lists})\]" if name == "Point" else rf"{name.upper()} ({lists})"
        out = F.regexp_replace(out, found, f'{{"type":"{name}","coordinates":$1}}')
        out = F.regexp_replace(out, f"{name.upper()} EMPTY", f'{{"type":"{name}","coordinates":[]}}')
    members = r"\{[^{}]*\}"
    out = F.regexp_replace(out, f"{_COLLECTION.upper()} EMPTY", f'{{"type":"{_COLLECTION}","geometries":[]}}')
    for _ in range(depth):
        found = rf"{_COLLECTION.upper()} \[({members}(?:,{members})*)\]"
        out = F.regexp_replace(out, found, f'{{"type":"{_COLLECTION}","geometries":[$1]}}')
        members = rf"\{{(?:[^{{}}]|{members})*\}}"
    return F.when(out.rlike(r"^\{.*\}$") & F.try_parse_json(out).isNotNull(), out)


def valid_rings(coordinates: Column) -> Column:
    """Whether every ring has four points or more and ends where it begins; null for null."""
    closed = lambda ring: (F.size(ring) >= 4) & (F.element_at(ring, 1) == F.element_at(ring, -1))
    return F.forall(coordinates, lambda polygon: F.forall(polygon, closed))


def geojson(geometry: Column) -> Column:
    return F.to_json(geometry)
