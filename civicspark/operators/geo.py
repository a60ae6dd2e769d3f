"""Points in polygons by quadtree cells, and crosswalks between area systems."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch


def edges(zones: DataFrame, zone: str, coordinates: str) -> DataFrame:
    """``zone``, ``polygon`` and each edge x1, y1, x2, y2 of all rings; holes are rings like any other."""
    rings = zones.select(
        F.col(zone).alias("zone"), F.posexplode(coordinates).alias("polygon", "rings")
    ).select("zone", "polygon", F.explode("rings").alias("ring"))
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("ring") - 1),
        lambda i: F.struct(F.element_at("ring", i).alias("a"), F.element_at("ring", i + 1).alias("b")),
    )
    return rings.where(F.size("ring") >= 2).select("zone", "polygon", F.explode(pairs).alias("e")).select(
        "zone", "polygon", *[F.element_at(f"e.{p}", i).alias(f"{c}{n}") for n, p in ((1, "a"), (2, "b")) for i, c in ((1, "x"), (2, "y"))]
    )


#: A polygon's finest cells are so many in its longer direction at most, and inner ones are merged so many times.
_SPAN, _MERGES = 32, 5
#: Where the grid of all levels begins: no place that coordinates are likely to have, so that no edge lies along a cell's side.
_ORIGIN = {"x": 0.1234567891011, "y": 0.2357111317192}
_LEAST_LEVEL = -40


def _place(value: Column, axis: str, level: Column) -> Column:
    return F.floor((value - _ORIGIN[axis]) / F.pow(F.lit(2.0), level)).cast("long")


def _side(place: Column, axis: str, level: Column) -> Column:
    """The upper side of a cell."""
    return (place + 1) * F.pow(F.lit(2.0), level) + _ORIGIN[axis]


def _crossing(along: str, across: str, at: Column) -> tuple[Column, Column]:
    """Whether an edge crosses the line ``across`` = ``at``, and where along it; an end on the line counts to one side."""
    a, b, c, d = (F.col(f"{v}{n}") for n in (1, 2) for v in (along, across))
    return (b > at) != (d > at), (c - a) * (at - b) / F.nullif(d - b, F.lit(0.0)) + a


@dataclass(frozen=True)
class Cover:
    """``cells``: zone, polygon, level, ix, iy of a polygon's cells, ``inner`` ones wholly within it, others with
    ``corner``, whether their upper right corner is. ``edges``: the edges that each cell that isn't inner meets."""

    cells: DataFrame
    edges: DataFrame


def cover(zones: DataFrame, zone: str = "zone", coordinates: str = "coordinates") -> Cover:
    """Action: a quadtree cover of each polygon, in cells of a size that goes by the polygon's own: about a thousand of the finest
    at most, whatever its size, and four inner ones that make up a larger one are merged."""
    border = edges(zones, zone, coordinates).where(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in ("x1", "y1", "x2", "y2")))
    ends = {f"{c}_{n}": f(g(f"{c}1", f"{c}2")) for c in "xy" for n, f, g in (("lo", F.min, F.least), ("hi", F.max, F.greatest))}
    boxes = border.groupBy("zone", "polygon").agg(*[v.alias(k) for k, v in ends.items()])
    extent = F.greatest(F.col("x_hi") - F.col("x_lo"), F.col("y_hi") - F.col("y_lo"))
    level = F.when(extent > 0, F.greatest(F.ceil(F.log2(extent / _SPAN)), F.lit(_LEAST_LEVEL))).otherwise(_LEAST_LEVEL)
    boxes = boxes.withColumn("level", level.cast("int"))
    spread = lambda df, axis, lo, hi: F.explode(F.sequence(_place(lo, axis, F.col("level")), _place(hi, axis, F.col("level"))))
    own = border.join(boxes.select("zone", "polygon", "level"), ["zone", "polygon"])
    least, most = (lambda c: F.least(f"{c}1", f"{c}2")), (lambda c: F.greatest(f"{c}1", f"{c}2"))
    rows = own.withColumn("iy", spread(own, "y", least("y"), most("y")))

    # cells that an edge meets: those of its box that its line doesn't pass by
    half = F.pow(F.lit(2.0), F.col("level")) / 2
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    cx, cy = _side(F.col("ix"), "x", F.col("level")) - half, _side(F.col("iy"), "y", F.col("level")) - half
    apart = F.abs(dx * (cy - F.col("y1")) - dy * (cx - F.col("x1"))) > half * (F.abs(dx) + F.abs(dy)) * 1.000001
    met = rows.withColumn("ix", spread(rows, "x", least("x"), most("x"))).where(~apart)

    # of each cell of the box, how many edges the ray from its upper right corner crosses
    top, right = _side(F.col("iy"), "y", F.col("level")), _side(F.col("ix"), "x", F.col("level"))
    crosses, at = _crossing("x", "y", top)
    lines = rows.where(crosses).select("zone", "polygon", "iy", at.alias("at"))
    grid = boxes.withColumn("iy", spread(boxes, "y", F.col("y_lo"), F.col("y_hi")))
    grid = grid.withColumn("ix", spread(grid, "x", F.col("x_lo"), F.col("x_hi"))).select("zone", "polygon", "level", "ix", "iy")
    key = ["zone", "polygon", "level", "ix", "iy"]
    corners = grid.join(lines, ["zone", "polygon", "iy"], "left").groupBy(key).agg((F.count_if(right < F.col("at")) % 2 == 1).alias("corner"))
    touched = met.select(key).distinct().withColumn("touched", F.lit(True))
    cells = corners.join(touched, key, "left").withColumn("inner", F.col("touched").isNull()).drop("touched").where("NOT inner OR corner")

    spark, path = zones.sparkSession, scratch(zones.sparkSession, "cells")
    cells.write.parquet(path)
    cells = spark.read.schema(cells.schema).parquet(path)

    # a larger cell is inner if all its cells are; of nested ones the largest stays
    above = cells.where("inner").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(_MERGES))))
    up = lambda c: F.expr(f"shiftright({c}, k)").alias(c)
    whole = above.groupBy("zone", "polygon", (F.col("level") + F.col("k")).alias("level"), up("ix"), up("iy"), "k").agg(
        F.count("*").alias("n")
    ).where(F.col("n") == F.pow(F.lit(4), F.col("k")))
    below = whole.select("zone", "polygon", "k", "level", F.explode(F.array(*[F.struct((F.col("ix") * 2 + i).alias("ix"), (F.col("iy") * 2 + j).alias("iy")) for i in (0, 1) for j in (0, 1)])).alias("c"))
    below = below.where("k > 0").select("zone", "polygon", (F.col("level") - 1).alias("level"), "c.ix", "c.iy")
    merged = whole.join(below, key, "left_anti").select(*key, F.lit(True).alias("corner"), F.lit(True).alias("inner"))
    whole = merged.unionByName(cells.where("NOT inner"))
    return Cover(whole, met.select(*key, "x1", "y1", "x2", "y2"))


def points_in_polygons(
    points: DataFrame, zones: DataFrame, *, key: str, x: str, y: str, zone: str = "zone", coordinates: str = "coordinates"
) -> DataFrame:
    """Action: ``key`` and ``zone`` of each point that lies in a polygon, the smallest zone where several hold it.

    A point is in a polygon if a ray to the right crosses an odd number of its edges. A point in an inner cell is in; in
    another cell its ray goes to the right side and along that to the upper corner, of which it is known whether it is in,
    so that only edges that meet the cell count. Points are joined on their cells of all levels that polygons have, of
    which there are few; the action is for these. Points and edges without a place are left out.
    """
    made = cover(zones, zone, coordinates)
    spark, path = points.sparkSession, scratch(points.sparkSession, "cover")
    made.cells.write.parquet(path)
    cells = spark.read.schema(made.cells.schema).parquet(path)
    levels = sorted(r["level"] for r in cells.select("level").distinct().collect())  # one number a size of polygons
    spots = points.select(F.col(key).alias("_k"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).where(
        "_x IS NOT NULL AND _y IS NOT NULL AND NOT isnan(_x) AND NOT isnan(_y)"
    )
    spots = spots.withColumn("_r", F.monotonically_increasing_id())  # points that stand twice count each for itself
    spots = spots.withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>")))
    spots = spots.withColumns({"ix": _place(F.col("_x"), "x", F.col("level")), "iy": _place(F.col("_y"), "y", F.col("level"))})
    found = spots.join(cells, ["level", "ix", "iy"])
    sure = found.where("inner").select("_k", "zone")
    top, right = _side(F.col("iy"), "y", F.col("level")), _side(F.col("ix"), "x", F.col("level"))
    (level_with, at), (upright, height) = _crossing("x", "y", F.col("_y")), _crossing("y", "x", right)
    flat = level_with & (F.col("_x") < at) & ~(right < at)
    up = upright & (F.col("_y") < height) & ~(top < height)
    turns = (F.count_if(flat) + F.count_if(up) + F.max(F.col("corner").cast("int"))) % 2 == 1
    near = found.where("NOT inner").join(made.edges, ["zone", "polygon", "level", "ix", "iy"])
    hits = near.groupBy("_k", "_r", "zone", "polygon").agg(turns.alias("in")).where("in").select("_k", "zone")
    return sure.union(hits).groupBy(F.col("_k").alias(key)).agg(F.min("zone").alias("zone"))


def assign_zones(points: DataFrame, found: DataFrame, labels: DataFrame, *, key: str, label: str) -> DataFrame:
    """Each point with ``zone`` and ``zone_source``: by place, else by its label (``labels``: label, zone), else null."""
    by_label = labels.select(F.col(label), F.col("zone").alias("_label_zone"))
    out = points.join(found, key, "left").join(by_label, label, "left")
    source = F.when(F.col("zone").isNotNull(), "place").when(F.col("_label_zone").isNotNull(), "label")
    return out.withColumn("zone_source", source).withColumn("zone", F.coalesce("zone", "_label_zone")).drop("_label_zone")


def crosswalk(placed: DataFrame, *, zone: str, label: str) -> DataFrame:
    """``label``, ``zone``, ``n`` and ``share``: how a label's rows spread over zones, by number."""
    counts = placed.where(F.col(zone).isNotNull() & F.col(label).isNotNull()).groupBy(label, zone).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(label)))
