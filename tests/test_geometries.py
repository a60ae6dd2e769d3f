"""Geometries of any type to text and back."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from civicspark.functions import wkt

CASES = {
    "POINT (1 2.5)": {"type": "Point", "coordinates": [1, 2.5]},
    "POINT Z (1 -2 3)": {"type": "Point", "coordinates": [1, -2, 3]},
    "POINT EMPTY": {"type": "Point", "coordinates": []},
    "LINESTRING (0 0, 1.0E-7 1)": {"type": "LineString", "coordinates": [[0, 0], [1.0e-7, 1]]},
    "MULTIPOINT (1 2, -3 4)": {"type": "MultiPoint", "coordinates": [[1, 2], [-3, 4]]},
    "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))": {
        "type": "Polygon",
        "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 1]]],
    },
    "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))": {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 1]], [[2, 2], [3, 3]]]},
    "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0)))": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [4, 0], [4, 4], [0, 0]]]]},
    "MULTIPOLYGON EMPTY": {"type": "MultiPolygon", "coordinates": []},
    "GEOMETRYCOLLECTION EMPTY": {"type": "GeometryCollection", "geometries": []},
    "GEOMETRYCOLLECTION (POINT (1 2), GEOMETRYCOLLECTION (MULTIPOINT (1 1, 2 2), GEOMETRYCOLLECTION (POINT (3 3), LINESTRING (0 0, 1 1))))": {
        "type": "GeometryCollection",
        "geometries": [
            {"type": "Point", "coordinates": [1, 2]},
            {
                "type": "GeometryCollection",
                "geometries": [
                    {"type": "MultiPoint", "coordinates": [[1, 1], [2, 2]]},
                    {
                        "type": "GeometryCollection",
                        "geometries": [{"type": "Point", "coordinates": [3, 3]}, {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}],
                    },
                ],
            },
        ],
    },
}
BROKEN = ['{"type":"Point","coordinates":[[1,2]]}', '{"type":"Ring","coordinates":[1,2]}', "[1]", "no json", None, "{}", '{"type":"Polygon"}']
BROKEN += ['{"type":"GeometryCollection","geometries":[{"type":"Ring"}]}']


def test_every_type_to_text_and_back(spark):
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in CASES.items()], "want string, json string")
    made = df.withColumn("wkt", wkt.geometry(F.try_parse_json("json"))).withColumn("back", wkt.geometry_json(F.col("wkt")))
    for r in made.collect():
        assert r.wkt == r.want and json.loads(r.back) == CASES[r.want]


def test_what_is_no_geometry_is_null(spark):
    df = spark.createDataFrame([(x,) for x in BROKEN], "json string")
    assert all(r[0] is None for r in df.select(wkt.geometry(F.try_parse_json("json"))).collect())
    texts = spark.createDataFrame([("POINT (1)",), ("CIRCLE (1 2)",), ("",), (None,), ("POINT (1 2",)], "t string")
    assert all(r[0] is None for r in texts.select(wkt.geometry_json(F.col("t"))).collect())
