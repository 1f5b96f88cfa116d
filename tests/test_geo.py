import json

import pytest
from pyspark.sql import functions as F

from tripstar.functions.columns import geometry_moments, moments_centroid, spatial_cell
from tripstar.operators.geo import build_zone_reference, combine_zone_geometry, zone_geometry_join, zones_without_geometry


def _sq(x, y, s=1.0, cw=False):
    ring = [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]
    return ring[::-1] if cw else ring


def _centroid(spark, geojsons):
    df = spark.createDataFrame([(g,) for g in geojsons], "g STRING")
    m = geometry_moments("g")
    area, lat, lon = moments_centroid(m.a2, m.mx, m.my)
    return [(r.area, r.lat, r.lon) for r in df.select(area.alias("area"), lat.alias("lat"), lon.alias("lon")).collect()]


def test_polygon_cases(spark):
    poly = lambda rings: json.dumps({"type": "Polygon", "coordinates": rings})
    multi = lambda polys: json.dumps({"type": "MultiPolygon", "coordinates": polys})
    cases = [
        poly([_sq(3, 4)]),                              # square
        poly([_sq(3, 4, cw=True)]),                     # reversed ring
        poly([_sq(0, 0, 4), _sq(0, 0, 2, cw=True)]),    # hole in a corner
        multi([[_sq(0, 0)], [_sq(10, 0, 1)]]),          # two equal squares
        poly([[[0, 0], [1, 0], [2, 0], [0, 0]]]),       # zero area
        None,
        "not json",
        json.dumps({"type": "Point", "coordinates": [1, 2]}),
    ]
    got = _centroid(spark, cases)
    assert got[0] == pytest.approx((1.0, 4.5, 3.5))
    assert got[1] == pytest.approx((1.0, 4.5, 3.5))
    # 4x4 minus 2x2 at the origin corner: area 12, centroid x = (16*2 - 4*1)/12
    assert got[2] == pytest.approx((12.0, 28 / 12, 28 / 12))
    assert got[3] == pytest.approx((2.0, 0.5, 5.5))
    assert got[4][0] == 0 and got[4][1] is None and got[4][2] is None
    assert all(g[1] is None and g[2] is None for g in got[5:])


def test_spatial_cell(spark):
    df = spark.createDataFrame([(0.0, 0.0), (90.0, 180.0), (-90.0, -180.0), (None, 1.0), (91.0, 0.0),
                                (float("nan"), 0.0), (40.75, -73.99)], "lat DOUBLE, lon DOUBLE")
    got = [r.c for r in df.select(spatial_cell("lat", "lon", 2).alias("c")).collect()]
    assert got[:3] == ["2/2/2", "2/3/3", "2/0/0"]
    assert got[3:6] == [None, None, None]
    assert got[6] == "2/1/2"
    with pytest.raises(ValueError):
        spatial_cell("lat", "lon", 31)


def test_zone_parts_combine_area_weighted(spark):
    g = spark.createDataFrame([
        (56, json.dumps({"type": "Polygon", "coordinates": [_sq(0, 0, 1)]})),
        (56, json.dumps({"type": "Polygon", "coordinates": [_sq(3, 0, 2)]})),
        (7, json.dumps({"type": "Polygon", "coordinates": [_sq(1, 1)]})),
    ], "location_id INT, polygon_geojson STRING")
    z = {r.location_id: r for r in combine_zone_geometry(g).collect()}
    assert z[56].parts == 2
    assert z[56].centroid_lon == pytest.approx((1 * 0.5 + 4 * 4.0) / 5)
    assert json.loads(z[56].polygon_geojson)["coordinates"][0][0] == [3, 0]  # the larger part
    lookup = spark.createDataFrame([(56, "Queens", "Z56", None), (57, "Queens", "Z57", "Boro Zone"), (7, "A", "Z7", "x")],
                                   "location_id INT, borough STRING, zone_name STRING, service_zone STRING")
    ref = build_zone_reference(lookup, g).collect()
    assert len(ref) == 3  # one row per lookup id
    miss = [r for r in ref if r.location_id == 57][0]
    assert miss.polygon_geojson is None and miss.geo_hash is None and miss.h3_resolution is None


def test_null_polygon_counts_as_no_geometry(spark):
    lookup = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "location_id INT, zone_name STRING")
    geometry = spark.createDataFrame([(1, None), (2, '{"type": "Polygon", "coordinates": []}'), (2, None)], "location_id INT, polygon_geojson STRING")
    assert sorted(r.location_id for r in zones_without_geometry(lookup, geometry).collect()) == [1, 3]


def test_zone_cells_do_not_depend_on_partitioning(spark):
    from conftest import SF_SMALL
    from tripstar.registry import Inputs

    inp = Inputs(spark, SF_SMALL)
    got = set()
    for n in (1, 7, 16):
        z = build_zone_reference(inp.lookup, inp.geometry.repartition(n, "polygon_geojson"))
        got.add(tuple(sorted(map(str, z.select("location_id", "centroid_lat", "centroid_lon", "geo_hash").collect()))))
    assert len(got) == 1


def test_inverse_conic_of_a_published_example(spark):
    """The worked example of the projection's published guidance (NAD27 / Texas South Central, US survey feet)."""
    from tripstar.functions.projection import LambertConic, map_point

    texas = LambertConic(28 + 23 / 60, 30 + 17 / 60, 27 + 50 / 60, -99.0, 2_000_000.0, 0.0, 20_925_832.164, 294.97870)
    lon, lat = texas.degrees(F.lit(2_963_503.91), F.lit(254_759.80))
    got = spark.range(1).select(lon.alias("lon"), lat.alias("lat")).first()
    assert abs(got.lon + 96) < 1e-7 and abs(got.lat - 28.5) < 1e-7
    x, y = map_point(texas, -96.0, 28.5)
    assert abs(x - 2_963_503.91) < 0.01 and abs(y - 254_759.80) < 0.01


def test_projected_shapes_round_trip(spark):
    import json

    from tripstar.functions.projection import NEW_YORK_LONG_ISLAND_FT as NY
    from tripstar.functions.projection import map_point
    from tripstar.operators.geo import project_geometry

    assert [round(v, 6) for v in map_point(NY, -74.0, 40 + 10 / 60)] == [984250.0, 0.0]
    ring = [[-74.2, 40.5], [-73.7, 40.5], [-73.7, 40.9], [-74.2, 40.9], [-74.2, 40.5]]
    hole = [[-74.0, 40.6], [-74.0, 40.7], [-73.9, 40.7], [-74.0, 40.6]]
    feet = [[list(map_point(NY, *p)) for p in r] for r in (ring, hole)]
    rows = [(1, json.dumps({"type": "Polygon", "coordinates": feet})), (2, json.dumps({"type": "MultiPolygon", "coordinates": [feet, feet[:1]]})),
            (3, None), (4, "no shape"), (5, '{"type": "Point", "coordinates": [1, 2]}'), (6, '{"type": "Polygon", "coordinates": "x"}')]
    got = {r[0]: r[1] for r in project_geometry(spark.createDataFrame(rows, "location_id int, polygon_geojson string"), NY).collect()}
    one, two = json.loads(got[1]), json.loads(got[2])
    assert one["type"] == "Polygon" and two["type"] == "MultiPolygon" and len(two["coordinates"]) == 2
    flat = [p for r in one["coordinates"] for p in r]
    assert all(abs(a - b) < 1e-9 for p, q in zip(flat, ring + hole, strict=True) for a, b in zip(p, q, strict=True))
    assert [got[i] for i in (3, 4, 5, 6)] == [None] * 4


def test_zone_geometry_join_keeps_every_row_and_never_broadcasts_shapes(spark):
    lookup = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (None, "d")], "location_id INT, zone_name STRING")
    shape = json.dumps({"type": "Polygon", "coordinates": [_sq(0, 0)]})
    geometry = spark.createDataFrame([(1, shape), (1, shape), (2, None), (9, shape), (None, shape)], "location_id INT, polygon_geojson STRING")
    got = zone_geometry_join(lookup, geometry)
    assert got.columns == ["location_id", "zone_name", "polygon_geojson", "centroid_lat", "centroid_lon", "geo_hash", "h3_resolution"]
    rows = sorted(((r.location_id, r.zone_name, r.polygon_geojson, r.centroid_lat) for r in got.collect()), key=str)
    half = 0.5
    assert rows == sorted([*[(1, "a", shape, half)] * 4, (2, "b", None, None), (3, "c", None, None), (None, "d", None, None)], key=str)
    # few bytes by the planner's guess, many as texts
    many = spark.range(1000).selectExpr("CAST(id % 3 AS INT) AS location_id", "repeat(CAST(id AS STRING), 3000) AS polygon_geojson")
    plan = zone_geometry_join(lookup, many)
    for side in plan._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[1:]:
        assert "repeat(" not in side
    assert plan.count() == 2 * 333 + 333 + 2
