import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hypso.functions import register, terrarium
from hypso.functions import tilemath as M
from hypso.operators import raster
from hypso.sources.pmtiles import tile_id, tile_of


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def test_flip_is_an_involution(spark):
    r = one(spark, a=M.flip_y(F.lit(5), F.lit(12)), b=M.flip_y(F.lit(5), M.flip_y(F.lit(5), F.lit(12))))
    assert (r.a, r.b) == (19, 12)


def test_pixel_size_sample_row_and_floors(spark):
    lit = [F.lit(v) for v in (15529068.97, 4232038.46, 15562464.81, 4273136.46, 1000, 1000)]
    r = one(spark, a=M.pixel_size(*lit), b=M.pixel_size(*(F.lit(v) for v in (0.0, 0.0, 0.0, 0.0, 0, 0))))
    assert abs(r.a - 41.098) < 1e-9
    assert r.b == 1e-6


def test_recommended_zoom(spark):
    r = spark.createDataFrame([(10000.0,), (0.5,), (float("nan"),), (float("inf"),), (0.0,), (-1.0,), (None,), (1e9,)], "p double").select(M.recommended_max_zoom("p").alias("z")).collect()
    z = [x.z for x in r]
    assert z[2:7] == [17] * 5
    assert z[7] == 0
    assert 0 <= z[0] <= z[1] <= 17


def test_touching_boxes_do_not_overlap(spark):
    a, b = [tuple(F.lit(float(v)) for v in box) for box in ((0, 0, 1, 1), (1, 0, 2, 1))]
    r = one(spark, touch=M.overlaps(a, b), same=M.overlaps(a, a))
    assert (r.touch, r.same) == (False, True)


def test_hilbert_ids(spark):
    rows = [(0, 0, 0), (1, 0, 0), (1, 0, 1), (1, 1, 1), (1, 1, 0)] + [(4, x, y) for x in range(16) for y in range(16)] + [(17, 116_000, 51_000)]
    got = spark.createDataFrame(rows, "z int, x int, y int").withColumn("id", M.tile_id("z", "x", "y")).collect()
    assert [r.id for r in got][:5] == [0, 1, 2, 3, 4]
    for r in got:
        assert r.id == tile_id(r.z, r.x, r.y)
        assert tile_of(r.id) == (r.z, r.x, r.y)
    curve = [tile_of(i)[1:] for i in range(85, 341)]
    assert all(abs(a[0] - b[0]) + abs(a[1] - b[1]) == 1 for a, b in zip(curve, curve[1:], strict=False))


def test_bounds_and_back(spark):
    b = one(spark, **M.lonlat_bounds(F.lit(9), F.lit(455), F.lit(201)))
    mid = one(spark, x=M.lon_to_x(F.lit((b.west + b.east) / 2), F.lit(9)), y=M.lat_to_y(F.lit((b.south + b.north) / 2), F.lit(9)))
    assert (mid.x, mid.y) == (455, 201)
    m = one(spark, **M.mercator_bounds(F.lit(9), F.lit(455), F.lit(201)))
    back = one(spark, w=M.mercator_to_lon(F.lit(m.left)), n=M.mercator_to_lat(F.lit(m.top)), y=M.lat_to_mercator(F.lit(b.north)))
    assert math.isclose(back.w, b.west) and math.isclose(back.n, b.north) and math.isclose(back.y, m.top)


@pytest.mark.parametrize(("z", "values", "metres"), [(11, [None, 0, 0.5, 1.5, 2.5, -0.5, -1, 3776.24], [0, 0, 0, 2, 2, 0, -1, 3776]), (0, [1000, 1024, 1025, 3072], [0, 0, 2048, 4096])])
def test_encode_rounds_halves_to_even(spark, z, values, metres):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "e double").withColumn("z", F.lit(z))
    got = [tuple(r) for r in df.select(*(c.alias(n) for n, c in terrarium.encode("e", "z").items())).collect()]
    assert [r * 256 + g + b / 256 - 32768 for r, g, b in got] == metres
    assert got == [tuple(int(v) for v in raster.terrarium_rgb(np.array([np.nan if v is None else v]), z)[0]) for v in values]


def test_encode_out_of_range_clips_red_only(spark):
    df = spark.createDataFrame([(40000.0,), (-40000.0,)], "e double").withColumn("z", F.lit(11))
    got = [tuple(r) for r in df.select(*(c.alias(n) for n, c in terrarium.encode("e", "z").items())).collect()]
    assert got == [(255, 72768 % 256, 0), (0, -7232 % 256, 0)]


@pytest.mark.parametrize("z", [0, 5, 11, 17])
def test_decode_inverts_encode_on_quantised_values(z):
    rng = np.random.default_rng(z)
    step = 2.0 ** (19 - z) / 256
    v = np.rint(rng.uniform(-11000, 9000, 500) / step) * step
    rgb = raster.terrarium_rgb(v, z).astype(float)
    back = rgb[:, 0] * 256 + rgb[:, 1] + rgb[:, 2] / 256 - 32768
    assert (back == v).all()
    assert (raster.terrarium_rgb(back, z) == rgb).all()


def test_palette(spark):
    df = spark.createDataFrame([(0,), (1,), (-1,), (7,), (None,)], "i int").select(terrarium.palette_colour("i").alias("c")).collect()
    assert [tuple(r.c) if r.c else None for r in df] == [(0, 100, 0), (50, 205, 50), (255, 255, 255), (193, 139, 141), None]


def test_sql_functions(spark):
    register.register(spark)
    r = spark.sql("SELECT tile_flip_y(5, 12) a, terrarium_r(1500D, 11) r, terrarium_g(1500D, 11) g, terrarium_b(1500D, 11) b, terrarium_decode(133, 220, 0) e, recommended_max_zoom(0.5D) m, tile_bounds(1, 0, 0).n n").first()
    assert (r.a, r.r, r.g, r.b, r.e, r.m) == (19, 133, 220, 0, 1500.0, 17)
    assert abs(r.n - 85.0511287798066) < 1e-9
    assert spark.sql("SELECT * FROM tile_cover(122D, 24D, 154D, 46D, 6)").count() > 0
