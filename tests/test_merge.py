import pytest
from pyspark.sql import functions as F

from hypso.operators import archive, inspection, merge, tiling
from hypso.plans import zoom_split

A1 = [(0, 0, 0, 1.0), (0, 0, 1, None), (0, 1, 0, None), (0, 1, 1, 4.0), (1, 0, 0, None), (1, 0, 1, 2.0), (1, 1, 0, 3.0), (1, 1, 1, None)]


@pytest.fixture
def grids(spark):
    return spark.createDataFrame(A1, "prio int, row int, col int, elev double")


def test_priority_merge_with_sources(grids):
    got = {(r.row, r.col): (r.elev, r.prov) for r in merge.priority_merge(grids, ["row", "col"], ["prio"]).collect()}
    assert got == {(0, 0): (1.0, 0), (0, 1): (2.0, 1), (1, 0): (3.0, 1), (1, 1): (4.0, 0)}


def test_finer_then_earlier_wins(spark):
    rows = [(0, 2.0, 0, 10.0), (0, 1.0, 1, 20.0), (0, 1.0, 2, 30.0)]
    df = spark.createDataFrame(rows, "prio int, pixel_size double, record_ord int, elev double").withColumn("k", F.lit(1))
    assert merge.priority_merge(df, ["k"], ["prio", "pixel_size", "record_ord"], source="record_ord").first().elev == 20.0


def test_nan_and_marker_become_null(spark):
    df = spark.createDataFrame([(float("nan"),), (-9999.0,), (5.0,)], "v double").select(merge.no_data(F.col("v"), -9999.0).alias("v"))
    assert [r.v for r in df.collect()] == [None, None, 5.0]


def test_array_form_equals_long_form(spark):
    rows = [(5, 1, 1, 0, [1.0, None, None, float("nan")]), (5, 1, 1, 1, [None, 2.0, None, 7.0]), (5, 2, 2, 0, [None, None, None, None])]
    df = spark.createDataFrame(rows, "z int, x int, y int, prio int, px array<float>")
    got = merge.merge_grids(df, ["prio"]).collect()
    assert [(r.x, r.px, r.prov) for r in got] == [(1, [1.0, 2.0, None, 7.0], [0, 1, -1, 1])]


def test_max_merge_takes_encoded_nodata_as_zero(spark):
    df = spark.createDataFrame([(0, 0, 0, [-5.0]), (0, 0, 0, [0.0])], "z int, x int, y int, px array<float>")
    assert merge.max_grids(df).first().px == [0.0]


def tiles(spark, rows):
    return spark.createDataFrame(rows, "z int, x int, y int, tile_data string")


def test_disjoint_union_and_overlap(spark):
    a, b = tiles(spark, [(5, 10, 12, "x")]), tiles(spark, [(6, 20, 15, "x")])
    assert archive.union_archives([a, b]).count() == 2
    with pytest.raises(ValueError, match="z5/x10/y12"):
        archive.union_archives([a, a])
    assert archive.union_archives([a, tiles(spark, [(5, 10, 12, "new")])], verify=False).first().tile_data == "new"
    assert archive.union_archives([tiles(spark, []), a]).count() == 1


def test_duplicates_name_the_first_holder(spark):
    df = spark.createDataFrame([(5, 1, 1, f"f{i}", i) for i in range(3)], "z int, x int, y int, file string, src_idx int")
    got = archive.duplicate_tiles(df).collect()
    assert sorted(r.file for r in got) == ["f1", "f2"]
    assert all("found in both f0 and" in r.message for r in got)


def test_stats(spark):
    r = archive.tile_stats(tiles(spark, [(6, 20, 15, "x")])).first()
    assert (r.n, r.min_zoom, r.max_zoom) == (1, 6, 6) and r.west < r.east and r.south < r.north
    assert archive.tile_stats(tiles(spark, [])).first().min_zoom is None
    assert archive.metadata_rows(archive.tile_stats(tiles(spark, [])), "n").count() == 0
    told = {r.name: r.value for r in archive.metadata_rows(archive.tile_stats(tiles(spark, [(5, 1, 1, "x"), (7, 3, 3, "x")])), "n", {"encoding": "e"}).collect()}
    assert set(told) == {"name", "format", "bounds", "minzoom", "maxzoom", "center", "attribution", "encoding"}
    assert (told["minzoom"], told["maxzoom"], told["encoding"]) == ("5", "7", "e")


def test_metadata_merge(spark):
    rows = [(0, "attribution", "B "), (1, "attribution", "A"), (2, "attribution", None), (3, "attribution", "A"), (0, "name", "first"), (1, "name", "second")]
    got = {r.name: r.value for r in archive.merged_metadata(spark.createDataFrame(rows, "src_idx int, name string, value string")).collect()}
    assert got == {"attribution": "A | B", "name": "first"}


def test_diff_and_inserts(spark):
    a, b = tiles(spark, [(1, 0, 0, "a"), (1, 0, 1, "b"), (1, 1, 0, "c")]), tiles(spark, [(1, 0, 0, "a"), (1, 0, 1, "z"), (1, 1, 1, "d")])
    got = {(r.x, r.y): r.status for r in archive.archive_diff(a, b).collect()}
    assert got == {(0, 0): "matched", (0, 1): "mismatch", (1, 0): "missing", (1, 1): "extra"}
    kept = {(r.x, r.y): r.tile_data for r in merge.insert_missing(a, b).collect()}
    assert kept[(0, 1)] == "b" and kept[(1, 1)] == "d"


def test_rate(spark):
    df = spark.createDataFrame([("a", 0, 0.0), ("a", 150, 300.0), ("a", 300, 600.0), ("b", 5, 1.0), ("c", 0, 0.0), ("c", 1000, 500.0)], "k string, t long, v double")
    got = {r.k: r.rate for r in inspection.recent_rate(df, ["k"]).collect()}
    assert got == {"a": 2.0, "b": 0.0, "c": 0.5}


def test_human_bytes(spark):
    df = spark.createDataFrame([(512,), (2048,), (5 * 1024**3,)], "n long").select(inspection.human_bytes(F.col("n")).alias("s"))
    assert [r.s for r in df.collect()] == ["512.0 B", "2.0 KB", "5.0 GB"]


def test_low_zooms_find_their_footprints(spark):
    tile = tiling.tile_cover(spark, (139.0, 35.0, 140.0, 36.0), 0, 8)
    box = spark.createDataFrame([(15_500_000.0, 4_200_000.0, 15_560_000.0, 4_260_000.0)], "left double, bottom double, right double, top double")
    got = tiling.overlap_join(tile, box).select("z").distinct().count()
    assert got == 9


def test_box_outside_the_sources(spark):
    box = spark.createDataFrame([(15_500_000.0, 4_200_000.0, 15_560_000.0, 4_260_000.0)], "left double, bottom double, right double, top double")
    with pytest.raises(ValueError):
        tiling.clipped_extent(box, (0.0, 0.0, 1.0, 1.0))


def test_antimeridian(spark):
    xs = {r.x for r in tiling.tile_cover(spark, (179.0, 0.0, -179.0, 1.0), 3, 3).collect()}
    assert xs == {0, 7}


def test_patterns(spark):
    assert {p: len(zoom_split.pattern(p)) for p in zoom_split.PATTERNS} == {"single": 1, "balanced": 4, "safe": 6, "fast": 3, "incremental": 9}
    for p in zoom_split.PATTERNS:
        zoom_split.validate(zoom_split.pattern(p))
    with pytest.raises(ValueError):
        zoom_split.pattern("none")
    g = zoom_split.ZoomGroup
    for bad in ([], [g(1, 16, 1, 1.0)], [g(0, 5, 1, 1.0), g(7, 16, 1, 1.0)], [g(0, 5, 1, 1.0), g(6, 4, 1, 1.0)], [g(0, 12, 1, 1.0)]):
        with pytest.raises(ValueError):
            zoom_split.validate(bad)
    groups = zoom_split.custom_split(spark, 16, 10.0)
    zoom_split.validate(groups)
    assert zoom_split.estimate_tiles(spark, 0, 6, (128.3, 32.4, 131.6, 33.8)) >= 1


def test_numbered_batches_by_stretches(spark):
    """Stretches give the numbers that one window gives, null groups too."""
    df = spark.range(0, 900, 1, 4).selectExpr("IF(id % 3 = 0, NULL, CAST(id % 3 AS STRING)) AS g", "id * 7919 % 1000 AS t", "id")
    plain = inspection.numbered_batches(df, ["g"], ["t", "id"], 25, 100)
    cut = inspection.numbered_batches(df, ["g"], ["t", "id"], 25, 100, F.floor(F.col("t") / 90))
    assert cut.columns == plain.columns
    assert sorted(map(tuple, cut.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
