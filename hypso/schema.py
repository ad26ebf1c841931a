"""Explicit schemas of everything that is read or written; nothing is inferred."""

from pyspark.sql import types as T

EARTH_CIRCUMFERENCE_M = 40075016.68557849
TILE_SIZE = 512
BASE_RESOLUTION_M = EARTH_CIRCUMFERENCE_M / TILE_SIZE
MAX_ZOOM = 17
BUCKET_ZOOM = 5
SUBTREE_ZOOM = 6
JAPAN = (122.0, 24.0, 154.0, 46.0)
# Fixed value: whose elevations the archives hold, unless told otherwise.
ATTRIBUTION = "国土地理院 (GSI Japan)"

BOUNDS_CSV = T.StructType(
    [T.StructField("filename", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in ("left", "bottom", "right", "top")]
    + [T.StructField(c, T.IntegerType()) for c in ("width", "height")]
)
FOOTPRINT = T.StructType(
    [*BOUNDS_CSV.fields, T.StructField("path", T.StringType()), T.StructField("pixel_size", T.DoubleType()), T.StructField("source", T.StringType()), T.StructField("priority", T.IntegerType())]
)
TILE = "z int, x int, y int, tile_data binary"
TILE_GRID = "z int, x int, y int, px array<float>"
METADATA = "name string, value string"
WRITER_LOG = "event string, timestamp string, ts string, time string, wal_bytes bigint, batch_committed bigint, insert_count bigint"
