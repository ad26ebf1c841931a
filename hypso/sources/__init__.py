"""Readers and writers: raster catalogues, GeoTIFF, MBTiles, PMTiles, image codecs."""
