"""geomosaic: raster catalogs and mosaics as plain Spark DataFrames."""
