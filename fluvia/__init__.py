"""fluvia: raster-change analytics over pixel tables, in Spark."""
