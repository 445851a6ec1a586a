"""tilewright: floor-plan annotation and raster-mask analytics on Spark."""
