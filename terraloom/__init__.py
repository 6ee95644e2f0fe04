"""Spark jobs for global one-degree raster tiles."""
