"""Raster time series and corpus preparation as Spark relations."""
