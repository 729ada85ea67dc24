"""Candle (OHLC) analytics on Spark: ingest, slice, aggregate, featurise, publish."""
