"""Windowed commerce analytics on Spark: event decoding, sliding-window tables,
a keyed serving table, reports over it, anomaly bands and seasonal forecasts."""
