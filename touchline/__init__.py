"""Match-event analytics on Spark: nested JSON in, flat tables, ten reports, live-score windows."""
