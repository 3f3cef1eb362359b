"""Shopping-event analytics on Spark: DataFrame functions for batch tables and live streams."""
