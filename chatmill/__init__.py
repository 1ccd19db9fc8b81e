"""Chat-tuning data preparation and reply evaluation as Spark DataFrame jobs."""
