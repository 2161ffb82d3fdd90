"""Species-distribution data work on Spark: cleaning, land cover, sampling, models."""
