"""Statistics, feature preparation, models and evaluation on Spark ML."""
