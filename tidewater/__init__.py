"""tidewater: DataFrame operators for batch, lake, streaming and ML work on Spark."""
