"""Analytics for instrument time series, particle events and sky maps on Spark."""
