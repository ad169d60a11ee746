"""Market-candle analytics expressed as Spark DataFrame transformations."""
