"""Market-data analytics expressed as Spark DataFrame plans."""
